import hashlib
import re
from collections import defaultdict

import pytest

from panelspark.llm.exact_dedup import exact_dedup, exact_groups


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", "", t or "")


@pytest.mark.parametrize("digest_all", [True, False])
def test_groups_equal_brute_force(documents, messy, digest_all):
    got = exact_groups(documents(messy), prefix_chars=3, digest_all=digest_all).collect()
    groups = defaultdict(list)
    for i, t in messy:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    sizes = {k: len(v) for k, v in groups.items()}
    keep = {k: min(v, key=lambda x: x[:3])[3] for k, v in groups.items()}
    assert len(got) == len(messy)
    want = sorted((str(i), str(keep[norm(t)]), sizes[norm(t)]) for i, t in messy)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    digests = {hashlib.sha256(k.encode()).hexdigest() for k in groups}
    assert {r.digest for r in got if r.digest} <= digests
    if digest_all:
        assert {r.digest for r in got} == digests


def test_dedup_keeps_one_full_row_of_each_group(documents, messy):
    docs = documents(messy)
    got = exact_dedup(docs, prefix_chars=3)
    assert got.columns == docs.columns
    texts = [norm(r[1]) for r in got.collect()]
    assert sorted(texts) == sorted({norm(t) for _, t in messy})


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0
    assert exact_dedup(documents([])).count() == 0
