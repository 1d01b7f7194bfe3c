import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm.sharding import permute, row_at, shard_rows


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation_and_inverse(n, seed):
    x = np.arange(n)
    p = permute(x, n, seed)
    assert sorted(p.tolist()) == x.tolist()
    assert (row_at(p, n, seed) == x).all()


def test_every_row_has_a_place(documents, messy):
    got = shard_rows(documents(messy), shards=8).collect()
    assert len(got) == len(messy)
    by = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in by.values())
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in messy)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want


def test_shards_do_not_depend_on_partitions(documents, messy):
    key = lambda r: (str(r.doc_id), r.text_crc32, r.shard, r.slot)
    a = shard_rows(documents(messy)).collect()
    b = shard_rows(documents(messy[::-1]).repartition(7)).collect()
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_empty_table(documents):
    assert shard_rows(documents([])).count() == 0
