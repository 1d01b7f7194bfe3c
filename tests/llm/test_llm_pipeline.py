"""The corpus pipeline's stages against brute force, each on its own input."""

import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows, labels = [], []

    def add(text, good, source):
        rows.append((len(rows), text, "en", source, len(text)))
        labels.append((len(labels), int(good), 0))

    for i in range(150):
        source = "big" if i % 3 else f"s{i % 4}"
        words = say(rng.randint(20, 150))
        add(" ".join(words), True, source)
        if i % 10 == 0:
            for k in range(3):
                add(" \n".join(words), True, source)  # equal without white space
                add(" ".join([*words[: len(words) - 1], f"new{k}"]), True, source)  # a near copy
        if i % 4 == 0:
            add(" ".join(w.upper() + "!!" for w in say(40)), False, source)
    rows += [(len(rows), None, None, None, None), (len(rows) + 1, "", "en", "big", 0)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stages, docs = [rows], spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/out/{k}")
        docs = spark.read.parquet(f"{folder}/out/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        stages.append([tuple(r) for r in docs.collect()])
    return str(folder), stages, dict((i, q) for i, q, _ in labels), docs


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]


def test_quality_stage(corpus):
    _, stages, labels, _ = corpus
    kept = {r[0] for r in stages[1]}
    assert all((i in kept) == bool(q) for i, q in labels.items())
    assert set(stages[1]) <= set(stages[0])


def test_exact_stage(corpus):
    _, stages, _, _ = corpus
    best = {}
    for r in stages[1]:
        k = re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "")
        if k not in best or (-len(r[1] or ""), r[0]) < (-len(best[k][1] or ""), best[k][0]):
            best[k] = r
    assert Counter(stages[2]) == Counter(best.values())


def test_near_stage(corpus):
    _, stages, _, _ = corpus
    rows = stages[2]
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in sorted(zip(group, rows), key=lambda x: x[1][0]):
        least.setdefault(g, r)
    assert Counter(stages[3]) == Counter(least.values()) and len(least) < len(rows)


def test_mixing_stage(corpus):
    _, stages, _, _ = corpus
    before, after = Counter(stages[3]), Counter(stages[4])
    assert set(before) == set(after)  # every row at least once
    assert max(after.values()) <= 2
    words = defaultdict(int)
    for r in stages[3]:
        words[r[3]] += len((r[1] or "").split())
    biggest = max(words, key=words.get)
    assert all(after[r] == 1 for r in after if r[3] == biggest)
    assert len(stages[4]) > len(stages[3])


def test_packing_stage(corpus):
    _, stages, _, docs = corpus
    got = docs.collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r[0] for r in stages[4])
    ends = defaultdict(list)
    for r in got:
        assert len(r.ids) == 2 * r.length
        ends[r.sequence_id].append((r.offset, r.length))
    for places in ends.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024


def test_run(spark, corpus):
    folder, stages, _, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.piece, r.length) for r in got.collect()) == Counter((r[0], r[1], r[3]) for r in stages[5])
