import random

import numpy as np

from panelspark.llm import components, jaccard
from panelspark.llm.jaccard import dedup_near, near_duplicates, signatures


def shingles(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        ids = [x for x in (least.get(find(i)), r[0]) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted((str(r[0]), len(s), str(least[find(i)])) for i, (r, s) in enumerate(zip(rows, sets)))


def same(documents, rows):
    got = near_duplicates(documents(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)


def edited(rng, words, rate, vocabulary):
    return [rng.choice(vocabulary) if rng.random() < rate else w for w in words]


def corpus(seed, bases, copies, vocabulary, lengths, rate, passage=0):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    shared = [rng.choice(vocab) for _ in range(passage)]
    rows = []
    for _ in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.choice(lengths))]
        for _ in range(copies):
            rows.append((len(rows), " ".join(shared + edited(rng, base, rng.choice(rate), vocab))))
    rng.shuffle(rows)
    return rows


def test_messy_rows(documents, messy):
    same(documents, messy)


def test_short_texts_of_few_words(documents):
    same(documents, corpus(1, 60, 4, 4, [1, 2, 4, 5, 6, 7, 8, 9, 10, 12], [0, 0.05]))


def test_near_copies_around_the_threshold(documents):
    same(documents, corpus(2, 25, 8, 5000, [8, 12, 20, 33, 40, 64, 100, 260, 600], [0, 0.01, 0.02, 0.03, 0.04]))


def test_passage_that_all_texts_share(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 3)
    same(documents, corpus(3, 40, 3, 5000, [6, 12, 24, 40, 60], [0, 0.03], passage=45))


def test_turns_do_not_list_the_members_of_hot_groups_again(documents, monkeypatch):
    """Turns that find links go on with a row for each component of a group, fewer than its members."""
    written = []

    def spy(df, name):
        got = scratch(df, name)
        written.append((name, got.count(), df.columns))
        return got

    scratch = jaccard.scratch
    monkeypatch.setattr(jaccard, "scratch", spy)
    monkeypatch.setattr(jaccard, "HOT", 3)
    same(documents, corpus(8, 2, 40, 5000, [200], [0.014, 0.018]))
    memberships = next(n for name, n, _ in written if name == "jaccard-hot")
    listed = [(name, n) for name, n, columns in written if "bucket" in columns and "component" in columns]
    assert len([name for name, _, _ in written if name == "jaccard-turned"]) > 1, "a turn has to find links"
    assert listed and all(n < memberships for _, n in listed), (memberships, listed)


def test_small_steps_shuffle_little(documents, monkeypatch):
    """Each shuffle has a task for each partition, however few its rows: contraction needs one a round, a turn two."""
    shuffles = {}

    def spy(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles.setdefault(name, []).append(plan.count("Exchange hashpartitioning"))
        return scratch(df, name)

    scratch = jaccard.scratch
    for module in (jaccard, components):
        monkeypatch.setattr(module, "scratch", spy)
    monkeypatch.setattr(jaccard, "HOT", 3)
    same(documents, corpus(8, 2, 40, 5000, [200], [0.014, 0.018]))
    assert set(shuffles["cc-step"]) == {1} and set(shuffles["cc-edges"]) == {0}, shuffles
    assert len(shuffles["jaccard-turned"]) > 1 and set(shuffles["jaccard-turned"]) == {2}, shuffles


def test_components_of_repeated_edges(spark, tmp_path):
    """Stars, chains, loops and edges that repeat, both ways round."""
    edges = [(5, k) for k in (1, 2, 7, 9)] + [(k, k + 1) for k in range(20, 60)] + [(70, 70), (71, 72), (72, 71), (71, 72)]
    spark.createDataFrame(edges * 3, "a long, b long").write.parquet(str(tmp_path / "edges"))
    got = components.connected_components(spark.read.parquet(str(tmp_path / "edges"))).collect()
    found = {}
    for r in got:
        found.setdefault(r.component, []).append(r.node)
    assert sorted(sorted(v) for v in found.values()) == [[1, 2, 5, 7, 9], list(range(20, 61)), [71, 72]]


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    got = near_duplicates(documents([(3, None), (4, ""), (5, " ")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(3, 0, 3), (4, 0, 4), (5, 0, 5)]


def test_rows_without_words_all_stay(documents):
    """Also those with equal id and text, which may differ elsewhere; a row with words that occurs twice stays once."""
    empty = [(None, None, "en", "a"), (None, None, "fr", "b"), (None, None, "fr", "b"), (7, "", "en", "a"), (7, "", "de", "c"), (8, " \n", "en", "a"), (8, " \n", "en", "b")]
    rows = [*empty, (1, "one two three", "en", "a"), (1, "one two three", "en", "a"), (2, "One  two three", "en", "b")]
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[3])
    got = dedup_near(documents(rows))
    assert sorted(key(r) for r in got.collect()) == sorted(map(key, [*empty, rows[-2]]))


def test_linked_sets_always_share_a_signature():
    rng = np.random.default_rng(5)
    for trial in range(400):
        n = int(rng.integers(1, 90))
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        drop = int(rng.integers(0, n // 4 + 1))
        y = x[drop:]
        extra = int(rng.integers(0, n // 3 + 1))
        y = np.concatenate([y, rng.integers(0, 2**63, extra).astype(np.uint64)])
        both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if not len(y) or 100 * both < 75 * union or both == union:
            continue
        h = np.concatenate([np.unique(x), np.unique(y)])
        sizes = np.array([len(np.unique(x)), len(np.unique(y))])
        found = list(signatures(h, np.repeat([0, 1], sizes), sizes))
        name, owner, marks = (np.concatenate(c) for c in zip(*found))
        whole = [set(name[(owner == k) & (marks & jaccard.DELETED == 0)].tolist()) for k in (0, 1)]
        every = [set(name[owner == k].tolist()) for k in (0, 1)]
        assert whole[0] & every[1] or whole[1] & every[0], (trial, sizes)
