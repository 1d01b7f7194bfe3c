"""Classifier, language identification and language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import langid, lm
from panelspark.llm.langid import identify
from panelspark.llm.lm import good_turing, score_texts
from panelspark.llm.quality import classify


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


def word_list(rng, alphabet, n):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_classifier_held_out_accuracy(spark, documents):
    rng = random.Random(3)
    vocab = word_list(rng, "abcdefghijkl", 300)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 120))]
        good = i % 3 > 0
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good), None))
    odd = [(1000, None), (1001, ""), (1002, " "), (None, "null id"), (5, rows[5][1]), (1003, "long " * 300_000)]
    frame = spark.createDataFrame(labels + [(None, 1, 0), (7, None, 0), (2000, 1, 0)], "doc_id long, quality int, toxic int")
    got = classify(documents(rows + odd), frame).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and fold(r.doc_id, 5) == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert np.mean([(r.score > 0.5) == (r.doc_id % 3 > 0) for r in held]) > 0.97
    again = {str(r.doc_id): r.score for r in classify(documents((rows + odd)[::-1]), frame).collect()}
    assert all(again[str(r.doc_id)] == pytest.approx(r.score, abs=1e-9) for r in got)


def test_classifier_without_labels(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in classify(documents([(1, "a"), (2, None)]), empty).collect()} == {0.5}
    assert classify(documents([]), empty).count() == 0
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in classify(documents([(1, "a"), (2, None)]), ones).collect())


def test_classifier_is_trained_in_a_task(spark, documents):
    """The driver gets the model only, the same as from the bags themselves, in any order of rows."""
    from panelspark.llm import quality
    from panelspark.llm.common import pick

    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ef", "gh"]) + "xy"[i % 2] for _ in range(30))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen, old = [], quality.train
    quality.train = lambda bags, *a, **k: seen.append(len(bags)) or old(bags, *a, **k)
    try:
        values, bias = quality.fit(documents(rows), labels, "true")
    finally:
        quality.train = old
    assert seen == []  # not called in this process
    again = quality.fit(documents(rows[::-1]), labels, "true")
    bags = pick(documents(rows), doc_id="doc_id", text="text").join(labels, "doc_id").select("text", "quality").mapInArrow(quality._bags, "label int, idx binary, weight binary").collect()
    want = quality.train(sorted((r.label, bytes(r.idx), bytes(r.weight)) for r in bags))
    assert np.allclose(values, want[0], atol=1e-5) and bias == pytest.approx(want[1], abs=1e-5)
    assert np.allclose(values, again[0], atol=1e-5) and values.dtype == np.float32 and len(values) == 1 << quality.BITS


def test_languages(documents):
    rng = random.Random(4)
    langs = {"xx": word_list(rng, "abcdefg", 200), "yy": word_list(rng, "efghijk", 200), "zz": word_list(rng, "ñéüabc", 200)}
    passage = " ".join(langs["xx"][:15])  # English-like passage in texts of every language
    rows = []
    for i in range(300):
        lang = ["xx", "yy", "zz"][i % 3]
        words = [rng.choice(langs[lang]) for _ in range(60)]
        rows.append((i, (passage + " " if i % 4 == 0 else "") + " ".join(words), lang))
    odd = [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 34 !!", "xx"), (1003, "abcd", None), (None, rows[1][1], "xx"), (1004, "q", "zz")]
    got = identify(documents(rows + odd)).collect()
    assert len(got) == 306
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and fold(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert np.mean([r.lang_pred == ["xx", "yy", "zz"][r.doc_id % 3] for r in held]) > 0.97
    assert by[None].lang_pred == "yy"


def test_short_texts_and_filter_size(documents):
    """One word or character is judged by shorter n-grams; the filter grows with the different n-grams."""
    rng = random.Random(5)
    langs = {"aa": word_list(rng, "abcd", 100), "el": word_list(rng, "αβγδ", 100), "zh": word_list(rng, "猫狗鳥魚", 100)}
    rows = [(i, " ".join(rng.choice(langs[k]) for _ in range(30)), k) for i, k in enumerate(["zh", "el", "el", "aa"] * 60)]
    short = [(1000, "猫", None), (1001, "β", None), (1002, "ab", None), (1003, "猫 \U0001f600", None), (1004, "д", None), (1005, "c", None)]
    by = {r.doc_id: r for r in identify(documents(rows + short)).collect()}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003, 1005)] == ["zh", "el", "aa", "zh", "aa"]
    assert by[1004].lang_pred in ("el", "zh", "aa") and 0 <= by[1004].score <= 1
    few = langid.fit(documents(rows), "true")
    many = langid.fit(documents([(i, "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(400)), "zh") for i in range(100)]), "true")
    assert few[0] == ["aa", "el", "zh"] and few[0][few[2]] == "el"
    assert len(many[1]) > 8 * len(few[1])
    assert all(np.unpackbits(m[1]).mean() < 0.32 for m in (few, many))


def test_languages_against_sets(documents, monkeypatch):
    """The filters return what sets of n-grams would, but for false positives; counts handed on in parts add up."""
    monkeypatch.setattr(langid, "POSITIONS_PER_GRAM", 4096)
    monkeypatch.setattr(langid, "HELD", 500)
    rng = random.Random(6)
    langs = {"xx": word_list(rng, "abcdefg", 120), "yy": word_list(rng, "efghijk", 120)}
    rows = [(i, " ".join(rng.choice(langs[k]) for _ in range(rng.randint(1, 40))), k) for i, k in enumerate(["xx", "yy"] * 100)]
    cut = lambda t: [t.encode()[j : j + 4] for j in range(len(t.encode()) - 3)]
    count = {k: Counter(g for i, t, lang in rows if lang == k and fold(i, 4) != 2 for g in cut(t)) for k in langs}
    rel = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in count.items()}
    keep = {k: {g for g, f in rel[k].items() if f >= langid.KEEP * max(rel[o].get(g, 0) for o in langs)} for k in langs}
    for r in identify(documents(rows)).collect():
        mine = cut(rows[r.doc_id][1])
        share = {k: sum(g in keep[k] for g in mine) / max(len(mine), 1) for k in langs}
        if max(share.values()) > 0:
            assert r.lang_pred == max(sorted(share), key=share.get)
            assert r.score == pytest.approx(max(share.values()) / sum(share.values()), abs=0.01)


def test_languages_without_learning(documents):
    assert {r.lang_pred for r in identify(documents([(1, "some text", None), (2, None, None)])).collect()} == {"und"}
    assert identify(documents([])).count() == 0


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute_katz(rows, vocabulary):
    """Scores of the model as its docstring states them, with plain dictionaries."""
    train = [tokens(t) for i, t in rows if i is not None and fold(i, 7) != 2]
    count = Counter(w for t in train for w in t)
    ends = len(train)
    total, distinct = sum(count.values()) + ends, len(count) + (ends > 0)
    norm = total + distinct + 1
    hashes = {w: int(lm.Words()(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w.encode())]))[0][0]) for w in count}
    signed = lambda w: hashes[w] - 2**64 if hashes[w] >= 2**63 else hashes[w]
    top = set(sorted(count, key=lambda w: (-count[w], signed(w)))[:vocabulary])
    symbol = lambda w: w if w in top else "<unk>"
    unigram = {w: (count[w] + 1) / norm for w in top}
    unigram["</s>"] = (ends + 1) / norm
    rest = norm - sum(count[w] + 1 for w in top) - (ends + 1) if ends else 1
    unigram["<unk>"] = rest / norm
    pairs = Counter()
    for t in train:
        s = ["<s>", *map(symbol, t), "</s>"]
        pairs.update(zip(s, s[1:]))
    ratios = good_turing(Counter(pairs.values()))
    d = lambda c: c * ratios[c] if c < len(ratios) else c
    context = {}
    for (a, b), c in pairs.items():
        n, kept, seen, types = context.get(a, (0, 0.0, 0.0, 0))
        context[a] = n + c, kept + d(c), seen + unigram[b], types + 1
    prob = {}
    for a, (n, kept, seen, types) in context.items():
        if types == len(unigram):
            base, alpha = kept, 0.0
        else:
            base = max(n, kept * (n + 1) / n)
            alpha = (1 - kept / base) / (1 - seen)
        prob[a] = {b: d(pairs[a, b]) / base if (a, b) in pairs else alpha * unigram[b] for b in unigram}
    out = []
    for i, t in rows:
        w = tokens(t)
        s = ["<s>", *map(symbol, w), "</s>"]
        score = sum(math.log10(prob[a][b] if a in prob else unigram[b]) for a, b in zip(s, s[1:]))
        score += sum(math.log10((count[x] + 1) / rest) for x in w if symbol(x) == "<unk>")
        base = sum(math.log10((count[x] + 1) / norm) for x in w) + math.log10((ends + 1) / norm)
        known = sum(count[x] > 0 for x in w) + (ends > 0)
        held = i is not None and fold(i, 7) == 2
        out.append((str(i), held, len(w) + 1, known, total, base, score))
    return sorted(out), prob


@pytest.mark.parametrize("vocabulary", [40, lm.VOCABULARY])
def test_katz_equals_brute_force(documents, messy, monkeypatch, vocabulary):
    monkeypatch.setattr(lm, "HOT_BIGRAMS", 16)
    want, prob = brute_katz(messy, vocabulary)
    for p in prob.values():
        assert sum(p.values()) == pytest.approx(1, abs=1e-9)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in score_texts(documents(messy), vocabulary=vocabulary).collect())
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6), (a, b)


@pytest.mark.parametrize("vocabulary", [40, None])
def test_katz_with_cold_words_equals_brute_force(documents, messy, monkeypatch, vocabulary):
    monkeypatch.setattr(lm, "HOT_BIGRAMS", 16)
    monkeypatch.setattr(lm, "HOT_WORDS", 12)
    rng = random.Random(3)
    rows = messy + [(100 + i, " ".join(rng.choice(["ab", "ca", "new", "odd"]) + str(rng.randrange(40)) for _ in range(30))) for i in range(30)]
    want, _ = brute_katz(rows, vocabulary)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in score_texts(documents(rows), vocabulary=vocabulary).collect())
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6), (a, b)


def test_katz_tells_all_words_apart(documents):
    """70,000 words, more than 16 bits can number; all but the last 5,000 occur twice, and those are followed by one word each."""
    ids = [i for i in range(400) if fold(i, 7) != 2][:270]
    held = next(i for i in range(400) if fold(i, 7) == 2)
    rows = [(i, " ".join(f"w{n * 500 + j}" for j in range(500))) for n, i in zip([*range(140), *range(130)], ids)]
    score = lambda text: next(r.score for r in score_texts(documents([*rows, (held, text)])).collect() if r.held_out)
    # equal words in the order of training and in another: only the bigrams differ
    straight, swapped = (score(" ".join(f"w{k}" for k in o)) for o in (range(69_100, 69_300), [*range(69_101, 69_300, 2), *range(69_100, 69_300, 2)]))
    assert straight > swapped + 200


def test_katz_beats_its_base_on_held_out_text(documents):
    rng = random.Random(8)
    follow = {w: [rng.randrange(300) for _ in range(4)] for w in range(300)}
    rows = []
    for i in range(500):
        w, out = rng.randrange(300), []
        for _ in range(60):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(out)))
    got = [r for r in score_texts(documents(rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.6 * sum(r.base_score for r in got)


def test_katz_without_training_text(documents):
    assert score_texts(documents([])).count() == 0
    held = next(i for i in range(100) if fold(i, 7) == 2)
    r = score_texts(documents([(held, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_good_turing():
    d = good_turing({1: 1000, 2: 300, 3: 140, 4: 80, 5: 50, 6: 35}, 5)
    common = 6 * 35 / 1000
    assert d[1] == pytest.approx((2 * 300 / 1000 - common) / (1 - common))
    assert ((d[1:] > 0) & (d[1:] <= 1)).all()
    assert (good_turing({}, 5)[1:] == [0.5, 0.75, 5 / 6, 7 / 8, 0.9]).all()
