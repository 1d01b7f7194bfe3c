import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import repeats
from panelspark.llm.repeats import remove_repeats
from panelspark.llm.suffix import suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(s):
    assert suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=np.int64)
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p] += 1
                gone[p + window] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(i), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def same(documents, rows, window=200):
    got = remove_repeats(documents(rows), window).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == brute(rows, window)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def passages(seed, n):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdefgh é") for _ in range(k))
    pool = [text(rng.randint(150, 420)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 260))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            if rng.random() < 0.3:
                at = rng.randrange(len(p))
                p = p[:at] + "#" + p[at + 1 :]
            a = rng.randint(0, 30)
            parts += [p[a : len(p) - rng.randint(0, 30)], text(rng.randint(0, 120))]
        rows.append((i, "".join(parts)))
    return rows


def test_messy_rows(documents, messy):
    same(documents, messy)


@pytest.mark.parametrize("contents", [512, 1])
def test_passages(documents, monkeypatch, contents):
    """Also with the windows of every seed that has two contents regrouped, down to single ones."""
    monkeypatch.setattr(repeats, "CONTENTS", contents)
    same(documents, passages(contents, 60))


def test_small_segments_and_batches(documents, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 512)
    monkeypatch.setattr(repeats, "SORTED", 32)
    same(documents, passages(9, 40))


def test_periodic_text_and_borders(documents):
    rows = [(1, "ab" * 150), (2, "x" * 199), (3, "x" * 200), (4, "y" * 201), (5, "q" * 200), (6, "z" + "q" * 200), (7, "0123456789" * 45)]
    same(documents, rows)


@pytest.mark.parametrize("window", [40, 600, 1500])
def test_other_windows(documents, window):
    """Above 531 the length of a stretch takes more than ten bits, above 1,063 the seed's place may, too."""
    rng = random.Random(window)
    text = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    pool = [text(n) for n in (window - 1, window, window + 1, 2 * window, 3 * window)]
    same(documents, [(i, text(rng.randint(0, 900)) + rng.choice(pool) + text(rng.randint(0, 900))) for i in range(30)], window)


@pytest.mark.parametrize("window", [39, (1 << 19) + 1])
def test_windows_that_do_not_fit_raise(documents, window):
    with pytest.raises(ValueError, match="window"):
        remove_repeats(documents([(1, "a")]), window)


def test_empty_table(documents):
    assert remove_repeats(documents([])).count() == 0
