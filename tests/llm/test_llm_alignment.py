import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelspark.llm import alignment
from panelspark.llm.alignment import align, byte_level_alphabet, overlaps, token_overlaps
from panelspark.llm.queries import op12_cross_tokenizer_alignment


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def tokens(sides, text):
    """[(id, bytes)] of either side, none where the bytes differ from space + text."""
    a, b = sides
    if not text:
        return [], []
    alphabet = byte_level_alphabet()
    e = a.encode(" " + text, add_special_tokens=False)
    xs = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    ys = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        ys.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (xs, ys) if b"".join(t for _, t in xs) == whole == b"".join(t for _, t in ys) else ([], [])


def spans(side):
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(sides, rows):
    """Per row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), by comparing all pairs of tokens."""
    per, counts = [], Counter()
    for r in rows:
        xs, ys = map(spans, tokens(sides, r[1]))
        links = [(i, j) for i, _, e in xs for j, _, f in ys if e == f]
        counts.update(links)
        ends = sorted({e for _, _, e in xs} & {f for _, _, f in ys})
        groups, low = [], 0
        for end in ends:
            pick = lambda side: ",".join(str(i) for i, s, e in side if low <= s and e <= end)  # noqa: B023, E731
            groups.append(f"{pick(xs)}|{pick(ys)}")
            low = end
        per.append((r[0], len(xs), len(ys), links, ";".join(groups)))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(d, a, b, len(g.split(";")) if g else 0, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), g) for d, a, b, ls, g in per]


ODD = ["▁under ▁", "naïve 猫 tail", "tab\there\nand \n lines", "  two  spaces  ", "<s> </s> <unk> <0x41> <|endoftext|>", " nbsp　wide", "emoji 👩‍👩‍👧 ok", "a\x00b", "word " * 5 + "▁"]


def test_equals_brute_force(spark, documents, messy, sides, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_BYTES", 700)  # several documents and single ones at a time
    rows = messy + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, ODD[1] + " the same words again") for i in range(30)]
    got = [tuple(r) for r in align(documents(rows)).collect()]
    key = lambda r: tuple((x is None, x) for x in map(str, r))
    assert sorted(got, key=key) == sorted(brute(sides, rows), key=key)
    none = {r[0] for r in got if r[1] == 0}
    assert {30, 31, 32, 100, 108} <= none  # null, empty, and the piece mark itself


def test_small_memory_of_words_gives_the_same(spark, documents, messy, sides, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "REMEMBERED_LENGTH", 4)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 100)
    ids = alignment.token_ids("byte_bpe_50k.json", "piece_bpe_32k.model")
    for _, text in messy + [(0, t) for t in ODD]:
        for _ in range(2):
            got = [np.frombuffer(x, dtype="<u4").tolist() for x in ids([text])[0]]
            assert got == [[i for i, _ in side] for side in tokens(sides, text)]


def test_overlaps_of_all_pairs(spark, documents, messy, sides):
    rows = [r for r in messy if r[0] is not None and r[0] in (10, 21, 35, 37, 43, 50)] + [(100 + i, t) for i, t in enumerate(ODD)]
    want = set()
    for d, text in rows:
        xs, ys = map(spans, tokens(sides, text))
        want |= {(d, i, j, *x, *y) for i, x in enumerate(xs) for j, y in enumerate(ys) if x[1] < y[2] and y[1] < x[2]}
    got = [(r["doc_id"], r["a_index"], r["b_index"], r["a_id"], r["a_start"], r["a_end"], r["b_id"], r["b_start"], r["b_end"]) for r in token_overlaps(documents(rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_overlaps_are_keyed_by_document():
    zero = np.zeros(0, dtype=np.int64)
    assert [x.tolist() for x in overlaps(zero, zero, zero, zero)] == [[], []]
    i, j = overlaps(np.array([0, 0, 2]), np.array([0, 3, 5]), np.array([0, 0, 2, 2]), np.array([0, 2, 5, 6]))
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3)]


def test_empty_table(spark, documents):
    assert align(documents([(1, None)]).limit(0)).count() == 0
    assert [tuple(r) for r in align(documents([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_query_on_a_fixture(spark, documents, messy, sides, tmp_path):
    rows = messy + [(100 + i, t) for i, t in enumerate(ODD)]
    spark.createDataFrame([(r[0], r[1], "en") for r in rows], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_cross_tokenizer_alignment(spark, str(tmp_path)).collect()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(sides, rows)]
    key = lambda r: tuple((x is None, x) for x in map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
