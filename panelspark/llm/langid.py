"""Language identification by language-bitmask n-gram filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import bucket, gram_spans, grams, lower_table, text_blocks
from .common import pick, scratch

GRAM = 4
#: Positions of a filter for each n-gram of the language that holds most, at least.
POSITIONS_PER_GRAM = 8
HASHES = 3
KEEP = 0.34  # share of an n-gram's highest relative frequency that a language must reach
#: Different n-grams that a task holds before it hands its counts on.
HELD = 1 << 21


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): occurrences of n-grams of ``GRAM`` bytes in the rows of a task, some in several parts."""
    lower = lower_table()
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        gram, where = np.unique(np.concatenate([g for g, _ in held[lang]]), return_inverse=True)
        return gram, np.bincount(where, np.concatenate([n for _, n in held[lang]]), minlength=len(gram)).astype(np.int64)

    def emit() -> Iterator[pa.RecordBatch]:
        for lang in list(held):
            gram, n = merged(lang)
            del held[lang]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(gram), type=pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
            )

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lo, hi, data, offsets in text_blocks(batch.column(0)):
            h = grams(lower[data], GRAM).astype(np.uint32)
            first, last = gram_spans(offsets, GRAM)
            rows: dict[str, list[int]] = {}
            for i in range(lo, hi):
                rows.setdefault(langs[i], []).append(i - lo)
            for lang, mine in rows.items():
                part = np.unique(np.concatenate([h[min(first[i], len(h)) : last[i]] for i in mine]), return_counts=True)
                held.setdefault(lang, []).append(part)
                size += len(part[0])
            if size > HELD:
                for lang in held:
                    held[lang] = [merged(lang)]
                size = sum(len(g) for parts in held.values() for g, _ in parts)
                if size > HELD // 2:
                    yield from emit()
                    size = 0
    yield from emit()


def _places(key: np.ndarray, positions: int) -> list[np.ndarray]:
    """The filter positions of n-grams, given as the number of their bytes and their length above 32 bits."""
    g = key.astype(np.uint64)
    bits = positions.bit_length() - 1
    return [bucket(g, bits, 11 + k).astype(np.int64) for k in range(HASHES)]


def fit(docs: DataFrame, learn: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, int]:
    """(languages, filter, the most frequent language) from all rows for which the SQL condition ``learn`` on ``id`` holds.

    The filter is an array of positions by bytes; bit l of a position is the
    position's bit in the Bloom filter of language l. A language's filter
    holds the n-grams whose relative frequency in it is at least ``KEEP``
    times the highest in any language, so passages in a foreign language do
    not carry their n-grams over. N-grams of ``GRAM`` bytes are counted, each
    under its own bytes; shorter ones are their beginnings. Null languages
    and ids are left out.

    Counts are summed by Spark. The number of positions is the power of two
    from ``POSITIONS_PER_GRAM`` for each n-gram of the language that holds
    most, so the filter grows with the different n-grams of the corpus, not
    with its size. The driver gets the filter's set positions.
    """
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col).filter(f"lang is not null and text is not null and ({learn})")
    counted = rows.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
    whole = scratch(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-counts")
    totals = {r["lang"]: r["n"] for r in whole.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return langs, np.zeros((1, 1), dtype=np.uint8), 0
    lengths = F.explode(F.array(*[F.expr(f"(gram & {(1 << 8 * k) - 1}L) | {k << 32}L") for k in range(1, GRAM + 1)]))
    counts = whole.select("lang", lengths.alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    known = docs.sparkSession.createDataFrame([(k, float(totals[k]), i) for i, k in enumerate(langs)], "lang string, total double, nr int")
    share = scratch(counts.join(F.broadcast(known), "lang").withColumn("rel", F.col("n") / F.col("total")), "lang-shares")
    best = share.groupBy("gram").agg(F.max("rel").alias("best"))
    kept = scratch(share.join(best, "gram").filter(F.col("rel") >= F.col("best") * KEEP).select("gram", "nr"), "lang-grams")
    most = max(r["count"] for r in kept.groupBy("nr").count().collect())
    positions = 1 << max(10, (POSITIONS_PER_GRAM * most - 1).bit_length())
    filled = np.zeros((positions, -(-len(langs) // 8)), dtype=np.uint8)

    @F.pandas_udf("array<long>")
    def places(gram):
        import pandas as pd

        return pd.Series(list(np.stack(_places(gram.to_numpy(), positions), axis=1)))

    per_gram = kept.groupBy("gram", F.expr("cast(nr div 8 as int)").alias("byte")).agg(
        F.expr("bit_or(shiftleft(1, nr % 8))").alias("mask")
    )
    slots = per_gram.select(F.explode(places("gram")).alias("place"), "byte", "mask").groupBy("place", "byte").agg(F.bit_or("mask").alias("mask"))
    found = slots.select(F.col("place").cast("int"), F.col("byte").cast("short"), F.col("mask").cast("short")).toArrow()
    place, byte, mask = (found.column(c).to_numpy() for c in ("place", "byte", "mask"))
    filled[place, byte] = mask.astype(np.uint8)
    return langs, filled, max(range(len(langs)), key=lambda i: (totals[langs[i]], -i))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row.

    Each n-gram of a text returns the mask of all languages that may hold
    it: the AND of its positions. A language's popcount, as a share of the
    n-grams and corrected for the rate at which its filter returns absent
    n-grams, is its strength; the strongest wins (ties: first in the
    alphabet) and its share of all strengths is the score. Texts that are
    null or hold no letter, and all texts if nothing was learned, are
    ``und`` with score 0. Texts without a known n-gram of ``GRAM`` bytes, as
    those too short for one, are judged by the n-grams of one byte less, and
    so on; if none is known they get the most frequent language with score 0.
    """
    langs, filled, common = model
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    per_bit = np.concatenate([np.bincount(filled[:, w], minlength=256) @ bits for w in range(filled.shape[1])])[: len(langs)]
    false_rate = (per_bit / len(filled)) ** HASHES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = lower_table()
        names = np.array([*langs, "und"], dtype=object)
        planes = [np.ascontiguousarray(filled[:, w]) for w in range(filled.shape[1])]

        def strengths(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
            first, last = gram_spans(offsets, n)
            size, texts = last - first, len(offsets) - 1
            owner = np.repeat(np.arange(texts), size)
            at = np.arange(len(owner)) + np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            places = _places(grams(data, n)[at] | np.uint64(n << 32), len(filled))
            hits = np.zeros((texts, len(langs)))
            for w, plane in enumerate(planes):
                mask = plane[places[0]]
                for p in places[1:]:
                    mask &= plane[p]
                table = np.bincount(owner * 256 + mask, minlength=256 * texts).reshape(-1, 256)
                hits[:, 8 * w : 8 * w + 8] = (table @ bits)[:, : len(langs) - 8 * w]
            share = (hits / np.maximum(size, 1)[:, None] - false_rate) / np.maximum(1 - false_rate, 1e-9)
            return np.maximum(share, 0)

        for batch in batches:
            winner = np.full(batch.num_rows, len(langs))
            score = np.zeros(batch.num_rows)
            for lo, hi, data, offsets in text_blocks(batch.column(1)) if langs else ():
                data = lower[data]
                share = strengths(data, offsets, GRAM)
                for n in range(GRAM - 1, 0, -1):
                    open_ = np.flatnonzero((share.max(axis=1) <= 0) & (np.diff(offsets) > 0))
                    if not len(open_):
                        break
                    texts = [data[offsets[i] : offsets[i + 1]] for i in open_]
                    share[open_] = strengths(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), n)
                top = share.max(axis=1)
                winner[lo:hi] = np.where(top > 0, share.argmax(axis=1), common)
                score[lo:hi] = top / np.maximum(share.sum(axis=1), 1e-300)
            lettered = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), dtype=bool)
            winner[~lettered] = len(langs)
            score[~lettered] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[winner].tolist(), type=pa.string()), pa.array(np.clip(score, 0, 1))],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = pick(docs, id=id_col, text=text_col).withColumn("lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from ids whose crc32 modulo ``folds`` is not ``held_out``.

    Rows with a null id are not held out and never learned from.
    """
    model = fit(docs, f"crc32(cast(id as string)) % {folds} != {held_out}")
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return predict(docs, model).select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
