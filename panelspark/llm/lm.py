"""Katz backoff language model over words: Good-Turing discounts, exactly normalised backoff weights.

Counts and occurrences travel as packed rows (see packed.py), partitioned by
word or bigram. The most frequent words have 16-bit symbols that every task
knows; any other word is its 64-bit hash. A bigram with such a word is kept
where the word's own count or, as a context, its backoff weight is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytes_ import Words, mix, text_blocks
from .common import pick, scratch
from .packed import PACKED, packed_rows, part_of, split, unpack

UNKNOWN, END, BEGIN, COLD, FIRST_WORD = 0, 1, 2, 3, 4
#: Words that the model tells apart: all.
VOCABULARY = None
#: Most frequent words that every task gets, as many as fit 16 bits. The others are COLD: known by their hashes only.
HOT_WORDS = (1 << 16) - FIRST_WORD
#: Symbols below this are hot; others are hashes.
HASHES = 1 << 16
#: Most frequent bigrams that every task gets, so that no key is hot in the shuffle.
HOT_BIGRAMS = 1 << 16
#: Good-Turing discounts apply to counts up to this.
DISCOUNTED = 5
#: Distinct entries that a task gathers before it sends them on.
GATHERED = 1 << 20


def _planes(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, first bytes of the entries first, second bytes next, so small or ascending entries compress to what they hold."""
    raw = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _arrays(raw: bytes | np.ndarray, n: int, dtype: type) -> np.ndarray:
    """The n arrays of equal length and one type in such bytes."""
    raw = bytes(raw)
    raw = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(n, np.dtype(dtype).itemsize, -1).transpose(0, 2, 1).copy().reshape(n, -1).view(dtype)


@contextmanager
def _single_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand Python one packed row at a time, each of which is large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class _Tally:
    """Counts of 64-bit keys, sent on as packed rows whenever GATHERED are held."""

    def __init__(self, kind: int, parts: int):
        self.kind, self.parts, self.held, self.size = kind, parts, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.held.append((keys, counts))
        self.size += len(keys)
        if self.size >= GATHERED:
            before = self.size
            self._merge()
            if self.size > before // 2:
                yield from self.flush()

    def _merge(self) -> None:
        if self.held:
            self.held = [_sum_by_key(np.concatenate([k for k, _ in self.held]), np.concatenate([c for _, c in self.held]))]
            self.size = len(self.held[0][0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        if self.held and self.size:
            keys, counts = self.held[0]
            yield packed_rows(
                [(p, self.kind, 0, _planes(keys[at]), _planes(counts[at].astype(np.int64))) for p, at in split(part_of(keys, self.parts), self.parts)]
            )
        self.held, self.size = [], 0


class _PairTally:
    """Counts of bigrams with a cold word, sent on to the partition of the word (kind 7) and of the context (kind 8) that is cold."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size = parts, [], 0

    def add(self, context: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(_sum_pairs(context, word, np.ones(len(word), np.int64)))
        self.size += len(self.held[-1][0])
        if self.size >= GATHERED // 2:
            before = self.size
            self._merge()
            if self.size > before // 2:
                yield from self.flush()

    def _merge(self) -> None:
        if self.held:
            self.held = [_sum_pairs(*(np.concatenate(x) for x in zip(*self.held)))]
            self.size = len(self.held[0][0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        if self.held and self.size:
            context, word, counts = self.held[0]
            yield packed_rows(
                [(p, kind, 0, _planes(context[at], word[at]), _planes(counts[at])) for kind, p, at in _sides(context, word, self.parts)]
            )
        self.held, self.size = [], 0


def _sides(context: np.ndarray, word: np.ndarray, parts: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(kind, partition, positions by ascending cold symbol): bigrams whose word is cold by word (7), whose context is cold by context (8); with both, twice."""
    for kind, symbol in ((7, word), (8, context)):
        cold = np.flatnonzero(symbol >= HASHES)
        cold = cold[np.argsort(symbol[cold], kind="stable")]
        for p, at in split(part_of(symbol[cold], parts), parts):
            yield kind, p, cold[at]


def _pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _sum_pairs(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bigrams, by ascending key, and their counts."""
    if not len(word):
        return context, word, counts
    keys = _pair_keys(context, word)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return context[order][first], word[order][first], np.add.reduceat(counts[order], first)


def _merged_pairs(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [(*_arrays(a, 2, np.uint64), _arrays(b, 1, np.int64)[0]) for _, a, b in unpack(table, kind, (np.uint8, np.uint8))]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _sum_pairs(*(np.concatenate(x) for x in zip(*found)))


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _merged(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    found = [(_arrays(a, 1, np.uint64)[0], _arrays(b, 1, np.int64)[0]) for _, a, b in unpack(table, kind, (np.uint8, np.uint8))]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _sum_by_key(*(np.concatenate(x) for x in zip(*found)))


def _count_table(packed: DataFrame, name: str) -> DataFrame:
    """Packed counts merged to one row per partition, keys ascending, stored."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        keys, counts = _merged(table, kind)
        return pa.Table.from_batches([packed_rows([(key[0].as_py(), kind, 0, _planes(keys), _planes(counts))])])

    return scratch(packed.groupBy("part").applyInArrow(merge, PACKED), name)


def _most_frequent(table: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n most frequent keys (ties: smaller key first) and their counts, sorted by key."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                keys, counts = _arrays(a.as_py(), 1, np.uint64)[0], _arrays(b.as_py(), 1, np.int64)[0]
                at = np.argsort(-counts, kind="stable")[:n]  # keys ascend
                yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(counts[at])], names=["key", "n"])

    rows = table.select("a", "b").mapInArrow(local, "key long, n long")
    with _single_rows(table.sparkSession):
        best = rows.orderBy(F.col("n").desc(), F.col("key")).limit(n).toArrow()
    keys = np.asarray(best["key"].to_numpy()).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.asarray(best["n"].to_numpy())[order]


def _lookup(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray, absent) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), absent, dtype=values.dtype)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], absent)


def good_turing(counts_of_counts: dict[int, int], k: int = DISCOUNTED) -> np.ndarray:
    """Katz's discount ratio of each count 0..k (index 0 unused; above k counts stand).

    d_r = (r* / r - c) / (1 - c) with r* = (r + 1) n_(r+1) / n_r and
    c = (k + 1) n_(k+1) / n_1. A ratio that the counts of counts leave
    undefined or outside (0, 1) is (r - 1/2) / r.
    """
    n = [counts_of_counts.get(r, 0) for r in range(k + 2)]
    out = np.ones(k + 1)
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _discounted(counts: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    small = counts < len(ratios)
    return np.where(small, ratios[np.where(small, counts, 0)], 1.0) * counts


class Katz:
    """What every task needs: the hot words, their unigrams and contexts."""

    def __init__(self, words: np.ndarray, word_counts: np.ndarray, end_count: int, total: int, distinct: int, vocabulary: int | None):
        order = np.lexsort((words.view(np.int64), -word_counts))
        hot = np.sort(order[:HOT_WORDS])
        #: with a vocabulary, hashes of all its words, ascending; else all words belong
        self.allowed = None if vocabulary is None else words
        self.norm = float(total + distinct + 1)
        # add-one mass of all words outside the vocabulary, the unseen one included
        closed = vocabulary is not None and end_count
        self.unknown_mass = self.norm - float(word_counts.sum() + len(words)) - (end_count + 1.0) if closed else 1.0
        # the symbols that can follow a context: the words, END and UNKNOWN
        self.types = (max(distinct - 1, 0) if vocabulary is None else len(words)) + 2
        self.words = words[hot]  # hashes, ascending; the symbol of words[i] is FIRST_WORD + i
        plus = np.zeros(FIRST_WORD + len(self.words))
        plus[FIRST_WORD:] = word_counts[hot] + 1.0
        plus[END] = end_count + 1.0
        plus[UNKNOWN] = self.unknown_mass
        self.plus = plus
        with np.errstate(divide="ignore"):
            self.unigram_log = np.log10(plus / self.norm)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        symbol = _lookup(self.words, np.arange(FIRST_WORD, FIRST_WORD + len(self.words)), hashes, COLD)
        if self.allowed is not None:
            symbol[(symbol == COLD) & ~_lookup(self.allowed, np.ones(len(self.allowed), bool), hashes, False)] = UNKNOWN
        return symbol

    def weights(self, count: np.ndarray, kept: np.ndarray, plus: np.ndarray, types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the denominator and of the backoff weight of contexts.

        Of each context: count, discounted count, add-one mass and number of
        the symbols seen after it. A context leaves what its discounts took,
        and at least one part in count + 1, to unseen words; dividing by
        their unigram mass makes its probabilities sum to 1.
        """
        open_ = types < self.types  # else every symbol was seen, and none is left to back off to
        # the denominator of a context: its count; more where the discounts took less than one part
        below = np.where(open_, np.maximum(count, kept * (count + 1) / count), kept)
        left = np.where(open_, 1 - kept / below, 0.0)
        with np.errstate(divide="ignore"):
            return np.log10(below), np.log10(left * self.norm / np.maximum(self.norm - plus, 1.0))

    def contexts(self, at: np.ndarray, sums: np.ndarray, ratios: np.ndarray) -> None:
        """Hot contexts and their sums (see weights); a context that was never seen backs off at no cost."""
        self.ratios = ratios
        self.context_log, self.backoff_log = np.zeros((2, len(self.plus)))
        self.context_log[at], self.backoff_log[at] = self.weights(*sums)

    def count_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(_discounted(counts, self.ratios))

    def seen_log(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.count_log(counts) - self.context_log[(keys >> np.uint64(16)).astype(np.int64)]

    def unseen_log(self, keys: np.ndarray) -> np.ndarray:
        context, word = (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(0xFFFF)).astype(np.int64)
        return self.backoff_log[context] + self.unigram_log[word]


def _learned(folds: int, held_out: int):
    fold = F.crc32(F.col("id").cast("string")) % folds
    return F.col("id").isNotNull() & (fold != held_out), F.coalesce(fold == held_out, F.lit(False))


def score_texts(
    docs: DataFrame, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = VOCABULARY, parts: int | None = None
) -> DataFrame:
    """log10 probability of every text under a bigram Katz model learned from the rows not held out.

    A-Z are lower-cased; tokens are the words of the text, then one end
    token. Rows are held out whose crc32 (of the id as text) modulo
    ``folds`` is ``held_out``; rows with a null id are neither held out nor
    learned from. Null and empty texts have the end token only. Returns
    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Unigrams are add-one: (c + 1) / (N + V + 1). Every word is a symbol of
    its own; unseen ones share one. With a ``vocabulary``, only its most
    frequent words are; the others, unseen ones included, share one, within
    which a word has its share of their add-one counts. Either way every
    word keeps its own exact count, and the base score is the same without
    the model. A bigram seen in training has its Good-Turing
    discounted share of its context; another word has the context's backoff
    weight times its unigram probability, and after an unseen context its
    unigram probability.

    The driver holds the ``HOT_WORDS`` most frequent words (a given
    ``vocabulary`` whole), their rows as contexts and the ``HOT_BIGRAMS``
    most frequent bigrams of them; all other words, contexts and counts stay
    in ``parts`` (default: twice the session's shuffle partitions)
    partitioned tables. The texts are read twice.
    """
    spark = docs.sparkSession
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pick(docs, id=id_col, text=text_col)
    learned, held = _learned(folds, held_out)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tally = Words(), _Tally(0, parts)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                yield from tally.add(words(data, offsets)[0])
        yield from tally.flush()

    unigrams = _count_table(rows.filter(learned).select("text").mapInArrow(count_words, PACKED), "lm-words")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0):
                n = _arrays(b.as_py(), 1, np.int64)[0]
                yield pa.RecordBatch.from_arrays([pa.array([len(n)]), pa.array([int(n.sum())])], names=["types", "tokens"])

    size = unigrams.select("b").mapInArrow(sizes, "types long, tokens long").agg(F.sum("types"), F.sum("tokens")).first()
    texts = rows.filter(learned).count()
    total, distinct = (size[1] or 0) + texts, (size[0] or 0) + (texts > 0)
    model = Katz(*_most_frequent(unigrams, HOT_WORDS if vocabulary is None else vocabulary), texts, total, distinct, vocabulary)

    def to_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        row = TaskContext.get().partitionId() << 33
        logs = np.log10(np.maximum(model.plus, 1.0) / model.norm)
        logs[[UNKNOWN, COLD]] = 0.0
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                hashes, upto = words(data, offsets)
                n = np.diff(upto)
                symbol = model.symbols(hashes)
                ends = upto[1:] + np.arange(hi - lo)  # places of the end tokens
                tokens = np.insert(symbol, upto[1:], END)
                value = np.concatenate([[0.0], np.cumsum(logs[tokens])])
                known = np.concatenate([[0], np.cumsum((tokens >= FIRST_WORD) | ((tokens == END) & (texts > 0)))])
                first = ends - n
                rest = (symbol == UNKNOWN) | (symbol == COLD)
                tail, tail_upto = hashes[rest], np.concatenate([[0], np.cumsum(rest)])[upto]
                raw = tokens.astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + hi - lo)),
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        batch.column(3).slice(lo, hi - lo),
                        pa.array(n + 1),
                        pa.array(known[ends + 1] - known[first]),
                        pa.array(value[ends + 1] - value[first]),
                        pa.array([raw[s : e + 1].tobytes() for s, e in zip(first, ends)], type=pa.binary()),
                        pa.array([tail[s:e].tobytes() for s, e in zip(tail_upto[:-1], tail_upto[1:])], type=pa.binary()),
                    ],
                    names=["row", "id", "learned", "held", "n_tokens", "known", "base", "symbols", "tail"],
                )
                row += hi - lo

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {id_type}, learned boolean, held boolean, n_tokens long, known long, base double, symbols binary, tail binary"
    marked = rows.select("id", "text", F.coalesce(learned, F.lit(False)).alias("learned"), held.alias("held"))
    tokens = scratch(marked.mapInArrow(to_symbols, schema), "lm-tokens")

    def bigrams(symbols: pa.Array, tails: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context, word and text of all bigrams of a batch; hashes and texts of the words that share UNKNOWN."""
        text = [np.frombuffer(s.as_py(), np.uint16) for s in symbols]
        flat = np.concatenate(text).astype(np.uint64) if text else np.zeros(0, np.uint64)
        n = np.array([len(t) for t in text], dtype=np.int64)
        of = np.repeat(np.arange(len(n)), n)
        at = np.flatnonzero((flat == UNKNOWN) | (flat == COLD))
        tail = np.frombuffer(b"".join(t.as_py() for t in tails), np.uint64)
        cold = flat[at] == COLD
        flat[at[cold]] = tail[cold]
        context = np.empty_like(flat)
        context[1:] = flat[:-1]
        context[np.cumsum(n) - n] = BEGIN
        return context, flat, of, tail[~cold], of[at[~cold]]

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, batch.num_rows, 1024):
            yield batch.slice(lo, 1024)

    def count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, pairs = _Tally(1, parts), _PairTally(parts)
        for batch in batches:
            for piece in slices(batch):
                context, word, *_ = bigrams(piece.column(0), piece.column(1))
                hot = (context < HASHES) & (word < HASHES)
                yield from tally.add((context[hot] << np.uint64(16)) | word[hot])
                yield from pairs.add(context[~hot], word[~hot])
        yield from tally.flush()
        yield from pairs.flush()

    def merge_bigrams(key: tuple, table: pa.Table) -> pa.Table:
        """Kind 1: hot bigrams; 7: those of the partition's cold words, with counts and the words' add-one counts; 8: those of its cold contexts."""
        out, part = [], key[0].as_py()
        keys, counts = _merged(table, 1)
        if len(keys):
            out.append((part, 1, 0, _planes(keys), _planes(counts)))
        context, word, counts = _merged_pairs(table, 7)
        if len(word):
            order = np.argsort(word, kind="stable")
            context, word, counts = context[order], word[order], counts[order]
            plus = _lookup(*_merged(table, 0), word, 0) + 1
            out.append((part, 7, 0, _planes(context, word), _planes(counts, plus)))
        context, word, counts = _merged_pairs(table, 8)
        if len(word):
            order = np.argsort(context, kind="stable")
            out.append((part, 8, 0, _planes(context[order], word[order]), _planes(counts[order])))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([packed_rows(out)])

    counted = tokens.filter("learned").select("symbols", "tail").mapInArrow(count_bigrams, PACKED)
    pairs = scratch(counted.unionAll(unigrams).groupBy("part").applyInArrow(merge_bigrams, PACKED), "lm-bigrams")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(context, word, count, add-one count of the word) of every bigram once."""
        for batch in batches:
            for kind, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                a, b = _arrays(a.as_py(), 1 if kind == 1 else 2, np.uint64), _arrays(b.as_py(), 2 if kind == 7 else 1, np.int64)
                if kind == 1:
                    word = a[0] & np.uint64(0xFFFF)
                    yield a[0] >> np.uint64(16), word, b[0], model.plus[word.astype(np.int64)]
                elif kind == 7:
                    yield *a, *b
                else:
                    context, word = a
                    hot = word < HASHES  # the others are of kind 7, too
                    yield context[hot], word[hot], b[0][hot], model.plus[word[hot].astype(np.int64)]

    def rarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, counts, _ in entries(batches):
            n = np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], names=["r", "n"])

    listed = pairs.select("kind", "a", "b")
    with _single_rows(spark):
        rare = listed.mapInArrow(rarities, "r long, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    ratios = good_turing({r["r"]: r["n"] for r in rare})

    def summed(context: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        context, inverse = np.unique(context, return_inverse=True)
        return context, np.array([np.bincount(inverse, w, minlength=len(context)) for w in sums])

    def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # sent on whenever GATHERED contexts are held, so a task sends few rows

        def flush() -> pa.RecordBatch:
            context, sums = summed(np.concatenate([c for c, _ in held]), np.concatenate([x for _, x in held], axis=1))
            held.clear()
            return packed_rows([(p, 5, 0, _planes(context[at]), _planes(*sums[:, at])) for p, at in split(part_of(context, parts), parts)])

        for context, _, counts, plus in entries(batches):
            held.append(summed(context, np.array([counts, _discounted(counts, ratios), plus, np.ones(len(plus))])))
            if sum(len(c) for c, _ in held) >= GATHERED:
                yield flush()
        if held:
            yield flush()

    def merge_contexts(key: tuple, table: pa.Table) -> pa.Table:
        """Kind 5: cold contexts and the logs of their weights; 10: hot contexts and their sums."""
        found = [(_arrays(a, 1, np.uint64)[0], _arrays(b, 4, np.float64)) for _, a, b in unpack(table, 5, (np.uint8, np.uint8))]
        context, sums = summed(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found], axis=1))
        hot = context < HASHES
        cold = np.array(model.weights(*sums[:, ~hot]))
        part = key[0].as_py()
        return pa.Table.from_batches(
            [packed_rows([(part, 5, 0, context[~hot].tobytes(), cold.tobytes()), (part, 10, 0, context[hot].tobytes(), sums[:, hot].tobytes())])]
        )

    with _single_rows(spark):
        contexts = scratch(listed.mapInArrow(context_sums, PACKED).groupBy("part").applyInArrow(merge_contexts, PACKED), "lm-contexts")
    known = unpack(contexts.filter("kind = 10").toArrow(), 10, (np.uint64, np.float64))
    if known:
        model.contexts(np.concatenate([a for _, a, _ in known]).astype(np.int64), np.concatenate([b.reshape(4, -1) for _, _, b in known], axis=1), ratios)
    else:
        model.contexts(np.zeros(0, np.int64), np.zeros((4, 0)), ratios)
    hot, hot_counts = _most_frequent(pairs.filter("kind = 1"), HOT_BIGRAMS)
    hot_logs = model.seen_log(hot, hot_counts)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By text. Kind 2: hot bigrams; 6: cold words with the words before and after; 3: words that share UNKNOWN; 4: of each text its row, the sum of its most frequent bigrams and its numbers of UNKNOWN and of cold words."""
        for batch in batches:
            for piece in slices(batch):
                block = piece.column(0)[0].as_py()
                context, word, text, words, of = bigrams(piece.column(1), piece.column(2))
                wide = (context >= HASHES) | (word >= HASHES)
                keys = (context << np.uint64(16)) | word
                value = np.where(wide, 0.0, _lookup(hot, hot_logs, keys, np.nan))
                rest = np.bincount(of, minlength=piece.num_rows)
                is_cold = np.flatnonzero(word >= HASHES)  # an end follows, so each has a next word
                cold = np.bincount(text[is_cold], minlength=piece.num_rows)
                left = np.isnan(value)
                sums = np.bincount(text, np.where(left, 0.0, value), minlength=piece.num_rows)
                out = [(block % parts, 4, block, piece.column(0).to_numpy().astype(np.int64).tobytes(), np.concatenate([sums, rest, cold]).tobytes())]
                text, of = text.astype(np.uint16), of.astype(np.uint16)
                keys, texts_ = keys[left].astype(np.uint32), text[left]
                order = np.argsort(keys, kind="stable")
                keys, texts_ = keys[order], texts_[order]
                out += [(p, 2, block, _planes(keys[at]), _planes(texts_[at])) for p, at in split(part_of(keys, parts), parts)]
                is_cold = is_cold[np.argsort(word[is_cold], kind="stable")]
                for p, at in split(part_of(word[is_cold], parts), parts):
                    at = is_cold[at]
                    out.append((p, 6, block, _planes(word[at], context[at], word[at + 1]), _planes(text[at])))
                out += [(p, 3, block, words[at].tobytes(), of[at].tobytes()) for p, at in split(part_of(words, parts), parts)]
                yield packed_rows(out)

    def hot_or(values: np.ndarray, symbols: np.ndarray, otherwise) -> np.ndarray:
        """values of the hot symbols; ``otherwise`` for hashes."""
        is_hot = symbols < HASHES
        return np.where(is_hot, values[np.where(is_hot, symbols, np.uint64(0)).astype(np.int64)], otherwise)

    def evaluate(key: tuple, table: pa.Table) -> pa.Table:
        """(texts, sums) of each block: a partition's count tables against its occurrences; kind 4 passes."""
        out = []
        keys, counts = _merged(table, 1)
        logs = model.seen_log(keys, counts)
        for block, key_, text in unpack(table, 2, (np.uint8, np.uint8)):
            key_, text = _arrays(key_, 1, np.uint32)[0].astype(np.uint64), _arrays(text, 1, np.uint16)[0]
            value = _lookup(keys, logs, key_, np.nan)
            value = np.where(np.isnan(value), model.unseen_log(key_), value)
            out.append((block, 0, text, value))
        words, n = _merged(table, 0)
        for block, word, text in unpack(table, 3, (np.uint64, np.uint16)):
            c = _lookup(words, n, word, 0)
            value = np.log10(c + 1.0)
            out.append((block, 1, text, value, value, c > 0))

        def pair_logs(kind: int) -> tuple[np.ndarray, np.ndarray]:
            """Keys, ascending, and logs of the discounted counts of a kind's bigrams."""
            keys, counts = _merged(table, kind)
            return keys, model.count_log(counts)

        into, out_of = pair_logs(7), pair_logs(8)  # bigrams that end in, that start with the partition's cold words
        found = [(a, *b.reshape(2, -1)) for _, a, b in unpack(table, 5, (np.uint64, np.float64))]
        known, below, backoff = found[0] if found else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
        for block, a, text in unpack(table, 6, (np.uint8, np.uint8)):
            (word, before, after), text = _arrays(a, 3, np.uint64), _arrays(text, 1, np.uint16)[0]
            c = _lookup(words, n, word, 0)
            plus = np.log10(c + 1.0)
            value = _lookup(*into, _pair_keys(before, word), np.nan)
            seen = hot_or(-model.context_log, before, 0.0) + np.where(before < HASHES, value, 0.0)  # a cold context adds its part where it is
            unseen = hot_or(model.backoff_log, before, 0.0) + plus - log10(model.norm)
            score = np.where(np.isnan(value), unseen, seen)
            value = _lookup(*out_of, _pair_keys(word, after), np.nan) - _lookup(known, below, word, 0.0)
            unseen = _lookup(known, backoff, word, 0.0) + hot_or(model.unigram_log, after, 0.0)
            score += np.where(np.isnan(value), unseen, value)
            out.append((block, 1, text, score, plus, c > 0))
        result = [(len(a) // 8, 4, block, a, b) for kind, block, a, b in zip(*(table[c].to_pylist() for c in ("kind", "block", "a", "b"))) if kind == 4]
        for block, kind, text, *values in out:
            at, inverse = np.unique(text, return_inverse=True)
            sums = [np.bincount(inverse, v) for v in values]
            result.append((len(at), kind, block, _planes(at.astype(np.uint16)), _planes(*(x.astype(np.float64) for x in sums))))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([packed_rows(result)])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count tables as keys, ascending, and counts."""
        for batch in batches:
            for part, kind, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), batch.column(4)):
                a, b = a.as_py(), b.as_py()
                if kind != 1:
                    keys = _pair_keys(*_arrays(a, 2, np.uint64))
                    order = np.argsort(keys)
                    a, b = _planes(keys[order]), _planes(_arrays(b, 2 if kind == 7 else 1, np.int64)[0][order])
                yield packed_rows([(part, kind, 0, a, b)])

    sent = tokens.select("row", "symbols", "tail").mapInArrow(occurrences, PACKED)
    partial = sent.unionAll(unigrams).unionAll(pairs.mapInArrow(keyed, PACKED)).unionAll(contexts.filter("kind = 5")).groupBy("part").applyInArrow(evaluate, PACKED)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        """(row, score, base, known) of the texts of a block."""
        row = score = base = known = None
        parts_ = list(zip(table["part"].to_pylist(), table["kind"].to_pylist(), table["a"], table["b"]))
        for n, kind, a, b in parts_:
            if kind == 4:
                row, all_ = np.frombuffer(a.as_py(), np.int64), np.frombuffer(b.as_py(), np.float64)
                score, rest, cold = all_[:n].copy(), all_[n : 2 * n], all_[2 * n :]
                base, known = -(rest + cold) * log10(model.norm), np.zeros(n)
                score -= rest * log10(model.unknown_mass) if rest.any() else 0.0
        for n, kind, a, b in parts_:
            if kind == 4:
                continue
            at, v = _arrays(a.as_py(), 1, np.uint16)[0], _arrays(b.as_py(), 1 + 2 * kind, np.float64)
            score[at] += v[0]
            if kind == 1:
                base[at] += v[1]
                known[at] += v[2]
        return pa.table({"row": row, "score": score, "base2": base, "known2": known.astype(np.int64)})

    sums = partial.groupBy("block").applyInArrow(gather, "row long, score double, base2 double, known2 long")
    return tokens.select("row", "id", "held", "n_tokens", "known", "base").join(sums, "row").select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.col("known2")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("base2")).alias("base_score"),
        "score",
    )
