"""Removal of repeated substrings: suffix arrays over the places where a long substring could recur."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import mix, text_blocks
from .common import pick, scratch, with_totals
from .suffix import suffix_array

#: Bytes of the seed that all equal windows share.
SEED = 40
#: Places in a segment and the window after it fit 20 bits.
WIDEST = 1 << 19
#: Bytes of a symbol of the suffix array.
SYMBOL = 16
#: Window starts looked at together; seeds are chosen by (hash, position) with 20 bits for the position.
SEGMENT = 1 << 19
#: Different contents around one seed that go to one suffix array; the windows of seeds with more are regrouped.
CONTENTS = 512
#: Distances from window to seed that share a group, at each regrouping; at 1 a group's windows are all equal.
RANGES = (40, 10, 3, 1)
#: Symbols sorted together, unless one seed needs more.
SORTED = 1 << 16

_A = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


class Seeds:
    """Cuts texts into stretches of windows that have the same seed.

    A window's seed is its ``SEED``-byte substring of least hash, leftmost of
    equals. It depends on the window's bytes only, so equal windows have
    equal seeds at equal distances.
    """

    def __init__(self, window: int):
        self.window = window
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * _A)
        size = SEGMENT + window
        self.power = _powers(int(_A), size + 1)
        self.inverse = _powers(pow(int(_A), -1, 2**64), size + 1)

    def _seed_hashes(self, values: np.ndarray) -> np.ndarray:
        levels, n, h = {1: values}, 1, values
        while 2 * n <= SEED:
            h = h[:-n] * self.power[n] + h[n:]
            n *= 2
            levels[n] = h
        whole, done = levels[n], n
        for m in sorted(levels, reverse=True):
            while done + m <= SEED:
                whole = whole[: len(values) - done - m + 1] * self.power[m] + levels[m][done:]
                done += m
        return mix(whole)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, start in the text, length, seed's place from the start, seed hash, content hash) of stretches."""
        w = self.window
        of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for lo in range(0, max(len(data) - w + 1, 0), SEGMENT):
            part = data[lo : lo + SEGMENT + w - 1]
            values = self.byte[part]
            hashes = self._seed_hashes(values)
            key = (hashes & ~np.uint64(0xFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
            seed = (_sliding_min(key, w - SEED + 1) & np.uint64(0xFFFFF)).astype(np.int64)
            n = len(seed)
            text = of[lo : lo + n]
            inside = text == of[lo + w - 1 : lo + w - 1 + n]
            cut = np.flatnonzero((seed[1:] != seed[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])) + 1
            first = np.concatenate([[0], cut])
            last = np.concatenate([cut, [n]]) - 1
            good = inside[first]
            first, last = first[good], last[good]
            length = last - first + w
            upto = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(values * self.inverse[1 : len(part) + 1], out=upto[1:])
            content = (upto[first + length] - upto[first]) * self.power[first + length]
            place = seed[first] - first
            content = mix(content + mix(((length << 20) | place).astype(np.uint64) * _A))
            yield text[first], lo + first - offsets[text[first]], length, place, hashes[seed[first]], content


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def repeated_windows(contents: list[bytes], places: list[int], copies: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Of each content the runs (first, last) of window starts whose window occurs again.

    Contents are different stretches of text of at least a window, given
    with the place of their seed and the number of times they occur. Equal
    windows lie alike around their seeds, so each content is cut into symbols
    counted from its seed; a window is then a tail of a symbol, a fixed
    number of whole symbols, and some bytes more. The suffix array over all
    symbols brings equal runs of whole symbols together; windows are equal
    if these and the remaining bytes are.
    """
    whole = (window - SYMBOL + 1) // SYMBOL  # whole symbols that any window has
    rest = window - whole * SYMBOL
    sizes = np.array([len(c) for c in contents])
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(contents) + bytes(SYMBOL), dtype=np.uint8)
    head = np.array(places) % SYMBOL
    blocks = (sizes - head) // SYMBOL
    owner = np.repeat(np.arange(len(contents)), blocks)
    nr = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = base[owner] + head[owner] + nr * SYMBOL
    halves = data[begin[:, None] + np.arange(SYMBOL)].copy().view(">u8")
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.concatenate([[True], (np.diff(halves[order], axis=0) != 0).any(axis=1)])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    string = np.insert(rank, np.cumsum(blocks), 0)  # a separator, the least symbol, ends each content
    at = np.arange(len(owner)) + owner  # of each symbol: its place in the string

    suffixes = suffix_array(string)
    back = np.full(len(string), -1)
    back[at] = np.arange(len(owner))
    sorted_ = back[suffixes]
    sorted_ = sorted_[sorted_ >= 0]
    sorted_ = sorted_[nr[sorted_] + whole <= blocks[owner[sorted_]]]
    class_of = np.full(len(owner), -1)
    if len(sorted_):
        runs = string[at[sorted_][:, None] + np.arange(whole)]
        class_of[sorted_] = np.cumsum(np.concatenate([[True], (runs[1:] != runs[:-1]).any(axis=1)]))

    n = sizes - window + 1
    of = np.repeat(np.arange(len(contents)), n)
    p = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    j = np.maximum(-(-(p - head[of]) // SYMBOL), 0)
    r = head[of] + j * SYMBOL - p
    symbol = (np.cumsum(blocks) - blocks)[of] + j
    key = np.zeros((len(of), -(-rest // 8) * 8), dtype=np.uint8)
    for c in range(rest):
        key[:, c] = data[base[of] + p + np.where(c < r, c, c + whole * SYMBOL)]
    fields = np.concatenate([key.view(np.uint64), (class_of[symbol] * SYMBOL + r).astype(np.uint64)[:, None]], axis=1)
    hashed = np.zeros(len(of), dtype=np.uint64)
    for c in range(fields.shape[1]):
        hashed = mix(hashed * _A + fields[:, c])
    order = np.argsort(hashed, kind="stable")
    same = (fields[order][1:] == fields[order][:-1]).all(axis=1)
    again = np.zeros(len(of), dtype=bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    again |= (np.array(copies) > 1)[of]
    return [_runs(x) for x in np.split(again, np.cumsum(n)[:-1])]


def repeated_spans(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (id, data, k1, k2) and, of each (k1, k2), the spans [s, e) of bytes that occur elsewhere.

    The work goes over stretches of windows with one seed, about one for
    every 80 bytes. A seed that occurs once rules its windows out. Stretches
    with the same content occur again as a whole; they are counted, not
    compared. Different contents around one seed are compared by suffix
    array, all contents of a seed in one task. A seed with more than
    ``CONTENTS`` different contents would make a hot task. Its windows are
    regrouped: those whose distance to the seed is in the same short range
    all hold the same core of bytes, so equal windows have equal cores, and
    each core is a seed of its own with far fewer contents; ranges shrink
    until no group is too large.
    """
    if not SEED <= window <= WIDEST:
        raise ValueError(f"window must be from {SEED} to {WIDEST}, not {window}")
    rows = pick(docs, id=id_col, text=text_col).select("id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("id", "text"), "k2": F.xxhash64("text", "id", F.lit(1))})

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(window)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(0), SEGMENT):
                for text, start, length, place, seed, content in seeds(data, offsets):
                    owner = pa.array(text + lo)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seed.view(np.int64)),
                            pa.array(content.view(np.int64)),
                            batch.column(1).take(owner),
                            batch.column(2).take(owner),
                            pa.array(start),
                            pa.array(length.astype(np.int32)),
                            pa.array(place.astype(np.int32)),
                        ],
                        names=["seed", "content", "k1", "k2", "start", "length", "place"],
                    )

    found = scratch(
        rows.filter(F.octet_length("text") >= window).select("text", "k1", "k2").mapInArrow(stretches, "seed long, content long, k1 long, k2 long, start long, length int, place int"),
        "repeat-stretches",
    )
    several = scratch(found.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"), "repeat-seeds")
    again = scratch(found.join(several, "seed"), "repeat-candidates")
    contents = scratch(
        again.groupBy("seed", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("k1", "k2", "start", "length", "place")).alias("one")).select("seed", "content", "copies", "one.*"),
        "repeat-contents",
    )
    around = scratch(with_totals(contents, ["seed"], {"n": (F.count(F.lit(1)), "sum")}, ["content"]), "repeat-around")
    alike = scratch(around.filter("n > 1"), "repeat-different")
    start, length = F.col("start"), F.col("length")
    texts = rows.select("k1", "k2", F.col("text").cast("binary").alias("data"))
    cut = F.expr("substring(data, cast(start as int) + 1, length)")
    spelled = alike.join(texts, ["k1", "k2"]).select("seed", "content", "copies", "n", "place", cut.alias("bytes"))
    spelled = scratch(spelled, "repeat-spelled")

    runs = "seed long, content long, first int, last int"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by seed; a batch of whole seeds is compared together."""

        def solve(held: dict[tuple[int, int], tuple[bytes, int, int]]) -> pa.RecordBatch:
            keys = list(held)
            out = repeated_windows(*(list(x) for x in zip(*held.values())), window)
            flat = [(*k, a, b) for k, spans in zip(keys, out) for a, b in spans]
            cols = list(zip(*flat)) if flat else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=["seed", "content", "first", "last"])

        held: dict[tuple[int, int], tuple[bytes, int, int]] = {}
        size, last = 0, None
        for batch in batches:
            for seed, content, copies, at, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if seed != last and size > SORTED * SYMBOL:
                    yield solve(held)
                    held, size = {}, 0
                held[seed, content] = raw, at, copies
                size += len(raw)
                last = seed
        if held:
            yield solve(held)

    def matches(level: DataFrame, ranges: tuple[int, ...]) -> DataFrame:
        """Runs of repeated windows of contents (seed, content, copies, n, place, bytes); n contents share the seed."""
        few = level.filter((F.col("n") <= CONTENTS) & ((F.col("n") > 1) | (F.col("copies") > 1)))
        few = few.select("seed", "content", "copies", "place", "bytes").repartition("seed").sortWithinPartitions("seed")
        found = scratch(few.mapInArrow(compare, runs), "repeat-runs")
        hot = level.filter(F.col("n") > CONTENTS)
        if not ranges or hot.isEmpty():
            return found
        z, w = ranges[0], window
        parts = hot.dropDuplicates(["seed", "content"]).withColumn("last", F.octet_length("bytes") - w)
        parts = parts.withColumn("r", F.explode(F.expr(f"sequence(cast(greatest(place - last, 0) div {z} as int), cast(place div {z} as int))")))
        parts = parts.withColumns({"base": F.expr(f"greatest(0, place - (r + 1) * {z} + 1)"), "end": F.expr(f"least(last, place - r * {z}) + {w}")})
        parts = parts.selectExpr(
            "seed", "content", "base", "copies", "place - base AS place", "substring(bytes, base + 1, end - base) AS bytes",
            f"xxhash64(seed, r, substring(bytes, place - r * {z} + 1, {w - z + 1})) AS seed2",
        )
        parts = scratch(parts.withColumn("content2", F.xxhash64("place", "bytes")), "repeat-parts")
        deeper = parts.groupBy(F.col("seed2").alias("seed"), F.col("content2").alias("content")).agg(
            F.sum("copies").alias("copies"), F.first("place").alias("place"), F.first("bytes").alias("bytes")
        )
        deeper = with_totals(scratch(deeper, "repeat-deeper"), ["seed"], {"n": (F.count(F.lit(1)), "sum")}, ["content"])
        deeper = matches(scratch(deeper, "repeat-level"), ranges[1:])
        up = parts.select("seed", "content", "base", "seed2", "content2").join(
            deeper.select(F.col("seed").alias("seed2"), F.col("content").alias("content2"), "first", "last"), ["seed2", "content2"]
        )
        return found.unionAll(up.select("seed", "content", F.expr("cast(first + base as int)"), F.expr("cast(last + base as int)")))

    hits = scratch(matches(spelled, RANGES), "repeat-hits")

    same = around.filter("n = 1").select("seed")  # one content, so every stretch with this seed occurs again
    whole = again.join(scratch(same, "repeat-same"), "seed").select("k1", "k2", start.alias("s"), (start + length).alias("e"))
    partly = again.join(hits, ["seed", "content"]).select(
        "k1", "k2", (start + F.col("first")).alias("s"), (start + F.col("last") + window).alias("e")
    )
    spans = whole.unionAll(partly).distinct()
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))  # bounded by the text's length
    return rows, scratch(spans, "repeat-spans")


def remove_repeats(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row without the bytes that are part of a ``window``-byte string that also starts anywhere else.

    Texts count as UTF-8 bytes; matches never cross texts, may lie in the
    same text, and may overlap; all are judged on the input. Null and empty
    texts, and texts shorter than the window, lose nothing. A row that is
    repeated as a whole repeats all its windows. Windows are from ``SEED`` to
    ``WIDEST`` bytes. What remains need not be
    valid UTF-8, so it is binary. Returns (doc_id, n_bytes, n_removed,
    n_spans, spans, kept): spans are the maximal removed runs [start, end).
    """
    rows, spans = repeated_spans(docs, window, id_col, text_col)
    joined = rows.join(spans, ["k1", "k2"], "left").select("id", F.col("text").cast("binary").alias("data"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, out, kept = [], [], [], []
            for raw, found in zip(batch.column(1), batch.column(2)):
                data = raw.as_py()
                merged: list[dict] = []
                for span in sorted(found.as_py() or (), key=lambda x: (x["s"], x["e"])):
                    if merged and span["s"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], span["e"])
                    else:
                        merged.append({"start": span["s"], "end": span["e"]})
                edges = [0, *(x for m in merged for x in (m["start"], m["end"])), len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(left))
                out.append(merged)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, type=pa.int64()),
                    pa.array(n_removed, type=pa.int64()),
                    pa.array([len(m) for m in out], type=pa.int64()),
                    pa.array(out, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, type=pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    schema = f"doc_id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary"
    return joined.mapInArrow(cut, schema)
