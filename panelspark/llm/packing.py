"""Best-fit packing by a configuration linear program over the length histogram."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, process_cache, scratch

CAPACITY = 1024
END_ID = 2
#: A space beside other white space, or white space at an end: such texts are not cut at spaces.
_AWKWARD = re.compile(r"\s |\s\Z|\A\s| \s")
#: Words whose ids a worker remembers; the memory is emptied when full.
REMEMBERED = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, task int, rank long"


def _encoder(vocabulary: str):
    """Maps a text to its ids as little-endian uint16 bytes (uint32 for larger vocabularies)."""
    import public_tokenizers
    from tokenizers import Tokenizer

    cache = process_cache()
    if ("encoder", vocabulary) in cache:
        return cache["encoder", vocabulary]
    path = public_tokenizers.path(vocabulary)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    width = "<u2" if tok.get_vocab_size() <= 1 << 16 else "<u4"
    encode = lambda s: tok.encode(s, add_special_tokens=False).ids
    ranks = re.sub(r"\.json$", ".tiktoken", path)
    try:  # the same vocabulary as ranks, for a faster encoder of the same ids
        import base64

        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    except (ImportError, FileNotFoundError):
        pass
    known: dict[str, bytes] = {}

    def ids(text: str) -> bytes:
        # The pattern never joins a space to a non-space before it, so a text may be cut before single spaces.
        if _AWKWARD.search(text):
            return np.asarray(encode(text), dtype=width).tobytes()
        words = text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [text]
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = np.asarray(encode(w), dtype=width).tobytes()
            return b"".join([known[w] for w in words])

    cache["encoder", vocabulary] = ids, width
    return ids, width


def tokenise(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k.json", bytes_per_id: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every row's ids: (doc_id, piece, start, length, ids, ids_crc32, task, rank).

    A text's ids end with id 2; null counts as empty, so every row has a
    piece. Only rows of more than ``capacity`` ids are cut, into pieces of
    ``capacity``; the first may be shorter. ``ids`` holds little-endian
    unsigned integers of ``bytes_per_id`` (2 or 4; 0: none), ``ids_crc32``
    the checksum of the same ids as uint32. ``rank`` numbers the pieces of a
    length within a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = _encoder(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.asarray([END_ID], dtype=width).tobytes()
        size = len(end)
        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 512):
                owner, piece, start, length, ids, crc = [], [], [], [], [], []
                for i in range(lo, min(lo + 512, batch.num_rows)):
                    raw = encode(texts[i].as_py() or "") + end
                    n = len(raw) // size
                    cut = n % capacity or capacity
                    whole = np.frombuffer(raw, dtype=width)
                    wide = whole.astype("<u4").tobytes()
                    kept = whole.astype(f"<u{bytes_per_id}").tobytes() if bytes_per_id else b""
                    s, e, k = 0, cut, 0
                    while s < n:
                        owner.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(e - s)
                        ids.append(kept[bytes_per_id * s : bytes_per_id * e])
                        crc.append(zlib.crc32(wide[4 * s : 4 * e]))
                        s, e, k = e, e + capacity, k + 1
                size_of = np.asarray(length, dtype=np.int64)
                order = np.argsort(size_of, kind="stable")
                ordered = size_of[order]
                first = np.searchsorted(ordered, ordered, side="left")
                rank = np.empty(len(ordered), dtype=np.int64)
                rank[order] = np.arange(len(ordered)) - first + seen[ordered]
                seen += np.bincount(size_of, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, type=pa.int64())).cast(pa.int64()),
                        pa.array(piece, type=pa.int32()),
                        pa.array(start, type=pa.int64()),
                        pa.array(size_of),
                        pa.array(ids, type=pa.binary()),
                        pa.array(crc, type=pa.int64()),
                        pa.array(np.full(len(ordered), task, dtype=np.int32)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "rank"],
                )

    return pick(docs, id=id_col, text=text_col).mapInArrow(run, PIECES)


def best_knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int, noise: np.ndarray, places: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(highest price of a configuration, price and multiplicities of one that is nearly as dear for each capacity from 0 up).

    Two programmes run side by side over ascending sizes: an exact one, and
    one that takes each size for up to the share ``noise`` dearer than it is,
    so that equally good configurations share few sizes. ``places`` says
    where in ``noise`` each capacity starts.
    """
    exact, near = np.zeros(capacity + 1), np.zeros(capacity + 1)
    held = np.zeros((capacity + 1, len(sizes)), dtype=np.int32)
    upto = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        n = upto[c]
        exact[c], near[c], held[c] = exact[c - 1], near[c - 1], held[c - 1]
        if n:
            before = c - sizes[:n]
            exact[c] = max(exact[c], (exact[before] + prices[:n]).max())
            k = int((near[before] + prices[:n] * (1 + noise[places[c] : places[c] + n])).argmax())
            value = near[before[k]] + prices[k]
            if value > near[c]:
                near[c], held[c] = value, held[before[k]]
                held[c, k] += 1
    return float(exact[capacity]), near, held


#: A size's price falls by exp(-RATE) in a first step that covers it as much as sizes on average; less later.
RATE = 0.05
#: A step counts a size as covered at most this many times the average.
MOST = 8
#: Configurations worth this share less than the best one count as best in the first steps; less later.
SLACK = 0.05
#: The program is solved when the cover is this close to its lower bound.
GAP = 0.002
#: Sizes that together hold this share of all ids, the rarest first, stay out of the program: best fit places them.
RARE = 0.002


def configuration_lp(histogram: dict[int, int], capacity: int, iterations: int, seed: int = 0) -> tuple[list[tuple[dict[int, int], float]], float]:
    """(fractional cover of the histogram as (configuration, how often), lower bound on the sequences of any cover).

    Multiplicative weights. Each size has a price; a knapsack programme
    finds a dear configuration through every size, and a step takes all
    those within the slack of the dearest, each in proportion to the demand
    for its size, until sizes are covered once on average. Then each price
    is multiplied by exp(-rate * the share of its demand that the step
    covered, up to ``MOST``); rate and slack fall with the square root of
    the steps. The cover is the average of the steps since the last
    power of two, scaled until every size is covered. Prices divided by that
    of the dearest configuration solve the dual program, so their sum over
    the demand bounds every cover from below, as the volume does. It stops
    when both are within ``GAP``, or after ``iterations``. Sizes left out as
    ``RARE`` count in the volume only.
    """
    rng = np.random.default_rng(seed)
    by_volume = sorted(histogram, key=lambda s: (s * histogram[s], s))
    volume = np.cumsum([s * histogram[s] for s in by_volume])
    sizes = np.array(sorted(s for s, v in zip(by_volume, volume) if v > RARE * volume[-1]), dtype=np.int64)
    demand = np.array([histogram[s] for s in sizes], dtype=float)
    prices = sizes / capacity
    bound, least, cover = float(volume[-1]) / capacity, np.inf, []
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # of each: configurations' rows, sizes, counts; how often
    covered = np.zeros(len(sizes))
    for t in range(iterations):
        slack = SLACK / np.sqrt(1 + t / 16)
        noise = slack * rng.random(8 * len(sizes))
        dearest, near, held = best_knapsack(prices, sizes, capacity, noise, rng.integers(0, 7 * len(sizes), capacity + 1))
        prices, near = prices / dearest, near / dearest
        bound = max(bound, float(demand @ prices))
        worth = prices + near[capacity - sizes]
        good = np.flatnonzero(worth >= min(1 - slack, worth.max()))
        configs = held[capacity - sizes[good]]
        configs[np.arange(len(good)), good] += 1
        times = demand[good] / configs[np.arange(len(good)), good]
        share = times @ configs / demand
        times, share = times / share.mean(), share / share.mean()
        if t & (t - 1) == 0:
            steps, covered = [], np.zeros(len(sizes))
        row, size = np.nonzero(configs)  # few sizes each: kept whole, the steps would fill the driver's memory
        steps.append((row.astype(np.int32), size.astype(np.int32), configs[row, size], times))
        covered = covered + share
        total = sum(float(x.sum()) for *_, x in steps)
        if covered.min() > 0 and total / covered.min() < least:
            least, cover = total / covered.min(), [(r, k, c, x / covered.min()) for r, k, c, x in steps]
        if least <= bound * (1 + GAP):
            break
        prices = prices * np.exp(-RATE / np.sqrt(1 + t / 16) * np.minimum(share, MOST))
    taken: dict[tuple, float] = defaultdict(float)
    for row, size, counts, times in cover:
        cuts = np.flatnonzero(np.diff(row)) + 1
        for x, at, many in zip(times, np.split(sizes[size], cuts), np.split(counts, cuts)):
            taken[tuple(zip(at.tolist(), many.tolist()))] += float(x)
    return [(dict(c), x) for c, x in taken.items()], bound


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram; bins of the same contents are handled together."""
    bins: dict[int, dict[tuple, int]] = defaultdict(dict)

    def put(space: int, items: tuple, n: int) -> None:
        if n:
            bins[space][items] = bins[space].get(items, 0) + n

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            space = min((s for s in bins if s >= size and bins[s]), default=None)
            if space is None:
                per = capacity // size
                if n >= per:
                    put(capacity - per * size, ((size, per),), n // per)
                if n % per:
                    put(capacity - n % per * size, ((size, n % per),), 1)
                break
            items, many = bins[space].popitem()
            use = min(n, many)
            put(space, items, many - use)
            put(space - size, (*items, (size, 1)), use)
            n -= use
    out = []
    for group in bins.values():
        for items, many in group.items():
            config: dict[int, int] = defaultdict(int)
            for s, k in items:
                config[s] += k
            out.append((dict(config), many))
    return out


def _rounded(histogram: dict[int, int], capacity: int, cover: list[tuple[dict[int, int], float]]) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """(whole sequences of the cover, what is left): fullest configurations first, fractions carried on, never beyond the histogram."""
    left, plan, carry = dict(histogram), [], 0.0
    for config, x in sorted(cover, key=lambda c: (-sum(s * k for s, k in c[0].items()), -c[1], sorted(c[0].items()))):
        want = x + carry
        n = min(int(want + 1e-9), *(left[s] // k for s, k in config.items()))
        carry = min(want - n, 1.0)
        if n > 0:
            plan.append((config, n))
            for s, k in config.items():
                left[s] -= n * k
    return plan, {s: n for s, n in left.items() if n}


#: The program is solved anew for what the rounding leaves, this often at most.
ROUNDS = 3


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, iterations: int = 256) -> list[tuple[dict[int, int], int]]:
    """Whole sequences that hold the histogram exactly: (configuration, how many).

    Pieces of full length stand alone. The cover of the program is rounded
    to whole sequences, and the program solved again for what is left; best
    fit packs the last remainder. If best fit alone, or after fewer rounds,
    needs no more sequences, that plan is taken. The histogram has at most
    ``capacity`` entries, so the cost does not depend on the number of rows.
    """
    left = dict(histogram)
    alone = [({capacity: 1}, left.pop(capacity))] if left.get(capacity) else []
    if not left:
        return alone
    fixed: list[tuple[dict[int, int], int]] = []
    plans = [_best_fit(left, capacity)]
    for k in range(ROUNDS):
        cover, _ = configuration_lp(left, capacity, iterations >> k, k)
        whole, left = _rounded(left, capacity, cover)
        fixed += whole
        plans.append(fixed + _best_fit(left, capacity))
        if not whole or not left:
            break
    return alone + min(plans, key=lambda p: sum(n for _, n in p))


def pack(pieces: DataFrame, capacity: int = CAPACITY, iterations: int = 256) -> DataFrame:
    """``pieces`` (columns length, task, rank and any others) with sequence_id and offset.

    Lengths must be 1 to ``capacity``; rank numbers equal lengths within a
    task, as :func:`tokenise` does. The pieces of a sequence follow each
    other from 0 without gaps. The driver sees the length histogram only;
    the places of the pieces of a length are computed from their rank. An
    empty table gives an empty result.
    """
    stored = scratch(pieces, "pack-pieces")
    counts = scratch(stored.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # of a length: pieces, first sequence, offset
    sequence = 0
    for config, n in plan_sequences(histogram, capacity, iterations):
        offset = 0
        for size in sorted(config, reverse=True):
            for _ in range(config[size]):
                slots[size].append((n, sequence, offset))
                offset += size
        sequence += n
    table = {s: tuple(np.array(x, dtype=np.int64) for x in zip(*v)) for s, v in slots.items()}
    ends = {s: np.cumsum(v[0]) for s, v in table.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), dtype=np.int64)
        size, rank = length.to_numpy(), number.to_numpy()
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            s = int(size[rows[0]])
            many, first, offset = table[s]
            k = np.searchsorted(ends[s], rank[rows], side="right")
            out[rows, 0] = first[k] + rank[rows] - (ends[s][k] - many[k])
            out[rows, 1] = offset[k]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    upto = F.sum("n").over(Window.partitionBy("length").orderBy("task"))
    base = counts.select("task", "length", (upto - F.col("n")).alias("_before"))
    placed = stored.join(base, ["task", "length"]).withColumn("_at", place("length", F.col("rank") + F.col("_before")))
    keep = [c for c in pieces.columns if c not in ("task", "rank")]
    return placed.select(*keep, "_at.sequence_id", "_at.offset")
