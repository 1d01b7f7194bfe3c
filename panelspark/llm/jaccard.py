"""Exact Jaccard join of shingle sets: universe partition, pigeonhole, one-deletion neighbourhoods.

Sets x and y with Jaccard similarity of at least t differ in at most
H = floor((1 - t) / (1 + t) * (|x| + |y|)) elements. Hash the universe into
segments and allow a segment i a difference of T_i: if the T_i + 1 sum to
more than H, some segment of x and y differs by at most its T_i. T_i = 0
needs equal segments, T_i = 1 segments that are equal or one deletion apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytes_ import Words, mix, text_blocks
from .common import WORD_CLASS, pick, scratch, with_totals
from .components import connected_components
from .packed import split, unpack

SHINGLE = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
PERCENT = 75
#: Guessed chance that an element of a text is in some unrelated text too; steers costs, not results.
SHARED = 0.25
#: Cost of a candidate in signatures, per element of the larger set.
VERIFY = 4000
#: A group of more rows than this is hot; a smaller one is compared pair by pair.
HOT = 8
HISTOGRAM = 256
#: Times that the components of a hot group are compared through one member each, before all of them are.
TURNS = 3
#: Size of the table of id hashes that is broadcast to thin out the second read of the texts.
SIEVE = 1 << 18
#: Marks of a signature beside the row's place in its block: made by a deletion; of a segment with T = 1; of the next band's scheme.
DELETED, NEAR, NEXT, PLACE = 0x8000, 0x4000, 0x2000, 0x1FFF
_A = np.uint64(0x9E3779B97F4A7C15)


def max_difference(total: int | np.ndarray) -> int | np.ndarray:
    """Elements by which two linked sets of ``total`` elements together can differ."""
    return total * (100 - PERCENT) // (100 + PERCENT)


@dataclass(frozen=True)
class Scheme:
    """How sets are cut when the larger of a pair has 2**band to 2**(band + 1) - 1 elements."""

    need: int  # weight (T + 1, summed) that rules out a link if no segment matches
    equal: int  # segments with T = 0
    near: int  # segments with T = 1
    share: float  # of the universe, for each segment with T = 1

    @property
    def spare(self) -> int:
        """Weight that a linked pair shares beyond the first: so much of it may be hot."""
        return (self.equal + 2 * self.near - self.need) // 2


def _allocate(band: int) -> Scheme | None:
    """The cheapest allocation for a band; none if only equal sets can link there.

    The cost is the number of signatures of a set of the band's largest
    size, plus the expected number of unrelated candidates at their price.
    Spare weight lets a set leave out segments (T = -1): half of it the
    smallest ones, half of it those that turn out to be hot.
    """
    top = 2 ** (band + 1) - 1
    need = max_difference(2 * top) + 1
    if need == 1:
        return None
    best, chosen = float("inf"), None
    for near in range(3) if top < 256 else (0,):
        for size in (4, 6, 8, 12) if near else (0,):
            share = min(size / top, 1 / (near + 1))
            left = 1 - near * share
            for spare in (0.3, 0.45, 0.6):
                equal = max(0, need - 2 * near) + max(2, ceil(need * spare))
                emitted = max(0, need - 2 * near) + (2 * near + equal - need) // 2
                in_equal, in_near = (top * left / equal if equal else 0.0), top * share
                false = emitted * exp(-in_equal * (1 - SHARED)) * (emitted / equal if equal else 0) ** 2
                false += near * (1 + in_near) * exp(-in_near * (1 - SHARED))
                cost = emitted + near * (1 + in_near) + VERIFY / top * false
                if cost < best:
                    best, chosen = cost, Scheme(need, equal, near, share)
    return chosen


SCHEMES = tuple(_allocate(band) for band in range(48))


def shingle_sets(words: np.ndarray, upto: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes by text, text of each) from word hashes; a text of 1 to n - 1 words is one shingle."""
    counts = np.diff(upto)
    if len(words) >= n:
        h = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            h *= _A
            h += words[k : len(words) - n + 1 + k]
        h = mix(h)
    else:
        h = np.zeros(0, dtype=np.uint64)
    full = np.maximum(counts - (n - 1), 0)
    text = np.repeat(np.arange(len(counts)), full)
    at = np.arange(len(text)) + np.repeat(upto[:-1] - (np.cumsum(full) - full), full)
    h = h[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = []
        for i in short:
            v = np.uint64(counts[i])
            for w in words[upto[i] : upto[i + 1]]:
                v = mix(np.array([v], dtype=np.uint64) * _A + w)[0]
            extra.append(v)
        h, text = np.concatenate([h, np.array(extra, dtype=np.uint64)]), np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def signatures(h: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signature, text, marks) of sets given as (hash, text) pairs, text ascending.

    A set has signatures under the scheme of its own band, and of the next
    if its partners there are small enough. Of its segments with T = 0 it
    emits the first in the order of falling size and hash: as many as the
    pigeonhole needs for its largest partner, and the scheme's spare ones.
    Two linked sets have more equal segments than either leaves out, and
    order them alike; so they share signatures of a weight of at least one
    more than the spare weight.
    """
    top_band = np.frexp(sizes.astype(float))[1] - 1  # floor(log2), exact below 2**53
    for step in (0, 1):
        for band in np.unique(top_band[sizes > 0]).tolist():
            s = SCHEMES[band + step]
            if s is None:
                continue
            low, top = 2 ** (band + step), 2 ** (band + step + 1) - 1
            partner = np.minimum(sizes * 100 // PERCENT, top)
            mine = (top_band == band) & (sizes > 0) & (partner >= low)
            if not mine.any():
                continue
            for name, owner, marks in _cut(h[mine[text]], text[mine[text]], s, band + step, max_difference(sizes + partner), mine):
                yield name, owner, np.full(len(owner), NEXT * step) | marks


def _cut(h: np.ndarray, text: np.ndarray, s: Scheme, band: int, differ: np.ndarray, mine: np.ndarray):
    spread = mix(h ^ mix(np.array([band + 1], dtype=np.uint64) * _A)[0])
    where = (spread >> np.uint64(11)).astype(np.float64) * 2.0**-53
    edge = s.near * s.share
    seg = np.where(
        where < edge,
        np.minimum((where / s.share).astype(np.int64), s.near - 1) if s.near else 0,
        s.near + np.minimum(((where - edge) / max(1 - edge, 1e-12) * s.equal).astype(np.int64), max(s.equal - 1, 0)),
    )
    element = mix(spread + _A)
    segments = s.near + s.equal
    key = text * segments + seg
    order = np.argsort(key, kind="stable")
    key, element = key[order], element[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    content, size = np.add.reduceat(element, first), np.diff(np.append(first, len(key)))
    owner, seg = key[first] // segments, key[first] % segments
    salt = lambda g: mix((g + 1).astype(np.uint64) * _A + np.uint64(band))
    name = mix(content + salt(seg))

    near = seg < s.near
    yield name[near], owner[near], NEAR
    member = np.repeat(near, size)
    less = np.repeat(content, size)[member] - element[member]
    yield mix(less + salt(key[member] % segments)), key[member] // segments, NEAR | DELETED

    rows = np.flatnonzero(~near)
    order = np.lexsort((name[rows], -size[rows], owner[rows]))
    rows = rows[order]
    heads = np.concatenate([[True], owner[rows][1:] != owner[rows][:-1]]) if len(rows) else np.zeros(0, dtype=bool)
    rank = np.arange(len(rows)) - np.maximum.accumulate(np.where(heads, np.arange(len(rows)), 0)) if len(rows) else np.zeros(0, dtype=np.int64)
    wanted = np.clip(differ + 1 - 2 * s.near + s.spare, 0, s.equal)
    rows = rows[rank < wanted[owner[rows]]]
    yield name[rows], owner[rows], 0

    # sets that must also emit empty segments: of T = 1, and of T = 0 where the others are too few
    texts = np.flatnonzero(mine)
    many = np.bincount(owner[~near], minlength=len(mine))
    poor = texts[(many[texts] < wanted[texts]) | (np.bincount(owner[near], minlength=len(mine))[texts] < s.near)]
    if len(poor):
        empty_name = mix(salt(np.arange(segments)))
        by_name = s.near + np.argsort(empty_name[s.near :], kind="stable")
        start, end = np.searchsorted(owner, poor), np.searchsorted(owner, poor, side="right")
        names, owners, marks = [], [], []
        for t, a, b in zip(poor.tolist(), start.tolist(), end.tolist()):
            has = np.zeros(segments, dtype=bool)
            has[seg[a:b]] = True
            out = [g for g in range(s.near) if not has[g]]
            short = int(wanted[t] - many[t])
            if short > 0:
                out += by_name[~has[by_name]][:short].tolist()
            names.append(empty_name[out])
            owners += [t] * len(out)
            marks += [NEAR if g < s.near else 0 for g in out]
        yield np.concatenate(names), np.array(owners, dtype=np.int64), np.array(marks, dtype=np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = pick(docs, id=id_col, text=text_col)
    return rows.withColumns({"k1": F.xxhash64("id", "text"), "k2": F.xxhash64("text", "id", F.lit(1))})


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, na, nb) whose sets link."""
    left = sets.select(F.col("sid").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("sid").alias("b"), F.col("elements").alias("eb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("ea", "eb")))
    return both.filter(F.lit(100) * F.col("common") >= F.lit(PERCENT) * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the size of its shingle set and its component of linked rows.

    Texts are lower-cased (A-Z) and cut into words; a set holds the distinct
    5-word shingles, or the whole sequence of a shorter text. Rows link at
    100 * intersection >= 75 * union. Null texts and texts without words have
    an empty set and link with nothing. ``component_id`` is the smallest id
    reachable by links, null if all ids in the component are null. Returns
    (doc_id, n_shingles, component_id, n_copies, component, row, k1, k2):
    n_copies counts the rows with an equal set, ``component`` is unique to a
    component (ids may repeat), ``row`` to a row, and k1 and k2 hash id and
    text.

    Equal sets are one class from the start. Rows that share a signature
    form groups; a pair links only if the weight of what it shares exceeds
    the spare weight of its scheme. Groups of up to ``HOT`` rows are compared pair by pair.
    Larger ones, as passages in many texts make, are left out for every row
    that has other signatures enough (T = -1 for these segments); the others,
    as near copies have, are verified against the group's first member, then
    a few times with one member for each component. Hot groups that still
    span several components are looked at again, through an index of their
    members' rarest shingles by band of size, of which linked sets share one
    at a place after which both still hold what they need to share. So a group of near copies costs as many checks as it has members,
    and no link between different sets is missed.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kind 0: of each row its number, set hash, size, keys and histogram; kind 1: signatures by part.

        The histogram counts the elements by 8 bits of their hash, up to 127:
        two sets differ by at least the sum of its differences.
        """
        words = Words()
        row = TaskContext.get().partitionId() << 33
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 8192):
                piece = batch.slice(lo, 8192)
                for first, last, data, offsets in text_blocks(piece.column(1)):
                    h, text = shingle_sets(*words(data, offsets))
                    count = last - first
                    sizes = np.bincount(text, minlength=count)
                    ends = np.cumsum(sizes)
                    total = lambda v: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])[np.concatenate([[0], ends])])
                    s1, s2 = total(mix(h + _A)).view(np.int64), total(mix(h ^ _A)).view(np.int64)
                    bins = np.bincount(text * HISTOGRAM + (h >> np.uint64(56)).astype(np.int64), minlength=count * HISTOGRAM)
                    bins = np.minimum(bins, 127).astype(np.int8)
                    histogram = pa.ListArray.from_arrays(np.arange(0, count * HISTOGRAM + 1, HISTOGRAM, dtype=np.int32), pa.array(bins))
                    part_of_piece = piece.slice(first, count)
                    columns = [
                        part_of_piece.column(0), pa.array(np.arange(row, row + count)), pa.array(s1), pa.array(s2), pa.array(sizes.astype(np.int64)),
                        part_of_piece.column(2), part_of_piece.column(3), histogram,
                    ]
                    parted = pa.array((np.arange(row, row + count) % parts).astype(np.int32))
                    fill = [pa.nulls(count, type=t) for t in (pa.int64(), pa.binary(), pa.binary())]
                    yield pa.RecordBatch.from_arrays([*columns, parted, pa.array(np.zeros(count, dtype=np.int32)), *fill], names=names)
                    fresh = np.zeros(count, dtype=bool)
                    for i, pair in enumerate(zip(s1.tolist(), s2.tolist())):
                        if sizes[i] and pair not in seen:
                            seen.add(pair)
                            fresh[i] = True
                    keep = fresh[text]
                    out = list(signatures(h[keep], text[keep], np.where(fresh, sizes, 0)))
                    if out:
                        name, owner, marks = (np.concatenate(x) for x in zip(*out))
                        owner = (owner | marks).astype(np.uint16)
                        part = ((name >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                        low = name.astype(np.uint32)
                        sent = [(p, low[at].tobytes(), owner[at].tobytes()) for p, at in split(part, parts)]
                        n = len(sent)
                        blank = [pa.nulls(n, type=c.type) for c in columns]
                        p, a, b = zip(*sent)
                        packed = [pa.array(p, type=pa.int32()), pa.array([1] * n, type=pa.int32()), pa.array([row] * n, type=pa.int64())]
                        packed += [pa.array(x, type=pa.binary()) for x in (a, b)]
                        yield pa.RecordBatch.from_arrays([*blank, *packed], names=names)
                    row += count

    own = ["id", "row", "s1", "s2", "n", "k1", "k2", "histogram"]
    names = [*own, "part", "kind", "block", "a", "b"]
    slim_schema = f"id {id_type}, row long, s1 long, s2 long, n long, k1 long, k2 long, histogram array<tinyint>"
    indexed = rows.select("id", "text", "k1", "k2").mapInArrow(index, f"{slim_schema}, part int, kind int, block long, a binary, b binary")

    def groups(key: tuple, table: pa.Table) -> pa.Table:
        """Kind 0 passes; of kind 1: (row, bucket, many, step, weight) of rows that share a signature.

        Groups with the same rows come once, with their weights summed.
        """
        extra = {"bucket": pa.int64(), "many": pa.int64(), "step": pa.int64(), "weight": pa.int64()}
        passed = table.filter(pa.compute.equal(table["kind"], 0)).select(own)
        for c, t in extra.items():
            passed = passed.append_column(c, pa.nulls(len(passed), type=t))
        found = unpack(table, 1, (np.uint32, np.uint16))
        if not found:
            return passed
        name = np.concatenate([a for _, a, _ in found])
        owner = np.concatenate([b for _, _, b in found])
        row = np.repeat([block for block, _, _ in found], [len(a) for _, a, _ in found]) + (owner & PLACE)
        order = np.lexsort((owner & DELETED, row, name))
        name, row, owner = name[order], row[order], owner[order]
        at = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (row[1:] != row[:-1])]))  # a row may emit a signature both ways
        name, row, owner = name[at], row[at], owner[at]
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        size = np.diff(np.append(first, len(name)))
        good = (size > 1) & np.logical_or.reduceat((owner & DELETED) == 0, first)  # two deletions alone prove nothing
        bucket = np.add.reduceat(mix(row.astype(np.uint64) * _A + np.uint64(7)), first) + ((owner[first] & NEXT) > 0).astype(np.uint64)
        member = np.repeat(good, size)
        bucket, many, row, owner = np.repeat(bucket, size)[member], np.repeat(size, size)[member], row[member], owner[member]
        order = np.lexsort((row, bucket))
        bucket, many, row, owner = bucket[order], many[order], row[order], owner[order]
        if not len(row):
            return passed
        at = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])]))
        weight = np.add.reduceat(1 + ((owner & NEAR) > 0).astype(np.int64), at)
        step = ((owner[at] & NEXT) > 0).astype(np.int64)
        made = {"row": row[at], "bucket": bucket[at].view(np.int64), "many": many[at].astype(np.int64), "step": step, "weight": weight}
        columns = [pa.array(made[f.name]) if f.name in made else pa.nulls(len(at), type=f.type) for f in passed.schema]
        return pa.concat_tables([passed, pa.table(columns, schema=passed.schema)])

    grouped = indexed.groupBy("part").applyInArrow(groups, f"{slim_schema}, bucket long, many long, step long, weight long")
    grouped = scratch(grouped, "jaccard-groups")
    slim = grouped.filter("bucket is null").select(*own)
    totals = {"sid": (F.min("row"), "min"), "copies": (F.count(F.lit(1)), "sum")}
    classed = scratch(with_totals(slim.filter("n > 0").select("row", "s1", "s2"), ["s1", "s2"], totals, ["row"]).select("row", "sid", "copies"), "jaccard-classes")

    # A linked pair shares signatures of more than its scheme's spare weight. So a row whose groups weigh no more
    # links with no other set; and a row whose hot groups weigh no more shares a smaller group with each of its
    # partners and needs no hot one.
    shared = grouped.filter("bucket is not null").select("row", "bucket", "many", "step", "weight")
    spare = F.array(*[F.lit(s.spare if s else 0) for s in SCHEMES])
    weights = shared.groupBy("row", "step").agg(
        F.sum("weight").alias("total"), F.sum(F.when(F.col("many") > HOT, F.col("weight")).otherwise(0)).alias("heat")
    )
    weights = weights.join(slim.select("row", "n"), "row").join(classed.select("row", "sid"), "row")
    limit = F.element_at(spare, (F.length(F.bin("n")) + F.col("step")).cast("int"))
    strong = weights.filter(F.col("total") > limit).select("row", "step", "sid", "heat", limit.alias("limit"))
    strong = scratch(strong, "jaccard-strong")
    kept = shared.join(strong, ["row", "step"])
    small = kept.filter(F.col("many") <= HOT).groupBy("bucket", "sid").agg(F.sum("weight").alias("weight"))
    small = scratch(small, "jaccard-small")
    # Of the others, each row leaves out its hottest groups, all in one order, up to the spare weight: two rows that
    # share more than that both keep the last of the groups they share.
    hottest = Window.partitionBy("row", "step").orderBy(F.col("many").desc(), "bucket").rowsBetween(Window.unboundedPreceding, 0)
    needed = kept.filter((F.col("many") > HOT) & (F.col("heat") > F.col("limit"))).withColumn("upto", F.sum("weight").over(hottest))
    large = scratch(needed.filter(F.col("upto") > F.col("limit")).select("bucket", "sid").distinct(), "jaccard-large")
    leads = large.groupBy("bucket").agg(F.min("sid").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    large = scratch(large.join(leads, "bucket"), "jaccard-hot")  # an inner join, which AQE splits where a group is hot

    x = small.select("bucket", F.col("sid").alias("a"), F.col("weight").alias("wa"))
    y = small.select("bucket", F.col("sid").alias("b"), F.col("weight").alias("wb"))
    pairs = x.join(y, "bucket").filter("a < b")  # HOT * (HOT - 1) / 2 for a group, at most
    pairs = pairs.groupBy("a", "b").agg(F.sum(F.greatest("wa", "wb")).alias("weight"))
    stars = large.filter("sid != lead").select(F.col("lead").alias("a"), F.col("sid").alias("b")).distinct()
    heat = strong.groupBy("sid").agg(F.max("heat").alias("heat"))
    about = slim.select(F.col("row").alias("sid"), "n", "histogram", "k1", "k2")
    sizes = scratch(about.select("sid", "n").join(heat, "sid"), "jaccard-sizes")  # every set that a pair can name

    def sized(pairs: DataFrame) -> DataFrame:
        """``pairs`` with the sizes and heats of both, where the sizes allow a link."""
        for side in "ab":
            pairs = pairs.join(sizes.select(F.col("sid").alias(side), F.col("n").alias(f"n{side}"), F.col("heat").alias(f"heat{side}")), side)
        return pairs.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)

    def possible(pairs: DataFrame) -> DataFrame:
        """``pairs`` whose histograms allow a link."""
        pairs = pairs.select("a", "b", "na", "nb")
        for side in "ab":
            pairs = pairs.join(about.select(F.col("sid").alias(side), F.col("histogram").alias(f"h{side}")), side)
        differ = F.aggregate(F.zip_with("ha", "hb", lambda u, v: F.abs(u - v).cast("int")), F.lit(0), lambda t, u: t + u)
        return pairs.filter(differ * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)).select("a", "b", "na", "nb")

    band = F.length(F.bin(F.greatest("na", "nb")))
    enough = F.col("weight") + F.least("heata", "heatb") > F.element_at(spare, band.cast("int"))
    pairs = sized(pairs).filter(enough).drop("weight").unionAll(sized(stars)).distinct()
    pairs = scratch(possible(pairs), "jaccard-pairs")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        seen: set[int] = set()  # equal rows are neighbours: they meet in a task, but for one that AQE splits
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                h, text = shingle_sets(*words(data, offsets))
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=last - first))])
                sid = batch.column(0).slice(first, last - first)
                lists = pa.LargeListArray.from_arrays(ends, pa.array(h.view(np.int64))).cast(pa.list_(pa.int64()))
                once = [s not in seen and not seen.add(s) for s in sid.to_pylist()]
                yield pa.RecordBatch.from_arrays([sid, lists], names=["sid", "elements"]).filter(pa.array(once, type=pa.bool_()))

    asked = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select("b")).unionAll(large.select("sid")).distinct()
    asked = scratch(asked.join(about.select("sid", "k1", "k2"), "sid"), "jaccard-asked")
    sieve = asked.select(F.pmod("k1", F.lit(SIEVE)).alias("sieve")).distinct()  # SIEVE rows at most
    thin = rows.select("k1", "k2", "text", F.pmod("k1", F.lit(SIEVE)).alias("sieve")).join(F.broadcast(sieve), "sieve", "left_semi")
    chosen = thin.join(asked, ["k1", "k2"]).select("sid", "text")
    sets = scratch(chosen.mapInArrow(elements, "sid long, elements array<long>"), "jaccard-sets")
    links = scratch(_linked(pairs, sets), "jaccard-links")
    labels = connected_components(links)

    # The memberships of hot groups meet the components once; what the turns need of them is a row for each component
    # of a group, with a member for each turn, and such rows merge as their components do.
    def relabelled(df: DataFrame, node: str, labels: DataFrame) -> DataFrame:
        of = labels.select(F.col("node").alias(node), F.col("component").alias("in"))
        return df.join(of, node, "left").withColumn("component", F.coalesce("in", node)).drop("in")

    picks = [f"pick{turn}" for turn in range(TURNS)]
    drawn = [F.min(F.struct(F.xxhash64("sid", F.lit(turn)).alias("drawn"), "sid")).alias(pick) for turn, pick in enumerate(picks)]
    ones = relabelled(large.select("bucket", "sid"), "sid", labels).groupBy("bucket", "component").agg(*drawn, F.count(F.lit(1)).alias("size"))
    ones = scratch(ones, "jaccard-ones")
    for pick in picks:  # a member of the largest component against one of each other component
        one = ones.select("bucket", "component", "size", F.col(f"{pick}.sid").alias("one"))
        most = one.groupBy("bucket").agg(F.max(F.struct("size", "component", "one")).alias("most"), F.count(F.lit(1)).alias("components"))
        one = one.join(most.filter("components > 1"), "bucket").filter("component != most.component")
        turned = one.select(F.least("one", "most.one").alias("a"), F.greatest("one", "most.one").alias("b")).distinct()
        new = scratch(_linked(scratch(possible(sized(turned)), "jaccard-turned"), sets), "jaccard-links")
        if new.isEmpty():
            break
        links = scratch(links.unionAll(new), "jaccard-links")
        labels = connected_components(links)
        merged = [F.min(p).alias(p) for p in picks]
        ones = relabelled(ones, "component", labels).groupBy("bucket", "component").agg(*merged, F.sum("size").alias("size"))
        ones = scratch(ones, "jaccard-ones")
    several = ones.groupBy("bucket").agg(F.count(F.lit(1)).alias("components")).filter("components > 1").select("bucket")
    members = large.join(several, "bucket", "left_semi").select("sid").distinct()
    open_ = scratch(relabelled(members, "sid", labels), "jaccard-open")
    if not open_.isEmpty():
        each = scratch(open_.join(sets.dropDuplicates(["sid"]), "sid").select("sid", "component", F.explode("elements").alias("element")), "jaccard-elements")
        counted = with_totals(each, ["element"], {"df": (F.count(F.lit(1)), "sum")}, ["sid"])
        ordered = counted.groupBy("sid", "component").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("all"))  # one set
        prefix = F.size("all") - F.ceil(F.size("all") * F.lit(PERCENT) / F.lit(100)).cast("int") + 1
        # bands of sizes 4/3 apart: linked sets are at most a band apart
        banded = ordered.withColumn("size", F.size("all")).withColumn("band", F.floor(F.log("size") / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int"))
        heads = banded.select("sid", "component", "size", "band", F.posexplode(F.slice("all", 1, prefix)).alias("place", "one")).filter("one.df > 1")
        heads = scratch(heads.select("one.element", "sid", "component", "size", "band", "place"), "jaccard-heads")
        side = lambda s: [F.col(c).alias(f"{c}{s}") for c in ("size", "place", "component")]
        x = heads.select("element", "band", F.col("sid").alias("a"), *side("a"))
        near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
        y = heads.select("element", near, F.col("sid").alias("b"), *side("b"))
        # at the first element that linked sets share, what follows in either must still hold all they need to share
        need = F.lit(PERCENT) * (F.col("sizea") + F.col("sizeb"))
        left = F.least(F.col("sizea") - F.col("placea"), F.col("sizeb") - F.col("placeb"))
        fits = (F.col("a") < F.col("b")) & (F.col("componenta") != F.col("componentb")) & (left * (100 + PERCENT) >= need)
        more = x.join(y, ["element", "band"]).filter(fits).select("a", "b").distinct()
        links = links.unionAll(scratch(_linked(scratch(possible(sized(more)), "jaccard-more"), sets), "jaccard-links"))
        labels = connected_components(links)

    placed = slim.select("id", "row", "n", "k1", "k2").join(classed, "row", "left").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    placed = scratch(placed.select("id", "row", "n", "k1", "k2", "copies", F.coalesce("component", "sid", "row").alias("component")), "jaccard-placed")
    least = with_totals(placed, ["component"], {"component_id": (F.min("id"), "min")}, ["row"])
    return least.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.coalesce("copies", F.lit(1)).alias("n_copies"),
        "component", "row", "k1", "k2",
    )


def dedup_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near duplicates, with all its columns: the one with the smallest id (null ids last).

    Rows without words link with nothing, so all of them stay, also those with equal id and text.
    """
    names = docs.columns
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "k1", "k2"))
    kept = near_duplicates(docs, id_col, text_col).filter("n_shingles > 0").groupBy("component").agg(first.alias("first")).select("first.k1", "first.k2")
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, t = (F.col(f"_c{names.index(c)}") for c in (id_col, text_col))
    rows = plain.withColumns({"k1": F.xxhash64(i, t), "k2": F.xxhash64(t, i, F.lit(1))})
    worded = F.coalesce(t.rlike(WORD_CLASS), F.lit(False))
    one = rows.filter(worded).join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*plain.columns)
    return one.unionAll(plain.filter(~worded)).toDF(*names)
