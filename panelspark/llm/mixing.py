"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

from collections.abc import Callable
from math import exp, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

BLOCKS = 256
#: Words as everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def _power_sums(sources: DataFrame, low: float, high: float, steps: int) -> list[tuple[float, float, float]]:
    """(a, sum of t^a, sum of t^a ln t) at evenly spaced exponents, t as a share of the largest source."""
    grid = [low + (high - low) * i / steps for i in range(steps + 1)]
    p = [F.exp(F.lit(a) * F.col("ln")) for a in grid]
    row = sources.agg(*[F.sum(x) for x in p], *[F.sum(x * F.col("ln")) for x in p]).first()
    return [(a, row[i], row[i + len(grid)]) for i, a in enumerate(grid)]


def _bisect(sources: DataFrame, holds: Callable[[float, float, float], bool], rounds: int = 6, steps: int = 32) -> tuple[float, float]:
    """Smallest exponent in [0, 1] for which ``holds``, with its power sum; each round cuts the bracket ``steps`` times."""
    low, high = 0.0, 1.0
    for _ in range(rounds):
        found = _power_sums(sources, low, high, steps)
        ok = next((i for i, x in enumerate(found) if holds(*x)), steps)
        if ok == 0:
            return found[0][:2]
        low, high, best = found[ok - 1][0], found[ok][0], found[ok][:2]
    return best


def mix(
    docs: DataFrame,
    repetition_limit: float = 2.0,
    target_entropy: float | None = None,
    budget: float | None = None,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` mixed to temperature weights: all its columns plus ``mix_*`` ones, a row per copy drawn.

    A source with a share s of all words gets the weight s^a / sum of s^a.
    The exponent a is the smallest in [0, 1] (the flattest mix) whose
    entropy is at most ``target_entropy`` (nats), if given, and under which
    no source is repeated more than ``repetition_limit`` times. ``budget`` is
    the number of words drawn in all; without it, the largest source is drawn
    exactly once and every other one at least once, so no row is lost.

    A source with weight w is drawn r = w * budget / words times: whole
    passes, then a part of one. For the part, its rows fall by hash into 256
    blocks, these into 256 sub-blocks; blocks are taken in the order of a
    seeded permutation while they fit the rest of the budget, then the
    sub-blocks of the first block that does not fit. Hence a source misses
    its budget by less than a sub-block (a row, where those are single rows).

    ``mix_epoch`` counts passes from 1; sorting by ``mix_position`` (0 to 1)
    interleaves the sources at their weights; ``mix_words``, ``mix_weight``
    and ``mix_repetition`` tell a row's words and its source's share and
    draws. Null sources are one source; null and empty texts have no words
    and go with their block; a source without any word is taken once. An
    empty table gives an empty result.

    Rows equal in id, source and text fall into one block together; rows
    without an id are spread by their texts. A ``target_entropy`` below that of
    the plain shares cannot be reached and raises.

    The exponent is found from power sums over one stored row per source, so
    neither rows nor sources pass through the driver.
    """
    names = docs.columns
    c = {k: F.col(f"_c{names.index(v)}") for k, v in (("id", id_col), ("text", text_col), ("source", source_col))}
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    spread = F.xxhash64(F.lit(seed), c["id"], c["source"], c["text"])
    drawn = plain.withColumns(
        {
            "_src": c["source"],
            "_block": F.pmod(spread, F.lit(BLOCKS)).cast("int"),
            "_sub": F.pmod(F.shiftright(spread, 8), F.lit(BLOCKS)).cast("int"),
            "_words": F.coalesce(F.regexp_count(c["text"], F.lit(WORD)), F.lit(0)).cast("long"),
        }
    )
    blocks = scratch(drawn.groupBy("_src", "_block").agg(F.sum("_words").alias("words")), "mix-blocks")
    totals = blocks.groupBy("_src").agg(F.sum("words").alias("words"))
    head = totals.agg(F.max("words").alias("top"), F.sum("words").alias("all")).first()
    top, everything = float(head["top"] or 0), float(head["all"] or 0)
    if top == 0:  # nothing to weigh: every row once
        exponent, power, draw = 1.0, 1.0, 0.0
    else:
        sources = scratch(totals.filter("words > 0").select(F.log(F.col("words") / F.lit(top)).alias("ln")), "mix-sources")
        least = sources.agg(F.min("ln")).first()[0]

        def fits(a: float, s0: float, s1: float) -> bool:
            repeats = exp((a - 1) * least) * (1.0 if budget is None else budget / top / s0)
            flat = target_entropy is None or log(s0) - a * s1 / s0 <= target_entropy + 1e-12
            return flat and repeats <= repetition_limit * (1 + 1e-12)

        if target_entropy is not None:
            _, s0, s1 = _power_sums(sources, 1.0, 1.0, 1)[0]
            if log(s0) - s1 / s0 > target_entropy + 1e-12:
                raise ValueError(f"target_entropy {target_entropy} is below {log(s0) - s1 / s0:.6g}, that of the sources' own shares")
        exponent, power = _bisect(sources, fits)
        # words drawn from the largest source; a budget beyond repetition_limit passes over everything is cut to that
        draw = top if budget is None else min(budget, repetition_limit * everything) / power
    share = F.col("words") / F.lit(top or 1.0)
    ratio = F.when(F.col("words") > 0, F.lit(draw / (top or 1.0)) * F.pow(share, F.lit(exponent - 1))).otherwise(1.0)
    per_source = scratch(
        totals.select(
            "_src",
            ratio.alias("rep"),
            F.floor(ratio + F.lit(1e-9)).cast("int").alias("passes"),
            F.when(F.col("words") > 0, F.pow(share, F.lit(exponent)) / F.lit(power)).otherwise(0.0).alias("weight"),
            F.greatest(F.lit(0.0), (ratio - F.floor(ratio + F.lit(1e-9))) * F.col("words")).alias("rest"),
        ),
        "mix-weights",
    )
    same = lambda x, y: x["_src"].eqNullSafe(y["_src"])

    def fitting(parts: DataFrame, unit: str, room: str) -> DataFrame:
        """``parts`` with the words up to and including each, in its source's permuted order."""
        order = Window.partitionBy("_src").orderBy(F.xxhash64(F.lit(seed + 1), "_src", unit), unit)
        return parts.withColumn("upto", F.sum("words").over(order)).withColumn("fits", F.col("upto") <= F.col(room))

    b = blocks.join(per_source, same(blocks, per_source)).select(blocks["_src"], "_block", "words", "rest")
    b = scratch(fitting(b, "_block", "rest"), "mix-plan")
    cut = b.filter("not fits").groupBy("_src").agg(
        F.min_by("_block", "upto").alias("cut"), (F.first("rest") - F.min(F.col("upto") - F.col("words"))).alias("room")
    )
    cut = scratch(cut, "mix-cut")
    inside = drawn.join(cut, same(drawn, cut) & (drawn["_block"] == cut["cut"])).select(drawn["_src"], "_sub", "_words", "room")
    subs = fitting(inside.groupBy("_src", "_sub").agg(F.sum("_words").alias("words"), F.first("room").alias("room")), "_sub", "room")
    subs = subs.filter("fits").groupBy("_src").agg(F.collect_set("_sub").alias("subs"))  # 256 at most
    whole = b.filter("fits").groupBy("_src").agg(F.collect_set("_block").alias("whole"))
    plan = per_source
    for extra in (whole, cut, subs):
        plan = plan.join(extra, plan["_src"].eqNullSafe(extra["_src"]), "left").drop(extra["_src"])
    plan = scratch(plan.withColumnRenamed("_src", "_key"), "mix-draw")

    part = F.coalesce(F.array_contains("whole", F.col("_block")), F.lit(False)) | (
        F.coalesce(F.col("_block") == F.col("cut"), F.lit(False)) & F.coalesce(F.array_contains("subs", F.col("_sub")), F.lit(False))
    )
    part = part & (F.col("rest") > 0)
    out = drawn.join(plan, drawn["_src"].eqNullSafe(plan["_key"])).withColumn("_times", F.col("passes") + part.cast("int"))
    out = out.filter("_times > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    last = F.when(F.col("mix_epoch") > F.col("passes"), F.col("rep") - F.col("passes")).otherwise(1.0)
    u = F.pmod(F.xxhash64(F.lit(seed + 2), "mix_epoch", c["id"], "_block"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return out.select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)],
        "mix_epoch",
        F.col("_block").alias("mix_block"),
        ((F.col("mix_epoch") - 1 + u * last) / F.greatest("rep", F.lit(1e-300))).alias("mix_position"),
        F.col("_words").alias("mix_words"),
        F.col("weight").alias("mix_weight"),
        F.col("rep").alias("mix_repetition"),
    )
