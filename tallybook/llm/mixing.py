"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (expected copies) between 0 and the cap.  Among all rates that meet the token target of each
source, entropy balancing takes those closest to one copy of everything, documents as base
measure: minimise sum(r * log(r) - r + 1) subject to sum(size * r) = target.  Their form is an exponential tilt by a document's
own tokens, r = exp(lambda of the source * size), held at the cap: a source that must shrink gives up
its long documents first, one that must grow repeats them.  The convex dual has one multiplier per source; Newton steps on it use
gradient and curvature that Spark sums over all documents in each round, kept between bounds that hold the solution.

Rates become copies: floor(r), and one more for documents whose id hash lies below the rest of their rate, shifted by a level of
each source, found by two rounds of histograms over all documents, so that taken tokens meet
the target up to about one document.  Reruns give the same copies.

Only one row per source reaches the driver.  Defined cases: a null text has size 0; a null source is a
source of its own, last in order; documents of size 0 have rate 1 (0 where the target is 0) and take nothing; texts of any length count whole; null ids share
one hash; repeated rows and other ties are separate documents of equal rate and copies; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Stages

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SLOTS = 4096
#: Broadcast the per-source table only up to so many sources (about 100 bytes each).
BROADCAST_SOURCES = 50_000


def capped_targets(sizes: list[int], weights: list[float], budget: float, cap: float = CAP) -> list[float]:
    """Shares of the budget by weight; none above cap * size, the excess going to the others by weight."""
    targets, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = cap * sizes[i]
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def _beside(spark, rows: list[tuple], schema: str) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_SOURCES else df


def _rate(lam: str, size: str, unit: str, cap: float) -> str:
    """SQL: the tilted rate; its exponent is held where it overflows nothing and rounds to 0."""
    return f"least(exp(greatest(-700D, least({lam} * {size} / {unit}, 700D))), {cap}D)"


def balance(sized: DataFrame, targets: dict, units: dict, cap: float = CAP, rounds: int = 60) -> dict:
    """The dual multiplier of each source; ``sized`` has (source, size), targets and mean sizes are by source.

    The tokens taken grow with the multiplier, so every round narrows the bounds; a Newton step that leaves them is halved to
    their middle.  A source whose documents all stand at the cap, or whose target is all its tokens, needs no tilt.
    """
    spark = sized.sparkSession
    bounds = {s: [-math.inf, math.inf] for s in targets}
    lam = {s: 0.0 for s in targets}
    open_ = {s for s in targets if targets[s] > 0}
    for _ in range(rounds):
        if not open_:
            break
        tilt = _beside(spark, [(s, lam[s], units[s]) for s in open_], "s string, lam double, unit double")
        rate = _rate("lam", "size", "unit", cap)
        sums = sized.join(tilt, F.expr("source <=> s")).groupBy("s").agg(
            F.sum(F.expr(f"size * {rate}")).alias("taken"), F.sum(F.expr(f"case when {rate} < {cap}D then size * size / unit * {rate} else 0D end")).alias("curve"),
        ).collect()
        for s, taken, curve in sums:
            gap, at = targets[s] - taken, lam[s]
            if abs(gap) <= 1e-9 * targets[s] or at > 600:
                open_.discard(s)
                continue
            bounds[s][0 if gap > 0 else 1] = at
            low, high = bounds[s]
            step = gap / curve if curve > 0 else math.copysign(1.0, gap)
            new = at + max(-4.0, min(4.0, step))
            if not low < new < high:
                new = (low + high) / 2 if math.isfinite(low + high) else at + math.copysign(1.0, gap) * max(1.0, abs(at))
            if new == at:
                open_.discard(s)
            lam[s] = new
    return lam


def mix(df: DataFrame, stages: Stages, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, cap: float = CAP, share: float = 1.0, keep=()) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, rate, copies, taken, then the columns in ``keep``."""
    spark = df.sparkSession
    sized = stages.save(
        df.select(
            F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            (F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string")), 11) / F.lit(float(1 << 53))).alias("u"),
            *(F.col(c).alias(f"keep_{c}") for c in keep),
        ), "sized",
    )
    sums = sized.groupBy("source").agg(F.sum("size"), F.count_if(F.col("size") > 0)).collect()
    sums.sort(key=lambda r: (r[0] is None, r[0] or ""))
    names, sizes, counts = [r[0] for r in sums], [int(r[1]) for r in sums], [int(r[2]) for r in sums]
    wanted = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share * sum(sizes), cap)
    units = {s: max(size / max(n, 1), 1.0) for s, size, n in zip(names, sizes, counts, strict=True)}
    lam = balance(sized.select("source", "size"), dict(zip(names, wanted, strict=True)), units, cap)
    stages.release()  # the tables of multipliers that were told in the rounds
    rows = [(s, size, target, lam[s] if target < cap * size else 701.0 * units[s], units[s]) for s, size, target in zip(names, sizes, wanted, strict=True)]
    plan = _beside(spark, rows, "s string, source_size long, target double, lam double, unit double")
    rate = f"case when target <= 0 then 0D when size = 0 then 1D else {_rate('lam', 'size', 'unit', cap)} end"
    rated = sized.join(plan, F.expr("source <=> s")).withColumn("rate", F.expr(rate)).drop("lam", "unit")
    # whole rates take no part in rounding; ``z`` orders the others: those of level 0 are drawn with the odds of their rate
    base = F.floor(F.col("rate") + F.lit(1e-9)).cast("int")
    z = F.when((F.col("rate") - base > 1e-9) & (F.col("size") > 0), F.col("u") - (F.col("rate") - base))
    rated = rated.withColumns({"base": base, "z": z})

    # the level of z under which a source's documents get one more copy
    held = {r[0]: (r[1], r[2]) for r in rated.groupBy("s").agg(F.first("target"), F.sum(F.col("base") * F.col("size"))).collect()}
    level, slot_size = {s: (-1.0, max(0.0, target - taken)) for s, (target, taken) in held.items()}, {}
    width = 2.0
    for _ in range(2):
        rows = [(s, lo, need) for s, (lo, need) in level.items() if need > 0]
        if not rows:
            break
        at = _beside(spark, rows, "t string, lo double, need double")
        slot = F.least(F.floor((F.col("z") - F.col("lo")) * (SLOTS / width)), F.lit(SLOTS - 1))
        bars = (
            rated.join(at, F.expr("s <=> t")).where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("lo") + width))
            .groupBy("t", "lo", "need", slot.alias("slot")).agg(F.sum("size").alias("size"))
        )
        # at most SLOTS rows per source
        steps = bars.groupBy("t", "lo", "need").agg(F.array_sort(F.collect_list(F.struct("slot", "size"))).alias("bars"))
        found = steps.selectExpr(
            "t", "lo", "aggregate(bars, named_struct('need', need, 'slot', cast(null as bigint), 'held', cast(0 as bigint)), (a, b) -> case when a.slot is not null then a "
            "when b.size >= a.need then named_struct('need', a.need, 'slot', b.slot, 'held', b.size) "
            "else named_struct('need', a.need - b.size, 'slot', a.slot, 'held', a.held) end) as r",
        ).collect()
        for s, lo, r in found:
            level[s] = (lo + width, 0.0) if r.slot is None else (lo + r.slot * width / SLOTS, r.need)
            slot_size[s] = r.held
        width /= SLOTS
    # the slot in which the target is met joins if that comes nearer to it
    rows = [(s, lo + (width if need > 0 and 2 * need >= slot_size.get(s, 0) else 0.0)) for s, (lo, need) in level.items()]
    copies = F.col("base") + F.when(F.col("z") < F.col("level"), 1).otherwise(0)
    return rated.join(_beside(spark, rows, "t string, level double"), F.expr("s <=> t")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
        *(F.col(f"keep_{c}").alias(c) for c in keep),
    )
