"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  Each positive opens a window of scores, from ``lower`` to ``upper``
hundredths of its own, and wants the best rows of other labels inside.  Windows of one anchor overlap, so they are not searched one by
one: the positives' upper limits, in descending order, split the scores into disjoint slots, and slot j reaches from limit j down to limit j + 1.
Blocks of rows keep the best few of each slot (the combiner), a row-number window merges the blocks, and the answer for positive j
is the best of slots j, j + 1, ...: one descending merge of at most slots * few candidates answers all windows, since a window's lower end only cuts its tail.

Anchors meet all rows in blocks: a grid of anchor blocks and row blocks, each cell one task's product of two matrices.  Rows are sent once to
every anchor block, anchors once to every row block.  Blocks are dealt by a row's number in the written table, so repeated ids or vectors make no block larger.

Scores are exact integers: a product of matrices runs in doubles while no sum can reach 2**53, in 64-bit integers below 2**63, and in
Python integers beyond; scores outside 64 bits then count as the nearest 64-bit number.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of another length
than the anchor's do not meet it; rows that share the anchor's id are neither its positives nor its negatives; repeated rows take part as often as they stand there, equal scores
come in order of id; an anchor without positives, or a positive whose window is empty, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Stages

#: Anchors and rows of a cell on average at most, row blocks that a small table is dealt to, and scores of a cell in memory at a time.
ANCHORS, ROWS, SPREAD, SCORES = 8192, 8192, 64, 1 << 20
MOST = (1 << 63) - 1
#: No score; smaller than all.
NONE = -MOST - 1


class Block:
    """Rows of one block in order of id: number, id, label and vector of whole numbers, held in doubles."""

    def __init__(self, table: pa.Table):
        self.table = table = table.sort_by([("id", "ascending"), ("seq", "ascending")]).combine_chunks()
        self.seq, self.id, self.label = (table[c].to_numpy() for c in ("seq", "id", "label"))
        lists = table["q"].combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        self.rows = [flat[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
        length = np.diff(at)
        reach = np.array([np.abs(r).max(initial=0) for r in self.rows])
        #: (length, largest component, places, matrix) of rows of one length and about one size
        self.groups = []
        for d in np.unique(length):
            for low, high in ((-1, 2.0**20), (2.0**20, 2.0**28), (2.0**28, np.inf)):
                at = np.flatnonzero((length == d) & (reach > low) & (reach <= high))
                if len(at):
                    self.groups.append((int(d), int(reach[at].max()), at, np.stack([self.rows[i] for i in at])))


def products(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, no larger than ``most`` in size, within 64 bits."""
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if most <= MOST:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in r] for r in b]
    return np.array([[min(max(sum(x * y for x, y in zip(left, r, strict=True)), -MOST), MOST) for r in whole] for left in ([int(x) for x in r] for r in a)], dtype=np.int64)


def scored(anchors: Block, rows: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of all pairs of equal length and unequal id: places of anchors and rows, scores, and whether labels are equal; NONE where ids are equal."""
    for d, a_most, ai, am in anchors.groups:
        for e, r_most, ri, rm in rows.groups:
            step = max(1, SCORES // len(ri))
            for s in range(0, len(ai) if d == e else 0, step):
                at = ai[s : s + step]
                score = products(am[s : s + step], rm, d * a_most * r_most)
                score[anchors.id[at][:, None] == rows.id[ri][None]] = NONE
                yield at, ri, score, anchors.label[at][:, None] == rows.label[ri][None]


def best(score: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``few`` largest scores of each row, leftmost on ties, NONE apart."""
    n = score.shape[1]
    least = np.partition(score, n - few, axis=1)[:, n - few] if n > few else np.full(len(score), NONE)
    over = score > least[:, None]
    tied = (score == least[:, None]) & (score != NONE)
    tied &= np.cumsum(tied, axis=1) <= few - over.sum(axis=1)[:, None]
    return np.nonzero(over | tied)


def _columns(**columns: list[np.ndarray]) -> pa.Table:
    return pa.table({k: pa.array(np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64)) for k, v in columns.items()})


def positives_of_cell(few: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The combiner of positives: the best ``few`` rows of a block with each anchor's label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = Block(left), Block(right)
        a, score, id_ = [], [], []
        for ai, ri, s, same in scored(anchors, rows):
            s[~same] = NONE
            r, c = best(s, few)
            a.append(anchors.seq[ai][r])
            score.append(s[r, c])
            id_.append(rows.id[ri][c])
        return _columns(a=a, score=score, id=id_)

    return run


def negatives_of_cell(few: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The combiner of negatives: the best ``few`` rows of a block with another label, for each slot of each anchor."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = Block(left), Block(right)
        limits = anchors.table["limits"].to_pylist()
        slots = max(map(len, limits), default=0)
        # shorter lists repeat their last limit: the slots between equal limits are empty, and the last has the rest
        limits = np.array([[*u, *u[-1:] * (slots - len(u))] for u in limits], dtype=np.int64).reshape(len(limits), slots)
        lowest = anchors.table["lowest"].to_numpy()
        a, slot, score, id_ = [], [], [], []
        for ai, ri, s, same in scored(anchors, rows):
            r, c = np.nonzero(~same & (s != NONE) & (s <= limits[ai][:, :1]) & (s >= lowest[ai][:, None]))
            s = s[r, c]
            k = (s[:, None] <= limits[ai][r]).sum(axis=1) - 1
            order = np.lexsort((c, -s, k, r))
            r, c, s, k = r[order], c[order], s[order], k[order]
            # place within (anchor, slot): a row few places back is of another one
            keep = np.ones(len(r), bool)
            keep[few:] = (r[few:] != r[:-few]) | (k[few:] != k[:-few])
            a.append(anchors.seq[ai][r[keep]])
            slot.append(k[keep])
            score.append(s[keep])
            id_.append(rows.id[ri][c[keep]])
        return _columns(a=a, slot=slot, score=score, id=id_)

    return run


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component as doubles, x as double; null unless all components are finite, also when scaled."""
    times = F.transform(vector, lambda x: x.cast("double") * F.lit(scale))
    finite = F.forall(times, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite, F.transform(times, lambda x: F.rint(x) - (F.rint(x) > x).cast("double")))


def hard_negatives(
    df: DataFrame, stages: Stages, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95, scale: float = 256.0,
) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on columns of ``df``.  A positive's window reaches from ``lower`` to ``upper`` hundredths of its score.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), whole_numbers(F.col(vector), scale).alias("q"), is_anchor.alias("is_anchor"))
    rows = stages.save(rows.where("id is not null and label is not null and q is not null"), "rows")
    # numbered as the written table is read, so a task that runs again numbers its rows alike
    rows = stages.save(rows.withColumn("seq", F.monotonically_increasing_id()), "numbered")
    stages.drop("rows", collect=False)
    n, anchors = rows.count(), rows.where("is_anchor").drop("is_anchor")
    across, down = -(-max(1, anchors.count()) // ANCHORS), max(1, -(-n // ROWS), min(SPREAD, n // 256))
    block = F.xxhash64(F.lit(7), "seq")
    by_cell = (
        rows.select("seq", "id", "label", "q", F.pmod(block, F.lit(down)).alias("j"))
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
    )

    def cells(asked: DataFrame, combiner: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long")))
        left = asked.withColumn("i", F.pmod(block, F.lit(across))).withColumn("j", every)
        return left.groupBy("i", "j").cogroup(by_cell.groupBy("i", "j")).applyInArrow(combiner, schema)

    def first(found: DataFrame, few: int, *group: str) -> DataFrame:
        ordered = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc("id"))
        return found.withColumn("n", F.row_number().over(ordered)).where(F.col("n") <= few)

    near = first(cells(anchors, positives_of_cell(positives), "a long, score long, id long"), positives, "a")
    share = "cast(least(greatest({0}(cast(score as decimal(20, 0)) * {1} / 100), -9223372036854775807), 9223372036854775807) as long)"
    near = near.withColumn("high", F.expr(share.format("floor", upper))).withColumn("low", F.expr(share.format("ceil", lower)))
    chosen = near.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("n", "score", "id", "high", "low"))).alias("p"))
    chosen = stages.save(anchors.join(chosen, anchors["seq"] == chosen["a"]).select("seq", "id", "label", "q", "p"), "positives")

    asked = chosen.select("seq", "id", "label", "q", F.col("p.high").alias("limits"), F.array_min("p.low").alias("lowest"))
    far = first(cells(asked, negatives_of_cell(negatives), "a long, slot long, score long, id long"), negatives, "a", "slot")
    # slots are disjoint, so one list by descending score holds the suffix of slots from any j on as its tail
    listed = far.groupBy("a").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "slot"))).alias("c"))
    merged = chosen.join(listed, chosen["seq"] == listed["a"]).select("id", "c", F.explode("p").alias("p"))
    tail = f"slice(filter(c, x -> x.slot >= p.n - 1), 1, {int(negatives)})"
    hits = merged.select("id", "p", F.posexplode(F.expr(f"filter({tail}, x -> -x.minus >= p.low)")).alias("at", "x"))
    return hits.select(
        F.col("id").alias("anchor_id"), F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), (-F.col("x.minus")).alias("negative_score"),
    )
