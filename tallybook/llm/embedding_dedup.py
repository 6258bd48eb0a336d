"""Embedding near-dedup: PCA-ordered tiled comparison with suffix-norm bounds.

Vectors of a label are rotated into principal axes, so that leading dimensions
hold most of every dot product.  Rows sorted by cells of the leading axes are cut into
tiles, so a tile is a small box in them.  Two tiles whose boxes lie near enough meet in one task.  There blocks of both, again only
those of near boxes, add up dot products a few dimensions at a
time; by Cauchy-Schwarz the rest of a product is at most the product of the two
suffix norms, so a pair (then a whole block pair) stops once even that bound stays
below the threshold.  What survives all dimensions is decided by the plain cosine
of the given vectors in double precision.

Equal vectors of a label are compared once and counted with their number.  A task returns
link counts and a spanning forest of its links, never the list of pairs.

Defined cases: a null label, a null or empty vector, null or non-finite components and
zero vectors link with nothing (n_links 0, own component).  Vectors of unequal length
never link; a vector may have any length.  Rows that share an id count as separate vectors and share a component; repeated rows link as copies;
ties go to the least id.  Null ids are kept, with a null component and ``kept`` true.  An empty table gives an empty
result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, join_hot
from .kernels import union_forest
from .tables import Stages

TILE, BLOCK = 2048, 256
STEP = 8
#: Leading axes whose cells order the rows, and the width of a cell; axes of the boxes that are compared.
CELL_AXES, CELL = 4, 0.25
BOX_AXES = 8


def usable(vec: Column, label: Column) -> Column:
    """True where the vector can link at all."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def principal_axes(reps: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, the axes of the second moment of the unit vectors.

    Every partition adds up one d x d matrix; only those sums reach the driver.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, part in pdf.groupby(pdf["v"].map(len)):
                m = _unit(np.stack(part["v"].to_numpy()).astype(np.float64))
                total[d] = total.get(d, 0) + m.T @ m
        for d, m in total.items():
            yield pd.DataFrame({"d": np.full(d, d), "i": np.arange(d), "row": list(m)})

    parts = reps.select("v").mapInPandas(moments, "d int, i int, row array<double>")
    summed = (
        parts.select("d", "i", F.posexplode("row").alias("j", "x"))
        .groupBy("d", "i", "j").agg(F.sum("x").alias("x")).toPandas()
    )
    axes = {}
    for d, part in summed.groupby("d"):
        m = np.zeros((d, d))
        m[part["i"], part["j"]] = part["x"]
        _, vectors = np.linalg.eigh((m + m.T) / 2)
        axes[int(d)] = vectors[:, ::-1].copy()
    return axes


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks of rotated unit vectors whose bound never fell below the threshold."""
    least, d = threshold - 1e-9, a.shape[1]
    rest_a = np.sqrt(np.maximum(np.cumsum(a[:, ::-1] ** 2, axis=1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum(b[:, ::-1] ** 2, axis=1)[:, ::-1], 0))
    dot = np.zeros((len(a), len(b)))
    i = j = None
    for lo in range(0, d, step):
        hi = min(lo + step, d)
        if i is None:
            dot += a[:, lo:hi] @ b[:, lo:hi].T
            bound = dot + np.outer(rest_a[:, hi], rest_b[:, hi]) if hi < d else dot
            alive = bound >= least
            count = int(alive.sum())
            if count == 0:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if count * 16 < dot.size:
                i, j = np.nonzero(alive)
                part = dot[i, j]
        else:
            part = part + np.einsum("ij,ij->i", a[i, lo:hi], b[j, lo:hi])
            bound = part + rest_a[i, hi] * rest_b[j, hi] if hi < d else part
            alive = bound >= least
            i, j, part = i[alive], j[alive], part[alive]
            if len(i) == 0:
                return i, j
    return np.nonzero(dot >= least) if i is None else (i, j)


def near_blocks(wa: np.ndarray, wb: np.ndarray, far: float, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Starts of block pairs of two tiles whose boxes are at most ``far`` apart (squared distance)."""

    def boxes(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(w), size)
        return np.minimum.reduceat(w[:, :BOX_AXES], at), np.maximum.reduceat(w[:, :BOX_AXES], at)

    (lo_a, hi_a), (lo_b, hi_b) = boxes(wa), boxes(wb)
    gap = np.maximum(0, np.maximum(lo_a[:, None] - hi_b[None], lo_b[None] - hi_a[:, None]))
    for x, y in zip(*np.nonzero((gap * gap).sum(axis=2) <= far)):
        yield int(x) * size, int(y) * size


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to about one: cosines stay the same, and no square leaves the range of doubles."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0))[1][:, None])


def embedding_links(df: DataFrame, stages: Stages, vec_id="vec_id", embedding="embedding", label="label", threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = dict(df.dtypes)[embedding]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    width = np.float32 if kind == "array<float>" else np.float64
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast(kind).alias("v"))
    rows = rows.withColumn("ok", usable(F.col("v"), F.col("label")))
    # 128 bits that stand for a label and a vector
    rows = rows.withColumns({k: F.when(F.col("ok"), F.xxhash64(F.lit(i), "label", "v")) for i, k in enumerate(("k1", "k2"))})
    reps = stages.save(
        rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("node", F.monotonically_increasing_id()), "reps",
    )
    axes = principal_axes(reps)

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf["v"].map(len)):
                w = _unit(np.stack(part["v"].to_numpy()).astype(np.float64)) @ axes[d]
                cells = np.zeros((len(w), CELL_AXES), np.int32)
                cells[:, : min(d, CELL_AXES)] = np.floor(w[:, :CELL_AXES] / CELL)
                yield pd.DataFrame({"node": part["node"], "d": d, "label": part["label"], "m": part["m"], "v": part["v"], **{f"c{i}": cells[:, i] for i in range(CELL_AXES)}})

    tag = dict(reps.dtypes)["label"]
    order = ["label", "d", *(f"c{i}" for i in range(CELL_AXES)), "node"]
    turned = reps.mapInPandas(rotate, f"node long, d int, label {tag}, m long, v {kind}, " + ", ".join(f"c{i} int" for i in range(CELL_AXES)))
    turned = turned.repartitionByRange(*order).sortWithinPartitions(*order)

    # A tile is a run of rows of one label within one range partition.
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def tiles(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for (lab, d), part in pdf.groupby(["label", "d"], sort=False):
                for s in range(0, len(part), tile):
                    p = part.iloc[s : s + tile]
                    v = np.stack(p["v"].to_numpy()).astype(width)
                    w = (_unit(v.astype(np.float64)) @ axes[d])[:, :BOX_AXES]
                    yield pd.DataFrame({"label": [lab], "d": [d], "lo": [w.min(axis=0)], "hi": [w.max(axis=0)], "nodes": [p["node"].to_numpy(np.int64).tobytes()], "ms": [p["m"].to_numpy(np.int64).tobytes()], "v": [v.tobytes()]})

        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= 4 * tile:
                yield from tiles(pd.concat(held))
                held = []
        if held:
            yield from tiles(pd.concat(held))

    cuts = stages.save(
        turned.mapInPandas(cut, f"label {tag}, d int, lo array<double>, hi array<double>, nodes binary, ms binary, v binary")
        .withColumn("tile", F.monotonically_increasing_id()), "tiles",
    )
    # Squared distance of unit vectors that link is at most 2 - 2 * threshold.
    far = 2 - 2 * threshold + 1e-9
    # boxes of one label meet in several tasks: one side is dealt out, the other copied to each
    box = cuts.select("tile", "label", "d", "lo", "hi")
    box = box.join(box.groupBy("label", "d").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts")), ["label", "d"])
    one = box.withColumn("part", F.pmod(F.xxhash64("tile"), F.col("parts")).cast("int"))
    every = box.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    gap = "aggregate(sequence(0, size(a.lo) - 1), 0D, (s, k) -> s + pow(greatest(0D, a.lo[k] - b.hi[k], b.lo[k] - a.hi[k]), 2))"
    pairs = (
        one.alias("a").join(every.alias("b"), F.expr(f"a.label = b.label and a.d = b.d and a.part = b.part and a.tile <= b.tile and {gap} <= {far}"))
        .select(F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb"))
    )
    whole = cuts.select("tile", "d", "nodes", "ms", "v")
    met = (
        pairs.join(whole.select(*[F.col(c).alias(f"{c}_a") for c in whole.columns]), F.col("ta") == F.col("tile_a"))
        .join(whole.select(*[F.col(c).alias(f"{c}_b") for c in whole.columns]), F.col("tb") == F.col("tile_b"))
        .drop("tile_a", "tile_b", "d_b")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                va, vb = (_scaled(np.frombuffer(x, width).reshape(-1, r.d_a).astype(np.float64)) for x in (r.v_a, r.v_b))
                (ka, ma), (kb, mb) = ((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)) for x, y in ((r.nodes_a, r.ms_a), (r.nodes_b, r.ms_b)))
                ua, ub = _unit(va), _unit(vb)
                wa, wb = ua @ axes[r.d_a], ub @ axes[r.d_a]
                na, nb = np.sqrt((va * va).sum(1)), np.sqrt((vb * vb).sum(1))
                same = r.ta == r.tb
                ca, cb = np.zeros(len(ka), np.int64), np.zeros(len(kb), np.int64)
                fi, fj = [], []
                for x, y in near_blocks(wa, wb, far):
                    if same and y < x:
                        continue
                    i, j = survivors(wa[x : x + BLOCK], wb[y : y + BLOCK], threshold)
                    i, j = i + x, j + y
                    if same:
                        i, j = i[i < j], j[i < j]
                    if len(i) == 0:
                        continue
                    link = np.einsum("ij,ij->i", va[i], vb[j]) / (na[i] * nb[j]) >= threshold
                    i, j = i[link], j[link]
                    ca += np.bincount(i, weights=mb[j], minlength=len(ka)).astype(np.int64)
                    cb += np.bincount(j, weights=ma[i], minlength=len(kb)).astype(np.int64)
                    keep = union_forest(len(ka) + len(kb), i, j if same else j + len(ka))
                    fi.append(i[keep])
                    fj.append(j[keep])
                if not fi:
                    continue
                i, j = np.concatenate(fi), np.concatenate(fj)
                keep = union_forest(len(ka) + len(kb), i, j if same else j + len(ka))
                yield pd.DataFrame({"a": ka[ca > 0], "n": ca[ca > 0], "b": pd.array([None] * int((ca > 0).sum()), dtype="Int64")})
                yield pd.DataFrame({"a": kb[cb > 0], "n": cb[cb > 0], "b": pd.array([None] * int((cb > 0).sum()), dtype="Int64")})
                yield pd.DataFrame({"a": ka[i[keep]], "n": 0, "b": pd.array(kb[j[keep]], dtype="Int64")})

    found = stages.save(met.mapInPandas(compare, "a long, n long, b long"), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(found.where("b is not null").select("a", "b"), stages, "components")
    n_rows, n_reps = df.count(), reps.count()
    known = stages.save(
        reps.select("k1", "k2", "node", "id", "m").join(counts, "node", "left").join(comp, "node", "left")
        .select("k1", "k2", "id", "m", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "node").alias("class")), "nodes",
    )
    least = stages.save(known.groupBy("class").agg(F.min("id").alias("component_id"), F.count("*").alias("n")), "classes")
    known = stages.save(join_hot(known, least, "class", "n", n_reps).select("k1", "k2", "m", "n_links", "component_id"), "known")
    stages.drop("reps", "tiles", "links", "nodes", "classes")
    rows = rows.select("vec_id", "ok", "k1", "k2")
    out = join_hot(rows.where("ok"), known, ["k1", "k2"], "m", n_rows).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    component = F.when(F.col("vec_id").isNotNull(), F.col("component_id"))
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
