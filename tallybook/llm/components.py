"""Connected components of a link table by alternating star contraction, and joins that spread hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Stages

#: A join broadcasts the keys that hold more than 1 / HOT_KEYS of the rows: at most so many rows.
HOT_KEYS = 10_000
HOT_ROWS = 1_000


def join_hot(left: DataFrame, right: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """Inner join on ``key``; ``right`` has one row a key, and its column ``n`` says how many rows of ``left`` carry the key.

    Keys of many rows, of which ``total`` rows allow ``HOT_KEYS`` at most, are broadcast, so that their rows of ``left`` stay where they
    are; all other keys meet in a shuffle.  Both sides are read twice and should be tables.
    """
    key = [key] if isinstance(key, str) else key
    level = max(HOT_ROWS, total // HOT_KEYS)
    hot, cold = right.where(F.col(n) > level), right.where(F.col(n) <= level)
    rest = left.join(F.broadcast(hot.select(*key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def components(edges: DataFrame, stages: Stages, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its least node.

    Large-star then small-star rounds shrink every tree to a star; each round's
    edges are written to the shared folder.  Null ends and loops are ignored.
    The number of rounds follows the logarithm of the longest chain; beyond ``max_rounds`` it raises.
    """
    cur = stages.save(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{name}-0",
    )
    total, digest = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first()
    for i in range(1, max_rounds + 1):
        if not total:
            break
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stages.save(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")), f"{name}-{i}-least")
        # large star: every greater neighbour points at the least node seen from here
        large = stages.save(
            join_hot(both, least, "a", "n", 2 * total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(), f"{name}-{i}-large",
        )
        same = large.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.count_distinct("a")).first()
        if tuple(same) == (total, digest, total):
            stages.drop(f"{name}-{i}-least", f"{name}-{i}-large", collect=False)
            break  # every node has one smaller neighbour, which has none: stars
        # small star: every node and its smaller neighbours point at the least of them
        floor = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        several = floor.where("n > 1").select("a", "m")
        small = (
            large.join(several, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(floor.select("a", F.col("m").alias("b"))).distinct()
        )
        cur = stages.save(small, f"{name}-{i}")
        total, digest = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        stages.drop(f"{name}-{i - 1}", f"{name}-{i}-least", f"{name}-{i}-large", collect=False)
    else:
        raise RuntimeError(f"components of {name} still change after {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
