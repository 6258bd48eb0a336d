"""Detail records: candidates with the names of their masters, and the evidence of each candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGETS = ("alcohol", "distillery", "region")
SLOTS = 3


def label(ko: Column, en: Column, id_: Column, score: Column) -> Column:
    """``ko / en · ID n · 점수 s``; names that are missing or empty are left out, the score has two digits."""
    names = F.nullif(F.concat_ws(" / ", F.nullif(ko, F.lit("")), F.nullif(en, F.lit(""))), F.lit(""))
    return F.concat_ws(" · ", names, F.concat(F.lit("ID "), id_.cast("string")), F.concat(F.lit("점수 "), F.format_number(score, 2)))


def candidate_labels(declarations: DataFrame, key: str, **masters: DataFrame) -> DataFrame:
    """(key, <target>_candidate_<k>): labels of nine slots; '' where a slot is empty.

    ``declarations`` has <target>_candidate_<k>_id and _score; each master (id, kor_name, eng_name) goes by its target's name.  The slots become rows, all masters
    are one table keyed by target and id, and one join serves the nine slots before they become columns again.
    """
    slots = [F.struct(F.lit(t).alias("target"), F.lit(k).alias("slot"), F.col(f"{t}_candidate_{k}_id").cast("long").alias("id"), F.col(f"{t}_candidate_{k}_score").cast("double").alias("score")) for t in TARGETS for k in range(1, SLOTS + 1)]
    rows = declarations.select(key, F.explode(F.array(*slots)).alias("s")).select(key, "s.*").where("id is not null")
    known = None
    for t in TARGETS:
        one = masters[t].select(F.lit(t).alias("target"), F.col("id").cast("long").alias("id"), "kor_name", "eng_name")
        known = one if known is None else known.unionByName(one)
    named = rows.join(known, ["target", "id"], "left").withColumn("label", label(F.col("kor_name"), F.col("eng_name"), F.col("id"), F.col("score")))
    out = [F.max(F.when((F.col("target") == t) & (F.col("slot") == k), F.col("label"))).alias(f"{t}_candidate_{k}") for t in TARGETS for k in range(1, SLOTS + 1)]
    wide = named.groupBy(key).agg(*out)
    return declarations.select(key).join(wide, key, "left").fillna("", [f"{t}_candidate_{k}" for t in TARGETS for k in range(1, SLOTS + 1)])


def candidate_details(candidates: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """(key, candidates): the candidates of a declaration in the order of targets and ranks, each with its evidence in order.

    candidates (key, target, rank, id, score) and evidence (key, target, rank, position, and any more columns); candidates without evidence have an empty list.
    """
    at = [key, "target", "rank"]
    lines = evidence.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("position", *[c for c in evidence.columns if c not in (*at, "position", "id")]))).alias("evidence"))
    d = candidates.select(*at, "id", "score").join(lines, at, "left")
    d = d.withColumn("evidence", F.coalesce("evidence", F.array().cast(d.schema["evidence"].dataType)))
    order = F.array_position(F.array(*map(F.lit, TARGETS)), F.lower("target"))
    item = F.struct(order.alias("target_order"), "rank", "id", "target", "score", "evidence")
    return d.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("target_order")).alias("candidates"))
