"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents.

Each stage reads what the one before it kept.  Rows with a null id pass the filters that name documents by id (toxicity, benchmark); a
decision of these about an id holds for all its rows.  Near-dedup decides by row, rows without id included.  Null and empty texts score
as texts without toxic hits, are near copies of nothing, hold no passage, stay as they are, and count no words in the mix.  Ties and repeated rows are settled by each operator as its module says; texts of
any length are read whole; an empty table passes every stage as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import overlaps
from .minhash_dedup import near_duplicates
from .mixing import mix
from .pii import pseudonymise
from .tables import Stages, read
from .toxicity import toxicity_scores

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    scores = toxicity_scores(docs, read(spark, sf_dir, "labels"), Stages(spark, "toxic"))
    bad = scores.where("predicted = 1 and doc_id is not null").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(bad, "doc_id", "left_anti").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    stages = Stages(spark, "near")
    rows = stages.save(near_duplicates(docs, stages), "decisions")
    gone = rows.where("not kept").select(F.col("doc_id").alias("d"), F.col("version").alias("v")).distinct()
    docs = docs.select(*COLUMNS)
    same = docs["doc_id"].eqNullSafe(gone["d"]) & (F.xxhash64(docs["text"].cast("string")) == gone["v"])
    rest = docs.join(gone, same, "left_anti").select(*COLUMNS)
    if rows.where("kept").groupBy("doc_id", "version").count().where("count > 1").isEmpty():
        return rest
    return rest.dropDuplicates(["doc_id", "text"])  # repeated rows of a kept text


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    hits = overlaps(docs, read(spark, sf_dir, "benchmark"), Stages(spark, "leaks"))
    return docs.select(*COLUMNS).join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by pseudonyms."""
    out = pseudonymise(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies."""
    mixed = mix(docs, Stages(spark, "mix"), keep=("text", "lang", "n_chars"))
    return mixed.where("copies > 0").select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written and read again; a stage's input goes once its output is written."""
    stages = Stages(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stages.save(stage(spark, docs, sf_dir), name)
        if before:
            stages.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
