"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Only a local session may leave it unset; it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of a frame, written once to the shared folder: later plans read them instead of working them out again at each use."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """The same rows, whose columns the optimiser takes as given: it neither spells them out again at each use nor moves filters on them below."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
