"""Reference tables as matching wants them, read from tables that keep everything as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.report import fingerprint

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: Columns of each table that its version covers, letter first.
COVERED = {
    "a": ("id", "kor_name", "eng_name", "abv", "type", "category", "region_id", "distillery_id", "age", "cask", "volume", "deleted_at"),
    "d": ("id", "kor_name", "eng_name"), "r": ("id", "kor_name", "eng_name", "parent_id"),
    "x": ("entity_type", "entity_id", "alias_norm", "language", "source"),
}


def strength(raw: Column) -> Column:
    """``40%`` as 40.0: one percent sign after trimming, then a plain decimal number; an empty rest is 0, anything else null."""
    text = F.regexp_replace(F.trim(raw), "%$", "")
    return F.when(text == "", F.lit(0.0)).when(text.rlike(NUMBER), text.try_cast("double"))


def load_alcohols(df: DataFrame) -> DataFrame:
    """Reads abv as number (the text stays in ``abv``), joins the given categories by ``|``; missing keys are 0 and missing texts empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    abv = F.coalesce(F.col("abv"), F.lit(""))
    return df.select(
        F.col("id").cast("long").alias("id"), "kor_name", "eng_name", abv.alias("abv"), strength(abv).alias("abv_percent"), "type",
        F.concat_ws("|", "kor_category", "eng_category", "category_group").alias("category"), key("region_id"), key("distillery_id"), text("age"), text("cask"), text("volume"), "deleted_at",
    )


def load_distilleries(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("long").alias("id"), "kor_name", "eng_name")


def load_regions(df: DataFrame) -> DataFrame:
    """A region without a parent has parent 0."""
    return df.select(F.col("id").cast("long").alias("id"), "kor_name", "eng_name", F.coalesce(F.col("parent_id").cast("long"), F.lit(0).cast("long")).alias("parent_id"))


def reference_version(alcohols: DataFrame, distilleries: DataFrame, regions: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(kind, rows, fingerprint) of each loaded table: matching results name these, and any change of a covered value changes them.

    Rows are digested one by one and summed, so no table is gathered and order does not count.
    """
    given = {"a": alcohols, "d": distilleries, "r": regions} | ({"x": aliases} if aliases is not None else {})
    each = [fingerprint(df, list(COVERED[kind])).select(F.lit(kind).alias("kind"), "rows", "fingerprint") for kind, df in given.items()]
    return reduce(DataFrame.unionByName, each)
