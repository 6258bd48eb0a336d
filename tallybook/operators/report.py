"""Reports over declarations and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.text import percent

#: Statuses that ask for a look: the population of the review reports.
OPEN = ("REVIEW_REQUIRED", "PARTIAL", "UNPARSED")
#: Fields of the coverage report, and what must not be null for a row to count.
COVERED = ("abv", "age", "importer", "ingredient_percent", "normalized_name", "variant_marker", "vintage", "volume")
UNKNOWN, UNNAMED = "미분류", "이름 미정"


def in_review() -> Column:
    return F.col("normalization_status").isin(*OPEN)


def overview(d: DataFrame) -> DataFrame:
    """Totals, review population, rows that still have their source, their shares and the latest day."""
    review, kept = F.count_if(in_review()), F.count("source_item_id")
    return d.agg(
        F.count("*").alias("total"), review.alias("review"), percent(review, F.count("*")).alias("review_pct"), kept.alias("preserved"),
        percent(kept, F.count("*")).alias("preserved_pct"), F.coalesce(F.date_format(F.max("processed_date"), "yyyy-MM-dd"), F.lit("")).alias("latest"),
    )


def counts_by(d: DataFrame, column: str) -> DataFrame:
    return d.groupBy(column).agg(F.count("*").alias("n"))


def field_coverage(d: DataFrame) -> DataFrame:
    """One pass over the rows, then one row per field in the order of their names."""
    filled = lambda *c: F.coalesce(*[F.col(x) for x in c], F.lit("")) != ""
    has = {
        "abv": F.col("abv_percent").isNotNull(), "age": F.col("age_years").isNotNull(), "importer": filled("importer_base"), "ingredient_percent": F.col("ingredient_raw").isNotNull(),
        "normalized_name": filled("display_name_ko", "display_name_en"), "variant_marker": F.col("variant_marker_raw").isNotNull(), "vintage": F.col("vintage_year").isNotNull(), "volume": F.col("unit_volume_ml").isNotNull(),
    }
    one = d.agg(F.count("*").alias("total"), *[F.count_if(has[c]).alias(c) for c in COVERED])
    stack = ", ".join(f"'{c}', {c}" for c in COVERED)
    return one.selectExpr("total", f"stack({len(COVERED)}, {stack}) as (field, populated)").select("field", "populated", "total", percent(F.col("populated"), F.col("total")).alias("pct"))


def top_counts(d: DataFrame, column: str, n: int = 20, default: str = "미분류") -> DataFrame:
    return d.groupBy(F.coalesce(F.col(column), F.lit(default)).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def sku_groups(d: DataFrame, n: int = 20) -> DataFrame:
    """Largest groups that share a key and a volume, by rows and then name; a report, nothing is merged."""
    name = F.coalesce(F.min(F.nullif("display_name_ko", F.lit(""))), F.min(F.nullif("base_name_ko", F.lit(""))), F.lit(UNNAMED))
    g = d.where("sku_key is not null").groupBy("sku_key", "unit_volume_ml").agg(name.alias("name"), F.count("*").alias("n"), F.count_distinct(F.coalesce("importer_base", "importer_name")).alias("importers"))
    top = g.where("n > 1").orderBy(F.desc("n"), "name", "sku_key").limit(n)
    return top.select("name", F.coalesce("unit_volume_ml", F.lit(0)).alias("unit_volume_ml"), "n", "importers", "sku_key")


def candidate_groups(d: DataFrame) -> DataFrame:
    """Keys that several rows share, with their distinct names, volumes and strengths; rows that differ in these never share a key."""
    g = d.where("sku_key is not null").groupBy("sku_key")
    return g.agg(
        F.count("*").alias("n"), F.count_distinct("base_name_en").alias("names"), F.count_distinct("unit_volume_ml").alias("volumes"), F.count_distinct("abv_percent").alias("strengths"),
    ).where("n > 1")


def review_reasons(d: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent reasons of rows that are not settled."""
    return d.where(in_review()).select(F.explode("review_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def duplicate_observations(items: DataFrame, n: int = 20) -> DataFrame:
    """Per queried item: keys that the ledger holds more than once, under whatever item, and their rows.

    Rows shrink to one a key and item first; a window over these finds keys with several rows, so the ledger is read once.
    """
    per = items.groupBy("rcno", F.coalesce("queried_item_name", F.lit(UNKNOWN)).alias("queried_item_name")).agg(F.count("*").alias("rows"))
    again = per.withColumn("all", F.sum("rows").over(Window.partitionBy("rcno"))).where(F.col("rcno").isNotNull() & (F.col("all") > 1))
    return again.groupBy("queried_item_name").agg(F.count("*").alias("keys"), F.sum("rows").alias("rows")).orderBy(F.desc("rows"), "queried_item_name").limit(n)


def review_distribution(d: DataFrame, n: int = 20) -> DataFrame:
    """(dimension, value, n): rows under review by item, importer, country and status, the n largest of each."""
    dims = {
        "item": F.coalesce("queried_item_name", F.lit(UNKNOWN)), "importer": F.coalesce("importer_base", "importer_name", F.lit(UNKNOWN)),
        "country": F.coalesce("manufacture_country_name", F.lit(UNKNOWN)), "status": F.col("normalization_status"),
    }
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value")) for k, v in dims.items()]))
    counts = d.where(in_review()).select(values.alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where((F.col("place") <= n) | (F.col("dimension") == "status")).drop("place")


def monthly(items: DataFrame, day: str) -> DataFrame:
    return items.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def bracket_balance(d: DataFrame, *columns: str) -> DataFrame:
    """Rows whose opening and closing brackets differ in number, by column."""
    count = lambda c, x: F.length(c) - F.length(F.replace(F.col(c), F.lit(x), F.lit("")))
    return d.agg(*[F.count_if(count(c, "(") != count(c, ")")).alias(f"{c}_unbalanced") for c in columns], F.count("*").alias("total"))


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """(rows, fingerprint) that do not depend on row order; null, empty and zero differ.

    Two 60-bit parts of each row's digest add into two decimal sums, so no group of lines is ever gathered and nothing overflows.
    """
    line = F.concat_ws("\x1f", *[F.when(F.col(c).isNull(), "null").otherwise(F.concat(F.lit("v:"), F.col(c).cast("string"))) for c in columns])
    part = lambda at: F.sum(F.conv(F.substring(F.sha2(line, 256), at, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    return df.agg(F.count("*").alias("rows"), F.concat_ws(":", F.coalesce(part(1), F.lit("0")), F.coalesce(part(16), F.lit("0"))).alias("fingerprint"))
