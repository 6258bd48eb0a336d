"""Searches, distributions and data-quality counts over declarations, and facts of captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.text import percent, plain_number

DIMENSIONS = ("item_name", "importer_name", "manufacture_country_name", "normalization_status")


def request_key(path: Column, params: Column) -> Column:
    """Digest of a path and its parameters in the order of their names."""
    pair = lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))
    return F.sha2(F.concat(path, F.lit("?"), F.array_join(F.transform(F.array_sort(F.map_entries(params)), pair), "&")), 256)


def body_facts(d: DataFrame, body: str, limit: int) -> DataFrame:
    """Size in bytes, digest and whether the body exceeds the limit; a null body is empty."""
    text = F.coalesce(F.col(body), F.lit(""))
    size = F.octet_length(text).cast("long")
    return d.withColumns({"n_bytes": size, "body_sha256": F.sha2(text, 256), "over_limit": size > limit})


def link_targets(body: Column) -> Column:
    """The distinct targets of a page's links, in page order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r'href="([^"]*)"'), F.lit(1)))


def task_counters(items: DataFrame) -> DataFrame:
    """Per task, over its last attempt: rows, keys, and keys that no other task holds in an earlier row.

    Rows shrink to one per (key, task) before keys meet in windows, so a hot key brings at most one row a task.
    """
    last = F.max("attempt_no").over(Window.partitionBy("task_id"))
    attempts = items.groupBy("task_id", "attempt_no", "rcno").agg(F.count("*").alias("rows"), F.min("item_id").alias("least"))
    current = F.col("attempt_no") == F.col("last")
    per = attempts.withColumn("last", last).groupBy("rcno", "task_id").agg(
        F.min("least").alias("least"), F.min(F.when(current, F.col("least"))).alias("own"), F.sum(F.when(current, F.col("rows"))).alias("rows"),
    )
    w = Window.partitionBy("rcno")
    first = per.withColumn("first", F.min(F.struct("least", "task_id")).over(w))
    second = first.withColumn("second", F.min(F.when(F.col("task_id") != F.col("first.task_id"), F.col("least"))).over(w))
    other = F.when(F.col("task_id") == F.col("first.task_id"), F.col("second")).otherwise(F.col("first.least"))
    new = other.isNull() | (other > F.col("own"))
    return second.where("own is not null").groupBy("task_id").agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"), F.count_if(new).alias("new_keys"))


def vocabularies(d: DataFrame, columns: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(dimension, value): the distinct values of several columns in one pass, and the reasons that occur."""
    pair = lambda name, value: F.struct(F.lit(name).alias("dimension"), value.cast("string").alias("value"))
    reasons = F.transform(F.coalesce("review_reasons", F.array().cast("array<string>")), lambda r: pair("review_reason", r))
    return d.select(F.inline(F.concat(F.array(*[pair(c, F.col(c)) for c in columns]), reasons))).where("value is not null or dimension = 'review_reason'").distinct()


def search(d: DataFrame, text: str | None = None, columns: tuple[str, ...] = (), equal: dict | None = None, reason: str | None = None) -> DataFrame:
    """Rows that hold the text, taken literally, in one of the columns, and meet the other conditions."""
    if text:
        found = F.lit(False)
        for c in columns:
            found = found | F.coalesce(F.col(c).contains(text), F.lit(False))
        d = d.where(found)
    for c, value in (equal or {}).items():
        d = d.where(F.col(c) == value)
    return d.where(F.array_contains("review_reasons", reason)) if reason else d


def page(d: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of a sorted list; the order must end in a unique column."""
    return d.orderBy(*order).offset((number - 1) * size).limit(size)


def product_name() -> Column:
    """Base name, else source name, Korean before English, else the item; blanks do not count."""
    names = ("base_name_ko", "base_name_en", "product_name_ko", "product_name_en", "item_name")
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in names], F.lit("이름 미정"))


def product_key() -> Column:
    return F.concat(F.lit("name:"), F.sha2(product_name(), 256))


def product_groups(d: DataFrame) -> DataFrame:
    """Declarations by product, with their first and last day ('' where no day is known)."""
    day = lambda f: F.coalesce(F.date_format(f("processed_date"), "yyyy-MM-dd"), F.lit(""))
    return d.groupBy(product_key().alias("product_key")).agg(F.min(product_name()).alias("name"), F.count("*").alias("n"), day(F.min).alias("first_day"), day(F.max).alias("last_day"))


def extraction_rates(d: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Share of rows with each field, in one row."""
    return d.agg(F.count("*").alias("total"), *[percent(F.count(c), F.count("*")).alias(f"{c}_pct") for c in columns])


def debris(d: DataFrame, column: str) -> DataFrame:
    """Rows with empty brackets, repeated separators or a separator at an end."""
    c = F.col(column)
    return d.agg(
        F.count_if(c.rlike(r"\( *\)|\[ *\]")).alias("empty_brackets"), F.count_if(c.rlike("[,/] *[,/]")).alias("repeated_separators"),
        F.count_if(c.rlike("^ *[,/]|[,/] *$")).alias("orphan_separators"), F.count("*").alias("total"),
    )


def missed(d: DataFrame, source: str, pattern: str, field: str) -> DataFrame:
    """How many sources match a pattern whose field stayed null."""
    hit = F.col(source).rlike(pattern)
    return d.agg(F.count_if(hit).alias("matching"), F.count_if(hit & F.col(field).isNull()).alias("missed"))


def select_match_work(d: DataFrame, current: str, limit: int, force: bool = False) -> DataFrame:
    """Normalised rows that the current matching version has not seen, smallest id first."""
    open_ = F.lit(force) | (F.coalesce("matching_version", F.lit("")) != current)
    return d.where(F.col("normalization_status").isNotNull() & open_).orderBy("item_id").limit(limit)


def mark_failed(state: DataFrame, failures: DataFrame) -> DataFrame:
    """State with the errors (rcno, error, next_at) of failed keys; derived values stay."""
    f = failures.select("rcno", F.substring(F.col("error"), 1, 4096).alias("last_error"), "next_at")
    return state.drop("last_error", "next_at").join(f, "rcno", "left")


def sku_counts(d: DataFrame) -> DataFrame:
    """(distinct, filled) SKU keys."""
    return d.agg(F.count_distinct("sku_key").alias("distinct_keys"), F.count("sku_key").alias("filled"))


def status_shares(d: DataFrame) -> DataFrame:
    """One row: how many rows each status has, and percents."""
    names = ("REVIEW_REQUIRED", "PARTIAL", "NORMALIZED", "UNPARSED")
    n = lambda s: F.count_if(F.col("normalization_status") == s)
    return d.agg(*[x for s in names for x in (n(s).alias(s.lower()), percent(n(s), F.count("*")).alias(f"{s.lower()}_pct"))])


def unchanged_names(d: DataFrame, items: DataFrame) -> DataFrame:
    """How many rows have base names equal to their source names."""
    source = items.select("item_id", F.col("product_name_ko").alias("source_ko"), F.col("product_name_en").alias("source_en"))
    same = F.col("base_name_ko").eqNullSafe(F.coalesce("source_ko", F.lit(""))) & F.col("base_name_en").eqNullSafe(F.coalesce("source_en", F.lit("")))
    return d.join(source, "item_id").agg(F.count("*").alias("total"), F.count_if(same).alias("unchanged"), percent(F.count_if(same), F.count("*")).alias("unchanged_pct"))


def version_drift(d: DataFrame) -> DataFrame:
    """Per rule version: rows, distinct keys and the share under review."""
    review = F.count_if(F.col("normalization_status") == "REVIEW_REQUIRED")
    return d.groupBy("rule_version").agg(F.count("*").alias("total"), F.count_distinct("sku_key").alias("sku_keys"), percent(review, F.count("*")).alias("review_pct"))


def nested_brackets(d: DataFrame, column: str) -> DataFrame:
    """Rows with a bracket inside another, and rows with several pairs."""
    c = F.col(column)
    return d.agg(F.count_if(c.rlike(r"\([^)]*\(")).alias("nested"), F.count_if(c.rlike(r"\([^)]*\).*\(")).alias("several"), F.count("*").alias("total"))


def defect_samples(d: DataFrame, defect: Column, key: str, n: int = 3) -> DataFrame:
    """(class, key): up to n rows of each class, the smallest keys."""
    w = Window.partitionBy("class").orderBy(key)
    return d.select(defect.alias("class"), key).where("class is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def three_keys(d: DataFrame) -> DataFrame:
    """(item_id, product_key, volume_key, variant_key): name, volume in mL, and all that tells variants apart; '' for nothing."""
    shown = lambda c, tail: F.concat(plain_number(F.col(c)), F.lit(tail))
    texts = ("strength_type", "version_marker", "edition_name", "variant_marker_raw", "variant_marker_type", "material_code", "cask_number", "batch_number")
    variant = F.concat_ws(" · ", shown("age_years", "년"), F.col("vintage_year").cast("string"), shown("abv_percent", "%"), shown("proof", " proof"), *[F.nullif(F.col(c).cast("string"), F.lit("")) for c in texts])
    volume = F.coalesce(F.concat(F.col("unit_volume_ml").cast("string"), F.lit(" mL")), F.lit(""))
    return d.select("item_id", F.coalesce(F.nullif("base_name_ko", F.lit("")), F.nullif("base_name_en", F.lit("")), F.lit("")).alias("product_key"), volume.alias("volume_key"), variant.alias("variant_key"))


def evidence_lines(d: DataFrame) -> DataFrame:
    """(item_id, position, line): normalised values, the volume with its source text, then reasons, one line each."""
    pair = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string")))
    volume = F.when(F.col("unit_volume_ml").isNotNull(), F.concat(F.lit("unit_volume_ml: "), F.col("volume_raw"), F.lit(" -> "), F.col("unit_volume_ml").cast("string")))
    values = F.array_compact(F.array(volume, *[pair(c) for c in ("age_years", "batch_number", "strength_type")]))
    lines = F.concat(values, F.transform("review_reasons", lambda r: F.concat(F.lit("reason: "), r)))
    return d.select("item_id", F.posexplode(lines).alias("position", "line"))


def importer_profile(d: DataFrame, importer: str) -> DataFrame:
    """Declarations, distinct names, items and the first and last key of one importer."""
    return d.where(F.trim("importer_name") == importer).agg(
        F.count("*").alias("declarations"), F.count_distinct("product_name_en").alias("products"), F.count_distinct("item_name").alias("kinds"),
        F.min("rcno").alias("first_rcno"), F.max("rcno").alias("last_rcno"),
    )


def product_declarations(d: DataFrame, key: str, number: int, size: int) -> DataFrame:
    """One page of the declarations of a product, newest first."""
    return page(d.where(product_key() == key), [F.desc("processed_date"), F.desc("item_id")], number, size)


def page_warnings(pages: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """Per page: rows expected of it, rows parsed, and repeats of keys within its scan's item."""
    group = ["task_id", "attempt", "item_code"]
    expected = F.least(F.lit(size), F.col("total") - (F.col("page_no") - 1) * size).cast("long")
    repeats = keys.groupBy(*group).agg((F.count("*") - F.count_distinct("rcno")).alias("repeats"))
    return pages.join(repeats, group, "left").select(*group, "page_no", expected.alias("expected"), "parsed_rows", (expected != F.col("parsed_rows")).alias("warned"), F.coalesce("repeats", F.lit(0)).alias("repeats"))
