"""Lists of declarations and importers as a dashboard asks for them: filters, orders with a unique last column, pages and their number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.quality import product_name, search

TARGETS = ("alcohol", "distillery", "region")


def find_declarations(
    d: DataFrame, text: str = "", columns: tuple[str, ...] = (), equal: dict[str, str] | None = None, reason: str | None = None, link: str | None = None, importer_id: int | None = None,
    first=None, last=None, matches: dict[str, str] | None = None,
) -> DataFrame:
    """Declarations that pass all filters given.

    ``text`` is looked for as it stands in any of ``columns``.  ``link`` is ``linked`` or ``unlinked``; ``first`` and ``last`` bound the processed date, both included, and leave out
    rows without one; ``matches`` asks of each target whether its first candidate is there: ``matched`` or ``unmatched``.
    """
    d = search(d, text, columns, equal, reason)
    has = lambda c, yes: F.col(c).isNotNull() if yes else F.col(c).isNull()
    asked = [has("importer_id", link == "linked")] if link else []
    asked += [F.col("importer_id") == importer_id] if importer_id else []
    asked += [F.col("processed_date") >= F.lit(first).cast("date")] if first else []
    asked += [F.col("processed_date") <= F.lit(last).cast("date")] if last else []
    asked += [has(f"{target}_candidate_1_id", wanted == "matched") for target, wanted in (matches or {}).items()]
    for condition in asked:
        d = d.where(condition)
    return d


def declaration_order(sort: str = "processed_at", descending: bool = True) -> list[Column]:
    """By processed date, or by whether a target has a candidate and then the newest first; the item's id decides ties.  Missing dates are least."""
    if sort == "processed_at":
        day = F.col("processed_date")
        return [day.desc_nulls_last() if descending else day.asc_nulls_first(), F.desc("source_item_id")]
    if sort not in TARGETS:
        raise ValueError(f"unknown order {sort!r}")
    found = F.col(f"{sort}_candidate_1_id").isNotNull()
    return [found.desc() if descending else found.asc(), F.col("processed_date").desc_nulls_last(), F.desc("source_item_id")]


def page_info(found: DataFrame, number: int, size: int) -> DataFrame:
    """(page, page_size, total, total_pages) of a list; nothing found has no pages."""
    total = F.count("*")
    return found.agg(
        F.lit(number).alias("page"), F.lit(size).alias("page_size"), total.alias("total"), F.ceil(total / size).cast("long").alias("total_pages"),
    )


IMPORTER_TEXTS = ("business_name", "code", "license_number", "representative", "address")


def importer_entries(registry: DataFrame, decls: DataFrame, text: str = "", matched_only: bool = False, equal: dict[str, str] | None = None) -> DataFrame:
    """Registry entries with declarations, products, first_day and last_day of the declarations linked to them ('' and 0 without any).

    ``text`` is looked for in name, code, licence, representative and address.  A product is a name as ``product_name`` tells it.
    """
    day = lambda f: F.date_format(f("processed_date"), "yyyy-MM-dd")
    stats = decls.where("importer_id is not null").groupBy("importer_id").agg(F.count("*").alias("declarations"), F.count_distinct(product_name()).alias("products"), day(F.min).alias("first_day"), day(F.max).alias("last_day"))
    found = search(registry, text, IMPORTER_TEXTS, equal).join(stats, "importer_id", "inner" if matched_only else "left")
    return found.fillna(0, ["declarations", "products"]).fillna("", ["first_day", "last_day"])


def importer_order(sort: str = "business_name", descending: bool = False) -> list[Column]:
    c = F.col({"business_name": "business_name", "declarations": "declarations", "last_import": "last_day", "observed_at": "observed_at"}[sort])
    return [c.desc() if descending else c.asc(), F.asc("importer_id")]
