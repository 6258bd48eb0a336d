"""Completeness of collection attempts, decided from pages and key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_set_sha(keys: str):
    """Digest of the sorted distinct keys of a group."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(keys).cast("string"))), "\n"), 256)


def reconcile_items(pages: DataFrame, keys: DataFrame, page_size: int) -> DataFrame:
    """Per (task, attempt, item): totals, digest, validity and the first reason against it.

    A group is what one scan of one item returned, so its key set is bounded by one scan.
    """
    group = ["task_id", "attempt", "item_code"]
    p = pages.groupBy(*group).agg(
        F.count("*").alias("pages"), F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), F.count_distinct("page_no").alias("page_nos"),
        F.count_if(F.col("status") != "PARSED").alias("unparsed"), F.min("total").alias("total"), F.max("total").alias("max_total"), F.sum("parsed_rows").alias("parsed"),
    )
    k = keys.groupBy(*group).agg(F.count("*").alias("stored"), F.count_distinct("rcno").alias("unique_keys"), key_set_sha("rcno").alias("key_sha"))
    r = p.join(k, group, "left").fillna({"stored": 0, "unique_keys": 0})
    wanted = F.greatest(F.lit(1), F.ceil(F.col("total") / page_size))
    reason = F.coalesce(
        F.when(F.col("unparsed") > 0, "page_not_parsed"), F.when(F.col("total") != F.col("max_total"), "total_differs"),
        F.when((F.col("first_page") != 1) | (F.col("last_page") != F.col("page_nos")) | (F.col("pages") != F.col("page_nos")), "pages_not_contiguous"),
        F.when(F.col("pages") != wanted, "page_count"), F.when(F.col("parsed") != F.col("total"), "parsed_rows"),
        F.when(F.col("stored") != F.col("parsed"), "stored_rows"), F.when(F.col("unique_keys") != F.col("total"), "unique_keys"),
    )
    return r.select(*group, "total", F.col("pages").cast("long").alias("pages"), "unique_keys", "key_sha", reason.alias("reason"), reason.isNull().alias("valid"))


def previous_valid(recon: DataFrame) -> DataFrame:
    """Each attempt with the latest earlier valid one of its item."""
    w = Window.partitionBy("task_id", "item_code").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("valid"), F.struct("attempt", "total", "key_sha")), ignorenulls=True).over(w)
    return recon.withColumn("_p", prev).select(
        *recon.columns, F.col("_p.attempt").alias("prev_attempt"), F.col("_p.total").alias("prev_total"), F.col("_p.key_sha").alias("prev_sha")
    )


def reconcile_tasks(recon: DataFrame) -> DataFrame:
    """Verdict per (task, attempt) from the items in it."""
    r = previous_valid(recon)
    multi = F.col("pages") > 1
    changed = multi & F.col("prev_attempt").isNotNull() & ((F.col("prev_total") != F.col("total")) | (F.col("prev_sha") != F.col("key_sha")))
    flags = r.groupBy("task_id", "attempt").agg(
        F.bool_or(~F.col("valid")).alias("invalid"), F.bool_or(multi & F.col("prev_attempt").isNull()).alias("unverified"), F.bool_or(changed).alias("changed"),
    )
    verdict = F.when(F.col("invalid"), "RECONCILIATION_FAILED").when(F.col("unverified"), "VERIFICATION_REQUIRED").when(F.col("changed"), "SET_CHANGED").otherwise("COMPLETE")
    return flags.select("task_id", "attempt", verdict.alias("verdict"))


def key_diff(keys: DataFrame, before: int, after: int) -> DataFrame:
    """(task, item, rcno, side): keys missing from or unexpected in the later attempt."""
    cols = ["task_id", "item_code", "rcno"]
    held = lambda n: F.bool_or(F.col("attempt") == n)
    sides = keys.where(F.col("attempt").isin(before, after)).groupBy(*cols).agg(held(before).alias("old"), held(after).alias("new"))
    return sides.where(F.col("old") != F.col("new")).select(*cols, F.when(F.col("old"), "missing").otherwise("unexpected").alias("side"))


def judge_tasks(recon: DataFrame, keys: DataFrame, targets: list[tuple[str, str]]) -> DataFrame:
    """Per (task, attempt): verdict, and of the target that gave it item_code, item_name, reason, missing and unexpected keys.

    ``targets`` are the (code, name) that every task must hold, in order; one without rows is invalid (``not_collected``).  The first
    invalid target decides; without one, the first of several pages that has no earlier valid scan or differs from it.
    """
    order = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(code).alias("item_code"), F.lit(name).alias("item_name")) for k, (code, name) in enumerate(targets)])
    wanted = recon.select("task_id", "attempt").distinct().select("task_id", "attempt", F.inline(order))
    # attempts without rows of an item are no earlier scans of it, so the scan before is found on the rows there are
    r = wanted.join(previous_valid(recon), ["task_id", "attempt", "item_code"], "left")
    multi, valid = F.col("pages") > 1, F.coalesce("valid", F.lit(False))
    fault = (
        F.when(~valid, "RECONCILIATION_FAILED").when(multi & F.col("prev_attempt").isNull(), "VERIFICATION_REQUIRED")
        .when(multi & ((F.col("prev_total") != F.col("total")) | (F.col("prev_sha") != F.col("key_sha"))), "SET_CHANGED")
    )
    why = F.when(~valid, F.coalesce("reason", F.lit("not_collected")))
    first = F.min_by(F.struct("fault", "item_code", "item_name", "why", "prev_attempt"), F.when(F.col("fault").isNotNull(), F.struct(valid.alias("stage"), "place")))
    judged = r.withColumns({"fault": fault, "why": why}).groupBy("task_id", "attempt").agg(first.alias("f")).select(
        "task_id", "attempt", F.coalesce("f.fault", F.lit("COMPLETE")).alias("verdict"), "f.item_code", "f.item_name", F.col("f.why").alias("reason"), "f.prev_attempt",
    )
    changed = judged.where("verdict = 'SET_CHANGED'").select("task_id", "attempt", "item_code", "prev_attempt")
    scans = changed.select("task_id", "item_code", "attempt", F.explode(F.array(F.struct(F.col("attempt").alias("scan"), F.lit(True).alias("new")), F.struct(F.col("prev_attempt").alias("scan"), F.lit(False).alias("new")))).alias("s"))
    scans = scans.select("task_id", "item_code", F.col("attempt").alias("judged"), F.col("s.scan").alias("attempt"), "s.new")
    sides = keys.select("task_id", "item_code", "attempt", "rcno").join(scans, ["task_id", "item_code", "attempt"]).groupBy("task_id", "item_code", "judged", "rcno").agg(F.bool_or("new").alias("now"), F.bool_and("new").alias("only"))
    diff = sides.groupBy("task_id", "item_code", F.col("judged").alias("attempt")).agg(F.count_if(~F.col("now")).alias("missing"), F.count_if(F.col("only")).alias("unexpected"))
    return judged.drop("prev_attempt").join(diff, ["task_id", "attempt", "item_code"], "left").select("task_id", "attempt", "verdict", "item_code", "item_name", "reason", "missing", "unexpected")
