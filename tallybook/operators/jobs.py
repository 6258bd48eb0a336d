"""Jobs over tasks: counters, status and the evidence of every attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accepted_items(items: DataFrame, tasks: DataFrame) -> DataFrame:
    """Items of the accepted attempt of finished tasks, with their job: tasks (task_id, job_id, status, attempts)."""
    done = tasks.where("status = 'DONE'").select("task_id", "job_id", F.col("attempts").alias("attempt_no"))
    return items.join(done, ["task_id", "attempt_no"])


def job_counters(items: DataFrame, fetches: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per job: tasks, finished and failed ones, fetches, accepted rows, distinct keys, and keys that no accepted item of any job had before.

    A key is new to the job that holds its accepted item of least id, so one aggregation by key finds it, whose partial sums keep a hot key to one row a task.
    """
    accepted = accepted_items(items, tasks)
    by_key = accepted.groupBy("rcno", "job_id").agg(F.count("*").alias("rows"), F.min("item_id").alias("least"))
    keys = by_key.groupBy("job_id").agg(F.sum("rows").alias("parsed_rows"), F.count("*").alias("unique_keys"))
    new = by_key.groupBy("rcno").agg(F.min_by("job_id", "least").alias("job_id")).groupBy("job_id").agg(F.count("*").alias("new_keys"))
    total = tasks.groupBy("job_id").agg(
        F.count("*").alias("total_tasks"), F.count_if(F.col("status") == "DONE").alias("completed_tasks"), F.count_if(F.col("status") == "FAILED").alias("failed_tasks"))
    fetched = fetches.join(tasks.select("task_id", "job_id"), "task_id").groupBy("job_id").agg(F.count("*").alias("fetched_requests"))
    joined = total.join(fetched, "job_id", "left").join(keys, "job_id", "left").join(new, "job_id", "left")
    return joined.fillna(0, ["fetched_requests", "parsed_rows", "unique_keys", "new_keys"])


def job_status(jobs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Jobs (job_id, status, cancel_requested) with the status that their tasks give and the largest error text.

    While a task is open the status stays; then a wish to cancel comes before failures, and failures before completion.
    """
    is_ = lambda *s: F.count_if(F.col("status").isin(*s))
    counts = tasks.groupBy("job_id").agg(
        F.count("*").alias("total"), is_("DONE").alias("done"), is_("FAILED").alias("failed"), is_("PENDING", "LEASED", "RETRY_WAIT").alias("active"), F.max("last_error").alias("last_error"))
    d = jobs.join(counts, "job_id", "left").fillna(0, ["total", "done", "failed", "active"])
    ended = F.when(F.col("cancel_requested"), "CANCELLED").when(F.col("failed") > 0, "PARTIAL_FAILED").otherwise("COMPLETED")
    return d.withColumn("status", F.when(F.col("active") > 0, F.col("status")).otherwise(ended))


def attempt_evidence(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """(task_id, attempts): attempts of a task, the items of each, and of an item its pages and keys, every list in order.

    Pages (task_id, attempt, item_code, page_no, status, total, parsed_rows) and keys (task_id, attempt, item_code, rcno) meet after both shrank to one row an
    item, so the lists are those of one scan of one item; an item that only one side knows has an empty list on the other.  Repeated keys stay.
    """
    group = ["task_id", "attempt", "item_code"]
    p = pages.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("page_no", "status", "total", "parsed_rows"))).alias("pages"))
    k = keys.groupBy(*group).agg(F.array_sort(F.collect_list("rcno")).alias("keys"))
    d = p.join(k, group, "full_outer")
    for c in ("pages", "keys"):
        d = d.withColumn(c, F.coalesce(c, F.array().cast(d.schema[c].dataType)))
    items = d.groupBy("task_id", "attempt").agg(F.array_sort(F.collect_list(F.struct("item_code", "pages", "keys"))).alias("items"))
    return items.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("attempt", "items"))).alias("attempts"))
