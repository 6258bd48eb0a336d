"""The ledger as a stream of overlapping observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.operators.cdc import latest_by_key


def dedupe(stream: DataFrame, time: str = "observed_at", keys=("rcno", "semantic_text"), delay: str = "3650 days") -> DataFrame:
    """First observation of every (key, content) within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def upsert_latest(stream: DataFrame, spark: SparkSession, target: str, checkpoint: str, key: str = "rcno", order=("observed_at", "item_id")):
    """Run all available data through micro-batches that keep the newest row of each key.

    Each batch writes the next version of the state, ``target/v=<batch>``; a batch that is run
    again overwrites its own version only, so a failure between batches loses nothing.
    """

    def step(batch: DataFrame, n: int) -> None:
        rows = batch if n == 0 else batch.unionByName(batch.sparkSession.read.parquet(f"{target}/v={n - 1}"))
        latest_by_key(rows, key, *order).write.mode("overwrite").parquet(f"{target}/v={n}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
