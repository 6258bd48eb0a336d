"""Reading inputs and cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark whatever the store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a local session may leave it unset; it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: While a table is written: Spark deletes a statement's shuffle files when the statement ends, and
#: long texts reach Python workers in small batches, whose copies as Python objects take several times their bytes.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


class Stages:
    """Tables written to the shared folder so that a lost executor re-reads, not recomputes.

    ``save`` writes and re-reads a frame; ``drop`` removes tables no later step reads.
    The shuffles of a saved frame are not needed once it is written, so their files go then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        # Python workers look for this package where the driver found it, unless told otherwise.
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        before = {key: self.spark.conf.get(key) for key in WHILE_WRITING}
        try:
            for key, value in WHILE_WRITING.items():
                self.spark.conf.set(key, value)
            df.write.mode("overwrite").parquet(path)
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, collect: bool = True) -> None:
        """Delete tables; with ``collect``, also the shuffles of frames that nothing refers to any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        if collect:
            self.release()

    def release(self) -> None:
        """Frames that went out of scope hold shuffle files until both collectors ran.

        Objects that only a finaliser frees take a second round.
        """
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.2)
