"""Mirrors of reference tables: a version is written beside the others, read back, compared by fingerprint, and only then becomes the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.operators.report import fingerprint

#: An empty file that stands in a version's folder once the version was found equal to its source; creating a file is atomic in every store.
MARK = "_VERIFIED"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, target: str, verified: bool = True) -> list[int]:
    """Numbers of the versions under ``target``, smallest first: those with a mark, or all."""
    at, fs = _fs(spark, f"{target}/v*/{MARK}" if verified else f"{target}/v*")
    found = fs.globStatus(at) or []
    return sorted(int((s.getPath().getParent() if verified else s.getPath()).getName()[1:]) for s in found)


def current(spark: SparkSession, target: str, name: str) -> DataFrame | None:
    """The table ``name`` of the newest verified version; none if there is no such version."""
    known = versions(spark, target)
    return spark.read.parquet(f"{target}/v{known[-1]:06d}/{name}") if known else None


def mirror(spark: SparkSession, target: str, tables: dict[str, DataFrame], tamper=None) -> dict[str, tuple[int, str]]:
    """Writes a new version of all tables and makes it current; returns rows and fingerprint of each.

    What was written is read back and must have the source's rows and fingerprint; else ValueError, and the version before stays current.  A run that dies half-way
    leaves a version without a mark, which nobody reads.  ``tamper`` is for tests: it is called with the version's folder before it is read back.
    """
    known = versions(spark, target, verified=False)
    folder = f"{target}/v{(known[-1] if known else 0) + 1:06d}"
    want = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        want[name] = tuple(fingerprint(df, df.columns).first())
    if tamper:
        tamper(folder)
    for name, df in tables.items():
        got = tuple(fingerprint(spark.read.schema(df.schema).parquet(f"{folder}/{name}"), df.columns).first())
        if got != want[name]:
            raise ValueError(f"{name}: the mirror has {got}, the source {want[name]}")
    at, fs = _fs(spark, f"{folder}/{MARK}")
    fs.create(at, True).close()
    return want
