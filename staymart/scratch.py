"""Folders for written intermediate tables.

Intermediate tables are plain Parquet in a folder that every executor can reach.
They cut lineage in a way that outlives a lost executor, and they give Catalyst
the file sizes from which it decides on a broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the session says all executors share."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder path under the session's ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse folder, which all executors share
    as well. The folder is the caller's: what is read from it later needs it still,
    so nothing removes it but ``staymart.sources.files.scratch``.
    """
    base = shared_folder(spark)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/staymart-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Where the session names no shared folder, the one used may be a machine's own: then the
    rows written are counted on the way, and it is an error if they are not read back.
    """
    spark, path = df.sparkSession, f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
    seen = None if shared_folder(spark) else Observation()
    rows = df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (rows.write.option("compression", compression) if compression else rows.write).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if seen is not None and seen.get["rows"] != (found := back.count()):
        raise RuntimeError(
            f"{found} of {seen.get['rows']} rows are in {path}: set spark.checkpoint.dir to a folder that all executors share"
        )
    return back


def stage_counted(df: DataFrame, folder: str, name: str) -> tuple[DataFrame, int]:
    """``stage``, and how many rows were written, observed on the way: no second pass."""
    seen = Observation()
    written = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), folder, name)
    return written, seen.get["rows"]
