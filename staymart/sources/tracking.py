"""Append-only log of synced snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from staymart.local import local_frame
from staymart.schemas import TRACKING


def create_tracking(spark: SparkSession, path: str) -> None:
    """An empty typed log, unless there is one."""
    if not written(spark, path):
        local_frame(spark, [], TRACKING).write.parquet(path)


def written(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path."""
    try:
        spark.read.schema("present string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def tracking_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACKING).parquet(path)


def record_sync(
    spark: SparkSession, path: str, snapshot_id: int, processed_at: dt.datetime
) -> None:
    """Appends one record."""
    record = local_frame(spark, [(snapshot_id, processed_at)], TRACKING)
    record.write.mode("append").parquet(path)
