"""Frames from a few rows that a program already holds."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

ARROW = {
    T.StringType: pa.string(),
    T.IntegerType: pa.int32(),
    T.LongType: pa.int64(),
    T.DoubleType: pa.float64(),
    T.TimestampType: pa.timestamp("us", tz="UTC"),
}


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A frame of the given rows.

    Handed over as Arrow, it becomes a local relation: one partition, a size that
    Catalyst knows, and no job to make it.
    """
    rows = list(rows)
    columns = [
        pa.array([row[i] for row in rows], ARROW[type(field.dataType)])
        for i, field in enumerate(schema)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.fieldNames()))
