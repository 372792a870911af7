"""Raw reservation records in JSON lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from staymart.functions.fields import as_date
from staymart.schemas import RAW_RECORD, TEXT

Bound = str | dt.date | None
CORRUPT = "_corrupt_record"


def read_reservations(
    spark: SparkSession,
    path: str | list[str],
    updated_from: Bound = None,
    updated_to: Bound = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """Records whose ``updated`` date lies in the inclusive window.

    The schema is given, so the input is read once and nested fields that no
    record has come back as NULL. A malformed line becomes an all-NULL record,
    which any window bound removes.

    The date in the record alone decides. Names of folders decide nothing, as a late
    record may lie anywhere; who knows better lists the folders in ``path``.
    """
    records = spark.read.schema(RAW_RECORD).json(path)
    return within_window(records, updated_from, updated_to, lenient_dates)


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    updated_from: Bound = None,
    updated_to: Bound = None,
    lenient_dates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The records that ``read_reservations`` gives, less those of rejected lines, and the
    rejected lines: (file, line).

    A line is rejected if it is not a JSON object of the schema's shape. Blank lines are
    neither. Whatever its window, a rejected line is told, as its date is not known.
    """
    schema = T.StructType([*RAW_RECORD, T.StructField(CORRUPT, TEXT)])
    lines = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    # Only fields that are read are judged. This, always true, reads them all in both frames.
    lines = lines.filter(F.hash(*RAW_RECORD.fieldNames()).bitwiseAND(F.lit(0)) == 0)
    bad = F.col(CORRUPT).isNotNull()
    records = within_window(lines.filter(~bad).drop(CORRUPT), updated_from, updated_to, lenient_dates)
    rejected = lines.filter(bad).select(F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("line"))
    return records, rejected


def bound(day: str | dt.date) -> Column:
    return as_date(F.lit(str(day)))


def within_window(
    records: DataFrame,
    updated_from: Bound = None,
    updated_to: Bound = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """Inclusive on both ends; a missing or empty bound does not restrict."""
    updated = as_date(F.col("updated"), lenient_dates)
    if updated_from:
        records = records.filter(updated >= bound(updated_from))
    if updated_to:
        records = records.filter(updated <= bound(updated_to))
    return records
