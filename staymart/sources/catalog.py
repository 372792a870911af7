"""Catalog tables as the target of a load.

Spark's own MERGE does the work, for a table whose format supports it. No such catalog
is at hand here, so this is untested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staymart.operators.inspection import empty_like, table_exists
from staymart.operators.merge import conform
from staymart.schemas import KEY


def create_table(df: DataFrame, name: str, provider: str = "iceberg") -> None:
    """The table with the columns of ``df`` and no rows, unless it exists."""
    if not table_exists(df.sparkSession, name):
        empty_like(df).writeTo(name).using(provider).create()


def merge_table(source: DataFrame, name: str, key: str = KEY, provider: str = "iceberg") -> None:
    """``source`` merged into the table by ``key``: matches updated, others inserted.

    One atomic statement. A NULL key matches nothing and is inserted.
    """
    create_table(source, name, provider)
    rows = conform(source, source.sparkSession.table(name)).alias("source")
    condition = F.col(f"{name}.{key}") == F.col(f"source.{key}")
    rows.mergeInto(name, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()
