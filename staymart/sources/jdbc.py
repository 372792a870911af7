"""Relational store over JDBC: parallel read, and upsert by key.

Rows travel between executors and the store only. The driver issues the few
statements that are not row traffic over a DB-API connection that the caller's
``connect`` opens (for PostgreSQL ``psycopg.connect``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from staymart.operators.merge import require_key, require_unique_key
from staymart.schemas import KEY

BATCH_ROWS = 500


def jdbc_read(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """A table of the store. With ``split_on`` (a numeric, date or timestamp
    column) and its rough ``bounds`` it is read in parallel; rows outside of the
    bounds or without a value are read all the same."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_on:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", str(partitions))
        )
    return reader.options(**(options or {})).load()


def hash_predicates(column: str, partitions: int, hashed: str = "hashtext({})") -> list[str]:
    """Conditions by which a table is read in parallel along a text column, each row under
    exactly one. ``hashed`` is the store's hash to a whole number; NULLs are in the first part.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    part = f"MOD(MOD({hashed.format(quoted(column))}, {partitions}) + {partitions}, {partitions})"
    here = f"{quoted(column)} IS NOT NULL AND {part}"  # whatever the hash makes of NULL
    return [f"{here} = {i}" + (f" OR {quoted(column)} IS NULL" if i == 0 else "") for i in range(partitions)]


def jdbc_read_by_text(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    options: dict[str, str] | None = None,
    partitions: int = 8,
    hashed: str = "hashtext({})",
) -> DataFrame:
    """A table of the store, read in parallel along a text column."""
    return spark.read.jdbc(url, table, predicates=hash_predicates(split_on, partitions, hashed), properties=options)


def quoted(name: str) -> str:
    """A possibly schema-qualified identifier in double quotes."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def column_type(data_type: T.DataType) -> str:
    """PostgreSQL type of a column."""
    if isinstance(data_type, T.DecimalType):
        return f"NUMERIC({data_type.precision},{data_type.scale})"
    plain = {
        T.StringType: "TEXT",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.TimestampNTZType: "TIMESTAMP",
        T.BooleanType: "BOOLEAN",
        T.ShortType: "SMALLINT",
        T.IntegerType: "INTEGER",
        T.LongType: "BIGINT",
        T.FloatType: "REAL",
        T.DoubleType: "DOUBLE PRECISION",
    }
    if type(data_type) not in plain:
        raise ValueError(f"no relational type for {data_type.simpleString()}")
    return plain[type(data_type)]


def create_table_sql(schema: T.StructType, table: str, key: str | None = None) -> str:
    """DDL from a frame's schema; ``key`` becomes the primary key."""
    columns = [
        f"{quoted(f.name)} {column_type(f.dataType)}{' PRIMARY KEY' if f.name == key else ''}"
        for f in schema
    ]
    return f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(columns)})"


def upsert_sql(columns: list[str], table: str, staging: str, key: str) -> str:
    """One statement that moves all staged rows into the table.

    DISTINCT, because a retried or speculative task may have staged its rows
    twice. Keys were checked to be unique before, so copies are exact.
    """
    names = ", ".join(quoted(c) for c in columns)
    changes = ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in columns if c != key)
    action = f"DO UPDATE SET {changes}" if changes else "DO NOTHING"
    return (
        f"INSERT INTO {quoted(table)} ({names}) SELECT DISTINCT {names} "
        f"FROM {quoted(staging)} ON CONFLICT ({quoted(key)}) {action}"
    )


def jdbc_stage(
    url: str, options: dict[str, str] | None = None, partitions: int = 16
) -> Callable[[DataFrame, str], None]:
    """A writer of staging tables: every task inserts its partition in batches over
    a connection of its own. ``partitions`` bounds the connections."""

    def write(rows: DataFrame, table: str) -> None:
        (
            rows.write.format("jdbc")
            .option("url", url)
            .option("dbtable", quoted(table))
            .option("batchsize", str(BATCH_ROWS))
            .option("numPartitions", str(partitions))
            .options(**(options or {}))
            .mode("append")
            .save()
        )

    return write


def _execute(connect: Callable[[], Any], *statements: str) -> None:
    """Runs statements in one transaction."""
    connection = connect()
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement)
        connection.commit()
    finally:
        connection.close()


def upsert_table(
    rows: DataFrame,
    table: str,
    connect: Callable[[], Any],
    stage_rows: Callable[[DataFrame, str], None],
    key: str = KEY,
) -> int:
    """Inserts or updates ``rows`` by key; returns how many rows were processed.

    The target table is created if needed. Rows are staged in parallel, then one
    statement in one transaction moves them, so the store shows all or nothing.
    """
    require_key(rows, key)
    require_unique_key(rows, key)
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    seen = Observation()
    _execute(
        connect,
        create_table_sql(rows.schema, table, key),
        create_table_sql(rows.schema, staging),
    )
    try:
        stage_rows(rows.observe(seen, F.count(F.lit(1)).alias("rows")), staging)
        _execute(connect, upsert_sql(rows.columns, table, staging, key))
    finally:
        _execute(connect, f"DROP TABLE IF EXISTS {quoted(staging)}")
    return seen.get["rows"]
