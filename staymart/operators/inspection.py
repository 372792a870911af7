"""Looking at tables: schema, size, preview, comparison of schemas and of content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from staymart.local import local_frame
from staymart.schemas import TEXT, struct

LISTING = struct(ordinal=T.IntegerType(), column_name=TEXT, data_type=TEXT)


def schema_listing(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type) of a frame, in column order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, start=1)]
    return local_frame(df.sparkSession, rows, LISTING)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.limit(0)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def compare_datasets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column by column: types on both sides, whether they agree, and both row
    counts, so that two stores can be compared at a glance."""
    lefts = schema_listing(left).select("column_name", F.col("data_type").alias("left_type"))
    rights = schema_listing(right).select("column_name", F.col("data_type").alias("right_type"))
    left_rows, right_rows = (side.agg(F.count(F.lit(1))).first()[0] for side in (left, right))
    return lefts.join(rights, "column_name", "full").select(
        "column_name",
        "left_type",
        "right_type",
        F.col("left_type").eqNullSafe(F.col("right_type")).alias("same_type"),
        F.lit(left_rows).cast("bigint").alias("left_rows"),
        F.lit(right_rows).cast("bigint").alias("right_rows"),
    )


def row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of a whole row. NULLs count: beside each value goes whether there is one."""
    both = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *both).cast("decimal(38,0)")


def hash_sums(df: DataFrame, by: list[str]) -> DataFrame:
    """Per group the number of rows and two sums of row hashes, whatever the order of rows."""
    sums = [F.sum(f"__h{i}").alias(f"h{i}") for i in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)


def compare_content(left: DataFrame, right: DataFrame, key: str, buckets: int = 4_096) -> DataFrame:
    """(key, left_rows, right_rows) of the keys whose rows differ between two datasets of the
    same columns; no rows if all are equal. A NULL key is a key here; order does not matter.

    Keys are dealt to buckets; sums of row hashes tell, from one small row per bucket, which
    buckets differ. Only rows of those go on to the comparison by key, so equal datasets are
    compared without a shuffle of their rows. Equal means equal in count and in 128 bits of sums.
    """
    right = right.select(*left.columns)
    sides = []
    for side in (left, right):
        hashes = [row_hash(side, i).alias(f"__h{i}") for i in (1, 2)]
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("__bucket")
        sides.append(side.select(F.col(key).alias("__key"), bucket, *hashes))
    a, b = (hash_sums(side, ["__bucket"]).withColumnsRenamed({"n": f"n_{s}", "h1": f"h1_{s}", "h2": f"h2_{s}"}) for s, side in zip("ab", sides))
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    unequal = F.broadcast(a.join(b, "__bucket", "full").where(~same).select("__bucket"))
    a, b = (
        hash_sums(side.join(unequal, "__bucket", "left_semi"), ["__key"]).withColumnsRenamed(
            {"__key": f"key_{s}", "n": f"n_{s}", "h1": f"h1_{s}", "h2": f"h2_{s}"}
        )
        for s, side in zip("ab", sides)
    )
    both = a.join(b, F.col("key_a").eqNullSafe(F.col("key_b")), "full").where(~same)
    none = F.lit(0).cast("long")
    named = F.when(F.col("n_a").isNotNull(), F.col("key_a")).otherwise(F.col("key_b"))
    return both.select(
        named.alias(key), F.coalesce("n_a", none).alias("left_rows"), F.coalesce("n_b", none).alias("right_rows")
    )
