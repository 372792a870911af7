"""Merge targets as Spark's bucketed tables: the merge joins bucket by bucket, without a shuffle
of the target.

Rows whose key many rows share, and rows without a key, are all in one bucket. They are read
past the buckets, in as many splits as their files allow, and joined with their few updates,
broadcast: there are at most so many such keys as the table has rows over ``most``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from staymart.operators.merge import conform, find_matches, keyed, updated
from staymart.schemas import KEY
from staymart.scratch import scratch_folder, stage

#: A key of more rows is joined apart.
MOST_ROWS = 1_000_000


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table, where its files are, and what it is bucketed by."""

    name: str
    path: str
    key: str
    buckets: int


def write_bucketed(rows: DataFrame, name: str, path: str, buckets: int, key: str = KEY) -> Bucketed:
    """``rows`` as a new table of the session's catalog, files below ``path``.

    Rows are dealt to the buckets before they are written, one file a bucket.
    """
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return Bucketed(name, path, key, buckets)


def hot_keys(table: Bucketed, spark: SparkSession, most: int) -> DataFrame:
    """Keys of more than ``most`` rows; counted bucket by bucket, without a shuffle."""
    counts = keyed(spark.table(table.name).select(table.key), table.key).groupBy(table.key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > most).select(table.key)


def merge_bucketed(
    table: Bucketed, source: DataFrame, folder: str | None = None, most: int = MOST_ROWS
) -> DataFrame:
    """The rows of the table after merging ``source``, by the rules of ``merge_upsert``.

    Only the source is shuffled, into the table's buckets.
    """
    spark, key = source.sparkSession, table.key
    folder = folder or scratch_folder(spark)
    target = spark.table(table.name)
    source = conform(source, target)
    hot = stage(hot_keys(table, spark, most), folder, "hot")
    found = find_matches(keyed(target, key).select(key).hint("merge"), source, key, folder)
    cold = keyed(target, key).join(F.broadcast(hot), key, "left_anti").select(*target.columns)
    # the source's side takes the buckets' number, so the buckets stay as they are
    kept = updated_in_buckets(cold, found.updates, table)
    plain = spark.read.schema(target.schema).parquet(table.path)
    apart = plain.join(F.broadcast(hot.withColumnRenamed(key, "__hot")), F.col(key) == F.col("__hot"), "left")
    apart = apart.where(F.col(key).isNull() | F.col("__hot").isNotNull()).select(*target.columns)
    few = F.broadcast(keyed(found.updates, key).join(F.broadcast(hot), key, "left_semi").select(*target.columns))
    return kept.unionByName(updated(apart, few, key)).unionByName(found.inserts)


def updated_in_buckets(cold: DataFrame, updates: DataFrame, table: Bucketed) -> DataFrame:
    key = table.key
    new = keyed(updates, key).select(F.col(key).alias("__key"), F.struct(*(F.col(c) for c in cold.columns)).alias("__new"))
    new = new.repartition(table.buckets, "__key").hint("merge")
    both = cold.join(new, F.col(key) == F.col("__key"), "left")
    hit = F.col("__new").isNotNull()
    return both.select(*[F.when(hit, F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in cold.columns])
