"""Versioned Parquet data: immutable files, a manifest per snapshot, a commit log.

    <root>/schema     an empty clone that fixes the columns
    <root>/data       data files, one folder per write, never changed
    <root>/manifests  which data files make up a snapshot
    <root>/commits    append-only log of commits; a snapshot exists once it is here
    <root>/expired    append-only log of snapshots that are given up
    <root>/staging    written intermediate tables of a running merge

Readers resolve through the commit log only. A job that stops before its commit
row leaves files that no snapshot names; maintenance removes them later. There
must be one writer per root at a time.

A merge rewrites the files that hold a matched row and carries all others over by
name. It saves work where keys are clustered in files, as with loads by date; keys
scattered over all files rewrite all of them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from staymart.local import local_frame
from staymart.operators.history import latest_snapshot
from staymart.operators.inspection import empty_like
from staymart.operators.merge import conform, find_matches, updated
from staymart.schemas import COMMIT, EXPIRED, KEY, MANIFEST, TEXT, struct
from staymart.sources.files import discard, list_files
from staymart.sources.tracking import written

Clock = Callable[[], dt.datetime]
DATA_FILE = "data/[0-9a-f]{32}/[^/]+"


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


# --- reading -----------------------------------------------------------------


def dataset_exists(spark: SparkSession, root: str) -> bool:
    return latest_commit(spark, root) is not None


def dataset_schema(spark: SparkSession, root: str) -> T.StructType:
    return spark.read.parquet(f"{root}/schema").schema


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Commit rows of the snapshots that are not expired."""
    log = spark.read.schema(COMMIT).parquet(f"{root}/commits")
    expired = spark.read.schema(EXPIRED).parquet(f"{root}/expired")
    return log.join(expired, "snapshot_id", "left_anti")


def latest_commit(spark: SparkSession, root: str) -> Row | None:
    """The newest commit row; None without a dataset or without commits."""
    if not written(spark, f"{root}/commits"):
        return None
    return latest_snapshot(commits(spark, root)).first()


def manifest(spark: SparkSession, root: str, commit: Row) -> DataFrame:
    """(file, bytes, rows) of a snapshot, file relative to the root."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/{commit['path']}")


def file_names(files: DataFrame) -> list[str]:
    """Names of data files, which the driver needs as for any listing; no rows."""
    return [row["file"] for row in files.select("file").collect()]


def read_files(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Rows of the named data files."""
    schema = dataset_schema(spark, root)
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{name}" for name in names))


def read_snapshot(spark: SparkSession, root: str, snapshot_id: int | None = None) -> DataFrame:
    """Rows of the newest snapshot, or of the given one."""
    if snapshot_id is None:
        commit = latest_commit(spark, root)
    else:
        commit = commits(spark, root).filter(F.col("snapshot_id") == snapshot_id).first()
    if commit is None:
        raise ValueError(f"no snapshot {'' if snapshot_id is None else snapshot_id} in {root}")
    return read_files(spark, root, file_names(manifest(spark, root, commit)))


# --- writing -----------------------------------------------------------------


def create_dataset(df: DataFrame, root: str, clock: Clock = now) -> Row:
    """A dataset with the columns of ``df`` and an empty first snapshot, unless
    there is one; returns its newest commit. The commit log comes last: without it
    nothing exists."""
    spark = df.sparkSession
    existing = latest_commit(spark, root)
    if existing is not None:
        return existing
    empty_like(df).coalesce(1).write.mode("overwrite").parquet(f"{root}/schema")
    local_frame(spark, [], EXPIRED).write.mode("overwrite").parquet(f"{root}/expired")
    commit(spark, root, None, "append", local_frame(spark, [], MANIFEST), clock)
    return latest_commit(spark, root)


def file_path() -> Column:
    """Path of the data file a row is in, as the scan has it."""
    return F.col("_metadata.file_path").alias("file")


def file_name() -> Column:
    """The part of ``file`` relative to the root; for distinct paths, not for rows."""
    return F.regexp_extract(F.col("file"), f"({DATA_FILE})$", 1).alias("file")


def write_data(rows: DataFrame, root: str) -> DataFrame:
    """Writes rows as new data files; returns their (file, bytes, rows).

    The counts come from the footers of the new files. Files without rows are left
    out; they go as orphans.
    """
    folder = f"{root}/data/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    back = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    size = F.col("_metadata.file_size").alias("bytes")
    counts = back.groupBy(file_path(), size).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(file_name(), "bytes", "rows")


def commit(
    spark: SparkSession,
    root: str,
    base: Row | None,
    operation: str,
    files: DataFrame,
    clock: Clock = now,
) -> int:
    """Makes ``files`` the newest snapshot; returns its id.

    ``base`` is the commit the files were derived from. If it is no longer the
    newest one, another writer was here and the commit is refused.
    """
    snapshot_id = 0 if base is None else base["snapshot_id"] + 1
    path = f"manifests/{snapshot_id}-{uuid.uuid4().hex}"
    files.select(*MANIFEST.fieldNames()).write.parquet(f"{root}/{path}")
    newest = latest_commit(spark, root)
    if (newest and newest["snapshot_id"]) != (base and base["snapshot_id"]):
        raise RuntimeError(f"{root} has got another commit meanwhile: only one writer at a time")
    at = clock().astimezone(dt.timezone.utc)
    if base is not None:
        at = max(at, base["committed_at"].astimezone(dt.timezone.utc))
    row = local_frame(spark, [(snapshot_id, at, operation, path)], COMMIT)
    row.write.mode("append").parquet(f"{root}/commits")
    return snapshot_id


def full_uri(spark: SparkSession, root: str) -> str:
    """The root as Spark resolves it, with scheme and host."""
    listed = list_files(spark, f"{root}/schema").first()["path"]
    return listed.rsplit("/schema/", 1)[0]


def staging_folder(spark: SparkSession, root: str) -> str:
    """A new folder for intermediate tables; orphan removal finds forgotten ones."""
    return f"{full_uri(spark, root)}/staging/{uuid.uuid4().hex}"


def publish_merge(source: DataFrame, root: str, key: str = KEY, clock: Clock = now) -> int:
    """Merges ``source`` into the dataset, creating it if needed; returns the
    snapshot id. ``source`` is evaluated once."""
    spark = source.sparkSession
    base = create_dataset(source, root, clock)
    old_files = manifest(spark, root, base)
    names = file_names(old_files)
    target = read_files(spark, root, names)
    rows = conform(source, target)
    if not names:
        return commit(spark, root, base, "append", write_data(rows, root), clock)

    staging = staging_folder(spark, root)
    try:
        target_keys = target.select(key, file_path()).filter(F.col(key).isNotNull())
        found = find_matches(target_keys, rows, key, staging)
        touched = file_names(found.pairs.select("file").distinct().select(file_name()))
        rewritten = updated(read_files(spark, root, touched), found.updates, key)
        rows = rewritten.unionByName(found.inserts).hint("rebalance")
        new_files = write_data(rows, root)
        replaced = local_frame(spark, [(name,) for name in touched], struct(file=TEXT))
        files = old_files.join(replaced, "file", "left_anti").unionByName(new_files)
        operation = "overwrite" if touched else "append"
        return commit(spark, root, base, operation, files, clock)
    finally:
        discard(staging)
