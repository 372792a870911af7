"""Maintenance of a versioned dataset: compact, expire, remove orphans."""

from __future__ import annotations

import datetime as dt
import heapq
import math
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from staymart.operators.history import expirable_snapshots
from staymart.local import local_frame
from staymart.schemas import EXPIRED, MANIFEST
from staymart.sources.files import list_files, relative_to, remove_files
from staymart.sources.versions import (
    DATA_FILE,
    Clock,
    commit,
    commits,
    full_uri,
    latest_commit,
    manifest,
    now,
    read_files,
    staging_folder,
    write_data,
)

RETAIN_LAST = 5
SNAPSHOT_AGE = dt.timedelta(days=5)
ORPHAN_AGE = dt.timedelta(days=3)
TARGET_BYTES = 512 * 1024 * 1024
# Files below this share of the target size count as small.
SMALL_SHARE = 0.75
MIN_FILES = 5
# Output files of one job of a compaction; bounds its plan.
FILES_PER_JOB = 64


def compact_files(
    spark: SparkSession,
    root: str,
    target_bytes: int = TARGET_BYTES,
    min_files: int = MIN_FILES,
    clock: Clock = now,
) -> int | None:
    """Rewrites small data files into files of about the target size; rows stay
    the same. Returns the new snapshot id, or None if too few files are small.

    Nothing is shuffled: a task reads the small files that make up its output file, by
    their bytes at most 1.5 times the target. Large files are carried over.
    """
    base = latest_commit(spark, root)
    if base is None:
        return None
    files = manifest(spark, root, base)
    small = files.filter(F.col("bytes") < int(target_bytes * SMALL_SHARE))
    count, size = small.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    outputs = math.ceil((size or 0) / target_bytes)
    if count < min_files or outputs >= count:
        return None
    groups = even_groups(small.select("file", "bytes").collect(), outputs)
    kept = files.join(small.select("file"), "file", "left_anti")
    for start in range(0, len(groups), FILES_PER_JOB):
        rows = [read_files(spark, root, names).coalesce(1) for names in groups[start : start + FILES_PER_JOB]]
        # a union of single partitions alone would be a single one; the empty clone is a scan
        rows.append(read_files(spark, root, ["schema"]))
        kept = kept.unionByName(write_data(reduce(DataFrame.union, rows), root))
    return commit(spark, root, base, "replace", kept, clock)


def even_groups(files: list[Row], count: int) -> list[list[str]]:
    """Names of files in ``count`` groups of about equal bytes: the largest file first, each
    to the group that has least. A group without a file is left out."""
    groups: list[list[str]] = [[] for _ in range(count)]
    least = [(0, 0, i) for i in range(count)]
    for row in sorted(files, key=lambda r: (-r["bytes"], r["file"])):
        held, n, i = heapq.heappop(least)
        groups[i].append(row["file"])
        heapq.heappush(least, (held + row["bytes"], n + 1, i))
    return [names for names in groups if names]


def manifests_of(spark: SparkSession, root: str, log: DataFrame) -> DataFrame:
    """(file, bytes, rows) of all snapshots in a commit log; one name per snapshot is
    collected, a number that expiry keeps small."""
    paths = [f"{root}/{row['path']}" for row in log.select("path").collect()]
    if not paths:
        return local_frame(spark, [], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*paths)


def expire_snapshots(
    spark: SparkSession,
    root: str,
    retain_last: int = RETAIN_LAST,
    older_than: dt.timedelta = SNAPSHOT_AGE,
    clock: Clock = now,
) -> int:
    """Gives up all but the newest snapshots and removes the files that only they
    used. Returns how many snapshots went.

    The ids are logged first. If the job stops before the files are gone, they are
    orphans for ``remove_orphan_files``.
    """
    live = commits(spark, root)
    victims = expirable_snapshots(live, retain_last, clock() - older_than)
    gone = victims.select("snapshot_id", "path").collect()
    if not gone:
        return 0
    unused = manifests_of(spark, root, victims).select("file").distinct()
    given_up = local_frame(spark, [(row["snapshot_id"],) for row in gone], EXPIRED)
    given_up.write.mode("append").parquet(f"{root}/expired")

    still_used = manifests_of(spark, root, commits(spark, root)).select("file")
    unused = unused.join(still_used, "file", "left_anti")
    data = unused.select(F.concat(F.lit(f"{full_uri(spark, root)}/"), "file").alias("path"))
    lists = list_files(spark, *(f"{root}/{row['path']}" for row in gone)).select("path")
    remove_files(data.unionByName(lists), staging_folder(spark, root))
    return len(gone)


def orphan_files(
    spark: SparkSession,
    root: str,
    older_than: dt.timedelta = ORPHAN_AGE,
    clock: Clock = now,
) -> DataFrame:
    """(path, length, modificationTime) of data, manifest and staging files that no
    live snapshot names. Files younger than ``older_than`` may belong to a running
    write and are left out."""
    live = commits(spark, root)
    named = manifests_of(spark, root, live).select("file").distinct()
    listed = list_files(spark, root).filter(
        F.col("modificationTime") < F.lit(clock() - older_than)
    )
    data = listed.withColumn("file", relative_to("path", DATA_FILE)).filter("file != ''")
    manifests = listed.withColumn(
        "folder", F.regexp_extract("path", r"(manifests/[0-9]+-[0-9a-f]{32})/[^/]+$", 1)
    ).filter("folder != ''")
    staging = listed.filter(F.col("path").rlike(r"/staging/[0-9a-f]{32}/[^/]+/[^/]+$"))
    used = live.select(F.col("path").alias("folder"))
    return (
        data.join(named, "file", "left_anti").drop("file")
        .unionByName(manifests.join(used, "folder", "left_anti").drop("folder"))
        .unionByName(staging)
    )


def remove_orphan_files(
    spark: SparkSession,
    root: str,
    older_than: dt.timedelta = ORPHAN_AGE,
    clock: Clock = now,
) -> int:
    orphans = orphan_files(spark, root, older_than, clock)
    return remove_files(orphans, staging_folder(spark, root))


def run_maintenance(
    spark: SparkSession,
    root: str,
    target_bytes: int = TARGET_BYTES,
    min_files: int = MIN_FILES,
    retain_last: int = RETAIN_LAST,
    snapshot_age: dt.timedelta = SNAPSHOT_AGE,
    orphan_age: dt.timedelta = ORPHAN_AGE,
    clock: Clock = now,
) -> dict[str, int | None]:
    """Compact, then expire, then remove orphans."""
    return {
        "compacted_into": compact_files(spark, root, target_bytes, min_files, clock),
        "expired": expire_snapshots(spark, root, retain_last, snapshot_age, clock),
        "orphans": remove_orphan_files(spark, root, orphan_age, clock),
    }
