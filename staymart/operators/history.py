"""Snapshot history, sync tracking and the decision between them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def snapshot_history(commits: DataFrame) -> DataFrame:
    """(snapshot_id, committed_at, operation), newest first."""
    return commits.select("snapshot_id", "committed_at", "operation").orderBy(
        F.desc("committed_at"), F.desc("snapshot_id")
    )


def latest_snapshot(commits: DataFrame) -> DataFrame:
    """The newest commit, or no row; the higher id wins among equal times."""
    return commits.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(1)


def last_tracked(tracking: DataFrame) -> DataFrame:
    """The newest sync record, or no row."""
    return tracking.orderBy(F.desc("processed_at"), F.desc("snapshot_id")).limit(1)


def sync_decision(commits: DataFrame, tracking: DataFrame) -> DataFrame:
    """One row (latest_id, tracked_id, decision).

    ``none`` without a snapshot, ``skip`` if the newest one is the one synced last,
    else ``full``. Ids are compared for equality only, never by order.
    """
    newest = commits.select(
        F.struct(F.col("committed_at"), "snapshot_id").alias("latest"),
        F.lit(None).cast("struct<at: timestamp, snapshot_id: bigint>").alias("tracked"),
    )
    synced = tracking.select(
        F.lit(None).cast("struct<committed_at: timestamp, snapshot_id: bigint>").alias("latest"),
        F.struct(F.col("processed_at").alias("at"), "snapshot_id").alias("tracked"),
    )
    heads = newest.unionByName(synced).agg(
        F.max("latest")["snapshot_id"].alias("latest_id"),
        F.max("tracked")["snapshot_id"].alias("tracked_id"),
    )
    decision = (
        F.when(F.col("latest_id").isNull(), "none")
        .when(F.col("latest_id") == F.col("tracked_id"), "skip")
        .otherwise("full")
    )
    return heads.withColumn("decision", decision)


def expirable_snapshots(
    commits: DataFrame, retain_last: int, committed_before: dt.datetime | None = None
) -> DataFrame:
    """Commits beyond the newest ``retain_last``, if also older than the given time.

    The retained ones are a top-n of known size, so no window over the whole log.
    """
    if retain_last < 1:
        raise ValueError("the newest snapshot is always retained")
    newest = (
        commits.orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
        .limit(retain_last)
        .select("snapshot_id")
    )
    old = commits.join(F.broadcast(newest), "snapshot_id", "left_anti")
    if committed_before is not None:
        old = old.filter(F.col("committed_at") < F.lit(committed_before))
    return old
