"""Bring a relational store up to the newest snapshot of a versioned dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from staymart.operators.history import sync_decision
from staymart.local import local_frame
from staymart.schemas import COMMIT
from staymart.sources.tracking import create_tracking, record_sync, tracking_log, written
from staymart.sources.versions import Clock, commits, now, read_snapshot


@dataclass(frozen=True)
class SyncReport:
    decision: str  # none, skip or full
    snapshot_id: int | None
    rows: int


def run_sync(
    spark: SparkSession,
    root: str,
    tracking_path: str,
    upsert: Callable[[DataFrame], int],
    clock: Clock = now,
) -> SyncReport:
    """Upserts the whole newest snapshot unless it is the one synced last.

    ``upsert`` writes a frame to the store, commits and returns the row count; see
    ``staymart.sources.jdbc.upsert_table``. The snapshot is recorded after that
    only, so a run that breaks off is repeated in full, which changes nothing. The
    rows read are those of the snapshot decided on, whatever is committed meanwhile.
    """
    create_tracking(spark, tracking_path)
    if written(spark, f"{root}/commits"):
        log = commits(spark, root)
    else:
        log = local_frame(spark, [], COMMIT)
    heads = sync_decision(log, tracking_log(spark, tracking_path)).first()
    if heads["decision"] != "full":
        return SyncReport(heads["decision"], heads["latest_id"], 0)
    rows = upsert(read_snapshot(spark, root, heads["latest_id"]))
    record_sync(spark, tracking_path, heads["latest_id"], clock())
    return SyncReport("full", heads["latest_id"], rows)
