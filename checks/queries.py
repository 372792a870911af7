"""One query per operator. Each takes (spark, folder of tables)."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from staymart.functions.fixed_values import REGION
from staymart.operators import canonical as can
from staymart.operators import history, inspection, key_filter, merge
from staymart.plans import maintenance
from staymart.plans.booking import run_booking
from staymart.plans.sync import run_sync
from staymart.scratch import scratch_folder, stage, stage_counted
from staymart.sources import rates as rate_source
from staymart.sources import tracking
from staymart.sources.bucketed import merge_bucketed, write_bucketed
from staymart.sources.jsonl import read_checked, read_reservations
from staymart.sources.lookups import read_lookup
from staymart.sources.versions import publish_merge, read_snapshot, write_data

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return can.flatten(fx.raw_records(spark, sf_dir))


def local_time(*columns: str) -> list:
    """Timestamps without zone, the same in every engine."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


# --- sources -----------------------------------------------------------------


@query
def jsonl_date_window(spark, sf_dir):
    path = f"{scratch_folder(spark)}/raw"
    fx.raw_records(spark, sf_dir).write.json(path)
    window = read_reservations(spark, path, "1997-01-01", "1997-01-31")
    return can.flatten(window).withColumn("check_in_date", F.to_date("check_in_date"))


@query
def lookup_table(spark, sf_dir):
    path = f"{scratch_folder(spark)}/lookup"
    customer = fx.table(spark, sf_dir, "customer")
    entry = F.create_map(F.col("c_name"), F.col("c_mktsegment"))
    customer.select(F.to_json(entry)).write.text(path)
    return read_lookup(spark, path, per_line=True)


@query
def currencies_in_use(spark, sf_dir):
    return rate_source.currencies_in_use(flat(spark, sf_dir))


@query
def rates_in_use(spark, sf_dir):
    return rate_source.rates_in_use(fx.usd_rates(spark), flat(spark, sf_dir))


@query
def missing_rates(spark, sf_dir):
    return rate_source.missing_rates(fx.usd_rates(spark), flat(spark, sf_dir))


@query
def jsonl_mixed_amounts(spark, sf_dir):
    """JSON lines in which every other amount is written as text."""
    path = f"{scratch_folder(spark)}/raw"
    records = fx.raw_records(spark, sf_dir)
    amount = F.col("commission.estimate_commission_amount.booker_currency").cast("string")
    as_text = F.struct(F.struct(amount.alias("booker_currency")).alias("estimate_commission_amount"))
    odd = F.col("accommodations.reservation").cast("bigint") % 2 == 1
    records.filter(~odd).write.json(f"{path}/numbers")
    records.filter(odd).withColumn("commission", as_text).write.json(f"{path}/texts")
    back = read_reservations(spark, [f"{path}/numbers", f"{path}/texts"])
    return can.with_types(can.flatten(back)).select("transaction_id", "revenue")


@query
def rejected_lines(spark, sf_dir):
    """JSON lines of which one in seventeen is cut short: which are read, which rejected."""
    path = f"{scratch_folder(spark)}/raw"
    whole = fx.raw_records(spark, sf_dir).select("accommodations.reservation", F.to_json(F.struct("*")).alias("line"))
    short = F.col("line").substr(F.lit(1), F.length("line") - F.col("reservation").cast("int") % 5 - 1)
    cut = F.col("reservation").cast("bigint") % 17 == 0
    whole.select(F.when(cut, short).otherwise(F.col("line")).alias("value")).write.text(path)
    records, rejected = read_checked(spark, path)
    named = F.regexp_extract("line", '"reservation":"([0-9]+)"', 1)
    return can.flatten(records).select("transaction_id", F.lit(False).alias("rejected")).unionByName(
        rejected.select(named.alias("transaction_id"), F.lit(True).alias("rejected"))
    )


# --- fields ------------------------------------------------------------------


@query
def flatten_nested(spark, sf_dir):
    return flat(spark, sf_dir)


@query
def country_upper(spark, sf_dir):
    return can.with_country(flat(spark, sf_dir)).select("transaction_id", "country_code")


@query
def label_extract(spark, sf_dir):
    return can.with_label_parts(flat(spark, sf_dir)).select(
        "transaction_id", "conversion_key", "site_key", "device_code", "referral_property_id"
    )


@query
def property_prefix(spark, sf_dir):
    return can.with_property_prefix(flat(spark, sf_dir)).select("transaction_id", "property_id")


@query
def cast_types(spark, sf_dir):
    return can.with_types(flat(spark, sf_dir)).select(
        "transaction_id", "check_in_date", "check_out_date", "revenue"
    )


# --- lookups and amounts -----------------------------------------------------


@query
def status_map(spark, sf_dir):
    return can.with_status(flat(spark, sf_dir)).select("transaction_id", "status")


@query
def device_map(spark, sf_dir):
    parts = can.with_label_parts(flat(spark, sf_dir))
    return can.with_device(parts).select("transaction_id", "device")


@query
def region_map(spark, sf_dir):
    """All listed countries and one that is not, dealt out over the reservations."""
    code = F.get(F.array(*[F.lit(c.lower()) for c in fx.COUNTRIES]), F.col("transaction_id").cast("int") % len(fx.COUNTRIES))
    upper = can.with_country(flat(spark, sf_dir).withColumn("country_code", code))
    return can.with_region(upper).select("transaction_id", "country_code", "region")


AMOUNTS = ["transaction_id", "currency", "revenue", "revenue_usd"]


@query
def revenue_usd(spark, sf_dir):
    typed = can.with_types(flat(spark, sf_dir))
    return can.with_revenue_usd(typed, fx.usd_rates(spark), strict=False).select(*AMOUNTS)


@query
def revenue_usd_udf(spark, sf_dir):
    typed = can.with_types(flat(spark, sf_dir))
    asked = rate_source.fetched_rates(typed, fx.USD_RATES.get)
    return can.with_revenue_usd(typed, asked, strict=False).select(*AMOUNTS)


@query
def revenue_usd_strict(spark, sf_dir):
    """Rates for every currency in use, so that the check of the rates passes."""
    typed = can.with_types(flat(spark, sf_dir))
    return can.with_revenue_usd(typed, fx.ALL_RATES).select(*AMOUNTS)


@query
def bookings_canonical(spark, sf_dir):
    return fx.canonical(spark, sf_dir)


# --- merge -------------------------------------------------------------------


@query
def merge_upsert(spark, sf_dir):
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    return merge.merge_upsert(fx.early(rows), fx.late(rows), folder=folder)


def scattered(rows: DataFrame) -> DataFrame:
    """Every fiftieth reservation, changed, and as many new ones: keys all over the range."""
    number = F.col("transaction_id").cast("bigint")
    some = rows.filter(number % 50 == 1).withColumn("status", F.lit("X"))
    new = rows.filter(number % 50 == 2).withColumn("transaction_id", F.concat("transaction_id", F.lit("-new")))
    return some.unionByName(new)


@query
def merge_scattered(spark, sf_dir):
    """A merge whose target rows are cut by a filter of the source's keys."""
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    return merge.merge_upsert(rows, scattered(rows), folder=folder, bloom=True)


@query
def merge_filter_counts(spark, sf_dir):
    """How many target rows have a key of the source, and that all of these pass the filter."""
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    source = scattered(rows)
    built = key_filter.key_filter(source.select("transaction_id"), "transaction_id", folder)
    tested = key_filter.with_test(rows.select("transaction_id"), "transaction_id", built, "passes")
    held = source.select("transaction_id", F.lit(True).alias("held"))
    both = tested.join(held, "transaction_id", "left")
    return both.agg(
        F.count_if("held").alias("held"),
        F.count_if(F.col("held") & F.col("passes")).alias("held_and_passing"),
        (F.count_if("passes") < 0.1 * F.count("*")).alias("most_are_cut"),
    )


@query
def merge_bucketed_table(spark, sf_dir):
    """The merge of two periods into a bucketed table, of which a third has no key."""
    folder = scratch_folder(spark)
    rows = stage(unkeyed(fx.canonical(spark, sf_dir)), folder, "rows")
    name = f"staymart_{uuid.uuid4().hex}"
    table = write_bucketed(fx.early(rows), name, f"{folder}/table", 8)
    try:
        return stage(merge_bucketed(table, fx.late(rows), folder), folder, "merged")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the catalog's entry; the files are the folder's


def unkeyed(rows: DataFrame) -> DataFrame:
    number = F.col("transaction_id").cast("bigint")
    return rows.withColumn("transaction_id", F.when(number % 3 > 0, F.col("transaction_id")))


@query
def merge_rerun(spark, sf_dir):
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    once = merge.merge_upsert(fx.early(rows), fx.late(rows), folder=folder)
    return merge.merge_upsert(once, fx.late(rows), folder=folder)


@query
def merge_actions(spark, sf_dir):
    rows = fx.canonical(spark, sf_dir)
    return merge.merge_actions(fx.early(rows), fx.late(rows))


@query
def merge_repeated_keys(spark, sf_dir):
    """A third of the rows has no key; some target keys and some new keys are held
    by several rows."""
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    number = F.col("transaction_id").cast("bigint")
    keyed = unkeyed(rows)

    def repeat(part: DataFrame, times) -> DataFrame:
        copies = F.array_repeat(F.lit(0), F.coalesce(times, F.lit(1)))
        return part.withColumn("copy", F.explode(copies)).drop("copy")

    target = repeat(fx.early(keyed), (1 + number % 2).cast("int"))
    is_new = F.col("check_in_date") > F.lit(fx.EARLY_END)
    source = repeat(fx.late(keyed), F.when(is_new, (1 + number % 2).cast("int")))
    return merge.merge_upsert(target, source, folder=folder)


@query
def external_upsert(spark, sf_dir):
    folder = scratch_folder(spark)
    rows = stage(fx.canonical(spark, sf_dir), folder, "rows")
    return merge.keyed_upsert(fx.early(rows), fx.late(rows), folder=folder)


# --- versioned data ----------------------------------------------------------


def published(spark: SparkSession, sf_dir: str) -> str:
    """A dataset made by two merges; returns its root."""
    root = f"{scratch_folder(spark)}/bookings"
    rows = fx.canonical(spark, sf_dir)
    publish_merge(fx.early(rows), root)
    publish_merge(fx.late(rows), root)
    return root


@query
def booking_job(spark, sf_dir):
    """Two overlapping date windows of JSON lines, loaded one after the other. What is in
    both has changed in the second."""
    folder = scratch_folder(spark)
    records = fx.raw_records(spark, sf_dir)
    records.write.json(f"{folder}/raw/first")
    fx.amended(records).write.json(f"{folder}/raw/second")
    regions = [(json.dumps(REGION, indent=2),)]
    spark.createDataFrame(regions, "value string").coalesce(1).write.text(f"{folder}/regions")
    for part, *window in (("first", "1995-01-01", "1998-12-31"), ("second", "1998-01-01", "2001-12-31")):
        run_booking(
            spark,
            f"{folder}/raw/{part}",
            f"{folder}/bookings",
            *window,
            region=read_lookup(spark, f"{folder}/regions"),
            rates=fx.usd_rates(spark),
            strict_rates=False,
        )
    return read_snapshot(spark, f"{folder}/bookings")


@query
def published_current(spark, sf_dir):
    return read_snapshot(spark, published(spark, sf_dir))


@query
def published_earlier(spark, sf_dir):
    return read_snapshot(spark, published(spark, sf_dir), snapshot_id=1)


@query
def row_count(spark, sf_dir):
    return inspection.row_count(fx.canonical(spark, sf_dir))


@query
def schema_listing(spark, sf_dir):
    return inspection.schema_listing(fx.canonical(spark, sf_dir))


@query
def dataset_compare(spark, sf_dir):
    return inspection.compare_datasets(fx.canonical(spark, sf_dir), flat(spark, sf_dir))


@query
def content_compare(spark, sf_dir):
    """Which reservations differ from a copy in which some are gone, changed, or there twice."""
    rows = fx.canonical(spark, sf_dir)
    rest = F.col("transaction_id").cast("bigint") % 100
    copy = rows.filter(rest != 3).withColumn("device", F.when(rest != 5, F.col("device")).otherwise("X"))
    return inspection.compare_content(rows, copy.unionByName(rows.filter(rest == 7)), "transaction_id")


@query
def rows_processed(spark, sf_dir):
    """Rows moved into a keyed store, counted while they are staged, and rows it then has."""
    folder = scratch_folder(spark)
    rows = fx.canonical(spark, sf_dir)
    target = stage(fx.early(rows), folder, "target")
    moved, n = stage_counted(fx.late(rows), folder, "moved")
    stored = merge.keyed_upsert(target, moved, folder=folder)
    return stored.agg(F.lit(n).cast("bigint").alias("moved"), F.count("*").alias("stored"))


# --- history and sync --------------------------------------------------------


@query
def snapshot_history(spark, sf_dir):
    ordered = history.snapshot_history(fx.commit_log(spark, sf_dir))
    return ordered.select("snapshot_id", *local_time("committed_at"), "operation")


@query
def latest_snapshot(spark, sf_dir):
    newest = history.latest_snapshot(fx.commit_log(spark, sf_dir))
    return newest.select("snapshot_id", *local_time("committed_at"))


@query
def tracking_log(spark, sf_dir):
    path = f"{scratch_folder(spark)}/tracking"
    tracking.create_tracking(spark, path)
    log = fx.commit_log(spark, sf_dir)
    fx.syncs(log).write.mode("append").parquet(path)
    newest = history.latest_snapshot(log).first()["snapshot_id"]
    at = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
    tracking.record_sync(spark, path, newest, at)
    return tracking.tracking_log(spark, path).select("snapshot_id", *local_time("processed_at"))


@query
def last_tracked(spark, sf_dir):
    newest = history.last_tracked(fx.syncs(fx.commit_log(spark, sf_dir)))
    return newest.select("snapshot_id", *local_time("processed_at"))


@query
def sync_decision(spark, sf_dir):
    log = fx.commit_log(spark, sf_dir)
    return history.sync_decision(log, fx.syncs(log))


@query
def sync_run(spark, sf_dir):
    """Load, sync, sync again, load more, sync: what each sync decided and moved,
    and how many rows the store had then. The store is a keyed dataset."""
    folder = scratch_folder(spark)
    root, store = f"{folder}/bookings", f"{folder}/store"

    def upsert(rows: DataFrame) -> int:
        merge.require_key(rows, "transaction_id")
        merge.require_unique_key(rows, "transaction_id")
        rows, n = stage_counted(rows, folder, "moved")
        publish_merge(rows, store)
        return n

    rows = fx.canonical(spark, sf_dir)
    runs = []
    for part in (fx.early(rows), None, fx.late(rows)):
        if part is not None:
            publish_merge(part, root)
        report = run_sync(spark, root, f"{folder}/tracking", upsert)
        stored = read_snapshot(spark, store).count()
        runs.append((len(runs) + 1, report.decision, report.snapshot_id, report.rows, stored))
    return spark.createDataFrame(
        runs, "run bigint, decision string, snapshot_id bigint, rows_moved bigint, stored bigint"
    )


# --- maintenance -------------------------------------------------------------


@query
def compact_files(spark, sf_dir):
    root = published(spark, sf_dir)
    maintenance.compact_files(spark, root, min_files=2)
    return read_snapshot(spark, root)


@query
def expire_snapshots(spark, sf_dir):
    log = fx.commit_log(spark, sf_dir)
    old = history.expirable_snapshots(log, maintenance.RETAIN_LAST)
    return old.select("snapshot_id", *local_time("committed_at"), "operation")


@query
def orphan_files(spark, sf_dir):
    """The rows in files that a broken-off write left behind."""
    root = f"{scratch_folder(spark)}/bookings"
    rows = fx.canonical(spark, sf_dir)
    publish_merge(fx.early(rows), root)
    write_data(fx.late(rows), root)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=4)
    orphans = maintenance.orphan_files(spark, root, clock=lambda: later)
    paths = [row["path"] for row in orphans.select("path").collect()]
    return spark.read.schema(rows.schema).parquet(*paths)
