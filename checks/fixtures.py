"""Reservation data derived by Spark from the ``orders`` and ``customer`` tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import literals
from staymart.local import local_frame
from staymart.operators.canonical import canonical_reservations
from staymart.operators.history import latest_snapshot
from staymart.schemas import RATES

# Long, irregular rates keep clear of half-cent ties, on which engines differ.
# XTS, which occurs in the data, has none.
USD_RATES = {currency: float(rate) for currency, rate in literals.RATES}
ALL_RATES = USD_RATES | {literals.XTS_RATE[0]: float(literals.XTS_RATE[1])}

# All listed countries, then one that is not.
COUNTRIES = [*literals.REGION, "ZZ"]

# The tables' order dates run from 1995 into 2001. The year 1998 is in both parts.
EARLY_END = dt.date(1998, 12, 31)
LATE_START = dt.date(1998, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column of the nested record <- expression over orders and customer. Covers NULL
# labels, labels without a match, unmapped statuses and devices, an unlisted and a
# NULL country, an unknown and a NULL currency.
RAW_COLUMNS = {
    "updated": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "label": """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'direct'
        ELSE concat('k-site', CAST(o_orderkey % 5 AS STRING), '_d-',
          element_at(array('m', 'd', 't', 'x'), CAST(o_orderkey % 4 + 1 AS INT)),
          '_p-', CAST(o_custkey AS STRING)) END""",
    "status": """CASE o_orderkey % 7 WHEN 0 THEN 'stayed' WHEN 1 THEN 'booked'
        WHEN 2 THEN 'cancelled_by_guest' WHEN 3 THEN 'no_show' WHEN 4 THEN NULL
        ELSE o_orderstatus END""",
    "start": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "end": "CAST(date_add(CAST(o_orderdate AS DATE), 3) AS STRING)",
    "accommodations": "named_struct('reservation', CAST(o_orderkey AS STRING))",
    "accommodation_details": "named_struct('accommodation', CAST(o_custkey AS STRING))",
    "currencies": """named_struct('booker', CASE c_nationkey % 6 WHEN 0 THEN 'USD'
        WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' WHEN 4 THEN 'XTS' END)""",
    "commission": """named_struct('estimate_commission_amount',
        named_struct('booker_currency', o_totalprice))""",
    "booker": """named_struct(
        'travel_purpose', CASE o_orderkey % 3 WHEN 0 THEN 'leisure' WHEN 1 THEN 'business' END,
        'address', named_struct('country', CASE c_nationkey % 7 WHEN 0 THEN 'us' WHEN 1 THEN 'gb'
          WHEN 2 THEN 'fr' WHEN 3 THEN 'jp' WHEN 4 THEN 'br' WHEN 5 THEN 'zz' END))""",
}


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested reservation record per order."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    both = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return both.selectExpr(*(f"{sql} AS `{name}`" for name, sql in RAW_COLUMNS.items()))


def usd_rates(spark: SparkSession) -> DataFrame:
    return local_frame(spark, USD_RATES.items(), RATES)


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_reservations(raw_records(spark, sf_dir), USD_RATES, strict_rates=False)


def amended(records: DataFrame) -> DataFrame:
    """The later raw records as they come in again: with another status and twice the amount."""
    amount = "commission.estimate_commission_amount.booker_currency"
    later = records.filter(F.col("updated") >= F.lit(str(LATE_START)))
    twice = F.struct(F.struct((F.col(amount) * 2).alias("booker_currency")).alias("estimate_commission_amount"))
    return later.withColumns({"status": F.lit("amended"), "commission": twice})


def early(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("check_in_date") <= F.lit(EARLY_END))


def late(rows: DataFrame) -> DataFrame:
    """The later orders, with a status that tells an update."""
    return rows.filter(F.col("check_in_date") >= F.lit(LATE_START)).withColumn("status", F.lit("X"))


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit log with a commit per month of orders, named by the month's last id."""
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    log = (
        table(spark, sf_dir, "orders")
        .groupBy(month.alias("committed_at"))
        .agg(F.max("o_orderkey").alias("snapshot_id"))
    )
    return log.selectExpr(
        "snapshot_id",
        "committed_at",
        """CASE month(committed_at) % 3 WHEN 0 THEN 'append' WHEN 1 THEN 'overwrite'
           ELSE 'replace' END AS operation""",
        "concat('manifests/', CAST(snapshot_id AS STRING)) AS path",
    )


def syncs(log: DataFrame) -> DataFrame:
    """A sync record an hour after each commit but the newest."""
    newest = latest_snapshot(log).select("snapshot_id")
    older = log.join(F.broadcast(newest), "snapshot_id", "left_anti")
    return older.select(
        "snapshot_id", (F.col("committed_at") + F.expr("INTERVAL 1 HOUR")).alias("processed_at")
    )
