"""Rejected lines, counts on the way, comparison of content, rates from slow services."""

import threading
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from staymart.operators.inspection import compare_content
from staymart.scratch import stage_counted
from staymart.sources import rates
from staymart.sources.jdbc import hash_predicates
from staymart.sources.jsonl import read_checked, read_reservations

GOOD = '{"updated": "2026-05-07", "accommodations": {"reservation": "%d"}}'


def test_rejected_lines_are_told_with_their_file(spark, tmp_path):
    bad = ['{"updated": "2026-05-07"', "no json", '{"updated": "2026-05-07", "booker": "text"}', "[1, 2"]
    (tmp_path / "a.json").write_text("\n".join([GOOD % 1, bad[0], "", GOOD % 2, bad[1]]))
    (tmp_path / "b.json").write_text("\n".join([bad[2], GOOD % 3, bad[3]]))
    records, rejected = read_checked(spark, str(tmp_path))
    assert sorted(r["line"] for r in rejected.collect()) == sorted(bad)
    assert {r["file"].rsplit("/", 1)[1] for r in rejected.collect()} == {"a.json", "b.json"}
    assert sorted(r[0] for r in records.select("accommodations.reservation").collect()) == ["1", "2", "3"]
    assert records.columns == read_reservations(spark, str(tmp_path)).columns
    records, rejected = read_checked(spark, str(tmp_path), "2027-01-01")
    assert records.count() == 0 and rejected.count() == 4


def test_rejected_lines_of_good_and_of_no_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(GOOD % 1)
    (tmp_path / "b.json").write_text("")
    records, rejected = read_checked(spark, str(tmp_path))
    assert records.count() == 1 and rejected.count() == 0 and rejected.columns == ["file", "line"]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(i):
        calls.add(1)
        return i

    rows, n = stage_counted(spark.range(1_000).select(seen("id").alias("i")), str(tmp_path), "rows")
    assert n == 1_000 and rows.count() == 1_000 and calls.value == 1_000
    assert stage_counted(spark.range(0), str(tmp_path), "none")[1] == 0


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b string").repartition(3)


def test_content_names_differing_keys(spark):
    left = [("same", "x", None), ("swap", "x", None), ("gone", "x", "y"), ("twice", "x", "y"), (None, "x", "y"), ("many", "1", "1"), ("many", "2", "2")]
    right = [("many", "2", "2"), ("many", "1", "1"), ("same", "x", None), ("swap", None, "x"), ("twice", "x", "y"), ("twice", "x", "y"), ("new", "", ""), (None, "x", "z")]
    for buckets in (1, 4, 4_096):
        got = compare_content(frame(spark, left), frame(spark, right), "k", buckets).collect()
        assert {r["k"]: (r["left_rows"], r["right_rows"]) for r in got} == {
            "swap": (1, 1), "gone": (1, 0), "twice": (1, 2), None: (1, 1), "new": (0, 1),
        }
    assert compare_content(frame(spark, left), frame(spark, left[::-1]), "k").collect() == []
    assert compare_content(frame(spark, []), frame(spark, []), "k").collect() == []
    assert compare_content(frame(spark, left), frame(spark, []), "k").count() == 6


def test_equal_content_is_compared_without_a_shuffle_of_rows(spark):
    """What is shuffled first is a row per bucket; rows follow only where buckets differ."""
    rows = spark.range(10_000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    plan = compare_content(rows, rows, "k", 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "LeftSemi" in plan


def test_calls_run_side_by_side_but_not_too_many():
    lock, now, most = threading.Lock(), [0], [0]

    def slow(currency):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        return float(len(currency))

    start = time.monotonic()
    got = rates.asked_rates(slow, [f"C{i:02d}" for i in range(16)], parallel=4, timeout=5, retries=0)
    assert got == {f"C{i:02d}": 3.0 for i in range(16)}
    assert most[0] == 4 and 0.8 <= time.monotonic() - start < 2.4


def test_failing_calls_are_repeated_then_told():
    calls = {}

    def flaky(currency):
        calls[currency] = calls.get(currency, 0) + 1
        if calls[currency] < 3:
            raise OSError("service is down")
        return 2.0 if currency == "EUR" else None

    assert rates.asked_rates(flaky, ["EUR", "XTS"], 8, 5, 2) == {"EUR": 2.0, "XTS": None}
    assert calls == {"EUR": 3, "XTS": 3}
    with pytest.raises(rates.RateUnavailable, match="EUR after 2 calls.*service is down"):
        calls.clear()
        rates.asked_rates(flaky, ["EUR"], 8, 5, 1)


def test_a_call_that_hangs_is_left_behind():
    calls = []

    def hangs_once(currency):
        calls.append(currency)
        if len(calls) == 1:
            time.sleep(30)
        return 1.5

    start = time.monotonic()
    assert rates.asked_rates(hangs_once, ["JPY"], 8, 0.3, 1) == {"JPY": 1.5}
    with pytest.raises(rates.RateUnavailable, match="no answer in 0.2 s"):
        rates.asked_rates(lambda currency: time.sleep(30), ["JPY"], 8, 0.2, 1)
    assert time.monotonic() - start < 5


def test_rates_of_a_service_fail_the_job_or_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("EUR",), ("USD",), (None,), ("",), ("XTS",)], "currency string")
    got = rates.fetched_rates(rows, {"EUR": 1.1}.get, str(tmp_path), parallel=2)
    assert {r["currency"]: r["rate_to_usd"] for r in got.collect()} == {"EUR": 1.1, "USD": 1.0, "XTS": None}

    def broken(currency):
        raise OSError("down")

    with pytest.raises(Exception, match="no rate for"):
        rates.fetched_rates(rows, broken, str(tmp_path), retries=1)


def test_text_keys_are_split_into_parts_that_hold_each_row_once():
    """The predicates in an engine at hand, with its own hash in the place of the store's."""
    connection = duckdb.connect()
    connection.execute("""CREATE TABLE t AS SELECT CASE WHEN i % 10 = 0 THEN NULL WHEN i % 10 = 1 THEN ''
        ELSE 'key"' || i END AS "a key", i FROM range(1000) r(i)""")
    for hashed in ("CAST(hash({}) % 4001 AS BIGINT) - 2000", "0"):
        parts = hash_predicates("a key", 7, hashed)
        found = [i for p in parts for (i,) in connection.execute(f"SELECT i FROM t WHERE {p}").fetchall()]
        assert sorted(found) == list(range(1000))
    sizes = [connection.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in hash_predicates("a key", 7, "CAST(hash({}) % 4001 AS BIGINT) - 2000")]
    assert min(sizes) > 50
    assert hash_predicates("k", 1) == ['"k" IS NOT NULL AND MOD(MOD(hashtext("k"), 1) + 1, 1) = 0 OR "k" IS NULL']
    with pytest.raises(ValueError):
        hash_predicates("k", 0)
