"""Filters of source keys and bucketed targets."""

import uuid

import pytest
from pyspark.sql import functions as F

from staymart.operators import key_filter, merge
from staymart.sources import bucketed

ROWS = "transaction_id string, v long"


def rows_of(frame):
    return sorted((r["transaction_id"] or "", r["v"]) for r in frame.collect())


def target(spark, n=20_000):
    """A third of the rows has no key, a third one and the same, the others one each."""
    key = "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'hot' ELSE CAST(id AS STRING) END AS transaction_id"
    return spark.range(n).selectExpr(key, "id AS v").repartition(4)


def source(spark, n=20_000):
    some = spark.range(0, n, 101).selectExpr("CAST(id AS STRING) AS transaction_id", "-id AS v")
    return some.union(spark.createDataFrame([("hot", 7), (None, 8), (None, 9)], ROWS))


def test_no_key_is_lost_and_few_others_pass(spark, tmp_path):
    keys = spark.range(0, 3_000_000, 1_000).selectExpr("CAST(id AS STRING) AS k")
    rows = spark.range(0, 3_000_000, 50).selectExpr("CAST(id AS STRING) AS k", "id % 1000 = 0 AS held").union(spark.sql("SELECT CAST(NULL AS STRING), false"))
    built = key_filter.key_filter(keys, "k", str(tmp_path))
    tested = key_filter.with_test(rows, "k", built, "passes")
    counts = {(r["held"], r["passes"]): r["count"] for r in tested.groupBy("held", "passes").count().collect()}
    assert counts[(True, True)] == 3_000 and (True, False) not in counts
    assert counts[(False, True)] < 0.05 * counts[(False, False)]
    plan = tested._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_a_full_filter_still_loses_no_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_filter, "MOST_WORDS", 2)
    keys = spark.range(5_000).withColumnRenamed("id", "k")
    built = key_filter.key_filter(keys, "k", str(tmp_path))
    assert built[1] == 2 and key_filter.passing(keys, "k", built).count() == 5_000
    none = key_filter.key_filter(keys.limit(0), "k", str(tmp_path))
    assert key_filter.passing(keys, "k", none).count() == 0


def test_rows_entering_the_join_fall(spark, tmp_path):
    """The pairs of a match, and the rows that reach the join, with and without the filter."""
    rows = spark.range(100_000).selectExpr("CAST(id AS STRING) AS transaction_id", "id AS v")
    new = spark.range(0, 100_000, 500).selectExpr("CAST(id AS STRING) AS transaction_id", "-id AS v")
    built = key_filter.key_filter(new.select("transaction_id"), "transaction_id", str(tmp_path))
    assert key_filter.passing(rows, "transaction_id", built).count() < 0.05 * rows.count()
    plain, cut = (merge.merge_upsert(rows, new, folder=str(tmp_path), bloom=b) for b in (False, True))
    assert rows_of(plain) == rows_of(cut)


def test_merges_agree_with_hot_and_missing_keys(spark, tmp_path):
    wanted = rows_of(merge.merge_upsert(target(spark), source(spark), folder=str(tmp_path)))
    assert rows_of(merge.merge_upsert(target(spark), source(spark), folder=str(tmp_path), bloom=True)) == wanted
    name = f"t_{uuid.uuid4().hex}"
    table = bucketed.write_bucketed(target(spark), name, f"{tmp_path}/table", 5)
    try:
        for most in (100, 10**6):
            assert rows_of(bucketed.merge_bucketed(table, source(spark), f"{tmp_path}/{most}", most)) == wanted
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_buckets_of_the_target_are_not_shuffled(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    table = bucketed.write_bucketed(target(spark), name, f"{tmp_path}/table", 5)
    try:
        frame = bucketed.merge_bucketed(table, source(spark), f"{tmp_path}/s", 100)
        plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        before_scan = plan[: plan.index("Bucketed: true")]
        side = before_scan[before_scan.rindex("SortMergeJoin") :]  # from the join down to the buckets
        assert "Exchange hashpartitioning" not in side
        # the hot key and rows without one are read past the buckets, and broadcast-joined
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") >= 2
        hot = bucketed.hot_keys(table, spark, 100)
        assert [r[0] for r in hot.collect()] == ["hot"]
        assert "Exchange hashpartitioning" not in hot._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_ambiguous_sources_are_refused_everywhere(spark, tmp_path):
    twice = spark.createDataFrame([("hot", 1), ("hot", 2)], ROWS)
    name = f"t_{uuid.uuid4().hex}"
    table = bucketed.write_bucketed(target(spark, 300), name, f"{tmp_path}/table", 2)
    try:
        with pytest.raises(merge.AmbiguousMerge):
            bucketed.merge_bucketed(table, twice, f"{tmp_path}/a")
        with pytest.raises(merge.AmbiguousMerge):
            merge.merge_upsert(target(spark, 300), twice, folder=str(tmp_path), bloom=True)
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_a_store_with_a_key_refuses_by_the_same_look(spark, tmp_path):
    for rows, told in (([("a", 1), (None, 2)], "NULL"), ([("a", 1), ("a", 2)], "twice")):
        with pytest.raises(ValueError, match=told):
            merge.keyed_upsert(target(spark, 30), spark.createDataFrame(rows, ROWS), folder=str(tmp_path))


def test_target_is_read_once_and_keyless_rows_are_dealt_out(spark, tmp_path):
    target(spark).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    updates = source(spark).where(F.col("transaction_id").isNotNull())
    frame = merge.updated(rows, updates, "transaction_id")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    assert frame.where("transaction_id IS NULL").count() == rows.where("transaction_id IS NULL").count()
