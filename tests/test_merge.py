import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staymart.operators import merge
from staymart.operators.merge import AmbiguousMerge, keyed_upsert, merge_actions, merge_upsert

DDL = "transaction_id string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def reference_merge(target, source):
    """Row by row on the driver: what a merge means."""
    out = []
    for row in target:
        hits = [s for s in source if row[0] is not None and s[0] == row[0]]
        if len(hits) > 1:
            raise AmbiguousMerge
        out.append(hits[0] if hits else row)
    keys = {t[0] for t in target if t[0] is not None}
    return Counter(out + [s for s in source if s[0] not in keys])


CASES = {
    "update and insert": ([("a", 1), ("b", 2)], [("b", 20), ("c", 30)]),
    "null keys on both sides": ([(None, 1), ("a", 2)], [(None, 10), ("a", 20)]),
    "repeated new keys": ([("a", 1)], [("n", 2), ("n", 2), ("n", 3), ("a", 4)]),
    "repeated target keys": ([("a", 1), ("a", 2), ("b", 3)], [("a", 9)]),
    "both repeated": ([("a", 1), ("a", 1), (None, 1)], [("a", 9), ("n", 1), ("n", 1), (None, 1)]),
    "empty source": ([("a", 1), (None, 2)], []),
    "empty target": ([], [("a", 1), ("a", 2), (None, 3)]),
    "both empty": ([], []),
    "no common key": ([("a", 1)], [("b", 2)]),
    "only null keys": ([(None, 1)], [(None, 1), (None, 1)]),
    "null value becomes null": ([("a", 1)], [("a", None)]),
}


@pytest.mark.parametrize("case", CASES)
def test_merge_equals_row_by_row(spark, tmp_path, case):
    target, source = CASES[case]
    out = merge_upsert(frame(spark, *target), frame(spark, *source), folder=str(tmp_path / "s"))
    assert bag(out) == reference_merge(target, source)


@pytest.mark.parametrize("case", CASES)
def test_actions_add_up(spark, case):
    target, source = CASES[case]
    keys = {t[0] for t in target if t[0] is not None}
    changed = {s[0] for s in source if s[0] is not None}
    row = merge_actions(frame(spark, *target), frame(spark, *source)).first()
    assert row["inserted"] == sum(s[0] not in keys for s in source)
    assert row["updated"] == sum(t[0] in changed for t in target)
    assert row["kept"] == sum(t[0] not in changed for t in target)


def test_two_source_rows_for_one_target_row(spark):
    with pytest.raises(AmbiguousMerge, match="a"):
        merge_upsert(frame(spark, ("a", 1)), frame(spark, ("a", 2), ("a", 3), ("b", 1)))


def test_merge_twice_is_merge_once(spark):
    target, source = frame(spark, ("a", 1), ("b", 2)), frame(spark, ("b", 3), ("c", 4))
    once = merge_upsert(target, source)
    assert bag(merge_upsert(once, source)) == bag(once)


def test_null_key_is_inserted_on_every_run(spark):
    source = frame(spark, (None, 1))
    once = merge_upsert(frame(spark), source)
    assert bag(merge_upsert(once, source)) == {(None, 1): 2}


def test_columns_go_by_name_and_take_the_target_type(spark):
    source = spark.createDataFrame([(5, "x", "a")], "v bigint, extra string, transaction_id string")
    out = merge_upsert(frame(spark, ("a", 1)), source)
    assert out.columns == ["transaction_id", "v"] and bag(out) == {("a", 5): 1}
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int"]
    with pytest.raises(ValueError, match="lacks v"):
        merge_upsert(frame(spark), source.drop("v"))


def test_keyed_upsert_rules(spark):
    target = frame(spark, ("a", 1))
    assert bag(keyed_upsert(target, frame(spark, ("a", 2), ("b", 3)))) == {("a", 2): 1, ("b", 3): 1}
    with pytest.raises(ValueError, match="NULL"):
        keyed_upsert(target, frame(spark, (None, 2)))
    with pytest.raises(ValueError, match="twice"):
        keyed_upsert(target, frame(spark, ("n", 2), ("n", 3)))
    with pytest.raises(ValueError, match="must have the column"):
        keyed_upsert(target, frame(spark, ("a", 2)).drop("transaction_id"))


def test_source_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = frame(spark, *((str(i), i) for i in range(20))).mapInPandas(count, DDL)
    merge_upsert(frame(spark, ("1", 0)), source, folder=str(tmp_path / "s")).collect()
    assert seen.value == 20


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("repeated", [False, True])
def test_hot_target_key_is_split(spark, tmp_path, small_partitions, repeated):
    """A third of the target has one key, a third has none; the source is too large
    to broadcast. With ``repeated`` a third of the source has one new key."""
    ids = spark.range(0, 300_000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    ids.select(key.alias("transaction_id"), F.col("id").cast("int").alias("v")).write.parquet(
        f"{tmp_path}/target"
    )
    new = F.col("id").cast("string")
    if repeated:
        new = F.when(F.col("id") % 3 == 0, "new").otherwise(new)
    source = ids.select(new.alias("transaction_id"), F.lit(-1).alias("v")).union(
        spark.createDataFrame([("hot", -2)], DDL)
    )
    target = spark.read.parquet(f"{tmp_path}/target")
    out = merge_upsert(target, source, folder=f"{tmp_path}/s")
    stats = out.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("transaction_id") == "hot").alias("hot"),
        F.count_if(F.col("transaction_id").isNull()).alias("no_key"),
        F.count_if(F.col("v") == -2).alias("updated_hot"),
        F.count_if(F.col("v") == -1).alias("from_source"),
    )
    row = stats.collect()[0].asDict()
    assert row == {
        "n": 500_000, "hot": 100_000, "no_key": 100_000, "updated_hot": 100_000, "from_source": 300_000,
    }
    assert "SortMergeJoin(skew=true)" in stats._jdf.queryExecution().executedPlan().toString()


def test_small_sides_are_broadcast(spark, tmp_path):
    out = merge_upsert(frame(spark, ("a", 1)), frame(spark, ("a", 2)), folder=str(tmp_path / "s"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_target_scan_is_cut_to_the_key_range(spark, tmp_path):
    frame(spark, *((str(i), i) for i in range(100, 200))).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    seen = []
    stage = merge.stage

    def spy(df, folder, name):
        seen.append((name, df._jdf.queryExecution().toString()))
        return stage(df, folder, name)

    merge.stage = spy
    try:
        merge_upsert(target, frame(spark, ("150", 0), ("160", 0)), folder=f"{tmp_path}/s")
    finally:
        merge.stage = stage
    plan = dict(seen)["pairs"]
    assert "GreaterThanOrEqual(transaction_id,150)" in plan
    assert "LessThanOrEqual(transaction_i" in plan  # cut short in the plan text
    assert "ReadSchema: struct<transaction_id:string>" in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_merges_equal_row_by_row(spark, tmp_path, seed):
    """Few keys, so that most of them repeat; the source repeats new keys only."""
    rng = random.Random(seed)
    target = [(rng.choice("abcdefgh") if rng.random() < 0.8 else None, i) for i in range(40)]
    keys = {row[0] for row in target}
    old = [(key, 100 + i) for i, key in enumerate("abcdefgh") if key in keys and rng.random() < 0.5]
    new = [(rng.choice(["x", "y", "z", None]), 200 + i) for i in range(seed * 5)]
    out = merge_upsert(frame(spark, *target), frame(spark, *(old + new)), folder=str(tmp_path / "s"))
    assert bag(out) == reference_merge(target, old + new)
