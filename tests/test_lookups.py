import pytest
from pyspark.sql import functions as F

from staymart.operators.lookup_join import attach, checked_size
from staymart.sources import rates
from staymart.sources.lookups import read_lookup


def test_pretty_printed_object(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text('{\n  "NA": "Africa",\n  "m": "mobile",\n  "m": "mobile phone",\n  "é": "ü"\n}')
    rows = {r["key"]: r["value"] for r in read_lookup(spark, str(path)).collect()}
    assert rows == {"NA": "Africa", "m": "mobile phone", "é": "ü"}


def test_empty_object(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text("{}")
    empty = read_lookup(spark, str(path))
    assert empty.columns == ["key", "value"] and empty.count() == 0


@pytest.mark.parametrize("per_line", [True, False])
def test_malformed_lookup_fails(spark, tmp_path, per_line):
    path = tmp_path / "codes.json"
    path.write_text('{"a": "b"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_lookup(spark, str(path), per_line).collect()


def test_object_per_line(spark, tmp_path):
    path = tmp_path / "codes.jsonl"
    path.write_text('{"a": "1", "b": "2"}\n{"c": "3"}\n')
    assert read_lookup(spark, str(path), per_line=True).count() == 3


def test_repeated_key_is_refused(spark):
    df = spark.createDataFrame([("a",)], "code string")
    twice = spark.createDataFrame([("a", "1"), ("a", "2")], "key string, value string")
    with pytest.raises(ValueError, match="more than one row"):
        attach(df, twice, "code", "found")


def test_null_keys_of_a_lookup_never_match(spark):
    df = spark.createDataFrame([(None,), ("a",)], "code string")
    odd = spark.createDataFrame([(None, "1"), (None, "2"), ("a", "3")], "key string, value string")
    assert sorted(str(r["found"]) for r in attach(df, odd, "code", "found").collect()) == ["3", "None"]


def test_size_counts_bytes(spark):
    lookup = spark.createDataFrame([("ab", "é"), ("c", None)], "key string, value string")
    assert checked_size(lookup, "key") == 2 + 2 + 1 + 2 * 64


def test_large_lookup_is_not_broadcast_and_a_hot_code_is_split(spark, tmp_path):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    ids = spark.range(0, 300_000, 1, 8)
    code = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    ids.select("id", code.alias("code")).write.parquet(f"{tmp_path}/rows")
    ids.select(F.col("id").cast("string").alias("key"), F.lit("x").alias("value")).write.parquet(
        f"{tmp_path}/lookup"
    )
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = spark.read.parquet(f"{tmp_path}/rows")
        lookup = spark.read.parquet(f"{tmp_path}/lookup")
        out = attach(rows, lookup, "code", "found", broadcast_bytes=1000).agg(
            F.count(F.lit(1)).alias("n"), F.count("found").alias("hits"), F.max("id").alias("last")
        )
        assert tuple(out.collect()[0]) == (300_000, 100_000, 299_999)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def reservations(spark, *currencies):
    return spark.createDataFrame([(c,) for c in currencies], "currency string")


def test_currencies_in_use(spark):
    df = reservations(spark, "USD", "EUR", "EUR", "", None, "usd")
    assert sorted(r[0] for r in rates.currencies_in_use(df).collect()) == ["EUR", "USD", "usd"]


def test_rates_in_use_and_missing(spark):
    table = spark.createDataFrame([("EUR", 1.1), ("GBP", 1.3)], "currency string, rate_to_usd double")
    df = reservations(spark, "EUR", "XTS", None)
    assert [tuple(r) for r in rates.rates_in_use(table, df).collect()] == [("EUR", 1.1)]
    assert [r[0] for r in rates.missing_rates(table, df).collect()] == ["XTS"]


def test_fetched_rates_ask_once_and_never_for_usd(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(currency):
        with open(f"{asked}/{currency}", "a") as log:
            log.write("x")
        return {"EUR": 1.1}.get(currency)

    df = reservations(spark, "USD", "EUR", "EUR", "XTS", "", None)
    table = rates.fetched_rates(df, fetch, str(tmp_path / "shared"))
    for _ in range(2):
        assert {r["currency"]: r["rate_to_usd"] for r in table.collect()} == {
            "USD": 1.0, "EUR": 1.1, "XTS": None,
        }
    assert {p.name: p.read_text() for p in asked.iterdir()} == {"EUR": "x", "XTS": "x"}


def test_fetched_rates_without_currencies(spark, tmp_path):
    table = rates.fetched_rates(reservations(spark, None, ""), {}.get, str(tmp_path / "shared"))
    assert table.columns == ["currency", "rate_to_usd"] and table.count() == 0
