import os

import pytest

from staymart.operators import inspection as look
from staymart.operators.merge import merge_upsert
from staymart.scratch import scratch_folder
from staymart.sources.files import scratch
from staymart.sources.rates import fetched_rates


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")


def test_schema_listing_is_in_column_order(df):
    assert [tuple(r) for r in look.schema_listing(df).collect()] == [(1, "k", "string"), (2, "v", "int")]


def test_count_preview_and_empty_clone(df):
    assert look.row_count(df).first()["row_count"] == 2
    assert look.preview(df, 1).count() == 1 and look.preview(df).count() == 2
    clone = look.empty_like(df)
    assert clone.schema == df.schema and clone.count() == 0


def test_table_exists(spark, df):
    assert not look.table_exists(spark, "some_bookings")
    df.createOrReplaceTempView("some_bookings")
    assert look.table_exists(spark, "some_bookings")
    spark.catalog.dropTempView("some_bookings")


def test_compare(spark, df):
    other = spark.createDataFrame([("a", 1.0, True)], "k string, v double, w boolean")
    rows = sorted(tuple(r) for r in look.compare_datasets(df, other).collect())
    assert rows == [
        ("k", "string", "string", True, 2, 1),
        ("v", "int", "double", False, 2, 1),
        ("w", None, "boolean", False, 2, 1),
    ]


def test_scratch_folders_are_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark), scratch_folder(spark)
    assert one != two and one.startswith(base)


def test_scratch_without_the_setting_lies_in_the_warehouse():
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: "/shared/wh/" if "warehouse" in name else default)

    assert scratch_folder(Session()).startswith("/shared/wh/scratch/")


def test_no_folder_is_left_after_a_merge_or_after_asking_for_rates(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    rows = spark.createDataFrame([("a", "EUR"), ("b", "USD")], "transaction_id string, currency string")
    with scratch(spark) as folder:
        assert merge_upsert(rows, rows, folder=folder).count() == 2
        assert fetched_rates(rows, {"EUR": 2.0}.get, folder=folder).count() == 2
        assert set(os.listdir(base)) != before
    assert set(os.listdir(base)) == before
