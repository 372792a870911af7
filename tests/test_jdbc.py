"""Statements are run in the SQL engine that also checks the queries; the JDBC
row traffic needs a database server and is not covered."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from staymart.schemas import CANONICAL
from staymart.sources import jdbc


def test_ddl_of_the_canonical_table():
    sql = jdbc.create_table_sql(CANONICAL, "public.bookings", "transaction_id")
    assert sql.startswith(
        'CREATE TABLE IF NOT EXISTS "public"."bookings" ("transaction_id" TEXT PRIMARY KEY, '
    )
    assert '"check_in_date" DATE' in sql and '"revenue_usd" NUMERIC(18,2)' in sql


def test_names_are_quoted():
    assert jdbc.quoted('a.b"c') == '"a"."b""c"'


def test_unsupported_type(spark):
    with pytest.raises(ValueError, match="array<int>"):
        jdbc.column_type(spark.sql("SELECT array(1) AS a").schema["a"].dataType)


def test_upsert_statement():
    sql = jdbc.upsert_sql(["k", "v"], "t", "s", "k")
    assert sql == (
        'INSERT INTO "t" ("k", "v") SELECT DISTINCT "k", "v" FROM "s" '
        'ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert jdbc.upsert_sql(["k"], "t", "s", "k").endswith('ON CONFLICT ("k") DO NOTHING')


class Shared:
    """A connection whose close() leaves the in-process data in place."""

    def __init__(self, db):
        self.db = db

    def cursor(self):
        self.db.begin()
        return self.db

    def commit(self):
        self.db.commit()

    def close(self):
        try:
            self.db.rollback()
        except duckdb.Error:
            pass


@pytest.fixture
def db():
    connection = duckdb.connect()
    yield connection
    connection.close()


def stage_into(db, tmp_path, twice=False):
    """Stages over Parquet files instead of JDBC, one or two times."""

    def write(rows, table):
        path = f"{tmp_path}/{table}"
        rows.write.parquet(path)
        for _ in range(2 if twice else 1):
            db.execute(f"INSERT INTO {jdbc.quoted(table)} SELECT * FROM read_parquet('{path}/*.parquet')")

    return write


DDL = "transaction_id string, day date, amount decimal(18,2)"
DAY = dt.date(2026, 5, 1)


@pytest.mark.parametrize("twice", [False, True])
def test_upsert_inserts_updates_and_keeps(spark, db, tmp_path, twice):
    def upsert(*rows):
        df = spark.createDataFrame(list(rows), DDL)
        return jdbc.upsert_table(df, "bookings", lambda: Shared(db), stage_into(db, tmp_path, twice))

    assert upsert(("a", DAY, Decimal("1.00")), ("b", None, None)) == 2
    assert upsert(("b", DAY, Decimal("2.50")), ("c", DAY, Decimal("3.00"))) == 2
    assert upsert() == 0
    assert db.execute("SELECT * FROM bookings ORDER BY 1").fetchall() == [
        ("a", DAY, Decimal("1.00")), ("b", DAY, Decimal("2.50")), ("c", DAY, Decimal("3.00")),
    ]
    tables = [r[0] for r in db.execute("SELECT table_name FROM information_schema.tables").fetchall()]
    assert tables == ["bookings"]


def test_bad_keys_are_refused_before_any_statement(spark):
    def no_connection():
        raise AssertionError("connected")

    def upsert(df):
        jdbc.upsert_table(df, "bookings", no_connection, None)

    with pytest.raises(ValueError, match="must have the column"):
        upsert(spark.createDataFrame([(1,)], "v int"))
    with pytest.raises(ValueError, match="NULL"):
        upsert(spark.createDataFrame([(None, DAY, None)], DDL))
    with pytest.raises(ValueError, match="twice"):
        upsert(spark.createDataFrame([("a", DAY, None), ("a", None, None)], DDL))


def test_failed_staging_changes_nothing_and_cleans_up(spark, db, tmp_path):
    stage = stage_into(db, tmp_path)

    def fails(rows, table):
        stage(rows, table)
        raise ConnectionError

    df = spark.createDataFrame([("a", DAY, None)], DDL)
    with pytest.raises(ConnectionError):
        jdbc.upsert_table(df, "bookings", lambda: Shared(db), fails)
    assert db.execute("SELECT count(*) FROM bookings").fetchone() == (0,)
    assert db.execute("SELECT count(*) FROM information_schema.tables").fetchone() == (1,)


def test_parallel_read_options(monkeypatch, spark):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, name, value):
            seen[name] = value
            return self

        def options(self, **more):
            seen.update(more)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    frame = jdbc.jdbc_read(
        Session(), "jdbc:x", "bookings", {"fetchsize": "1000"}, "check_in_date", (DAY, DAY), 4
    )
    assert frame == "frame"
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "bookings", "fetchsize": "1000",
        "partitionColumn": "check_in_date", "lowerBound": "2026-05-01",
        "upperBound": "2026-05-01", "numPartitions": "4",
    }
