import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException

from staymart.operators.canonical import flatten, with_types
from staymart.sources.jsonl import read_reservations


def write(tmp_path, *lines):
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(path)


def updates(df):
    return sorted((r["updated"] for r in df.collect()), key=lambda v: (v is not None, v))


def test_window_is_inclusive_and_drops_missing_dates(spark, tmp_path):
    days = ["2026-05-06", "2026-05-07", "2026-05-08", "2026-05-09"]
    path = write(tmp_path, *({"updated": d} for d in days), {"updated": None}, {"label": "x"})
    assert updates(read_reservations(spark, path, "2026-05-07", "2026-05-08")) == days[1:3]
    assert updates(read_reservations(spark, path, updated_from="2026-05-08")) == days[2:]
    assert updates(read_reservations(spark, path, updated_to=dt.date(2026, 5, 6))) == days[:1]


def test_no_or_empty_bounds_return_every_row(spark, tmp_path):
    path = write(tmp_path, {"updated": "2026-05-06"}, {"updated": None}, {"updated": ""})
    assert read_reservations(spark, path).count() == 3
    assert read_reservations(spark, path, "", "").count() == 3


def test_date_as_written_counts_whatever_the_offset(spark, tmp_path):
    late = ["2026-05-07T23:30:00-08:00", "2026-05-07T00:10:00+09:00", "2026-05-07 12:00:00"]
    path = write(tmp_path, *({"updated": d} for d in late), {"updated": "2026-05-08T00:00:00Z"})
    found = read_reservations(spark, path, "2026-05-07", "2026-05-07")
    assert updates(found) == sorted(late)


def test_month_without_day_is_its_first_day(spark, tmp_path):
    path = write(tmp_path, {"updated": "2026-05"})
    assert read_reservations(spark, path, "2026-05-01", "2026-05-01").count() == 1


@pytest.mark.parametrize("junk", ["", "soon"])
def test_junk_date_fails_unless_lenient(spark, tmp_path, junk):
    path = write(tmp_path, {"updated": junk}, {"updated": "2026-05-07"})
    with pytest.raises(PySparkException, match="not a date"):
        read_reservations(spark, path, "2026-05-01").collect()
    lenient = read_reservations(spark, path, "2026-05-01", lenient_dates=True)
    assert updates(lenient) == ["2026-05-07"]


def test_junk_bound_fails(spark, tmp_path):
    path = write(tmp_path, {"updated": "2026-05-07"})
    with pytest.raises(PySparkException, match="not a date"):
        read_reservations(spark, path, "next week").collect()


def test_malformed_line_is_an_empty_record_that_a_bound_removes(spark, tmp_path):
    path = write(tmp_path, {"updated": "2026-05-07"}, '{"updated": "2026-05-07", ')
    assert read_reservations(spark, path).count() == 2
    assert read_reservations(spark, path, "2026-05-07").count() == 1


def test_absent_nested_fields_are_null_and_ids_are_text(spark, tmp_path):
    path = write(
        tmp_path,
        {"accommodations": {"reservation": 12}, "accommodation_details": {"accommodation": 7}},
        {"accommodations": {}, "booker": {"address": None}},
    )
    rows = flatten(read_reservations(spark, path)).collect()
    assert sorted((r["transaction_id"], r["property_id"]) for r in rows if r["transaction_id"]) == [
        ("12", "7")
    ]
    assert all(r["country_code"] is None and r["revenue"] is None for r in rows)


def test_several_paths(spark, tmp_path):
    one, two = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    one.write_text('{"updated": "2026-05-07"}\n')
    two.write_text('{"updated": "2026-05-08"}\n')
    assert read_reservations(spark, [str(one), str(two)], "2026-05-01").count() == 2


def test_late_records_in_another_days_folder_are_found(spark, tmp_path):
    days = ["2026-05-06", "2026-05-07", "2026-05-08"]
    for day in days:
        folder = tmp_path / f"day={day}"
        folder.mkdir()
        (folder / "a.jsonl").write_text(json.dumps({"updated": day}))
    (tmp_path / "day=2026-05-08" / "late.jsonl").write_text(json.dumps({"updated": days[1]}))
    found = read_reservations(spark, str(tmp_path), days[1], days[1])
    assert updates(found) == [days[1]] * 2


@pytest.fixture(params=["true", "false"])
def either_ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def amount(value):
    return {"commission": {"estimate_commission_amount": {"booker_currency": value}}}


def test_amounts_as_numbers_and_as_text(spark, tmp_path, either_ansi):
    path = write(tmp_path, amount("12.50"), amount(12.5), amount(None), amount(1.5e7), amount("-3"))
    rows = with_types(flatten(read_reservations(spark, path))).collect()
    assert [r["revenue"] and float(r["revenue"]) for r in rows] == [12.5, 12.5, None, 1.5e7, -3.0]


@pytest.mark.parametrize("junk", ["abc", "", "1e30", 1e17, "NaN"])
def test_junk_and_overflowing_amounts_fail_in_either_mode(spark, tmp_path, either_ansi, junk):
    path = write(tmp_path, amount(junk), amount(1))
    with pytest.raises(PySparkException, match="not a"):
        with_types(flatten(read_reservations(spark, path))).collect()


def test_junk_dates_fail_in_either_mode(spark, tmp_path, either_ansi):
    path = write(tmp_path, {"updated": "2026-05-07", "start": "soon"})
    with pytest.raises(PySparkException, match="not a date: soon"):
        with_types(flatten(read_reservations(spark, path))).collect()
    with pytest.raises(PySparkException, match="not a date: soon"):
        read_reservations(spark, path, "soon").collect()
