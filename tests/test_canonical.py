import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from staymart.operators import canonical as can
from staymart.schemas import CANONICAL, RAW_RECORD

RATES = {"USD": 1.0, "EUR": 1.0838}


def record(**given):
    row = {
        "updated": "2026-05-07",
        "label": given.get("label"),
        "status": given.get("status"),
        "start": given.get("start", "2026-06-01"),
        "end": given.get("end", "2026-06-04"),
        "accommodations": {"reservation": given.get("id", "1")},
        "accommodation_details": {"accommodation": given.get("property")},
        "currencies": {"booker": given.get("currency")},
        "commission": {"estimate_commission_amount": {"booker_currency": given.get("amount")}},
        "booker": {"travel_purpose": None, "address": {"country": given.get("country")}},
    }
    return row


def rows_of(spark, *records, **options):
    raw = spark.createDataFrame(list(records), RAW_RECORD)
    options.setdefault("region", {"NA": "Africa", "GB": "Europe", "UK": "Europe", "XA": "other"})
    options.setdefault("rates", RATES)
    return can.canonical_reservations(raw, **options).collect()


def test_columns_types_and_a_whole_row(spark):
    raw = spark.createDataFrame(
        [record(label="k-foo_d-m_p-77", status="S", property="9", currency="EUR", amount=10.0, country="gb")],
        RAW_RECORD,
    )
    out = can.canonical_reservations(raw, RATES, {"GB": "Europe"})
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CANONICAL]
    assert out.first().asDict() == {
        "transaction_id": "1",
        "conversion_key": "k-foo_d-m_p-77",
        "property_id": "BC-9",
        "status": "approved",
        "currency": "EUR",
        "check_in_date": dt.date(2026, 6, 1),
        "check_out_date": dt.date(2026, 6, 4),
        "revenue": Decimal("10.00"),
        "travel_purpose": None,
        "country_code": "GB",
        "site_key": "FOO",
        "referral_property_id": "77",
        "device": "mobile",
        "region": "Europe",
        "revenue_usd": Decimal("10.84"),
    }


@pytest.mark.parametrize(
    "label, site, referral, device",
    [
        (None, None, None, None),
        ("direct", "", "", None),
        ("brand-foo_d-m", "", "", None),  # 'd-foo' comes first
        ("book-x_k-site", "X", "", None),  # 'k-x' comes first
        ("k-a_d-t_p-5", "A", "5", "tablet"),
        ("k-a_d-M_p-5", "A", "5", None),  # codes are case-sensitive
        ("d-d", "", "", "desktop"),
    ],
)
def test_label_patterns_are_unanchored(spark, label, site, referral, device):
    row = rows_of(spark, record(label=label))[0]
    assert (row["site_key"], row["referral_property_id"], row["device"]) == (site, referral, device)


@pytest.mark.parametrize(
    "status, mapped",
    [("stayed", "approved"), ("no_show", "cancelled"), ("F", "pending"), ("f", "f"),
     ("Stayed", "Stayed"), ("other", "other"), ("", ""), (None, None)],
)
def test_status_falls_back_to_the_original(spark, status, mapped):
    assert rows_of(spark, record(status=status))[0]["status"] == mapped


@pytest.mark.parametrize(
    "country, code, region",
    [("na", "NA", "Africa"), ("uk", "UK", "Europe"), ("xa", "XA", "other"),
     ("zz", "ZZ", None), ("", "", None), (None, None, None)],
)
def test_country_is_upper_cased_and_region_does_not_fall_back(spark, country, code, region):
    row = rows_of(spark, record(country=country))[0]
    assert (row["country_code"], row["region"]) == (code, region)


def test_property_prefix(spark):
    ids = [r["property_id"] for r in rows_of(spark, record(property="12.0"), record(property=None))]
    assert ids == ["BC-12.0", None]


@pytest.mark.parametrize(
    "amount, revenue", [(1.005, "1.01"), (2.675, "2.68"), (-1.005, "-1.01"), (0.004, "0.00")]
)
def test_amounts_round_half_up_on_the_shortest_decimal(spark, amount, revenue):
    row = rows_of(spark, record(amount=amount, currency="USD"))[0]
    assert row["revenue"] == Decimal(revenue) and row["revenue_usd"] == Decimal(revenue)


def test_conversion_multiplies_as_double(spark):
    row = rows_of(spark, record(amount=0.5, currency="EUR"), rates={"EUR": 1.01})[0]
    assert row["revenue_usd"] == Decimal("0.51")  # 0.505 as a double's shortest decimal


def test_amount_overflow_fails(spark):
    with pytest.raises(PySparkException, match="not an amount"):
        rows_of(spark, record(amount=1e17))


def test_currency_rules(spark):
    rows = rows_of(
        spark,
        record(id="1", amount=5.0, currency=None),
        record(id="2", amount=5.0, currency=""),
        record(id="3", amount=5.0, currency="USD"),
        record(id="4", amount=None, currency="USD"),
    )
    assert [r["revenue_usd"] for r in rows] == [None, None, Decimal("5.00"), None]


@pytest.mark.parametrize("currency", ["XTS", "usd"])
def test_unknown_currency_fails_or_is_null(spark, currency):
    with pytest.raises(PySparkException, match=f"no rate to USD for currency {currency}"):
        rows_of(spark, record(amount=5.0, currency=currency))
    assert rows_of(spark, record(amount=5.0, currency=currency), strict_rates=False)[0][
        "revenue_usd"
    ] is None


@pytest.mark.parametrize("junk", ["", "soon"])
def test_junk_dates(spark, junk):
    with pytest.raises(PySparkException, match="not a date"):
        rows_of(spark, record(start=junk))
    row = rows_of(spark, record(start=junk), lenient_dates=True)[0]
    assert row["check_in_date"] is None and row["check_out_date"] == dt.date(2026, 6, 4)


def test_partial_date(spark):
    assert rows_of(spark, record(start="2026-05"))[0]["check_in_date"] == dt.date(2026, 5, 1)


def test_empty_lookups_and_rates(spark):
    row = rows_of(spark, record(label="d-m", country="gb", status="S"), status={}, device={}, region={}, rates={})[0]
    assert (row["status"], row["device"], row["region"]) == ("S", None, None)


def test_duplicates_stay(spark):
    assert len(rows_of(spark, record(), record())) == 2


def test_plan_has_no_shuffle_and_reads_only_needed_leaves(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([record(status="S")], RAW_RECORD).write.json(path)
    raw = spark.read.schema(RAW_RECORD).json(path)
    plan = can.canonical_reservations(raw, RATES, {"GB": "Europe"})._jdf.queryExecution().toString()
    assert plan.count("BroadcastHashJoin") >= 4
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_region_lookup_as_table(spark):
    table = spark.createDataFrame([("GB", "Europe")], "key string, value string")
    assert rows_of(spark, record(country="gb"), region=table)[0]["region"] == "Europe"


def test_lazy_strictness_ignores_rows_filtered_out(spark):
    raw = spark.createDataFrame([record(id="1", currency="XTS", amount=1.0), record(id="2", currency="USD", amount=1.0)], RAW_RECORD)
    kept = raw.filter(F.col("accommodations.reservation") == "2")
    assert can.canonical_reservations(kept, RATES, {}).count() == 1
