"""From nested raw records to canonical reservation rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from staymart.functions import fields, fixed_values
from staymart.operators.lookup_join import attach
from staymart.schemas import CANONICAL

Lookup = DataFrame | Mapping[str, str]
Rates = DataFrame | Mapping[str, float]

# Output name <- path in the raw record, and whether ids are read as text.
RAW_PATHS = {
    "transaction_id": "accommodations.reservation",
    "conversion_key": "label",
    "property_id": "accommodation_details.accommodation",
    "status": "status",
    "currency": "currencies.booker",
    "check_in_date": "start",
    "check_out_date": "end",
    "revenue": "commission.estimate_commission_amount.booker_currency",
    "travel_purpose": "booker.travel_purpose",
    "country_code": "booker.address.country",
}
TEXT_IDS = {"transaction_id", "property_id"}


def raw_field(name: str) -> Column:
    field = F.col(RAW_PATHS[name])
    if name in TEXT_IDS:
        return field.cast("string")
    return fields.as_number(field) if name == "revenue" else field


def flatten(records: DataFrame) -> DataFrame:
    """The ten fields that are used, under their canonical names. An amount may be a
    number or a number as text; other text fails the query."""
    return records.select(*(raw_field(name).alias(name) for name in RAW_PATHS))


def with_country(flat: DataFrame) -> DataFrame:
    return flat.withColumn("country_code", fields.country_code(F.col("country_code")))


def with_label_parts(flat: DataFrame) -> DataFrame:
    """Adds site_key, device_code and referral_property_id from the label."""
    label = F.col("conversion_key")
    return flat.withColumns(
        {
            "site_key": fields.site_key(label),
            "device_code": fields.device_code(label),
            "referral_property_id": fields.referral_property_id(label),
        }
    )


def with_property_prefix(flat: DataFrame) -> DataFrame:
    return flat.withColumn("property_id", fields.property_id(F.col("property_id")))


def with_status(flat: DataFrame, status: Lookup = fixed_values.STATUS) -> DataFrame:
    """Mapped status, or the original where the lookup has none."""
    found = attach(flat, status, "status", "mapped_status")
    return found.withColumn("status", F.coalesce("mapped_status", "status")).drop("mapped_status")


def with_device(flat: DataFrame, device: Lookup = fixed_values.DEVICE) -> DataFrame:
    return attach(flat, device, "device_code", "device")


def with_region(flat: DataFrame, region: Lookup = fixed_values.REGION) -> DataFrame:
    return attach(flat, region, "country_code", "region")


def with_types(flat: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Both dates as date, revenue as decimal(18,2)."""
    return flat.withColumns(
        {
            "check_in_date": fields.as_date(F.col("check_in_date"), lenient_dates),
            "check_out_date": fields.as_date(F.col("check_out_date"), lenient_dates),
            "revenue": fields.as_amount(F.col("revenue")),
        }
    )


def with_revenue_usd(typed: DataFrame, rates: Rates, strict: bool = True) -> DataFrame:
    """Adds revenue_usd; rows without a usable currency get NULL.

    A usable currency without a rate fails the query, or gives NULL if not
    strict. The check is part of the row expression, so it costs no second pass.
    """
    found = attach(typed, rates, "currency", "rate", key="currency", value="rate_to_usd")
    rate = F.col("rate")
    if strict:
        unknown = F.concat(F.lit("no rate to USD for currency "), F.col("currency"))
        rate = F.when(
            rate.isNull() & fields.usable_currency(F.col("currency")),
            F.raise_error(unknown).cast("double"),
        ).otherwise(rate)
    return found.withColumn("revenue_usd", fields.converted(F.col("revenue"), rate)).drop("rate")


def canonical_reservations(
    records: DataFrame,
    rates: Rates,
    region: Lookup = fixed_values.REGION,
    status: Lookup = fixed_values.STATUS,
    device: Lookup = fixed_values.DEVICE,
    strict_rates: bool = True,
    lenient_dates: bool = False,
) -> DataFrame:
    """Canonical rows of raw records: one output row per record, no shuffle
    while the lookups are small enough to be broadcast."""
    flat, label = flatten(records), F.col("conversion_key")
    made = {
        "property_id": fields.property_id(F.col("property_id")),
        "check_in_date": fields.as_date(F.col("check_in_date"), lenient_dates),
        "check_out_date": fields.as_date(F.col("check_out_date"), lenient_dates),
        "revenue": fields.as_amount(F.col("revenue")),
        "country_code": fields.country_code(F.col("country_code")),
        "site_key": fields.site_key(label),
        "device_code": fields.device_code(label),
        "referral_property_id": fields.referral_property_id(label),
    }
    rows = with_region(with_device(with_status(flat.withColumns(made), status), device), region)
    return with_revenue_usd(rows, rates, strict_rates).select(*CANONICAL.fieldNames())
