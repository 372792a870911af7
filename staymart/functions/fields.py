"""Column expressions for single reservation fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from staymart.functions import fixed_values as fixed
from staymart.schemas import AMOUNT


def site_key(label: Column) -> Column:
    """Upper-cased site of a tracking label: '' without a match, NULL for NULL."""
    return F.upper(F.regexp_extract(label, fixed.SITE_PATTERN, 1))


def device_code(label: Column) -> Column:
    return F.regexp_extract(label, fixed.DEVICE_PATTERN, 1)


def referral_property_id(label: Column) -> Column:
    return F.regexp_extract(label, fixed.REFERRAL_PATTERN, 1)


def property_id(accommodation: Column) -> Column:
    """Prefixed id; NULL stays NULL."""
    return F.concat(F.lit(fixed.PROPERTY_PREFIX), accommodation.cast("string"))


def country_code(country: Column) -> Column:
    return F.upper(country)


def checked(value: Column, kind: str | T.DataType, what: str) -> Column:
    """``value`` as another type. A value that is not of that type fails the query,
    whatever the session's ANSI setting; NULL stays NULL."""
    told = F.concat(F.lit(f"not {what}: "), value.cast("string"))
    # only a NULL result goes on to the second branch, so good values are computed once
    return F.coalesce(value.try_cast(kind), F.when(value.isNotNull(), F.raise_error(told).cast(kind)))


def as_date(text: Column, lenient: bool = False) -> Column:
    """Calendar date as written. Junk fails the query, or gives NULL if lenient."""
    return text.try_cast("date") if lenient else checked(text, "date", "a date")


def as_number(text: Column) -> Column:
    """A number, or a number written as text. Other text fails the query."""
    return checked(text, "double", "a number")


def as_amount(number: Column) -> Column:
    """decimal(18,2); what does not fit fails the query."""
    return checked(number, AMOUNT, "an amount of 16 digits and cents")


def converted(amount: Column, rate: Column) -> Column:
    """Amount times a double rate, rounded half up to cents.

    The product of decimal and double is a double on purpose: a decimal product
    would round other half-cent ties.
    """
    return as_amount(amount * rate)


def usable_currency(currency: Column) -> Column:
    """False for NULL and '', which are never converted."""
    return F.coalesce(currency != "", F.lit(False))
