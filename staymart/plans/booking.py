"""Load one date window of raw reservations into the versioned dataset."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import SparkSession

from staymart.functions import fixed_values
from staymart.operators.canonical import (
    Lookup,
    Rates,
    canonical_reservations,
    flatten,
)
from staymart.schemas import KEY
from staymart.sources.jsonl import read_reservations
from staymart.sources.rates import fetched_rates
from staymart.sources.versions import Clock, now, publish_merge


def run_booking(
    spark: SparkSession,
    input_path: str | list[str],
    root: str,
    updated_from: str | dt.date,
    updated_to: str | dt.date,
    rates: Rates | Callable[[str], float],
    region: Lookup = fixed_values.REGION,
    status: Lookup = fixed_values.STATUS,
    device: Lookup = fixed_values.DEVICE,
    strict_rates: bool = True,
    lenient_dates: bool = False,
    clock: Clock = now,
) -> int:
    """Read the window, make canonical rows, merge them; returns the snapshot id.

    ``rates`` is a (currency, rate_to_usd) table or dict, or a function that is asked
    for the rate of each currency in use; the table spares a pass over the input.
    """
    if not updated_from or not updated_to:
        raise ValueError("a booking load needs both dates of its window")
    records = read_reservations(spark, input_path, updated_from, updated_to, lenient_dates)
    if callable(rates):
        rates = fetched_rates(flatten(records), rates)
    rows = canonical_reservations(
        records, rates, region, status, device, strict_rates, lenient_dates
    )
    return publish_merge(rows, root, KEY, clock)
