"""Exchange rates to USD for the currencies in the data."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from staymart.functions.fields import usable_currency
from staymart.scratch import scratch_folder, stage


def currencies_in_use(reservations: DataFrame) -> DataFrame:
    """Distinct currencies, without NULL and ''."""
    return reservations.select("currency").filter(usable_currency(F.col("currency"))).distinct()


def rates_in_use(rates: DataFrame, reservations: DataFrame) -> DataFrame:
    """The rates of currencies that occur in the reservations."""
    return rates.join(currencies_in_use(reservations), "currency", "left_semi")


def missing_rates(rates: DataFrame, reservations: DataFrame) -> DataFrame:
    """Currencies in use that have no rate."""
    return currencies_in_use(reservations).join(rates, "currency", "left_anti")


class RateUnavailable(RuntimeError):
    """A service gave no answer for a currency, however often it was asked."""


def asked_together(
    fetch: Callable[[str], float | None], currencies: list[str], timeout: float
) -> dict[str, float | None | Exception]:
    """The answers, or what was raised, of one call per currency, all at the same time. A call
    without an answer in time is left behind; its thread does not keep the worker alive."""
    answers: queue.Queue = queue.Queue()

    def ask(currency: str) -> None:
        try:
            answers.put((currency, fetch(currency)))
        except Exception as error:  # whatever the service raises is the caller's to see
            answers.put((currency, error))

    for currency in currencies:
        threading.Thread(target=ask, args=(currency,), daemon=True).start()
    found: dict[str, float | None | Exception] = {}
    end = time.monotonic() + timeout
    while len(found) < len(currencies):
        try:
            currency, answer = answers.get(timeout=max(0.0, end - time.monotonic()))
            found[currency] = answer
        except queue.Empty:
            break
    late = TimeoutError(f"no answer in {timeout} s")
    return {currency: found.get(currency, late) for currency in currencies}


def asked_rates(
    fetch: Callable[[str], float | None], currencies: list[str], parallel: int, timeout: float, retries: int
) -> dict[str, float | None]:
    """The rates of distinct currencies, at most ``parallel`` calls at a time, each repeated up
    to ``retries`` times when it fails or takes longer than ``timeout`` seconds."""
    known: dict[str, float | None] = {}
    for start in range(0, len(currencies), parallel):
        left = currencies[start : start + parallel]
        for attempt in range(retries + 1):
            answers = asked_together(fetch, left, timeout)
            known |= {c: a for c, a in answers.items() if not isinstance(a, Exception)}
            failed = {c: a for c, a in answers.items() if isinstance(a, Exception)}
            if not failed:
                break
            if attempt == retries:
                currency, error = next(iter(failed.items()))
                raise RateUnavailable(f"no rate for {currency} after {retries + 1} calls: {error!r}") from error
            left = list(failed)
    return known


def fetched_rates(
    reservations: DataFrame,
    fetch: Callable[[str], float | None],
    folder: str | None = None,
    parallel: int = 8,
    timeout: float = 20.0,
    retries: int = 2,
) -> DataFrame:
    """Rates asked from ``fetch`` on the executors, once per currency in use.

    A task has at most ``parallel`` calls open. A call that fails or takes longer than
    ``timeout`` seconds is repeated up to ``retries`` times, then the job fails.

    ``fetch`` runs on the distinct currencies only, never per row, and USD is not
    asked for. The answers are written before they are used: a later action, a
    retried task or a lost executor can then not meet other rates.
    """

    @F.pandas_udf("double")
    def rate_to_usd(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float | None] = {"USD": 1.0}
        for currencies in batches:
            new = [c for c in dict.fromkeys(currencies) if c not in known]
            known |= asked_rates(fetch, new, parallel, timeout, retries)
            yield currencies.map(known).astype("float64")

    rates = currencies_in_use(reservations).withColumn("rate_to_usd", rate_to_usd("currency"))
    return stage(rates, folder or scratch_folder(reservations.sparkSession), "rates")
