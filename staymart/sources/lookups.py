"""Code lookups as (key, value) tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from staymart.local import local_frame
from staymart.schemas import DOUBLE, TEXT, struct


def read_lookup(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """A JSON object ``{"code": "value", ...}`` as rows of (key, value).

    A file holds one object, in which the last of several equal keys counts.
    With ``per_line`` each line holds an object of its own, so that a large lookup
    is split over tasks. Malformed JSON fails the query.
    """
    text = spark.read.text(path, wholetext=not per_line)
    parsed = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    if per_line:
        return text.select(F.explode(parsed).alias("key", "value"))
    return (
        text.select(F.posexplode(parsed).alias("at", "key", "value"))
        .groupBy("key")
        .agg(F.max_by("value", "at").alias("value"))
    )


def lookup_from_dict(
    spark: SparkSession, entries: Mapping[str, str | float], key: str = "key", value: str = "value"
) -> DataFrame:
    """A lookup small enough to be written down in a program, of texts or numbers."""
    numbers = any(isinstance(v, (int, float)) for v in entries.values())
    schema = struct(**{key: TEXT, value: DOUBLE if numbers else TEXT})
    return local_frame(spark, entries.items(), schema)
