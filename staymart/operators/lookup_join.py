"""Left joins onto lookup tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from staymart.sources.lookups import lookup_from_dict

# A lookup is broadcast up to this many bytes of content.
BROADCAST_BYTES = 64 * 1024 * 1024
# Memory a hash table needs per entry besides the content, rounded up.
ENTRY_OVERHEAD = 64


def checked_size(lookup: DataFrame, key: str) -> int:
    """Bytes of a lookup's content; fails if a key occurs twice.

    One aggregation over the lookup, combined before its shuffle.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in lookup.columns),
        F.lit(0),
    )
    per_key = lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes"))
    size = per_key.agg(
        F.sum("n").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("copies"),
    ).first()
    if (size["copies"] or 0) > 1:
        raise ValueError(f"lookup has more than one row for a {key}")
    return (size["bytes"] or 0) + (size["rows"] or 0) * ENTRY_OVERHEAD


def attach(
    df: DataFrame,
    lookup: DataFrame | Mapping[str, str | float],
    code: str,
    into: str,
    key: str = "key",
    value: str = "value",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the value found for column ``code`` as column ``into``.

    Keeps every row exactly once: keys are checked to be unique, and a code that
    is NULL or not listed gives NULL. Codes compare case-sensitively. The lookup
    is broadcast while its measured size allows it. A larger one is joined by
    sorting on both sides; adaptive execution then splits the partition of a code
    that most rows share, as the side that is split is the preserved one.
    """
    if isinstance(lookup, Mapping):
        side = lookup_from_dict(df.sparkSession, lookup, "__code", into)
        width = sum(len(str(k).encode()) + len(str(v).encode()) for k, v in lookup.items())
        small = width + len(lookup) * ENTRY_OVERHEAD <= broadcast_bytes
    else:
        side = lookup.select(key, value)
        small = checked_size(side, key) <= broadcast_bytes
        side = side.toDF("__code", into)
    if small:
        side = F.broadcast(side)
    return df.join(side, F.col(code) == F.col("__code"), "left").drop("__code")
