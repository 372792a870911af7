"""Merge upsert by key: matched target rows take the source's values, unmatched
source rows are inserted, nothing is deleted.

Rules kept:
- A NULL key equals nothing, so a source row without a key is always inserted.
- Source rows are not de-duplicated. Two of them inserting the same new key are
  both inserted; two of them matching one target row are an error.
- A target key held by several rows keeps as many rows, each updated.

The steps are written tables between joins whose probe side may be skewed. A join
of two plain scans is one that adaptive execution can split where a key holds
many rows, and that Catalyst broadcasts if the files of one side are small.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from staymart.operators.key_filter import key_filter, passing
from staymart.schemas import KEY
from staymart.scratch import scratch_folder, stage


class AmbiguousMerge(ValueError):
    """Several source rows match the same target row."""


@dataclass(frozen=True)
class Matches:
    """What the source of a merge hits in its target."""

    pairs: DataFrame  # (key, columns beside it) per matched target row, written
    updates: DataFrame  # source rows, written; at most one per key of the target
    inserts: DataFrame  # source rows that match nothing
    built: tuple[DataFrame, int] | None  # a filter of the source's keys, if one was wanted


def keyless(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNull())


def keyed(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def key_copies(source: DataFrame, key: str) -> DataFrame:
    """(key, copies) of the non-NULL keys, combined before the shuffle."""
    return keyed(source, key).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))


def find_matches(
    target_keys: DataFrame,
    source: DataFrame,
    key: str,
    folder: str,
    bloom: bool = False,
    unique: bool = False,
) -> Matches:
    """Splits ``source`` by whether ``target_keys`` has the key.

    ``target_keys`` is read for the key and whatever columns it has beside it. It
    is cut to the source's key range first: a filter that Parquet row groups skip by. With
    ``bloom`` a filter of the source's keys cuts it further where keys are scattered: what does
    not pass is not shuffled. ``unique`` refuses NULL and repeated keys, as a store with a
    primary key does, by the same look at the written source.

    Unique source keys, the usual case, need two written tables. Repeated ones need
    three more, so that no join has many rows of one key on its unsplit side.
    """
    source = stage(source, folder, "source")
    copies = key_copies(source, key)
    low, high, most, n = copies.agg(F.min(key), F.max(key), F.max("copies"), F.count("*")).first()
    repeated = (most or 0) > 1
    if unique and not keyless(source, key).isEmpty():
        raise ValueError(f"rows to upsert have a NULL {key}")
    if unique and repeated:
        raise ValueError(f"rows to upsert have a {key} twice")
    if repeated:
        copies = stage(copies, folder, "copies")
        keys = copies.select(key, (F.col("copies") > 1).alias("ambiguous"))
    else:
        keys = keyed(source, key).select(key, F.lit(False).alias("ambiguous"))

    in_range = target_keys.filter(F.col(key).between(F.lit(low), F.lit(high)))
    built = key_filter(keyed(source, key).select(key), key, folder, n) if bloom else None
    if built:
        in_range = passing(in_range, key, built)
    pairs = stage(in_range.join(keys, key), folder, "pairs")
    matched = pairs.select(key).distinct()
    updates = source
    if repeated:
        examples = [row[key] for row in pairs.filter("ambiguous").select(key).take(3)]
        if examples:
            raise AmbiguousMerge(f"several source rows match one target row: {key} {examples}")
        matched = stage(matched, folder, "matched")
        updates = stage(keyed(source, key).join(matched, key, "left_semi"), folder, "updates")
    inserts = keyless(source, key).unionByName(
        keyed(source, key).join(matched, key, "left_anti")
    )
    return Matches(pairs.drop("ambiguous"), updates, inserts, built)


def updated(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``target``, read once, with the rows whose key is in ``updates`` replaced from there.

    Rows without a key match nothing. They are dealt out by the partition they were read in,
    so they do not come together. No key of ``target`` is in ``updates`` twice, so every target
    row comes out once.
    """
    new = keyed(updates, key).select(
        F.col(key).alias("__key"), F.lit(0).alias("__of"), F.struct(*(F.col(c) for c in target.columns)).alias("__new")
    )
    dealt = F.when(F.col(key).isNull(), F.spark_partition_id() + 1).otherwise(0)
    old = target.withColumn("__part", dealt)
    kept_or_new = old.join(new, (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__of")), "left")
    hit = F.col("__new").isNotNull()
    columns = [
        F.when(hit, F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in target.columns
    ]
    return kept_or_new.select(*columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = KEY,
    folder: str | None = None,
    bloom: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The rows of ``target`` after merging ``source`` into it.

    ``target`` is only read, and twice: for its keys, and in the returned frame. Where that is
    dear, as for a frame that is itself a join, hand in a written one. ``bloom`` is for a small
    share of scattered keys in a large target: rows whose key does not pass a filter of the
    source's keys go around both joins, for one more scan.
    """
    folder = folder or scratch_folder(target.sparkSession)
    source = conform(source, target)
    found = find_matches(keyed(target, key).select(key), source, key, folder, bloom, unique)
    if found.built is None:
        return updated(target, found.updates, key).unionByName(found.inserts)
    hit, around = (passing(target, key, found.built, side) for side in (True, False))
    return around.unionByName(updated(hit, found.updates, key)).unionByName(found.inserts)


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the target's columns, order and types, matched by name."""
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source of the merge lacks {', '.join(missing)}")
    return source.select(*(F.col(f.name).cast(f.dataType) for f in target.schema))


def merge_actions(target: DataFrame, source: DataFrame, key: str = KEY) -> DataFrame:
    """One row: how many rows a merge inserts, updates and keeps.

    The target is cut to the source's keys before it is counted per key; what is kept
    is the rest of its row count. A key held by many rows is a single row in the join.
    """
    n = F.count(F.lit(1))
    after = keyed(source, key).groupBy(key).agg(n.alias("s_rows"))
    hit = keyed(target, key).select(key).join(after.select(key), key, "left_semi")
    both = hit.groupBy(key).agg(n.alias("t_rows")).join(after, key)
    none = F.lit(0).cast("long")
    parts = [
        source.agg(n.alias("inserted"), none.alias("updated"), none.alias("kept")),
        target.agg(none.alias("inserted"), none.alias("updated"), n.alias("kept")),
        both.agg(
            (-F.sum("s_rows")).alias("inserted"),
            F.sum("t_rows").alias("updated"),
            (-F.sum("t_rows")).alias("kept"),
        ),
    ]
    total = reduce(DataFrame.unionByName, parts)
    return total.agg(*(F.coalesce(F.sum(c), none).alias(c) for c in total.columns))


def require_key(source: DataFrame, key: str) -> None:
    """Fails before any work if the key column is not there."""
    if key not in source.columns:
        raise ValueError(f"rows to upsert must have the column {key}")


def require_unique_key(source: DataFrame, key: str) -> None:
    """A store with a primary key takes no NULL keys and no key twice."""
    worst = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max(F.col(key).isNull()).alias("null_key"), F.max("n").alias("copies")
    ).first()
    if worst["null_key"]:
        raise ValueError(f"rows to upsert have a NULL {key}")
    if (worst["copies"] or 0) > 1:
        raise ValueError(f"rows to upsert have a {key} twice")


def keyed_upsert(
    target: DataFrame, source: DataFrame, key: str = KEY, folder: str | None = None
) -> DataFrame:
    """``merge_upsert`` under the rules of a store with a primary key."""
    require_key(source, key)
    return merge_upsert(target, source, key, folder, unique=True)
