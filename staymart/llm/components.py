"""Connected components by alternating large and small stars, as Spark joins.

Every step is a grouped minimum (combined before the shuffle) and a join back that
adaptive execution can split, so a hub with most of the links is no single task's
work. Links between steps are tables in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staymart.scratch import stage


def connected_components(links: DataFrame, folder: str) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; both are longs.

    The component is the smallest node that links reach. Loops and repeated links
    are fine, null ends are left out, no links give no rows.
    """
    now = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        folder,
        "links",
    )
    mark = state(now)
    while True:
        either = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = either.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stage(
            either.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(),
            folder,
            "large",
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi")
            .where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(least.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        now = stage(small, folder, "small")
        if (after := state(now)) == mark:
            break
        mark = after
    ends = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return ends.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def state(links: DataFrame) -> tuple:
    """A count and a sum of hashes: two numbers that a change of the links changes."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]
