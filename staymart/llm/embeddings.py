"""Near-duplicate vectors by spherical-cap filters of a structured random product code.

Vectors are rotated at random and cut into blocks. Each block has a code of random unit
vectors; a filter is one code vector per block, so there are ``code ** blocks`` filters
that are never written down. A vector passes a filter if its inner product with it exceeds
a threshold. All filters that a vector passes are listed by extending partial choices block
by block, dropping those that even the best of the remaining blocks could not lift over it.
Vectors of one label that pass a filter in common meet there and are compared exactly.

A vector that passes fewer than ``least`` filters takes its ``least`` best instead, so none
is left without neighbours. Copies are one node. The code grows with the vectors of the
largest label (``code_for``), so that as many vectors without a link meet in a filter in a
small table as in a large one.

Near copies are settled as balls: all vectors within half the angle of one vector, its
leader, are linked with each other, which is known without comparing them. Only vectors of
different balls are compared, in filters where two balls meet. Of a filter with more than
``block_rows`` vectors the largest ball and the rest are each cut into blocks; blocks of the
rest meet each other and those of the ball, blocks of the ball never meet. A dense region is
neither collected into one task nor written out as pairs: a group returns a row per vector.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staymart.llm.components import connected_components
from staymart.scratch import scratch_folder, stage

SEED = 20_011
COSINE = 0.93
#: A group of vectors to be compared: one filter of one label, one pair of its blocks.
KEYS = ["width", "label", "filter", "one", "two"]
FILTER = ["width", "label", "filter"]
#: Filters for each vector of the largest label, and the smallest code.
FILTERS_EACH, LEAST_CODE = 256, 40


def code_for(vectors: int, blocks: int) -> tuple[int, float, int]:
    """Code vectors a block, threshold, and least filters of a vector, by the number of vectors
    that may meet. A larger code has smaller caps, so the threshold rises with its logarithm,
    and a pair at the bound shares a smaller part of them, so more are taken."""
    code = max(LEAST_CODE, math.ceil((FILTERS_EACH * vectors) ** (1 / blocks)))
    finer = code / LEAST_CODE
    return code, 0.54 + 0.22 * math.log10(finer), round(48 * math.sqrt(finer))


@lru_cache(maxsize=8)
def product_code(width: int, blocks: int, code: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation of the space and the code of each block, from a fixed seed."""
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    codes = []
    for part in np.array_split(np.arange(width), blocks):
        rows = rng.standard_normal((code, max(1, len(part))))
        codes.append(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    return rotation, codes


def passed(unit: np.ndarray, blocks: int, code: int, threshold: float, least: int) -> list[np.ndarray]:
    """For each unit vector the sorted numbers of its filters."""
    width = unit.shape[1]
    rotation, codes = product_code(width, blocks, code)
    turned = unit @ rotation
    parts = np.array_split(np.arange(width), blocks)
    scores = [turned[:, p] @ c.T / np.sqrt(blocks) for p, c in zip(parts, codes)]
    best = np.stack([s.max(axis=1) for s in scores])
    rest = np.vstack([np.cumsum(best[::-1], axis=0)[::-1][1:], np.zeros((1, len(unit)))])
    out = []
    for v in range(len(unit)):
        wanted = min(threshold, best[:, v].sum() - 0.06)
        while True:
            number, sums = np.zeros(1, np.int64), np.zeros(1)
            for k in range(blocks):
                grown = sums[:, None] + scores[k][v][None, :]
                i, j = np.nonzero(grown + rest[k, v] > wanted)
                number, sums = number[i] * code + j, grown[i, j]
            if len(number) >= least or wanted < -1:
                break
            wanted -= 0.02
        keep = max(least, np.count_nonzero(sums > threshold))
        if wanted < threshold and len(number) > keep:
            number = number[np.argsort(-sums, kind="stable")[:keep]]
        out.append(np.sort(number))
    return out


def usable(vector: str = "embedding"):
    """A vector with values, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def filters_of(nodes: DataFrame, blocks: int, code: int, threshold: float, least: int) -> DataFrame:
    """``node, label, width, filters`` with the sorted list of filters."""

    def over(batches):
        for batch in batches:
            nodes, vectors = batch.column("node"), batch.column("vector").to_pylist()
            widths = np.array([len(x) for x in vectors], np.int64)
            lists: list = [None] * len(vectors)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                unit = unit_rows(np.array([vectors[i] for i in own], np.float64))
                for i, found in zip(own, passed(unit, min(blocks, int(width)), code, threshold, least)):
                    lists[i] = found
            yield pa.RecordBatch.from_arrays(
                [nodes, batch.column("label"), pa.array(widths), pa.array(lists, pa.list_(pa.int64()))],
                ["node", "label", "width", "filters"],
            )

    return nodes.select("node", "label", "vector").mapInArrow(
        over, "node long, label int, width long, filters array<long>"
    )


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def end_of_run(changes: np.ndarray) -> np.ndarray:
    """For each row the end of its run; ``changes`` says where the next row differs."""
    ends = np.append(np.flatnonzero(changes) + 1, len(changes) + 1)
    return np.repeat(ends, np.diff(np.append(0, ends)))


def pairs_within(group: np.ndarray, ball: np.ndarray, split: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i < j`` of all pairs of rows of a group that are of different balls; rows are
    sorted by group and ball. In a group of two blocks only pairs across them."""
    changes = group[1:] != group[:-1]
    after = end_of_run(changes | (ball[1:] != ball[:-1]))
    later = end_of_run(changes) - after
    i = np.repeat(np.arange(len(group)), later)
    j = after[i] + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    used = ~split[i] | (side[i] != side[j])
    return i[used], j[used]


def compared(rows: pd.DataFrame, cosine: float) -> pa.RecordBatch:
    """Links between balls inside the groups of ``rows``, which are sorted by group and ball: per
    node and group how many, each pair counted under the first filter where it meets, and the
    smallest node of the node's part of the group's links."""
    vectors = rows["vector"].to_numpy()
    x = unit_rows(np.array([*vectors], np.float64))
    number, node, copies = rows["filter"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy()
    split = (rows["one"] != rows["two"]).to_numpy()
    i, j = pairs_within(rows["group"].to_numpy(), rows["ball"].to_numpy(), split, rows["block"].to_numpy())
    near = np.concatenate(
        [np.einsum("ij,ij->i", x[i[k : k + 100_000]], x[j[k : k + 100_000]]) >= cosine for k in range(0, len(i), 100_000)]
        or [np.zeros(0, bool)]
    )
    i, j = i[near], j[near]
    before = {k: frozenset(f[f < number[k]].tolist()) for k in np.unique([i, j]) for f in (rows["filters"].iat[k],)}
    first = np.fromiter((before[a].isdisjoint(before[b]) for a, b in zip(i, j)), bool, len(i))
    links = np.bincount(i[first], copies[j[first]], len(rows)) + np.bincount(j[first], copies[i[first]], len(rows))
    root = node.copy()
    while True:  # labels move along links until they rest
        last = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if (root == last).all():
            break
    kept = np.unique(np.concatenate([i, j])).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(node[kept]), pa.array(root[kept]), pa.array(links[kept].astype(np.int64))], ["node", "root", "links"]
    )


def whole_groups(batches, most: int):
    """Sorted rows as frames of about ``most`` rows that break between groups only. ``width``
    is part of a group, and a frame holds one width."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        part = batch.to_pandas()
        start = 0
        keys = part[KEYS].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if held and len(part) and (held[-1][KEYS].to_numpy()[-1] != keys[0]).any():
            cuts = np.append(0, cuts)
        for cut in cuts.tolist():
            rows = sum(map(len, held)) + cut - start
            last = held[-1].iloc[-1] if cut == 0 else part.iloc[cut - 1]
            if rows >= most or last["width"] != part.iloc[cut]["width"]:
                held.append(part.iloc[start:cut])
                yield pd.concat(held, ignore_index=True)
                held, start = [], cut
        if start < len(part):
            held.append(part.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def numbered(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows[KEYS].to_numpy()
    return rows.assign(group=np.append(0, np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))


def balls_of(nodes: DataFrame, entries: DataFrame, cosine: float, crowd: int = 4) -> DataFrame:
    """``node, ball`` of nodes that lie within half the angle of ``cosine`` of the node ``ball``.

    Tried are the smallest nodes of a node's filters with ``crowd`` nodes or more: of these the
    smallest, and the one that leads most of its filters. A node without a leader has no row.
    """
    leaders = entries.groupBy(FILTER).agg(F.min("node").alias("leader"), F.count("*").alias("n"))
    votes = entries.join(leaders.where(F.col("n") >= crowd), FILTER).where("node <> leader")
    votes = votes.groupBy("node", "leader").agg(F.count("*").alias("votes"))
    tried = votes.groupBy("node").agg(
        F.array_distinct(F.array(F.min("leader"), F.max_by("leader", F.struct("votes", -F.col("leader"))))).alias("tried")
    )
    tried = tried.select("node", F.explode("tried").alias("leader"))
    both = tried.join(nodes.select("node", "vector"), "node").join(
        nodes.select(F.col("node").alias("leader"), F.col("vector").alias("other")), "leader"
    )
    within = math.sqrt((1 + cosine) / 2) + 1e-9  # the margin keeps sums of angles below the bound

    def over(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (unit_table(batch.column(name)) for name in ("vector", "other"))
                near = np.array([x @ y >= within for x, y in zip(a, b)], bool)
                yield batch.select(["node", "leader"]).filter(pa.array(near))

    near = both.select("node", "leader", "vector", "other").mapInArrow(over, "node long, leader long")
    return near.groupBy("node").agg(F.min("leader").alias("ball"))


def unit_table(lists: pa.Array) -> list[np.ndarray]:
    return [unit_rows(np.array([x], np.float64))[0] for x in lists.to_pylist()]


def vector_groups(
    vectors: DataFrame,
    cosine: float = COSINE,
    blocks: int = 4,
    block_rows: int = 256,
    folder: str | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding, label)``.

    Rows of one label whose cosine is ``cosine`` or more are linked if they meet in a filter,
    nearly all do; none below is ever linked. Null labels, null, empty and zero vectors and
    those with a null or non-finite component link with nothing, nor do vectors of different
    length. Equal vectors of one label are one node, and each other's links. ``component_id``
    is the smallest ``vec_id`` reached. A null id forms no name of a group with others.
    Other columns do not matter; an empty table gives no rows.
    """
    folder = folder or scratch_folder(vectors.sparkSession)
    rows = vectors.select(
        "vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").alias("vector")
    )
    rows = rows.withColumn("used", F.coalesce(usable("vector"), F.lit(False)))
    kind = vectors.schema["embedding"].dataType.elementType
    clean = F.transform("vector", lambda x: F.when(x == 0, F.lit(0).cast(kind)).otherwise(x))  # no -0.0
    alike = rows.where("used").groupBy("label", clean.alias("vector"))
    nodes = alike.agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), folder, "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    lists = stage(filters_of(nodes, blocks, *code_for(largest, blocks)), folder, "filters")
    entries = lists.select("node", "label", "width", F.explode("filters").alias("filter"))
    balls = stage(balls_of(nodes, entries, cosine), folder, "balls")
    entries = lists.join(balls, "node", "left").select(
        "node", "label", "width", F.coalesce("ball", "node").alias("ball"), F.explode("filters").alias("filter")
    )
    sizes = entries.groupBy(*FILTER, "ball").agg(F.count("*").alias("n")).groupBy(FILTER)
    sizes = sizes.agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("ball", F.struct("n", "ball")).alias("main"), F.count("*").alias("balls")
    ).where("balls > 1")
    crowded = F.col("n") > block_rows
    rests = F.ceil(F.when(crowded, F.col("n") - F.col("most")).otherwise(F.col("n")) / block_rows)
    met = entries.join(sizes, FILTER).select(
        "node", *FILTER, "ball", (crowded & (F.col("ball") == F.col("main"))).alias("inner"),
        rests.alias("rests"), F.when(crowded, F.ceil(F.col("most") / block_rows)).otherwise(0).alias("mains"),
    )
    met = met.withColumn(
        "block",
        F.when(F.col("inner"), F.col("rests") + F.pmod(F.xxhash64("node"), F.greatest("mains", F.lit(1).cast("long"))))
        .otherwise(F.pmod(F.xxhash64("node"), "rests")),
    )
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("rests") - 1 + F.when(F.col("inner"), 0).otherwise(F.col("mains"))),
        lambda b: F.struct(F.least("block", b).alias("one"), F.greatest("block", b).alias("two")),
    )
    met = met.select("node", *FILTER, "ball", "block", F.inline(others))
    full = met.join(lists.select("node", "filters"), "node").join(nodes.select("node", "vector", "copies"), "node")

    def over(batches):
        for rows in whole_groups(batches, 2_000):
            yield compared(numbered(rows), cosine)

    together = full.repartition(*KEYS).sortWithinPartitions(*KEYS, "ball")
    found = together.mapInArrow(over, "node long, root long, links long")
    found = stage(found, folder, "found")
    ends = found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(balls)
    groups = connected_components(ends, folder)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.join(balls, "node", "left").withColumn("ball", F.coalesce("ball", "node"))
    inside = placed.groupBy("ball").agg(F.sum("copies").alias("inside"))
    placed = placed.join(inside, "ball").join(counts, "node", "left").join(groups, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = placed.join(names, "component").select(
        "label", "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("inside") - 1).alias("n_links")
    )
    linked = rows.where("used").withColumn("vector", clean).join(placed, ["label", "vector"])
    alone = rows.where(~F.col("used")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
