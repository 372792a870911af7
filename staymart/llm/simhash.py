"""Near-duplicates by SimHash fingerprints and the generalised pigeonhole principle.

A fingerprint has 64 bits. The bits are grouped into partitions so that correlated
bits lie together. Two fingerprints within ``t`` bits agree, for thresholds that sum up
to ``t - m + 1`` over ``m`` partitions, within its threshold in one partition at least.
Each fingerprint gets thresholds of its own: a dynamic program spends the sum where
the estimated candidates are fewest, so a partition whose value is common is skipped
(threshold -1) and the others are probed more widely.

Probes are counted exactly before any candidate is made. A fingerprint that would still
meet more than ``most`` candidates lies in a dense region and takes an exact other way:
it is joined on all values at one bit's distance. Two fingerprints within two bits have
such a value in common, and all that share one are within two bits of each other, so a
star is enough. Both ways together find every link and no group is paired out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from staymart.llm.common import free_name, in_order, row_of, scan, utf8
from staymart.llm.components import connected_components
from staymart.scratch import scratch_folder, stage

BITS, SEED, SHINGLE = 64, 42, 3
#: Fingerprints link at so many differing bits. The way through dense regions rests on two.
APART = 2


def fingerprint(text: str | None) -> int:
    """Majority of the bits of the shingles' XXH64, as a signed long; 0 without words."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: 1 - SHINGLE].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[i:j], SEED) for i, j in zip(starts, ends[SHINGLE - 1 :].tolist())], np.uint64
        )
    n, ones = len(hashes), np.zeros(BITS, np.int64)
    for k in range(0, n, 65_536):
        octets = hashes[k : k + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; a null text counts as empty."""
    return scan(
        docs,
        ["doc_id", "text"],
        lambda part: {"doc_id": part["doc_id"], "fp": [fingerprint(x) for x in part["text"]]},
        "doc_id long, fp long",
    )


def correlation(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of the 64 bits; summed up in Spark, 2,080 numbers come back."""

    def sums(batches):
        import pyarrow as pa

        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            octets = np.asarray(batch.column(0).to_numpy(zero_copy_only=False)).astype("<i8").view(np.uint8)
            signs = np.unpackbits(octets.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
            total += np.rint(signs.T @ signs).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(total[i, j])}
        )

    rows = fps.select("fp").mapInArrow(sums, "i int, j int, s long").groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((BITS, BITS))
    for i, j, s in rows.collect():
        out[i, j] = out[j, i] = s
    n = max(1.0, out[0, 0])
    return np.abs(out) / n


def grouped_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal size; each grows by the bit most correlated with it."""
    free, groups = set(range(BITS)), []
    for size in [BITS // parts + (k < BITS % parts) for k in range(parts)]:
        group = [max(sorted(free), key=lambda b: sum(corr[b, c] for c in free))]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(free), key=lambda b: sum(corr[b, c] for c in group)))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def flips(group: list[int], radius: int) -> list[int]:
    """What to XOR a value with to reach all values within ``radius`` bits; none below 0."""
    return [
        signed(sum(1 << b for b in chosen)) for r in range(radius + 1) for chosen in combinations(group, r)
    ]


def allocate(counts: np.ndarray, widths: list[int], mean: list[float], t: int) -> np.ndarray:
    """Thresholds per row that sum to ``t - m + 1`` at the least estimated cost.

    ``counts[row, part]`` is how many fingerprints share the part's value. A wider radius
    is estimated to meet ``mean[part]`` more for each further value that it probes.
    """
    n, m = counts.shape
    low, goal = -1, t - m + 1
    cost = np.zeros((n, m, t + 2))
    for k in range(m):
        reach = 0
        for r in range(t + 1):
            reach += 1 if r == 0 else int(np.prod([widths[k] - x for x in range(r)]) / np.prod(range(1, r + 1)))
            cost[:, k, r - low] = counts[:, k] + (reach - 1) * mean[k] + reach
    span = range(low * m, t * m + 1)
    best = {0: np.zeros(n)}
    trace: list[dict[int, np.ndarray]] = []
    for k in range(m):
        now: dict[int, np.ndarray] = {}
        how: dict[int, np.ndarray] = {}
        for total, so_far in best.items():
            for r in range(low, t + 1):
                s, c = total + r, so_far + cost[:, k, r - low]
                if s not in span:
                    continue
                if s in now:
                    better = c < now[s]
                    now[s] = np.where(better, c, now[s])
                    how[s] = np.where(better, r, how[s])
                else:
                    now[s], how[s] = c, np.full(n, r)
        best = now
        trace.append(how)
    out, left = np.zeros((n, m), np.int64), np.full(n, goal)
    for k in reversed(range(m)):
        out[:, k] = np.choose(left - min(trace[k]), [trace[k][s] for s in sorted(trace[k])])
        left = left - out[:, k]
    return out


def probes_of(part: int, group: list[int], mask: int) -> Column:
    """The values of one partition that a row's threshold ``r[part]`` lets it look up."""
    radius, ways = F.get(F.col("r"), F.lit(part)), F.array().cast("array<long>")
    for r in range(APART + 1):
        ways = F.when(radius == r, F.array(*[F.lit(x).cast("long") for x in flips(group, r)])).otherwise(ways)
    own = F.col("fp").bitwiseAND(F.lit(mask))
    return F.transform(ways, lambda x: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(x).alias("value")))


def near_links(fps: DataFrame, folder: str, parts: int = 3, most: int = 256) -> DataFrame:
    """``(a, b)`` that connect all distinct fingerprints ``fp`` within two bits.

    Links of dense regions are stars over shared neighbours; every returned pair is itself
    within two bits.
    """
    groups = grouped_bits(correlation(fps), parts)
    masks = [signed(sum(1 << b for b in g)) for g in groups]
    keys = fps.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("part", "value"),
    )
    keys = stage(keys, folder, "keys")
    counts = stage(keys.groupBy("part", "value").agg(F.count("*").alias("n")), folder, "counts")
    sums = counts.groupBy("part").agg(F.sum("n").alias("n")).collect()
    spread = {r["part"]: r["n"] / 2.0 ** len(groups[r["part"]]) for r in sums}
    shared = keys.join(counts, ["part", "value"]).groupBy("fp").pivot("part", list(range(parts))).agg(F.max("n"))
    names, widths = [str(k) for k in range(parts)], [len(g) for g in groups]
    means = [spread.get(k, 0.0) for k in range(parts)]

    def thresholds(batches):
        import pyarrow as pa

        for batch in batches:
            of = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            yield pa.RecordBatch.from_pydict(
                {"fp": batch.column("fp"), "r": pa.array(allocate(of, widths, means, APART).tolist(), pa.list_(pa.int64()))}
            )

    chosen = shared.mapInArrow(thresholds, "fp long, r array<long>")
    probe = [probes_of(k, group, masks[k]) for k, group in enumerate(groups)]
    probes = chosen.select("fp", F.inline(F.flatten(F.array(*probe))))
    probes = stage(probes.join(counts, ["part", "value"]), folder, "probes")
    total = probes.groupBy("fp").agg(F.sum("n").alias("total"))
    dense = stage(total.where(F.col("total") > most).select("fp"), folder, "dense")
    thin = probes.join(dense, "fp", "left_anti").select("part", "value", F.col("fp").alias("a"))
    pairs = (
        thin.join(keys.withColumnRenamed("fp", "b"), ["part", "value"])
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= APART))
        .select("a", "b")
    )
    around = F.array(*[F.lit(x) for x in flips(list(range(BITS)), 1)])
    near = dense.select("fp", F.explode(F.transform(around, lambda x: F.col("fp").bitwiseXOR(x))).alias("v"))
    star = near.groupBy("v").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))  # 65 at most share v
    links = star.where(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    return pairs.union(links.where("a <> b"))


def simhash_groups(docs: DataFrame, parts: int = 3, most: int = 256, folder: str | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    Null text is an empty one; documents without words share fingerprint zero and are one
    group. Equal fingerprints are one node, so copies are never paired. ``component_id`` is
    the smallest ``doc_id`` that links reach; null only if all of a group are null. Repeated
    rows come back as often as they are given, other columns do not matter, an empty table
    gives none.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    fps = stage(fingerprints(docs), folder, "fingerprints")
    nodes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), folder, "nodes")
    groups = connected_components(near_links(nodes, folder, parts, most), folder)
    placed = nodes.join(groups, nodes.fp == groups.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    placed = stage(placed, folder, "placed")
    names = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = placed.join(names, "component").select("fp", "component_id")
    return fps.join(placed, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_groups(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``docs`` less all but one of each group, with all their columns.

    The row of smallest id stays; of repeated rows with that id, one; of a group without ids,
    one. A null text counts as an empty one. ``docs`` is written once with a row number, so that
    a row has one identity. Columns of any name are kept; an empty table gives no rows.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    row = free_name(docs, "__row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    held = stage(numbered, folder, "docs")
    fps = stage(
        scan(
            held,
            [row, "doc_id", "text"],
            lambda part: {
                "row": part[row],
                "doc_id": part["doc_id"],
                "fp": [fingerprint(x) for x in part["text"]],
            },
            "row long, doc_id long, fp long",
        ),
        folder,
        "fingerprints",
    )
    nodes = stage(fps.groupBy("fp").agg(F.min(in_order("doc_id", "row")).alias("first")), folder, "nodes")
    groups = connected_components(near_links(nodes, folder), folder)
    placed = nodes.join(groups, nodes.fp == groups.node, "left")
    keep = placed.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
    rows = keep.select(row_of(F.col("first")).alias(row))
    return held.join(rows, row, "left_semi").select(*docs.columns)
