"""Whitening of embeddings by a weighted covariance of distinct vectors.

Vectors are put on a grid of 1/256. Equal grid vectors are one row of the fit, whose weight is
its multiplicity or one. Sums per dimension are exact integers; with them every task centres
its rows and multiplies them by themselves, and Spark adds up the entries of these products.
The driver holds a covariance, width by width, and takes its eigenvectors. Each distinct vector
is whitened once and joined back to the rows that have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staymart.scratch import scratch_folder, stage

GRID = 256
COMPONENTS = 4


@dataclass(frozen=True)
class Fit:
    """What the vectors of one width have in common."""

    n: int  # sum of weights
    sums: list[int]  # weighted, per dimension
    axes: np.ndarray  # unit eigenvectors in columns, by falling eigenvalue
    values: np.ndarray  # their eigenvalues, all above zero
    trace: float


def on_grid(vector: str) -> Column:
    """``floor(256 c)`` per entry; null if an entry is null or not finite, or there is no vector."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * GRID).cast("long")))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x, h, width, copies`` per distinct ``x`` of ``rows(x)``."""
    grouped = rows.groupBy("x").agg(F.count("*").alias("copies"))
    return grouped.select("x", F.xxhash64("x").alias("h"), F.size("x").alias("width"), "copies")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The rows of a batch, those of one width at a time, as (width, x, rows)."""
    widths = batch.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        part = batch.filter(pa.array(widths == width))
        yield width, matrix(part.column("x"), width), part


def weight_of(part: pa.RecordBatch, weighted: bool) -> np.ndarray:
    return part.column("copies").to_numpy() if weighted else np.ones(part.num_rows, np.int64)


def sums_of(nodes: DataFrame, weighted: bool) -> dict[int, tuple[int, list[int]]]:
    """Per width the sum of weights and the exact weighted sums per dimension.

    Partial sums are split in two words before they are added, so they cannot overflow.
    """

    def over(batches):
        for batch in batches:
            for width, x, part in by_width(batch):
                w = weight_of(part, weighted)
                high, low = x >> 32, x & 0xFFFFFFFF
                yield pa.RecordBatch.from_pydict(
                    {
                        "width": pa.array([width] * width, pa.int32()),
                        "at": pa.array(range(width), pa.int32()),
                        "n": pa.array([int(w.sum())] * width, pa.int64()),
                        "high": pa.array(w @ high, pa.int64()),
                        "low": pa.array(w @ low, pa.int64()),
                    }
                )

    parts = nodes.where("width > 0").select("width", "x", "copies")
    parts = parts.mapInArrow(over, "width int, at int, n long, high long, low long")
    big = "decimal(38,0)"
    total = parts.groupBy("width", "at").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast(big)).alias(c) for c in ("high", "low")))
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for row in total.collect():  # width numbers per width
        sums = found.setdefault(row["width"], (row["n"], {}))[1]
        sums[row["at"]] = (int(row["high"]) << 32) + int(row["low"])
    return {width: (n, [sums[i] for i in range(width)]) for width, (n, sums) in found.items()}


def mean_of(n: int, sums: list[int]) -> np.ndarray:
    return np.array([s / n for s in sums])


def covariances(nodes: DataFrame, sums: dict[int, tuple[int, list[int]]], weighted: bool) -> dict[int, np.ndarray]:
    """Per width the covariance, divisor n. A task adds up its batches and returns the upper
    half of a matrix per width; the entries are summed by Spark."""
    means = {width: mean_of(n, s) for width, (n, s) in sums.items()}

    def over(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, x, part in by_width(batch):
                centred = x - means[width]
                product = (centred * weight_of(part, weighted)[:, None]).T @ centred
                held[width] = held[width] + product if width in held else product
        for width, product in held.items():
            for i in range(width):
                rest = width - i
                yield pa.RecordBatch.from_pydict(
                    {
                        "width": pa.array([width] * rest, pa.int32()),
                        "i": pa.array([i] * rest, pa.int32()),
                        "j": pa.array(range(i, width), pa.int32()),
                        "value": pa.array(product[i, i:]),
                    }
                )

    parts = nodes.where("width > 0").select("width", "x", "copies")
    parts = parts.mapInArrow(over, "width int, i int, j int, value double")
    found = {width: np.zeros((width, width)) for width in sums}
    for row in parts.groupBy("width", "i", "j").agg(F.sum("value").alias("value")).collect():
        v = row["value"] / sums[row["width"]][0]
        found[row["width"]][row["i"], row["j"]] = found[row["width"]][row["j"], row["i"]] = v
    return found


def fit_whitening(nodes: DataFrame, components: int = COMPONENTS, weighted: bool = False) -> dict[int, Fit]:
    """A fit per width of the distinct vectors ``nodes(x, width, copies)``.

    ``weighted`` counts each vector as often as it occurs, else once. The driver gets a sum
    and half a covariance per width. An eigenvector whose eigenvalue is not above rounding
    (width times 2^-52 of the trace) is left out: along it nothing varies.
    """
    sums = sums_of(nodes, weighted)
    fits = {}
    for width, v in covariances(nodes, sums, weighted).items():
        values, axes = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > np.trace(v) * width * 2.0**-52]
        chosen = axes[:, order]
        largest = np.abs(chosen).argmax(axis=0) if len(order) else np.zeros(0, int)
        chosen = chosen * np.where(chosen[largest, np.arange(len(order))] < 0, -1.0, 1.0)
        fits[width] = Fit(*sums[width], chosen, values[order], float(np.trace(v)))
    return fits


def deviations(x: np.ndarray, fit: Fit) -> list[int]:
    """``sum((n x - S)^2)`` per row, exactly; a value beyond a long is an error."""
    sums, limit = np.array(fit.sums, object), 2**63
    spread = np.abs(x * float(fit.n) - np.array(fit.sums, float))
    if len(x) == 0 or float((spread**2).sum(axis=1).max()) < 2.0**62 and max(map(abs, fit.sums), default=0) < limit:
        whole = x * np.int64(fit.n) - np.array(fit.sums, np.int64)  # differences wrap around to the right value
        return (whole * whole).sum(axis=1).tolist()
    exact = [sum(int(d) ** 2 for d in fit.n * row.astype(object) - sums) for row in x]
    if max(exact) >= limit:
        raise OverflowError("the deviation of a vector is beyond a long")
    return exact


def whitened_nodes(nodes: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``x, h, width, n, deviation, whitened`` per distinct vector that has a component."""

    def over(batches):
        for batch in batches:
            for width, x, part in by_width(batch):
                fit = fits[width]
                if not len(fit.values):
                    continue
                z = (x - mean_of(fit.n, fit.sums)) @ fit.axes / np.sqrt(fit.values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("x"),
                        part.column("h"),
                        part.column("width"),
                        pa.array([fit.n] * len(x), pa.int64()),
                        pa.array(deviations(x, fit), pa.int64()),
                        pa.array(list(z), pa.list_(pa.float64())),
                    ],
                    names=["x", "h", "width", "n", "deviation", "whitened"],
                )

    schema = "x array<long>, h long, width int, n long, deviation long, whitened array<double>"
    return nodes.where("width > 0").select("x", "h", "width", "copies").mapInArrow(over, schema)


def identity_errors(white: DataFrame, nodes: DataFrame, fits: dict[int, Fit], weighted: bool) -> dict[int, float]:
    """Per width the largest entry of the covariance of ``whitened`` minus the identity, as
    measured on the whitened vectors."""
    if not fits:
        return {}
    most = max(len(f.values) for f in fits.values())
    rows = white.join(nodes.select("x", "h", "copies"), ["h", "x"]) if weighted else white.withColumn("copies", F.lit(1))
    z = [F.get("whitened", F.lit(i)) for i in range(most)]
    w = F.col("copies").cast("double")
    means = {r["width"]: r for r in rows.groupBy("width").agg(F.sum(w).alias("w"), *(F.sum(w * c).alias(f"m{i}") for i, c in enumerate(z))).collect()}
    errors = {}
    for width, row in means.items():  # one pass per width
        k = len(fits[width].values)
        mean = [row[f"m{i}"] / row["w"] for i in range(k)]
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        products = [F.sum(w * (z[i] - mean[i]) * (z[j] - mean[j])) for i, j in pairs]
        found = rows.where(F.col("width") == width).agg(*products).first()
        errors[width] = max(abs(v / row["w"] - (i == j)) for v, (i, j) in zip(found, pairs))
    return errors


def per_width(values: dict[int, object], kind: str) -> Callable[[Column], Column]:
    entries = [F.lit(v) for pair in values.items() for v in pair]
    return lambda width: F.element_at(F.create_map(*entries), width).cast(kind)


def whitened_vectors(
    vectors: DataFrame, components: int = COMPONENTS, weighted: bool = False, folder: str | None = None
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row of
    ``vectors(vec_id, embedding)`` and component.

    Rows whose vector is null, empty, or holds a null or non-finite entry are left out. Vectors
    of different width are fitted apart. Repeated rows and null ids come out as they come in;
    ties of eigenvalues are in the order of the solver. Without spread, as with one distinct
    vector, there is no component and no row. Entries beyond a long on the grid saturate.
    Other columns do not matter; an empty table gives no rows.
    """
    folder = folder or scratch_folder(vectors.sparkSession)
    rows = vectors.select("vec_id", on_grid("embedding").alias("x")).where(F.size("x") > 0)
    nodes = stage(distinct_vectors(rows), folder, "nodes")
    fits = fit_whitening(nodes, components, weighted)
    white = stage(whitened_nodes(nodes, fits), folder, "white")
    errors = identity_errors(white, nodes, {w: f for w, f in fits.items() if len(f.values)}, weighted)
    joined = rows.withColumn("h", F.xxhash64("x")).join(white, ["h", "x"])
    out = joined.select("vec_id", "width", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = {w: [float(v) / f.trace for v in f.values] for w, f in fits.items() if len(f.values)}
    flat = {f"{w}:{i}": v for w, values in share.items() for i, v in enumerate(values)} or {"": 0.0}
    place = F.concat_ws(":", F.col("width").cast("string"), F.col("at").cast("string"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        per_width(flat, "double")(place).alias("explained"),
        per_width(errors or {0: 0.0}, "double")(F.col("width")).alias("identity_error"),
    )
