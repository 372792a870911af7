"""What several operators share: table readers and the scan of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from staymart.scratch import stage

#: Rows and characters that a scan of texts holds at a time; a longer text comes alone.
SLICE_ROWS, SLICE_CHARS = 512, 8_000_000

#: White space of the word rule: space and the control characters 9 to 13.
#: ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def held_out() -> Column:
    """The rows that no model may learn from. A row without id counts as 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def in_order(doc_id: str, row: str) -> Column:
    """One number that orders rows by id, null last, and then by row number.

    Decimals are grouped minima that Spark combines in place. An id has 19 digits and a
    row number, whose upper part is a partition, fewer than 18.
    """
    last = F.lit("9223372036854775808").cast("decimal(19,0)")
    ids = F.coalesce(F.col(doc_id).cast("decimal(19,0)"), last)
    return (ids * F.lit("1000000000000000000").cast("decimal(19,0)") + F.col(row)).cast("decimal(38,0)")


def row_of(order: Column) -> Column:
    return F.pmod(order, F.lit("1000000000000000000").cast("decimal(19,0)")).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: str | None = None) -> Iterator[dict[str, list]]:
    """Columns of a few rows at a time, so that no more than some MB of text are copied. Of
    compressed texts the column ``size`` has the bytes that they unpack to."""

    def length(column: pa.Array) -> int:
        return column.nbytes if size is None else pc.sum(column).as_py() or 0

    for batch in batches:
        start, n = 0, batch.num_rows
        at = batch.schema.get_field_index(size or text)
        while start < n:
            take = min(SLICE_ROWS, n - start)
            if at >= 0:
                while take > 1 and length(batch.column(at).slice(start, take)) > SLICE_CHARS:
                    take = max(1, take // 2)
            yield {k: v.to_pylist() for k, v in zip(batch.schema.names, batch.slice(start, take).columns)}
            start += take


def scan(
    docs: DataFrame,
    columns: list[str],
    of_slice: Callable[[dict[str, list]], dict[str, list]],
    schema: str | T.StructType,
    size: str | None = None,
) -> DataFrame:
    """``of_slice`` over all rows, a slice at a time, inside Spark's tasks."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, size=size):
            yield pa.RecordBatch.from_pydict(of_slice(part), schema=arrow)

    wanted = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow(wanted)
    return docs.select(*columns).mapInArrow(over, wanted)


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def stage_text(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``stage`` for tables that hold texts, which zstd makes about a third smaller."""
    return stage(df, folder, name, "zstd")


def free_name(docs: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``docs`` has that name."""
    taken = {c.lower() for c in docs.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
