"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies: the source's target
divided by its size. Documents are put in an order of size, expected copies are summed up
along it, one random offset per source is added, and a document is taken once for each
whole number that its stretch of the sum crosses. In an order of size, what is taken from
large and from small documents balances, so the words taken come near the target.

The sum up to a document is its expected copies times its rank. Ranks are found in three
levels, none of which puts a source into one task: size bins of a source, slots of about
``slot_rows`` rows in a bin, rows in a slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from staymart.llm.common import free_name, scan, utf8
from staymart.scratch import scratch_folder, stage

#: Weights of sources in the order of their names, repeated; null comes last.
WEIGHTS = (1, 2, 3)
#: A target is at most so many times the size of its source.
MOST_REPEATS = 3
#: Rows of a slot, on average at most; the bound for one task's sort.
SLOT_ROWS = 4_000


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` per row; a null text has size 0."""
    return scan(
        docs,
        ["doc_id", "source", "text"],
        lambda part: {
            "doc_id": part["doc_id"],
            "source": part["source"],
            "size": [len(utf8(x).split()) for x in part["text"]],
        },
        "doc_id long, source string, size long",
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target``, a row per source.

    All sizes are shared out by weight. A source's target stops at three times its size and
    the excess is shared by weight among the others, again and again. The end of that is a
    level: sources in the order of cap over weight are capped as long as the level that the
    rest would get is not below theirs. The work is on one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    which = (F.row_number().over(named) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), which + 1))
    cap = MOST_REPEATS * F.col("source_size")
    per = per.withColumns({"cap": cap, "ratio": cap / F.col("weight")})
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumns(
        {
            "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    per = per.withColumn("level", F.col("left") / F.col("weights"))
    per = per.withColumn("capped", F.col("level") >= F.col("ratio"))
    # the level of the first source that is not capped holds for all that are not
    level = F.min(F.when(~F.col("capped"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(whole)["level"]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def size_bin(size: Column) -> Column:
    """Eight bins per doubling of the size."""
    return F.floor(8 * F.log2(1 + size)).cast("int")


def offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) with 20 binary places, fixed by the source and the seed."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("long") / F.lit(float(1 << 20))


def spread(doc_id: Column, size: Column) -> Column:
    """32 bits by which rows are dealt to slots, whatever their ids have in common. Rows of one
    id and one size, null ids too, come together: they are ties."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("n")), size.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")


def placed(sizes: DataFrame, folder: str, seed: int = 0, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``sizes`` (a stored table) with ``source_size``, ``target`` and ``copies``.

    Rows are counted by slot once, into a table; targets and ranks are made from that.
    """
    n = sizes.count()
    slots = max(1, -(-n // slot_rows))
    rows = sizes.withColumns(
        {"bin": size_bin(F.col("size")), "slot": F.pmod(spread(F.col("doc_id"), F.col("size")), F.lit(slots))}
    )
    one = F.coalesce("source", F.lit("")), F.col("source").isNull()
    rows = rows.withColumns({"name": one[0], "unnamed": one[1]})
    counts = rows.groupBy("unnamed", "name", "bin", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    counts = stage(counts, folder, "slots")
    target = targets(counts.select(F.when(~F.col("unnamed"), F.col("name")).alias("source"), "size"))
    in_bin = Window.partitionBy("unnamed", "name", "bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before_slot", F.coalesce(F.sum("n").over(in_bin), F.lit(0)))
    bins = counts.groupBy("unnamed", "name", "bin").agg(F.sum("n").alias("n"))
    in_source = Window.partitionBy("unnamed", "name").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before_bin", F.coalesce(F.sum("n").over(in_source), F.lit(0))).drop("n")
    starts = counts.join(bins, ["unnamed", "name", "bin"]).select(
        "unnamed", "name", "bin", "slot", (F.col("before_slot") + F.col("before_bin")).alias("before")
    )
    in_slot = Window.partitionBy("unnamed", "name", "bin", "slot").orderBy("size", F.col("doc_id").asc_nulls_last())
    rows = rows.withColumn("at", F.row_number().over(in_slot)).join(starts, ["unnamed", "name", "bin", "slot"])
    of = target.withColumns({"name": F.coalesce("source", F.lit("")), "unnamed": F.col("source").isNull()}).drop("source")
    rows = rows.join(of, ["unnamed", "name"])
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank, shift = F.col("before") + F.col("at"), offset(F.col("source"), seed)
    copies = F.floor(each * rank + shift) - F.floor(each * (rank - 1) + shift)
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, seed: int = 0, slot_rows: int = SLOT_ROWS, folder: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` per row of ``docs``.

    ``taken`` is ``copies * size``; reruns agree. Ties of size go by ``doc_id``; repeated rows
    are rows of their own. A null source is a source; an empty table gives no rows.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    sizes = stage(sized(docs), folder, "sizes")
    out = placed(sizes, folder, seed, slot_rows)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


#: The same for DuckDB, with ``slot_rows`` as above and seed 0.
MIXTURE_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
slots AS (SELECT greatest(1, CAST(ceil(count(*) / 4000.0) AS BIGINT)) AS k FROM sizes),
weighted AS (
  SELECT source, source_size, 3 * source_size AS cap,
    1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source)),
ordered AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size,
    CASE WHEN level >= ratio THEN CAST(cap AS DOUBLE)
      ELSE weight * (SELECT level FROM ordered WHERE level < ratio ORDER BY ratio, source ASC NULLS LAST LIMIT 1) END AS target
  FROM ordered),
ranked AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source
    ORDER BY CAST(floor(8 * log2(1 + size)) AS INTEGER), CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'n') || ':' || CAST(size AS VARCHAR)), 1, 8) AS BIGINT) % k, size, doc_id ASC NULLS LAST) AS place
  FROM sizes, slots),
shares AS (
  SELECT r.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS each,
    CAST('0x' || substr(md5('0:' || coalesce('s' || r.source, 'n')), 1, 5) AS BIGINT) / 1048576.0 AS shift
  FROM ranked r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(each * place + shift) - floor(each * (place - 1) + shift) AS BIGINT) * size AS taken,
  CAST(floor(each * place + shift) - floor(each * (place - 1) + shift) AS BIGINT) AS copies
FROM shares
"""


def repeated(docs: DataFrame, seed: int = 0, slot_rows: int = SLOT_ROWS, folder: str | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with all their columns.

    Rows are told apart by a number of their own, so null and repeated ids and repeated rows are
    rows like any other; ties of size go by that number. A null text has size 0, a null source
    is a source. Columns of any name are kept; an empty table gives no rows.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    row, times = free_name(docs, "__row"), free_name(docs, "__copies")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), folder, "docs")
    counted = scan(
        held,
        [row, "source", "text"],
        lambda part: {
            "doc_id": part[row],
            "source": part["source"],
            "size": [len(utf8(x).split()) for x in part["text"]],
        },
        "doc_id long, source string, size long",
    )
    sizes = stage(counted, folder, "sizes")
    taken = placed(sizes, folder, seed, slot_rows).where("copies > 0")
    copies = taken.select(F.col("doc_id").alias(row), F.col("copies").alias(times))
    each = held.join(copies, row).select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return each.select(*docs.columns)
