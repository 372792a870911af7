"""The corpus pipeline: documents in, packed sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes what a
stage returns as Parquet and reads it again as the next one's ``docs``. All stages but the
last return the columns of ``documents``.

Every row of ``docs`` is judged; a stage's rows may repeat (mixing repeats documents on
purpose). Null texts count as empty ones, null ids and sources are allowed, further columns of
any name are kept up to packing, an empty table gives an empty result.

A stage's own tables go to ``folder``, a new one of its own unless given. ``run`` removes them,
and what the stage read, once the stage's result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staymart.llm.common import table
from staymart.llm.lines import without_repeats
from staymart.llm.mixing import repeated
from staymart.llm.packing import pieces
from staymart.llm.quality_rules import keep_good, rules_for
from staymart.llm.queries import TOKENIZER
from staymart.llm.simhash import first_of_groups
from staymart.scratch import scratch_folder, stage
from staymart.sources.files import discard, with_scheme


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Documents that the base rules and the boosted trees keep."""
    return keep_good(docs, rules_for(docs, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Documents without lines that repeat, exactly or within two edits, a line that stays
    elsewhere.

    ``n_chars`` is set anew where the text has changed.
    """
    return without_repeats(docs, folder)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, folder: str | None = None) -> DataFrame:
    """One document of each group of near fingerprints, the one of smallest id."""
    return first_of_groups(docs, folder)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return repeated(docs, folder=folder)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Pieces of documents as sequences, with their token ids."""
    return pieces(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixture", source_mixture),
    ("packing", packing),
]

#: Trees, fingerprints and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, docs, last = scratch_folder(spark), table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir, f"{base}/{name}/own"), f"{base}/{name}/result", "rows")
        for done in (f"{base}/{name}/own", last):
            if done:
                discard(with_scheme(done))
        last = f"{base}/{name}/result"
    return docs
