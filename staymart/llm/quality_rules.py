"""Quality rules: base rules and boosted trees over the statistics of a document.

The trees are fitted on a bounded sample of labelled documents outside the held-out
quarter. More symbols, repeated lines or repeated words never raise a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from staymart.llm.common import scan
from staymart.llm.statistics import BASE, FEATURES, sample_for, statistics
from staymart.llm.trees import Trees, boost

#: The features that may only lower a score.
FALLING = ["symbol_share", "dup_line_share", "repeat_share", "same_next_share", "top_word_share"]


def fit_rules(x: np.ndarray, y: np.ndarray) -> Trees:
    return boost(x, y, monotone={FEATURES.index(name): -1 for name in FALLING})


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(docs: DataFrame, model: Trees, least: float = 0.5) -> DataFrame:
    """``doc_id``, ``BASE``, ``score``, ``base_failed`` and ``kept`` per row of ``docs``.

    A null text counts as empty; a text of fewer than ten words, the empty one too, fails the
    base rules. Other columns do not matter. An empty table gives no rows. Without labels
    the model is its prior: all that pass the base rules are kept.
    """

    def of_slice(part):
        rows = [statistics(x) for x in part["text"]]
        x = np.array([r[len(BASE) :] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
        return (
            {"doc_id": part["doc_id"]}
            | {k: [r[i] for r in rows] for i, k in enumerate(BASE)}
            | {"score": model.score(x).tolist()}
        )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", score double"
    out = scan(docs, ["doc_id", "text"], of_slice, schema).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def keep_good(docs: DataFrame, model: Trees, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass.

    A null or empty text has no words, so it goes. Repeated rows are judged each, and alike;
    columns of any name are kept; an empty table gives no rows.
    """

    def over(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = [statistics(x.as_py()) for x in part.column("text")]
                x = np.array([r[len(BASE) :] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
                words, repeats = np.array([r[0] for r in rows]), np.array([r[4] for r in rows])
                kept = (model.score(x) >= least) & (words >= 10) & (100 * repeats <= 20 * words)
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(over, docs.schema)


def rules_for(docs: DataFrame, sf_dir: str) -> Trees:
    return fit_rules(*sample_for(docs.sparkSession, docs, sf_dir))
