"""Statistics of whole texts, for the quality operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from staymart.llm.common import held_out, scan, table, utf8

SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
STOPS = np.frombuffer(b".,;:!?", np.uint8)
WINDOW = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the models see; all are ratios or logarithms, so that length alone decides little.
FEATURES = [
    "log_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "same_next_share",
    "top_word_share",
    "digit_share",
    "upper_share",
    "stop_share",
    "words_per_line",
]
SCHEMA = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", " + ", ".join(f"{n} double" for n in FEATURES)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside a window of five that the text holds twice or more. Exact: windows are
    compared as packed ids, which are ranked again before they would outgrow 63 bits."""
    n = len(ids) - WINDOW + 1
    if n < 2 or distinct == len(ids):
        return 0
    key, of = ids[:n].astype(np.int64), max(1, distinct)
    limit = of
    for k in range(1, WINDOW):
        if limit > (1 << 62) // of:
            key = np.unique(key, return_inverse=True)[1].reshape(-1)
            limit = n
        key = key * of + ids[k : k + n]
        limit *= of
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[back.reshape(-1)] > 1)
    if not len(starts):
        return 0
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple:
    """The values of ``BASE`` and ``FEATURES``; a null text counts as empty."""
    data = utf8(text)
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - int(octets[0x80:0xC0].sum())
    word_chars = chars - int(octets[SPACES].sum())
    words = data.split()
    n = len(words)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_symbols, n_dup = int(octets[SYMBOLS].sum()), len(lines) - len(set(lines))
    n_repeat = repeated_words(ids, len(index))
    w, c = max(1, n), max(1, word_chars)
    return (
        n,
        word_chars,
        n_symbols,
        n_dup,
        n_repeat,
        float(np.log1p(n)),
        word_chars / w,
        n_symbols / c,
        n_dup / max(1, len(lines)),
        n_repeat / w,
        len(index) / w,
        float((ids[1:] == ids[:-1]).sum()) / w,
        float(np.bincount(ids).max()) / w if n else 0.0,
        int(octets[48:58].sum()) / c,
        int(octets[65:91].sum()) / c,
        int(octets[STOPS].sum()) / c,
        n / max(1, len(lines)),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``BASE`` and ``FEATURES`` per row of ``docs``."""
    names = [*BASE, *FEATURES]

    def of_slice(part):
        rows = [statistics(x) for x in part["text"]]
        return {"doc_id": part["doc_id"]} | {k: [r[i] for r in rows] for i, k in enumerate(names)}

    return scan(docs, ["doc_id", "text"], of_slice, SCHEMA)


def labelled_sample(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = 20_000
) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 labels of about ``most`` labelled rows at most, for fitting only.

    Rows of the held-out quarter and rows without label are left out. The sample is a fixed
    range of a hash of the id, so that reruns agree. Only numbers come to the driver.
    """
    one = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    n = one.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, most / max(1, n)))
    chosen = one.where(share).limit(2 * most)  # the bound holds even for odd hashes
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ids = with_statistics(joined).dropDuplicates(["doc_id"])
    rows = ids.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").select("quality", *FEATURES).toPandas()
    return rows[FEATURES].to_numpy(np.float64), rows["quality"].to_numpy(np.float64)


def sample_for(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[np.ndarray, np.ndarray]:
    return labelled_sample(spark, docs, table(spark, sf_dir, "labels"))
