"""Substring dedup by compaction of a de Bruijn graph of words.

Windows of ``K`` consecutive words are the edges of the graph, from their first ``K - 1`` words
to their last. Only edges that occur in two documents matter, and most do not. Each edge has a
minimizer: the least hash of the runs of ``GRAM`` words in it. Consecutive edges of a text with
one minimizer form a path, and paths are what goes through Spark:

1. All paths are shuffled by minimizer, once. A minimizer of a single document is of no further
   use. A path that is also in a smaller document repeats as a whole, and all its edges are
   settled at once; its source is the smallest document that has it.
2. If a minimizer has several paths, they branch, as at the ends of a repeat. The edges of the
   first occurrence of each such path are grouped one by one and joined back.
3. Edges that follow each other, and do so at their source, too, make up one long span.

Hashes: a path is known by those of its minimizer and of its edges, 64 bits each; an edge of a
path that branches by two of 64 bits. ``verified`` compares spans with the words at their source
coordinates.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from staymart.llm.common import scan, stage_text, utf8
from staymart.scratch import scratch_folder, stage

#: Words of a window, and of the runs whose least hash is its minimizer.
K, GRAM = 13, 7
#: A null id counts as the largest one.
LAST = 2**63 - 1
U64 = np.uint64
RNG = np.random.default_rng(113)
WEIGHTS = [U64(int(x) | 1) for x in RNG.integers(0, 2**63, 2 * K + GRAM)]
BASE = 0xD6E8FEB86659FD93
BACK = pow(BASE, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one map that spreads all bits."""
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(29))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


def rolled(h: np.ndarray, weights: list[np.uint64]) -> np.ndarray:
    """A hash of every run of ``len(weights)`` numbers."""
    n = len(h) - len(weights) + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for j, weight in enumerate(weights):
        total += h[j : j + n] * weight
    return mixed(total)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


@dataclass
class Paths:
    """The paths of some texts: of which text, first window there, windows, and two hashes."""

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    minimizer: np.ndarray
    path: np.ndarray
    edge: np.ndarray  # a hash of the window at each word of all texts, sensible within a text
    vocabulary: dict[bytes, int]
    codes: np.ndarray  # words of all texts, numbered as in the vocabulary
    first: np.ndarray  # where each text starts in ``codes``

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the window at each word; the second one is made only now."""
        return self.edge, rolled(hashes(self.vocabulary, 2)[self.codes], WEIGHTS[K : 2 * K])


def hashes(vocabulary: dict[bytes, int], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in vocabulary], U64)


def paths_of(texts: list[list[bytes]]) -> Paths:
    """The paths of texts given as words."""
    vocabulary: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter((vocabulary[w] for t in texts for w in t), np.int64)
    h = hashes(vocabulary, 1)[codes]
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    windows = np.maximum(0, sizes - K + 1)
    edge = rolled(h, WEIGHTS[:K])
    gram = rolled(h, WEIGHTS[2 * K :])
    least = gram[: len(edge)].copy()
    for j in range(1, K - GRAM + 1):
        np.minimum(least, gram[j : j + len(edge)], out=least)
    # windows that lie within a text
    of = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = first[of] + place
    own, least = edge[at], least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    # the hash of a path is a polynomial in its edges, taken from sums over the whole slice
    sums = np.append(U64(0), np.cumsum(own * powers(BASE, len(own)), dtype=U64))
    path = (sums[begin + size] - sums[begin]) * powers(BACK, len(own))[begin] if len(begin) else sums[:0]
    path = mixed(path + size.astype(U64))
    return Paths(of[begin], place[begin], size, least[begin], path, edge, vocabulary, codes, first)


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc, salt``: the id to compare by, and a hash of the text that splits
    rows of one id. Rows that agree in both are treated alike."""
    return docs.select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.hash("text").alias("salt")
    )


PACKED = "doc_id long, doc long, salt int, size long, packed binary"


def packed_rows(part: dict[str, list]) -> dict[str, list]:
    texts = [utf8(t) for t in part["text"]]
    return {c: part[c] for c in ("doc_id", "doc", "salt")} | {
        "size": [len(t) for t in texts],
        "packed": [zlib.compress(t, 1) for t in texts],
    }


def packed_texts(own: DataFrame) -> DataFrame:
    """Texts as they are shuffled: compressed one by one they take two thirds of what Spark's
    own compression of the shuffle leaves. ``size`` is that of the text in bytes."""
    return scan(own, ["doc_id", "text", "doc", "salt"], packed_rows, PACKED)


def required(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in fields])


PATH_ROW = required(("minimizer", T.LongType()), ("path", T.LongType()), ("doc", T.LongType()), ("place", T.LongType()))


def path_rows(part: dict[str, list]) -> dict[str, np.ndarray]:
    """Each path of a text once: hashes, document, and salt and first window in one number."""
    p = paths_of([utf8(t).split() for t in part["text"]])
    order = np.lexsort((p.start, p.path, p.minimizer, p.text))
    new = np.ones(len(order), bool)
    for c in (p.text, p.minimizer, p.path):
        new[1:] &= c[order[1:]] == c[order[:-1]]
    once = order[~new | (np.arange(len(order)) == 0)]
    doc, salt = np.array(part["doc"], np.int64), np.array(part["salt"], np.int64)
    place = (salt[p.text[once]] << 32) | p.start[once]
    return {"minimizer": p.minimizer[once].view(np.int64), "path": p.path[once].view(np.int64), "doc": doc[p.text[once]], "place": place}


def listed_paths(rows: DataFrame) -> DataFrame:
    """``doc, salt, paths``: per document those of its paths that another document may share,
    with a source, or none if the edges have to be asked about.

    One shuffle and one sort serve both windows.
    """
    alike, met = Window.partitionBy("minimizer", "path"), Window.partitionBy("minimizer")
    known = rows.repartition("minimizer").select(
        "*", F.min("doc").over(alike).alias("source"), F.min_by("place", "doc").over(alike).alias("source_place")
    )
    known = known.select(
        "*",
        F.min("source").over(met).alias("least"),
        F.max("doc").over(met).alias("largest"),
        F.min("path").over(met).alias("one"),
        F.max("path").over(met).alias("other"),
    )
    again, branches = F.col("source") < F.col("doc"), F.col("one") != F.col("other")
    shared = known.where((F.col("least") < F.col("largest")) & (again | branches))
    entry = F.struct(
        "minimizer",
        "path",
        F.when(again, F.col("source")).alias("source"),
        F.col("source_place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("source_start"),
    )
    salt = F.shiftright("place", 32).cast("int").alias("salt")
    return shared.groupBy("doc", salt).agg(F.collect_list(entry).alias("paths"))


def counted(words: list[bytes], hits: list[tuple[int, int]]) -> tuple[int, str]:
    """Words removed, and the digest of those left, by stretches (first window, windows)."""
    kept = words
    if hits:
        change = np.zeros(len(words) + 1, np.int64)
        start, size = np.array(hits, np.int64).T
        np.add.at(change, start, 1)
        np.add.at(change, start + size + K - 1, -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


STRETCH = "array<struct<start:bigint,size:bigint,source:bigint,source_start:bigint>>"
JUDGED = f"""doc_id long, doc long, salt int, n_words long, n_removed long, kept_sha256 string, packed binary,
    hits {STRETCH}, start array<long>, one array<long>, two array<long>"""
ASKED = ["start", "one", "two"]


def judged_rows(part: dict[str, list]) -> dict[str, list]:
    """What the listed paths say of each text, and the windows still to be asked about. Only a
    text with some of these is handed on, compressed as it came."""
    out = defaultdict(list)
    texts = [zlib.decompress(t).split() for t in part["packed"]]
    some = [k for k, paths in enumerate(part["paths"]) if paths]
    p = paths_of([texts[k] for k in some])
    cuts = np.searchsorted(p.text, np.arange(len(some) + 1))
    names = list(zip(p.minimizer.view(np.int64).tolist(), p.path.view(np.int64).tolist()))
    found: dict[int, tuple[list, list]] = {}
    for n, k in enumerate(some):
        known = {(e["minimizer"], e["path"]): e for e in part["paths"][k]}
        hits, asked = [], []
        for i in range(cuts[n], cuts[n + 1]):
            e = known.get(names[i])
            if e is None:
                continue
            if e["source"] is None:
                asked.append(i)
            else:
                hits.append((int(p.start[i]), int(p.size[i]), e["source"], e["source_start"]))
        found[k] = hits, asked
    one, two = p.edges() if any(asked for _, asked in found.values()) else (None, None)
    none = np.zeros(0, np.int64)
    for k, words in enumerate(texts):
        hits, asked = found.get(k, ((), ()))
        removed, digest = (None, None) if asked else counted(words, [h[:2] for h in hits])
        start = np.concatenate([np.arange(p.start[i], p.start[i] + p.size[i]) for i in asked] or [none])
        at = start + p.first[p.text[asked[0]]] if asked else none
        for name in ("doc_id", "doc", "salt"):
            out[name].append(part[name][k])
        out["n_words"].append(len(words))
        out["n_removed"].append(removed)
        out["kept_sha256"].append(digest)
        out["packed"].append(part["packed"][k] if asked else None)
        out["hits"].append([dict(zip(("start", "size", "source", "source_start"), h)) for h in hits])
        out["start"].append(start)
        out["one"].append(one[at].view(np.int64) if asked else none)
        out["two"].append(two[at].view(np.int64) if asked else none)
    return out


def answers(judged: DataFrame, folder: str) -> DataFrame:
    """``doc, salt, answers``: the asked windows that a document with a smaller id has, too.

    What is known of a window is written, so that the join back is one of plain scans, which
    adaptive execution splits where very many documents ask about one window.
    """
    rows = judged.where("n_removed IS NULL").select("doc", "salt", F.inline(F.arrays_zip(*ASKED)))
    known = rows.groupBy("one", "two").agg(
        F.min("doc").alias("source"), F.max("doc").alias("largest"), F.min_by("start", "doc").alias("source_start")
    )
    known = stage(known.where("source < largest").drop("largest"), folder, "known")
    again = rows.join(known, ["one", "two"]).where("source < doc")
    return again.groupBy("doc", "salt").agg(F.collect_set(F.struct("one", "two", "source", "source_start")).alias("answers"))


def settled(part: dict[str, list], finish) -> dict[str, list]:
    """``finish`` per row, of its words and all stretches found, answered windows included."""
    out = defaultdict(list)
    for k in range(len(part["doc_id"])):
        known = {(a["one"], a["two"]): a for a in part["answers"][k] or ()}
        hits = [(h["start"], h["size"], h["source"], h["source_start"]) for h in part["hits"][k]]
        for start, one, two in zip(*(part[c][k] for c in ASKED)):
            a = known.get((one, two))
            if a is not None:
                hits.append((start, 1, a["source"], a["source_start"]))
        for name, values in finish(k, zlib.decompress(part["packed"][k]).split(), sorted(hits)).items():
            out[name] += values
    return out


def judged_documents(docs: DataFrame, folder: str) -> DataFrame:
    """The first step over all documents, as a written table."""
    own = identified(docs)
    lists = listed_paths(scan(own, ["text", "doc", "salt"], path_rows, PATH_ROW))
    both = packed_texts(own).join(lists.hint("merge"), ["doc", "salt"], "left")
    judged = scan(both, ["doc_id", "packed", "size", "doc", "salt", "paths"], judged_rows, JUDGED, "size")
    return stage_text(judged, folder, "judged")


PENDING = ["doc_id", "n_words", "packed", "hits", *ASKED]


def asked_rows(judged: DataFrame, folder: str) -> DataFrame:
    pending = judged.where("n_removed IS NULL").select("doc", "salt", *PENDING)
    return pending.join(answers(judged, folder).hint("merge"), ["doc", "salt"], "left")


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def span_report(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row of ``docs``.

    A word is removed if a window of ``K`` words that covers it is also in a document with a
    smaller id. A null text has no words; a null id counts as the largest one; rows of one id
    remove nothing from each other, be they equal or not. Texts shorter than a window stay.
    Other columns do not matter; an empty table gives no rows.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    judged = judged_documents(docs, folder)

    def rows(part):
        def finish(k, words, hits):
            removed, digest = counted(words, [h[:2] for h in hits])
            row = part["doc_id"][k], part["n_words"][k], removed, digest
            return {c: [v] for c, v in zip(("doc_id", "n_words", "n_removed", "kept_sha256"), row)}

        return settled(part, finish)

    later = scan(asked_rows(judged, folder), [*PENDING, "answers"], rows, REPORT)
    done = judged.where("n_removed IS NOT NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(later)


def compacted(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Stretches of windows as spans of words: those that follow each other in step with their
    source are one."""
    spans: list[list[int]] = []
    for start, size, source, source_start in hits:
        last = spans[-1] if spans else None
        if last and start == last[0] + last[1] and source == last[2] and source_start - start == last[3] - last[0]:
            last[1] += size
        else:
            spans.append([start, size, source, source_start])
    return [(start, size + K - 1, source, source_start) for start, size, source, source_start in spans]


SPAN = "doc_id long, start long, length long, source_doc_id long, source_start long"


def repeated_spans(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, start, length, source_doc_id, source_start`` in words: the spans of each text
    that stand, word for word, in a document with a smaller id. Neighbouring spans overlap
    where windows of one have another source than those of the next."""
    folder = folder or scratch_folder(docs.sparkSession)
    judged = judged_documents(docs, folder)
    names = ("doc_id", "start", "length", "source_doc_id", "source_start")

    def spans_of(doc_id, hits):
        return {c: list(v) for c, v in zip(names, zip(*((doc_id, *s) for s in compacted(hits))))}

    def early(part):
        out = {c: [] for c in names}
        for doc_id, hits in zip(part["doc_id"], part["hits"]):
            for c, values in spans_of(doc_id, sorted(tuple(h.values()) for h in hits)).items():
                out[c] += values
        return out

    def late(part):
        found = settled(part, lambda k, words, hits: spans_of(part["doc_id"][k], hits))
        return {c: found.get(c, []) for c in names}

    done = judged.where("n_removed > 0").select("doc_id", "hits")
    asked = asked_rows(judged, folder)
    return scan(done, ["doc_id", "hits"], early, SPAN).unionByName(
        scan(asked, [*PENDING, "answers"], late, SPAN)
    )


def words_between(start: str, length: str) -> Column:
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.sha2(F.concat_ws(" ", F.slice(words, F.col(start).cast("int") + 1, F.col(length).cast("int"))), 256)


def verified(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans`` with ``same``: do the words at the source coordinates equal those of the span?
    ``docs`` must not hold an id twice."""
    texts = docs.select(F.col("doc_id").alias("source_doc_id"), "text")
    source = spans.join(texts, "source_doc_id").withColumn("there", words_between("source_start", "length")).drop("text")
    own = source.join(docs.select("doc_id", "text"), "doc_id").withColumn("here", words_between("start", "length"))
    return own.select(*spans.columns, (F.col("here") == F.col("there")).alias("same"))
