"""Periodic runs of words: maximal stretches in which a period repeats four times or more.

A run of period q and four periods or more holds, at three steps of q out of four, words that
equal the word q further on, in one stretch of 3q such places. So among the places 0, 3q, 6q ...
of a text, a harmonic grid over all q, one lies in that stretch. Where the word there and the
one q further agree, and enough of their neighbours do, the longest common extension to the
right and to the left gives the run.

Extensions come from a difference cover. Of all suffixes only those at places 0, 1, 3 and 9
modulo 13 are sorted: any two places reach two such ones by the same step of at most 12. A few
words are compared up to there, the rest is the least common prefix between two ranks, a
range-minimum over a sparse table. Extensions to the left are those of the reversed words.

Texts of a slice are one sequence with a word of its own between any two, so no run crosses.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from staymart.llm.common import scan, utf8

#: A run is ``least`` words long or ``times`` periods, whichever is more.
LEAST, TIMES = 6, 4
#: Differences of these numbers give every number modulo the period.
COVER, MODULUS = (0, 1, 3, 9), 13
#: Grid places that are looked at together.
BLOCK = 1 << 20


def steps_to_cover() -> np.ndarray:
    """For two residues, the least step after which both are in the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    steps = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            steps[a, b] = next(d for d in range(MODULUS) if inside[a + d] and inside[b + d])
    return steps


STEPS = steps_to_cover()


class Extensions:
    """Longest common extensions to the right in one sequence of word numbers, all >= 0."""

    def __init__(self, words: np.ndarray):
        n = self.n = len(words)
        # Past the end, words of their own that equal none and each other only in place.
        self.words = np.concatenate([words, -1 - np.arange(2 * MODULUS)]).astype(np.int64)
        places = np.arange(n + MODULUS)
        places = places[np.isin(places % MODULUS, COVER)]
        self.index = np.full(n + 2 * MODULUS, -1, np.int64)
        self.index[places] = np.arange(len(places))
        ranks = self.sorted_by_blocks(places)
        self.rank = ranks[-1]
        order = np.argsort(self.rank, kind="stable")
        self.table = self.sparse_table(self.neighbours(places, order, ranks))

    def sorted_by_blocks(self, places: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 13 words, 26, 52 ..., until all differ."""
        columns = self.packed(places)
        ranks = [dense(np.lexsort(columns), columns)] if places.size else [np.zeros(0, np.int64)]
        width = MODULUS
        while places.size and ranks[-1].max() + 1 < len(places):
            later = places + width
            ends = later >= len(self.index)
            follow = np.where(ends, -1, self.index[np.minimum(later, len(self.index) - 1)])
            second = np.where(follow >= 0, ranks[-1][follow], -1 - places)
            columns = [second, ranks[-1]]
            ranks.append(dense(np.lexsort(columns), columns))
            width *= 2
        return ranks

    def packed(self, places: np.ndarray) -> list[np.ndarray]:
        """The 13 words at each place as few numbers, the last words first."""
        plain = self.words + 2 * MODULUS  # the padding is above zero then
        bits = int(plain.max()).bit_length()
        columns = []
        for first in range(0, MODULUS, 63 // bits):
            key = np.zeros(len(places), np.int64)
            for d in range(first, min(MODULUS, first + 63 // bits)):
                key = (key << bits) | plain[places + d]
            columns.append(key)
        return columns[::-1]

    def neighbours(self, places: np.ndarray, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Words that each sorted suffix shares with the next one."""
        a, b = places[order[:-1]], places[order[1:]]
        shared = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            i, j = self.sample(a + shared), self.sample(b + shared)
            same = (i >= 0) & (j >= 0)
            same[same] = ranks[level][i[same]] == ranks[level][j[same]]
            shared[same] += MODULUS << level
        return shared + self.compared(a + shared, b + shared, np.full(len(a), MODULUS))

    def sample(self, place: np.ndarray) -> np.ndarray:
        inside = place < len(self.index)
        return np.where(inside, self.index[np.minimum(place, len(self.index) - 1)], -1)

    def compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from ``a`` and ``b`` on, word by word, up to ``most``."""
        found = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        end = len(self.words)
        for d in range(MODULUS):
            alive = alive[most[alive] > d]
            i, j = a[alive] + d, b[alive] + d
            fine = (i < end) & (j < end)
            fine[fine] = self.words[i[fine]] == self.words[j[fine]]
            alive = alive[fine]
            if not len(alive):
                break
            found[alive] += 1
        return found

    @staticmethod
    def sparse_table(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            last = table[-1]
            table.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b``, which differ, have in common."""
        step = STEPS[a % MODULUS, b % MODULUS]
        found = self.compared(a, b, step)
        far = np.flatnonzero(found == step)
        i, j = self.rank[self.index[a[far] + step[far]]], self.rank[self.index[b[far] + step[far]]]
        low, high = np.minimum(i, j), np.maximum(i, j)
        level = np.frexp(high - low)[1].astype(np.int64) - 1
        least = np.empty(len(far), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            least[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        found[far] += least
        return found


def dense(order: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Ranks from 0, equal rows alike, of rows that ``order`` sorts."""
    new = np.zeros(len(order), bool)
    for c in columns:
        sorted_column = c[order]
        new[1:] |= sorted_column[1:] != sorted_column[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def grid_hits(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, q) on the harmonic grid where the word equals the one ``q`` further on and so do
    enough neighbours for a run. ``longest`` bounds the texts' lengths, in words."""
    n, places, periods = len(words), [], []
    top = longest // TIMES

    def keep(i: np.ndarray, q: np.ndarray) -> None:
        # Of a stretch of 5 or more equal words around i, at least 5 lie within 4 of it.
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for side, total in ((1, right), (-1, left)):
            alive = np.arange(len(i))
            for d in range(1, LEAST - 1):
                a = i[alive] + side * d
                b = a + q[alive]
                inside = (a >= 0) & (b < n)
                inside[inside] = words[a[inside]] == words[b[inside]]
                alive = alive[inside]
                if not len(alive):
                    break
                total[alive] += 1
        # the stretch is max(LEAST, TIMES q) - q long, so LEAST - 1 at least
        fine = right + left + 1 >= np.minimum(LEAST - 1, np.maximum(LEAST - q, (TIMES - 1) * q))
        places.append(i[fine])
        periods.append(q[fine])

    q, near = 1, min(top, 512)
    while q <= near:  # long grids, one at a time
        a, b = words[0 : n - q : 3 * q], words[q : n : 3 * q]
        i = np.flatnonzero(a == b) * (3 * q)
        if len(i):
            keep(i, np.full(len(i), q))
        q += 1
    while q <= top:  # short grids, many at a time
        size = max(1, BLOCK // (n // (3 * q) + 1))
        qs = np.arange(q, min(top, q + size - 1) + 1)
        each = -(-(n - qs) // (3 * qs))
        period = np.repeat(qs, each)
        i = (np.arange(len(period)) - np.repeat(np.cumsum(each) - each, each)) * 3 * period
        same = words[i] == words[i + period]
        if same.any():
            keep(i[same], period[same])
        q = int(qs[-1]) + 1
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs in a sequence of word numbers, all >= 0,
    by start and then period."""
    return extended(words, *grid_hits(words, len(words)))


def extended(words: np.ndarray, i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs around grid hits."""
    if not len(i):
        return i, i, q
    n = len(words)
    ahead, back = Extensions(words), Extensions(words[::-1].copy())
    right = ahead(i, i + q)
    left = back(n - 1 - i, n - 1 - i - q)
    start = i - left + 1
    length = left - 1 + right + q
    fine = length >= np.maximum(LEAST, TIMES * q)
    start, length, q = start[fine], length[fine], q[fine]
    # the same stretch is found at multiples of its period, too: the smallest counts
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[first], length[first], q[first]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of one document in ten, by a hash of its id, with a tail that repeats."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]


def runs_of_texts(texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each list of words, all lists in one pass; starts count within a list.

    Suffixes are sorted of those texts only that have a hit on the grid.
    """
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter((numbers[w] for t in texts for w in t), np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)  # one word between texts
    whole = np.empty(len(codes) + len(texts), np.int64)
    between = np.zeros(len(whole), bool)
    between[ends - 1] = True
    whole[between] = len(numbers) + np.arange(len(texts))
    whole[~between] = codes
    i, q = grid_hits(whole, max(map(len, texts), default=0))
    of = np.searchsorted(ends, i, "right")
    within = of == np.searchsorted(ends, i + q, "right")
    i, q, of = i[within], q[within], of[within]
    hit = np.unique(of)
    starts = np.append(0, ends[:-1])
    moved = np.cumsum(ends[hit] - starts[hit]) - (ends[hit] - starts[hit])
    some = np.concatenate([whole[starts[k] : ends[k]] for k in hit] or [whole[:0]])
    start, length, period = extended(some, i - starts[of] + moved[np.searchsorted(hit, of)], q)
    owner = np.searchsorted(moved, start, "right") - 1
    none = np.zeros(0, np.int64)
    out = [(none, none, none)] * len(texts)
    for k in range(len(hit)):
        own = slice(*np.searchsorted(owner, [k, k + 1]))
        out[hit[k]] = start[own] - moved[k], length[own], period[own]
    return out


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def run_rows(part: dict[str, list], periodic: bool) -> dict[str, list]:
    out = defaultdict(list)
    texts = [utf8(text).split() for text in part["text"]]
    if periodic:
        texts = [made_periodic(words, doc_id) for words, doc_id in zip(texts, part["doc_id"])]
    for doc_id, words, (start, length, period) in zip(part["doc_id"], texts, runs_of_texts(texts)):
        runs = list(zip(start.tolist(), length.tolist(), period.tolist()))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = collapsed(words, start, length, period)
        out["doc_id"].append(doc_id)
        out["n_runs"].append(len(runs))
        out["start"].append(best[0])
        out["length"].append(best[1])
        out["period"].append(best[2])
        out["exponent_milli"].append(1000 * best[1] // best[2] if runs else None)
        out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        out["n_words"].append(len(words))
        out["n_dropped"].append(len(words) - len(kept))
    return out


REPORT = """doc_id long, n_runs long, start long, length long, period long, exponent_milli long,
    runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"""


def run_report(docs: DataFrame, periodic: bool = False) -> DataFrame:
    """A row per row of ``docs``: how many runs, the longest one, digests of all runs and of
    the words left, ``n_words`` and ``n_dropped``.

    ``periodic`` first makes the tail of one document in ten repeat, chosen by its id. A null
    text has no words, a null id is never chosen. Repeated rows are rows of their own, ties of
    length go to the smallest start. Other columns do not matter; an empty table gives no rows.
    """
    return scan(docs, ["doc_id", "text"], lambda part: run_rows(part, periodic), REPORT)


def all_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, start, length, period`` of every run of every text, null texts without any."""

    def rows(part):
        texts = [utf8(text).split() for text in part["text"]]
        found = [(d, *r) for d, runs in zip(part["doc_id"], runs_of_texts(texts)) for r in zip(*(c.tolist() for c in runs))]
        return dict(zip(("doc_id", "start", "length", "period"), map(list, zip(*found)) if found else [[]] * 4))

    return scan(docs, ["doc_id", "text"], rows, "doc_id long, start long, length long, period long")


def without_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of ``text`` joined by one space, without what a run repeats.

    A text without a run is left as it is. Null texts stay null; other columns stay.
    """

    def rows(part):
        texts = [utf8(text).split() for text in part["text"]]
        new = list(part["text"])
        for k, runs in enumerate(runs_of_texts(texts)):
            if len(runs[0]):
                new[k] = b" ".join(collapsed(texts[k], *runs)).decode("utf-8", "surrogatepass")
        return {**part, "text": new}

    return scan(docs, docs.columns, rows, docs.schema)
