import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from staymart.llm import periodic_runs as pr
from staymart.llm import queries


def slow_runs(words):
    """(start, length, period) by comparing every word with the one each period further."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def random_words(rng, most=400):
    words = []
    for _ in range(rng.randint(0, 8)):
        letters = rng.choice([1, 2, 3, 5, 20])
        block = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        words += block * rng.choice([1, 1, 2, 4, 5, 9])
        if rng.random() < 0.3:
            words = words * rng.choice([1, 2, 4, 5])
    return words[:most]


def test_runs_are_those_of_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        words = random_words(rng)
        found = pr.find_runs(np.array(words, np.int64))
        assert list(zip(*(c.tolist() for c in found))) == slow_runs(words)


def test_texts_of_a_slice_do_not_mix():
    rng = random.Random(2)
    texts = [[b"%d" % w for w in random_words(rng)] for _ in range(80)] + [[], [b"a"] * 5, [b"a"] * 6, []]
    for words, found in zip(texts, pr.runs_of_texts(texts)):
        assert list(zip(*(c.tolist() for c in found))) == slow_runs(words)
    assert pr.runs_of_texts([]) == []


def test_copies_beside_each_other_have_no_runs_in_common():
    rng = random.Random(7)
    copy = [b"%d" % rng.randrange(10**6) for _ in range(120)]
    long = [b"x%d" % i for i in range(4_000)]
    texts = [copy, copy, [b"y"] * 9 + copy, copy, long, copy * 5, copy]
    found = pr.runs_of_texts(texts)
    assert [list(zip(*(c.tolist() for c in f))) for f in found] == [slow_runs(t) for t in texts]


def test_extensions_are_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(30):
        words = random_words(rng, 200) + [99]
        extend = pr.Extensions(np.array(words, np.int64))
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words))]
        a, b = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        for i, j, got in zip(a, b, extend(a, b)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            assert got == k


def test_only_the_cover_is_sorted():
    extend = pr.Extensions(np.arange(1_300))
    assert len(extend.rank) <= 4 * (1_300 // 13 + 2)


def slow_row(doc_id, text, periodic=True):
    words = (text or "").encode("utf-8", "surrogatepass").split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if periodic and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()
    return (doc_id, len(runs), *best, milli, *digests, n, len(gone))


def test_query_equals_brute_force_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r["text"] or "") < 9_000]
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    for r in docs:
        assert got[r["doc_id"]] == slow_row(r["doc_id"], r["text"])
    assert any(row[1] for row in got.values())


def test_odd_rows_empty_table_and_clashing_names(spark, odd_docs, no_docs, make_docs):
    rows = odd_docs.collect()
    clash = odd_docs.withColumns({c: F.lit(1) for c in ("start", "n_runs", "length", "period")})
    got = sorted((tuple(r) for r in pr.run_report(clash).collect()), key=repr)
    assert len(got) == len(rows)
    long_word_runs = [r for r in got if r[0] == 3]
    assert long_word_runs[0][1:6] == (1, 0, 30_000, 1, 30_000_000) and long_word_runs[0][-1] == 29_999
    short = [r for r in rows if len(r[1] or "") < 1_000]
    wanted = [slow_row(i, text, periodic=False) for i, text, *_ in short]
    assert sorted((r for r in got if r[0] != 3 and r[0] != 4), key=repr) == sorted((w for w in wanted), key=repr)
    assert pr.run_report(no_docs).collect() == [] and pr.all_runs(no_docs).collect() == []
    # ties: two runs of one length, the earlier one counts
    tied = make_docs([(5, "a a a a a a x b b b b b b", "en", "s")])
    assert tuple(pr.run_report(tied).first())[1:5] == (2, 0, 6, 1)
    assert [tuple(r) for r in pr.all_runs(tied).orderBy("start").collect()] == [(5, 0, 6, 1), (5, 7, 6, 1)]


def test_without_runs_keeps_other_columns(make_docs):
    docs = make_docs([(1, "go go go go go go now", "en", "s"), (2, "one  two\nthree", "en", "s"), (3, None, None, None)])
    rows = {r["doc_id"]: r for r in pr.without_runs(docs).collect()}
    assert rows[1]["text"] == "go now" and rows[2]["text"] == "one  two\nthree" and rows[3]["text"] is None
    assert rows[1]["source"] == "s" and set(docs.columns) == set(rows[1].asDict())


def test_grid_work_stays_near_linear():
    """Places looked at: n/3 times a harmonic sum, and few of them go on to an extension."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 1_000, 200_000)
    i, q = pr.grid_hits(words, len(words))
    assert len(i) < 100
    start, length, period = pr.find_runs(np.arange(300_000) % 1_000)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [300_000], [1_000])
