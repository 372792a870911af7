import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from staymart.llm import simhash
from staymart.llm.components import connected_components
from staymart.scratch import scratch_folder


def groups(ids, links):
    """Smallest member reachable, by plain union-find."""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_majority_of_shingle_bits():
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c a", "ÄÖ ü É x  y\tz", "w " * 300]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_fingerprint_uses_the_same_hash_as_spark(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert simhash.fingerprint("A b C") == row["h"]


def test_allocation_sums_up_and_costs_least():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 500, (40, 3))
    chosen = simhash.allocate(counts, [22, 21, 21], [0.5, 2.0, 0.1], 2)
    assert (chosen.sum(axis=1) == 0).all()

    def cost(row, r):
        total, ways = 0.0, {-1: 0, 0: 1}
        for k, width in enumerate([22, 21, 21]):
            ways[1], ways[2] = 1 + width, 1 + width + width * (width - 1) // 2
            if r[k] >= 0:
                total += row[k] + (ways[r[k]] - 1) * [0.5, 2.0, 0.1][k] + ways[r[k]]
        return total

    options = [(a, b, -a - b) for a in range(-1, 3) for b in range(-1, 3) if -1 <= -a - b <= 2]
    for row, got in zip(counts, chosen):
        assert np.isclose(cost(row, got), min(cost(row, r) for r in options))


def test_links_are_those_of_brute_force_also_in_dense_regions(spark):
    rng = random.Random(4)
    centre, fps = rng.getrandbits(64), set()
    for _ in range(300):  # a dense region: everything within a few bits of one value
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for _ in range(200):
        lone = rng.getrandbits(64)
        fps |= {lone, lone ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))}
    fps = sorted(fps)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    wanted = groups(signed, [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= 2])
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    for most in (8, 256, 10**6):  # nearly all dense, some dense, none dense
        folder = scratch_folder(spark)
        links = simhash.near_links(frame, folder, most=most)
        pairs = links.collect()
        assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in pairs)
        assert groups(signed, [tuple(p) for p in pairs]) == wanted


def test_groups_of_odd_documents(odd_docs, no_docs):
    rows = simhash.simhash_groups(odd_docs.withColumn("fp", F.lit(1)).withColumn("node", F.lit(2))).collect()
    assert len(rows) == 9
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert sum(r.fingerprint == "0" * 16 for r in rows) == 4
    assert simhash.simhash_groups(no_docs).collect() == []
    assert simhash.first_of_groups(no_docs).collect() == []


def test_one_document_of_a_group_stays(make_docs):
    text = "some words that make up a text of which there are copies"
    docs = make_docs([(9, text, "en", "a"), (7, text, "en", "b"), (7, text, "en", "b"), (None, text, "en", "c"), (8, "quite another text here", "en", "a")])
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.source) for r in kept.collect()) == [(7, "b"), (8, "a")]
    nameless = make_docs([(None, text, "en", "a"), (None, text, "en", "b")])
    assert simhash.first_of_groups(nameless).count() == 1
    assert [r.component_id for r in simhash.simhash_groups(nameless).collect()] == [None, None]


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 200)] + [(7, 7), (3, 3)]
    links += [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(250)]
    frame = spark.createDataFrame(links, "a long, b long").union(spark.sql("SELECT 1L, CAST(NULL AS LONG)"))
    got = {r.node: r.component for r in connected_components(frame, scratch_folder(spark)).collect()}
    proper = [(a, b) for a, b in links if a != b]
    assert got == groups({x for p in proper for x in p}, proper)
    assert connected_components(frame.where("a < 0"), scratch_folder(spark)).count() == 0
