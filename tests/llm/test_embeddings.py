import math

import numpy as np

import pytest

from staymart.llm.embeddings import code_for, pairs_within, passed, product_code, unit_rows, vector_groups
from tests.llm.test_simhash import groups

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows):
    """Links, components by plain comparison of all pairs."""
    usable = []
    for i, v, label in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable.append((i, unit_rows(np.array([v], np.float32).astype(np.float64))[0], label))
    links = []
    for n, (i, a, x) in enumerate(usable):
        links += [(i, j) for j, b, y in usable[:n] if x == y and len(a) == len(b) and a @ b >= 0.93]
    return links


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(60):
            base = rng.standard_normal(64)
            for k in range(rng.integers(1, 5)):
                noise = rng.standard_normal(64) * rng.choice([0.0, 0.1, 0.3, 0.5])
                rows.append((at, [float(x) for x in np.float32(base + noise)], label))
                at += 1
    rows += [(at, None, 0), (at + 1, [], 0), (at + 2, [0.0] * 64, 0), (at + 3, [float("nan")] + [1.0] * 63, 0)]
    rows += [(at + 4, [None] + [1.0] * 63, 0), (at + 5, [1e30] * 64, 0), (at + 6, [1e-30] * 64, 0), (at + 7, [1.0, 2.0], 0), (at + 8, [2.0, 4.0], 0)]
    frame = spark.createDataFrame([(i, v, l, "clash") for i, v, l in rows], SCHEMA).repartition(4)
    got = {r.vec_id: r for r in vector_groups(frame).collect()}
    links = brute(rows)
    wanted, degree = groups([r[0] for r in rows], links), {}
    for pair in links:
        for i in pair:
            degree[i] = degree.get(i, 0) + 1
    assert len(got) == len(rows)
    for i, row in got.items():
        assert row.n_links <= degree.get(i, 0)
        assert row.kept == (row.vec_id == row.component_id)
        if i in got and row.component_id != i:
            assert wanted[i] == wanted[row.component_id]
    found = sum(r.n_links for r in got.values()) / 2
    assert found >= 0.97 * len(links)
    assert got[at + 5].component_id == got[at + 6].component_id == at + 5
    assert got[at + 8].n_links == 1


def test_copies_and_large_groups_are_counted(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(64)
    rows = [(i, [float(x) for x in base], 4, "x") for i in range(40)]
    rows += [(100 + i, [float(x) for x in base + 0.02 * rng.standard_normal(64)], 4, "x") for i in range(60)]
    rows += [(None, [float(x) for x in base], 4, "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for block_rows in (7, 256):  # many pairs of blocks, or one block
        got = vector_groups(frame, block_rows=block_rows).collect()
        assert {r.n_links for r in got} == {100}
        assert {r.component_id for r in got} == {0}


def test_empty_table(spark):
    assert vector_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_filters_are_those_over_the_threshold():
    rng = np.random.default_rng(0)
    unit = unit_rows(rng.standard_normal((5, 12)))
    rotation, codes = product_code(12, 3, 5)
    for v, got in zip(unit, passed(unit, 3, 5, 0.3, 0)):
        turned = v @ rotation
        wanted = [
            (i * 5 + j) * 5 + k
            for i in range(5)
            for j in range(5)
            for k in range(5)
            if (turned[:4] @ codes[0][i] + turned[4:8] @ codes[1][j] + turned[8:] @ codes[2][k]) / np.sqrt(3) > 0.3
        ]
        assert sorted(wanted) == got.tolist()


@pytest.mark.parametrize("vectors", [1_000, 1_000_000, 30_000_000])
def test_recall_at_the_bound(vectors):
    """At every size; and so few of these vectors meet that each meets a bounded number."""
    rng = np.random.default_rng(5)
    a = unit_rows(rng.standard_normal((300, 64)))
    z = rng.standard_normal((300, 64))
    z = unit_rows(z - (z * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * z
    code, threshold, least = code_for(vectors, 4)
    assert code**4 >= 256 * vectors
    one, two = passed(a, 4, code, threshold, least), passed(b, 4, code, threshold, least)
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(one, two)]) >= 0.95
    taken = np.mean([len(x) for x in one])
    assert taken <= 1.1 * least  # vectors times filters taken, over all filters, is what a filter holds
    assert vectors * taken / code**4 <= 1


def test_pairs_are_of_different_balls():
    rng = np.random.default_rng(2)
    for _ in range(50):
        rows = sorted((int(g), int(b)) for g, b in rng.integers(0, 4, (rng.integers(0, 20), 2)))
        group, ball = (np.array([r[k] for r in rows], int) for k in (0, 1))
        split, side = group == 1, rng.integers(0, 2, len(rows))
        i, j = pairs_within(group, ball, split, side)
        wanted = [
            (x, y)
            for y in range(len(rows))
            for x in range(y)
            if group[x] == group[y] and ball[x] != ball[y] and (not split[x] or side[x] != side[y])
        ]
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(wanted)


@pytest.mark.parametrize("noise", [0.08, 0.13, 0.19, 0.25])
def test_dense_groups_equal_all_pairs(spark, noise):
    """From one ball with all vectors, over balls with stragglers, to links that hold in part."""
    rng = np.random.default_rng(9)
    rows = []
    for label in (0, 1):
        base = rng.standard_normal(64)
        for _ in range(120):
            rows.append((len(rows), [float(x) for x in np.float32(base + noise * rng.standard_normal(64))], label, "x"))
        rows += [(len(rows) + k, *rows[-1][1:]) for k in range(3)]
    links = brute([r[:3] for r in rows])
    degree = {}
    for pair in links:
        for i in pair:
            degree[i] = degree.get(i, 0) + 1
    wanted = groups([r[0] for r in rows], links)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.vec_id: r for r in vector_groups(frame, block_rows=16).collect()}
    assert all(r.n_links <= degree.get(i, 0) for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.99 * 2 * len(links)
    assert {i: r.component_id for i, r in got.items()} == {i: wanted[i] for i in got}
