"""Nearest vectors and hard negatives against plain versions."""

from __future__ import annotations

import math
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import ann, hardneg
from tallyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

LARGE_DIR = SF_DIR.replace("sf0.001", "sf0.1")


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def near_plain(rows, k, picked):
    """{query id: [(vec_id, score)]} of rows (id, vector), exactly."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and sound(v) and any(v)})
    out = {}
    for i, v in rows:
        if picked(i):
            near = [(math.dist(v, w), j) for j, w in rows if j != i]
            out[i] = [(j, s) for s, j in sorted(near)[:k]]
    return out


def near_found(spark, rows, k, condition, **names):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, list string")
    out = {}
    for r in sorted(ann.nearest(df, condition, k, **names).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_nearest_defined_cases(spark):
    rows = [
        (0, [1.0, 0.0]),
        (0, [1.0, 0.0]),  # repeated
        (1, [0.0, 1.0]),
        (2, [1.0, 0.0]),
        (3, [1.0, 0.0]),  # ties with 2
        (4, None),
        (5, [0.0, 0.0]),
        (6, [1.0, None]),
        (7, [float("nan"), 1.0]),
        (8, [float("inf"), 1.0]),
        (9, []),
        (11, [1.0, 2.0, 3.0]),
        (None, [1.0, 0.5]),
        (10, [2.0, 2.0]),
    ]
    want = near_plain([r for r in rows if r[0] != 11], 10, lambda i: i % 10 == 0)
    assert near_found(spark, rows, 10, "id % 10 = 0") == want
    assert want[0][:2] == [(2, 0.0), (3, 0.0)]


def test_nearest_of_nothing(spark):
    assert near_found(spark, [], 3, "id % 10 = 0") == {}
    assert near_found(spark, [(0, [1.0])], 3, "id % 10 = 0") == {}
    assert near_found(spark, [(1, None)], 3, "id % 10 = 0") == {}


def test_many_copies_are_found(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [0.5] * 8) for i in range(2000)] + [(i, rng.normal(size=8).tolist()) for i in range(2000, 6000)]
    found = near_found(spark, rows, 10, "id = 100 OR id = 3000")
    want = near_plain(rows, 10, lambda i: i in (100, 3000))
    assert found[100] == want[100]
    assert len(found[3000]) == 10


def test_every_query_gets_its_number_of_rows(spark):
    """Also one that lies alone, far from lists that are full."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 3000)]
    rows += [(5000 + i, [1e6 * (i + 1), 0.0, 0.0, 0.0]) for i in range(3)]
    found = near_found(spark, rows, 10, "id >= 5000 OR id = 1")
    assert {q: len(x) for q, x in found.items()} == {1: 10, 5000: 10, 5001: 10, 5002: 10}
    want = near_plain(rows, 10, lambda i: i >= 5000)
    assert all(found[q][:2] == want[q][:2] for q in want)


def test_lists_are_balanced_and_boundary_rows_replicated():
    sample = np.random.default_rng(1).normal(size=(4096, 16))
    built = ann.fit(sample, 16, 10)
    assert len(built.centroids) == 16 and built.ratio > 1
    row, lists = built.posted(sample)
    assert set(row) == set(range(4096)) and len(row) > 4096
    first = np.bincount(ann.squares(sample, built.centroids).argmin(1), minlength=16)
    assert first.max() <= 2.5 * 4096 / 16
    leaves = ann.balanced_means(np.arange(64.0)[:, None], 8)
    assert np.allclose(np.sort(leaves[:, 0]), np.arange(8) * 8 + 3.5)


def test_the_graph_finds_the_selected_lists():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(8192, 32))
    built = ann.fit(sample, 128, 10)
    queries = rng.normal(size=(64, 32))
    d = np.sqrt(ann.squares(queries, built.centroids))
    want = [set(np.flatnonzero(x <= built.ratio * x.min())) for x in d]
    found = [set(x) for x in built.selected(queries)]
    assert sum(len(a & b) for a, b in zip(found, want, strict=True)) >= 0.99 * sum(map(len, want))


def recall(spark, sf_dir):
    rows = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = QUERIES["op12_nearest_vectors"](spark, sf_dir).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = set(ids[np.lexsort((ids, d))[:10]].tolist())
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == ids[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        at = {int(i): s for i, s in zip(ids, d, strict=True)}
        assert all(s == pytest.approx(at[i], abs=1e-12) for _, i, s in mine)
        hits += len(want & {i for _, i, _ in mine})
        total += 10
    return hits / total


@needs_data
@pytest.mark.parametrize("sf_dir", [SF_DIR, LARGE_DIR])
def test_recall(spark, sf_dir):
    assert recall(spark, sf_dir) >= 0.9


def hard_plain(rows, picked, positives=5, negatives=10, low=30, high=90):
    """Rows (id, label, vector) straight from the definition."""
    rows = {(i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and sound(v)}
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for i, y, v in rows:
        if not picked(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in rows if j != i)
        for s, j in [(-s, j) for s, j, z in scored if z == y][:positives]:
            hard = [(-t, k) for t, k, z in scored if z != y and low * s <= -100 * t <= high * s][:negatives]
            out += [(i, j, n + 1, k, s, t) for n, (t, k) in enumerate(hard)]
    return sorted(out)


def hard_found(spark, rows, condition):
    df = spark.createDataFrame([(i, y, v, 1) for i, y, v in rows], "vec_id long, label int, embedding array<double>, key int")
    return sorted(tuple(r) for r in hardneg.mine(df, condition).collect())


def test_hard_negatives_defined_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 3), rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(i + 60, 1, rows[i][2]) for i in range(30)]  # copies under other ids
    rows += [rows[0], rows[7]]  # repeated
    rows += [(200, None, [1.0] * 5), (210, 1, None), (220, 1, [1.0, None, 1.0, 1.0, 1.0]), (230, 1, [float("nan")] * 5)]
    rows += [(None, 1, [1.0] * 5), (240, 2, [0.0] * 5), (250, 9, [1.0] * 5)]
    want = hard_plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert hard_found(spark, rows, "id % 10 = 0") == want
    odd = [(300, 1, [1.0]), (310, 1, []), (320, 1, [1e30] * 5), (330, 2, [-1e6] * 5)]  # take no part
    assert hard_found(spark, rows + odd, "id % 10 = 0") == want


def test_hard_negatives_of_nothing(spark):
    assert hard_found(spark, [], "id % 10 = 0") == []
    assert hard_found(spark, [(0, 1, [1.0])], "id % 10 = 0") == []
    assert hard_found(spark, [(1, None, None)], "id % 10 = 0") == []


def test_large_components_keep_exact_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(i % 2), (rng.normal(size=9) * 3000).tolist()) for i in range(40)]
    assert hard_found(spark, rows, "id % 10 = 0") == hard_plain(rows, lambda i: i % 10 == 0)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(1, 12), st.integers(0, 2**32))
def test_scores_are_inner_products(dim, rows, seed):
    rng = np.random.default_rng(seed)
    anchors, values = rng.integers(-300, 300, (2, dim)), rng.integers(-300, 300, (rows, dim))
    tables = hardneg.subset_sums(anchors)
    packed = hardneg.bit_planes(values, 10)
    for i in range(2):
        assert hardneg.scores(tables[i], packed).tolist() == (values @ anchors[i]).tolist()
