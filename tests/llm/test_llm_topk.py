import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import pivot_topk as pt

ROWS = "vec_id long, embedding array<float>"


def clamp(score):
    return min(max(score, -(2**63)), 2**63 - 1)


def plain(rows, k, every):
    vectors = {}
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors[key] = min(v, vectors.get(key, v))
    whole = {key: [math.floor(1024 * x) for x in v] for key, v in vectors.items()}
    out = []
    for q in whole:
        if q % every == 0:
            scores = [(-clamp(sum(a * b for a, b in zip(whole[q], v))), c) for c, v in whole.items() if c != q and len(v) == len(whole[q])]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def random_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 0.3, dim))]) for i in range(n)]
    return rows + [(n + i, rows[i % 7][1]) for i in range(20)]  # ties


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 16)])
def test_equals_brute_force(spark, scratch, monkeypatch, blocks):
    monkeypatch.setattr(pt, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(pt, "CANDIDATE_BLOCK", blocks[1])
    rows = random_rows(300, 12, 2)
    got = pt.top_k(spark.createDataFrame(rows, ROWS).repartition(3), scratch, F.col("vec_id") % 25 == 0, 10)
    assert sorted(map(tuple, got.collect())) == plain(rows, 10, 25)


def test_odd_rows(spark, scratch):
    rows = [
        (0, [1.0, -0.5]), (1, [float("nan"), 1.0]), (2, [None, 1.0]), (3, None), (4, []), (5, [float("inf"), 0.0]), (-5, [0.25, 0.3]),
        (None, [1.0, 1.0]), (7, [1.0, -0.5]), (7, [1.0, -0.5]), (8, [2.0]), (10, []), (12, [0.1, 0.2]), (15, [0.0, 0.0]), (20, [3.0]),
    ]
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", score string, pair int")
    got = pt.top_k(extra, scratch, F.col("vec_id") % 5 == 0, 3)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 5)


def test_large_components_stay_exact(spark, scratch):
    rows = [(0, [2.0**40, 1.0, 3.0]), (1, [2.0**40, 5.0, 0.0]), (2, [-(2.0**40), 5.0, 0.0]), (3, [0.5, 0.25, 2.0**20])]
    got = pt.top_k(spark.createDataFrame(rows, ROWS), scratch, F.lit(True), 3).collect()
    assert sorted(map(tuple, got)) == plain(rows, 3, 1)


def test_empty_table(spark, scratch):
    empty = spark.createDataFrame([], ROWS)
    assert pt.top_k(empty, scratch, F.lit(True), 10).count() == 0


def test_search_stops_early_where_bounds_allow():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 900, (20, 16)).round()
    c = np.concatenate([centres[i % 20] + rng.normal(0, 5, (1, 16)).round() for i in range(4000)])
    pivots = np.stack(pt.choose_pivots(list(centres))[16])
    side = lambda x, ids: (ids, x, (x**2).sum(1), np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2)))
    seen = []
    exact = pt._products
    pt._products = lambda a, b: (seen.append(len(b)), exact(a, b))[1]
    try:
        list(pt.best_of_block(side(c[:5], np.arange(5)), side(c, np.arange(4000)), 10))
    finally:
        pt._products = exact
    assert sum(seen) < 0.5 * 5 * 4000
