import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import residue_negatives as rn

ROWS = "vec_id long, embedding array<double>, label int"


def clamp(score):
    return min(max(score, -(2**63)), 2**63 - 1)


def plain(rows, every, positives=5, negatives=5, low=80):
    held = {}
    for key, v, label in rows:
        if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(256 * x) for x in v):
            held[key] = min((v, label), held.get(key, (v, label)))
    whole = {key: ([math.floor(256 * x) for x in v], label) for key, (v, label) in held.items()}
    out = []
    for a, (v, label) in whole.items():
        if a % every:
            continue
        found = sorted((-clamp(sum(x * y for x, y in zip(v, w))), c, m) for c, (w, m) in whole.items() if c != a and len(w) == len(v))
        for ps, p, _ in [f for f in found if f[2] == label][:positives]:
            near = [(s, c) for s, c, m in found if m != label and low * -ps <= 100 * -s <= 100 * -ps]
            out += [(a, p, n, c, -ps, -s) for n, (s, c) in enumerate(near[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", [(3, 0, 5), (5, 64, 9), (4, 2500, 6), (7, 1, 2)])
@pytest.mark.parametrize("size", [3.0, 300.0, 2.0**24, 2.0**29, 2.0**60, 1e300])
def test_products_are_exact(shape, size):
    rng = np.random.default_rng(1)
    a, b = (np.floor(rng.uniform(-size, size, (n, shape[1]))) for n in (shape[0], shape[2]))
    want = [[clamp(sum(int(x) * int(y) for x, y in zip(u, v))) for v in b] for u in a]
    assert rn.scores(a, b).tolist() == want


def test_products_at_the_edge_of_the_range():
    a = np.array([[255.0] * 64, [-256.0] * 64, [0.0] * 64])
    assert rn.scores(a, a).tolist() == [[int(x @ y) for y in a] for x in a]
    p = next(rn.primes())
    assert (p // 2) ** 2 * (rn.EXACT // (p // 2) ** 2) <= rn.EXACT and len(rn.enough_primes(70_000)) == 3


@pytest.mark.parametrize("blocks", [(1024, 8192, 128), (3, 16, 2)])
def test_equals_brute_force(spark, scratch, monkeypatch, blocks):
    for name, n in zip(("ANCHOR_BLOCK", "CANDIDATE_BLOCK", "SLICE"), blocks):
        monkeypatch.setattr(rn, name, n)
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 1, 8)
    rows = [(i, [float(x) for x in centre + rng.normal(0, 0.2, 8)], int(rng.integers(0, 3) if i % 3 else 0)) for i in range(240)]
    rows += [(240 + i, rows[i % 5][1], i % 4) for i in range(40)]  # ties and a hot label
    got = rn.hard_negatives(spark.createDataFrame(rows, ROWS).repartition(3), scratch, F.col("vec_id") % 20 == 0)
    want = plain(rows, 20)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark, scratch):
    rows = [
        (0, [1.0, -0.5], 1), (1, [float("nan"), 1.0], 1), (2, [None, 1.0], 1), (3, None, 1), (4, [], 1), (5, [float("inf"), 0.0], 1),
        (-5, [0.9, -0.4], 2), (None, [1.0, 1.0], 1), (7, [1.0, -0.5], 1), (7, [1.0, -0.5], 1), (7, [2.0, 0.0], 2), (8, [2.0], 2), (10, [], 1),
        (12, [1.0, -0.5], None), (15, [0.95, -0.4], 3), (20, [3.0], 2), (25, [], 2), (30, [1e307, 1.0], 1), (35, [1e300, 1.0], 1), (40, [1e300, 2.0], 1),
        (45, [1e300, 2.0], 4), (50, [-1.0, 0.5], 9),
    ]
    extra = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], ROWS + ", dim string, a int, c int, cells int")
    got = rn.hard_negatives(extra, scratch, F.col("vec_id") % 5 == 0)
    want = plain(rows, 5)
    assert want and sorted(map(tuple, got.collect())) == want


def test_empty_table(spark, scratch):
    assert rn.hard_negatives(spark.createDataFrame([], ROWS), scratch, F.lit(True)).collect() == []
