import numpy as np
import pytest

from hindcast.llm import vectors
from tests.llm.brute import groups

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, dtype=np.float32).astype(np.float64)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [None if i is None else unit(v) for i, v in rows]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
        and units[a] @ units[b] >= threshold
    ]
    root = groups(range(len(rows)), links)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root[n]] = min(i, least.get(root[n], i))
    return sorted(
        (
            (i, sum(n in x for x in links), least.get(root[n]), i is not None and i == least[root[n]])
            for n, (i, _) in enumerate(rows)
        ),
        key=str,
    )


def got(spark, rows, **how):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    table = table.selectExpr("*", "1 AS v", "2 AS node", "3 AS class", "4 AS component")
    return sorted((tuple(r) for r in vectors.near_duplicates(table, **how).collect()), key=str)


def cloud(seed=1, n=160, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.02, 0.3, 0.45, 2])
        rows.append((int(i * 37 % 1009), (v * rng.choice([1e-3, 1, 50])).astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("tile", [16, 4096])
def test_same_as_brute_force(spark, tile):
    rows = cloud()
    rows += [(2000 + k, rows[k % 5][1]) for k in range(30)]
    found = got(spark, rows, tile=tile)
    assert found == brute(rows)
    assert 30 < sum(not r[3] for r in found) < len(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [1.0, nan, 3.0]),
        (6, [1.0, inf, 3.0]), (None, one), (None, one), (9, one), (8, one), (8, one), (10, [2.0, 4.0, 6.0]),
        (11, [1.0, 2.0]), (12, [3e38, 3e38, 3e38]), (13, [1e-38, 1e-38, 1e-38]), (14, [-0.0, 1.0, 0.0]),
        (15, [0.0, 1.0, -0.0]),
    ]
    found = got(spark, rows)
    assert found == brute(rows)
    assert got(spark, []) == []


def test_pairs_at_the_threshold_are_decided_in_double_precision(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(60):  # pairs with a cosine within 1e-4 of the threshold
        u = rng.normal(size=64)
        u /= np.linalg.norm(u)
        w = rng.normal(size=64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = 0.9 + rng.uniform(-1e-4, 1e-4)
        rows += [(2 * i, u.astype(np.float32).tolist()), (2 * i + 1, (c * u + (1 - c * c) ** 0.5 * w).astype(np.float32).tolist())]
    found = got(spark, rows, tile=32)
    assert found == brute(rows)
    assert 10 < sum(r[1] for r in found) < 110


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = vectors._Tile(np.arange(300), np.ones(300), rng.normal(size=(300, 64)) ** 3)
    product = (x.whole.astype(float) * x.step[:, None]) @ (x.whole.astype(float) * x.step[:, None]).T
    bound = (
        x.length[:, None] * x.error + x.error[:, None] * x.length + x.error[:, None] * x.error
    )
    assert (np.abs(x.units @ x.units.T - product) <= bound + 1e-12).all()
