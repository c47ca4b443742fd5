import hashlib
import math
import random

import numpy as np
import pytest

from voltframe.llm import va_clusters as va

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda r: ((r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1])
    centres = [v for _, v in sorted(kept, key=first)[:16]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(3):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else c for k, c in enumerate(centres)]
    best = [(i, *nearest(v)) for i, v in kept]
    by = {k: sum(d for _, d, c in best if c == k) for _, _, k in best}
    return sorted(((i, k, d, by[k], sum(by.values()),
                    hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, d, k in best), key=str)


def got(df):
    return sorted(map(tuple, va.cluster(df).collect()), key=str)


def rows_of(seed, n, spread):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.5) for _ in range(64)] for _ in range(5)]
    return [(k * 7, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(middles)]) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n,spread", [(10, 0.1), (150, 0.02), (150, 1.0)])
def test_equals_plain_version(spark, n, spread):
    rows = rows_of(n, n, spread)
    rows += [(5, None), (6, [0.5] * 63), (8, [float("nan")] * 64), (9, [None] + [0.5] * 63), (11, [-math.inf] * 64), (12, [])]
    assert got(frame(spark, rows)) == plain(rows)


def test_ties_repeats_null_ids_outliers_and_extra_columns(spark):
    rows = [(k % 9 if k % 4 else None, [float((k * j) % 3) for j in range(64)]) for k in range(40)]
    rows += [(100, [0.0] * 64), (101, [1000.0] * 64), (102, [-1000.0] + [0.0] * 63)]
    df = frame(spark, rows).selectExpr("*", "1 AS v", "2 AS cells", "3 AS cluster", "4 AS distance")
    assert got(df) == plain(rows)


def test_empty_table_and_bound(spark):
    assert got(frame(spark, [])) == []
    with pytest.raises(ValueError, match="distances would not fit"):
        va.cluster(frame(spark, [(1, [1e30] * 64)]))


def test_settled_rows_are_not_fetched(spark):
    """Clusters that stand far apart are decided by cells alone."""
    rng = random.Random(3)
    rows = [(k, [float(np.float32(10 * (k % 3) + rng.random())) for _ in range(64)]) for k in range(300)]
    found = va.fit(frame(spark, rows))
    assert found.fetched[0] == 300  # the first sums take every vector once
    assert got(frame(spark, rows)) == plain(rows)
    far = np.repeat(np.array([[0], [3000]]), 64, 1)
    grid = va.Grid(np.tile(np.arange(200, 3200, 200), (64, 1)), np.zeros(64, int), np.full(64, 3199))
    cells = grid.pack(np.array([[10] * 64, [2990] * 64, [1500] * 64]))
    assert va.candidates(cells, grid.bounds(far)).tolist() == [[True, False], [False, True], [True, True]]
    seen = []
    va.moved(cells, grid, far, far, lambda rows: (seen.extend(rows), np.full((len(rows), 64), 1500))[1])
    assert seen == [2]


def test_bounds_hold_every_value(spark):
    rng = np.random.default_rng(1)
    rows, centres = rng.integers(-40, 40, (500, 64)), rng.integers(-40, 40, (16, 64))
    grid = va.Grid(np.tile(np.arange(-35, 40, 5), (64, 1)), rows.min(0), rows.max(0))
    table, cells = grid.bounds(centres), grid.pack(rows)
    bounds = sum(table[d][cells[:, d]] for d in range(64))
    exact = ((rows[:, None] - centres) ** 2).sum(2) - (rows ** 2).sum(1)[:, None]
    assert (bounds[:, :16] <= exact).all() and (exact <= bounds[:, 16:]).all()
