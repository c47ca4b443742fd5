import hashlib
import math
import random

import numpy as np
import pytest

from voltframe.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """The contract in plain Python; all vectors of one length."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // 4
    parts = {k: [tuple(v[p * w:(p + 1) * w]) for p in range(4)] for k, (_, v, _) in enumerate(kept)}
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0], kept[k][1]))[:256]
    books = [[parts[k][p] for k in order] for p in range(4)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            own = {}
            for k in parts:
                own.setdefault(nearest(p, parts[k][p])[1], []).append(parts[k][p])
            books[p] = [tuple(sum(c) // len(own[i]) for c in zip(*own[i])) if i in own else e
                        for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for k, (i, _, lab) in enumerate(kept):
        best = [nearest(p, parts[k][p]) for p in range(4)]
        out.append([i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab])
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    return sorted(((i, c, d, by_label[lab], digest) for i, c, d, lab in out), key=str)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.encode(df).collect()), key=str)


def vectors(rng, n, width=8, grain=40):
    return [[rng.randrange(-grain, grain) / 1024 + rng.choice([0, 0.0004]) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("n,grain", [(40, 3), (400, 6), (300, 500)])
def test_equals_plain_version(spark, n, grain):
    rng = random.Random(n)
    rows = [(k * 3, [float(np.float32(x)) for x in v], rng.choice([None, 1, 2])) for k, v in enumerate(vectors(rng, n, 8, grain))]
    rows += [(7, None, 1), (8, [0.1, None] * 4, 1), (10, [float("nan")] * 8, 2), (11, [float("inf")] * 8, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_repeated_rows_null_ids_extra_columns(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3, 4]), [float(np.float32(x)) for x in v], 1) for v in vectors(rng, 20)] * 2
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS n", "3 AS part", "4 AS code", "5 AS error")
    assert got(df) == plain(rows)


def test_empty_table_and_other_lengths(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 4, 1), (4, [], None)]
    by_id = {r[0]: r for r in got(spark.createDataFrame(rows, SCHEMA))}
    assert by_id[1][1:4] == ("00000000", 0, 0) and by_id[2][1] == "01010101"
    assert by_id[3][1:3] == (None, None) and by_id[4][1:4] == (None, None, None)
    odd = got(spark.createDataFrame([(1, [0.5] * 7, 1)], SCHEMA))
    assert odd[0][:4] == (1, None, None, None)


def test_components_beyond_the_bound_raise(spark):
    with pytest.raises(Exception, match="distances would not fit"):
        vc.encode(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA)).collect()


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_trie_walk_in_any_block_size(monkeypatch, block):
    monkeypatch.setattr(vc, "BLOCK", block)
    rng = np.random.default_rng(block)
    parts = rng.integers(-2, 3, (200, 5))
    parts = parts[np.lexsort(parts.T[::-1])]
    book = rng.integers(-3, 4, (9, 5))
    distance = ((parts[:, None] - book[None]) ** 2).sum(2)
    index, best = vc.nearest(parts, book)
    assert (index == distance.argmin(1)).all() and (best == distance.min(1)).all()
