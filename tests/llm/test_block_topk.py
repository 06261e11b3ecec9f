import math

import numpy as np
import pytest

from rankforge.llm import block_topk as B

SCHEMA = "vec_id long, embedding array<double>, id string, score int"


def brute(rows, k=10, every=100):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, **setting):
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in B.top_k(df, **setting).collect())


@pytest.mark.parametrize("setting", [{}, {"range_rows": 40, "block": 4, "pack_rows": 2, "packs_at_once": 1, "max_cells": 5}])
def test_equals_brute_force(spark, setting):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(400)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, -1.0]) for i in range(400, 700)]  # a large group of equal vectors
    rows += [(1000, None), (1100, []), (1200, [float("nan")]), (1300, [float("inf"), 1.0]), (1400, [None, 1.0]), (None, [9.0] * 6),
             (1500, [1.0, 2.0]), (300, [1.0] * 6), (7, [1.0] * 6), (7, [1.0] * 6), (-100, [-3.0] * 6), (1600, [0.0] * 6)]
    assert run(spark, rows, **setting) == brute(rows)


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (2, [1.0]), (1, [1.0])]) == [(0, 1, 1, 2 ** 20), (0, 2, 2, 2 ** 20)]
    assert run(spark, [(0, []), (2, [])]) == [(0, 1, 2, 0)]


def test_large_components_stay_exact(spark):
    rows = [(i * 100, [float(2 ** 17 + i), 2.0 ** 18, -float(i)]) for i in range(30)]
    assert run(spark, rows, k=3) == brute(rows, k=3)


def test_blocks_below_the_kth_score_are_skipped():
    rows = np.vstack([np.full((64, 4), 9), np.full((640, 4), 1), np.full((64, 4), -5)]).astype(np.int64)
    r = B.Range(np.arange(len(rows)), rows, 64)
    q = np.ones(4, np.int64)
    read = []
    r.rows = type("Rows", (), {"__getitem__": lambda _, at: read.append(len(at)) or rows[at]})()
    reach = B.bounds(q[None], r.high, r.low)[0]
    assert [i for _, i in r.best(5, q, reach, 10, None)] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert sum(read) == 64
    scores = rows @ q
    for a, bound in zip(range(0, len(rows), 64), reach):
        assert scores[a:a + 64].max() <= bound
