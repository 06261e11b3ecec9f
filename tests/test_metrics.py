import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import metrics as M


def brute_auc(y, p, w=None):
    w = w or [1.0] * len(y)
    num = den_p = den_n = 0.0
    for yi, pi, wi in zip(y, p, w):
        if yi == 1:
            den_p += wi
        else:
            den_n += wi
    for yi, pi, wi in zip(y, p, w):
        if yi != 1:
            continue
        for yj, pj, wj in zip(y, p, w):
            if yj == 1:
                continue
            num += wi * wj * (1.0 if pj < pi else 0.5 if pj == pi else 0.0)
    return num / (den_p * den_n) if den_p * den_n > 0 else None


def ref_auc_200(y, p, w, curve="ROC"):
    eps = 1e-7
    t = M.thresholds()
    y, p, w = map(np.asarray, (y, p, w))
    tp = np.array([np.sum(w * y * (p > ti)) for ti in t])
    fp = np.array([np.sum(w * (1 - y) * (p > ti)) for ti in t])
    fn = np.array([np.sum(w * y * (p <= ti)) for ti in t])
    tn = np.array([np.sum(w * (1 - y) * (p <= ti)) for ti in t])
    rec = (tp + eps) / (tp + fn + eps)
    if curve == "ROC":
        x, yy = fp / (fp + tn + eps), rec
    else:
        x, yy = rec, (tp + eps) / (tp + fp + eps)
    return float(np.sum((x[:-1] - x[1:]) * (yy[:-1] + yy[1:]) / 2))


def frame(spark, y, p, w=None, g=None):
    w = w or [1.0] * len(y)
    g = g or [0] * len(y)
    return spark.createDataFrame([(float(a), float(b), float(c), int(d)) for a, b, c, d in zip(y, p, w, g)],
                                 "y double, p double, w double, g int")


def test_exact_auc_ties_and_weights(spark):
    rng = np.random.default_rng(1)
    y = list(rng.integers(0, 2, 300))
    p = list(np.round(rng.random(300), 1))          # heavy ties
    w = list(np.round(rng.random(300) + 0.5, 2))
    got = M.auc_exact(frame(spark, y, p, w), "y", "p", "w").first()["auc"]
    assert got == pytest.approx(brute_auc(y, p, w), abs=1e-12)
    q = M.auc_exact(frame(spark, y, p, w), "y", "p", "w", binning="quantile", bins=8).first()["auc"]
    assert q == pytest.approx(got, abs=1e-12)


def test_exact_auc_monotone_invariant_and_one_class(spark):
    rng = np.random.default_rng(2)
    y = list(rng.integers(0, 2, 200))
    p = list(rng.random(200))
    a = M.auc_exact(frame(spark, y, p), "y", "p").first()["auc"]
    b = M.auc_exact(frame(spark, y, [math.exp(3 * v) - 7 for v in p]), "y", "p").first()["auc"]
    assert a == pytest.approx(b, abs=1e-12)
    assert M.auc_exact(frame(spark, [1, 1, 1], [0.1, 0.2, 0.3]), "y", "p").first()["auc"] is None
    assert M.auc_exact(frame(spark, [0, 0], [0.1, 0.2]), "y", "p").first()["auc"] is None


def test_grouped_auc_and_logloss(spark):
    rng = np.random.default_rng(3)
    y = list(rng.integers(0, 2, 400))
    p = list(rng.random(400))
    g = list(rng.integers(0, 4, 400))
    res = {r.g: r for r in M.auc_exact(frame(spark, y, p, None, g), "y", "p", None, ["g"], with_logloss=True).collect()}
    for k in range(4):
        idx = [i for i in range(400) if g[i] == k]
        assert res[k].auc == pytest.approx(brute_auc([y[i] for i in idx], [p[i] for i in idx]), abs=1e-12)
        ll = np.mean([-(y[i] * math.log(p[i] + 1e-7) + (1 - y[i]) * math.log(1 - p[i] + 1e-7)) for i in idx])
        assert res[k].logloss == pytest.approx(ll, abs=1e-12)


def test_auc_200_matches_reference_including_grid_scores(spark):
    rng = np.random.default_rng(4)
    y = list(rng.integers(0, 2, 500))
    p = list(rng.random(480)) + [i / 199 for i in range(1, 21)]     # scores exactly on thresholds
    w = list(np.round(rng.random(500) + 0.5, 2))
    df = frame(spark, y, p, w)
    assert M.auc_200(df, "y", "p", "w").first()["auc"] == pytest.approx(ref_auc_200(y, p, w), abs=1e-12)
    assert M.auc_200(df, "y", "p", "w", curve="PR").first()["auc"] == pytest.approx(
        ref_auc_200(y, p, w, "PR"), abs=1e-12)


def test_logloss_denominator_is_row_count(spark):
    df = frame(spark, [1, 0], [0.9, 0.2], [2.0, 0.5])
    got = M.weighted_logloss(df, "y", "p", "w").first()["logloss"]
    exp = (2.0 * -math.log(0.9 + 1e-7) + 0.5 * -math.log(0.8 + 1e-7)) / 2
    assert got == pytest.approx(exp)


def test_precision_recall_and_report(spark):
    df = frame(spark, [1, 1, 0, 0], [0.9, 0.4, 0.6, 0.1])
    pr = M.precision_recall(df, "y", "p").first()
    assert (pr.precision, pr.recall, pr.accuracy) == (0.5, 0.5, 0.5)
    rep = {r.metric: r.value for r in M.eval_report(df, "y", "p").collect()}
    assert set(rep) == set(M.EVAL_METRICS)
    assert rep["accuracy_baseline"] == 0.5 and rep["label_mean"] == 0.5


def test_logit_ce_stable(spark):
    df = spark.createDataFrame([(1.0, 800.0), (0.0, -800.0), (1.0, 0.0)], "y double, z double")
    ce = M.logit_ce(df, "y", "z").first()["ce"]
    assert ce == pytest.approx(math.log(2) / 3)


def test_histogram_and_l2(spark):
    df = frame(spark, [0, 1, 1], [0.0, 0.5, 1.0])
    h = {r.bin: r.n for r in M.pred_histogram(df, "p", 4).collect()}
    assert h == {0: 1, 2: 1, 3: 1}
    w = spark.createDataFrame([("a", 0.5), ("a", -0.5), ("b", 1.0)], "field string, w double")
    l2 = {r.field: r.l2 for r in M.l2_penalty(w, 0.2).collect()}
    assert l2["a"] == pytest.approx(0.05) and l2["b"] == pytest.approx(0.1)


def test_threshold_cell_counts_every_threshold(spark):
    import random
    rng = random.Random(3)
    for n in (2, 3, 4, 50, 200, 1000):
        t = M.thresholds(n)
        xs = [x + d for x in t for d in (0.0, 1e-17, -1e-17, 2e-16, -2e-16)] + [rng.uniform(-0.1, 1.1) for _ in range(500)]
        xs += [0.0, -0.0, 1.0, float("inf"), float("-inf"), float("nan"), None, 1e300, -1e300]
        got = spark.createDataFrame([(x,) for x in xs], "p double").select("p", M.threshold_cell(F.col("p"), n).alias("c")).collect()
        for r in got:
            want = 0 if r.p is None else len(t) if r.p != r.p else sum(v < r.p for v in t)
            assert r.c == want, (n, r.p)


def _scans(df):
    """Reads of the input and jobs' Python stages in the plan, those of reused exchanges not counted."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Scan ExistingRDD")


def test_metrics_read_the_rows_once(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 3 == 0), (i % 10) / 10, 1.0 + i % 4) for i in range(200)], "y double, y2 double, p double, w double")
    assert _scans(M.auc_200(df, "y", "p", "w")) == 1
    assert _scans(M.auc_200(df, "y", "p", "w", curve="PR", method="careful_interpolation")) == 1
    assert _scans(M.eval_report(df, "y", "p", "w")) == 1
    tasks = {"a": ("y", "p", None), "b": ("y2", "p", None), "c": ("y2", "p", F.col("y") == 1)}
    assert _scans(M.auc_per_task(df, tasks, "w", exact=False)) == 1
    rows = {r.task: r.auc for r in M.auc_per_task(df, tasks, "w", exact=True).collect()}
    for name, (y, p, cond) in tasks.items():
        one = M.auc_exact(df if cond is None else df.where(cond), y, p, "w").first().auc
        assert abs(rows[name] - one) < 1e-12
    wide = M.eval_report(df, "y", "p", "w", long=False).first()
    assert abs(wide.auc - M.auc_200(df, "y", "p", "w").first().auc) < 1e-12
    pr = M.precision_recall(df, "y", "p", "w").first()
    assert abs(wide.precision - pr.precision) + abs(wide.recall - pr.recall) + abs(wide.accuracy - pr.accuracy) < 1e-12
