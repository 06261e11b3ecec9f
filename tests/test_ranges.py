import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import metrics as M
from rankforge.operators import ranges as R
from rankforge.operators.fit import exact_quantiles


def test_crowded_values_are_cut_into_bounded_ranges(spark):
    v = [0.5 + i * 1e-9 for i in range(5000)] + [float(i) for i in range(100)]  # nearly all in one old bin
    df = spark.createDataFrame([("a", x) for x in v] + [("b", x) for x in v[:50]], "k string, v double")
    out = R.placed(df, [F.col("k"), F.col("v")], 400)
    assert out.groupBy("_range").count().agg(F.max("count")).first()[0] <= 400
    got = R.before(df, ["k"], ["v"], {"n": F.lit(1), "s": F.col("v")}, {"all": F.lit(1)}, 400).orderBy("k", "v").collect()
    for k, own in (("a", sorted(v)), ("b", sorted(v[:50]))):
        rows = [r for r in got if r.k == k]
        assert [r.n for r in rows] == list(range(len(own))) and {r["all"] for r in rows} == {len(own)}
        assert [r.s for r in rows] == pytest.approx(np.concatenate([[0], np.cumsum(own)[:-1]]))


def test_quantiles_of_crowded_values(spark):
    v = np.random.default_rng(1).normal(size=3000) * 1e-6 + 7
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    qs = [0.0, 0.01, 0.5, 0.99, 1.0]
    assert exact_quantiles(df, {"x": qs}, range_rows=100)["x"] == pytest.approx(list(np.quantile(v, qs)), abs=1e-12)


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_auc_by_ranges_equals_auc_by_bins(spark, groups):
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2], float(rng.random() < 0.4), float(round(rng.random(), 2)), float(rng.integers(1, 4))) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, y double, p double, w double")
    want = M.auc_exact(df, "y", "p", "w", groups, with_logloss=True).orderBy("n", *groups).collect()
    got = M.auc_exact(df, "y", "p", "w", groups, with_logloss=True, binning="range").orderBy("n", *groups).collect()
    for a, b in zip(want, got):
        assert a.auc == pytest.approx(b.auc, abs=1e-12) and a.n == b.n and a.logloss == pytest.approx(b.logloss)


def test_first_rows(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, i) for i in range(1000)], "k long, i long")
    for n in (0, 1, 137, 1000, 5000):
        got = R.first_rows(df, ["k"], n, 90)
        assert sorted(r.k for r in got.collect()) == list(range(min(n, 1000)))
    assert "TakeOrdered" not in got._jdf.queryExecution().toString() and R.first_rows(df.limit(0), ["k"], 5).count() == 0
