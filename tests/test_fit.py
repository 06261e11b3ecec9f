import numpy as np
import pytest

from rankforge.operators.fit import (boundary_ranks, exact_quantiles, fit_all_features, fit_boundaries,
                                     keep_increasing, norm_stats)
from rankforge.spec import parse_ini


def ref_bounds(values, n):
    a = np.array(values, dtype=float)
    ranks = boundary_ranks(n)
    q = [np.percentile(a, r) for r in ranks]
    out = [q[0]]
    for i in range(1, len(q)):
        if q[i] > q[i - 1]:
            out.append(q[i])
    return out


def test_ranks_truncate():
    assert boundary_ranks(30)[:4] == [3, 6, 10, 13]
    assert boundary_ranks(200)[0] == 0            # n > 100 gives rank 0 (the minimum)
    assert keep_increasing([1, 1, 2, 2, 3]) == [1, 2, 3]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = list(np.round(rng.gamma(2.0, 3.0, 2000), 3)) + [0.0] * 500
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, {"x": probs}, bins=16)["x"]
    assert np.allclose(got, [np.percentile(vals, 100 * p) for p in probs], atol=1e-9)


def test_boundaries_edge_cases(spark):
    df = spark.createDataFrame([(5.0, float(i % 7 == 0) * i, float(i)) for i in range(300)],
                               "const double, zeros double, lin double")
    for n in (5, 10, 15, 20, 30, 50):
        got = fit_boundaries(df, {"const": n, "zeros": n, "lin": n})
        assert got["const"] == [5.0]                       # one boundary survives
        pdf = df.toPandas()
        assert np.allclose(got["zeros"], ref_bounds(pdf["zeros"], n))   # leading duplicates collapse
        assert np.allclose(got["lin"], ref_bounds(pdf["lin"], n))


def test_vector_pooled(spark):
    df = spark.createDataFrame([([float(i), float(i + 100)],) for i in range(50)], "v array<double>")
    got = fit_boundaries(df, {"v": 4}, vector_cols=("v",))["v"]
    pooled = [float(i) for i in range(50)] + [float(i + 100) for i in range(50)]
    assert np.allclose(got, ref_bounds(pooled, 4))


def test_norm_stats_and_all_features(spark):
    vals = [float(v) for v in range(1, 101)]
    df = spark.createDataFrame([(v, v * 2, 1.0) for v in vals], "a double, b double, label double")
    st = norm_stats(df, ["a"])["a"]
    assert np.isclose(st["min"], np.percentile(vals, 1)) and np.isclose(st["max"], np.percentile(vals, 99))
    assert np.isclose(st["mean"], np.mean(vals)) and np.isclose(st["std"], np.std(vals))
    spec = parse_ini("""
[label]
ftype = numeric
group = norm
[a]
ftype = numeric
group = norm
[b_cat]
ftype = bucketized
fname = b
boundaries = 0.0
auto_boundaries = 4
""")
    fitted, table = fit_all_features(df, spec)
    assert np.allclose(fitted["b_cat"].boundaries, ref_bounds([v * 2 for v in vals], 4))
    stats = {(r.feature, r.stat) for r in table.collect()}
    assert ("a", "std") in stats and not any(f == "label" for f, _ in stats)


def test_sections_are_fitted_by_themselves(spark):
    from rankforge.operators.fit import fit_all_features
    from rankforge.spec import Feature, FeatureSpec
    rows = [(float(i), 5.0e-8 + i * 1e-11, None if i % 2 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "x double, tiny double, gap double")
    spec = FeatureSpec([
        Feature(name="x5", ftype="bucketized", fname="x", auto_boundaries=5),
        Feature(name="x10", ftype="bucketized", fname="x", auto_boundaries=10),
        Feature(name="gap", ftype="bucketized", auto_boundaries=4, default=-1.0),
        Feature(name="tiny", ftype="numeric", group=("norm",)),
    ])
    fitted, table = fit_all_features(df, spec)
    got = {(r.feature, r.stat): r["values"] for r in table.collect()}
    assert len(got["x5", "boundaries"]) == 4 and len(got["x10", "boundaries"]) == 9
    assert got["gap", "boundaries"][0] == -1.0
    assert got["tiny", "mean"][0] == pytest.approx(sum(r[1] for r in rows) / 1000, rel=1e-12)
    assert got["tiny", "std"][0] == pytest.approx(1e-11 * (999 * 1001 / 12) ** 0.5, rel=1e-6)
