"""Property tests: Spark operators against independent pure-Python references."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rankforge.functions import features as X
from rankforge.operators import metrics as M
from rankforge.operators.lookup import fits_broadcast

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(bounds=st.lists(finite, min_size=1, max_size=12, unique=True), xs=st.lists(finite, min_size=1, max_size=30))
def test_bucketize_is_searchsorted_right(spark, bounds, xs):
    b = sorted(bounds)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(X.bucketize("x", b)).collect()]
    assert got == [int(np.searchsorted(b, x, side="right")) for x in xs]
    below = [r[0] for r in df.select(X.count_below("x", b)).collect()]
    assert below == [int(np.searchsorted(b, x, side="left")) for x in xs]


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20), st.integers(1, 3)), min_size=2, max_size=60))
def test_exact_auc_matches_pairwise(spark, data):
    y = [float(a) for a, _, _ in data]
    p = [b / 20.0 for _, b, _ in data]
    w = [float(c) for _, _, c in data]
    df = spark.createDataFrame(list(zip(y, p, w)), "y double, p double, w double")
    got = M.auc_exact(df, "y", "p", "w").first()["auc"]
    pos = sum(wi for yi, wi in zip(y, w) if yi == 1)
    neg = sum(wi for yi, wi in zip(y, w) if yi == 0)
    if pos * neg == 0:
        assert got is None
        return
    num = sum(wi * wj * (1.0 if pj < pi else 0.5 if pj == pi else 0.0)
              for yi, pi, wi in zip(y, p, w) if yi == 1 for yj, pj, wj in zip(y, p, w) if yj == 0)
    assert abs(got - num / (pos * neg)) < 1e-12


def test_broadcast_bound_checks_total():
    small = [("a", 0, 1000, False)] * 3
    assert fits_broadcast(small, dim=8)
    assert not fits_broadcast([("h", 0, 5_000_000, False)], dim=48)          # one large hashed table
    many = [(f"f{i}", i, 400_000, False) for i in range(20)]                  # each fits, together too big
    assert not fits_broadcast(many, dim=8)
    assert not fits_broadcast([("l", 0, 10, True)])                           # list fields go long
