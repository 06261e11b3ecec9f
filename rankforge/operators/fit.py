"""Fitting passes: quantile bucket boundaries (A1/A2), normalisation stats
(A3) and the all-feature pass (A4) — one job for all features, not one scan
per feature.

Exact quantiles do not use Spark's ``percentile`` aggregate (it holds every
distinct value of a column in one buffer). Instead: a distributed
(feature, value) → count table is range-partitioned into ranges of bounded
size, and running counts over ranges and inside each range locate the values
at the wanted ranks; linear interpolation (numpy's default) is done on
the handful of selected values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.features import count_below, numeric, vector
from rankforge.operators.ranges import RANGE_ROWS, before
from rankforge.session import cut_lineage
from rankforge.spec import FeatureSpec


def boundary_ranks(n: int) -> list:
    """Percentile ranks for ``n`` buckets: int(100/n), int(100*i/n) for
    i = 2..n-1 (integer truncation, as the fitted specs were produced)."""
    return [int(100 * i / n) for i in range(1, n)]


def keep_increasing(values: list) -> list:
    """First value always kept; a later one only if it exceeds the value at
    the previous rank (not the previous kept value)."""
    out = []
    for i, v in enumerate(values):
        if i == 0 or v > values[i - 1]:
            out.append(v)
    return out


def parsed_values(f) -> Column:
    """The numbers of a spec section, with its default (0 if it has none) in gaps."""
    d = 0.0 if f.default is None else float(f.default)
    return vector(F.col(f.source), f.shape, d) if f.shape > 1 else numeric(F.col(f.source), d)


def _long_values(df: DataFrame, cols, vector_cols=()) -> DataFrame:
    parts = [F.array(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))) for c in cols]
    def tag(name):
        return lambda x: F.struct(F.lit(name).alias("feature"), x.cast("double").alias("value"))
    parts += [F.transform(F.col(c), tag(c)) for c in vector_cols]
    return df.select(F.inline(F.concat(*parts))).where(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(df: DataFrame, probs: dict, vector_cols=(), bins: int | None = None, range_rows: int = RANGE_ROWS) -> dict:
    """``probs`` = {column: [q in 0..1]} → {column: [value]} with linear
    interpolation between order statistics. Vector columns are pooled over
    all elements. The distinct values are cut into ranges of at most
    ``range_rows``, or into at least ``bins`` ranges if that is given."""
    return quantiles_and_moments(df, probs, vector_cols, bins, range_rows)[0]


def quantiles_and_moments(df: DataFrame, probs: dict, vector_cols=(), bins: int | None = None, range_rows: int = RANGE_ROWS):
    """One pass over ``df``: exact quantiles for every column in ``probs`` and
    (mean, population std) per column, both from the distributed
    (feature, value) → count table (moments from sums of doubles, the spread
    in a second pass around the mean)."""
    from rankforge.session import ensure_defaults
    ensure_defaults(df.sparkSession)
    scalar = [c for c in probs if c not in vector_cols]
    vc = _long_values(df, scalar, [c for c in vector_cols if c in probs]) \
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    vc = cut_lineage(vc)
    if bins:
        range_rows = max(1, -(-vc.count() // bins))
    stats = vc.groupBy("feature").agg(F.sum("cnt").alias("n"), F.sum(F.col("value") * F.col("cnt")).alias("sx")).collect()
    info = {r.feature: int(r.n) for r in stats}
    means = {r.feature: (r.sx / r.n) for r in stats}
    var = {}
    if means:
        mexpr = None
        for c, m in means.items():
            cond = F.col("feature") == F.lit(c)
            lit = F.lit(float(m))
            mexpr = F.when(cond, lit) if mexpr is None else mexpr.when(cond, lit)
        dev = F.col("value") - mexpr
        for r in vc.groupBy("feature").agg(F.sum(dev * dev * F.col("cnt")).alias("ss")).collect():
            var[r.feature] = r.ss / info[r.feature]
    moments = {c: (float(means[c]), float(var.get(c, 0.0)) ** 0.5) for c in means}
    targets, plan = {}, {}
    for c, qs in probs.items():
        if c not in info:
            continue
        n = info[c]
        plan[c] = []
        for q in qs:
            rk = q * (n - 1)
            k1 = int(math.floor(rk))
            k2 = min(k1 + 1, n - 1)
            plan[c].append((k1, k2, rk - k1))
            targets.setdefault(c, set()).update((k1, k2))
    if not targets:
        return {c: [] for c in probs}, moments
    tgt_expr = None
    for c in targets:
        t = F.array(*[F.lit(k) for k in sorted(targets[c])]).cast("array<bigint>")
        cond = F.col("feature") == F.lit(c)
        tgt_expr = F.when(cond, t) if tgt_expr is None else tgt_expr.when(cond, t)
    ranked = before(vc.where(F.col("feature").isin(list(targets))), ["feature"], ["value"], {"lo": F.col("cnt")}, range_rows=range_rows)
    hits = ranked.select("feature", "value", F.explode(F.filter(
        tgt_expr, lambda k: (k >= F.col("lo")) & (k < F.col("lo") + F.col("cnt")))).alias("k")).collect()
    at = {(h.feature, int(h.k)): float(h.value) for h in hits}
    out = {}
    for c, qs in probs.items():
        out[c] = [at[(c, k1)] + f * (at[(c, k2)] - at[(c, k1)]) for k1, k2, f in plan.get(c, [])]
    return out, moments


def approx_quantiles(df: DataFrame, probs: dict, vector_cols=(), accuracy: int = 10000) -> dict:
    """A2: one aggregate of ``percentile_approx`` over the full data (rank
    error ≤ n/accuracy) instead of fitting on one shuffled batch."""
    scalar = [c for c in probs if c not in vector_cols]
    res = {}
    if scalar:
        row = df.agg(*[F.percentile_approx(c, list(probs[c]), accuracy).alias(c) for c in scalar]).first()
        res.update({c: [float(x) for x in row[c]] for c in scalar})
    for c in probs:
        if c in vector_cols:
            row = df.select(F.explode(c).alias(c)).agg(F.percentile_approx(c, list(probs[c]), accuracy).alias(c)).first()
            res[c] = [float(x) for x in row[c]]
    return res


def fit_boundaries(df: DataFrame, auto: dict, vector_cols=(), method: str = "exact") -> dict:
    """A1: ``auto`` = {column: n buckets} → {column: boundaries}."""
    return _fit_pass(df, auto, [], tuple(vector_cols), method)[0]


def norm_stats(df: DataFrame, cols, vector_cols=(), method: str = "exact") -> dict:
    """A3: p1 as min, p99 as max, mean, population std."""
    return _fit_pass(df, {}, list(cols), tuple(vector_cols), method)[1]


def _fit_pass(df: DataFrame, auto: dict, norm_cols, vector_cols=(), method: str = "exact"):
    """Boundaries for ``auto`` = {column: n} and stats for ``norm_cols`` from
    ONE pass over the data (exact) or one aggregate (approximate)."""
    probs: dict = {}
    for c, n in auto.items():
        if n > 1:
            probs.setdefault(c, [])
            probs[c] += [rk / 100.0 for rk in boundary_ranks(n)]
    for c in norm_cols:
        probs.setdefault(c, [])
        probs[c] += [0.01, 0.99]
    if method == "exact":
        q, mom = quantiles_and_moments(df, probs, vector_cols)
    else:
        q = approx_quantiles(df, probs, vector_cols)
        mom = {}
        for c in norm_cols:
            src = df.select(F.explode(c).alias("x")) if c in vector_cols else df.select(F.col(c).alias("x"))
            row = src.agg(F.avg(F.col("x").cast("double")).alias("m"),
                          F.stddev_pop("x").alias("s")).first()
            mom[c] = (row.m, row.s)
    bnd = {}
    for c, n in auto.items():
        if n > 1:
            k = len(boundary_ranks(n))
            bnd[c] = keep_increasing(q[c][:k])
    st = {}
    for c in norm_cols:
        lo, hi = q[c][-2], q[c][-1]
        st[c] = {"min": lo, "max": hi, "mean": mom[c][0], "std": mom[c][1]}
    return bnd, st


def fit_all_features(df: DataFrame, spec: FeatureSpec, method: str = "exact", label_cols=("label",)):
    """A4: boundaries for every feature with ``auto_boundaries > 0`` and stats
    for numeric features in a ``norm`` group (labels excluded). Returns the
    fitted spec and the fitted-spec table ``(feature, stat, values)`` (S9).
    Each section is fitted by itself, on the values it would parse: its default
    stands where the field is null."""
    auto = {f.name: f.auto_boundaries for f in spec if f.auto_boundaries > 0}
    norm = [f for f in spec if "norm" in f.group and f.ftype == "numeric" and f.name not in label_cols]
    used = [f for f in spec if f.name in auto or f in norm]
    df = df.select(*(parsed_values(f).alias(f.name) for f in used)) if used else df
    vec = {f.name for f in used if f.shape > 1}
    by_name_b, by_name_s = _fit_pass(df, auto, sorted(f.name for f in norm), tuple(vec), method)
    fitted = spec.with_fitted(by_name_b, by_name_s)
    rows = [(n, "boundaries", [float(x) for x in b]) for n, b in by_name_b.items()]
    rows += [(n, k, [float(v)]) for n, s in by_name_s.items() for k, v in sorted(s.items())]
    table = df.sparkSession.createDataFrame(rows, "feature string, stat string, values array<double>")
    return fitted, table
