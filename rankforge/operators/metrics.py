"""Evaluation metrics as aggregations.

No metric moves raw rows into one partition: AUCs run on score histograms
(200 fixed thresholds) or on the distinct-score table split into quantile
bins (exact AUC), and every per-group metric is a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.features import count_below

EPS = 1e-7


def _w(weight) -> Column:
    return F.lit(1.0) if weight is None else F.col(weight).cast("double")


def sigmoid(z) -> Column:
    z = F.col(z) if isinstance(z, str) else z
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# ---------------------------------------------------------------- A6 / A7 losses
def logloss_terms(y, p) -> Column:
    y = F.col(y).cast("double")
    p = F.col(p).cast("double")
    return -(y * F.log(p + F.lit(EPS)) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p + F.lit(EPS)))


def weighted_logloss(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=()) -> DataFrame:
    """Σ w·ℓ ÷ row count (the batch-size reduction, not ÷ Σw)."""
    return df.groupBy(*group_cols).agg(
        (F.sum(_w(weight) * logloss_terms(y, p)) / F.count(F.lit(1))).alias("logloss"),
        F.count(F.lit(1)).alias("n"))


def logit_ce(df: DataFrame, y: str, z: str, group_cols=()) -> DataFrame:
    """Mean sigmoid cross-entropy from logits, overflow-safe form."""
    zc, yc = F.col(z).cast("double"), F.col(y).cast("double")
    term = F.greatest(zc, F.lit(0.0)) - zc * yc + F.log1p(F.exp(-F.abs(zc)))
    return df.groupBy(*group_cols).agg(F.avg(term).alias("ce"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- A8 / A11: 200-threshold curves
def thresholds(n: int = 200) -> list:
    """-eps, i/(n-1) for i = 1..n-2, 1+eps; predicted positive means p > t."""
    return [0.0 - EPS] + [(i + 1) * 1.0 / (n - 1) for i in range(n - 2)] + [1.0 + EPS]


def _keyed(df: DataFrame, group_cols):
    """Grouping keys; an ungrouped metric uses one literal key so every step
    stays an equi-join / partitioned window."""
    if group_cols:
        return df, list(group_cols)
    return df.withColumn("_g", F.lit(0)), ["_g"]


def _unkey(df: DataFrame, group_cols) -> DataFrame:
    return df if group_cols else df.drop("_g")


def threshold_cell(p: Column, n: int = 200) -> Column:
    """Number of ``thresholds(n)`` below p (NaN: all, null: none): the inner ones lie
    evenly, so the place comes from p itself, set right by one step if p * (n - 1) was
    rounded. A chain of n comparisons compiles into a method too large for the JIT."""
    if n < 3:
        return count_below(p, thresholds(n))
    x = F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
    j = F.least(F.greatest(F.ceil(x * F.lit(float(n - 1))) - 1, F.lit(0)), F.lit(n - 2))
    inner = F.when((j < n - 2) & ((j + 1) / F.lit(float(n - 1)) < x), j + 1) \
        .when((j >= 1) & (j / F.lit(float(n - 1)) >= x), j - 1).otherwise(j)
    ends = [(p > F.lit(t)).cast("bigint") for t in (0.0 - EPS, 1.0 + EPS)]
    return F.coalesce(ends[0] + inner + ends[1], F.lit(0)).cast("bigint")


def _confusion(d: DataFrame, keys: list, y: str, p: str, w: Column, n: int, extra: dict | None = None) -> DataFrame:
    """``threshold_counts`` of keyed rows, plus ``extra`` sums (name -> column) of each
    group, from one pass: a histogram over the n+1 cells cut by the thresholds (cell c = p
    above exactly c thresholds), gathered into one row per group, so that the rows are not
    read again for the empty cells."""
    yc, extra = F.col(y).cast("double"), extra or {}
    d = d.withColumn("_cell", threshold_cell(F.col(p).cast("double"), n))
    hist = d.groupBy(*keys, "_cell").agg(F.sum(w * yc).alias("pos"), F.sum(w * (F.lit(1.0) - yc)).alias("neg"),
                                         *(F.sum(c).alias(name) for name, c in extra.items()))
    cells = F.map_from_entries(F.collect_list(F.struct("_cell", F.struct("pos", "neg"))))
    dense = hist.groupBy(*keys).agg(cells.alias("_m"), *(F.sum(name).alias(name) for name in extra)) \
        .withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n).cast("bigint"))))
    zero = F.lit(0.0)
    h = dense.withColumns({c: F.coalesce(F.nanvl(F.col("_m")[F.col("cell")][c], zero), zero) for c in ("pos", "neg")}).drop("_m")
    wsuf = (Window.partitionBy(*keys).orderBy(F.col("cell").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wall = Window.partitionBy(*keys)
    out = (h.withColumn("tp", F.sum("pos").over(wsuf)).withColumn("fp", F.sum("neg").over(wsuf))
           .withColumn("P", F.sum("pos").over(wall)).withColumn("N", F.sum("neg").over(wall))
           .where(F.col("cell") >= 1))
    return out.select(*keys, *extra, (F.col("cell") - 1).alias("i"), "tp", "fp",
                      (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"))


def threshold_counts(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=(),
                     n: int = 200) -> DataFrame:
    """Per group and threshold index i: tp, fp, tn, fn masses for ``p > t_i``: suffix
    sums over the n+1 cells of a histogram."""
    d, keys = _keyed(df, group_cols)
    return _unkey(_confusion(d, keys, y, p, _w(weight), n), group_cols)


def _area_term(keys: list, curve: str, method: str) -> Column:
    """What threshold i adds to the area, from tp, fp, tn, fn by threshold."""
    e = F.lit(EPS)
    win = Window.partitionBy(*keys).orderBy("i")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rec = (tp + e) / (tp + fn + e)
    if curve == "PR" and method == "careful_interpolation":
        tp1, fn1, pp, pp1 = F.lead("tp").over(win), F.lead("fn").over(win), tp + fp, F.lead(tp + fp).over(win)
        slope = F.when(pp - pp1 > 0, (tp - tp1) / (pp - pp1)).otherwise(F.lit(0.0))
        ratio = F.when((pp > 0) & (pp1 > 0), pp / pp1).otherwise(F.lit(1.0))
        den = tp1 + fn1
        return F.when(den > 0, slope * (tp - tp1 + (tp1 - slope * pp1) * F.log(ratio)) / den).otherwise(F.lit(0.0))
    x, yv = (fp / (fp + F.col("tn") + e), rec) if curve == "ROC" else (rec, (tp + e) / (tp + fp + e))
    return (x - F.lead(x).over(win)) * (yv + F.lead(yv).over(win)) / F.lit(2.0)


def auc_200(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=(),
            curve: str = "ROC", method: str = "trapezoidal", n: int = 200) -> DataFrame:
    """Threshold AUC (ROC or PR), trapezoid or careful interpolation (PR)."""
    d, keys = _keyed(df, group_cols)
    c = _confusion(d, keys, y, p, _w(weight), n)
    return c.withColumn("term", _area_term(keys, curve, method)).groupBy(*group_cols).agg(F.sum("term").alias("auc"))


# ---------------------------------------------------------------- A8b exact AUC
def _quantile_bounds(scores: DataFrame, col: str, bins: int) -> list:
    """Approximate quantiles of the distinct scores: a bounded summary
    (``bins - 1`` doubles) brought to the driver to cut the score axis."""
    probs = [i / bins for i in range(1, bins)]
    row = scores.agg(F.percentile_approx(col, probs, 10000).alias("q")).first()
    q = row["q"] if row and row["q"] else []
    return sorted(set(float(v) for v in q if v is not None))


def logit_bin(score, per_unit: int = 64, clamp: float = 20.0):
    """Monotone, statistics-free bin of a score: floor(logit(p)·k) with the
    logit clamped to ±``clamp``; p ≤ 0 → bottom bin, p ≥ 1 (and NaN, which
    Spark orders last) → top bin. Fine where probabilities concentrate."""
    x = F.col(score) if isinstance(score, str) else score
    lo, hi = -clamp * per_unit, clamp * per_unit
    lg = F.log(x / (F.lit(1.0) - x))
    b = F.floor(F.least(F.greatest(lg, F.lit(-clamp)), F.lit(clamp)) * F.lit(float(per_unit)))
    return (F.when(x <= 0, F.lit(lo)).when(x >= 1, F.lit(hi)).when(F.isnan(x), F.lit(hi))
            .otherwise(b)).cast("bigint")


def auc_exact(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=(),
              bins: int = 256, with_logloss: bool = False, binning: str = "logit") -> DataFrame:
    """Rank AUC with half credit for ties: Σ_pos w·(neg mass below + ½ neg
    mass at the same score) ÷ (P·N). Null when a group lacks a class.

    Scale plan: (1) aggregate to distinct (group, score) rows; (2) cut the
    score axis into monotone bins — fixed logit bins (no extra pass over the
    data) or, with ``binning="quantile"``, approximate quantiles of the
    distinct scores (one extra job) — so a (group, bin) window partition
    holds a share of a group's distinct scores even if one group dominates;
    (3) a tiny per-bin table gives the mass below each bin; (4) a window
    inside each (group, bin) adds the mass below within the bin.
    With ``binning="range"`` (2)-(4) are running sums over ranges of bounded size
    (``operators.ranges``), for scores that crowd in few bins; this runs at once.
    ``with_logloss`` also returns ``n`` and the weighted log-loss (÷ rows)
    from the same distinct-score aggregate — one pass over the scores."""
    w = _w(weight)
    yc = F.col(y).cast("double")
    extra = [F.count(F.lit(1)).alias("cnt"), F.sum(w * logloss_terms(y, p)).alias("ll")] if with_logloss else []
    sc = F.col(p).cast("double")
    if binning == "range":
        from rankforge.operators.ranges import before
        keys = list(group_cols)
        s = df.groupBy(*keys, sc.alias("_s")).agg(F.sum(w * yc).alias("pos"), F.sum(w * (F.lit(1.0) - yc)).alias("neg"), *extra)
        s = s if keys else s.withColumn("_all", F.lit(1))
        t = before(s, keys or ["_all"], ["_s"], {"below": F.col("neg")}, {"P": F.col("pos"), "N": F.col("neg")})
        out = [F.when(F.first("P") * F.first("N") > 0, F.sum(F.col("pos") * (F.col("below") + F.lit(0.5) * F.col("neg")))
                      / (F.first("P") * F.first("N"))).alias("auc")]
        if with_logloss:
            out += [F.sum("cnt").alias("n"), (F.sum("ll") / F.sum("cnt")).alias("logloss")]
        return t.groupBy(*keys).agg(*out)
    if binning == "quantile":
        base = df.groupBy(*group_cols, sc.alias("_s")).agg(
            F.sum(w * yc).alias("pos"), F.sum(w * (F.lit(1.0) - yc)).alias("neg"), *extra)
        bounds = _quantile_bounds(base, "_s", bins)
        s = base.withColumn("_bin", count_below(F.col("_s"), bounds, strict=False))
    else:
        # the bin is a function of the score, so it joins the grouping keys and
        # the later (group, bin) windows reuse this aggregate's partitioning
        s = df.groupBy(*group_cols, logit_bin(sc).alias("_bin"), sc.alias("_s")).agg(
            F.sum(w * yc).alias("pos"), F.sum(w * (F.lit(1.0) - yc)).alias("neg"), *extra)
    keys = list(group_cols)
    per_bin = s.groupBy(*keys, "_bin").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    wb = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*keys)
    per_bin = (per_bin.withColumn("neg_before", F.coalesce(F.sum("bneg").over(wb), F.lit(0.0)))
               .withColumn("P", F.sum("bpos").over(wg)).withColumn("N", F.sum("bneg").over(wg))
               .select(*keys, "_bin", "neg_before", "P", "N"))
    if not keys:
        per_bin = F.broadcast(per_bin)  # at most 2·20·64 + 1 bins
    ws = Window.partitionBy(*keys, "_bin").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    t = (s.join(per_bin, keys + ["_bin"])
         .withColumn("below", F.col("neg_before") + F.coalesce(F.sum("neg").over(ws), F.lit(0.0))))
    contrib = F.col("pos") * (F.col("below") + F.lit(0.5) * F.col("neg"))
    out = [F.when(F.first("P") * F.first("N") > 0, F.sum(contrib) / (F.first("P") * F.first("N"))).alias("auc")]
    if with_logloss:
        out += [F.sum("cnt").alias("n"), (F.sum("ll") / F.sum("cnt")).alias("logloss")]
    return t.groupBy(*keys).agg(*out)


def auc_per_task(df: DataFrame, tasks: dict, weight: str | None = None, group_cols=(),
                 exact: bool = True, weighted=None) -> DataFrame:
    """tasks = {name: (label_col, score_col, row_filter Column|None)};
    unpivot to (task, y, p, w), in the one pass that scores the rows, then one grouped
    AUC. Sample weights apply to the
    tasks in ``weighted`` (None: to all)."""
    parts = []
    for name, (yc, pc, cond) in tasks.items():
        one = F.struct(F.lit(name).alias("task"), F.col(yc).cast("double").alias("_y"), F.col(pc).cast("double").alias("_p"),
                       (_w(weight) if weighted is None or name in weighted else F.lit(1.0)).alias("_w"))
        parts.append(one if cond is None else F.when(cond, one))
    u = df.select(*group_cols, F.inline(F.array_compact(F.array(*parts))))
    g = list(group_cols) + ["task"]
    if exact:
        return auc_exact(u, "_y", "_p", "_w", g)
    return auc_200(u, "_y", "_p", "_w", g)


# ---------------------------------------------------------------- A9 / A10 / A12
def precision_recall(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=(),
                     threshold: float = 0.5) -> DataFrame:
    w = _w(weight)
    yc = F.col(y).cast("double")
    pred = (F.col(p) > F.lit(threshold)).cast("double")
    tp = F.sum(w * yc * pred)
    return df.groupBy(*group_cols).agg(
        F.when(F.sum(w * pred) > 0, tp / F.sum(w * pred)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.sum(w * yc) > 0, tp / F.sum(w * yc)).otherwise(F.lit(0.0)).alias("recall"),
        (F.sum(w * (pred == yc).cast("double")) / F.sum(w)).alias("accuracy"))


EVAL_METRICS = ("accuracy", "accuracy_baseline", "auc", "auc_precision_recall", "average_loss",
                "label_mean", "precision", "prediction_mean", "recall")


def eval_report(df: DataFrame, y: str, p: str, weight: str | None = None, group_cols=(),
                long: bool = True) -> DataFrame:
    """The canned binary-classifier report from one pass; ``long`` → (metric, value)
    rows sorted by metric name."""
    w = _w(weight)
    yc = F.col(y).cast("double")
    d, keys = _keyed(df, group_cols)
    pred = (F.col(p) > F.lit(0.5)).cast("double")
    c = _confusion(d, keys, y, p, w, 200, {"_w0": w, "_wy": w * yc, "_wp": w * F.col(p), "_ll": w * logloss_terms(y, p), "_hit": w * yc * pred,
                                           "_pos": w * pred, "_ok": w * (pred == yc).cast("double")})
    c = c.withColumn("_roc", _area_term(keys, "ROC", "trapezoidal")).withColumn("_prc", _area_term(keys, "PR", "careful_interpolation"))
    r = c.groupBy(*keys).agg(F.sum("_roc").alias("auc"), F.sum("_prc").alias("auc_precision_recall"),
                             *(F.first(x).alias(x) for x in ("_w0", "_wy", "_wp", "_ll", "_hit", "_pos", "_ok")))

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    r = r.withColumns({"label_mean": F.col("_wy") / F.col("_w0"), "prediction_mean": F.col("_wp") / F.col("_w0"),
                       "average_loss": F.col("_ll") / F.col("_w0"), "precision": ratio("_hit", "_pos"),
                       "recall": ratio("_hit", "_wy"), "accuracy": F.col("_ok") / F.col("_w0")})
    keys = list(group_cols)
    r = r.withColumn("accuracy_baseline", F.greatest(F.col("label_mean"), F.lit(1.0) - F.col("label_mean")))
    if not long:
        return r.select(*keys, *EVAL_METRICS)
    stack = "stack({}, {}) as (metric, value)".format(
        len(EVAL_METRICS), ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in EVAL_METRICS))
    return r.selectExpr(*keys, stack)


def pred_histogram(df: DataFrame, p: str, bins: int = 20, group_cols=()) -> DataFrame:
    b = F.least(F.floor(F.col(p) * F.lit(bins)), F.lit(bins - 1)).cast("bigint")
    return df.groupBy(*group_cols, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def l2_penalty(weights: DataFrame, lam: float, value_col: str = "w", group_cols=("field",)) -> DataFrame:
    """λ·Σw²/2 per table (vectors: Σ over elements)."""
    v = F.col(value_col)
    sq = (F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) if dict(weights.dtypes)[value_col].startswith("array")
          else v * v)
    return weights.groupBy(*group_cols).agg((F.sum(sq) * F.lit(lam / 2.0)).alias("l2"))


def metrics_long(report: DataFrame, name_col: str = "metric", value_col: str = "value",
                 type_: str = "float") -> DataFrame:
    """``{name, type, value}`` rows with the value as a string."""
    return report.select(F.col(name_col).alias("name"), F.lit(type_).alias("type"),
                         F.col(value_col).cast("string").alias("value"))
