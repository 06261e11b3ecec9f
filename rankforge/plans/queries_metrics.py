"""Metric queries (A6-A12, S8) on the wide-model scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import metrics as M
from rankforge.plans.catalog import query, with_ctes
from rankforge.plans.queries_core import LR_SCORED_SQL, _li_scored, lr_scored_sql, r
from rankforge.operators.metrics import thresholds


def _scored_ctcvr(spark, sf):
    from rankforge.operators.scoring import score_lr
    from rankforge.plans.demo import li_spec, samples_li
    return score_lr(samples_li(spark, sf), li_spec(), keep=("ds", "y_ctr", "y_ctcvr", "wt", "z_type"),
                    logit_digits=9)


SC = LR_SCORED_SQL
THR = "[" + ", ".join(repr(t) for t in thresholds()) + "]"
CONF_SQL = f"""thr AS (SELECT unnest(range(0, 200)) AS i, unnest({THR}) AS t),
    conf AS (SELECT thr.i, sum(CASE WHEN p > t THEN wt * y_ctr ELSE 0 END) AS tp,
                    sum(CASE WHEN p > t THEN wt * (1 - y_ctr) ELSE 0 END) AS fp,
                    sum(CASE WHEN p > t THEN 0 ELSE wt * (1 - y_ctr) END) AS tn,
                    sum(CASE WHEN p > t THEN 0 ELSE wt * y_ctr END) AS fn
             FROM scored_p, thr GROUP BY thr.i)"""


@query("weighted_logloss", sql=with_ctes(*SC, body="""
SELECT count(*) AS n, round(sum(wt * -(y_ctr * ln(p + 1e-7) + (1 - y_ctr) * ln(1 - p + 1e-7))) / count(*), 6) AS logloss
FROM scored_p"""))
def q_weighted_logloss(spark, sf):
    s = _li_scored(spark, sf)
    return M.weighted_logloss(s, "y_ctr", "p", "wt").select("n", r(F.col("logloss"), "logloss"))


@query("logit_ce", sql=with_ctes(*SC, body="""
SELECT count(*) AS n, round(avg(greatest(logit, 0) - logit * y_ctr + ln(1 + exp(-abs(logit)))), 6) AS ce FROM scored_p"""))
def q_logit_ce(spark, sf):
    s = _li_scored(spark, sf)
    return M.logit_ce(s, "y_ctr", "logit").select("n", r(F.col("ce"), "ce"))


@query("auc_200", sql=with_ctes(*SC, CONF_SQL, """
    roc AS (SELECT i, fp / (fp + tn + 1e-7) AS x, (tp + 1e-7) / (tp + fn + 1e-7) AS y FROM conf)""", body="""
SELECT round(sum((x - nx) * (y + ny) / 2), 6) AS auc FROM (
  SELECT x, y, lead(x) OVER (ORDER BY i) AS nx, lead(y) OVER (ORDER BY i) AS ny FROM roc) WHERE nx IS NOT NULL"""))
def q_auc_200(spark, sf):
    """ROC AUC over 200 fixed thresholds, trapezoid rule, weighted."""
    s = _li_scored(spark, sf)
    return M.auc_200(s, "y_ctr", "p", "wt").select(r(F.col("auc"), "auc"))


@query("pr_auc", sql=with_ctes(*SC, CONF_SQL, """
    c AS (SELECT i, tp, fp, fn, tp + fp AS pp, lead(tp) OVER (ORDER BY i) AS tp1,
                 lead(tp + fp) OVER (ORDER BY i) AS pp1, lead(fn) OVER (ORDER BY i) AS fn1 FROM conf),
    t AS (SELECT *, CASE WHEN pp - pp1 > 0 THEN (tp - tp1) / (pp - pp1) ELSE 0 END AS slope FROM c WHERE tp1 IS NOT NULL)""",
    body="""
SELECT round(sum(CASE WHEN tp1 + fn1 > 0 THEN slope * ((tp - tp1) + (tp1 - slope * pp1) *
        ln(CASE WHEN pp > 0 AND pp1 > 0 THEN pp / pp1 ELSE 1 END)) / (tp1 + fn1) ELSE 0 END), 6) AS auc FROM t"""))
def q_pr_auc(spark, sf):
    """PR AUC, careful interpolation between the 200 threshold points."""
    s = _li_scored(spark, sf)
    return M.auc_200(s, "y_ctr", "p", "wt", curve="PR", method="careful_interpolation").select(r(F.col("auc"), "auc"))


def _auc_sql(group: str, src: str, y: str = "y_ctr", p: str = "p", w: str = "wt") -> str:
    return f"""agg AS (SELECT {group}, {p} AS s, sum({w} * {y}) AS pos, sum({w} * (1 - {y})) AS neg FROM {src} GROUP BY {group}, {p}),
    cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM agg)"""


AUC_BODY = """SELECT {g}, round(CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 6) AS auc
FROM cum GROUP BY {g}"""


@query("auc_exact", sql=with_ctes(*SC, "s2 AS (SELECT *, 1 AS g0 FROM scored_p)", _auc_sql("g0", "s2"),
                                  body="SELECT round(CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 6) AS auc FROM cum"))
def q_auc_exact(spark, sf):
    """Exact weighted rank AUC with tie half-credit, no single-partition window."""
    s = _li_scored(spark, sf)
    return M.auc_exact(s, "y_ctr", "p", "wt").select(r(F.col("auc"), "auc"))


_PT_SRC = """u AS (SELECT 'ctr' AS task, y_ctr AS y, p, wt FROM scored_p
             UNION ALL SELECT 'ctcvr', y_ctcvr, p, wt FROM scored_p
             UNION ALL SELECT 'cvr', y_ctcvr, p, wt FROM scored_p WHERE y_ctr = 1)"""
_PT_SRC_CTR = _PT_SRC.replace("y_ctcvr, p, wt", "y_ctcvr, p, 1.0")  # weights on the click task only


@query("auc_per_task", sql=with_ctes(*lr_scored_sql(("y_ctr", "y_ctcvr")), _PT_SRC, _auc_sql("task", "u", "y", "p", "wt"),
                                     body=AUC_BODY.format(g="task")))
def q_auc_per_task(spark, sf):
    """ctr and ctcvr AUC on all rows, cvr AUC on clicked rows only."""
    s = _scored_ctcvr(spark, sf)
    tasks = {"ctr": ("y_ctr", "p", None), "ctcvr": ("y_ctcvr", "p", None),
             "cvr": ("y_ctcvr", "p", F.col("y_ctr") == 1)}
    return M.auc_per_task(s, tasks, "wt").select("task", r(F.col("auc"), "auc"))


@query("auc_per_task_weighted", sql=with_ctes(*lr_scored_sql(("y_ctr", "y_ctcvr")), _PT_SRC_CTR, _auc_sql("task", "u", "y", "p", "wt"),
                                              body=AUC_BODY.format(g="task")))
def q_auc_per_task_weighted(spark, sf):
    """As ``auc_per_task``, with sample weights on the click task only."""
    s = _scored_ctcvr(spark, sf)
    tasks = {"ctr": ("y_ctr", "p", None), "ctcvr": ("y_ctcvr", "p", None), "cvr": ("y_ctcvr", "p", F.col("y_ctr") == 1)}
    return M.auc_per_task(s, tasks, "wt", weighted=("ctr",)).select("task", r(F.col("auc"), "auc"))


@query("precision_recall", sql=with_ctes(*SC, body="""
SELECT round(CASE WHEN sum(wt * (p > 0.5)::DOUBLE) > 0 THEN sum(wt * y_ctr * (p > 0.5)::DOUBLE) / sum(wt * (p > 0.5)::DOUBLE) ELSE 0 END, 6) AS precision,
       round(CASE WHEN sum(wt * y_ctr) > 0 THEN sum(wt * y_ctr * (p > 0.5)::DOUBLE) / sum(wt * y_ctr) ELSE 0 END, 6) AS recall,
       round(sum(wt * (((p > 0.5)::DOUBLE) = y_ctr)::DOUBLE) / sum(wt), 6) AS accuracy
FROM scored_p"""))
def q_precision_recall(spark, sf):
    s = _li_scored(spark, sf)
    m = M.precision_recall(s, "y_ctr", "p", "wt")
    return m.select(*[r(F.col(c), c) for c in ("precision", "recall", "accuracy")])


def _eval_sql():
    return with_ctes(*SC, CONF_SQL, """
    roc AS (SELECT i, fp / (fp + tn + 1e-7) AS x, (tp + 1e-7) / (tp + fn + 1e-7) AS y FROM conf),
    roc_auc AS (SELECT sum((x - nx) * (y + ny) / 2) AS v FROM (
        SELECT x, y, lead(x) OVER (ORDER BY i) AS nx, lead(y) OVER (ORDER BY i) AS ny FROM roc) WHERE nx IS NOT NULL),
    c AS (SELECT i, tp, fp, fn, tp + fp AS pp, lead(tp) OVER (ORDER BY i) AS tp1,
                 lead(tp + fp) OVER (ORDER BY i) AS pp1, lead(fn) OVER (ORDER BY i) AS fn1 FROM conf),
    t AS (SELECT *, CASE WHEN pp - pp1 > 0 THEN (tp - tp1) / (pp - pp1) ELSE 0 END AS slope FROM c WHERE tp1 IS NOT NULL),
    pr_auc AS (SELECT sum(CASE WHEN tp1 + fn1 > 0 THEN slope * ((tp - tp1) + (tp1 - slope * pp1) *
        ln(CASE WHEN pp > 0 AND pp1 > 0 THEN pp / pp1 ELSE 1 END)) / (tp1 + fn1) ELSE 0 END) AS v FROM t),
    base AS (SELECT sum(wt * y_ctr) / sum(wt) AS label_mean, sum(wt * p) / sum(wt) AS prediction_mean,
        sum(wt * -(y_ctr * ln(p + 1e-7) + (1 - y_ctr) * ln(1 - p + 1e-7))) / sum(wt) AS average_loss,
        CASE WHEN sum(wt * (p > 0.5)::DOUBLE) > 0 THEN sum(wt * y_ctr * (p > 0.5)::DOUBLE) / sum(wt * (p > 0.5)::DOUBLE) ELSE 0 END AS precision,
        CASE WHEN sum(wt * y_ctr) > 0 THEN sum(wt * y_ctr * (p > 0.5)::DOUBLE) / sum(wt * y_ctr) ELSE 0 END AS recall,
        sum(wt * (((p > 0.5)::DOUBLE) = y_ctr)::DOUBLE) / sum(wt) AS accuracy FROM scored_p)""", body="""
SELECT unnest(['accuracy', 'accuracy_baseline', 'auc', 'auc_precision_recall', 'average_loss', 'label_mean',
               'precision', 'prediction_mean', 'recall']) AS metric,
       round(unnest([accuracy, greatest(label_mean, 1 - label_mean), roc_auc.v, pr_auc.v, average_loss, label_mean,
               precision, prediction_mean, recall]), 6) AS value
FROM base, roc_auc, pr_auc""")


@query("eval_report", sql=_eval_sql())
def q_eval_report(spark, sf):
    """The canned report as (metric, value) rows in name order."""
    s = _li_scored(spark, sf)
    rep = M.eval_report(s, "y_ctr", "p", "wt")
    return rep.select("metric", r(F.col("value"), "value")).orderBy("metric")


@query("metrics_long", sql=with_ctes(*SC, body="""
SELECT 'logloss' AS name, 'float' AS type,
       printf('%.6f', sum(wt * -(y_ctr * ln(p + 1e-7) + (1 - y_ctr) * ln(1 - p + 1e-7))) / count(*)) AS value FROM scored_p
UNION ALL
SELECT 'rows', 'int', CAST(count(*) AS VARCHAR) FROM scored_p"""))
def q_metrics_long(spark, sf):
    """Metrics sink layout: {name, type, value-as-string}."""
    s = _li_scored(spark, sf)
    ll = M.weighted_logloss(s, "y_ctr", "p", "wt")
    a = ll.select(F.lit("logloss").alias("name"), F.lit("float").alias("type"),
                  F.format_string("%.6f", "logloss").alias("value"))
    b = ll.select(F.lit("rows").alias("name"), F.lit("int").alias("type"), F.col("n").cast("string").alias("value"))
    return a.unionByName(b)


@query("pred_histogram", sql=with_ctes(*SC, body="""
SELECT CAST(least(floor(p * 20), 19) AS BIGINT) AS bin, count(*) AS n FROM scored_p GROUP BY 1"""))
def q_pred_histogram(spark, sf):
    return M.pred_histogram(_li_scored(spark, sf), "p", 20)
