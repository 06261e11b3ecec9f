"""Core queries: the wide-model slice (features → weights → score → metrics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators.metrics import auc_exact
from rankforge.operators.scoring import score_lr
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_LI_SQL, li_spec, samples_li

R = 6  # decimals kept in floating outputs (summation order differs between engines)


def r(c, name):
    return rnd(c, name)


def _li_scored(spark, sf):
    spec = li_spec()
    return score_lr(samples_li(spark, sf), spec, keep=("ds", "y_ctr", "wt"), logit_digits=9)


def li_feats_sql(keep=("sample_id", "ds", "y_ctr", "y_ctcvr", "wt", "uid", "touid")):
    return [SAMPLES_LI_SQL] + Q.feature_ctes(li_spec(), "samples_li", keep)


def lr_scored_sql(labels=("y_ctr",)):
    """CTEs ending in ``scored_p`` (rid, sample_id, ds, labels..., wt, logit, p)."""
    keep = ("ds", *labels, "wt")
    carried = ", ".join(f"any_value({k}) AS {k}" for k in keep)
    return li_feats_sql() + [
        Q.long_ids_cte(li_spec(), "feats", keep=keep, with_bias=True),
        f"""scored AS (SELECT rid, any_value(sample_id) AS sample_id, {carried},
        round(sum(value * {Q.init_value('fid', 'bucket')}), 9) AS logit FROM ids GROUP BY rid)""",
        f"scored_p AS (SELECT *, {Q.sigmoid('logit')} AS p FROM scored)"]


LR_SCORED_SQL = lr_scored_sql()


@query("wide_eval_by_day", headline=True, sql=with_ctes(*LR_SCORED_SQL,
    """agg AS (SELECT ds, p, sum(wt * y_ctr) AS pos, sum(wt * (1 - y_ctr)) AS neg FROM scored_p GROUP BY ds, p),
    cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY ds ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM agg),
    auc AS (SELECT ds, CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc FROM cum GROUP BY ds),
    ll AS (SELECT ds, count(*) AS n, sum(wt * -(y_ctr * ln(p + 1e-7) + (1 - y_ctr) * ln(1 - p + 1e-7))) / count(*) AS logloss FROM scored_p GROUP BY ds)""",
    body="""SELECT ll.ds, ll.n, round(auc.auc, 6) AS auc, round(ll.logloss, 6) AS logloss
    FROM ll JOIN auc ON ll.ds = auc.ds"""))
def wide_eval_by_day(spark, sf):
    """Minimum slice: score samples_li with the wide model; AUC and weighted
    log-loss per ship day."""
    s = _li_scored(spark, sf)
    rep = auc_exact(s, "y_ctr", "p", "wt", ["ds"], with_logloss=True)
    return rep.select("ds", "n", r(F.col("auc"), "auc"), r(F.col("logloss"), "logloss"))


@query("score_lr", sql=with_ctes(*LR_SCORED_SQL,
    body="SELECT sample_id, round(logit, 6) AS logit, round(p, 6) AS p FROM scored_p"))
def q_score_lr(spark, sf):
    s = _li_scored(spark, sf)
    return s.select("sample_id", r(F.col("logit"), "logit"), r(F.col("p"), "p"))
