"""Training / evaluation queries (T1-T14, A13) and the streaming ingest."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.functions import features as X
from rankforge.operators import metrics as M
from rankforge.operators import models as MD
from rankforge.operators import samples as SM
from rankforge.operators import training as TR
from rankforge.operators.boosting import score_id_trees
from rankforge.operators.factorization import score_id_fm
from rankforge.operators.lookup import id_fields, param_table
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_EV_SQL, SAMPLES_LI_SQL, li_spec, samples_ev, samples_li
from rankforge.plans.queries_core import LR_SCORED_SQL, _li_scored
from rankforge.plans.queries_models import (D, DNN, HIDDEN, N_EXP, TOWER, UNITS, WIDTH, _esmm_sql, _mmoe_sql,
                                            _sp, _sp_sql, _x, _x0_sql)
from rankforge.session import written
from rankforge.sources import scans as SC
from rankforge.sources.tables import read_table
from rankforge.streaming.ingest import ingest_daily, ingest_trailing, read_daily


def r(c, name, digits=6):
    return rnd(c, name, digits)


LR = 0.1
LAM = 0.01


def _grad_sql():
    spec = li_spec()
    return [SAMPLES_LI_SQL] + Q.feature_ctes(spec, "samples_li", ("sample_id", "y_ctr", "wt")) + [
        Q.long_ids_cte(spec, "feats", keep=("y_ctr", "wt"), with_bias=True),
        f"""scored AS (SELECT rid, sum(value * {Q.init_value('fid', 'bucket')}) AS logit,
                   any_value(y_ctr) AS y, any_value(wt) AS w FROM ids GROUP BY rid)""",
        f"resid AS (SELECT rid, ({Q.sigmoid('logit')} - y) * w AS r FROM scored)",
        """g AS (SELECT i.field, i.fid, i.bucket, sum(r.r * i.value) / (SELECT count(*) FROM scored) AS grad
               FROM ids i JOIN resid r ON i.rid = r.rid GROUP BY 1, 2, 3)"""]


@query("grad_step_lr", sql=with_ctes(*_grad_sql(), body=f"""
SELECT field, fid, bucket, round(grad, 9) AS grad, round({Q.init_value('fid', 'bucket')} - {LR} * grad, 9) AS w FROM g"""))
def q_grad_step_lr(spark, sf):
    """One weighted log-loss gradient step of the wide model (sparse, per bucket)."""
    g = TR.grad_step_lr(samples_li(spark, sf), li_spec(), LR)
    return g.select("field", "fid", "bucket", r(F.col("grad"), "grad", 9), r(F.col("w"), "w", 9))


def _full_table_sql():
    parts = [f"SELECT '{n}' AS field, CAST({fid} AS BIGINT) AS fid, CAST(b AS BIGINT) AS bucket FROM range({k}) t(b)"
             for n, fid, k, _ in id_fields(li_spec())]
    parts.append("SELECT '__bias__', CAST(-1 AS BIGINT), CAST(0 AS BIGINT)")
    return "full_t AS (" + " UNION ALL ".join(parts) + ")"


@query("l2_penalty", sql=with_ctes(*_grad_sql(), _full_table_sql(), body=f"""
SELECT t.field, round(sum(pow({Q.init_value('t.fid', 't.bucket')} - {LR} * coalesce(g.grad, 0), 2)) * {LAM / 2}, 9) AS l2
FROM full_t t LEFT JOIN g ON t.fid = g.fid AND t.bucket = g.bucket GROUP BY t.field"""))
def q_l2_penalty(spark, sf):
    """λ·Σw²/2 per table after one gradient step (untouched rows included)."""
    spec = li_spec()
    g = TR.grad_step_lr(samples_li(spark, sf), spec, LR)
    full = param_table(spark, id_fields(spec))
    upd = full.join(g.select("fid", "bucket", "grad"), ["fid", "bucket"], "left").withColumn(
        "w", F.col("w") - F.lit(LR) * F.coalesce("grad", F.lit(0.0)))
    return M.l2_penalty(upd, LAM).select("field", r(F.col("l2"), "l2", 9))


def _ll(y, p, w="wt"):
    return f"{w} * -({y} * ln({p} + 1e-7) + (1 - {y}) * ln(1 - {p} + 1e-7))"


def _esmm_preds(spark, sf, extra=()):
    from rankforge.plans.queries_models import KEEP, _spec
    sp = MD.sparse_inputs(samples_li(spark, sf), _spec(), D, (), DNN, (), keep=KEEP + tuple(extra))
    h = MD.esmm_heads(_x(), WIDTH, HIDDEN)
    return sp.select("sample_id", "y_ctr", "y_ctcvr", "wt", *extra, h.alias("h")).select(
        "sample_id", "y_ctr", "y_ctcvr", "wt", *extra, "h.*")


ESMM_P_SQL = _sp_sql() + [_x0_sql()] + _esmm_sql() + [
    """preds AS (SELECT pz.rid, pz.sample_id, sp.y_ctr, sp.y_ctcvr, sp.wt, pz.p_ctr, pz.p_cvr, pz.p_ctr * pz.p_cvr AS p_ctcvr
                 FROM pz JOIN sp ON pz.rid = sp.rid)"""]


@query("loss_esmm", sql=with_ctes(*ESMM_P_SQL, f"""
l AS (SELECT sum({_ll('y_ctr', 'p_ctr')}) / count(*) AS ctr, sum({_ll('y_ctcvr', 'p_ctcvr', '1.0')}) / count(*) AS ctcvr FROM preds)""",
    body="""SELECT 'ctr' AS task, round(ctr, 6) AS loss FROM l UNION ALL SELECT 'ctcvr', round(ctcvr, 6) FROM l
    UNION ALL SELECT 'total', round(ctr + 1.5 * ctcvr, 6) FROM l"""))
def q_loss_esmm(spark, sf):
    """ESMM objective L_ctr + λ·L_ctcvr (λ = 1.5) from one scan of predictions."""
    pr = _esmm_preds(spark, sf)
    tl = TR.task_losses(pr, {"ctr": ("y_ctr", "p_ctr", None), "ctcvr": ("y_ctcvr", "p_ctcvr", None)})
    return TR.esmm_objective(tl, lam=1.5).select("task", r(F.col("loss"), "loss"))


@query("loss_mmoe", sql=with_ctes(*_sp_sql(), _x0_sql(), *_mmoe_sql(), """
preds AS (SELECT pz.rid, pz.sample_id, sp.y_ctr, sp.y_ctcvr, sp.wt, pz.p_ctr, pz.p_cvr, pz.p_ctr * pz.p_cvr AS p_ctcvr
          FROM pz JOIN sp ON pz.rid = sp.rid)""", body=f"""
SELECT 'ctr' AS task, round(sum({_ll('y_ctr', 'p_ctr')}) / count(*), 6) AS loss, count(*) AS n FROM preds
UNION ALL SELECT 'ctcvr', round(sum({_ll('y_ctcvr', 'p_ctcvr', '1.0')}) / count(*), 6), count(*) FROM preds
UNION ALL SELECT 'cvr', round(sum(CASE WHEN y_ctr = 1 THEN {_ll('y_ctcvr', 'p_cvr', '1.0')} END) / count(CASE WHEN y_ctr = 1 THEN 1 END), 6),
                 count(CASE WHEN y_ctr = 1 THEN 1 END) FROM preds"""))
def q_loss_mmoe(spark, sf):
    """MMoE losses: ctr and ctcvr on all rows, cvr on clicked rows only."""
    sp = _sp(spark, sf)
    h = MD.mmoe_heads(_x(), WIDTH, N_EXP, UNITS, TOWER)
    pr = sp.select("sample_id", "y_ctr", "y_ctcvr", "wt", h.alias("h")).select("y_ctr", "y_ctcvr", "wt", "h.*")
    tl = TR.task_losses(pr, {"ctr": ("y_ctr", "p_ctr", None), "ctcvr": ("y_ctcvr", "p_ctcvr", None),
                             "cvr": ("y_ctcvr", "p_cvr", F.col("y_ctr") == 1)})
    return tl.select("task", r(F.col("loss"), "loss"), "n")


TOTAL = 30


@query("lbtw_weights", sql=with_ctes(*ESMM_P_SQL, f"""
sl AS (SELECT ds, 'ctr' AS task, sum({_ll('preds.y_ctr', 'p_ctr', 'preds.wt')}) / count(*) AS loss FROM preds JOIN samples_li USING (rid) GROUP BY ds
       UNION ALL SELECT ds, 'ctcvr', sum({_ll('preds.y_ctcvr', 'p_ctcvr', '1.0')}) / count(*) FROM preds JOIN samples_li USING (rid) GROUP BY ds)""",
    """st AS (SELECT *, dense_rank() OVER (ORDER BY ds) - 1 AS step FROM sl)""",
    f"""lh AS (SELECT *, pow(loss / first_value(loss) OVER (PARTITION BY task, floor(step / {TOTAL}) ORDER BY step), 0.5) AS inv FROM st)""",
    body="""SELECT CAST(step AS BIGINT) AS step, task, round(count(*) OVER (PARTITION BY step) * inv / sum(inv) OVER (PARTITION BY step), 6) AS weight FROM lh"""))
def q_lbtw_weights(spark, sf):
    """Loss-balanced task weights per day-step (reset every 30 steps) from
    the per-day ESMM task losses."""
    pr = _esmm_preds(spark, sf, extra=("ds",))
    tl = TR.task_losses(pr, {"ctr": ("y_ctr", "p_ctr", None), "ctcvr": ("y_ctcvr", "p_ctcvr", None)},
                        group_cols=["ds"])
    steps = tl.select("ds").distinct().withColumn("step", F.dense_rank().over(Window.orderBy("ds")) - 1)
    sl = tl.join(steps, "ds").select(F.col("step").cast("bigint").alias("step"), "task", "loss")
    return TR.lbtw_weights(sl, TOTAL).select("step", "task", r(F.col("weight"), "weight"))


@query("gradnorm_weights")
def q_gradnorm_weights(spark, sf):
    """GradNorm task weights per day-step; per-step losses and gradient
    norms from one Spark job, the weight recurrence on the small table."""
    stats = TR.multitask_step_stats(samples_ev_li(spark, sf), li_spec(),
                                    {"ctr": ("y_ctr", 0.0), "ctcvr": ("y_ctcvr", -1.0)}, step_col="ds")
    return TR.gradnorm_weights(stats)


def samples_ev_li(spark, sf):
    return samples_li(spark, sf)


_tw = """daily AS (SELECT touid, ds, sum(y_ctr) AS clk, count(*) AS imp, ds - DATE '1970-01-01' AS dn FROM samples_ev GROUP BY 1, 2)""", \
      """tr AS (SELECT touid, ds, CASE WHEN coalesce(sum(imp) OVER w, 0) > 0 THEN sum(clk) OVER w / sum(imp) OVER w ELSE 0 END AS ctr_7
             FROM daily WINDOW w AS (PARTITION BY touid ORDER BY dn RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


@query("walk_forward", sql=with_ctes(SAMPLES_EV_SQL, *_tw, """
sc AS (SELECT e.ds, e.y_ctr, tr.ctr_7 AS p FROM samples_ev e JOIN tr ON e.touid = tr.touid AND e.ds = tr.ds)""", """
agg AS (SELECT ds, p, sum(y_ctr) AS pos, sum(1 - y_ctr) AS neg FROM sc GROUP BY ds, p)""", """
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY ds ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM agg)""", """
auc AS (SELECT ds, CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc FROM cum GROUP BY ds)""",
    body="""SELECT s.ds, count(*) AS n, round(any_value(auc.auc), 6) AS auc,
       round(sum(-(y_ctr * ln(p + 1e-7) + (1 - y_ctr) * ln(1 - p + 1e-7))) / count(*), 6) AS logloss
FROM sc s JOIN auc ON s.ds = auc.ds GROUP BY s.ds"""))
def q_walk_forward(spark, sf):
    """Fit on the days before d (item trailing 7-day CTR), test on day d:
    AUC and log-loss per test day."""
    w = TR.walk_forward(samples_ev(spark, sf), "touid", window=7)
    return w.select("ds", "n", r(F.col("auc"), "auc"), r(F.col("logloss"), "logloss"))


@query("score_check", sql=with_ctes(*LR_SCORED_SQL, body="""
SELECT sample_id, y_ctr, round(p, 6) AS p FROM scored_p ORDER BY sample_id LIMIT 8"""))
def q_score_check(spark, sf):
    """Eight scored rows beside their labels, in key order."""
    s = _li_scored(spark, sf)
    return s.select("sample_id", "y_ctr", r(F.col("p"), "p")).orderBy("sample_id").limit(8)


# ---------------------------------------------------------------- MLlib (rows-only)
ID_COLS = [f.name for f in li_spec().categorical()]


def _id_frame(spark, sf):
    """The samples with one id >= 0 per field (0 if missing)."""
    c = X.compile_features(samples_li(spark, sf), li_spec(), keep=["sample_id", "y_ctr", "wt", "ds"])
    return c.withColumns({col: F.greatest(F.col(col), F.lit(0)) for col in ID_COLS})


def _id_rows(spark, sf):
    # fitting, training and scoring read the samples several times each
    return written(_id_frame(spark, sf).select(*ID_COLS, "y_ctr", "wt"))


def _ml_frame(spark, sf):
    return TR.onehot_features(_id_rows(spark, sf).withColumns({col: F.col(col).cast("double") for col in ID_COLS}), ID_COLS)


@query("train_lr")
def q_train_lr(spark, sf):
    """Elastic-net weighted LR on one-hot ids; reports train AUC and sparsity."""
    d = _ml_frame(spark, sf)
    m = TR.train_lr(d, max_iter=10)
    pred = m.transform(d).select("y_ctr", "wt", _p1().alias("p"))
    auc = M.auc_exact(pred, "y_ctr", "p", "wt").first()["auc"]
    nz = int(sum(1 for x in m.coefficients.toArray() if x != 0))
    return spark.createDataFrame([("auc_train", float(auc)), ("nonzero", float(nz)), ("intercept", float(m.intercept))],
                                 "metric string, value double")


def _p1(col="probability"):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col)).getItem(1)


@query("train_fm")
def q_train_fm(spark, sf):
    """FM (adamW) on one-hot ids, as MLlib trains it; train AUC."""
    d = _id_rows(spark, sf)
    m = TR.train_fm(d, ID_COLS)
    pred = written(score_id_fm(d, m).select("y_ctr", "p"))  # the AUC reads the scores twice
    auc = M.auc_exact(pred, "y_ctr", "p").first()["auc"]
    return spark.createDataFrame([("auc_train", float(auc)), ("factors", float(m.getFactorSize()))],
                                 "metric string, value double")


def _gbt(spark, sf):
    """The model and its split data."""
    # training and scoring read the samples several times
    d = written(SC.split_train_test(_id_frame(spark, sf), "sample_id", 0.2, seed=3).select("sample_id", *ID_COLS, "y_ctr", "wt", "split"))
    return TR.train_gbt(d.where("split = 'train'"), ID_COLS), d


@query("train_gbt")
def q_train_gbt(spark, sf):
    """Weighted boosted trees; train and test AUC."""
    m, d = _gbt(spark, sf)
    pred = written(score_id_trees(d, m).select("split", "y_ctr", "wt", "p"))  # the AUC reads the scores twice
    return M.auc_exact(pred, "y_ctr", "p", "wt", ["split"]).select("split", r(F.col("auc"), "auc"))


@query("score_gbt")
def q_score_gbt(spark, sf):
    """Tree-ensemble scores for the test split."""
    m, d = _gbt(spark, sf)
    return score_id_trees(d.where("split = 'test'"), m).select("sample_id", r("p", "p"))


# ---------------------------------------------------------------- T5 / T11 (rows-only)
@query("train_deep")
def q_train_deep(spark, sf):
    """Data-parallel Adam on the DNN tower: loss per step."""
    sp = _sp(spark, sf).select(_x().alias("x"), "y_ctr", "wt")
    _, hist = TR.train_deep(sp, "x", WIDTH, HIDDEN, steps=4, lr=0.01, checkpoint_input=True)
    return spark.createDataFrame(hist, "step long, loss double")


# ---------------------------------------------------------------- X1
@query("daily_ingest", sql="""
SELECT CAST(ts AS DATE) AS ds, event_type, count(*) AS n, round(sum(value), 6) AS value FROM events GROUP BY 1, 2""")
def q_daily_ingest(spark, sf):
    """Stream the events file through the daily ingest (availableNow),
    then read the sink back."""
    schema = read_table(spark, sf, "events").schema
    out = ingest_daily(spark, sf, schema, "events.parquet")
    d = read_daily(spark, out)
    return d.select("ds", "event_type", "n", r(F.col("value"), "value"))


TRAILING = (1, 7)


@query("trailing_ingest", sql=with_ctes(SAMPLES_EV_SQL, """
d AS (SELECT touid, ds, sum(y_ctr) AS clk, count(*) AS imp FROM samples_ev GROUP BY touid, ds)""", body="SELECT a.touid, a.ds, " + ", ".join(
    f"round(coalesce(sum(b.clk) FILTER (WHERE b.ds >= a.ds - {n}) / sum(b.imp) FILTER (WHERE b.ds >= a.ds - {n}), 0), 6) AS ctr_{n}"
    for n in TRAILING) + " FROM d a LEFT JOIN d b ON b.touid IS NOT DISTINCT FROM a.touid AND b.ds < a.ds AND b.ds >= a.ds - 7 GROUP BY a.touid, a.ds"))
def q_trailing_ingest(spark, sf):
    """Trailing click rates of items, kept by the streaming ingest."""
    schema = read_table(spark, sf, "events").schema

    def samples(batch):
        return batch.select(F.get_json_object("props", "$.k").cast("bigint").alias("touid"), F.to_date("ts").alias("ds"),
                            F.col("event_type").isin("click", "purchase").cast("double").alias("y_ctr"))

    path = ingest_trailing(spark, sf, schema, "events.parquet", "touid", TRAILING, samples)
    return spark.read.parquet(path).select("touid", "ds", *(r(F.col(f"ctr_{n}"), f"ctr_{n}") for n in TRAILING))
