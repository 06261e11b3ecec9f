"""Scoring with parameter tables passed in, and joint training."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from rankforge.operators import joint as J
from rankforge.operators import metrics as M
from rankforge.operators import models as MD
from rankforge.operators import networks as N
from rankforge.operators.lookup import id_fields, param_table
from rankforge.operators.metrics import EPS, sigmoid
from rankforge.operators.scoring import score_fm
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import ORACLES, query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_LI_SQL, li_spec, samples_li
from rankforge.plans.queries_models import (D, DENSE, DNN, FM_COLS, HIDDEN, KEEP, N_EXP, UNITS, WIDTH, _DFM_FINAL_FID, _sp_sql, _x)

from rankforge.session import checkpoint_dir, discarded, written
from rankforge.sources import scans as SC

SHIFT = 777  # the given tables differ from the initial values by this term


def r(c, name, digits=6):
    return rnd(c, name, digits)


# ---------------------------------------------------------------- given parameters
def given_table(spark, fields, dim=D):
    """A parameter table (fid, bucket, w, vec) that is not the initial one."""
    def value(d):
        return ((F.col("fid") * 7919 + F.col("bucket") * 104729 + d * 1299709 + SHIFT) % 2001 - 1000) / F.lit(10000.0)
    return param_table(spark, fields, with_bias=False).select("fid", "bucket", value(0).alias("w"),
                                                              F.array(*[value(d) for d in range(dim)]).alias("vec"))


def given_dense(shapes) -> dict:
    """Dense parameters by the same rule."""
    return {f: ((f * 7919 + np.arange(a, dtype=np.int64)[:, None] * 104729 + np.arange(b, dtype=np.int64)[None, :] * 1299709 + SHIFT)
                % 2001 - 1000) / 10000.0 for f, (a, b) in shapes.items()}


def given_sql(sql: str) -> str:
    """The same for a query's SQL."""
    return sql.replace("* 1299709) % 2001", f"* 1299709 + {SHIFT}) % 2001")


def _given_inputs(spark, sf, lin=()):
    fields = id_fields(li_spec(), set(DNN))
    return MD.sparse_inputs(samples_li(spark, sf), li_spec(), D, lin, DNN, keep=KEEP, params=given_table(spark, fields))


@query("score_fm_tables", sql=given_sql(ORACLES["score_fm"]))
def q_score_fm_tables(spark, sf):
    """FM with a parameter table passed in."""
    s = score_fm(samples_li(spark, sf), li_spec(), dim=D, params=given_table(spark, id_fields(li_spec())))
    return s.select("sample_id", r(F.col("logit"), "logit", 9), r(F.col("p"), "p"))


@query("score_deepfm_tables", sql=given_sql(ORACLES["score_deepfm"]))
def q_score_deepfm_tables(spark, sf):
    """DeepFM with embedding, linear and dense parameters passed in."""
    dense = given_dense(N.DeepFM(DNN, D, len(DENSE), HIDDEN).shapes())
    fm = F.array(*[F.col(c) for c in FM_COLS], *MD.poly_vector(DNN, D))
    z = MD.deepfm_logit(F.concat(fm, _x()), len(DNN) + D, WIDTH, 3, HIDDEN, _DFM_FINAL_FID, dense)
    return _given_inputs(spark, sf, DNN).select("sample_id", z.alias("logit")).select(
        "sample_id", r(F.col("logit"), "logit"), r(sigmoid("logit"), "p"))


@query("score_esmm_tables", sql=given_sql(ORACLES["score_esmm_shared"]))
def q_score_esmm_tables(spark, sf):
    """ESMM after a shared layer, all parameters passed in."""
    dense = given_dense(N.ESMM(DNN, D, len(DENSE), HIDDEN, 32).shapes())
    o = _given_inputs(spark, sf).select("sample_id", MD.esmm_heads(_x(), WIDTH, HIDDEN, 32, dense).alias("h"))
    return o.select("sample_id", *(r(F.col(f"h.{p}"), p) for p in ("p_ctr", "p_cvr", "p_ctcvr")))


def _labels():
    return {"ctr": "y_ctr", "ctcvr": "y_ctcvr", "cvr": "y_ctcvr"}


def _mmoe():
    return N.MMoE(DNN, D, len(DENSE), [6, 4], N_EXP, UNITS, inputs="shared")


def _mmoe_sql():
    iv, net = Q.init_value, _mmoe()
    poly = [f"0.5 * (({' + '.join(f'e_{f}_{d}' for f in DNN)}) * ({' + '.join(f'e_{f}_{d}' for f in DNN)}) - "
            f"({' + '.join(f'e_{f}_{d} * e_{f}_{d}' for f in DNN)}))" for d in range(D)]
    block = [*FM_COLS, *poly, *(f"e_{f}_{d}" for f in DNN for d in range(D)), *DENSE]
    ctes = [*_sp_sql(lin=DNN), Q.long_vector_cte("x0", block),
            f"""ex AS (SELECT x.rid, e.e, r.j AS u, greatest(sum(x.v * {iv('4000 + e.e', 'x.i', 'r.j')}) + {iv('4100 + e.e', '0', 'r.j')}, 0) AS v
                FROM x0 x, range({N_EXP}) e(e), range({UNITS}) r(j) GROUP BY x.rid, e.e, r.j)""",
            f"""gz AS (SELECT x.rid, t.t, g.g AS e, sum(x.v * {iv('4200 + t.t', 'x.i', 'g.g')}) + {iv('4300 + t.t', '0', 'g.g')} AS z
                FROM x0 x, range(3) t(t), range({N_EXP}) g(g) GROUP BY x.rid, t.t, g.g)""",
            "gate AS (SELECT rid, t, e, exp(z) / sum(exp(z)) OVER (PARTITION BY rid, t) AS g FROM gz)",
            """mix AS (SELECT ex.rid, gate.t, ex.u AS i, sum(gate.g * ex.v) AS v
                FROM ex JOIN gate ON ex.rid = gate.rid AND ex.e = gate.e GROUP BY ex.rid, gate.t, ex.u)"""]
    last = []
    for t, tower in enumerate(net.towers):
        ctes.append(f"m{t} AS (SELECT mix.rid, sp.sample_id, i, v FROM mix JOIN sp USING (rid) WHERE t = {t})")
        more, name = Q.mlp_ctes(f"m{t}", 20 + t, [UNITS, *(layer[3] for layer in tower.layers)], f"w{t}_")
        ctes += more
        last.append(name)
    p = ", ".join(f"round({Q.sigmoid(f'l{t}.v')}, 6) AS p_{task}" for t, task in enumerate(net.tasks))
    return given_sql(with_ctes(*ctes, body=f"SELECT l0.sample_id, {p} FROM {last[0]} l0 JOIN {last[1]} l1 USING (rid) JOIN {last[2]} l2 USING (rid)"))


@query("score_mmoe_tables", sql=_mmoe_sql())
def q_score_mmoe_tables(spark, sf):
    """MMoE with a tower each for click, click-and-convert and conversion, on
    the block of linear outputs, FM vector and deep inputs; parameters passed in."""
    net = _mmoe()
    rows = J.training_rows(samples_li(spark, sf), li_spec(), net, _labels(), DENSE, keep=("sample_id",))
    t = given_table(spark, id_fields(li_spec(), set(DNN))).select("fid", "bucket", F.concat(F.array("w"), "vec").alias("p"))
    size = sum(n for _, _, n in J.field_tables(li_spec(), net))
    p = J.score(rows.select("rid", "entries", "x", "y", "w", "sample_id"), net, J.Model(t, given_dense(net.shapes()), {}), _labels(), size,
                keep=("sample_id",))
    return p.select("sample_id", *(r(F.col(c), c) for c in ("p_ctr", "p_ctcvr", "p_cvr")))


# ---------------------------------------------------------------- one step, by SQL
STEP_LR = 0.05
CATS = [f.name for f in li_spec().categorical()]


def _step_sql():
    iv, spec = Q.init_value, li_spec()
    s = ", ".join(f"sum({iv('fid', 'bucket', str(d))}) AS s{d}" for d in range(D))
    q = " + ".join(f"sum(pow({iv('fid', 'bucket', str(d))}, 2))" for d in range(D))
    own = ", ".join(f"sum(d * (s{d} - {iv('fid', 'bucket', str(d))})) AS g{d + 1}" for d in range(D))
    pair = " + ".join(f"s{d} * s{d}" for d in range(D))
    full = " UNION ALL ".join(f"SELECT CAST({fid} AS BIGINT) AS fid, CAST(b AS BIGINT) AS bucket FROM range({n}) t(b)"
                              for _, fid, n, _ in id_fields(spec))

    def moved(value, g):
        return f"{value} - {STEP_LR} * coalesce({g}, 0) / sqrt(0.1 + pow(coalesce({g}, 0), 2))"
    vec = ", ".join(f"round({moved(iv('f.fid', 'f.bucket', str(d)), f'g{d + 1}')}, 9) AS v{d}" for d in range(D))
    return with_ctes(
        SAMPLES_LI_SQL, *Q.feature_ctes(spec, "samples_li", ("sample_id", "y_ctr", "wt")), Q.long_ids_cte(spec, "feats", keep=("y_ctr", "wt")),
        f"t AS (SELECT rid, any_value(y_ctr) AS y, any_value(wt) AS w, sum({iv('fid', 'bucket')}) AS lin, {s}, {q} AS q FROM ids GROUP BY rid)",
        f"z AS (SELECT *, {Q.sigmoid(f'lin + 0.5 * ({pair} - q)')} AS p FROM t)",
        f"e AS (SELECT *, w * (-y / (p + {EPS}) + (1 - y) / (1 - p + {EPS})) * p * (1 - p) / (SELECT count(*) FROM feats) AS d FROM z)",
        f"g AS (SELECT fid, bucket, sum(d) AS g0, {own} FROM ids JOIN e USING (rid) GROUP BY 1, 2)",
        f"f AS ({full})",
        body=f"SELECT f.fid, f.bucket, round({moved(iv('f.fid', 'f.bucket'), 'g0')}, 9) AS w, {vec} FROM f LEFT JOIN g USING (fid, bucket)")


@query("train_step_fm", sql=_step_sql())
def q_train_step_fm(spark, sf):
    """One Adagrad step of an FM over all samples: the linear weight and the
    embedding of every id after it."""
    net, rule = N.FM(CATS, D), J.Rule("adagrad", STEP_LR)
    rows = J.stored(J.training_rows(samples_li(spark, sf), li_spec(), net, {"ctr": "y_ctr"}))
    size = sum(n for _, _, n in J.field_tables(li_spec(), net))
    m = J.train(rows, net, J.start_model(spark, li_spec(), net, rule), {"ctr": "y_ctr"}, size, deep=rule)
    t = m.tables()
    return t.select("fid", "bucket", r(F.col("w"), "w", 9), *(r(F.col("vec").getItem(d), f"v{d}", 9) for d in range(D)))


# ---------------------------------------------------------------- training loops (rows only)
@query("train_joint")
def q_train_joint(spark, sf):
    """ESMM with tables, shared layer and towers trained together: mini-batches,
    Adagrad for tables and layers, FTRL for linear weights, GradNorm task
    weights; loss and weight of every task by step."""
    net = N.ESMM(DNN, D, len(DENSE), HIDDEN, 32, inputs="shared")
    deep, wide = J.Rule("adagrad", 0.05), J.Rule("ftrl", 0.01, 0.01, 0.001)
    rows = J.stored(J.training_rows(samples_li(spark, sf), li_spec(), net, _labels(), DENSE, batches=4))
    size = sum(n for _, _, n in J.field_tables(li_spec(), net))
    m = J.train(rows, net, J.start_model(spark, li_spec(), net, deep, wide), _labels(), size, 1, deep, wide, J.TaskWeights(2, "gradnorm"))
    return spark.createDataFrame([tuple(h[k] for k in ("step", "loss", "loss_ctr", "loss_ctcvr", "weight_ctr", "weight_ctcvr")) for h in m.history],
                                 "step long, loss double, loss_ctr double, loss_ctcvr double, weight_ctr double, weight_ctcvr double")


EPOCHS, GROUPS = 2, 5


@query("train_eval_loop")
def q_train_eval_loop(spark, sf):
    """Epochs over five shard groups: a group continues from the run that the
    group before committed, is saved as a run of its own and evaluated on the
    dev split; one row per (epoch, group)."""
    net, rule = N.DeepFM(DNN, D, len(DENSE), HIDDEN), J.Rule("adagrad", 0.1)
    s = SC.split_train_test(SC.shard_groups(samples_li(spark, sf), key="sample_id", n_shards=2 * GROUPS, divisor=2), "sample_id", 0.2, seed=9)
    rows = J.stored(J.training_rows(s, li_spec(), net, {"ctr": "y_ctr"}, DENSE, keep=("shard_group", "split")), by=("split", "shard_group"))
    dev, size = rows.filter("split = 'test'"), sum(n for _, _, n in J.field_tables(li_spec(), net))
    path = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    out = []
    for epoch in range(EPOCHS):
        for group in range(GROUPS):
            m = J.load_model(spark, path) or J.start_model(spark, li_spec(), net, rule)
            part = rows.filter((F.col("split") == "train") & (F.col("shard_group") == group))
            m = J.train(part, net, m, {"ctr": "y_ctr"}, size, deep=rule, seed=epoch)
            J.save_model(m, path, f"{epoch:04d}-{group:04d}")
            p = J.score(dev, net, m, {"ctr": "y_ctr"}, size, keep=("y", "w"))
            p = written(p.select(F.element_at("y", 1).alias("y"), "w", "p_ctr"))  # the AUC reads the scores twice
            auc = M.auc_exact(p, "y", "p_ctr", "w").first()["auc"]
            discarded(p)
            out.append((epoch, group, m.step, m.history[-1]["loss"] if m.history else None, auc))
    return spark.createDataFrame(out, "epoch long, shard_group long, step long, train_loss double, dev_auc double")


@query("walk_forward_train")
def q_walk_forward_train(spark, sf):
    """DeepFM trained year by year, each year from the run committed for the
    year before, and tested on the year after: AUC by tested year."""
    net, rule = N.DeepFM(DNN, D, len(DENSE), HIDDEN), J.Rule("adagrad", 0.1)
    s = samples_li(spark, sf).withColumn("period", F.year("ds"))
    rows = J.stored(J.training_rows(s, li_spec(), net, {"ctr": "y_ctr"}, DENSE, keep=("period",)))
    size, path = sum(n for _, _, n in J.field_tables(li_spec(), net)), f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    out = []
    for now, after, m, p in J.walk_forward_runs(rows, "period", net, J.start_model(spark, li_spec(), net, rule), {"ctr": "y_ctr"}, size, path, rule):
        auc = M.auc_exact(p.select(F.element_at("y", 1).alias("y"), "w", "p_ctr"), "y", "p_ctr", "w").first()["auc"]
        out.append((now, after, m.step, auc))
    return spark.createDataFrame(out, "trained int, tested int, step long, auc double")
