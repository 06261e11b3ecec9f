"""Lookup (J1-J5, A5) and model-scoring (M2-M12, F19-F21, F24, O4) queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.functions import features as X
from rankforge.operators import models as MD
from rankforge.operators.lookup import (ROW_ID, with_row_id, embed_bag, embed_lookup, id_fields, init_value, linear_lookup, long_ids,
                                        maybe_broadcast, param_table, warm_start)
from rankforge.operators.metrics import sigmoid
from rankforge.operators.scoring import score_fm
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import (SAMPLES_EV_SQL, SAMPLES_LI_SQL, li_spec, samples_ev, samples_li)
from rankforge.sources.tables import read_table

D = 4
DNN = ["acctbal_b", "discount_b", "mktsegment_v", "nation_id", "z_nation_id", "z_brand_h"]
DENSE = ["discount", "tax", "z_size_n"]
KEEP = ("y_ctr", "y_ctcvr", "wt", *DENSE)
WIDTH = len(DNN) * D + len(DENSE)
HIDDEN = [16, 8]


def r(c, name):
    return rnd(c, name)


def r9(c, name):
    """Exact short decimals (sums/products of 4-decimal weights): round at 9
    places so no output sits on a rounding tie."""
    return rnd(c, name, 9)


def _spec():
    return li_spec()


def _sp(spark, sf, lin=(), emb=DNN, numeric=(), shared=None):
    return MD.sparse_inputs(samples_li(spark, sf), _spec(), D, lin, emb, numeric, keep=KEEP, shared=shared)


def _x():
    return F.concat(MD.emb_array(DNN, D), F.array(*[F.col(c) for c in DENSE]))


def _sp_sql(lin=(), emb=DNN, numeric=(), shared=None):
    return [SAMPLES_LI_SQL] + Q.sparse_ctes(_spec(), D, lin, emb, numeric, KEEP, shared)


X0_COLS = [f"e_{f}_{d}" for f in DNN for d in range(D)] + DENSE


def _x0_sql():
    return Q.long_vector_cte("x0", X0_COLS)


# ---------------------------------------------------------------- J1 .. J5, A5
def _ids_sql(with_bias=False):
    return [SAMPLES_LI_SQL] + Q.feature_ctes(_spec(), "samples_li", ("sample_id",)) + [
        Q.long_ids_cte(_spec(), "feats", with_bias=with_bias)]


@query("linear_lookup", sql=with_ctes(*_ids_sql(), body=f"""
SELECT any_value(sample_id) AS sample_id, count(*) AS n_ids, round(sum(value * {Q.init_value('fid', 'bucket')}), 9) AS linear
FROM ids GROUP BY rid"""))
def q_linear_lookup(spark, sf):
    """Σ weights over every id of a sample (sum combiner), bias excluded."""
    spec = _spec()
    fields = id_fields(spec)
    feats = with_row_id(X.compile_features(samples_li(spark, sf), spec, keep=["sample_id"]))
    ids = long_ids(feats, fields, ROW_ID, keep=("sample_id",))
    w = maybe_broadcast(param_table(spark, fields, with_bias=False), fields)
    # a row has one sample id: as a key it keeps the aggregate hashed, as a value it would sort all ids
    s = ids.join(w.select("fid", "bucket", "w"), ["fid", "bucket"], "left").groupBy(ROW_ID, "sample_id").agg(
        F.count(F.lit(1)).alias("n_ids"),
        r9(F.sum(F.col("value") * F.coalesce("w", F.lit(0.0))), "linear"))
    return s.drop(ROW_ID)


@query("embed_lookup", sql=with_ctes(SAMPLES_LI_SQL, *Q.feature_ctes(_spec(), "samples_li", ("sample_id",))[0:2],
                                     body=f"""
SELECT sample_id, CAST(d AS BIGINT) AS dim, round({Q.init_value('6', 'z_brand_h', 'd')}, 6) AS value
FROM feats, range({D}) t(d)"""))
def q_embed_lookup(spark, sf):
    """Single-valued id → vector (brand hash, 4 dims), exploded."""
    spec = _spec()
    fields = id_fields(spec, {"z_brand_h"})
    feats = X.compile_features(samples_li(spark, sf), spec, keep=["sample_id"])
    ids = long_ids(feats, fields)
    table = maybe_broadcast(param_table(spark, fields, dim=D, with_bias=False), fields, D)
    v = embed_lookup(ids, table)
    return v.select("sample_id", F.posexplode("vec").alias("dim", "value")).select(
        "sample_id", F.col("dim").cast("bigint").alias("dim"), r(F.col("value"), "value"))


TOUID_FID = 7  # touid_h position in the demo spec


def _bag_sql(combiners=("sum",), distinct="DISTINCT "):
    sel = []
    for c in combiners:
        scale = {"sum": "1.0", "mean": "(1.0 / count(*))", "sqrtn": "(1.0 / sqrt(count(*)))"}[c]
        sel.append(f"""SELECT cu.c_custkey AS uid, '{c}' AS combiner, CAST(t.d AS BIGINT) AS dim,
            round(coalesce(round(sum({Q.init_value(str(TOUID_FID), 'p.b', 't.d')}), 9) * {scale}, 0), 6) AS value
        FROM customer cu CROSS JOIN range({D}) t(d) LEFT JOIN pairs p ON p.uid = cu.c_custkey
        GROUP BY cu.c_custkey, t.d""")
    return with_ctes(SAMPLES_LI_SQL, f"""pairs AS (SELECT {distinct}uid, {Q.hash_bucket('touid', 1000)} AS b FROM samples_li)""",
                     body=" UNION ALL ".join(sel))


def _bags(spark, sf, combiner, distinct=True):
    """Per customer: the suppliers bought from (each once, or once per sample),
    as hashed ids (the exploded form of a var-length list column), combined into
    one vector; customers without orders get the zero vector."""
    s = samples_li(spark, sf).select("uid", X.hash_bucket("touid", 1000).alias("touid_h"))
    s = s.distinct() if distinct else s
    spec = _spec()
    fields = id_fields(spec, {"touid_h"})
    ids = long_ids(s, fields, id_col="uid")
    table = maybe_broadcast(param_table(spark, fields, dim=D, with_bias=False), fields, D)
    bag = embed_bag(ids, table, D, combiner, group_cols=("uid",), snap_digits=9)
    cu = read_table(spark, sf, "customer", ["c_custkey"], spread=False)
    j = cu.join(bag, cu.c_custkey == bag.uid, "left")
    vec = F.coalesce(F.col("vec"), F.array_repeat(F.lit(0.0), D))
    return j.select(F.col("c_custkey").alias("uid"), F.lit(combiner).alias("combiner"),
                    F.posexplode(vec).alias("dim", "value")).select(
        "uid", "combiner", F.col("dim").cast("bigint").alias("dim"), r(F.col("value"), "value"))


@query("embed_bag_list", sql=_bag_sql(("mean",), ""))
def q_embed_bag_list(spark, sf):
    """Lists with repeated ids: an id counts as often as it occurs."""
    return _bags(spark, sf, "mean", distinct=False)


@query("embed_bag_sum", sql=_bag_sql(("sum",)), headline=True)
def q_embed_bag_sum(spark, sf):
    return _bags(spark, sf, "sum")


@query("bag_combiners", sql=_bag_sql(("sum", "mean", "sqrtn")))
def q_bag_combiners(spark, sf):
    out = _bags(spark, sf, "sum")
    for c in ("mean", "sqrtn"):
        out = out.unionByName(_bags(spark, sf, c))
    return out


SHARED = {"nation_id": (100, 25), "z_nation_id": (100, 25)}


@query("shared_embed", sql=with_ctes(*_sp_sql(emb=("nation_id", "z_nation_id"), shared=SHARED), body=" ".join([
    "SELECT sample_id, round(", " + ".join(f"e_nation_id_{d} * e_z_nation_id_{d}" for d in range(D)),
    ", 6) AS nation_affinity FROM sp"])))
def q_shared_embed(spark, sf):
    """Customer nation and supplier nation read ONE table; their dot product
    is a learned nation-affinity term."""
    sp = _sp(spark, sf, emb=("nation_id", "z_nation_id"), shared=SHARED)
    aff = sum((F.col(f"e_nation_id_{d}") * F.col(f"e_z_nation_id_{d}") for d in range(1, D)),
              F.col("e_nation_id_0") * F.col("e_z_nation_id_0"))
    return sp.select("sample_id", r(aff, "nation_affinity"))


#: Components of the stored embeddings.
WARM_D = 64


@query("warm_embed", sql=f"""
SELECT b.b AS bucket, CAST(t.d AS BIGINT) AS dim,
       round(coalesce(CAST(e.embedding[t.d + 1] AS DOUBLE), {Q.init_value(str(TOUID_FID), 'b.b', 't.d')}), 6) AS value
FROM (SELECT range AS b FROM range(1000) UNION SELECT vec_id FROM embeddings) b
CROSS JOIN range({WARM_D}) t(d) LEFT JOIN embeddings e ON e.vec_id = b.b""")
def q_warm_embed(spark, sf):
    """Initial table for the 1000 touid buckets and every id of the pretrained
    table, overwritten by that (the stored embeddings, keyed by vec_id)."""
    fields = id_fields(_spec(), {"touid_h"})
    init = param_table(spark, fields, dim=WARM_D, with_bias=False).select("fid", "bucket", "vec")
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    pre = e.select(F.lit(TOUID_FID).cast("bigint").alias("fid"), F.col("vec_id").alias("bucket"),
                   F.col("embedding").cast("array<double>").alias("vec"))
    more = pre.select("fid", "bucket").distinct().join(init, ["fid", "bucket"], "left_anti").withColumn(
        "vec", F.array(*[init_value(F.col("fid"), F.col("bucket"), d) for d in range(WARM_D)]))
    w = warm_start(init.unionByName(more), pre)
    return w.select("bucket", F.posexplode("vec").alias("dim", "value")).select(
        "bucket", F.col("dim").cast("bigint").alias("dim"), r(F.col("value"), "value"))


# ---------------------------------------------------------------- M2 / M3 FM
def _fm_sql(numeric=()):
    spec = _spec()
    ctes = [SAMPLES_LI_SQL] + Q.feature_ctes(spec, "samples_li", ("sample_id",) + tuple(numeric)) + [
        Q.long_ids_cte(spec, "feats", numeric=numeric)]
    s = ", ".join(f"sum(value * {Q.init_value('fid', 'bucket', str(d))}) AS s{d}" for d in range(D))
    q = " + ".join(f"sum(pow(value * {Q.init_value('fid', 'bucket', str(d))}, 2))" for d in range(D))
    ctes.append(f"t AS (SELECT any_value(sample_id) AS sample_id, sum(value * {Q.init_value('fid', 'bucket')}) AS lin, "
                f"{s}, {q} AS q FROM ids GROUP BY rid)")
    pair = "0.5 * (" + " + ".join(f"s{d} * s{d}" for d in range(D)) + " - q)"
    ctes.append(f"z AS (SELECT sample_id, lin + {pair} AS logit FROM t)")
    d = 9 if not numeric else 6
    return with_ctes(*ctes, body=f"SELECT sample_id, round(logit, {d}) AS logit, round({Q.sigmoid('logit')}, 6) AS p FROM z")


@query("score_fm", sql=_fm_sql(), headline=True)
def q_score_fm(spark, sf):
    """FM: linear + ½Σ_d((Σv)²−Σv²) over all categorical ids (no pairwise join)."""
    s = score_fm(samples_li(spark, sf), _spec(), dim=D)
    return s.select("sample_id", r9(F.col("logit"), "logit"), r(F.col("p"), "p"))


@query("score_fm_values", sql=_fm_sql(("discount", "tax")))
def q_score_fm_values(spark, sf):
    """FM with numeric fields: x·w and x·v (vocabulary of one)."""
    s = score_fm(samples_li(spark, sf), _spec(), dim=D, numeric=("discount", "tax"))
    return s.select("sample_id", r(F.col("logit"), "logit"), r(F.col("p"), "p"))


# ---------------------------------------------------------------- M4 FM layer
def _fm_layer_sql_cols(first_order="sum"):
    lw = MD.init_matrix(3000, len(DNN), 1)[:, 0]
    cols = []
    for k, f in enumerate(DNN):
        s = " + ".join(f"e_{f}_{d}" for d in range(D))
        if first_order == "mean":
            s = f"({s}) / {float(D)}"
        cols.append(f"({s}) * {float(lw[k])!r}")
    for d in range(D):
        s = " + ".join(f"e_{f}_{d}" for f in DNN)
        q = " + ".join(f"e_{f}_{d} * e_{f}_{d}" for f in DNN)
        cols.append(f"0.5 * (({s}) * ({s}) - ({q}))")
    return cols


@query("fm_layer", sql=with_ctes(*_sp_sql(), Q.long_vector_cte("fm", _fm_layer_sql_cols("sum")),
                                 body="SELECT sample_id, CAST(i AS BIGINT) AS pos, round(v, 9) AS value FROM fm"))
def q_fm_layer(spark, sf):
    """FM layer on dense embeddings (sum first order): per-feature first
    order × weight, plus the second-order vector; exploded."""
    sp = _sp(spark, sf)
    v = MD.fm_layer(DNN, D, "sum")
    return sp.select("sample_id", F.posexplode(v).alias("pos", "value")).select(
        "sample_id", F.col("pos").cast("bigint").alias("pos"), r9(F.col("value"), "value"))


# ---------------------------------------------------------------- M5 DNN, F19, F20, F21
def _dnn_sql(head=0, sizes=(WIDTH, *HIDDEN, 1), prefix="h"):
    ctes, last = Q.mlp_ctes("x0", head, list(sizes), prefix)
    return ctes, last


_DNN_CTES, _DNN_LAST = _dnn_sql()


@query("score_dnn", sql=with_ctes(*_sp_sql(), _x0_sql(), *_DNN_CTES,
                                  body=f"SELECT sample_id, round(v, 6) AS logit, round({Q.sigmoid('v')}, 6) AS p FROM {_DNN_LAST}"))
def q_score_dnn(spark, sf):
    """DNN tower: embeddings of the dnn role + dense inputs → 16 → 8 → logit."""
    sp = _sp(spark, sf)
    z = MD.mlp_logit(_x(), WIDTH, 0, HIDDEN)
    return sp.select("sample_id", z.alias("logit")).select(
        "sample_id", r(F.col("logit"), "logit"), r(sigmoid("logit"), "p"))


@query("two_class_outputs", sql=with_ctes(*_sp_sql(), _x0_sql(), *_DNN_CTES, f"pp AS (SELECT sample_id, {Q.sigmoid('v')} AS p FROM {_DNN_LAST})",
                                          body="SELECT sample_id, round(1 - p, 6) AS p0, round(p, 6) AS p1, CAST(p > 0.5 AS BIGINT) AS class_id FROM pp"))
def q_two_class_outputs(spark, sf):
    """[1-p, p] and the arg-max class id."""
    sp = _sp(spark, sf)
    p = sigmoid(MD.mlp_logit(_x(), WIDTH, 0, HIDDEN))
    o = sp.select("sample_id", p.alias("p"))
    p0, p1, cls = MD.two_class_outputs(F.col("p"))
    return o.select("sample_id", r(p0, "p0"), r(p1, "p1"), cls)


_L1_CTES, _L1 = Q.mlp_ctes("x0", 7, [WIDTH, 8], "d", hidden_only=True)


@query("dense_relu", sql=with_ctes(*_sp_sql(), _x0_sql(), *_L1_CTES, body=f"""
SELECT any_value(sample_id) AS sample_id, CAST(sum(CASE WHEN v > 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_units,
       round(sum(v), 9) AS total FROM {_L1} GROUP BY rid"""))
def q_dense_relu(spark, sf):
    """One dense relu layer (8 units) per sample: active units and sum."""
    sp = _sp(spark, sf)
    h = MD.dense_layer(_x(), WIDTH, 8, head=7)
    o = sp.select("sample_id", h.alias("h"))
    return o.select("sample_id", F.size(F.filter("h", lambda v: v > 0)).cast("bigint").alias("active_units"),
                    r9(F.aggregate("h", F.lit(0.0), lambda a, v: a + v), "total"))


@query("batch_norm", sql=with_ctes(*_sp_sql(), _x0_sql(), *_L1_CTES, f"""
st AS (SELECT i, avg(v) AS m, var_pop(v) AS s2 FROM {_L1} GROUP BY i)""", body=f"""
SELECT any_value(h.sample_id) AS sample_id, round(sum((h.v - st.m) / sqrt(st.s2 + 0.001)), 6) AS bn_total
FROM {_L1} h JOIN st ON h.i = st.i GROUP BY h.rid"""))
def q_batch_norm(spark, sf):
    """Batch normalisation with frozen population statistics of the layer."""
    sp = _sp(spark, sf)
    o = sp.select("sample_id", MD.dense_layer(_x(), WIDTH, 8, head=7).alias("h"))
    bn = MD.batch_norm_frozen(o, "h", 8)
    return bn.select("sample_id", r(F.aggregate("h_bn", F.lit(0.0), lambda a, v: a + v), "bn_total"))


# ---------------------------------------------------------------- M6 DeepFM, M7 Wide&Deep, M8 shared input
FM_COLS = [f"lin_{f}" for f in DNN]
_DEEP_CTES, _DEEP_LAST = Q.mlp_ctes("x0", 3, [WIDTH, *HIDDEN], "g", hidden_only=True)
_DFM_FINAL_FID = 1040


def _poly_sql(d):
    s = " + ".join(f"e_{f}_{d}" for f in DNN)
    q = " + ".join(f"e_{f}_{d} * e_{f}_{d}" for f in DNN)
    return f"0.5 * (({s}) * ({s}) - ({q}))"


@query("score_deepfm", sql=with_ctes(*_sp_sql(lin=DNN), _x0_sql(), *_DEEP_CTES,
                                     Q.long_vector_cte("fmp", FM_COLS + [_poly_sql(d) for d in range(D)]),
                                     f"""allp AS (SELECT rid, sample_id, i, v FROM fmp UNION ALL
                                                  SELECT rid, sample_id, i + {len(DNN) + D}, v FROM {_DEEP_LAST})""",
                                     f"""z AS (SELECT any_value(sample_id) AS sample_id, sum(v * {Q.init_value(str(_DFM_FINAL_FID), 'i', '0')}) AS logit
                                             FROM allp GROUP BY rid)""",
                                     body=f"SELECT sample_id, round(logit, 6) AS logit, round({Q.sigmoid('logit')}, 6) AS p FROM z"))
def q_score_deepfm(spark, sf):
    """DeepFM: [per-field linear outputs, FM second-order vector, DNN hidden]
    → one bias-free dense unit (+ bias 0) → sigmoid."""
    sp = _sp(spark, sf, lin=DNN)
    fm_part = F.array(*[F.col(c) for c in FM_COLS], *MD.poly_vector(DNN, D))
    n_fm = len(DNN) + D
    z = MD.deepfm_logit(F.concat(fm_part, _x()), n_fm, WIDTH, 3, HIDDEN, _DFM_FINAL_FID)
    return sp.select("sample_id", z.alias("logit")).select(
        "sample_id", r(F.col("logit"), "logit"), r(sigmoid("logit"), "p"))


LIN_ALL = [f.name for f in li_spec().categorical()]
_WD_CTES, _WD_LAST = Q.mlp_ctes("x0", 2, [WIDTH, *HIDDEN, 1], "w")


@query("score_wide_deep", sql=with_ctes(*_sp_sql(lin=LIN_ALL), _x0_sql(), *_WD_CTES, f"""
z AS (SELECT sp.sample_id, {' + '.join('sp.lin_' + f for f in LIN_ALL)} + {Q.init_value('-1', '0')} AS wide, d.v AS deep
      FROM sp JOIN {_WD_LAST} d ON sp.rid = d.rid)""", body=f"""
SELECT sample_id, round(wide, 6) AS wide, round(deep, 6) AS deep, round({Q.sigmoid('wide + deep')}, 6) AS p FROM z"""))
def q_score_wide_deep(spark, sf):
    """Wide (all linear ids + bias) and deep (DNN) logits added → sigmoid."""
    sp = _sp(spark, sf, lin=LIN_ALL)
    wide = sum((F.col(f"lin_{f}") for f in LIN_ALL[1:]), F.col(f"lin_{LIN_ALL[0]}")) + init_value(F.lit(-1), F.lit(0))
    deep = MD.mlp_logit(_x(), WIDTH, 2, HIDDEN)
    o = sp.select("sample_id", wide.alias("wide"), deep.alias("deep"))
    return o.select("sample_id", r(F.col("wide"), "wide"), r(F.col("deep"), "deep"),
                    r(sigmoid(F.col("wide") + F.col("deep")), "p"))


@query("shared_input", sql=with_ctes(*_sp_sql(lin=DNN), Q.long_vector_cte(
    "blk", FM_COLS + [_poly_sql(d) for d in range(D)] + X0_COLS), body="""
SELECT any_value(sample_id) AS sample_id, count(*) AS width, round(sum(v), 6) AS total, round(sum(v * v), 6) AS sq
FROM blk GROUP BY rid"""))
def q_shared_input(spark, sf):
    """Shared input block concat(linear outputs, FM vector, dense part),
    summarised per sample (width, Σ, Σ²)."""
    sp = _sp(spark, sf, lin=DNN)
    blk = F.concat(F.array(*[F.col(c) for c in FM_COLS], *MD.poly_vector(DNN, D)), _x())
    o = sp.select("sample_id", blk.alias("b"))
    return o.select("sample_id", F.size("b").cast("bigint").alias("width"),
                    r(F.aggregate("b", F.lit(0.0), lambda a, v: a + v), "total"),
                    r(F.aggregate("b", F.lit(0.0), lambda a, v: a + v * v), "sq"))


# ---------------------------------------------------------------- M9 / M10 ESMM, F24
def _esmm_sql(shared_units=None):
    ctes = []
    src, w = "x0", WIDTH
    if shared_units:
        c, src = Q.mlp_ctes("x0", 5, [WIDTH, shared_units], "s", hidden_only=True)
        ctes += c
        w = shared_units
    c0, l0 = Q.mlp_ctes(src, 0, [w, *HIDDEN, 1], "c")
    c1, l1 = Q.mlp_ctes(src, 1, [w, *HIDDEN, 1], "v")
    ctes += c0 + c1
    ctes.append(f"""pz AS (SELECT a.rid, a.sample_id, {Q.sigmoid('a.v')} AS p_ctr, {Q.sigmoid('b.v')} AS p_cvr
                    FROM {l0} a JOIN {l1} b ON a.rid = b.rid)""")
    return ctes


@query("score_esmm", sql=with_ctes(*_sp_sql(), _x0_sql(), *_esmm_sql(), body="""
SELECT sample_id, round(p_ctr, 6) AS p_ctr, round(p_cvr, 6) AS p_cvr, round(p_ctr * p_cvr, 6) AS p_ctcvr FROM pz"""))
def q_score_esmm(spark, sf):
    """ESMM: click and conversion towers on one input; p_ctcvr = p_ctr·p_cvr."""
    sp = _sp(spark, sf)
    h = MD.esmm_heads(_x(), WIDTH, HIDDEN)
    o = sp.select("sample_id", h.alias("h"))
    return o.select("sample_id", r(F.col("h.p_ctr"), "p_ctr"), r(F.col("h.p_cvr"), "p_cvr"),
                    r(F.col("h.p_ctcvr"), "p_ctcvr"))


@query("score_esmm_shared", sql=with_ctes(*_sp_sql(), _x0_sql(), *_esmm_sql(32), body="""
SELECT sample_id, round(p_ctr, 6) AS p_ctr, round(p_cvr, 6) AS p_cvr, round(p_ctr * p_cvr, 6) AS p_ctcvr FROM pz"""))
def q_score_esmm_shared(spark, sf):
    """ESMM with a shared 32-unit relu layer before both towers."""
    sp = _sp(spark, sf)
    h = MD.esmm_heads(_x(), WIDTH, HIDDEN, shared_units=32)
    o = sp.select("sample_id", h.alias("h"))
    return o.select("sample_id", r(F.col("h.p_ctr"), "p_ctr"), r(F.col("h.p_cvr"), "p_cvr"),
                    r(F.col("h.p_ctcvr"), "p_ctcvr"))


@query("prob_outputs", sql=with_ctes(*_sp_sql(), _x0_sql(), *_esmm_sql(), body="""
SELECT sample_id, 'ctr' AS name, CAST(0 AS BIGINT) AS pos, round(p_ctr, 6) AS value FROM pz UNION ALL
SELECT sample_id, 'ctcvr', CAST(1 AS BIGINT), round(p_ctr * p_cvr, 6) FROM pz"""))
def q_prob_outputs(spark, sf):
    """Exported probability vector in [ctr, ctcvr] order, as named rows."""
    sp = _sp(spark, sf)
    o = sp.select("sample_id", MD.esmm_heads(_x(), WIDTH, HIDDEN).alias("h"))
    packed = F.array(F.struct(F.lit("ctr").alias("name"), F.col("h.p_ctr").alias("value")),
                     F.struct(F.lit("ctcvr").alias("name"), F.col("h.p_ctcvr").alias("value")))
    return o.select("sample_id", F.posexplode(packed).alias("pos", "x")).select(
        "sample_id", F.col("x.name").alias("name"), F.col("pos").cast("bigint").alias("pos"), r(F.col("x.value"), "value"))


# ---------------------------------------------------------------- M11 MMoE
N_EXP, UNITS, TOWER = 3, 8, [4]


def _mmoe_sql():
    iv = Q.init_value
    ctes = [
        f"""ex AS (SELECT x.rid, e.e, r.j AS u,
               greatest(sum(x.v * {iv('4000 + e.e', 'x.i', 'r.j')}) + {iv('4100 + e.e', '0', 'r.j')}, 0) AS v
               FROM x0 x, range({N_EXP}) e(e), range({UNITS}) r(j) GROUP BY x.rid, e.e, r.j)""",
        f"""gz AS (SELECT x.rid, t.t, g.g AS e,
               sum(x.v * {iv('4200 + t.t', 'x.i', 'g.g')}) + {iv('4300 + t.t', '0', 'g.g')} AS z
               FROM x0 x, range(2) t(t), range({N_EXP}) g(g) GROUP BY x.rid, t.t, g.g)""",
        "gm AS (SELECT *, max(z) OVER (PARTITION BY rid, t) AS zm FROM gz)",
        "gate AS (SELECT rid, t, e, exp(z - zm) / sum(exp(z - zm)) OVER (PARTITION BY rid, t) AS g FROM gm)",
        """mix AS (SELECT ex.rid, gate.t, ex.u AS i, sum(gate.g * ex.v) AS v
               FROM ex JOIN gate ON ex.rid = gate.rid AND ex.e = gate.e GROUP BY ex.rid, gate.t, ex.u)""",
        f"""tw1 AS (SELECT x.rid, x.t, r.j AS i,
               greatest(sum(x.v * {iv('1000 + 10 * (20 + x.t)', 'x.i', 'r.j')}) + {iv('2000 + 10 * (20 + x.t)', '0', 'r.j')}, 0) AS v
               FROM mix x, range({TOWER[0]}) r(j) GROUP BY x.rid, x.t, r.j)""",
        f"""tw2 AS (SELECT x.rid, x.t, sum(x.v * {iv('1000 + 10 * (20 + x.t) + 1', 'x.i', '0')}) AS logit
               FROM tw1 x GROUP BY x.rid, x.t)""",
        f"""pz0 AS (SELECT rid, max(CASE WHEN t = 0 THEN {Q.sigmoid('logit')} END) AS p_ctr,
               max(CASE WHEN t = 1 THEN {Q.sigmoid('logit')} END) AS p_cvr FROM tw2 GROUP BY rid)""",
        "pz AS (SELECT pz0.*, sp.sample_id FROM pz0 JOIN sp ON pz0.rid = sp.rid)"]
    return ctes


@query("score_mmoe", sql=with_ctes(*_sp_sql(), _x0_sql(), *_mmoe_sql(), body="""
SELECT sample_id, round(p_ctr, 6) AS p_ctr, round(p_cvr, 6) AS p_cvr, round(p_ctr * p_cvr, 6) AS p_ctcvr FROM pz"""))
def q_score_mmoe(spark, sf):
    """MMoE: 3 relu experts × 8 units, per-task softmax gates, task towers."""
    sp = _sp(spark, sf)
    h = MD.mmoe_heads(_x(), WIDTH, N_EXP, UNITS, TOWER)
    o = sp.select("sample_id", h.alias("h"))
    return o.select("sample_id", r(F.col("h.p_ctr"), "p_ctr"), r(F.col("h.p_cvr"), "p_cvr"),
                    r(F.col("h.p_ctcvr"), "p_ctcvr"))


# ---------------------------------------------------------------- M12 two-tower, O4 top-k
EMB_DIM = 64


def _towers(spark, sf):
    """Item tower = stored 64-d embedding (vec_id = item k); user tower =
    mean of the item vectors the user clicked (one aggregate per user)."""
    ev = samples_ev(spark, sf)
    items = read_table(spark, sf, "embeddings", ["vec_id", "embedding"]).select(
        F.col("vec_id").alias("touid"), F.col("embedding").cast("array<double>").alias("ivec"))
    clicked = ev.where(F.col("y_ctr") == 1).select("uid", "touid").join(items, "touid")
    users = clicked.groupBy("uid").agg(*[F.avg(F.col("ivec").getItem(d)).alias(f"u{d}") for d in range(EMB_DIM)])
    users = users.select("uid", F.array(*[F.col(f"u{d}") for d in range(EMB_DIM)]).alias("uvec"))
    return ev, users, items


TOWER_SQL = [SAMPLES_EV_SQL, """
items AS (SELECT vec_id AS touid, i - 1 AS d, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(i))""", """
users AS (SELECT e.uid, it.d, avg(it.v) AS v FROM samples_ev e JOIN items it ON e.touid = it.touid
          WHERE e.y_ctr = 1 GROUP BY e.uid, it.d)""", """
dots AS (SELECT e.sample_id, e.uid, e.touid, sum(u.v * it.v) AS score
         FROM samples_ev e JOIN users u ON e.uid = u.uid JOIN items it ON it.touid = e.touid AND it.d = u.d
         GROUP BY e.sample_id, e.uid, e.touid)"""]


@query("score_two_tower", sql=with_ctes(*TOWER_SQL, body=f"""
SELECT sample_id, round(score, 6) AS score, round({Q.sigmoid('score')}, 6) AS p FROM dots"""))
def q_score_two_tower(spark, sf):
    """sigmoid(user · item) for every impression whose user has a tower
    vector and whose item has an embedding (inner joins)."""
    ev, users, items = _towers(spark, sf)
    j = ev.select("sample_id", "uid", "touid").join(users, "uid").join(items, "touid")
    s = j.select("sample_id", MD.dot(F.col("uvec"), F.col("ivec")).alias("score"))
    return s.select("sample_id", r(F.col("score"), "score"), r(sigmoid("score"), "p"))


K = 5
SALT = 16


@query("topk_retrieval", headline=True, sql=with_ctes(*TOWER_SQL, f"""
cand AS (SELECT DISTINCT uid, touid, round(score, 9) AS score FROM dots)""", body=f"""
SELECT uid, CAST(rk AS BIGINT) AS rank, touid, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, touid) AS rk FROM cand) WHERE rk <= {K}"""))
def q_topk_retrieval(spark, sf):
    """Top-k items per user among the user's candidate items (impressions),
    ranked by the two-tower dot product. Two-stage: top-k inside
    (user, item-hash salt) partitions, then top-k of those ≤ salt·k rows per
    user — a user holding a third of all rows still spreads over `SALT`
    tasks."""
    ev, users, items = _towers(spark, sf)
    cand = ev.select("uid", "touid").distinct().join(users, "uid").join(items, "touid")
    sc = cand.select("uid", "touid", F.round(MD.dot(F.col("uvec"), F.col("ivec")), 9).alias("score"))
    sc = sc.withColumn("salt", F.pmod(F.xxhash64("touid"), F.lit(SALT)))
    order = [F.col("score").desc(), F.col("touid")]
    w1 = Window.partitionBy("uid", "salt").orderBy(*order)
    stage1 = sc.withColumn("rk1", F.row_number().over(w1)).where(F.col("rk1") <= K)
    w2 = Window.partitionBy("uid").orderBy(*order)
    top = stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= K)
    return top.select("uid", F.col("rank").cast("bigint").alias("rank"), "touid", r(F.col("score"), "score"))
