"""Model scoring as DataFrame transforms; parameters are tables.

Sparse parts (linear weights, FM vectors, embeddings) are joins on the long
id table followed by one per-sample aggregate. Dense parts (DNN towers,
experts, gates) are small matrices shipped to tasks once and applied to
Arrow batches with numpy (``dense_forward``), never per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.features import compile_features
from rankforge.operators.lookup import (BIAS_FID, ROW_ID, checked_params, fits_broadcast, gather_fold, gather_sums, id_fields, linear_lookup,
                                        long_ids, maybe_broadcast, param_table, scalar_param, with_row_id)
from rankforge.operators.metrics import sigmoid
from rankforge.spec import FeatureSpec


# ---------------------------------------------------------------- M1 linear / wide
def score_lr(samples: DataFrame, spec: FeatureSpec, weights: DataFrame | None = None,
             id_col: str = "sample_id", keep=(), role: str | None = None,
             logit_digits: int | None = None) -> DataFrame:
    """Σ weights of the sample's ids + bias → sigmoid. ``weights`` is a
    ``(fid, bucket, w)`` table (bias row fid = -1); default: deterministic.
    ``logit_digits`` rounds the summed logit so that ties do not depend on
    summation order (exact AUC gives ties half credit)."""
    names = None if role is None else {f.name for f in spec.role(role, emitted_only=False)}
    fields = id_fields(spec, names)
    if weights is None:
        weights = param_table(samples.sparkSession, fields)
    feats = compile_features(samples, spec, keep=[id_col, *keep])
    if fits_broadcast(fields):
        # bounded tables: map-side gathers folded into a running logit
        bias = scalar_param(weights, BIAS_FID) or 0.0
        g = gather_fold(feats, fields, weights, [(F.col("w"), "w")], {"logit": F.lit(float(bias))},
                        lambda acc, got: {"logit": acc["logit"] + got["w"]})
        s = g.select(id_col, *keep, "logit")
    else:
        ids = long_ids(with_row_id(feats), fields, ROW_ID, keep=(id_col, *keep), with_bias=True)
        s = linear_lookup(ids, maybe_broadcast(weights, fields), ROW_ID, (id_col, *keep)).drop(ROW_ID)
    if logit_digits is not None:
        s = s.withColumn("logit", F.round("logit", logit_digits))
    return s.withColumn("p", sigmoid("logit"))


# ---------------------------------------------------------------- M2 / M3 factorization machine
def score_fm(samples: DataFrame, spec: FeatureSpec, dim: int = 4, numeric=(), id_col: str = "sample_id",
             keep=(), bias: float = 0.0, params: DataFrame | None = None) -> DataFrame:
    """M2/M3: FM over the spec's categorical ids plus ``numeric`` value fields
    (vocabulary of one, value multiplies weight and vector):
    logit = Σ x·w + ½Σ_d((Σ x·v_d)² − Σ (x·v_d)²) + bias. Inputs come from
    ``sparse_inputs`` (map-side gathers for bounded tables, one shuffle
    otherwise); ``params`` = trained table ``(fid, bucket, w, vec)``; the identity is per-row arithmetic, no pairwise expansion."""
    from rankforge.operators.models import sparse_inputs
    cats = [f.name for f in spec.categorical()]
    fields = id_fields(spec)
    base = len(spec.features)
    num = [(c, base + i) for i, c in enumerate(numeric)]
    tables = fields + [(c, fid, 1, False) for c, fid in num]
    if fits_broadcast(tables, dim):
        spark = samples.sparkSession
        both = param_table(spark, tables, dim=dim, with_bias=False, with_w=True) if params is None else checked_params(params, tables)
        feats = compile_features(samples, spec, keep=[id_col, *keep, *numeric])
        part = [F.coalesce(F.col("vec").getItem(d), F.lit(0.0)) for d in range(dim)]
        g = gather_sums(feats, fields, both, [F.col("w"), sum((v * v for v in part[1:]), part[0] * part[0]), *part])
        g = g.select(*[c for c in g.columns if c != "_sums"],
                     *[F.col("_sums")[i].alias(c) for i, c in enumerate(["_lin", "_q", *(f"_s{d}" for d in range(dim))])])
        # numeric fields: x·w and x·v with their single parameter row each (one small read)
        rows = {r.fid: r for r in both.where(F.col("fid").isin([f for _, f in num])).select("fid", "w", "vec").collect()} if num else {}
        for c, fid in num:
            if fid not in rows:
                continue
            x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            xv = [x * F.lit(float(v)) for v in rows[fid].vec]
            g = g.select(*[k for k in g.columns if not k.startswith("_") or k == id_col],
                         (F.col("_lin") + x * F.lit(float(rows[fid].w))).alias("_lin"),
                         (F.col("_q") + sum((v * v for v in xv[1:]), xv[0] * xv[0])).alias("_q"),
                         *[(F.col(f"_s{d}") + xv[d]).alias(f"_s{d}") for d in range(dim)])
        sq = sum((F.col(f"_s{d}") * F.col(f"_s{d}") for d in range(1, dim)), F.col("_s0") * F.col("_s0"))
        t = g.select(id_col, *keep, F.col("_lin").alias("linear"), (F.lit(0.5) * (sq - F.col("_q"))).alias("pair"))
        logit = F.col("linear") + F.col("pair") + F.lit(bias)
        return t.withColumn("logit", logit).withColumn("p", sigmoid(logit))
    sp = sparse_inputs(samples, spec, dim, cats, cats, numeric, id_col=id_col, keep=keep, params=params)
    fields = cats + list(numeric)
    linear = sum((F.col(f"lin_{f}") for f in fields[1:]), F.col(f"lin_{fields[0]}"))
    sq, q = None, None
    for d in range(dim):
        s_d = sum((F.col(f"e_{f}_{d}") for f in fields[1:]), F.col(f"e_{fields[0]}_{d}"))
        q_d = sum((F.col(f"e_{f}_{d}") * F.col(f"e_{f}_{d}") for f in fields[1:]),
                  F.col(f"e_{fields[0]}_{d}") * F.col(f"e_{fields[0]}_{d}"))
        sq = s_d * s_d if sq is None else sq + s_d * s_d
        q = q_d if q is None else q + q_d
    pair = F.lit(0.5) * (sq - q)
    t = sp.select(id_col, *keep, linear.alias("linear"), pair.alias("pair"))
    logit = F.col("linear") + F.col("pair") + F.lit(bias)
    return t.withColumn("logit", logit).withColumn("p", sigmoid(logit))


# ---------------------------------------------------------------- N1 model registry
def model_registry() -> dict:
    """Name → scoring function (``(samples, spec, ...) -> DataFrame``)."""
    from rankforge.operators import models as MD
    return {"lr": score_lr, "wide": score_lr, "fm": score_fm, "fm_layer": MD.fm_layer, "dnn": MD.mlp_logit,
            "deepfm": MD.deepfm_logit, "esmm": MD.esmm_heads, "mmoe": MD.mmoe_heads, "two_tower": MD.dot}


def get_model(name: str):
    reg = model_registry()
    if name not in reg:
        raise KeyError(f"unknown model {name!r}; known: {sorted(reg)}")
    return reg[name]
