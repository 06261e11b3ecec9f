"""Dense model parts: sparse-to-dense input assembly, MLP towers, FM layer,
DeepFM, Wide & Deep, ESMM, MMoE, two-tower.

Input assembly is one join of the long id table with the (broadcast when
bounded) parameter tables and ONE per-sample aggregate of conditional sums
(``lin_<field>``, ``e_<field>_<d>``) — partial aggregation collapses a
sample's ids before the shuffle. Dense layers are small matrices (size fixed
by the network shape, not the data) applied to Arrow batches with numpy in a
pandas UDF — vectorised, no per-row Python.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.features import compile_features
from rankforge.operators.lookup import (ROW_ID, checked_params, fits_broadcast, gather_columns, gather_pair, id_fields, long_ids,
                                        maybe_broadcast, param_table, with_row_id)
from rankforge.spec import FeatureSpec

# Dense heads run inside Python workers: ship this module's functions by
# value so tasks do not depend on the package being installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---------------------------------------------------------------- deterministic dense parameters
def init_matrix(fid: int, rows: int, cols: int) -> np.ndarray:
    """Same rule as ``lookup.init_value``: ((f·7919 + i·104729 + j·1299709) mod 2001 − 1000)/10⁴."""
    i = np.arange(rows, dtype=np.int64)[:, None]
    j = np.arange(cols, dtype=np.int64)[None, :]
    return ((fid * 7919 + i * 104729 + j * 1299709) % 2001 - 1000) / 10000.0


def dense_param(dense: dict | None, fid: int, rows: int, cols: int) -> np.ndarray:
    """Dense parameter ``fid`` of a trained model (``{fid: array}``), or its initial values."""
    if dense is None or fid not in dense:
        return init_matrix(fid, rows, cols)
    if dense[fid].shape != (rows, cols):
        raise ValueError(f"dense parameter {fid} has shape {dense[fid].shape}, the network needs {(rows, cols)}")
    return dense[fid]


def mlp_params(head: int, sizes, out_bias: bool = False, dense: dict | None = None) -> list:
    """Layers for sizes [in, h1, ..., out]: W from fid 1000+10·head+l, bias
    from fid 2000+10·head+l; hidden layers relu; the output layer is linear
    and (as in the prediction layers) bias-free unless ``out_bias``. ``dense``
    holds trained parameters."""
    layers = []
    n = len(sizes) - 1
    for l in range(n):
        W = dense_param(dense, 1000 + 10 * head + l, sizes[l], sizes[l + 1])
        last = l == n - 1
        b = (np.zeros(sizes[l + 1]) if last and not out_bias
             else dense_param(dense, 2000 + 10 * head + l, 1, sizes[l + 1])[0])
        layers.append((W, b, None if last else "relu"))
    return layers


def forward(X: np.ndarray, layers) -> np.ndarray:
    h = X
    for W, b, act in layers:
        h = h @ W + b
        if act == "relu":
            h = np.maximum(h, 0.0)
    return h


def _matrix(s: pd.Series, width: int) -> np.ndarray:
    if len(s) == 0:
        return np.zeros((0, width))
    return np.vstack(s.to_numpy()).astype(np.float64)


def dense_apply(x: Column, width: int, fn, out_fields) -> Column:
    """Apply ``fn(X[n, width]) -> {name: 1-d or 2-d array}`` to an
    array<double> column batch-wise; returns a struct column."""
    fields = []
    for name, kind in out_fields:
        fields.append(T.StructField(name, T.ArrayType(T.DoubleType()) if kind == "vec" else T.DoubleType()))
    schema = T.StructType(fields)

    @F.pandas_udf(schema)
    def _udf(s: pd.Series) -> pd.DataFrame:
        out = fn(_matrix(s, width))
        cols = {}
        for name, kind in out_fields:
            v = out[name]
            cols[name] = list(v) if kind == "vec" else np.asarray(v, dtype=np.float64).reshape(-1)
        return pd.DataFrame(cols)

    return _udf(x)


# ---------------------------------------------------------------- sparse → dense inputs
def sparse_inputs(samples: DataFrame, spec: FeatureSpec, dim: int, lin_fields=(), emb_fields=(),
                  numeric=(), id_col: str = "sample_id", keep=(), shared: dict | None = None,
                  params: DataFrame | None = None) -> DataFrame:
    """Per sample: ``lin_<f>`` (Σ linear weights of field f) and
    ``e_<f>_<d>`` (sum-combined embedding of field f); numeric fields get
    ``lin_<c> = x·w`` and ``e_<c>_<d> = x·v``. ``shared`` maps a field to
    ``(table_fid, n_ids)`` of the one table several fields read (J4).
    ``params`` = trained table ``(fid, bucket, w, vec)``; ids it does not hold
    read zeros. One join, one aggregate."""
    spark = samples.sparkSession
    idx = spec.field_index()
    names = set(lin_fields) | set(emb_fields)
    cat = [f for f in id_fields(spec) if f[0] in names]
    base = len(spec.features)
    num = [(c, base + i) for i, c in enumerate(numeric)]
    feats = compile_features(samples, spec, keep=[id_col, *keep, *numeric])
    tables = cat + [(c, fid, 1, False) for c, fid in num]
    if shared:
        tables += [(f"shared_{t}", t, n, False) for t, n in set(shared.values())]
    if params is None:
        vec_t = param_table(spark, tables, dim=dim, with_bias=False, with_w=True)
        w_t = param_table(spark, cat + [(c, fid, 1, False) for c, fid in num], with_bias=False)
    else:
        vec_t = w_t = checked_params(params, tables)
    if fits_broadcast(tables, dim):
        return _sparse_inputs_wide(feats, cat, num, dim, lin_fields, emb_fields, shared or {}, vec_t, w_t,
                                   id_col, keep)
    ids = long_ids(with_row_id(feats), cat, ROW_ID, keep=(id_col, *keep), numeric=num, with_bias=True)
    if shared:
        ids = ids.withColumn("tfid", F.col("fid"))
        for fld, (tfid, _n) in shared.items():
            ids = ids.withColumn("tfid", F.when(F.col("field") == fld, F.lit(tfid)).otherwise(F.col("tfid")))
    else:
        ids = ids.withColumn("tfid", F.col("fid"))
    vec = maybe_broadcast(vec_t, tables, dim)
    w = maybe_broadcast(w_t, tables)
    j = (ids.join(w.select("fid", "bucket", "w"), ["fid", "bucket"], "left")
         .join(vec.select(F.col("fid").alias("tfid"), "bucket", "vec"), ["tfid", "bucket"], "left"))
    aggs = []
    for f in list(lin_fields) + [c for c in numeric]:
        aggs.append(F.coalesce(F.sum(F.when(F.col("field") == f, F.col("w") * F.col("value"))), F.lit(0.0))
                    .alias(f"lin_{f}"))
    for f in list(emb_fields) + [c for c in numeric]:
        for d in range(dim):
            aggs.append(F.coalesce(F.sum(F.when(F.col("field") == f, F.col("vec").getItem(d) * F.col("value"))),
                                   F.lit(0.0)).alias(f"e_{f}_{d}"))
    aggs += [F.any_value(k).alias(k) for k in (id_col, *keep)]
    return j.groupBy(ROW_ID).agg(*aggs).select(id_col, *keep, *_agg_names(lin_fields, emb_fields, numeric, dim))


def _sparse_inputs_wide(feats, cat, num, dim, lin_fields, emb_fields, shared, vec_t, w_t, id_col, keep):
    """Bounded tables: per-field broadcast gathers, all columns per row —
    no explode and no shuffle (the same outputs as the long path)."""
    g = feats
    lin_cat = [f for f in cat if f[0] in set(lin_fields)]
    emb_cat = [(f[0], shared[f[0]][0] if f[0] in shared else f[1], f[2], False)
               for f in cat if f[0] in set(emb_fields)]
    lin_names = {f[0] for f in lin_cat}
    # fields needing both a weight and a vector from the same table: one join
    both = [f for f in emb_cat if f[0] in lin_names and f[0] not in shared]
    both_names = {f[0] for f in both}
    if both:
        g = gather_pair(g, both, w_t, vec_t, dim)
    if [f for f in lin_cat if f[0] not in both_names]:
        g = gather_columns(g, [f for f in lin_cat if f[0] not in both_names], w_t, "w", "_w_")
    if [f for f in emb_cat if f[0] not in both_names]:
        g = gather_columns(g, [f for f in emb_cat if f[0] not in both_names], vec_t, "vec", "_v_", dim=dim)
    cols = [F.col(id_col), *[F.col(k) for k in keep]]
    for f in lin_fields:
        cols.append(F.coalesce(F.col(f"_w_{f}"), F.lit(0.0)).alias(f"lin_{f}"))
    # numeric fields: one parameter row each (bucket 0) — a bounded summary
    consts = {fid: ([0.0] * dim, 0.0) for _, fid in num}
    if num:
        for r in vec_t.where(F.col("fid").isin([fid for _, fid in num])).select("fid", "w", "vec").collect():
            consts[r.fid] = (list(r.vec), r.w)
    for c, fid in num:
        cols.append(F.coalesce(F.col(c).cast("double") * F.lit(float(consts[fid][1])), F.lit(0.0)).alias(f"lin_{c}"))
    for f in emb_fields:
        for d in range(dim):
            cols.append(F.coalesce(F.col(f"_v_{f}_{d}"), F.lit(0.0)).alias(f"e_{f}_{d}"))
    for c, fid in num:
        for d in range(dim):
            cols.append(F.coalesce(F.col(c).cast("double") * F.lit(float(consts[fid][0][d])), F.lit(0.0))
                        .alias(f"e_{c}_{d}"))
    return g.select(*cols)


def _agg_names(lin_fields, emb_fields, numeric, dim) -> list:
    names = [f"lin_{f}" for f in list(lin_fields) + list(numeric)]
    names += [f"e_{f}_{d}" for f in list(emb_fields) + list(numeric) for d in range(dim)]
    return names


def emb_array(fields, dim: int) -> Column:
    return F.array(*[F.col(f"e_{f}_{d}") for f in fields for d in range(dim)])


def poly_vector(fields, dim: int) -> list:
    """FM second order kept per dimension: ½((Σ_f e_fd)² − Σ_f e_fd²)."""
    out = []
    for d in range(dim):
        s = sum((F.col(f"e_{f}_{d}") for f in fields[1:]), F.col(f"e_{fields[0]}_{d}"))
        q = sum((F.col(f"e_{f}_{d}") * F.col(f"e_{f}_{d}") for f in fields[1:]),
                F.col(f"e_{fields[0]}_{d}") * F.col(f"e_{fields[0]}_{d}"))
        out.append(F.lit(0.5) * (s * s - q))
    return out


# ---------------------------------------------------------------- M4 FM layer on dense embeddings
def fm_layer(emb_fields, dim: int, first_order: str = "sum", weight_fid: int = 3000) -> Column:
    """concat(first order per feature (Σ or mean over its vector) × weight,
    second-order vector)."""
    lw = init_matrix(weight_fid, len(emb_fields), 1)[:, 0]
    first = []
    for k, f in enumerate(emb_fields):
        s = sum((F.col(f"e_{f}_{d}") for d in range(1, dim)), F.col(f"e_{f}_0"))
        if first_order == "mean":
            s = s / F.lit(float(dim))
        first.append(s * F.lit(float(lw[k])))
    return F.array(*first, *poly_vector(list(emb_fields), dim))


# ---------------------------------------------------------------- heads
def mlp_logit(x: Column, width: int, head: int, hidden, dense: dict | None = None) -> Column:
    layers = mlp_params(head, [width, *hidden, 1], dense=dense)
    return dense_apply(x, width, lambda X: {"logit": forward(X, layers)[:, 0]}, [("logit", "num")])["logit"]


def deepfm_logit(fm_and_x: Column, n_fm: int, width: int, head: int, hidden, final_fid: int,
                 dense: dict | None = None) -> Column:
    """M6: input = concat(fm_part, deep input). The deep part keeps relu +
    bias on every hidden layer (no output unit); one bias-free unit over
    [fm_part, deep hidden] gives the logit."""
    hid = {f: p for f, p in (dense or {}).items() if f != 1000 + 10 * head + len(hidden)}
    deep = [(W, b, "relu") for W, b, _ in mlp_params(head, [width, *hidden, 1], dense=hid)[:-1]]
    final = dense_param(dense, final_fid, n_fm + hidden[-1], 1)

    def fn(Xa):
        fm, x = Xa[:, :n_fm], Xa[:, n_fm:]
        return {"logit": (np.hstack([fm, forward(x, deep)]) @ final)[:, 0]}

    return dense_apply(fm_and_x, n_fm + width, fn, [("logit", "num")])["logit"]


def esmm_heads(x: Column, width: int, hidden, shared_units: int | None = None, dense: dict | None = None) -> Column:
    """p_ctr, p_cvr from two towers over one input (optionally after a
    shared relu layer); p_ctcvr = p_ctr · p_cvr ≤ p_ctr."""
    shared = [(dense_param(dense, 1050, width, shared_units), dense_param(dense, 2050, 1, shared_units)[0], "relu")] if shared_units else []
    w2 = shared_units or width
    ctr = mlp_params(0, [w2, *hidden, 1], dense=dense)
    cvr = mlp_params(1, [w2, *hidden, 1], dense=dense)

    def fn(X):
        h = X
        for W, b, _ in shared:
            h = np.maximum(h @ W + b, 0.0)
        pc = 1.0 / (1.0 + np.exp(-forward(h, ctr)[:, 0]))
        pv = 1.0 / (1.0 + np.exp(-forward(h, cvr)[:, 0]))
        return {"p_ctr": pc, "p_cvr": pv, "p_ctcvr": pc * pv}

    return dense_apply(x, width, fn, [("p_ctr", "num"), ("p_cvr", "num"), ("p_ctcvr", "num")])


def mmoe_params(width: int, n_experts: int, units: int, tasks: int, tower, dense: dict | None = None):
    def p(fid, rows, cols):
        return dense_param(dense, fid, rows, cols)
    experts = [(p(4000 + e, width, units), p(4100 + e, 1, units)[0]) for e in range(n_experts)]
    gates = [(p(4200 + t, width, n_experts), p(4300 + t, 1, n_experts)[0]) for t in range(tasks)]
    towers = [mlp_params(20 + t, [units, *tower, 1], dense=dense) for t in range(tasks)]
    return experts, gates, towers


def mmoe_heads(x: Column, width: int, n_experts: int = 3, units: int = 8, tower=(4,),
               task_names=("ctr", "cvr"), dense: dict | None = None) -> Column:
    """Experts relu(xW_e + b_e); per task softmax gate over experts;
    weighted expert mix → task tower → probability. Adds p_ctcvr."""
    experts, gates, towers = mmoe_params(width, n_experts, units, len(task_names), tower, dense)

    def fn(X):
        E = np.stack([np.maximum(X @ W + b, 0.0) for W, b in experts], axis=2)  # n, units, experts
        out = {}
        for t, name in enumerate(task_names):
            G, g = gates[t]
            z = X @ G + g
            z = z - z.max(axis=1, keepdims=True)
            gate = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            mix = (E * gate[:, None, :]).sum(axis=2)
            out[f"p_{name}"] = 1.0 / (1.0 + np.exp(-forward(mix, towers[t])[:, 0]))
        out["p_ctcvr"] = out["p_ctr"] * out["p_cvr"]
        return out

    fields = [(f"p_{n}", "num") for n in task_names] + [("p_ctcvr", "num")]
    return dense_apply(x, width, fn, fields)


def dense_layer(x: Column, width: int, units: int, head: int = 7, dense: dict | None = None) -> Column:
    """one dense relu layer (array<double> out)."""
    W, b = dense_param(dense, 1000 + 10 * head, width, units), dense_param(dense, 2000 + 10 * head, 1, units)[0]
    return dense_apply(x, width, lambda X: {"h": np.maximum(X @ W + b, 0.0)}, [("h", "vec")])["h"]


def softmax_cols(cols) -> list:
    """numerically stable softmax over a few logit columns."""
    m = F.greatest(*cols) if len(cols) > 1 else cols[0]
    ex = [F.exp(c - m) for c in cols]
    tot = sum(ex[1:], ex[0])
    return [e / tot for e in ex]


def two_class_outputs(p: Column) -> tuple:
    """[1-p, p] and the arg-max class (ties → class 0)."""
    return ((F.lit(1.0) - p).alias("p0"), p.alias("p1"), (p > F.lit(0.5)).cast("bigint").alias("class_id"))


def batch_norm_frozen(df: DataFrame, vec_col: str, units: int, eps: float = 1e-3) -> DataFrame:
    """per-unit population mean/variance over the whole dataset (one
    aggregate, a 2·units summary), then (h − μ)/√(σ² + ε) applied with
    frozen statistics — scores do not depend on batch mates."""
    stats = df.agg(*[F.avg(F.col(vec_col).getItem(u)).alias(f"m{u}") for u in range(units)],
                   *[F.var_pop(F.col(vec_col).getItem(u)).alias(f"v{u}") for u in range(units)]).first()
    cols = [(F.col(vec_col).getItem(u) - F.lit(float(stats[f"m{u}"]))) /
            F.lit(float(np.sqrt(stats[f"v{u}"] + eps))) for u in range(units)]
    return df.withColumn(vec_col + "_bn", F.array(*cols))


def dot(a: Column, b: Column) -> Column:
    """u·v (the reference's "cosine" without normalisation)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


# ---------------------------------------------------------------- F13 / F14 / F16 from the spec
def spec_embeddings(samples: DataFrame, spec: FeatureSpec, tables: dict | None = None,
                    id_col: str = "sample_id", keep=()) -> DataFrame:
    """Compile the spec's ``embedding`` and ``shared_embedding`` sections.

    Each section owns one table keyed by the section's fid (a shared section
    is read by all its ``cat_col`` inputs). Scalar inputs are gathered with a
    size-checked broadcast; list inputs are exploded, joined and combined per
    row (``combiner`` sum / mean / sqrtn). A section emits one array column;
    a shared section with several inputs emits their concatenation in
    ``cat_col`` order. ``tables`` = {section: (fid, bucket, vec) DataFrame};
    missing tables use the deterministic initialisation."""
    from rankforge.operators.lookup import embed_bag, gather_columns
    idx = spec.field_index()
    sections = [f for f in spec if f.ftype in ("embedding", "shared_embedding")]
    inputs = sorted({c for f in sections for c in f.cat_col})
    spark = samples.sparkSession
    out = with_row_id(compile_features(samples, spec, keep=[id_col, *keep], include=inputs))
    if any(spec[c].is_list or not fits_broadcast([(c, idx[sec.name], max(spec[x].n_ids() for x in sec.cat_col), False)],
                                                 sec.dimension) for sec in sections for c in sec.cat_col):
        # bags are joined back on the row id: it must not be computed twice
        from rankforge.session import cut_lineage
        out = cut_lineage(out)
    for sec in sections:
        fid = idx[sec.name]
        n = max(spec[c].n_ids() for c in sec.cat_col)
        dim = sec.dimension
        table = (tables or {}).get(sec.name)
        if table is None:
            table = param_table(spark, [(sec.name, fid, n, False)], dim=dim, with_bias=False)
        parts = []
        for c in sec.cat_col:
            col = f"_emb_{sec.name}_{c}"
            if spec[c].is_list or not fits_broadcast([(c, fid, n, False)], dim):
                ids = long_ids(out.select(ROW_ID, c), [(c, fid, n, spec[c].is_list)], ROW_ID)
                bag = embed_bag(ids, maybe_broadcast(table, [(c, fid, n, False)], dim), dim, sec.combiner,
                                group_cols=(ROW_ID,)).select(ROW_ID, F.col("vec").alias(col))
                out = out.join(bag, ROW_ID, "left")
            else:
                out = gather_columns(out, [(c, fid, n, False)], table, "vec", f"_emb_{sec.name}_", dim=dim)
                out = out.withColumn(col, F.array(*[F.coalesce(F.col(f"{col}_{d}"), F.lit(0.0))
                                                    for d in range(dim)])).drop(
                    *[f"{col}_{d}" for d in range(dim)])
            out = out.withColumn(col, F.coalesce(F.col(col), F.array_repeat(F.lit(0.0), dim)))
            parts.append(col)
        out = out.withColumn(sec.name, F.concat(*[F.col(p) for p in parts]) if len(parts) > 1 else F.col(parts[0]))
        out = out.drop(*parts)
    return out.drop(ROW_ID, *[c for c in inputs if not spec[c].is_out])


def spec_input_layer(df: DataFrame, spec: FeatureSpec, role: str, out: str = "input") -> tuple:
    """F16 from the spec: the role's emitted numeric features and embedding
    sections concatenated in name order; returns (DataFrame, width)."""
    cols, width = {}, 0
    for f in spec.role(role):
        if f.ftype == "numeric":
            cols[f.name] = (F.col(f.name), f.shape > 1)
            width += max(f.shape, 1)
        elif f.ftype in ("embedding", "shared_embedding"):
            cols[f.name] = (F.col(f.name), True)
            width += f.dimension * (len(f.cat_col) if f.ftype == "shared_embedding" else 1)
    from rankforge.functions.features import input_layer
    return df.withColumn(out, input_layer(cols)), width
