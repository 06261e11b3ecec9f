"""Id → parameter gathers as joins (linear weights, embeddings).

Samples are unpivoted once into a long id table ``(sample_id, field, fid,
bucket, value)``; parameter tables are keyed by ``(fid, bucket)``. A table is
broadcast only when its row count — known from the spec, not guessed — times
its row width fits the broadcast limit; bigger tables (hashed ids with
millions of buckets) go through a shuffled join where AQE splits hot buckets.
Aggregating back per sample happens map-side first (rows of one sample are
adjacent after the explode), so the shuffle carries one row per sample and
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import BROADCAST_LIMIT_BYTES, bounded_broadcast
from rankforge.spec import FeatureSpec

BIAS_FIELD = "__bias__"
BIAS_FID = -1


# ---------------------------------------------------------------- deterministic parameters
def init_value(fid, bucket, d=0) -> Column:
    """Deterministic parameter for (field, bucket, dim), in [-0.1, 0.1].
    Used to initialise tables reproducibly (and as demo model weights)."""
    def _b(x):
        return x.cast("bigint") if isinstance(x, Column) else F.lit(int(x))
    raw = (_b(fid) * 7919 + _b(bucket) * 104729 + _b(d) * 1299709) % 2001 - 1000
    return raw.cast("double") / F.lit(10000.0)


def id_fields(spec: FeatureSpec, names=None) -> list:
    """(name, fid, n_ids, is_list) for the categorical features of the spec."""
    idx = spec.field_index()
    out = []
    for f in spec.categorical():
        if names is not None and f.name not in names:
            continue
        out.append((f.name, idx[f.name], f.n_ids(), f.is_list))
    return out


def param_table(spark: SparkSession, fields, dim: int = 0, with_bias: bool = True,
                with_w: bool = False) -> DataFrame:
    """Parameter table over the whole id space of ``fields`` ((name, fid, n, …)).

    One ``spark.range`` over the summed id space, split across tasks; the
    (field, bucket) of each row comes from its offset, so a 5M-bucket field is
    generated in parallel, not by one task. ``dim == 0`` → scalar ``w``;
    otherwise ``vec array<double>`` of length ``dim``."""
    offs, total = [], 0
    for name, fid, n, *_ in fields:
        offs.append((name, fid, total, n))
        total += n
    if with_bias:
        offs.append((BIAS_FIELD, BIAS_FID, total, 1))
        total += 1
    r = spark.range(total)
    fid_expr, name_expr, base_expr = None, None, None
    for name, fid, start, n in offs:
        cond = F.col("id") < F.lit(start + n)
        fid_expr = F.when(cond, F.lit(fid)) if fid_expr is None else fid_expr.when(cond, F.lit(fid))
        name_expr = F.when(cond, F.lit(name)) if name_expr is None else name_expr.when(cond, F.lit(name))
        base_expr = F.when(cond, F.lit(start)) if base_expr is None else base_expr.when(cond, F.lit(start))
    t = r.select(name_expr.alias("field"), fid_expr.cast("bigint").alias("fid"),
                 (F.col("id") - base_expr).cast("bigint").alias("bucket"))
    if dim == 0:
        return t.withColumn("w", init_value(F.col("fid"), F.col("bucket")))
    t = t.withColumn("vec", F.array(*[init_value(F.col("fid"), F.col("bucket"), d) for d in range(dim)]))
    if with_w:  # linear weight and vector in one table (one gather per field)
        t = t.withColumn("w", init_value(F.col("fid"), F.col("bucket")))
    return t


def checked_params(table: DataFrame, fields) -> DataFrame:
    """A parameter table that a caller passes in, after one count by id: a table
    with an id twice (samples would multiply) or with more rows than the spec
    declares (its size bound would not hold) is an error."""
    known = {fid: n for _, fid, n, *_ in fields}
    found = table.where(F.col("fid").isin(sorted(known))).groupBy("fid", "bucket").agg(F.count("*").alias("n")) \
        .groupBy("fid").agg(F.max("n").alias("most"), F.count("*").alias("rows")).collect()
    for r in found:
        if r.most > 1:
            raise ValueError(f"parameter table: an id of table {r.fid} occurs {r.most} times")
        if r.rows > known[r.fid]:
            raise ValueError(f"parameter table: {r.rows} ids of table {r.fid}, the spec declares {known[r.fid]}")
    return table


def table_rows(fields, with_bias: bool = True) -> int:
    return sum(f[2] for f in fields) + (1 if with_bias else 0)


def maybe_broadcast(table: DataFrame, fields, dim: int = 0, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    row_bytes = 48 + 8 * max(dim, 1)
    return bounded_broadcast(table, table_rows(fields), row_bytes, limit)


def fits_broadcast(fields, dim: int = 0, limit: int = BROADCAST_LIMIT_BYTES,
                   total_limit: int = 4 * BROADCAST_LIMIT_BYTES) -> bool:
    """True when every field's slice of the table (n_ids rows, known from the
    spec) fits under the broadcast limit AND all slices together fit under
    ``total_limit`` (executors hold every slice at once) — then gathers are
    map-side. List-valued fields always take the long path."""
    row_bytes = 48 + 8 * max(dim, 1)
    sizes = [f[2] * row_bytes for f in fields]
    return (all(s <= limit for s in sizes) and sum(sizes) <= total_limit
            and not any(f[3] for f in fields))


def gather_fold(df: DataFrame, fields, table: DataFrame, values, init: dict, fold) -> DataFrame:
    """Wide-form gather that folds each field's gathered values into running
    accumulators right after its broadcast join, then drops them: rows stay
    narrow through the join chain and every projection stays small (one big
    fused expression over dozens of gathered columns compiles into code the
    JIT will not optimise). ``values`` = [(table column expr, name)];
    ``init`` = {acc: Column}; ``fold(acc_cols, gathered) -> {acc: Column}``."""
    out = df.select("*", *[c.alias(a) for a, c in init.items()])
    accs = list(init)
    for name, fid, _n, _is_list in fields:
        tag = f"_g_{name}"
        t = table.where(F.col("fid") == F.lit(fid)).select(
            F.col("bucket").alias(f"{tag}_b"), *[v.alias(f"{tag}_{k}") for v, k in values])
        j = out.join(F.broadcast(t), F.col(name) == F.col(f"{tag}_b"), "left")
        got = {k: F.coalesce(F.col(f"{tag}_{k}"), F.lit(0.0)) for _, k in values}
        new = fold({a: F.col(a) for a in accs}, got)
        keep = [c for c in out.columns if c not in accs and c != name]
        out = j.select(*keep, *[new[a].alias(a) for a in accs])
    return out


def gather_sums(df: DataFrame, fields, table: DataFrame, values, out: str = "_sums") -> DataFrame:
    """Wide-form gather that adds up several values: the broadcast join of a field adds
    one array of its ``values`` (table columns; null reads 0), and ``out`` has their sums
    over the fields, in field order. The sums are taken by array functions: so many
    additions as columns compile into one method that the JIT leaves interpreted."""
    j = df
    for name, fid, _n, _is_list in fields:
        t = table.where(F.col("fid") == F.lit(fid)).select(
            F.col("bucket").alias("_b"), F.array(*[F.coalesce(v, F.lit(0.0)) for v in values]).alias(f"_g_{name}"))
        keep = [c for c in j.columns if c != name]
        j = j.join(F.broadcast(t), F.col(name) == F.col("_b"), "left").select(*keep, f"_g_{name}")
    zeros, tags = F.array(*[F.lit(0.0)] * len(values)), [f"_g_{f[0]}" for f in fields]
    total = F.aggregate(F.array(*[F.coalesce(t, zeros) for t in tags]), zeros, lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    return j.select(*[c for c in j.columns if c not in tags], total.alias(out))


def gather_pair(df: DataFrame, fields, w_table: DataFrame, vec_table: DataFrame, dim: int,
                w_prefix: str = "_w_", v_prefix: str = "_v_") -> DataFrame:
    """Linear weight and vector of each field in ONE broadcast join per field
    (the two tables share (fid, bucket) keys)."""
    both = (vec_table if "w" in vec_table.columns else
            vec_table.select("fid", "bucket", "vec").join(w_table.select("fid", "bucket", "w"), ["fid", "bucket"], "full"))
    out = df
    for name, fid, _n, _is_list in fields:
        t = both.where(F.col("fid") == F.lit(fid)).select(
            F.col("bucket").alias(f"_b_{name}"), F.col("w").alias(f"{w_prefix}{name}"),
            *[F.col("vec").getItem(d).alias(f"{v_prefix}{name}_{d}") for d in range(dim)])
        out = out.join(F.broadcast(t), F.col(name) == F.col(f"_b_{name}"), "left").drop(f"_b_{name}")
    return out


def gather_columns(df: DataFrame, fields, table: DataFrame, value_col: str, prefix: str,
                   dim: int | None = None) -> DataFrame:
    """Wide-form gather: for each scalar id field, a broadcast hash join with
    that field's slice of the table adds ``<prefix><field>`` (null when the
    id is unknown/negative). All joins are map-side in one stage: no explode,
    no shuffle. Only for tables whose size bound was checked
    (``fits_broadcast``). With ``dim`` the vector is carried as ``dim``
    fixed-width columns ``<prefix><field>_<d>`` (cheaper to move through a
    chain of joins than array values)."""
    out = df
    for name, fid, _n, _is_list in fields:
        if dim is None:
            vals = [F.col(value_col).alias(f"{prefix}{name}")]
        else:
            vals = [F.col(value_col).getItem(d).alias(f"{prefix}{name}_{d}") for d in range(dim)]
        t = table.where(F.col("fid") == F.lit(fid)).select(F.col("bucket").alias(f"_b_{name}"), *vals)
        out = out.join(F.broadcast(t), F.col(name) == F.col(f"_b_{name}"), "left").drop(f"_b_{name}")
    return out


def scalar_param(table: DataFrame, fid: int, value_col: str = "w"):
    """One parameter (e.g. the bias row) as a Python value — a single row."""
    row = table.where(F.col("fid") == F.lit(fid)).select(value_col).first()
    return None if row is None else row[0]


ROW_ID = "_rid"


def with_row_id(df: DataFrame) -> DataFrame:
    """Internal per-row key for long-form aggregation: sample ids need not be
    unique (exact duplicate records), and grouping by them would merge rows.
    The id is derived from the partition and position, so a recomputed
    partition of the same deterministic input gets the same ids."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


# ---------------------------------------------------------------- long ids
def long_ids(df: DataFrame, fields, id_col: str = "sample_id", keep=(), numeric=(),
             with_bias: bool = False) -> DataFrame:
    """Unpivot id columns (scalar or list) to ``(id_col, field, fid, bucket,
    value, *keep)``. ``numeric`` adds (name, fid) value-carrying fields with
    bucket 0 (a vocabulary of one: ``x·w``). Negative / null ids are dropped
    (unknown vocabulary values, out-of-range identities, empty lists)."""
    parts = []

    def one(name, fid, bucket, value):
        return F.struct(F.lit(name).alias("field"), F.lit(int(fid)).cast("bigint").alias("fid"),
                        bucket.cast("bigint").alias("bucket"), value.cast("double").alias("value"))

    def tag(name, fid):
        return lambda b: one(name, fid, b, F.lit(1.0))

    for name, fid, _n, is_list in fields:
        if is_list:
            parts.append(F.transform(F.col(name), tag(name, fid)))
        else:
            parts.append(F.array(one(name, fid, F.col(name), F.lit(1.0))))
    for name, fid in numeric:
        parts.append(F.array(one(name, fid, F.lit(0), F.col(name))))
    if with_bias:
        parts.append(F.array(one(BIAS_FIELD, BIAS_FID, F.lit(0), F.lit(1.0))))
    cols = [F.col(id_col)] + [F.col(k) for k in keep]
    out = df.select(*cols, F.inline(F.concat(*parts)))
    return out.where(F.col("bucket").isNotNull() & (F.col("bucket") >= 0))


# ---------------------------------------------------------------- J1 linear
def linear_lookup(ids: DataFrame, weights: DataFrame, id_col: str = "sample_id", keep=()) -> DataFrame:
    """Σ value·w per sample (``sum`` combiner); ids missing from the table
    contribute 0 (left join)."""
    j = ids.join(weights.select("fid", "bucket", "w"), ["fid", "bucket"], "left")
    aggs = [F.sum(F.col("value") * F.coalesce(F.col("w"), F.lit(0.0))).alias("logit")]
    aggs += [F.any_value(k).alias(k) for k in keep]
    return j.groupBy(id_col).agg(*aggs)


# ---------------------------------------------------------------- J2/J3/A5 embeddings
def embed_lookup(ids: DataFrame, table: DataFrame) -> DataFrame:
    """Gather one vector per id row (``vec`` null when the id is unknown)."""
    return ids.join(table.select("fid", "bucket", "vec"), ["fid", "bucket"], "left")


def embed_bag(ids: DataFrame, table: DataFrame, dim: int, combiner: str = "sum",
              group_cols=("sample_id", "field"), keep=(), snap_digits: int | None = None) -> DataFrame:
    """Combine the vectors of a multi-valued field per sample: ``sum``,
    ``mean`` or ``sqrtn`` (sum / sqrt(count)). Per-dimension sums are plain
    aggregates, so partial aggregation happens before the shuffle. Empty
    lists have no rows; callers left-join to fill the zero vector."""
    j = embed_lookup(ids, table)
    vec = F.coalesce(F.col("vec"), F.array(*[F.lit(0.0)] * dim))
    aggs = [F.sum(vec.getItem(d) * F.col("value")).alias(f"s{d}") for d in range(dim)]
    aggs.append(F.count(F.lit(1)).alias("n_ids"))
    aggs += [F.any_value(k).alias(k) for k in keep]
    g = j.groupBy(*group_cols).agg(*aggs)
    if snap_digits is not None:
        for d in range(dim):
            g = g.withColumn(f"s{d}", F.round(F.col(f"s{d}") * F.lit(10.0 ** snap_digits)) / F.lit(10.0 ** snap_digits))
    if combiner == "sum":
        scale = F.lit(1.0)
    elif combiner == "mean":
        scale = F.lit(1.0) / F.col("n_ids")
    elif combiner == "sqrtn":
        scale = F.lit(1.0) / F.sqrt(F.col("n_ids"))
    else:
        raise ValueError(combiner)
    return g.select(*group_cols, *keep, "n_ids",
                    F.array(*[F.col(f"s{d}") * scale for d in range(dim)]).alias("vec"))


def shared_fields(spec: FeatureSpec, section: str) -> list:
    """The input fields of a shared_embedding section all read one table,
    keyed by the section's own fid. Returns (field, table_fid, n_ids, is_list)."""
    f = spec[section]
    tfid = spec.field_index()[section]
    n = max(spec[c].n_ids() for c in f.cat_col)
    return [(c, tfid, n, spec[c].is_list) for c in f.cat_col]


def warm_start(init: DataFrame, pretrained: DataFrame, value_col: str = "vec") -> DataFrame:
    """Take pretrained values where present, keep the initial value otherwise."""
    p = pretrained.select("fid", "bucket", F.col(value_col).alias("_pre"))
    return (init.join(p, ["fid", "bucket"], "left")
            .withColumn(value_col, F.coalesce(F.col("_pre"), F.col(value_col))).drop("_pre"))
