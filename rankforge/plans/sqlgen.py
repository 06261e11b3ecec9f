"""SQL formulations of the feature kinds, for oracle queries run by an
independent SQL engine. Written against the same definitions as the Spark
columns but with different primitives (list filters instead of CASE trees,
list_position instead of CASE chains), so a shared mistake is unlikely."""

from __future__ import annotations

from rankforge.spec import FeatureSpec


def lst(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]"


def bucketize(x: str, bounds) -> str:
    return f"CAST(len(list_filter({lst(bounds)}, lambda b: b <= {x})) AS BIGINT)"


def stable_hash(x: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15)) AS BIGINT)"


def hash_bucket(x: str, n: int) -> str:
    return f"({stable_hash(x)} % {int(n)})"


def vocab(x: str, values, default=None, dtype: str = "string") -> str:
    items = ", ".join(str(int(v)) if dtype == "int64" else "'" + str(v) + "'" for v in values)
    miss = -1 if default is None else int(default)
    return f"CAST(coalesce(list_position([{items}], {x}) - 1, {miss}) AS BIGINT)"


def identity(x: str, n: int, default=None) -> str:
    miss = -1 if default is None else int(default)
    return f"(CASE WHEN {x} >= 0 AND {x} < {int(n)} THEN CAST({x} AS BIGINT) ELSE {miss} END)"


def cross(keys, n: int) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"({stable_hash(f'concat_ws({chr(39)}_X_{chr(39)}, {parts})')} % {int(n)})"


def init_value(fid: str, bucket: str, d: str = "0") -> str:
    return (f"((CAST({fid} AS BIGINT) * 7919 + CAST({bucket} AS BIGINT) * 104729 + "
            f"CAST({d} AS BIGINT) * 1299709) % 2001 - 1000) / 10000.0")


def sigmoid(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-({z}))))"


def feature_ctes(spec: FeatureSpec, src: str, keep, name: str = "feats") -> list:
    """Two CTEs: scalar features from ``src``, then crosses over them."""
    first, second = [], []
    for f in spec:
        s = f.source
        if f.ftype == "numeric":
            d = 0.0 if f.default is None else float(f.default)
            first.append(f"coalesce(CAST({s} AS DOUBLE), {d!r}) AS {f.name}")
        elif f.ftype == "bucketized":
            d = 0.0 if f.default is None else float(f.default)
            first.append(f"{bucketize(f'coalesce(CAST({s} AS DOUBLE), {d!r})', f.boundaries)} AS {f.name}")
        elif f.ftype == "cat_hash":
            first.append(f"{hash_bucket(s, f.num_buckets)} AS {f.name}")
        elif f.ftype == "cat_hash_self":
            first.append(f"(((CAST({s} AS BIGINT) % {f.num_buckets}) + {f.num_buckets}) % {f.num_buckets}) AS {f.name}")
        elif f.ftype == "cat_vocab":
            first.append(f"{vocab(s, f.vocab, f.default, f.dtype)} AS {f.name}")
        elif f.ftype == "cat_id":
            first.append(f"{identity(s, f.num_buckets, f.default)} AS {f.name}")
        elif f.ftype == "cross":
            second.append(f"{cross(f.keys, f.num_buckets)} AS {f.name}")
    keep = tuple(keep)
    if "sample_id" in keep and "rid" not in keep and src == "samples_li":
        keep = ("rid",) + keep
    k = ", ".join(keep)
    c1 = f"{name}_1 AS (SELECT {k}, {', '.join(first)} FROM {src})"
    c2 = f"{name} AS (SELECT *{', ' + ', '.join(second) if second else ''} FROM {name}_1)"
    return [c1, c2]


def long_ids_cte(spec: FeatureSpec, src: str, id_col: str = "rid, sample_id", keep=(), with_bias: bool = False,
                 numeric=(), name: str = "ids") -> str:
    idx = spec.field_index()
    extra = "".join(f", {k}" for k in keep)
    parts = []
    for f in spec.categorical():
        parts.append(f"SELECT {id_col}{extra}, '{f.name}' AS field, CAST({idx[f.name]} AS BIGINT) AS fid, "
                     f"CAST({f.name} AS BIGINT) AS bucket, 1.0::DOUBLE AS value FROM {src} WHERE {f.name} >= 0")
    base = len(spec.features)
    for i, c in enumerate(numeric):
        parts.append(f"SELECT {id_col}{extra}, '{c}' AS field, CAST({base + i} AS BIGINT) AS fid, "
                     f"CAST(0 AS BIGINT) AS bucket, CAST({c} AS DOUBLE) AS value FROM {src}")
    if with_bias:
        parts.append(f"SELECT {id_col}{extra}, '__bias__' AS field, CAST(-1 AS BIGINT) AS fid, "
                     f"CAST(0 AS BIGINT) AS bucket, 1.0::DOUBLE AS value FROM {src}")
    return f"{name} AS (" + "\n  UNION ALL ".join(parts) + ")"


def sparse_ctes(spec: FeatureSpec, dim: int, lin_fields=(), emb_fields=(), numeric=(), keep=(),
                shared: dict | None = None, src: str = "samples_li") -> list:
    """feats → ids (with bias row) → sp: per-sample lin_<f> and e_<f>_<d>."""
    feat_keep = ("rid", "sample_id") + tuple(keep) + tuple(numeric)
    ctes = feature_ctes(spec, src, feat_keep)
    want = set(lin_fields) | set(emb_fields)
    idx = spec.field_index()
    extra = "".join(f", {k}" for k in keep)
    parts = []
    for f in spec.categorical():
        if f.name not in want:
            continue
        parts.append(f"SELECT rid, sample_id{extra}, '{f.name}' AS field, CAST({idx[f.name]} AS BIGINT) AS fid, "
                     f"CAST({f.name} AS BIGINT) AS bucket, 1.0::DOUBLE AS value FROM feats WHERE {f.name} >= 0")
    base = len(spec.features)
    for i, c in enumerate(numeric):
        parts.append(f"SELECT rid, sample_id{extra}, '{c}' AS field, CAST({base + i} AS BIGINT) AS fid, "
                     f"CAST(0 AS BIGINT) AS bucket, CAST({c} AS DOUBLE) AS value FROM feats")
    parts.append(f"SELECT rid, sample_id{extra}, '__bias__' AS field, CAST(-1 AS BIGINT) AS fid, "
                 f"CAST(0 AS BIGINT) AS bucket, 1.0::DOUBLE AS value FROM feats")
    ctes.append("ids AS (" + "\n  UNION ALL ".join(parts) + ")")
    shared = shared or {}
    cols = [f"any_value({k}) AS {k}" for k in keep]
    for f in list(lin_fields) + list(numeric):
        cols.append(f"coalesce(sum(CASE WHEN field = '{f}' THEN value * {init_value('fid', 'bucket')} END), 0) AS lin_{f}")
    for f in list(emb_fields) + list(numeric):
        tf = str(shared[f][0]) if f in shared else "fid"
        for d in range(dim):
            cols.append(f"coalesce(sum(CASE WHEN field = '{f}' THEN value * {init_value(tf, 'bucket', str(d))} END), 0) AS e_{f}_{d}")
    ctes.append(f"sp AS (SELECT rid, any_value(sample_id) AS sample_id, {', '.join(cols)} FROM ids GROUP BY rid)")
    return ctes


def long_vector_cte(name: str, cols, src: str = "sp", key: str = "rid, sample_id") -> str:
    parts = [f"SELECT {key}, {i} AS i, CAST({c} AS DOUBLE) AS v FROM {src}" for i, c in enumerate(cols)]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


def mlp_ctes(src: str, head: int, sizes, prefix: str, out_bias: bool = False, hidden_only: bool = False) -> tuple:
    """Layer l: W fid 1000+10·head+l, bias fid 2000+10·head+l, relu on hidden
    layers; final CTE has i = 0 holding the logit."""
    ctes, prev = [], src
    n = len(sizes) - 1
    for l in range(n):
        last = l == n - 1 and not hidden_only
        b = "0" if (last and not out_bias) else init_value(str(2000 + 10 * head + l), "0", "r.j")
        expr = f"sum(x.v * {init_value(str(1000 + 10 * head + l), 'x.i', 'r.j')}) + {b}"
        if not last:
            expr = f"greatest({expr}, 0)"
        name = f"{prefix}{l + 1}"
        ctes.append(f"{name} AS (SELECT x.rid, any_value(x.sample_id) AS sample_id, r.j AS i, {expr} AS v "
                    f"FROM {prev} x, range({sizes[l + 1]}) r(j) GROUP BY x.rid, r.j)")
        prev = name
    return ctes, prev
