"""Feature columns as built-in Spark expressions.

Everything here returns a ``Column`` so Catalyst can fuse it into the scan's
whole-stage-codegen span: CASE chains instead of array higher-order functions
for bucketing and vocabularies, and md5 (available in both Spark and SQL
engines) for hashing so ids are reproducible outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.spec import Feature, FeatureSpec

CROSS_SEP = "_X_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- numeric
def numeric(c, default: float = 0.0) -> Column:
    """Scalar numeric with default for null and NaN."""
    v = _c(c).cast("double")
    return F.coalesce(F.nanvl(v, F.lit(default)), F.lit(float(default)))


def vector(c, length: int, default: float = 0.0) -> Column:
    """Fixed-length vector as array<double>; a missing value becomes the
    default vector and a wrong length raises (declared schemas, not inferred)."""
    v = _c(c).cast("array<double>")
    filled = F.coalesce(v, F.array_repeat(F.lit(float(default)), length))
    return F.when(F.size(filled) == length, filled).otherwise(
        F.raise_error(F.lit(f"vector length != {length}")).cast("array<double>"))


def parse_list(c, element: str = "double", sep: str = ",") -> Column:
    """``"a,b,c"`` → typed array; empty or null string → empty array."""
    s = _c(c)
    arr = F.split(s, sep).try_cast(f"array<{element}>")
    return F.when((s.isNull()) | (F.trim(s) == ""), F.array().cast(f"array<{element}>")).otherwise(arr)


# ---------------------------------------------------------------- bucketize
def bucketize(c, boundaries) -> Column:
    """Left-closed buckets: id = number of boundaries <= x, ids 0..n.
    NaN sorts above every number (top bucket), matching Spark's ordering."""
    b = [float(x) for x in boundaries]
    if any(b[i] >= b[i + 1] for i in range(len(b) - 1)):
        raise ValueError("boundaries must be strictly increasing")
    x = _c(c)
    expr = None
    for i, bound in enumerate(b):
        cond = x < F.lit(bound)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    if expr is None:
        return F.when(x.isNull(), F.lit(None)).otherwise(F.lit(0)).cast("bigint")
    return F.when(x.isNull(), F.lit(None)).otherwise(expr.otherwise(F.lit(len(b)))).cast("bigint")


def bucketize_vector(c, boundaries, length: int) -> Column:
    """Element j of a fixed-length vector gets ``bucket + j*(n+1)`` so every
    position owns its own id range (multi-valued ids)."""
    width = len(boundaries) + 1
    x = _c(c)
    if length <= 8:
        return F.array(*[bucketize(x.getItem(j), boundaries) + F.lit(j * width) for j in range(length)])
    # wide vectors: one lambda instead of `length` unrolled copies (keeps the
    # generated method under the JVM size limit)
    return F.transform(x, lambda v, j: bucketize(v, boundaries) + j.cast("bigint") * F.lit(width))


# ---------------------------------------------------------------- hashing
HASH_CONF = "rankforge.hash"


def hash_method() -> str:
    """``md5`` (default: reproducible by any SQL engine) or ``xxhash64``
    (about 10x cheaper per row, Spark-only ids), read from the active
    session's ``rankforge.hash`` setting when the plan is built."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    m = spark.conf.get(HASH_CONF, "md5") if spark is not None else "md5"
    if m not in ("md5", "xxhash64"):
        raise ValueError(f"{HASH_CONF} must be md5 or xxhash64, not {m!r}")
    return m


def stable_hash(c) -> Column:
    """Non-negative 60-bit integer of the value's string form: the first 15
    hex digits of its md5, or xxhash64 with the sign bit cleared."""
    s = _c(c).cast("string")
    if hash_method() == "xxhash64":
        return F.xxhash64(s).bitwiseAND(F.lit((1 << 60) - 1))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def hash_bucket(c, n: int) -> Column:
    x = _c(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(stable_hash(x) % F.lit(int(n))).cast("bigint")


def hash_list(c, n: int) -> Column:
    return F.transform(_c(c), lambda x: stable_hash(x) % F.lit(int(n)))


def hash_self(c, n: int) -> Column:
    """Input already an integer hash: non-negative modulo."""
    return F.pmod(_c(c).cast("bigint"), F.lit(int(n)))


# ---------------------------------------------------------------- vocab / identity
def vocab_index(c, vocab, default: int | None = None, dtype: str = "string") -> Column:
    """Position in the vocabulary; unknown → ``default`` index, else -1
    (ignored by lookups)."""
    x = _c(c)
    expr = None
    for i, v in enumerate(vocab):
        lit = F.lit(int(v)) if dtype == "int64" else F.lit(str(v))
        cond = x == lit
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    miss = -1 if default is None else int(default)
    return expr.otherwise(F.lit(miss)).cast("bigint")


def vocab_list(c, vocab, default: int | None = None, dtype: str = "string") -> Column:
    return F.transform(_c(c), lambda x: vocab_index(x, vocab, default, dtype))


def identity_id(c, n: int, default: int | None = None) -> Column:
    """Integer is its own id when 0 <= x < n, otherwise ``default`` (or -1)."""
    x = _c(c).cast("bigint")
    miss = -1 if default is None else int(default)
    return F.when((x >= 0) & (x < n), x).otherwise(F.lit(miss)).cast("bigint")


# ---------------------------------------------------------------- crosses
def cross_hash(cols, n: int) -> Column:
    """Hash of the joined string forms of 2+ scalar keys; null key → null."""
    cs = [_c(c).cast("string") for c in cols]
    anynull = None
    for c in cs:
        anynull = c.isNull() if anynull is None else (anynull | c.isNull())
    return F.when(anynull, F.lit(None)).otherwise(
        stable_hash(F.concat_ws(CROSS_SEP, *cs)) % F.lit(int(n))).cast("bigint")


def cross_list(cols, n: int) -> Column:
    """Cross where keys may be lists: hash every combination (Cartesian
    product of the key values, in key order)."""
    arrs = []
    for c in cols:
        arrs.append(c if isinstance(c, Column) else F.col(c))
    combos = F.transform(arrs[0].cast("array<string>"), lambda x: F.array(x))
    for a in arrs[1:]:
        prev = combos
        combos = F.flatten(F.transform(prev, lambda p: F.transform(
            a.cast("array<string>"), lambda y: F.concat(p, F.array(y)))))
    return F.transform(combos, lambda parts: stable_hash(F.array_join(parts, CROSS_SEP)) % F.lit(int(n)))


# ---------------------------------------------------------------- indicator
def indicator_counts(c, is_list: bool = True) -> Column:
    """Sparse multi-hot counts: sorted array<struct<id,count>>; a scalar id
    (``is_list`` false) is one-hot; negative and null ids are dropped."""
    x = _c(c)
    if not is_list:
        x = F.array(x)
    ids = F.filter(F.coalesce(x, F.array()), lambda i: i >= 0)
    return F.transform(F.array_sort(F.array_distinct(ids)),
                       lambda i: F.struct(i.alias("id"),
                                          F.size(F.filter(ids, lambda j: j == i)).cast("bigint").alias("count")))


# ---------------------------------------------------------------- normalise
def normalise(c, mn: float, mx: float, mean: float | None = None, std: float | None = None,
              mode: str = "zscore") -> Column:
    """Clip to [min, max] then z-score ((x-mean)/std) or min-max scale.
    A zero spread leaves the centred value (no division by zero)."""
    x = F.least(F.greatest(_c(c).cast("double"), F.lit(float(mn))), F.lit(float(mx)))
    if mode == "minmax":
        span = float(mx) - float(mn)
        return (x - F.lit(float(mn))) / F.lit(span if span > 0 else 1.0)
    sd = float(std) if std else 0.0
    return (x - F.lit(float(mean))) / F.lit(sd if sd > 0 else 1.0)


# ---------------------------------------------------------------- calendar & dates
def calendar_features(ts) -> tuple:
    """(weekday 1=Monday..7=Sunday, hour 0..23)."""
    t = _c(ts)
    return ((F.weekday(t) + 1).cast("bigint").alias("weekday"),
            F.hour(t).cast("bigint").alias("hourOfDay"))


def date_shift(c, days: int) -> Column:
    """Shift a ``yyyyMMdd`` string by ``days``."""
    return F.date_format(F.date_add(F.to_date(_c(c), "yyyyMMdd"), int(days)), "yyyyMMdd")


# ---------------------------------------------------------------- compiler
def feature_column(f: Feature, compiled: dict) -> Column:
    """Column for one spec entry; ``compiled`` holds already-built features so
    crosses and indicators can refer to derived columns by name."""
    src = F.col(f.source)
    if f.ftype == "numeric":
        d = 0.0 if f.default is None else float(f.default)
        if f.shape > 1:
            return vector(src, f.shape, d)
        return numeric(src, d)
    if f.ftype == "bucketized":
        d = 0.0 if f.default is None else float(f.default)
        if f.shape > 1:
            return bucketize_vector(vector(src, f.shape, d), f.boundaries, f.shape)
        return bucketize(numeric(src, d), f.boundaries)
    if f.ftype == "cat_hash":
        if f.shape != 1:
            return hash_list(F.coalesce(src, F.array()), f.num_buckets)
        return hash_bucket(src if f.default is None else F.coalesce(src.cast("string"), F.lit(str(f.default))),
                           f.num_buckets)
    if f.ftype == "cat_hash_self":
        return hash_self(src, f.num_buckets)
    if f.ftype == "cat_vocab":
        if f.shape != 1:
            return vocab_list(F.coalesce(src, F.array()), f.vocab, f.default, f.dtype)
        return vocab_index(src, f.vocab, f.default, f.dtype)
    if f.ftype == "cat_id":
        if f.shape != 1:
            return F.transform(F.coalesce(src, F.array()), lambda x: identity_id(x, f.num_buckets, f.default))
        return identity_id(src, f.num_buckets, f.default)
    if f.ftype == "cross":
        keys = [compiled.get(k, F.col(k)) for k in f.keys]
        return cross_hash(keys, f.num_buckets)
    if f.ftype == "indicator":
        base = compiled.get(f.cat_col[0], F.col(f.cat_col[0]))
        return indicator_counts(base)
    raise ValueError(f"{f.ftype} is a lookup, not a column: use rankforge.operators.lookup")


def compile_features(df: DataFrame, spec: FeatureSpec, keep=(), list_crosses: dict | None = None,
                     include=()) -> DataFrame:
    """Every column-type feature of the spec plus the ``keep`` pass-through
    columns. Two projections: base features first, then crosses and
    indicators over the *materialised* base columns, so each hash is
    computed once per row (Catalyst does not inline an expensive expression
    into several consumers)."""
    base, derived = [], []
    for f in spec:
        if f.ftype in ("embedding", "shared_embedding"):
            continue
        (derived if f.ftype in ("cross", "indicator") else base).append(f)
    base_names = {f.name for f in base}
    include = set(include)
    # helper columns referenced by crosses are kept through the first step
    needed = {k for f in derived for k in (f.keys + f.cat_col) if k in base_names} | include
    first = [F.col(k) for k in keep]
    if not derived:
        first += [feature_column(f, {}).alias(f.name) for f in base if f.is_out or f.name in include]
        return df.select(*first)
    raw_refs = sorted({k for f in derived for k in (f.keys + f.cat_col)
                       if k not in base_names and k not in keep})
    first += [F.col(k) for k in raw_refs]
    for f in base:
        if f.is_out or f.name in needed:
            first.append(feature_column(f, {}).alias(f.name))
    step1 = df.select(*first)
    if not derived:
        return step1
    cols = {f.name: F.col(f.name) for f in base}
    lists = {x.name for x in step1.schema if isinstance(x.dataType, T.ArrayType)}
    out = [F.col(k) for k in keep] + [F.col(f.name) for f in base if f.is_out or f.name in include]
    for f in derived:
        if f.ftype == "cross" and (lists.intersection(f.keys) or f.name in (list_crosses or ())):
            # the cross of a list has one id per combination, so is a list itself
            col = cross_list([F.coalesce(F.col(k).cast("array<string>"), F.array()) if k in lists else
                              F.when(F.col(k).isNull(), F.array()).otherwise(F.array(F.col(k).cast("string")))
                              for k in f.keys], f.num_buckets)
            lists.add(f.name)
        elif f.ftype == "indicator":
            col = indicator_counts(F.col(f.cat_col[0]), f.cat_col[0] in lists)
        else:
            col = feature_column(f, cols)
        cols[f.name] = F.col(f.name)
        if f.is_out or f.name in include:
            out.append(col.alias(f.name))
    return step1.select(*out)


def input_layer(cols: dict) -> Column:
    """Concatenate dense parts (scalar or array) in column-name order."""
    parts = []
    for name in sorted(cols):
        c, is_vec = cols[name]
        parts.append(c.cast("array<double>") if is_vec else F.array(c.cast("double")))
    return F.concat(*parts)


def count_below(c, bounds, strict: bool = True) -> Column:
    """Number of sorted ``bounds`` strictly below x (``strict``) or <= x, as a
    balanced CASE tree: log2(n) comparisons per row, fully code-generated."""
    x = _c(c)
    b = [float(v) for v in bounds]

    def below(v):
        return (F.lit(v) < x) if strict else (F.lit(v) <= x)

    def tree(lo, hi):
        # answer lies in [lo, hi]; bounds[lo..hi-1] undecided
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(b[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(b)).cast("bigint")
