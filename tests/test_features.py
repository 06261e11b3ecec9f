import math

import duckdb
import pytest
from pyspark.sql import functions as F

from rankforge.functions import features as X
from rankforge.plans import sqlgen as Q
from rankforge.spec import parse_ini


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bucketize_edges(spark):
    b = [0.0, 1.0, 5.0]
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (5.0,), (7.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(X.bucketize("x", b)).collect()]
    # left-closed: a value equal to a boundary goes to the upper bucket; NaN on top; null stays null
    assert got == [0, 1, 1, 2, 3, 3, 3, None]


def test_bucketize_vector_ids(spark):
    df = spark.createDataFrame([([-1.0, 0.5, 9.0],)], "v array<double>")
    got = df.select(X.bucketize_vector("v", [0.0, 1.0], 3)).first()[0]
    assert got == [0, 1 + 3, 2 + 6]     # element j gets bucket + j*(n+1)
    wide = spark.createDataFrame([([float(i) for i in range(12)],)], "v array<double>")
    ids = wide.select(X.bucketize_vector("v", [5.0], 12)).first()[0]
    assert ids == [(1 if i >= 5 else 0) + 2 * i for i in range(12)]


def test_hash_matches_sql_engine(spark):
    vals = ["abc", "Brand#1", "", "12345", "ü"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(X.hash_bucket("s", 1000)).collect()]
    con = duckdb.connect()
    exp = [con.sql(f"SELECT {Q.hash_bucket(repr(v), 1000)}").fetchall()[0][0] for v in vals]
    assert got == exp
    assert all(0 <= g < 1000 for g in got)


def test_hash_self_negative(spark):
    df = spark.createDataFrame([(-7,), (13,)], "x bigint")
    assert [r[0] for r in df.select(X.hash_self("x", 5)).collect()] == [3, 3]


def test_vocab_and_identity(spark):
    df = spark.createDataFrame([("a", 3), ("zz", 10), (None, -1)], "s string, i bigint")
    got = rows(df.select(X.vocab_index("s", ["a", "b"]), X.vocab_index("s", ["a", "b"], 1),
                         X.identity_id("i", 10), X.identity_id("i", 10, 0)))
    assert got == [(0, 0, 3, 3), (-1, 1, -1, 0), (-1, 1, -1, 0)]


def test_cross_null_list_and_three_way(spark):
    df = spark.createDataFrame([("a", 1, "x"), (None, 1, "x")], "a string, b bigint, c string")
    got = rows(df.select(X.cross_hash(["a", "b"], 100), X.cross_hash(["a", "b", "c"], 100)))
    assert got[1] == (None, None)
    con = duckdb.connect()
    assert got[0][0] == con.sql(f"SELECT {Q.cross([repr('a'), '1'], 100)}").fetchall()[0][0]
    assert got[0][1] == con.sql(f"SELECT {Q.cross([repr('a'), '1', repr('x')], 100)}").fetchall()[0][0]
    lst = spark.createDataFrame([(["p", "q"], "z")], "l array<string>, s string")
    ids = lst.select(X.cross_list([F.col("l"), F.array(F.col("s"))], 100)).first()[0]
    single = [rows(spark.createDataFrame([(v, "z")], "a string, b string").select(X.cross_hash(["a", "b"], 100)))[0][0]
              for v in ("p", "q")]
    assert ids == single


def test_indicator_counts_duplicates(spark):
    df = spark.createDataFrame([([2, 0, 2, -1],), ([],)], "ids array<bigint>")
    got = [[(s["id"], s["count"]) for s in r[0]] for r in df.select(X.indicator_counts("ids")).collect()]
    assert got == [[(0, 1), (2, 2)], []]


def test_numeric_default_and_vector_length(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (float("nan"), None)], "x double, v array<double>")
    got = rows(df.select(X.numeric("x", -1.0), X.vector("v", 2)))
    assert got == [(-1.0, [1.0, 2.0]), (-1.0, [0.0, 0.0])]
    bad = spark.createDataFrame([([1.0],)], "v array<double>")
    with pytest.raises(Exception):
        bad.select(X.vector("v", 2)).collect()


def test_parse_list_and_dates(spark):
    df = spark.createDataFrame([("1,2.5,x", "20240131"), ("", "20240301")], "s string, d string")
    got = rows(df.select(X.parse_list("s"), X.date_shift("d", 1), X.date_shift("d", -1)))
    assert got[0] == ([1.0, 2.5, None], "20240201", "20240130")
    assert got[1] == ([], "20240302", "20240229")


def test_normalise_clip_and_zero_spread(spark):
    df = spark.createDataFrame([(-5.0,), (5.0,), (50.0,)], "x double")
    z = [r[0] for r in df.select(X.normalise("x", 0.0, 10.0, 5.0, 2.0)).collect()]
    assert z == [-2.5, 0.0, 2.5]
    z0 = [r[0] for r in df.select(X.normalise("x", 0.0, 10.0, 5.0, 0.0)).collect()]
    assert z0 == [-5.0, 0.0, 5.0]


def test_compile_features_hashes_once_and_crosses(spark):
    spec = parse_ini("""
[b]
ftype = cat_hash
fname = s
num_buckets = 7
is_out = 0
[c]
ftype = bucketized
fname = x
boundaries = 1.0
[bc]
ftype = cross
keys = b,c
num_buckets = 11
""")
    df = spark.createDataFrame([("u", 0.5), ("v", 3.0)], "s string, x double")
    out = X.compile_features(df, spec)
    assert out.columns == ["c", "bc"]           # helper column (is_out = 0) not emitted
    got = rows(out)
    exp = rows(df.select(X.bucketize("x", [1.0]), X.cross_hash([X.hash_bucket("s", 7), X.bucketize("x", [1.0])], 11)))
    assert got == exp


def test_count_below_tree(spark):
    bounds = [i / 10 for i in range(1, 50)]
    xs = [-1.0, 0.1, 0.15, 4.9, 5.0, 2.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(X.count_below("x", bounds), X.count_below("x", bounds, strict=False)).collect()]
    exp = [sum(1 for b in bounds if b < x) for x in xs]
    assert got == exp


def test_fast_hash_option(spark):
    df = spark.createDataFrame([(str(i),) for i in range(200)], "s string")
    md5_ids = [r[0] for r in df.select(X.hash_bucket("s", 37)).collect()]
    spark.conf.set(X.HASH_CONF, "xxhash64")
    try:
        fast = [r[0] for r in df.select(X.hash_bucket("s", 37)).collect()]
    finally:
        spark.conf.unset(X.HASH_CONF)
    assert all(0 <= v < 37 for v in fast) and fast != md5_ids
    assert len(set(fast)) > 30                                  # spreads over the buckets
    assert [r[0] for r in df.select(X.hash_bucket("s", 37)).collect()] == md5_ids


def test_list_cross_and_scalar_indicator_through_the_compiler(spark):
    from rankforge.functions.features import compile_features
    from rankforge.spec import Feature, FeatureSpec
    df = spark.createDataFrame([([1, 2], 1, 3), ([], 2, None), (None, 3, -1)], "ids array<long>, u long, s long")
    spec = FeatureSpec([
        Feature(name="id_list", ftype="cat_id", fname="ids", shape=0, num_buckets=100),
        Feature(name="user", ftype="cat_id", fname="u", num_buckets=100),
        Feature(name="single", ftype="cat_id", fname="s", num_buckets=100),
        Feature(name="x", ftype="cross", keys=("id_list", "user"), num_buckets=1000),
        Feature(name="one", ftype="indicator", cat_col=("single",)),
        Feature(name="many", ftype="indicator", cat_col=("id_list",)),
    ])
    rows = compile_features(df, spec, keep=["u"]).orderBy("u").collect()
    assert [len(r.x) for r in rows] == [2, 0, 0]
    assert [[tuple(c) for c in r.one] for r in rows] == [[(3, 1)], [], []]
    assert [[tuple(c) for c in r.many] for r in rows] == [[(1, 1), (2, 1)], [], []]
