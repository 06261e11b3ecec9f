"""Feature-column queries (F1-F17, F23, F25) and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions import features as X
from rankforge.operators.fit import norm_stats
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_LI_SQL, li_spec, samples_li
from rankforge.sources.tables import read_table
from rankforge.sources.typed import role_projection, typed_read
from rankforge.spec import parse_ini

R = 6


def r(c, name):
    return rnd(c, name)


LI = [SAMPLES_LI_SQL]


@query("feat_numeric", sql=with_ctes(*LI, body="""
SELECT s.sample_id, round(coalesce(c.c_acctbal, -1.0), 6) AS acctbal_or_default,
       round(coalesce(s.price, 0.0), 6) AS price
FROM samples_li s LEFT JOIN customer c ON s.uid = c.c_custkey AND c.c_acctbal > 0"""))
def feat_numeric(spark, sf):
    """Scalar numeric with default: a left join leaves nulls for customers
    with non-positive balance; the default (-1) fills them."""
    s = samples_li(spark, sf)
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal"]).where("c_acctbal > 0")
    j = s.join(c, s.uid == c.c_custkey, "left")
    return j.select("sample_id", r(X.numeric("c_acctbal", -1.0), "acctbal_or_default"),
                    r(X.numeric("price", 0.0), "price"))


@query("feat_vector", sql="""
SELECT vec_id, CAST(i - 1 AS BIGINT) AS dim, round(CAST(embedding[i] AS DOUBLE), 6) AS value
FROM embeddings, range(1, 65) t(i)""")
def feat_vector(spark, sf):
    """Length-checked 64-wide dense vector, exploded to (id, dim, value)."""
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    v = e.select("vec_id", X.vector("embedding", 64).alias("v"))
    return v.select("vec_id", F.posexplode("v").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), r(F.col("value"), "value"))


BUCKET_SPEC = li_spec()


@query("feat_bucketize", sql=with_ctes(*LI, body=f"""
SELECT sample_id, {Q.bucketize('acctbal', BUCKET_SPEC['acctbal_b'].boundaries)} AS acctbal_b,
       {Q.bucketize('price', BUCKET_SPEC['price_b'].boundaries)} AS price_b,
       {Q.bucketize('discount', BUCKET_SPEC['discount_b'].boundaries)} AS discount_b
FROM samples_li"""))
def feat_bucketize(spark, sf):
    s = samples_li(spark, sf)
    return s.select("sample_id",
                    X.bucketize("acctbal", BUCKET_SPEC["acctbal_b"].boundaries).alias("acctbal_b"),
                    X.bucketize("price", BUCKET_SPEC["price_b"].boundaries).alias("price_b"),
                    X.bucketize("discount", BUCKET_SPEC["discount_b"].boundaries).alias("discount_b"))


VEC_BOUNDS = (-0.1, -0.02, 0.0, 0.02, 0.1)


@query("feat_bucketize_vec", sql=f"""
SELECT vec_id, CAST(i - 1 AS BIGINT) AS pos,
       {Q.bucketize('CAST(embedding[i] AS DOUBLE)', VEC_BOUNDS)} + (i - 1) * {len(VEC_BOUNDS) + 1} AS id
FROM embeddings, range(1, 65) t(i)""")
def feat_bucketize_vec(spark, sf):
    """Each element of the 64-vector bucketed into its own id range."""
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    ids = X.bucketize_vector(X.vector("embedding", 64), VEC_BOUNDS, 64)
    return e.select("vec_id", F.posexplode(ids).alias("pos", "id")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), "id")


@query("feat_hash", sql=with_ctes(*LI, body=f"""
SELECT sample_id, {Q.hash_bucket('z_brand', 50)} AS z_brand_h, {Q.hash_bucket('touid', 1000)} AS touid_h,
       {Q.hash_bucket('z_type', 7)} AS z_type_h
FROM samples_li"""))
def feat_hash(spark, sf):
    s = samples_li(spark, sf)
    return s.select("sample_id", X.hash_bucket("z_brand", 50).alias("z_brand_h"),
                    X.hash_bucket("touid", 1000).alias("touid_h"), X.hash_bucket("z_type", 7).alias("z_type_h"))


@query("feat_hash_self", sql="""
SELECT l_orderkey, l_linenumber, CAST(((l_partkey - 1000) % 97 + 97) % 97 AS BIGINT) AS part_h FROM lineitem""")
def feat_hash_self(spark, sf):
    """Already-integer input: non-negative modulo (negative inputs included)."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    return li.select("l_orderkey", "l_linenumber", X.hash_self(F.col("l_partkey") - 1000, 97).alias("part_h"))


VOCAB = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")  # MACHINERY deliberately unknown


@query("feat_vocab", sql=f"""
SELECT c_custkey, {Q.vocab('c_mktsegment', VOCAB)} AS seg_v, {Q.vocab('c_mktsegment', VOCAB, 0)} AS seg_v0,
       {Q.vocab('c_nationkey', (3, 1, 4, 15, 9), None, 'int64')} AS nation_v
FROM customer""")
def feat_vocab(spark, sf):
    """Vocabulary index; unknown → -1 (ignored) or the default index."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    return c.select("c_custkey", X.vocab_index("c_mktsegment", VOCAB).alias("seg_v"),
                    X.vocab_index("c_mktsegment", VOCAB, 0).alias("seg_v0"),
                    X.vocab_index("c_nationkey", (3, 1, 4, 15, 9), None, "int64").alias("nation_v"))


@query("feat_identity", sql=f"""
SELECT c_custkey, {Q.identity('c_nationkey', 20, 0)} AS nation_id, {Q.identity('c_nationkey - 5', 20)} AS shifted_id
FROM customer""")
def feat_identity(spark, sf):
    """Integer ids used as-is inside [0, n); others → default (or -1)."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    return c.select("c_custkey", X.identity_id("c_nationkey", 20, 0).alias("nation_id"),
                    X.identity_id(F.col("c_nationkey") - 5, 20).alias("shifted_id"))


def _li_feats_sql():
    return [SAMPLES_LI_SQL] + Q.feature_ctes(li_spec(), "samples_li", ("sample_id",))


@query("feat_cross2", sql=with_ctes(*_li_feats_sql(), body="SELECT sample_id, seg_x_znation FROM feats"))
def feat_cross2(spark, sf):
    c = X.compile_features(samples_li(spark, sf), li_spec(), keep=["sample_id"])
    return c.select("sample_id", "seg_x_znation")


@query("feat_cross3", sql=with_ctes(*_li_feats_sql(), body="SELECT sample_id, seg_x_brand_x_nation FROM feats"))
def feat_cross3(spark, sf):
    c = X.compile_features(samples_li(spark, sf), li_spec(), keep=["sample_id"])
    return c.select("sample_id", "seg_x_brand_x_nation")


@query("feat_cross_list", sql=f"""
WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT o.o_orderkey, {Q.cross(['l.l_suppkey', 'o.o_orderpriority'], 1000)} AS cross_id, count(*) AS n
FROM orders o JOIN l ON o.o_orderkey = l.l_orderkey
GROUP BY 1, 2""")
def feat_cross_list(spark, sf):
    """List key × scalar key: every (supplier of the order, priority) pair is
    hashed; result exploded and counted per order."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    lists = li.groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("supps"))
    j = o.join(lists, o.o_orderkey == lists.l_orderkey)
    ids = X.cross_list([F.col("supps"), F.array(F.col("o_orderpriority"))], 1000)
    return (j.select("o_orderkey", F.explode(ids).alias("cross_id"))
            .groupBy("o_orderkey", "cross_id").agg(F.count(F.lit(1)).alias("n")))


@query("feat_indicator", sql="""
SELECT l_orderkey, CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS BIGINT) AS id,
       count(*) AS count
FROM lineitem GROUP BY 1, 2""")
def feat_indicator(spark, sf):
    """Multi-hot counts of a list-valued categorical (return flags of an
    order's lines): a duplicated id counts twice."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag"])
    lists = li.groupBy("l_orderkey").agg(
        F.collect_list(X.vocab_index("l_returnflag", ("A", "N", "R"))).alias("flags"))
    return lists.select("l_orderkey", F.inline(X.indicator_counts("flags")))


@query("feat_normalise", sql=with_ctes(*LI, """
st AS (SELECT quantile_cont(price, 0.01) AS mn, quantile_cont(price, 0.99) AS mx, avg(CAST(price AS DECIMAL(38,12)))::DOUBLE AS mu,
              stddev_pop(price) AS sd FROM samples_li)""", body="""
SELECT sample_id, round((least(greatest(price, mn), mx) - mu) / sd, 6) AS price_z,
       round((least(greatest(price, mn), mx) - mn) / (mx - mn), 6) AS price_mm
FROM samples_li, st"""))
def feat_normalise(spark, sf):
    """Fit p1/p99/mean/std (one aggregate, a 4-number summary), then clip
    and scale — z-score and min-max."""
    s = samples_li(spark, sf)
    st = norm_stats(s, ["price"])["price"]
    return s.select("sample_id",
                    r(X.normalise("price", st["min"], st["max"], st["mean"], st["std"]), "price_z"),
                    r(X.normalise("price", st["min"], st["max"], mode="minmax"), "price_mm"))


@query("input_layer", sql=with_ctes(*LI, body="""
SELECT sample_id, CAST(pos AS BIGINT) AS pos, round(value, 6) AS value FROM (
  SELECT sample_id, 0 AS pos, discount AS value FROM samples_li UNION ALL
  SELECT sample_id, 1, tax FROM samples_li UNION ALL
  SELECT sample_id, 2, z_size_n FROM samples_li)"""))
def input_layer(spark, sf):
    """Dense parts concatenated in column-name order, exploded for checking."""
    s = samples_li(spark, sf)
    v = X.input_layer({"tax": (F.col("tax"), False), "discount": (F.col("discount"), False),
                       "z_size_n": (F.col("z_size_n"), False)})
    return s.select("sample_id", F.posexplode(v).alias("pos", "value")).select(
        "sample_id", F.col("pos").cast("bigint").alias("pos"), r(F.col("value"), "value"))


@query("date_shift", sql="""
SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS ds,
       strftime(CAST(l_shipdate AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS prev_day,
       strftime(CAST(l_shipdate AS DATE) + INTERVAL 7 DAY, '%Y%m%d') AS next_week
FROM lineitem""")
def date_shift(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_shipdate"])
    d = li.select(F.date_format("l_shipdate", "yyyyMMdd").alias("ds")).distinct()
    return d.select("ds", X.date_shift("ds", -1).alias("prev_day"), X.date_shift("ds", 7).alias("next_week"))


@query("parse_list", sql="""
SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 6) AS total_qty FROM lineitem GROUP BY l_orderkey""")
def parse_list(spark, sf):
    """``a,b,c`` strings (built per order) parsed back to typed lists."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_quantity"])
    s = li.groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list(F.col("l_quantity").cast("string"))).alias("q"))
    v = s.select("l_orderkey", X.parse_list("q").alias("qs"))
    return v.select("l_orderkey", F.size("qs").cast("bigint").alias("n"),
                    r(F.aggregate("qs", F.lit(0.0), lambda a, x: a + x), "total_qty"))


@query("calendar_features", sql="""
SELECT CAST(isodow(ts) AS BIGINT) AS weekday, CAST(hour(ts) AS BIGINT) AS hourOfDay, count(*) AS n
FROM events GROUP BY 1, 2""")
def calendar_features(spark, sf):
    ev = read_table(spark, sf, "events", ["ts"])
    wd, hr = X.calendar_features("ts")
    return ev.select(wd, hr).groupBy("weekday", "hourOfDay").agg(F.count(F.lit(1)).alias("n"))


TYPED_SCHEMA = [("c_custkey", "int64", 1, 0), ("c_acctbal", "float", 1, 0.0), ("c_nationkey", "int64", 1, 0),
                ("c_mktsegment", "string", 1, ""), ("c_phone", "string", 1, "unknown"),
                ("c_tags", "string", 0, None)]


@query("typed_read", sql="""
SELECT c_custkey, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment,
       'unknown' AS c_phone, CAST(0 AS BIGINT) AS n_tags FROM customer""")
def q_typed_read(spark, sf):
    """Declared schema: casts, defaults, an absent scalar column and an
    absent var-length list (empty); undeclared columns (c_name) dropped."""
    c = read_table(spark, sf, "customer")
    t = typed_read(c, TYPED_SCHEMA)
    return t.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment", "c_phone",
                    F.size("c_tags").cast("bigint").alias("n_tags"))


@query("role_projection", sql=with_ctes(*[SAMPLES_LI_SQL] + Q.feature_ctes(li_spec(), "samples_li", ("sample_id",)),
                                        body="""SELECT sample_id, acctbal_b, discount_b, mktsegment_v, nation_id,
       z_nation_id, z_brand_h FROM feats"""))
def q_role_projection(spark, sf):
    """Columns of the ``dnn`` role only."""
    spec = li_spec()
    c = X.compile_features(samples_li(spark, sf), spec, keep=["sample_id"])
    return role_projection(c, spec, "dnn", keep=["sample_id"])


@query("drop_listed", sql=with_ctes(*[SAMPLES_LI_SQL] + Q.feature_ctes(li_spec(), "samples_li", ("sample_id",)),
                                    body="""SELECT sample_id, acctbal_b, price_b, discount_b, mktsegment_v,
       nation_id, z_nation_id, z_brand_h, z_size_id FROM feats"""))
def q_drop_listed(spark, sf):
    """Spec minus listed features (touid hash and both crosses)."""
    spec = li_spec().drop(["touid_h", "seg_x_znation", "seg_x_brand_x_nation"])
    return X.compile_features(samples_li(spark, sf), spec, keep=["sample_id"])


ALIAS_SPEC = parse_ini("""
[price]
ftype = numeric
[price_cat]
ftype = bucketized
fname = price
boundaries = 10000.0,40000.0,70000.0
[price_hash]
ftype = cat_hash
fname = price
num_buckets = 13
""")


@query("alias_fields", sql=with_ctes(*LI, body=f"""
SELECT sample_id, round(price, 6) AS price, {Q.bucketize('price', (10000.0, 40000.0, 70000.0))} AS price_cat,
       {Q.hash_bucket("CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR)", 13)} AS price_hash
FROM samples_li"""))
def alias_fields(spark, sf):
    """Several features from one raw field (numeric, bucketized, hashed)."""
    s = samples_li(spark, sf).select("sample_id", "price",
                                     F.round(F.col("price") * 100).cast("bigint").cast("string").alias("price_key"))
    c = X.compile_features(s, ALIAS_SPEC.drop(["price_hash"]), keep=["sample_id", "price_key"])
    return c.select("sample_id", r(F.col("price"), "price"), "price_cat",
                    X.hash_bucket("price_key", 13).alias("price_hash"))


@query("multitask_labels", sql=with_ctes(*LI, body="""
SELECT y_ctr, y_ctcvr, count(*) AS n, round(sum(wt), 6) AS wt FROM samples_li GROUP BY 1, 2"""))
def multitask_labels(spark, sf):
    """Click and conversion labels side by side (ctcvr implies ctr)."""
    s = samples_li(spark, sf)
    return s.groupBy("y_ctr", "y_ctcvr").agg(F.count(F.lit(1)).alias("n"), r(F.sum("wt"), "wt"))


@query("mask_clicked", sql=with_ctes(*LI, body="""
SELECT ds, count(*) AS clicks, CAST(sum(y_ctcvr) AS BIGINT) AS conversions FROM samples_li WHERE y_ctr = 1 GROUP BY ds"""))
def mask_clicked(spark, sf):
    """Conversion head trains on clicked rows only (pushed-down predicate)."""
    s = samples_li(spark, sf).where(F.col("y_ctr") == 1)
    return s.groupBy("ds").agg(F.count(F.lit(1)).alias("clicks"), F.sum("y_ctcvr").cast("bigint").alias("conversions"))


@query("date_regex_range", sql="""
SELECT strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS ds, count(*) AS n FROM lineitem
WHERE regexp_full_match(strftime(CAST(l_shipdate AS DATE), '%Y%m%d'), '199[67](0[1-6])[0-9]{2}')
  AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-15' AND DATE '1997-04-20'
GROUP BY 1""")
def date_regex_range(spark, sf):
    """Day folders chosen by a name pattern and a min/max range."""
    li = read_table(spark, sf, "lineitem", ["l_shipdate"])
    d = li.select(F.to_date("l_shipdate").alias("d"))
    name = F.date_format("d", "yyyyMMdd")
    sel = d.where(name.rlike("^199[67](0[1-6])[0-9]{2}$") &
                  F.col("d").between(F.lit("1996-03-15").cast("date"), F.lit("1997-04-20").cast("date")))
    return sel.groupBy(name.alias("ds")).agg(F.count(F.lit(1)).alias("n"))
