"""Ranking samples built from the provided tables.

The lineitem primary key is (orderkey, linenumber, partkey, suppkey), so the
sample id is their ``:``-joined string: unique by construction at any scale
(a 64-bit hash of it would collide at hundreds of billions of rows).

``samples_li``: one sample per lineitem — user = ordering customer, item =
supplier, day = ship date; click = returned or accepted (flag <> 'N'),
conversion = returned ('R'), so every conversion is also a click; weight =
quantity / 25.

``samples_ev``: one impression per event — user = ``user_id``, item = the
``k`` value in ``props``, day = date(ts), watch time = ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import ensure_defaults
from rankforge.sources.tables import read_table
from rankforge.spec import parse_ini

# The demo wide-model spec over samples_li columns.
LI_SPEC_INI = """
[acctbal_b]
ftype = bucketized
fname = acctbal
boundaries = 0.0,2000.0,4000.0,6000.0,8000.0
auto_boundaries = 10
group = linear,dnn

[price_b]
ftype = bucketized
fname = price
boundaries = 10000.0,25000.0,40000.0,55000.0,70000.0
auto_boundaries = 10
group = linear

[discount_b]
ftype = bucketized
fname = discount
boundaries = 0.02,0.04,0.06,0.08
group = linear,dnn

[mktsegment_v]
ftype = cat_vocab
fname = mktsegment
vocab = AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD,MACHINERY
group = linear,dnn

[nation_id]
ftype = cat_id
fname = nationkey
dtype = int64
num_buckets = 25
group = linear,dnn

[z_nation_id]
ftype = cat_id
fname = z_nationkey
dtype = int64
num_buckets = 25
group = linear,dnn

[z_brand_h]
ftype = cat_hash
fname = z_brand
num_buckets = 50
group = linear,dnn

[touid_h]
ftype = cat_hash
fname = touid
dtype = int64
num_buckets = 1000
group = linear

[z_size_id]
ftype = cat_id
fname = z_size
dtype = int64
num_buckets = 51
group = linear

[seg_x_znation]
ftype = cross
keys = mktsegment_v,z_nation_id
num_buckets = 100
group = linear

[seg_x_brand_x_nation]
ftype = cross
keys = mktsegment_v,z_brand_h,nation_id
num_buckets = 500
group = linear
"""

# Dense (numeric) inputs of the demo deep part, in input-layer order.
LI_DENSE = ("discount", "tax", "z_size_n")


def li_spec():
    return parse_ini(LI_SPEC_INI)


def samples_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ supplier ⋈ part ⋈ (orders ⋈ customer). The fact-fact join on
    orderkey shuffles both sides; the dimension joins are left to the planner
    (broadcast only under the size threshold, sort-merge otherwise)."""
    ensure_defaults(spark)
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                                  "l_returnflag", "l_shipdate"])
    # only the streamed (fact) side is spread over cores; dimension sides are
    # either broadcast (small) or already split into many partitions (large)
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"], spread=False)
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"], spread=False)
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_acctbal", "s_nationkey"], spread=False)
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"], spread=False)
    # customers meet the orders before the lines do: the lines are shuffled once less
    buyers = o.join(c, F.col("o_custkey") == c.c_custkey)
    j = (li.join(s, F.col("l_suppkey") == s.s_suppkey)
         .join(p, F.col("l_partkey") == p.p_partkey)
         .join(buyers, li.l_orderkey == F.col("o_orderkey")))
    return j.select(
        F.concat_ws(":", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("sample_id"),
        F.col("o_custkey").cast("bigint").alias("uid"),
        F.col("l_suppkey").cast("bigint").alias("touid"),
        F.to_date("l_shipdate").alias("ds"),
        (F.col("l_returnflag") != "N").cast("double").alias("y_ctr"),
        (F.col("l_returnflag") == "R").cast("double").alias("y_ctcvr"),
        (F.col("l_quantity") / F.lit(25.0)).alias("wt"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
        F.col("c_nationkey").cast("bigint").alias("nationkey"),
        F.col("s_acctbal").alias("z_acctbal"), F.col("s_nationkey").cast("bigint").alias("z_nationkey"),
        F.col("p_brand").alias("z_brand"), F.col("p_type").alias("z_type"),
        F.col("p_size").cast("bigint").alias("z_size"), F.col("p_retailprice").alias("z_price"),
        (F.col("p_size") / F.lit(50.0)).alias("z_size_n"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_partkey").alias("partkey"),
        F.col("l_shipdate").alias("ts"))


def samples_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as impressions: view/click/purchase flags, watch time = value."""
    ensure_defaults(spark)
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return ev.select(
        F.col("event_id").alias("sample_id"), F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("touid"),
        F.to_date("ts").alias("ds"), F.col("ts"), F.col("event_type"),
        F.col("value").alias("watch_time"),
        (F.col("event_type").isin("click", "purchase")).cast("double").alias("y_ctr"),
        (F.col("event_type") == "purchase").cast("double").alias("y_ctcvr"))


# SQL twins of the two sample builders, for oracle queries. ``rid`` is a
# per-row key: exact duplicate records share a sample_id, and per-sample
# aggregates in SQL must not merge them (identical copies may swap numbers).
SAMPLES_LI_SQL = """
samples_li AS (
  SELECT concat_ws(':', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS sample_id,
         CAST(o.o_custkey AS BIGINT) AS uid, CAST(l.l_suppkey AS BIGINT) AS touid,
         CAST(l.l_shipdate AS DATE) AS ds,
         CASE WHEN l.l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END::DOUBLE AS y_ctr,
         CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS y_ctcvr,
         l.l_quantity / 25.0 AS wt,
         c.c_acctbal AS acctbal, c.c_mktsegment AS mktsegment, CAST(c.c_nationkey AS BIGINT) AS nationkey,
         s.s_acctbal AS z_acctbal, CAST(s.s_nationkey AS BIGINT) AS z_nationkey,
         p.p_brand AS z_brand, p.p_type AS z_type, CAST(p.p_size AS BIGINT) AS z_size,
         p.p_retailprice AS z_price, p.p_size / 50.0 AS z_size_n,
         l.l_extendedprice AS price, l.l_discount AS discount, l.l_tax AS tax,
         l.l_partkey AS partkey, l.l_shipdate AS ts,
         row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS rid
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN part p ON l.l_partkey = p.p_partkey)"""

SAMPLES_EV_SQL = """
samples_ev AS (
  SELECT event_id AS sample_id, user_id AS uid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS touid,
         CAST(ts AS DATE) AS ds, ts, event_type, value AS watch_time,
         CASE WHEN event_type IN ('click', 'purchase') THEN 1.0 ELSE 0.0 END::DOUBLE AS y_ctr,
         CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS y_ctcvr
  FROM events)"""
