"""Sample-building and source queries (J6, J7, A14, W1-W3, U1-U5, F26, S1,
S3, S5, S6, S10, S11, O2, O3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rankforge.functions import features as X
from rankforge.operators import samples as SM
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_EV_SQL, SAMPLES_LI_SQL, li_spec, samples_ev, samples_li
from rankforge.plans.queries_core import LR_SCORED_SQL, _li_scored
from rankforge.session import checkpoint_dir
from rankforge.sources import scans as SC
from rankforge.sources.tables import read_table

EV = [SAMPLES_EV_SQL]
LI = [SAMPLES_LI_SQL]


def r(c, name):
    return rnd(c, name)


@query("assemble_samples", sql=with_ctes(*EV, body="""
SELECT e.sample_id, e.uid, e.touid, c.c_acctbal AS acctbal, c.c_mktsegment AS mktsegment,
       s.s_acctbal AS z_acctbal, CAST(s.s_nationkey AS BIGINT) AS z_nationkey
FROM samples_ev e LEFT JOIN customer c ON e.uid = c.c_custkey LEFT JOIN supplier s ON e.touid = s.s_suppkey"""))
def q_assemble_samples(spark, sf):
    """Impressions (events) ⋈ user features (customer) ⋈ item features
    (supplier, prefixed z_)."""
    ev = samples_ev(spark, sf).select("sample_id", "uid", "touid")
    users = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"]).select(
        F.col("c_custkey").alias("uid"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    items = read_table(spark, sf, "supplier", ["s_suppkey", "s_acctbal", "s_nationkey"]).select(
        F.col("s_suppkey").alias("touid"), F.col("s_acctbal").alias("acctbal"),
        F.col("s_nationkey").cast("bigint").alias("nationkey"))
    return SM.assemble_samples(ev, users, items).select(
        "sample_id", "uid", "touid", "acctbal", "mktsegment", "z_acctbal", "z_nationkey")


@query("follow_positives", sql=with_ctes(*EV, """
f AS (SELECT DISTINCT uid, touid, ds FROM samples_ev WHERE event_type = 'purchase')""", body="""
SELECT e.sample_id, CASE WHEN f.uid IS NOT NULL THEN 1.0 ELSE e.y_ctr END AS y_ctr
FROM samples_ev e LEFT JOIN f ON e.uid = f.uid AND e.touid = f.touid AND e.ds = f.ds
WHERE e.event_type IN ('view', 'click')"""))
def q_follow_positives(spark, sf):
    """Views/clicks of a (user, item, day) that had a purchase become positives."""
    ev = samples_ev(spark, sf)
    imp = ev.where(F.col("event_type").isin("view", "click"))
    follows = ev.where(F.col("event_type") == "purchase")
    return SM.follow_positives(imp, follows).select("sample_id", "y_ctr")


@query("watch_time_label", sql=with_ctes(*EV, body="""
SELECT uid, touid, ds, round(sum(CASE WHEN event_type IN ('view', 'click') THEN watch_time ELSE 0 END), 6) AS watch,
       count(*) AS n_entries,
       CASE WHEN sum(CASE WHEN event_type IN ('view', 'click') THEN watch_time ELSE 0 END) >= 30 THEN 1.0 ELSE 0.0 END::DOUBLE AS label
FROM samples_ev GROUP BY uid, touid, ds"""))
def q_watch_time_label(spark, sf):
    """Watch time of view/click entries per (user, item, day) → label ≥ 30."""
    ev = samples_ev(spark, sf)
    g = SM.watch_time_label(ev, threshold=30.0, entry_filter=F.col("event_type").isin("view", "click"))
    return g.select("uid", "touid", "ds", r(F.col("watch"), "watch"), "n_entries", "label")


@query("pair_day_distinct", sql=with_ctes(*EV, body="""
SELECT uid, touid, ds, sample_id FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, touid, ds ORDER BY ts, sample_id) AS rn FROM samples_ev) WHERE rn = 1"""))
def q_pair_day_distinct(spark, sf):
    """One sample per (user, item, day): the earliest."""
    ev = samples_ev(spark, sf).select("uid", "touid", "ds", "ts", "sample_id")
    return SM.first_per_key(ev, ["uid", "touid", "ds"], ["ts", "sample_id"]).select("uid", "touid", "ds", "sample_id")


@query("pair_day_cap", sql=with_ctes(*EV, body="""
SELECT uid, ds, sample_id, CAST(rn AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, ds ORDER BY ts, sample_id) AS rn FROM samples_ev) WHERE rn <= 5"""))
def q_pair_day_cap(spark, sf):
    """At most 5 samples per (user, day), earliest first (two-stage, salted)."""
    ev = samples_ev(spark, sf).select("uid", "ds", "ts", "sample_id")
    c = SM.cap_per_key(ev, ["uid", "ds"], ["ts", "sample_id"], 5)
    return c.select("uid", "ds", "sample_id", F.col("_rank").cast("bigint").alias("rank"))


def _trailing_sql(src, key, windows, label="y_ctr"):
    cols = ", ".join(
        f"""round(CASE WHEN coalesce(sum(imp) OVER (PARTITION BY {key} ORDER BY dn RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) > 0
             THEN sum(clk) OVER (PARTITION BY {key} ORDER BY dn RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING)
                / sum(imp) OVER (PARTITION BY {key} ORDER BY dn RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING) ELSE 0 END, 6) AS ctr_{n}"""
        for n in windows)
    return f"""daily AS (SELECT {key}, ds, sum({label}) AS clk, count(*) AS imp, ds - DATE '1970-01-01' AS dn
                FROM {src} GROUP BY {key}, ds)""", f"SELECT {key}, ds, {cols} FROM daily"


UW = (1, 3, 7, 15, 30)
IW = (1, 7, 30, 90)
_tu = _trailing_sql("samples_ev", "uid", UW)
_ti = _trailing_sql("samples_li", "touid", IW)


@query("trailing_ctr_user", headline=True, sql=with_ctes(*EV, _tu[0], body=_tu[1]))
def q_trailing_ctr_user(spark, sf):
    """User CTR over the 1/3/7/15/30 days before each day (today excluded)."""
    t = SM.trailing_ctr(samples_ev(spark, sf), "uid", windows=UW)
    return t.select("uid", "ds", *[r(F.col(f"ctr_{n}"), f"ctr_{n}") for n in UW])


@query("trailing_ctr_item", sql=with_ctes(*LI, _ti[0], body=_ti[1]))
def q_trailing_ctr_item(spark, sf):
    """Item (supplier) CTR over 1/7/30/90 prior days, across day gaps."""
    t = SM.trailing_ctr(samples_li(spark, sf), "touid", windows=IW)
    return t.select("touid", "ds", *[r(F.col(f"ctr_{n}"), f"ctr_{n}") for n in IW])


@query("union_positives", sql=with_ctes(*EV, """
u AS (SELECT sample_id, uid, touid, ds, ts, y_ctr FROM samples_ev WHERE event_type IN ('view', 'click')
      UNION ALL SELECT sample_id, uid, touid, ds, ts, 1.0 FROM samples_ev WHERE event_type = 'purchase')""", body="""
SELECT uid, touid, ds, sample_id, y_ctr FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, touid, ds ORDER BY -y_ctr, ts, sample_id) AS rn FROM u) WHERE rn = 1"""))
def q_union_positives(spark, sf):
    """Watch samples ∪ follow positives, one per (user, item, day), positive first."""
    ev = samples_ev(spark, sf).select("sample_id", "uid", "touid", "ds", "ts", "y_ctr", "event_type")
    s = ev.where(F.col("event_type").isin("view", "click")).drop("event_type")
    p = ev.where(F.col("event_type") == "purchase").drop("event_type").withColumn("y_ctr", F.lit(1.0))
    return SM.union_positives(s, p).select("uid", "touid", "ds", "sample_id", "y_ctr")


@query("negative_sampling", sql=with_ctes(*LI, body=f"""
SELECT sample_id, y_ctr FROM samples_li
WHERE y_ctr > 0 OR {Q.stable_hash("concat_ws(':', '11', sample_id)")} < {int(0.3 * (1 << 60))}"""))
def q_negative_sampling(spark, sf):
    """All positives, a reproducible 30% of negatives."""
    s = samples_li(spark, sf)
    return SM.negative_sampling(s, "y_ctr", "sample_id", 0.3, seed=11).select("sample_id", "y_ctr")


@query("time_weight", sql=with_ctes(*EV, body="""
SELECT sample_id, round(CASE WHEN y_ctr > 0 THEN 1 + ln(1 + greatest(watch_time, 0)) ELSE 1.0 END, 6) AS wt FROM samples_ev"""))
def q_time_weight(spark, sf):
    s = SM.time_weight(samples_ev(spark, sf), "watch_time", "y_ctr")
    return s.select("sample_id", r(F.col("wt"), "wt"))


@query("pref_tfidf", sql=with_ctes(*LI, """
ua AS (SELECT uid, z_nationkey, count(*) AS n FROM samples_li GROUP BY 1, 2)""", """
tf AS (SELECT *, n / sum(n) OVER (PARTITION BY uid) AS tf FROM ua)""", """
df AS (SELECT z_nationkey, count(*) AS d FROM ua GROUP BY 1)""", body="""
SELECT tf.uid, tf.z_nationkey, round(tf.tf * ln((SELECT count(DISTINCT uid) FROM samples_li) / df.d), 6) AS tfidf
FROM tf JOIN df ON tf.z_nationkey = df.z_nationkey"""))
def q_pref_tfidf(spark, sf):
    """TF-IDF preference of each user toward supplier nations."""
    t = SM.pref_tfidf(samples_li(spark, sf), "uid", "z_nationkey")
    return t.select("uid", "z_nationkey", r(F.col("tfidf"), "tfidf"))


@query("scan_days", sql="""
SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1""")
def q_scan_days(spark, sf):
    """Directory scan with a file-name glob (only lineitem files of the folder)."""
    d = SC.scan_days(spark, [sf], glob="lineitem*.parquet")
    return d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("trailing_days", sql=with_ctes(*LI, body="""
SELECT ds, count(*) AS n FROM samples_li WHERE ds BETWEEN DATE '1998-01-01' - INTERVAL 7 DAY AND DATE '1998-01-01' - INTERVAL 1 DAY
GROUP BY ds"""))
def q_trailing_days(spark, sf):
    """The 7 days before 1998-01-01, that day excluded."""
    s = SC.trailing_days(samples_li(spark, sf), "ds", "1998-01-01", 7)
    return s.groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


@query("split_train_test", sql=with_ctes(*LI, body=f"""
SELECT CASE WHEN {Q.stable_hash("concat_ws(':', '5', sample_id)")} < {int(0.1 * (1 << 60))} THEN 'test' ELSE 'train' END AS split,
       count(*) AS n, CAST(sum(y_ctr) AS BIGINT) AS clicks FROM samples_li GROUP BY 1"""))
def q_split_train_test(spark, sf):
    """Stable 90/10 train/test split by md5 of the sample key."""
    s = SC.split_train_test(samples_li(spark, sf), "sample_id", 0.1, seed=5)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("y_ctr").cast("bigint").alias("clicks"))


@query("shard_groups", sql=with_ctes(*LI, body=f"""
SELECT CAST(floor(({Q.stable_hash('sample_id')} % 200) / 40) AS BIGINT) AS shard_group, count(*) AS n
FROM samples_li GROUP BY 1"""))
def q_shard_groups(spark, sf):
    """200 shards → 5 sub-epoch groups of 40."""
    s = SC.shard_groups(samples_li(spark, sf), key="sample_id", n_shards=200, divisor=40)
    return s.groupBy("shard_group").agg(F.count(F.lit(1)).alias("n"))


@query("union_days", sql=with_ctes(*LI, body="""
SELECT year(ds) AS yr, count(*) AS n, count(wt) AS with_wt FROM (
  SELECT sample_id, ds, y_ctr, NULL::DOUBLE AS wt FROM samples_li WHERE year(ds) = 1996
  UNION ALL SELECT sample_id, ds, y_ctr, wt FROM samples_li WHERE year(ds) = 1997) GROUP BY 1"""))
def q_union_days(spark, sf):
    """Union of two day ranges whose schemas differ (missing column → null)."""
    s = samples_li(spark, sf)
    a = s.where(F.year("ds") == 1996).select("sample_id", "ds", "y_ctr")
    b = s.where(F.year("ds") == 1997).select("sample_id", "ds", "y_ctr", "wt")
    u = SC.union_days([a, b])
    return u.groupBy(F.year("ds").cast("bigint").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"), F.count("wt").alias("with_wt"))


@query("repeat_epochs", sql=with_ctes(*EV, body="""
SELECT CAST(e AS BIGINT) AS epoch, count(*) AS n, round(sum(watch_time), 6) AS watch FROM samples_ev, range(3) t(e) GROUP BY 1"""))
def q_repeat_epochs(spark, sf):
    s = SC.repeat_epochs(samples_ev(spark, sf), 3)
    return s.groupBy(F.col("epoch").cast("bigint").alias("epoch")).agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("watch_time"), "watch"))


@query("step_cap", sql=with_ctes(*LI, body="""
SELECT sample_id, y_ctr FROM samples_li ORDER BY sample_id LIMIT 5120"""))
def q_step_cap(spark, sf):
    """Stop after max_step (10) × batch_size (512) samples of a stable order."""
    return SC.step_cap(samples_li(spark, sf).select("sample_id", "y_ctr"), ["sample_id"], 10, 512)


@query("epoch_shuffle", sql=with_ctes(*LI, body="""
SELECT sample_id, CAST(e AS BIGINT) AS epoch, md5(concat_ws(':', '7', CAST(e AS VARCHAR), sample_id)) AS order_key
FROM samples_li, range(2) t(e)"""))
def q_epoch_shuffle(spark, sf):
    """Reproducible per-epoch global order (range-partitioned, sorted in
    partitions); two epochs."""
    s = SC.repeat_epochs(samples_li(spark, sf).select("sample_id"), 2)
    k = SC.epoch_order_key("sample_id", 7, F.col("epoch"))
    d = s.withColumn("order_key", k).repartitionByRange("order_key").sortWithinPartitions("order_key")
    return d.select("sample_id", F.col("epoch").cast("bigint").alias("epoch"), "order_key")


PEEK = ["acctbal_b", "price_b", "discount_b", "mktsegment_v", "nation_id", "z_brand_h", "seg_x_znation"]


@query("peek_features", sql=with_ctes(SAMPLES_LI_SQL, *Q.feature_ctes(li_spec(), "samples_li", ("sample_id",)),
                                      "one AS (SELECT * FROM feats ORDER BY sample_id LIMIT 1)", body=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM one" for c in PEEK)))
def q_peek_features(spark, sf):
    """First sample's features, one row per feature."""
    c = X.compile_features(samples_li(spark, sf), li_spec(), keep=["sample_id"])
    return SC.peek_features(c, PEEK, "sample_id")


@query("predict_batch", sql=with_ctes(*LR_SCORED_SQL, body="""
SELECT ds, sample_id, round(p, 6) AS p FROM scored_p WHERE ds BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"""))
def q_predict_batch(spark, sf):
    """The prediction table written for a test period, partitioned by day
    (``sources.scans.write_predictions``)."""
    s = _li_scored(spark, sf).where("ds between date'2000-01-01' and date'2000-12-31'")
    return s.select("ds", "sample_id", r(F.col("p"), "p"))


@query("predict_sink", sql=with_ctes(*LR_SCORED_SQL, body="SELECT ds, sample_id, round(p, 6) AS p FROM scored_p"))
def q_predict_sink(spark, sf):
    """Predictions of all days written by month and read back from the table."""
    path = f"{checkpoint_dir(spark)}/predictions-{uuid.uuid4().hex}"
    rows = _li_scored(spark, sf).select("ds", "sample_id", r(F.col("p"), "p"), F.date_format("ds", "yyyyMM").alias("month"))
    SC.write_predictions(rows, path, "month")
    return spark.read.parquet(path).select("ds", "sample_id", "p")
