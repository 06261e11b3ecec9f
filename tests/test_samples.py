import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankforge.operators import samples as SM


def d(s):
    return dt.date.fromisoformat(s)


def test_trailing_ctr_gaps_first_day_and_no_leak(spark):
    rows = [("u", d("2024-01-01"), 1.0), ("u", d("2024-01-01"), 0.0), ("u", d("2024-01-02"), 1.0),
            ("u", d("2024-01-05"), 0.0), ("u", d("2024-01-05"), 0.0)]
    df = spark.createDataFrame(rows, "uid string, ds date, y_ctr double")
    got = {r.ds: r for r in SM.trailing_ctr(df, "uid", windows=(1, 3, 7)).collect()}
    assert got[d("2024-01-01")].ctr_7 == 0.0                       # first day: nothing before → 0
    assert got[d("2024-01-02")].ctr_1 == 0.5                       # only day 1
    assert got[d("2024-01-05")].ctr_1 == 0.0                       # gap: day 4 absent
    assert got[d("2024-01-05")].ctr_3 == pytest.approx(1.0)        # days 2..4 → day 2 only
    assert got[d("2024-01-05")].ctr_7 == pytest.approx(2 / 3)      # days 1,2 (day 5 excluded)


def test_cap_ties_broken_by_id(spark):
    rows = [("u", d("2024-01-01"), 5, i) for i in range(9, 0, -1)] + [("v", d("2024-01-01"), 1, 100)]
    df = spark.createDataFrame(rows, "uid string, ds date, ts int, sample_id int")
    got = SM.cap_per_key(df, ["uid", "ds"], ["ts", "sample_id"], 5, salts=4)
    u = sorted((r._rank, r.sample_id) for r in got.where("uid = 'u'").collect())
    assert u == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert got.where("uid = 'v'").count() == 1
    first = SM.first_per_key(df, ["uid", "ds"], ["ts", "sample_id"]).where("uid = 'u'").first()
    assert first.sample_id == 1


def test_negative_sampling_keeps_positives_and_is_stable(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("double").alias("y"))
    a = SM.negative_sampling(df, "y", "k", 0.3, seed=1)
    assert a.where("y = 1").count() == 200
    n = a.where("y = 0").count()
    assert 400 < n < 680
    b = SM.negative_sampling(df, "y", "k", 0.3, seed=1)
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())


def test_union_positives_prefers_positive(spark):
    s = spark.createDataFrame([(1, "u", 7, d("2024-01-01"), 1, 0.0)], "sample_id int, uid string, touid int, ds date, ts int, y_ctr double")
    p = spark.createDataFrame([(2, "u", 7, d("2024-01-01"), 9, 1.0)], "sample_id int, uid string, touid int, ds date, ts int, y_ctr double")
    r = SM.union_positives(s, p).collect()
    assert len(r) == 1 and r[0].sample_id == 2 and r[0].y_ctr == 1.0


def test_watch_label_follow_and_weight(spark):
    df = spark.createDataFrame([("u", 1, d("2024-01-01"), 20.0, "view"), ("u", 1, d("2024-01-01"), 15.0, "view"),
                                ("u", 2, d("2024-01-01"), 50.0, "error")],
                               "uid string, touid int, ds date, watch_time double, event_type string")
    g = {r.touid: r for r in SM.watch_time_label(df, threshold=30.0, entry_filter=F.col("event_type") == "view").collect()}
    assert g[1].label == 1.0 and g[2].label == 0.0 and g[2].n_entries == 1
    imp = df.withColumn("y_ctr", F.lit(0.0))
    fol = spark.createDataFrame([("u", 2, d("2024-01-01"))], "uid string, touid int, ds date")
    f = {r.touid: r.y_ctr for r in SM.follow_positives(imp, fol).collect()}
    assert f[2] == 1.0 and f[1] == 0.0
    tw = SM.time_weight(imp.withColumn("y_ctr", F.lit(1.0)), "watch_time", "y_ctr").first()
    assert tw.wt == pytest.approx(1 + __import__("math").log1p(20.0))


def test_pref_tfidf(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y")], "u string, attr string")
    got = {(r.u, r.attr): r.tfidf for r in SM.pref_tfidf(df, "u", "attr").collect()}
    import math
    assert got[("a", "x")] == pytest.approx(2 / 3 * math.log(2 / 1))
    assert got[("a", "y")] == pytest.approx(0.0)


def test_trailing_ctr_string_days(spark):
    rows = [("u", "20240101", 1.0), ("u", "20240102", 0.0), ("u", "20240103", 1.0)]
    df = spark.createDataFrame(rows, "uid string, ds string, y_ctr double")
    got = {r.ds: r.ctr_2 for r in SM.trailing_ctr(df, "uid", windows=(2,)).collect()}
    assert got == {"20240101": 0.0, "20240102": 1.0, "20240103": 0.5}


def test_walk_forward_uses_only_past_days(spark):
    from rankforge.operators.training import walk_forward
    rows = [("a", d("2024-01-01"), 1.0), ("b", d("2024-01-01"), 0.0),
            ("a", d("2024-01-02"), 1.0), ("b", d("2024-01-02"), 0.0)]
    df = spark.createDataFrame(rows, "k string, ds date, y_ctr double")
    got = {r.ds: r for r in walk_forward(df, "k", window=7).collect()}
    assert got[d("2024-01-01")].auc == 0.5          # no history: every score 0 → all ties
    assert got[d("2024-01-02")].auc == 1.0          # day-1 CTRs rank day 2 perfectly


def test_very_small_sampling_rate(spark):
    df = spark.range(100_000).select(F.lit(0).alias("y"), F.col("id").alias("k"))
    n = SM.negative_sampling(df, "y", "k", 0.0004).count()
    assert 15 <= n <= 80
