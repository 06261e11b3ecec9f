"""Training-sample construction: assembly joins, labels, per-key caps,
trailing click-through rates, positives, negative sampling, weights.

Skew rules: a single user/item/pair may hold a third of all rows, so
per-key "first row" uses ``min_by`` (partial aggregation before the
shuffle) and per-key caps run in two stages — top-k inside (key, salt),
then top-k of the ≤ salt·k survivors per key. Trailing windows run on
daily pre-aggregates, so a window partition holds one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.features import stable_hash


# ---------------------------------------------------------------- J6 / J7
def assemble_samples(imp: DataFrame, users: DataFrame, items: DataFrame, uid: str = "uid",
                     item: str = "touid", item_prefix: str = "z_") -> DataFrame:
    """impressions ⋈ user features ⋈ item features (item columns prefixed).
    Left joins keep every impression; the planner picks broadcast only under
    its size threshold and AQE splits a hot item's partition."""
    it = items.select(F.col(item), *[F.col(c).alias(item_prefix + c) for c in items.columns if c != item])
    return imp.join(users, uid, "left").join(it, item, "left")


def follow_positives(imp: DataFrame, follows: DataFrame, keys=("uid", "touid", "ds"),
                     label: str = "y_ctr") -> DataFrame:
    """Impressions whose (user, item, day) later followed become positives."""
    f = follows.select(*keys).distinct().withColumn("_followed", F.lit(1))
    j = imp.join(f, list(keys), "left")
    return j.withColumn(label, F.when(F.col("_followed") == 1, F.lit(1.0)).otherwise(F.col(label))).drop("_followed")


# ---------------------------------------------------------------- A14
def watch_time_label(df: DataFrame, keys=("uid", "touid", "ds"), time_col: str = "watch_time",
                     threshold: float = 30.0, entry_filter: Column | None = None) -> DataFrame:
    """Total watch time per (user, item, day) — optionally only entries
    matching ``entry_filter`` — and a label = total >= threshold."""
    t = F.col(time_col) if entry_filter is None else F.when(entry_filter, F.col(time_col)).otherwise(F.lit(0.0))
    g = df.groupBy(*keys).agg(F.sum(t).alias("watch"), F.count(F.lit(1)).alias("n_entries"))
    return g.withColumn("label", (F.col("watch") >= F.lit(threshold)).cast("double"))


# ---------------------------------------------------------------- W1 / W2
def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """One row per key, the smallest by ``order_cols`` — an aggregate
    (``min_by`` over a struct), so hot keys are pre-reduced map-side."""
    others = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) for c in order_cols])
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), ordk).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def cap_per_key(df: DataFrame, keys, order_cols, cap: int, salt_col: str = "sample_id",
                salts: int = 16) -> DataFrame:
    """At most ``cap`` rows per key, first by ``order_cols`` (Columns or
    names; ties broken by them). Two-stage ranking with a hash salt so one
    dominant key is ranked by ``salts`` tasks, never by one."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_col), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    s1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= cap)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    s2 = s1.withColumn("_rank", F.row_number().over(w2)).where(F.col("_rank") <= cap)
    return s2.drop("_salt", "_r1")


# ---------------------------------------------------------------- W3
def day_number(c, string_days: bool = False) -> Column:
    """Days since 1970-01-01 of a date column (or of a ``yyyyMMdd`` string,
    the day-folder naming, with ``string_days``)."""
    col = F.col(c) if isinstance(c, str) else c
    if string_days:
        col = F.to_date(col, "yyyyMMdd")
    return F.datediff(col, F.lit("1970-01-01").cast("date"))


def trailing_ctr(df: DataFrame, key: str, day: str = "ds", label: str = "y_ctr",
                 windows=(1, 3, 7, 15, 30, 45, 60, 90), prefix: str = "ctr_") -> DataFrame:
    """Per (key, day): click-through rate over the N days *before* the day
    (day d never contributes to itself); 0 when there were no impressions.
    Daily pre-aggregation first, then range windows over the day number."""
    daily = df.groupBy(key, day).agg(F.sum(F.col(label)).alias("_clk"), F.count(F.lit(1)).alias("_imp"))
    return trailing_from_counts(daily, key, day, windows, prefix)


def trailing_from_counts(daily: DataFrame, key: str, day: str, windows, prefix: str = "ctr_") -> DataFrame:
    """``trailing_ctr`` from clicks ``_clk`` and impressions ``_imp`` per (key, day)."""
    out = daily.withColumn("_dn", day_number(day, dict(daily.dtypes).get(day) == "string"))
    for n in windows:
        w = Window.partitionBy(key).orderBy("_dn").rangeBetween(-n, -1)
        clk, imp = F.sum("_clk").over(w), F.sum("_imp").over(w)
        out = out.withColumn(f"{prefix}{n}", F.when(imp > 0, clk / imp).otherwise(F.lit(0.0)))
    return out.drop("_clk", "_imp", "_dn")


# ---------------------------------------------------------------- U3 / U4 / U5
def union_positives(samples: DataFrame, positives: DataFrame, keys=("uid", "touid", "ds"),
                    label: str = "y_ctr", order_cols=("ts", "sample_id")) -> DataFrame:
    """Union watch samples with follow positives, then one row per key,
    preferring a positive."""
    u = samples.unionByName(positives, allowMissingColumns=True)
    u = u.withColumn("_neg", -F.col(label))
    return first_per_key(u, list(keys), ["_neg", *order_cols]).drop("_neg")


def negative_sampling(df: DataFrame, label: str, key: str, rate: float, seed: int = 0) -> DataFrame:
    """Keep every positive and a reproducible ``rate`` share of negatives
    (60 bits of the md5 of seed:key, so every engine and every rerun keeps the
    same rows and no rate is too small)."""
    h = stable_hash(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.where((F.col(label) > 0) | (h < F.lit(int(rate * (1 << 60)))))


def time_weight(df: DataFrame, time_col: str, label: str, out: str = "wt") -> DataFrame:
    """Positives weighted 1 + ln(1 + watch time); negatives 1."""
    return df.withColumn(out, F.when(F.col(label) > 0, F.lit(1.0) + F.log1p(F.greatest(F.col(time_col), F.lit(0.0))))
                         .otherwise(F.lit(1.0)))


# ---------------------------------------------------------------- F26
def pref_tfidf(df: DataFrame, user: str, attr: str) -> DataFrame:
    """User preference toward an item attribute: tf = share of the user's
    rows with the attribute, idf = ln(#users / #users having it)."""
    ua = df.groupBy(user, attr).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(user)
    tf = ua.withColumn("_tf", F.col("_n") / F.sum("_n").over(w))
    n_users = ua.agg(F.count_distinct(user).alias("_users"))   # one row
    dfreq = ua.groupBy(attr).agg(F.count(F.lit(1)).alias("_df"))
    return tf.join(dfreq, attr).crossJoin(F.broadcast(n_users)).select(
        user, attr, (F.col("_tf") * F.log(F.col("_users").cast("double") / F.col("_df"))).alias("tfidf"))
