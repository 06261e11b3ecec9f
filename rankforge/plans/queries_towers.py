"""Two towers as networks (M12) and retrieval over the whole catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import models as MD
from rankforge.operators import retrieval as R
from rankforge.operators.metrics import sigmoid
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_EV_SQL, samples_ev
from rankforge.sources.tables import read_table

USER, ITEM, K = [3, 16, 8], [64, 16, 8], 10  # sizes of the towers, heads 50 and 51


def r(c, name, digits=6):
    return rnd(c, name, digits)


def vectors(spark, sf):
    """(samples, user vectors, item vectors): users by their activity, items by
    their stored embedding; every user and item of the samples counts as often
    in the statistics of its tower as it has samples."""
    ev = samples_ev(spark, sf).select("sample_id", "uid", "touid", "y_ctr", "watch_time")
    users = ev.groupBy("uid").agg(F.count("*").alias("n"), F.avg("y_ctr").alias("c"), F.avg("watch_time").alias("t"))
    users = users.select("uid", "n", F.array(F.log1p(F.col("n").cast("double")), "c", F.col("t") / 100).alias("x"))
    shown = ev.groupBy("touid").agg(F.count("*").alias("n"))
    items = read_table(spark, sf, "embeddings", ["vec_id", "embedding"]).select(
        F.col("vec_id").alias("touid"), F.col("embedding").cast("array<double>").alias("x")).join(shown, "touid", "left").fillna(0, ["n"])
    return (ev, R.tower_vectors(users, "uid", "x", USER, 50, count="n", digits=9),
            R.tower_vectors(items, "touid", "x", ITEM, 51, count="n", digits=9))


def _tower_sql(src: str, key: str, sizes, head: int, name: str) -> list[str]:
    """From ``src`` (key, n, i, v) by layer: weighted batch normalisation of relu outputs."""
    out, prev = [], src
    for layer, b in enumerate(sizes[1:]):
        w = Q.init_value(str(1000 + 10 * head + layer), "x.i", "r.j")
        out += [f"{name}h{layer} AS (SELECT {key}, any_value(n) AS n, r.j AS i, greatest(sum(x.v * {w}), 0) AS v FROM {prev} x, range({b}) r(j) GROUP BY {key}, r.j)",
                f"{name}m{layer} AS (SELECT i, sum(n * v) / sum(n) AS m FROM {name}h{layer} GROUP BY i)",
                f"{name}s{layer} AS (SELECT i, any_value(m) AS m, sum(n * pow(v - m, 2)) / sum(n) AS s FROM {name}h{layer} JOIN {name}m{layer} USING (i) GROUP BY i)",
                f"{name}b{layer} AS (SELECT {key}, n, i, (v - m) / sqrt(s + 0.001) AS v FROM {name}h{layer} JOIN {name}s{layer} USING (i))"]
        prev = f"{name}b{layer}"
    return [*out, f"{name} AS (SELECT {key}, i, round(v, 9) AS v FROM {prev})"]


SQL = [SAMPLES_EV_SQL,
       "ua AS (SELECT uid, count(*) AS n, avg(y_ctr) AS c, avg(watch_time) AS t FROM samples_ev GROUP BY uid)",
       """ux AS (SELECT uid, n, 0 AS i, ln(1 + n::DOUBLE) AS v FROM ua UNION ALL SELECT uid, n, 1, c FROM ua
           UNION ALL SELECT uid, n, 2, t / 100 FROM ua)""",
       """ix AS (SELECT vec_id AS touid, coalesce(n, 0) AS n, i - 1 AS i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings
           LEFT JOIN (SELECT touid, count(*) AS n FROM samples_ev GROUP BY touid) s ON s.touid = vec_id, range(1, 65) t(i))""",
       *_tower_sql("ux", "uid", USER, 50, "uv"), *_tower_sql("ix", "touid", ITEM, 51, "iv")]


@query("score_towers", sql=with_ctes(*SQL, body=f"""
SELECT sample_id, round(z, 5) AS score, round({Q.sigmoid('z')}, 5) AS p FROM (
  SELECT sample_id, sum(u.v * w.v) AS z FROM samples_ev e JOIN uv u ON u.uid = e.uid JOIN iv w ON w.touid = e.touid AND w.i = u.i GROUP BY sample_id)"""))
def q_score_towers(spark, sf):
    """Score of every sample: inner product of the user's and the item's tower output."""
    ev, users, items = vectors(spark, sf)
    s = ev.select("sample_id", "uid", "touid").join(users.withColumnRenamed("vec", "u"), "uid").join(items.withColumnRenamed("vec", "i"), "touid") \
        .select("sample_id", MD.dot(F.col("u"), F.col("i")).alias("score"))
    return s.select("sample_id", r(F.col("score"), "score", 5), r(sigmoid("score"), "p", 5))


@query("topk_catalogue", sql=with_ctes(*SQL, f"""
d AS (SELECT uid, touid, round(sum(u.v * w.v), 9) AS score FROM uv u JOIN iv w ON w.i = u.i GROUP BY uid, touid)""", body=f"""
SELECT uid, rk AS rank, touid, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, touid) AS rk FROM d) WHERE rk <= {K}"""))
def q_topk_catalogue(spark, sf):
    """The ten best items of the whole catalogue for every user."""
    _, users, items = vectors(spark, sf)
    return R.top_items(users, items, K).withColumn("score", r(F.col("score"), "score"))
