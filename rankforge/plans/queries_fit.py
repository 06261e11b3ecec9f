"""Fitting queries (A1-A4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators.fit import (approx_quantiles, boundary_ranks, fit_all_features, fit_boundaries,
                                     norm_stats)
from rankforge.plans.catalog import pyround, query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_LI_SQL, samples_li
from rankforge.sources.tables import read_table
from rankforge.spec import parse_ini

AUTO = {"price": 10, "acctbal": 20, "discount": 30, "z_size": 15}


def _q_sql(feature: str, expr: str, n: int, src: str) -> str:
    probs = ", ".join(repr(rk / 100.0) for rk in boundary_ranks(n))
    return (f"SELECT '{feature}' AS feature, unnest(range(1, {n})) AS i, "
            f"unnest(quantile_cont({expr}, [{probs}])) AS v FROM {src}")


def _boundaries_sql(parts: str) -> str:
    return f"""q AS ({parts}),
    k AS (SELECT *, lag(v) OVER (PARTITION BY feature ORDER BY i) AS pv FROM q),
    kept AS (SELECT feature, i, v FROM k WHERE pv IS NULL OR v > pv)"""


def _rows(spark, fitted: dict, name="boundary"):
    rows = [(c, i, pyround(float(v))) for c, vs in fitted.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, f"feature string, idx bigint, {name} double")


@query("fit_boundaries", sql=with_ctes(
    SAMPLES_LI_SQL,
    _boundaries_sql(" UNION ALL ".join(_q_sql(c, c, n, "samples_li") for c, n in AUTO.items())
                    + " UNION ALL " + _q_sql("embedding", "CAST(x AS DOUBLE)", 8,
                                             "(SELECT unnest(embedding) AS x FROM embeddings)")),
    body="""SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY i) - 1 AS BIGINT) AS idx,
       round(v, 6) AS boundary FROM kept"""))
def q_fit_boundaries(spark, sf):
    """Exact quantile boundaries (truncated ranks, duplicates collapsed) for
    four sample columns and one pooled 64-wide vector."""
    b = fit_boundaries(samples_li(spark, sf), AUTO)
    e = read_table(spark, sf, "embeddings", ["embedding"])
    b.update(fit_boundaries(e, {"embedding": 8}, vector_cols=("embedding",)))
    return _rows(spark, b)


@query("fit_boundaries_approx")
def q_fit_boundaries_approx(spark, sf):
    """A2: approximate quantiles over the full data (no oracle: values may
    differ from exact by the configured rank error)."""
    s = samples_li(spark, sf)
    probs = {c: [rk / 100.0 for rk in boundary_ranks(n)] for c, n in AUTO.items()}
    q = approx_quantiles(s, probs)
    from rankforge.operators.fit import keep_increasing
    return _rows(spark, {c: keep_increasing(v) for c, v in q.items()})


NORM_COLS = ("price", "acctbal", "z_price", "discount")


@query("fit_norm_stats", sql=with_ctes(SAMPLES_LI_SQL, body=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, unnest(['max', 'mean', 'min', 'std']) AS stat,
    round(unnest([quantile_cont({c}, 0.99), avg(CAST({c} AS DECIMAL(38,12)))::DOUBLE, quantile_cont({c}, 0.01), stddev_pop({c})]), 6) AS value
    FROM samples_li""" for c in NORM_COLS)))
def q_fit_norm_stats(spark, sf):
    st = norm_stats(samples_li(spark, sf), list(NORM_COLS))
    rows = [(c, k, pyround(float(v))) for c, d in st.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "feature string, stat string, value double")


FIT_SPEC = parse_ini("""
[label]
ftype = numeric
group = norm

[price_n]
ftype = numeric
fname = price
group = dnn,norm

[tax_n]
ftype = numeric
fname = tax
group = norm

[price_b]
ftype = bucketized
fname = price
boundaries = 0.0
auto_boundaries = 10
group = linear

[acctbal_b]
ftype = bucketized
fname = acctbal
boundaries = 0.0
auto_boundaries = 20
group = linear

[size_b]
ftype = bucketized
fname = z_size
boundaries = 0.0
auto_boundaries = 5
group = linear
""")


@query("fit_all_features", sql=with_ctes(
    SAMPLES_LI_SQL,
    _boundaries_sql(" UNION ALL ".join([_q_sql("price_b", "price", 10, "samples_li"),
                                        _q_sql("acctbal_b", "acctbal", 20, "samples_li"),
                                        _q_sql("size_b", "z_size", 5, "samples_li")])),
    body="""SELECT feature, 'boundaries' AS stat,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY i) - 1 AS BIGINT) AS idx, round(v, 6) AS value FROM kept
    UNION ALL
    SELECT feature, unnest(['max', 'mean', 'min', 'std']) AS stat, CAST(0 AS BIGINT) AS idx,
           round(unnest([quantile_cont(x, 0.99), avg(CAST(x AS DECIMAL(38,12)))::DOUBLE, quantile_cont(x, 0.01), stddev_pop(x)]), 6) AS value
    FROM (SELECT 'price_n' AS feature, price AS x FROM samples_li UNION ALL SELECT 'tax_n', tax FROM samples_li)
    GROUP BY feature"""))
def q_fit_all_features(spark, sf):
    """One fitting pass over a spec: boundaries where auto_boundaries > 0,
    stats for numeric features in the norm group (label excluded); output is
    the fitted-spec table, exploded."""
    s = samples_li(spark, sf).withColumn("label", F.col("y_ctr"))
    _, table = fit_all_features(s, FIT_SPEC)
    return table.select("feature", "stat", F.posexplode("values").alias("idx", "value")).select(
        "feature", "stat", F.col("idx").cast("bigint").alias("idx"), rnd("value", "value"))
