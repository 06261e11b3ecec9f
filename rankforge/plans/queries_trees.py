"""Boosted trees by histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions.features import compile_features
from rankforge.operators import boosting as B
from rankforge.operators import metrics as M
from rankforge.operators.lookup import id_fields
from rankforge.plans import sqlgen as Q
from rankforge.plans.catalog import query, rnd, with_ctes
from rankforge.plans.demo import SAMPLES_LI_SQL, li_spec, samples_li
from rankforge.session import written
from rankforge.sources import scans as SC

FIELDS = [(f, n) for f, _, n, _ in id_fields(li_spec())]
NAMES, BINS = [f for f, _ in FIELDS], [n + 1 for _, n in FIELDS]
L1, L2 = 0.01, 0.01


def r(c, name, digits=6):
    return rnd(c, name, digits)


def _rows(spark, sf):
    feats = compile_features(samples_li(spark, sf), li_spec(), keep=["sample_id", "y_ctr", "wt"])
    return B.binned(feats, NAMES, "y_ctr", "wt", keep=("sample_id",))


def _cuts_sql():
    parts = " UNION ALL ".join(f"SELECT {i} AS feature, greatest(coalesce({f}, -1) + 1, 0) AS bin, y_ctr AS y, wt AS w FROM feats"
                               for i, f in enumerate(NAMES))

    def s(g, h):
        return f"pow(greatest(abs({g}) - {L1}, 0), 2) / ({h} + {L2})"
    return with_ctes(
        SAMPLES_LI_SQL, *Q.feature_ctes(li_spec(), "samples_li", ("sample_id", "y_ctr", "wt")),
        "b AS (SELECT sum(wt * y_ctr) / sum(wt) AS p FROM feats)",
        f"c AS (SELECT feature, bin, sum(w * (b.p - y)) AS g, sum(w * b.p * (1 - b.p)) AS h FROM ({parts}), b GROUP BY 1, 2)",
        """d AS (SELECT feature, bin, sum(g) OVER x AS gl, sum(h) OVER x AS hl, sum(g) OVER (PARTITION BY feature) AS g,
            sum(h) OVER (PARTITION BY feature) AS h, max(bin) OVER (PARTITION BY feature) AS last FROM c WINDOW x AS (PARTITION BY feature ORDER BY bin))""",
        body=f"""SELECT CAST(feature AS INTEGER) AS feature, CAST(bin AS INTEGER) AS cut, round(gl, 5) AS g_left, round(hl, 5) AS h_left,
            round(({s('gl', 'hl')} + {s('(g - gl)', '(h - hl)')} - {s('g', 'h')}) / 2, 5) AS gain FROM d WHERE bin < last""")


@query("tree_cuts", sql=_cuts_sql())
def q_tree_cuts(spark, sf):
    """Every cut of the root of the first tree: gradient sums on its left and its gain."""
    rows = _rows(spark, sf)
    mean = rows.agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("p")).first().p
    cells = B.histograms(rows.withColumn("logit", F.lit(mean / (1 - mean))).withColumn("logit", F.log("logit")), {}, 0, BINS)
    return B.cuts(cells, L1, L2).select("feature", "cut", *(r(F.col(c), c, 5) for c in ("g_left", "h_left", "gain")))


TREES, DEPTH = 8, 6  # about 12 s a tree of depth 10 on local[8]: 100 of them take 20 minutes


@query("train_trees")
def q_train_trees(spark, sf):
    """Weighted boosted trees with L1/L2 leaves on all samples of the training
    split: AUC of both splits and the size of the model."""
    # training and scoring read the samples several times
    d = written(SC.split_train_test(_rows(spark, sf), "sample_id", 0.2, seed=3).drop("sample_id"))
    model = B.train_trees(d.where("split = 'train'"), BINS, TREES, DEPTH, 0.2, L1, L2)
    s = B.score_trees(d, model)
    return M.auc_exact(s, "y", "p", "w", ["split"]).select("split", r(F.col("auc"), "auc"),
                                                           F.lit(len(model.nodes)).cast("long").alias("n_nodes"))
