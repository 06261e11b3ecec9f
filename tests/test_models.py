import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import models as MD
from rankforge.operators.lookup import id_fields, init_value, param_table
from rankforge.operators.scoring import score_fm, score_lr
from rankforge.spec import parse_ini

SPEC = parse_ini("""
[a]
ftype = cat_id
num_buckets = 5
group = linear,dnn
[b]
ftype = cat_vocab
vocab = x,y,z
group = linear,dnn
[c]
ftype = bucketized
fname = v
boundaries = 0.0,1.0
group = linear,dnn
""")


def data(spark):
    return spark.createDataFrame([("s1", 1, "y", 0.5, 1.0), ("s2", 4, "q", -3.0, 0.0), ("s3", 9, "x", 2.0, 1.0)],
                                 "sample_id string, a bigint, b string, v double, y_ctr double")


def w(fid, b, d=0):
    return ((fid * 7919 + b * 104729 + d * 1299709) % 2001 - 1000) / 10000.0


def ids_of(row):
    out = []
    if 0 <= row["a"] < 5:
        out.append((0, row["a"]))
    if row["b"] in ("x", "y", "z"):
        out.append((1, ("x", "y", "z").index(row["b"])))
    out.append((2, 0 if row["v"] < 0 else 1 if row["v"] < 1 else 2))
    return out


def test_fm_identity_equals_explicit_pairs(spark):
    D = 3
    got = {r.sample_id: r.logit for r in score_fm(data(spark), SPEC, dim=D).collect()}
    for row in data(spark).collect():
        ids = ids_of(row)
        lin = sum(w(f, b) for f, b in ids)
        pair = sum(sum(w(f1, b1, d) * w(f2, b2, d) for d in range(D))
                   for (f1, b1), (f2, b2) in itertools.combinations(ids, 2))
        assert got[row["sample_id"]] == pytest.approx(lin + pair, abs=1e-12)


def test_lr_unknown_ids_ignored_and_bias(spark):
    got = {r.sample_id: r.logit for r in score_lr(data(spark), SPEC).collect()}
    # bias row fid = -1 uses Java-style remainder: (-7919 % 2001) = -1916
    bias = (-1916 - 1000) / 10000.0
    for row in data(spark).collect():
        assert got[row["sample_id"]] == pytest.approx(sum(w(f, b) for f, b in ids_of(row)) + bias, abs=1e-12)


def test_long_and_wide_inputs_agree(spark, monkeypatch):
    import rankforge.operators.models as models
    wide = {r.sample_id: r for r in MD.sparse_inputs(data(spark), SPEC, 2, ["a", "b", "c"], ["a", "b", "c"]).collect()}
    monkeypatch.setattr(models, "fits_broadcast", lambda *a, **k: False)
    long = {r.sample_id: r for r in MD.sparse_inputs(data(spark), SPEC, 2, ["a", "b", "c"], ["a", "b", "c"]).collect()}
    for k in wide:
        for c in wide[k].asDict():
            if c != "sample_id":
                assert wide[k][c] == pytest.approx(long[k][c], abs=1e-12)


def test_esmm_and_mmoe_invariants(spark):
    rng = np.random.default_rng(0)
    X = [list(map(float, rng.normal(size=6))) for _ in range(50)]
    df = spark.createDataFrame([(x,) for x in X], "x array<double>")
    e = df.select(MD.esmm_heads(F.col("x"), 6, [4]).alias("h")).select("h.*").collect()
    assert all(r.p_ctcvr <= r.p_ctr + 1e-15 and abs(r.p_ctcvr - r.p_ctr * r.p_cvr) < 1e-15 for r in e)
    m = df.select(MD.mmoe_heads(F.col("x"), 6, 3, 4, (2,)).alias("h")).select("h.*").collect()
    assert all(0 < r.p_ctr < 1 and r.p_ctcvr <= r.p_ctr for r in m)
    # gates: softmax rows sum to one
    experts, gates, _ = MD.mmoe_params(6, 3, 4, 2, (2,))
    G, g = gates[0]
    z = np.array(X) @ G + g
    sm = np.exp(z - z.max(axis=1, keepdims=True))
    sm /= sm.sum(axis=1, keepdims=True)
    assert np.allclose(sm.sum(axis=1), 1.0)


def test_dense_apply_matches_numpy(spark):
    X = [[1.0, -2.0, 0.5], [0.0, 0.0, 0.0]]
    df = spark.createDataFrame([(x,) for x in X], "x array<double>")
    layers = MD.mlp_params(0, [3, 4, 1])
    got = [r[0] for r in df.select(MD.mlp_logit(F.col("x"), 3, 0, [4])).collect()]
    assert np.allclose(got, MD.forward(np.array(X), layers)[:, 0])


def test_two_class_and_dot(spark):
    df = spark.createDataFrame([(0.7, [1.0, 2.0], [3.0, -1.0])], "p double, a array<double>, b array<double>")
    r = df.select(*MD.two_class_outputs(F.col("p")), MD.dot(F.col("a"), F.col("b")).alias("d"),
                  MD.cosine(F.col("a"), F.col("b")).alias("c")).first()
    assert r.p0 == pytest.approx(0.3) and r.class_id == 1 and r.d == 1.0
    assert r.c == pytest.approx(1.0 / (np.sqrt(5) * np.sqrt(10)))


def test_param_table_parallel_and_exact(spark):
    fields = id_fields(SPEC)
    t = param_table(spark, fields, dim=2).collect()
    assert len(t) == 5 + 3 + 3 + 1
    for r in t:
        if r.fid >= 0:
            assert r.vec == [w(r.fid, r.bucket, 0), w(r.fid, r.bucket, 1)]


def test_gathered_sums(spark):
    """Sums over the fields in one array column; unknown ids and null values read 0."""
    from rankforge.operators.lookup import gather_sums
    df = spark.createDataFrame([(1, 0, 1), (2, 5, 0), (3, None, -1)], "id int, a long, b long")
    table = spark.createDataFrame([(0, 0, 1.5, 2.0), (1, 0, 10.0, None), (1, 1, 20.0, 0.25)], "fid long, bucket long, w double, v double")
    got = gather_sums(df, [("a", 0, 9, False), ("b", 1, 9, False)], table, [F.col("w"), F.col("v")])
    assert {r.id: r._sums for r in got.collect()} == {1: [21.5, 2.25], 2: [10.0, 0.0], 3: [0.0, 0.0]}


def test_linear_lookup_does_not_sort_the_ids(spark, sf_small, capsys):
    from rankforge.plans.registry import QUERIES
    QUERIES["linear_lookup"](spark, sf_small).explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan
