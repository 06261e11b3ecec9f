import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import factorization as FM


def rows_of(spark, n=400):
    rng = np.random.default_rng(2)
    rows = [(int(a), int(b), int(c), float((a + b * c + e) % 3 == 0)) for a, b, c, e in zip(
        rng.integers(0, 5, n), rng.integers(0, 40, n), rng.integers(0, 3, n), rng.integers(0, 2, n))]
    return spark.createDataFrame(rows, "a int, b int, c int, y_ctr double").repartition(3)


@pytest.mark.parametrize("group_ids", [1, 30, 4_096])
def test_fm_equals_mllib_on_one_hot_vectors(spark, monkeypatch, group_ids):
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.functions import vector_to_array

    from rankforge.operators.training import onehot_features
    monkeypatch.setattr(FM, "BLOCK_ROWS", 64)
    monkeypatch.setattr(FM, "GROUP_IDS", group_ids)
    df = rows_of(spark).cache()
    hot = onehot_features(df.select(*(F.col(c).cast("double") for c in "abc"), "y_ctr"), list("abc"))
    want = FMClassifier(featuresCol="features", labelCol="y_ctr", factorSize=4, regParam=0.01, maxIter=20, stepSize=0.05, solver="adamW", seed=1).fit(hot)
    model = FM.train_id_fm(df, list("abc"), "y_ctr")
    assert model.iterations == 20
    assert model.table[:, :-1] == pytest.approx(want.factors.toArray(), abs=1e-9)
    assert model.table[:, -1] == pytest.approx(want.linear.toArray(), abs=1e-9) and model.intercept == pytest.approx(want.intercept, abs=1e-9)
    p = {(int(r.a), int(r.b), int(r.c)): r.p for r in want.transform(hot).select(*"abc", vector_to_array("probability")[1].alias("p")).collect()}
    assert {(r.a, r.b, r.c): r.p for r in FM.score_id_fm(df, model).collect()} == pytest.approx(p, abs=1e-9)


def test_fm_edges(spark):
    schema = "a int, b int, y_ctr double"
    for rows in ([], [(0, 0, None)], [(0, 0, 0.5)], [(None, 0, 1.0)], [(-1, 0, 1.0)]):
        with pytest.raises(Exception):
            FM.train_id_fm(spark.createDataFrame(rows, schema), ["a", "b"], "y_ctr", max_iter=1)
    model = FM.train_id_fm(spark.createDataFrame([(0, 70_000, 1.0), (1, 3, 0.0)], schema), ["a", "b"], "y_ctr", max_iter=2)
    assert model.sizes == [3, 70_002] and FM.score_id_fm(spark.createDataFrame([(5, 80_000, 1.0)], schema), model).first().p > 0


def test_query_trains_the_whole_fm(spark, sf_small, monkeypatch):
    """As many iterations as the operator's default."""
    from rankforge.operators import training
    from rankforge.plans import queries_train
    seen, plain = [], FM.train_id_fm
    monkeypatch.setattr(FM, "train_id_fm", lambda *a: seen.append(plain(*a)) or seen[-1])
    queries_train.q_train_fm(spark, sf_small).collect()
    assert [m.iterations for m in seen] == [20] == [inspect.signature(training.train_fm).parameters["max_iter"].default]
