import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankforge.operators import joint as J
from rankforge.operators import networks as N
from rankforge.operators.lookup import checked_params
from rankforge.operators.samples import trailing_ctr
from rankforge.plans.demo import li_spec, samples_li
from rankforge.sources.typed import typed_read
from rankforge.streaming.ingest import ingest_trailing


def test_trailing_ingest_equals_recomputation(spark, tmp_path):
    schema = "touid long, ds date, y_ctr double"
    day = dt.date(2020, 1, 1)
    files = [[(i % 3, day + dt.timedelta(days=d), float(i % 2)) for i in range(7) for d in days] for days in ((5, 6), (7,), (1, 5, 9), (8,))]
    source, out, seen = tmp_path / "in", str(tmp_path / "out"), []
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        seen += rows
        path = ingest_trailing(spark, str(source), schema, "*.parquet", "touid", (1, 3), lambda b: b, out)
        got = spark.read.parquet(path).select("touid", "ds", "ctr_1", "ctr_3")
        want = trailing_ctr(spark.createDataFrame(seen, schema), "touid", windows=(1, 3)).select("touid", "ds", "ctr_1", "ctr_3")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), n


def test_walk_forward_continues_from_committed_runs(spark, sf_small, tmp_path):
    net, rule, path = N.FM(["nation_id", "z_nation_id"], 2), J.Rule("adagrad", 0.1), str(tmp_path / "runs")
    s = samples_li(spark, sf_small).withColumn("period", F.year("ds"))
    years = sorted(r.period for r in s.select("period").distinct().collect())[:3]
    s = s.where(F.col("period").isin(years))
    rows = J.stored(J.training_rows(s, li_spec(), net, {"ctr": "y_ctr"}, keep=("period",)))
    first = J.start_model(spark, li_spec(), net, rule)
    args = (rows, "period", net, first, {"ctr": "y_ctr"}, 50, path, rule)
    runs = [(now, after, m.step, p.count()) for now, after, m, p in J.walk_forward_runs(*args)]
    sizes = {r.period: r["count"] for r in rows.groupBy("period").count().collect()}
    a, b, c = years
    assert runs == [(a, b, 1, sizes[b]), (b, c, 2, sizes[c])]
    assert J.committed_runs(spark, path) == [str(a), str(b)]
    assert [m.step for _, _, m, _ in J.walk_forward_runs(*args)] == [1, 2]  # nothing is trained again


def test_parameter_tables_are_checked(spark):
    fields = [("a", 0, 3, False)]
    ok = spark.createDataFrame([(0, 0, 1.0), (0, 2, 1.0), (9, 7, 1.0)], "fid long, bucket long, w double")
    assert checked_params(ok, fields) is ok
    for extra in ([(0, 2, 5.0)], [(0, 1, 1.0), (0, 3, 1.0)]):
        with pytest.raises(ValueError):
            checked_params(ok.unionByName(spark.createDataFrame(extra, ok.schema)), fields)


def test_typed_read_fills_nan_and_checks_lengths(spark):
    df = spark.createDataFrame([(float("nan"), [1.0, float("nan")]), (None, None), (2.0, [3.0, 4.0])], "a double, v array<double>")
    got = typed_read(df, [("a", "float", 1, -1.0), ("v", "float", 2, 0.5)]).collect()
    assert [(r.a, r.v) for r in got] == [(-1.0, [1.0, 0.5]), (-1.0, [0.5, 0.5]), (2.0, [3.0, 4.0])]
    with pytest.raises(Exception):
        typed_read(spark.createDataFrame([([1.0],)], "v array<double>"), [("v", "float", 2, 0.0)]).collect()
