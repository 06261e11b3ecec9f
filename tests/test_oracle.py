"""Every registered query against its SQL oracle on the smallest tables
(rows-only queries must run and return rows)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(rows, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


# SQL result type → Spark type name
TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "INTEGER": "int",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}

SLOW = {"train_gbt", "score_gbt", "train_fm", "train_lr", "train_eval_loop", "gradnorm_weights", "train_deep"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    if name in SLOW and os.environ.get("RANKFORGE_FAST_TESTS"):
        pytest.skip("slow trainer")
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    sql_types = {c: TYPES.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    assert dict(df.dtypes) == sql_types
    assert _rows(rows, df.columns) == _rows(rel.fetchall(), rel.columns)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["ds", "n", "auc", "logloss"]
    assert df.count() > 0
