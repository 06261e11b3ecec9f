import hashlib
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_ngram_join import brute
from test_pii import base

import __spark_entry__
import corpus_pipeline
from rankforge.llm import bpe, queries

TABLES = ["documents", "pages", "embeddings", "benchmark", "conversations"]


def test_pipeline_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    extra = docs.limit(5).union(spark.createDataFrame([(None, None, None, None, None), (7001, "123", "en", "src0", 3)], docs.schema))
    docs, seen = docs.union(extra), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_small)
        if i < 4:
            assert out.columns == docs.columns
        seen.append((docs.collect(), out.collect()))
        docs = spark.createDataFrame(seen[-1][1], out.schema)

    before, after = seen[0]
    gone = Counter(r.doc_id for r in before) - Counter(r.doc_id for r in after)
    assert set(gone) >= {None, 7001} and len(gone) <= 4

    before, after = seen[1]
    groups = brute([(r.doc_id, r.text) for r in before], 3, 90)
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in groups})
    assert set(after) <= set(before)

    before, after = seen[2]
    assert len(before) == len(after) and all(base(r.text) == "" and r.n_chars == len(r.text) for r in after)
    clean = {r.doc_id: r.text for r in before if base(r.text) == "" and "token" not in r.text}
    assert all(r.text == clean[r.doc_id] for r in after if r.doc_id in clean)

    before, after = seen[3]
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(words(after) - 1.5 * words(before)) <= len({r.source for r in before})
    assert max(Counter((r.doc_id) for r in after).values()) <= 3

    before, after = seen[4]
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = bpe.MergeReplay(f.read(), P.PATTERN).rank
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in before:
        ids = enc.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after) == want


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_small)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(want, key=str)


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


def test_stages_with_clashing_columns_and_empty_tables(spark, sf_small):
    names = ["score", "rejected", "pii", "copies", "part_words", "component_id", "key", "sigs", "target", "size", "row"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(40)
    for i, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(i))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_small).collect() == []
        out = stage(spark, docs, sf_small)
        if name != "byte_bpe":
            assert out.columns == docs.columns
            assert all(tuple(r[c] for c in names) == tuple(range(len(names))) for r in out.collect())


def test_near_duplicate_stage_keeps_one_of_each_group_by_content(spark):
    words = lambda name: [f"{name}{i}" for i in range(60)]
    text = {x: " ".join(words(x)) for x in "abcdef"}
    near = " ".join(["new", *words("a")[1:]])
    rows = [(1, text["a"], "x"), (5, near, "x"), (5, text["b"], "x"),  # 5: a near-copy of 1 and a clean text
            (None, text["c"], "x"), (None, text["d"], "x"), (None, text["e"], "x"), (None, text["e"], "x"), (None, text["e"], "y"),
            (None, near, "x"), (7, text["f"], None), (7, text["f"], None), (8, None, "x"), (8, None, "x"), (None, None, "x"), (None, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted((tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()), key=str)
    assert sum(r[1] == text["e"] for r in got) == 1
    assert [r for r in got if r[1] != text["e"]] == sorted(
        [rows[0], rows[2], rows[3], rows[4], rows[9], *rows[11:]], key=str)


def test_mixing_stage_takes_many_equal_rows(spark):
    rows = [(1, "one two three", "a", 5)] * 30_000 + [(None, None, "a", 5)] * 3 + [(i, f"word{i} and more", "b", 5) for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _a int")
    out = corpus_pipeline.mixed(spark, docs.repartition(5), "")
    assert out.columns == docs.columns
    words = Counter(r.source for r in out.collect() for _ in (r.text or "").split())
    total = 3 * (30_000 + 398)
    # source b stops at twice its size, source a takes the rest
    assert abs(words["b"] - 2 * 3 * 398) <= 1 and abs(words["a"] - (1.5 * total - 2 * 3 * 398)) <= 1
    assert corpus_pipeline.mixed(spark, docs.limit(0), "").collect() == []
