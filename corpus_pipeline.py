"""From raw documents to token counts: language ID, near-duplicates, personal
data, source mixing, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns the columns of ``documents``; the last one returns token
counts and digests of the encoded documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import bpe, language_id, ngram_join, pii, source_mix
from rankforge.llm.common import cut, table


def aside(docs: DataFrame, names: list[str]) -> DataFrame:
    """Columns that a stage would replace, under other names."""
    return docs.withColumnsRenamed({c: f"_aside_{c}" for c in docs.columns if c in names})


def back(docs: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """The given columns, those put ``aside`` under their own names again."""
    return docs.select(*(F.col(f"_aside_{c}" if c in names else c).alias(c) for c in columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know. The models learn from the
    documents that are not held out; what they reject goes (text without a
    letter, or unlike every language)."""
    models = language_id.fit_language_models(docs.filter(~language_id.held_out(F.col("doc_id"))))
    new = ["lang_pred", "score", "cross_entropy", "rejected"]
    return back(language_id.classify(aside(docs, new), models).filter("not rejected"), new, docs.columns)


def content_key(docs: DataFrame) -> Column:
    """What tells rows apart: the doc_id (null ones last), then 128 bits of all columns, and which of them are null."""
    own = [*(F.col(c) for c in docs.columns), *(F.isnull(c) for c in docs.columns)]
    return F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*own).alias("a"),
                    F.xxhash64(F.lit(1), *own).alias("b"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates (3-word shingles, Jaccard
    similarity 90 %): the one with the smallest doc_id, then the first by
    content; null doc_ids come last. Rows are told apart by content, so those
    that share a doc_id, or have none, stay unless their texts are linked.
    Rows without a word are linked with nothing: all stay."""
    parts = ngram_join.ngram_components(docs.select(content_key(docs).alias("doc_id"), "text"), n=3, threshold=90)
    first = parts.filter("doc_id = component_id").groupBy(F.col("doc_id.a").alias("_a"), F.col("doc_id.b").alias("_b")) \
        .agg(F.sum(F.when(F.col("n_shingles") == 0, 1).otherwise(0)).alias("_blank"))
    key, same = content_key(docs), F.struct(*(F.col(c) for c in docs.columns))
    kept = docs.select(key["a"].alias("_a"), key["b"].alias("_b"), same.alias("_row")).join(first, ["_a", "_b"])
    return kept.groupBy("_a", "_b").agg(F.first("_row").alias("_row"), F.first("_blank").alias("_blank")) \
        .select("_row", F.explode(F.array_repeat(F.lit(0), F.greatest("_blank", F.lit(1)).cast("int")))).select("_row.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind."""
    clean = pii.redact(pii.find_pii(aside(docs, ["pii"]))).withColumn("n_chars", F.length("text").cast("long"))
    return back(clean, ["pii"], docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; the one per source that is
    taken in part ends after these words. Equal rows are taken together: they
    become one row before any shuffle, with the sum of their copies."""
    key, own = content_key(docs), F.struct(*(F.col(c) for c in docs.columns))
    plan = source_mix.mix_sources(docs.select(key.alias("doc_id"), "source", "text")).groupBy(
        F.col("doc_id.a").alias("_a"), F.col("doc_id.b").alias("_b")).agg(F.sum("copies").alias("_copies"), F.max("part_words").alias("_part"))
    rows = docs.select(key["a"].alias("_a"), key["b"].alias("_b"), own.alias("_row")).groupBy("_a", "_b").agg(F.first("_row").alias("_row"))
    taken = rows.join(plan, ["_a", "_b"]).filter("_copies > 0 or _part > 0").withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies") + (F.col("_part") > 0).cast("long"))))
    words = F.array_remove(F.split(F.col("_row.text"), source_mix.SPACE), "")
    part = F.array_join(F.slice(words, F.lit(1), F.col("_part").cast("int")), " ")
    text = F.when(F.col("_i") <= F.col("_copies"), F.col("_row.text")).otherwise(part)
    return taken.select("_row.*", text.alias("_text")).withColumn("text", F.col("_text")) \
        .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every copy."""
    return bpe.bpe_encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("ngram_join", one_of_each_group),
    ("personal_data", without_personal_data),
    ("source_mix", mixed),
    ("byte_bpe", encoded),
]
#: The models of the first stage and the tokenizer are beyond SQL; the tests
#: compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
