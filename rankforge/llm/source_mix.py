"""Mixing sources to target weights by pivotal dependent rounding.

Targets: the sources in code point order (null last) take turns in ``weights``
and share ``share`` times all words; a source that would exceed ``most`` times
its own words stops there and the excess is shared again until none is above.

Copies: all documents of a source start with the same fractional number of
copies, target / size. Whole parts are kept. Two fractional parts at a time
exchange words, at random and without changing either's expectation, until one
of the two is whole; the sum of words stays what it was. Documents are dealt
into buckets of about ``bucket_rows``; each bucket ends with one fractional
document at most, and these meet in the next level of a reduction tree with a
fan-in of ``fan_in``, until one is left per source. That one is taken in part:
``part_words`` of its words.

Random numbers depend on ``seed``, source, level, bucket and documents only, so
reruns and repeated tasks agree.

Edge cases: null text has size 0; documents of size 0 take nothing; null is a
source of its own; a source without words has target 0; repeated rows are
separate documents; an empty table gives an empty mix. Only ``doc_id``, ``text``
and ``source`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import cut
from rankforge.llm.quality import SPACE


def ranked(rows: DataFrame, col: str) -> DataFrame:
    """``rows`` plus ``place``: 0, 1, ... by ``col``, nulls last. Sorted in
    ranges; only one count per partition reaches the driver."""
    order = F.col(col).asc_nulls_last()
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(rows.repartitionByRange(n, order).withColumn("_part", F.spark_partition_id()))
    offsets, at = {}, 0
    for p, c in sorted((r["_part"], r["n"]) for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets[p], at = at, at + c
    if not offsets:
        return parts.withColumn("place", F.lit(0).cast("long")).drop("_part")
    base = F.create_map(*(F.lit(x).cast(t) for k, v in offsets.items() for x, t in ((k, "int"), (v, "long"))))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return parts.withColumn("place", base[F.col("_part")] + own).drop("_part")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``sized(source, size)`` -> ``(source, n_docs, source_size, target)``."""
    sums = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    w = F.array(*(F.lit(float(x)) for x in weights))[(F.col("place") % len(weights)).cast("int")]
    rows = cut(ranked(sums, "source").withColumn("w", w).withColumn("cap", F.col("source_size") * most))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("w") * level > F.col("cap")
        x = rows.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("cap"),
                     F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("w"),
                     F.count(F.when(full, 1)).alias("n")).first()
        if x["n"] == capped or not x["w"]:
            break
        capped = x["n"]
        level = (total - x["cap"]) / x["w"]
    return rows.select("source", "n_docs", "source_size",
                       F.least(F.col("w") * F.lit(level or 0.0), F.col("cap")).alias("target"))


def pivot(size: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Parts (0 to 1) after pairwise exchanges: all whole but one at most; the
    sum of size * part is kept."""
    part, held = part.copy(), -1
    random = rng.random(len(part))
    for i in range(len(part)):
        if size[i] == 0 or part[i] <= 0 or part[i] >= 1:
            continue
        if held < 0:
            held = i
            continue
        a, b, p, q = float(size[held]), float(size[i]), part[held], part[i]
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
        if random[i] * (up + down) < down:
            p, q = (1.0, q - up / b) if up == a * (1 - p) else (p + up / a, 0.0)
        else:
            p, q = (0.0, q + down / b) if down == a * p else (p - down / a, 1.0)
        # what is whole but for rounding is whole
        p, q = (float(round(x)) if abs(x - round(x)) < 1e-12 else x for x in (p, q))
        part[held], part[i] = p, q
        held = held if 0 < p < 1 else i if 0 < q < 1 else -1
    return part


def row_key() -> Column:
    """Key of a row of documents by content; equal rows share it."""
    return F.xxhash64("doc_id", "source", "text")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                seed: int = 17, bucket_rows: int = 4096, fan_in: int = 256) -> DataFrame:
    """``(doc_id, source, row_key, size, source_size, target, copies,
    part_words, taken)`` of every row of ``docs(doc_id, text, source)``."""
    size = F.size(F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), SPACE), "")).cast("long")
    sized = docs.select("doc_id", "source", row_key().alias("row_key"), size.alias("size"))
    # equal rows have running numbers, so that they are dealt to all buckets
    sized = cut(sized.groupBy(*sized.columns).agg(F.count("*").cast("int").alias("n"))
                .withColumn("running", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n"))
    targets = source_targets(sized, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = F.ceil(F.col("n_docs") / F.lit(bucket_rows))
    rows = (sized.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("copies", F.floor(rate).cast("long"))
            .withColumn("part", rate - F.floor(rate))
            .withColumn("bucket", F.pmod(F.xxhash64("row_key", F.lit(seed) + F.col("running")), buckets))
            .drop("n_docs", "running"))
    schema = rows.schema

    def settle(level: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "row_key"], kind="stable")
            name = f"{seed}:{level}:{pdf['source'].iloc[0]!r}:{pdf['bucket'].iloc[0]}"
            rng = np.random.default_rng(int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big"))
            return pdf.assign(part=pivot(pdf["size"].to_numpy(), pdf["part"].to_numpy(), rng))
        return run

    done, level, n = [], 0, int(targets.agg(F.max(F.ceil(F.col("n_docs") / F.lit(bucket_rows)))).first()[0] or 0)
    open_ = F.col("part").between(0, 1) & (F.col("part") > 0) & (F.col("part") < 1) & (F.col("size") > 0)
    while True:
        rows = cut(rows.groupBy("source", "bucket").applyInPandas(settle(level), schema))
        if n <= 1:
            done.append(rows)
            break
        done.append(rows.filter(~open_))
        rows = rows.filter(open_).withColumn("bucket", F.floor(F.col("bucket") / fan_in))
        level, n = level + 1, -(-n // fan_in)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    whole = F.col("copies") + F.when(F.col("part") >= 1, 1).otherwise(0)
    words = F.when(open_, F.round(F.col("size") * F.col("part"))).otherwise(0).cast("long")
    return out.select("doc_id", "source", "row_key", "size", "source_size", "target", whole.alias("copies"),
                      words.alias("part_words")).withColumn("taken", F.col("size") * F.col("copies") + F.col("part_words"))
