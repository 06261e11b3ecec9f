"""Merkle fixity audit of WARC files and their replicas.

Every record is hashed. Records are grouped by ranges of their file offset, and
ranges again by wider ranges: a tree per file whose nodes keep a digest of
their offsets and parts. Replicas compare roots; only below roots that differ
the next level is read, and so on down to the records of the few ranges that
really differ. Nodes are aligned by offset, so a lost record damages its own
range only.

A leaf range holds at most ``RANGE`` bytes of records, an inner node at most
``FAN_OUT`` children, a root one child per 256 MB of its file. Bodies are hashed
where they are read; only offsets and digests are shuffled.

Edge cases: null record bodies are hashed as empty, bodies of any length whole; a file or record that only
one side has is missing or extra; records with equal file and offset are
hashed in the order of their hashes and reported once; empty tables give an
empty audit; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import cut

RANGE, FAN_OUT, LEVELS = 1 << 16, 16, 4


def warc_records(pages: DataFrame, records_per_file: int = 500) -> DataFrame:
    """``pages(page_id, url, html)`` as WARC response records ``(file, offset,
    length, page_id, body)``, ``records_per_file`` page numbers to a file.
    Rows without a page_id are spread over further files by a hash. The bodies
    go through the window that makes the offsets: for an audit of many or long
    records take ``warc_index``."""
    return _with_offsets(_bodies(pages, records_per_file)).select("file", "offset", "length", "page_id", "body")


def warc_index(pages: DataFrame, records_per_file: int = 500, **versions: Column) -> DataFrame:
    """The records of ``warc_records`` as an index ``(file, offset, length,
    page_id, digest)``. Each of ``versions``, a body as a column over
    ``page_id`` and ``body``, adds its digest under its name."""
    rows = _bodies(pages, records_per_file).select(
        "file", "page_id", "length", "digest", *(_digest(v).alias(name) for name, v in versions.items()))
    return _with_offsets(rows).select("file", "offset", "length", "page_id", "digest", *versions)


def _digest(body: Column) -> Column:
    return F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256)


def _bodies(pages: DataFrame, records_per_file: int) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    body = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(html), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    file = F.coalesce(F.floor(F.col("page_id") / records_per_file),
                      -1 - F.pmod(F.xxhash64("url", "html"), F.lit(1 << 20)))
    rows = pages.select("page_id", file.alias("file"), body.alias("body"))
    return rows.withColumn("length", F.octet_length("body").cast("long")).withColumn("digest", _digest(F.col("body")))


def _with_offsets(rows: DataFrame) -> DataFrame:
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def hashed(records: DataFrame) -> DataFrame:
    """``records(file, offset, body)``, or with a ``digest`` instead of the
    body -> ``(file, offset, node, digest)``."""
    digest = _digest(F.col("body")) if "body" in records.columns else F.col("digest")
    return records.select("file", "offset", F.floor(F.col("offset") / RANGE).alias("node"), digest.alias("digest"))


def merkle_levels(records: DataFrame) -> list[DataFrame]:
    """Trees of ``hashed`` records as levels ``(file, node, digest, n)``, leaf
    ranges first, roots (node 0) last."""

    def up(rows: DataFrame, at: str, node, n) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), "digest")))
        text = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["at"], x["digest"])), ",")
        return rows.groupBy("file", node.alias("node")).agg(F.sha2(text.cast("binary"), 256).alias("digest"),
                                                            n.alias("n"))

    levels = [up(records.withColumnRenamed("node", "range"), "offset", F.col("range"), F.count("*"))]
    for i in range(LEVELS):
        wider = F.lit(0).cast("long") if i == LEVELS - 1 else F.floor(F.col("child") / FAN_OUT)
        levels.append(up(levels[-1].withColumnRenamed("node", "child"), "child", wider, F.sum("n")))
    return levels


def differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks, with both digests."""
    return a.select(*keys, F.col("digest").alias("digest_a")).join(
        b.select(*keys, F.col("digest").alias("digest_b")), keys, "full") \
        .filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(original: DataFrame, replica: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of two sets of records: per file ``(file, n_records, root,
    replica_root, intact)``, and the damage ``(file, offset, status)`` with
    status corrupt, missing (in the replica) or extra."""
    rows_a, rows_b = cut(hashed(original)), cut(hashed(replica))
    a, b = merkle_levels(rows_a), merkle_levels(rows_b)
    a, b = a[:1] + [cut(x) for x in a[1:]], b[:1] + [cut(x) for x in b[1:]]
    roots = a[-1].select("file", "n", F.col("digest").alias("root")).join(
        b[-1].select("file", F.col("digest").alias("replica_root")), "file", "full")
    files = roots.select("file", F.coalesce("n", F.lit(0)).alias("n_records"), "root", "replica_root",
                         F.col("root").eqNullSafe(F.col("replica_root")).alias("intact"))
    open_ = cut(differing(a[-1], b[-1], ["file", "node"]).select("file", F.col("node").alias("parent")))
    for i in range(LEVELS - 1, -1, -1):
        parent = F.lit(0).cast("long") if i == LEVELS - 1 else F.floor(F.col("node") / FAN_OUT)
        below = [x.withColumn("parent", parent).join(open_, ["file", "parent"], "left_semi") for x in (a[i], b[i])]
        open_ = cut(differing(*below, ["file", "node"]).select("file", F.col("node").alias("parent")))
    last = [x.withColumnRenamed("node", "parent").join(open_, ["file", "parent"], "left_semi") for x in (rows_a, rows_b)]
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("corrupt")
    last = [x.groupBy("file", "offset").agg(F.array_join(F.array_sort(F.collect_list("digest")), ",").alias("digest"))
            for x in last]
    return files, differing(*last, ["file", "offset"]).select("file", "offset", status.alias("status"))


def report(original: DataFrame, replica: DataFrame) -> DataFrame:
    """``audit`` as one row per file: its damage as ``n_bad`` and ``bad``
    (``offset:status``, by offset, joined by commas)."""
    files, damage = audit(original, replica)
    bad = damage.groupBy("file").agg(F.count("*").alias("n_bad"), F.array_sort(
        F.collect_list(F.struct("offset", "status"))).alias("bad"))
    return files.join(bad, "file", "left").select(
        "file", "n_records", "root", "replica_root", "intact", F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
        F.array_join(F.transform(F.coalesce("bad", F.array().cast("array<struct<offset:bigint,status:string>>")),
                                 lambda x: F.concat_ws(":", x["offset"], x["status"])), ",").alias("bad"))
