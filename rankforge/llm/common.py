"""Shared helpers: checkpointing, connected components, 64-bit mixing."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word of the contracts: a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3): spreads structured values over the range."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h = h ^ (h >> _S33)
    h = h * _M2
    return h ^ (h >> _S33)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder. Only a session that
    names no folder (tests) gets one of its own, and only in local mode."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="rankforge-llm-"))
    return df.checkpoint(eager=True)


#: Shares that the rows of one join key are dealt to.
SHARES = 8


def share(col: str) -> Column:
    """Share of a row: the other side of the join has each row in ``every_share``."""
    return F.pmod(F.xxhash64(col), F.lit(SHARES)).cast("int")


def every_share() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller node or none, and no chain is left."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("top")),
                                          F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("top"))))
                        .alias("x")).select("x.*")
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("top").alias("top")) \
        .filter("up > 1 or (up = 1 and top = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of any orderable type -> ``(node, component)``; the
    component is the smallest node reachable. Nodes without an edge to another
    node are left out; null ends are ignored.

    Alternating large-star and small-star steps: each is one min-aggregate
    (map-side combined, so a hub is no hot group) and one equi-join, which AQE
    may split. Stops when every edge leads to a node that leads nowhere."""
    e = cut(edges.select("u", "v").filter("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter("u <> v").distinct())
        e = cut(small)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
