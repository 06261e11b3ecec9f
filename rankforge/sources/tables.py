"""Access to the provided parquet tables (one file per table under an sf dir)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# The provided table names.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None, spread: bool = True) -> DataFrame:
    """Parquet scan; selecting ``columns`` here makes the pruning explicit
    (Catalyst would prune anyway once the plan projects).

    ``spread``: a scan with fewer splits than the cluster's parallelism
    (e.g. one small file holding a single row group) is round-robin
    repartitioned so per-row work uses every core. Large inputs already have
    at least as many splits as cores and are read as they are."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if columns:
        df = df.select(*columns)
    if spread:
        df = spread_small(df)
    return df


def spread_small(df: DataFrame) -> DataFrame:
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
