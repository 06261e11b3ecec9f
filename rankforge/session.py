"""Session helpers: defaults the library relies on, checkpoint location, and
size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default ceiling for a broadcast side whose size we can bound from the spec.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(master: str = "local[8]", app: str = "rankforge", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench. On a cluster, the submitter's
    configuration wins: ``getOrCreate`` keeps whatever is already set."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Pin the settings results depend on (UTC dates) and let AQE coalesce
    the partitions of cached intermediate tables (fitting persists a
    (feature, value) table that is re-read by several small jobs). Idempotent."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    if spark.conf.get(key, "false") != "true":
        spark.conf.set(key, "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts. Reads the cluster's
    ``spark.checkpoint.dir`` / SparkContext setting; a local session (one
    machine) that sets none gets a fresh folder, a cluster an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="rankforge-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, packed: bool = False) -> DataFrame:
    """The rows written once into the shared folder, compressed by column, for jobs that read them several times.
    ``packed`` rows are blocks of many samples: not compressed again, a few of them in memory at once."""
    path = f"{checkpoint_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    options = {"compression": "none", "parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false"} if packed else {"parquet.block.size": 32 << 20}
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discarded(df: DataFrame) -> None:
    """Deletes the rows that ``written`` gave, which nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, size: str = "16m") -> Iterator[None]:
    """Within it Arrow batches are small, for rows that are packed blocks of many samples."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bounded_broadcast(df: DataFrame, max_rows: int, row_bytes: int,
                      limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its proven row bound times the row width fits
    under ``limit``; otherwise leave the join strategy to the planner (AQE
    still converts to broadcast at runtime if the real size turns out small)."""
    if max_rows * row_bytes <= limit:
        return F.broadcast(df)
    return df
