"""Daily incremental ingest (X1) with Structured Streaming.

New day files are picked up by the file source; ``trigger(availableNow)``
processes everything present and stops. Each micro-batch writes its
aggregates into partitions keyed by (day, batch id) with dynamic partition
overwrite: a retried batch rewrites exactly its own partitions, so the sink
is idempotent under at-least-once ``foreachBatch`` delivery. Readers sum over
batch ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import checkpoint_dir


def daily_event_counts(batch: DataFrame) -> DataFrame:
    return batch.groupBy(F.to_date("ts").alias("ds"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))


def ingest_daily(spark: SparkSession, source_dir: str, schema, glob: str, out_dir: str | None = None,
                 transform=daily_event_counts, max_files: int | None = None) -> str:
    """Run the stream to completion over the files present; return the sink path.

    The stream's checkpoint lies beside the sink (``<sink>_checkpoint``), so the
    next call with the same ``out_dir`` reads only files that came since and
    batch numbers go on: late files add to their days, nothing counts twice.
    Without ``out_dir`` the sink is a new folder under the shared one."""
    out = (out_dir or f"{checkpoint_dir(spark).rstrip('/')}/ingest/{uuid.uuid4().hex}/table").rstrip("/")
    ckpt = f"{out}_checkpoint"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        agg = transform(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (agg.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ds", "batch_id").parquet(out))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.parquet(path)
    return t.groupBy("ds", "event_type").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))


# ---------------------------------------------------------------- trailing rates, kept up to date
def ingest_trailing(spark: SparkSession, source_dir: str, schema, glob: str, key: str, windows, samples, out_dir: str | None = None,
                    max_files: int | None = None) -> str:
    """Click-through rates of the N days before each day (``trailing_ctr``), kept
    as days of impressions arrive; returns the folder of the result.

    State: clicks and impressions by (key, day), in partitions (day, batch). A
    batch writes its own counts and then only the result days it can change: its
    own days and the ``max(windows)`` days after them, from the counts of the days
    those look back to. Late days and repeated batches are therefore right.
    ``samples`` turns a batch of the source into (key, ds, y_ctr) rows."""
    from rankforge.operators.samples import trailing_from_counts
    out = (out_dir or f"{checkpoint_dir(spark).rstrip('/')}/trailing/{uuid.uuid4().hex}").rstrip("/")
    reach = max(windows)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def counts() -> DataFrame:
        return spark.read.parquet(f"{out}/counts").groupBy(key, "ds").agg(F.sum("clk").alias("_clk"), F.sum("imp").alias("_imp"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        daily = samples(batch).groupBy(key, "ds").agg(F.sum("y_ctr").alias("clk"), F.count(F.lit(1)).alias("imp"))
        daily.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("ds", "batch_id").parquet(f"{out}/counts")
        seen = spark.read.parquet(f"{out}/counts")
        touched = [r.ds for r in seen.where(F.col("batch_id") == batch_id).select("ds").distinct().collect()]  # days of a batch
        if not touched:
            return
        spans = spark.createDataFrame([(d,) for d in touched], "d date")
        days = seen.select("ds").distinct().join(F.broadcast(spans), (F.col("ds") >= F.col("d")) & (F.col("ds") <= F.date_add("d", reach)), "left_semi")
        first = min(touched)
        read = counts().where(F.col("ds") >= F.date_sub(F.lit(first), reach))
        fresh = trailing_from_counts(read, key, "ds", windows).join(F.broadcast(days), "ds", "left_semi")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(f"{out}/result")

    q = (reader.parquet(source_dir).writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{out}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{out}/result"
