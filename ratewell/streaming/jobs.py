"""Streams of scoring requests and of the scoring log.

Sinks write each micro-batch to its own folder, so a batch that is run again
after a failure replaces its output and nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..models.scoring import Scorer
from ..operators.ranking import latest
from ..operators.summary import latency_aggregates, latency_long


def parquet_stream(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """New Parquet files of one name below a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def json_stream(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """New files of JSON lines below a folder."""
    return spark.readStream.schema(schema).json(folder)


def run_to_folder(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Work off what has arrived and stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if shape is None else shape(batch)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def score_stream(requests: DataFrame, scorer: Scorer, path: str, checkpoint: str) -> None:
    """Score requests as they arrive: one folder of scored rows and one of rejects per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            scored, bad = scorer.score(rows)
            scored.write.mode("overwrite").parquet(f"{path}/scored/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{path}/rejected/batch_id={batch_id}")
        finally:
            rows.unpersist()

    query = requests.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def usage_per_window(log: DataFrame, version: str, ts: str = "ts", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Predictions per version and tumbling window; rows later than ``late`` are dropped."""
    counts = log.withWatermark(ts, late).groupBy(F.window(ts, window), F.col(version).alias("version")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "version", "n")


def latency_per_window(log: DataFrame, version: str, latency: Column, ts: str = "ts", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Cumulative latency buckets per version and window."""
    wide = log.withWatermark(ts, late).groupBy(F.window(ts, window), F.col(version).alias("version")).agg(*latency_aggregates(latency))
    flat = wide.withColumn("window_start", F.col("window.start")).drop("window")
    return latency_long(flat, ["window_start", "version"])


def usage_total(log: DataFrame, version: str) -> DataFrame:
    """Predictions per version since the stream began; a restart goes on from its checkpoint."""
    return log.groupBy(F.col(version).alias("version")).agg(F.count(F.lit(1)).alias("n"))


def latency_total(log: DataFrame, version: str, latency: Column) -> DataFrame:
    """Cumulative latency buckets per version since the stream began."""
    return latency_long(log.groupBy(F.col(version).alias("version")).agg(*latency_aggregates(latency)), ["version"])


def with_known(totals: DataFrame, known: DataFrame, key: str = "version") -> DataFrame:
    """Counters of all known keys: those that never came stand at 0."""
    numbers = [f.name for f in totals.schema if f.name != key]
    every = known.select(key).union(totals.select(key)).distinct()
    return every.join(totals, key, "left").na.fill(0, numbers)


def without_repeats(log: DataFrame, keys: Sequence[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """First arrival of each request id; ids are remembered as long as repeats may come."""
    return log.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current row of each key from a folder of update batches."""
    return latest(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")
