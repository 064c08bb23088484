"""Logs of model runs kept as text files: what a file means is in its path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import latest

# Path forms; the first group is the run, the second the metric or parameter.
METRIC_PATH = r"([^/]+)/metrics/([^/]+)$"
PARAM_PATH = r"([^/]+)/params/([^/]+)$"
PARTITIONED_METRIC_PATH = r"run_id=([^/]+)/metric=([^/]+)/[^/]+$"
PARTITIONED_PARAM_PATH = r"run_id=([^/]+)/param=([^/]+)/[^/]+$"

FILES = 8


def _lines(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("wholetext", whole)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("path"))


def scan_metrics(spark: SparkSession, path: str, pattern: str = METRIC_PATH) -> DataFrame:
    """(run_id, metric, ts_ms, value, step) from lines ``epoch_ms value step``."""
    lines = _lines(spark, path, False).where(F.col("path").rlike(pattern))
    cells = F.split(F.trim("value"), r"\s+")
    return lines.select(
        F.url_decode(F.regexp_extract("path", pattern, 1)).alias("run_id"),
        F.url_decode(F.regexp_extract("path", pattern, 2)).alias("metric"),
        F.get(cells, F.lit(0)).try_cast("bigint").alias("ts_ms"),
        F.get(cells, F.lit(1)).try_cast("double").alias("value"),
        F.get(cells, F.lit(2)).try_cast("bigint").alias("step"),
    )


def scan_params(spark: SparkSession, path: str, pattern: str = PARAM_PATH) -> DataFrame:
    """(run_id, param, value); each file holds one value."""
    lines = _lines(spark, path, True).where(F.col("path").rlike(pattern))
    return lines.select(
        F.url_decode(F.regexp_extract("path", pattern, 1)).alias("run_id"),
        F.url_decode(F.regexp_extract("path", pattern, 2)).alias("param"),
        F.trim(F.regexp_replace("value", r"[\r\n]+$", "")).alias("value"),
    )


def latest_metrics(log: DataFrame) -> DataFrame:
    """Last value of every (run, metric) by step, then time."""
    return latest(log, ["run_id", "metric"], ["step", "ts_ms"])


def write_metric_log(df: DataFrame, path: str) -> None:
    """Write (run_id, metric, ts_ms, value, step) rows as log lines, one folder per run and metric."""
    line = F.concat_ws(" ", F.col("ts_ms").cast("string"), F.col("value").cast("string"), F.col("step").cast("string"))
    rows = df.select("run_id", "metric", line.alias("value"))
    # At most FILES files for a run and metric, and no task with all rows of a frequent one.
    dealt = rows.repartition("run_id", "metric", F.pmod(F.xxhash64("value"), F.lit(FILES)))
    dealt.write.mode("append").partitionBy("run_id", "metric").text(path)


def write_param_log(df: DataFrame, path: str) -> None:
    """Write (run_id, param, value) rows, one file per parameter."""
    df.select("run_id", "param", "value").repartition("run_id", "param").write.mode("append").partitionBy("run_id", "param").text(path)
