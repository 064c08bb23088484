"""Small helpers that several operators of this folder use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir


#: Bytes of an Arrow batch between Spark and Python, where the session names no bound: rows here are whole texts.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, in Spark's direct memory and in Python alike; a bound set by the user stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: later reads do not depend on the executors that made it."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, purpose: str) -> str:
    return scratch_dir(spark, purpose)


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted name of a new column, or it with the first number that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    names = [wanted, *(f"{wanted}_{i}" for i in range(1, len(taken) + 1))]
    return next(n for n in names if n.lower() not in taken)
