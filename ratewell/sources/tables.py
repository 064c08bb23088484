"""Files and snapshots of exposure tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..roles import MINE, Roles


def exposure_schema(roles: Roles = MINE) -> StructType:
    """Declared schema of a raw exposure table."""
    text = [roles.state, roles.commodity, roles.labels, roles.status, roles.kind]
    fields = [StructField(roles.key, LongType()), StructField(roles.period, LongType())]
    fields += [StructField(c, StringType()) for c in text]
    fields += [StructField(c, DoubleType()) for c in (roles.height, roles.size, roles.exposure)]
    fields += [StructField(roles.count, LongType())]
    fields += [StructField(c, DoubleType()) for c in roles.shares]
    return StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, null_text: str = "NA") -> DataFrame:
    """CSV with a header.  A schema saves a pass; without one types are inferred.

    Columns are matched to the header by name when a schema is given.
    """
    reader = spark.read.option("header", True).option("nullValue", null_text).option("enforceSchema", False)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, null_text: str = "NA") -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", null_text).csv(path)


def write_snapshot(df: DataFrame, path: str, part: str | None = None) -> None:
    """Parquet snapshot; with ``part`` one folder per value, so readers can prune."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(part) if part else writer).parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Reload a snapshot; a missing one says what to do."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no snapshot at {path}: run the cleaning step and write it first") from e


def read_or_build(spark: SparkSession, path: str, build, part: str | None = None) -> DataFrame:
    """The stored snapshot, or the built table, stored on the way."""
    try:
        return read_snapshot(spark, path)
    except FileNotFoundError:
        write_snapshot(build(), path, part)
        return read_snapshot(spark, path)
