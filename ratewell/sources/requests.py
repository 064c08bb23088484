"""Scoring requests and responses as nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.relational import salted_lookup

# Fields of one request entry.
ENTRY_SCHEMA = """MINE_ID string, MINE_NAME string, CURRENT_STATUS string, STATE string, CAL_YR int, YEAR int,
  AVG_EMPLOYEE_CNT double, HOURS_WORKED double, CURRENT_MINE_TYPE string, CURRENT_MINE_STATUS string,
  CURRENT_CONTROLLER_ID string, CURRENT_OPERATOR_ID string, FIPS_CNTY_CD string, PRIMARY string, SECONDARY string,
  CURRENT_MINE_SUBUNIT string, SUBUNIT_CD string, LONGITUDE double, LATITUDE double, COAL_PRODUCTION double,
  AVG_EMPLOYEE_CNT_UNDERGROUND double, UNDERGROUND_HOURS double, AVG_EMPLOYEE_CNT_SURFACE double,
  SURFACE_HOURS double, INJURIES_COUNT int"""
BATCH_SCHEMA = f"mines array<struct<{ENTRY_SCHEMA.replace(' string', ': string').replace(' double', ': double').replace(' int', ': int')}>>"


def parse_batches(df: DataFrame, body: str, batch_id: str, schema: str = BATCH_SCHEMA, entries: str = "mines") -> DataFrame:
    """One row per entry of each JSON batch, with its place in the batch.

    An unreadable or empty batch keeps one row with null fields, so it can be
    rejected by the row checks and is not lost.
    """
    parsed = df.select(F.col(batch_id), F.from_json(F.col(body), schema).alias("_b"))
    rows = parsed.select(batch_id, F.posexplode_outer(F.col(f"_b.{entries}")).alias("entry_no", "_e"))
    return rows.select(batch_id, "entry_no", "_e.*")


def response_rows(df: DataFrame, batch_id: str, entity: str, prediction: str, version: Column) -> DataFrame:
    """One row per answered entry, with the mean of its batch: the form for batches of any size."""
    sums = df.groupBy(batch_id).agg(F.avg(prediction).alias("average_predicted_rate"))
    rows = salted_lookup(df, sums, batch_id, F.col(entity))
    return rows.select(
        batch_id, F.col(entity).cast("string").alias("mine_id"), F.col(prediction).alias("predicted_injury_rate"), "average_predicted_rate", version.alias("model_version")
    )


def batch_responses(df: DataFrame, batch_id: str, entity: str, prediction: str, version: Column, page_rows: int) -> DataFrame:
    """JSON answers per batch with the batch's mean, in pages of about ``page_rows`` entries.

    So no array grows with the data; every page carries the mean of the whole batch.
    """
    sums = df.groupBy(batch_id).agg(F.count(F.lit(1)).alias("_n"), F.avg(prediction).alias("average_predicted_rate"))
    sums = sums.withColumn("_pages", F.ceil(F.col("_n") / F.lit(page_rows)).cast("bigint"))
    page = F.pmod(F.xxhash64(F.col(entity)), F.col("_pages"))
    paged = salted_lookup(df, sums, batch_id, F.col(entity)).select(batch_id, entity, prediction, "average_predicted_rate", page.alias("page"))
    item = F.struct(F.col(entity).cast("string").alias("mine_id"), F.col(prediction).alias("predicted_injury_rate"))
    return (
        paged.groupBy(batch_id, "page")
        .agg(
            F.to_json(F.array_sort(F.collect_list(item))).alias("predictions"),
            F.max("average_predicted_rate").alias("average_predicted_rate"),
        )
        .withColumn("model_version", version)
    )
