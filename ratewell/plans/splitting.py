"""Queries for splits and weights (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as lb
from ..functions.hashing import hash_unit
from ..operators import relational as rel, splits as sp
from .base import Registry, clean, mine_year, r6, scored, with_clean, with_scored
from .features import RATE_BIN_SQL
from .summaries import UNIT_SQL

HASH_SQL = "md5(concat(CAST(MINE_ID AS VARCHAR), '|{seed}'))"


def stratified(s, d):
    rows = clean(s, d).select("MINE_ID", "INJ_RATE_PER2K", "NUM_INJURIES")
    return sp.stratified_split(rows, "MINE_ID", lb.right_closed_bin("INJ_RATE_PER2K"), 0.75, 1234)


STRATIFIED_SQL = f"""SELECT MINE_ID, INJ_RATE_PER2K, NUM_INJURIES,
  CASE WHEN row_number() OVER (PARTITION BY bin ORDER BY h) <= floor(count(*) OVER (PARTITION BY bin) * 0.75) THEN 'train' ELSE 'test' END AS dataset
  FROM (SELECT *, {RATE_BIN_SQL.format(c='INJ_RATE_PER2K')} AS bin, {HASH_SQL.format(seed=1234)} AS h FROM clean)"""


def register(reg: Registry) -> None:
    reg.add(
        "e1_stratified_split",
        lambda s, d: stratified(s, d).select("MINE_ID", "dataset"),
        with_clean("SELECT MINE_ID, dataset FROM parts", parts=STRATIFIED_SQL),
    )
    reg.add(
        "e2_random_split",
        lambda s, d: sp.random_split(clean(s, d).select("MINE_ID"), "MINE_ID", 0.75, 42),
        with_clean(f"SELECT MINE_ID, CASE WHEN {UNIT_SQL.format(key='MINE_ID', seed=42)} < 0.75 THEN 'train' ELSE 'test' END AS dataset FROM clean"),
    )
    reg.add(
        "e3_quantile_stratified_split",
        lambda s, d: sp.quantile_stratified_split(clean(s, d).select("MINE_ID", "INJ_RATE_PER2K"), "MINE_ID", "INJ_RATE_PER2K", 0.75, 5, 9).select(
            "MINE_ID", "dataset"
        ),
        with_clean(
            f"""SELECT MINE_ID, CASE WHEN row_number() OVER (PARTITION BY g ORDER BY {HASH_SQL.format(seed=9)})
              <= ceil(count(*) OVER (PARTITION BY g) * 0.75) THEN 'train' ELSE 'test' END AS dataset
            FROM (SELECT MINE_ID, greatest(1, CAST(x > q0 AS INTEGER) + CAST(x > q1 AS INTEGER) + CAST(x > q2 AS INTEGER) + CAST(x > q3 AS INTEGER)) AS g
              FROM (SELECT MINE_ID, INJ_RATE_PER2K AS x FROM clean) CROSS JOIN
              (SELECT min(INJ_RATE_PER2K) AS q0, quantile_cont(INJ_RATE_PER2K, 0.25) AS q1, quantile_cont(INJ_RATE_PER2K, 0.5) AS q2,
               quantile_cont(INJ_RATE_PER2K, 0.75) AS q3 FROM clean))"""
        ),
    )

    def reuse(s, d):
        rows = clean(s, d)
        keys = rows.where(hash_unit("MINE_ID", 42) < 0.75).select("MINE_ID")
        other = rows.select("MINE_ID", F.concat_ws(" ", "TYPE_OF_MINE", "COMMODITY").alias("MINE_CHAR"))
        train, test = sp.apply_partition(other, keys, "MINE_ID")
        return rel.union_tagged({"train": train, "test": test})

    reg.add(
        "e4_reuse_partition",
        reuse,
        with_clean(
            f"""SELECT MINE_ID, concat_ws(' ', TYPE_OF_MINE, COMMODITY) AS MINE_CHAR,
            CASE WHEN {UNIT_SQL.format(key='MINE_ID', seed=42)} < 0.75 THEN 'train' ELSE 'test' END AS dataset FROM clean"""
        ),
    )
    reg.add(
        "e5_split_report",
        lambda s, d: sp.split_report(stratified(s, d), "INJ_RATE_PER2K").select("dataset", "n", r6("pct"), r6("mean")),
        with_clean(
            """SELECT coalesce(dataset, 'total') AS dataset, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM parts), 6) AS pct,
            round(avg(INJ_RATE_PER2K), 6) AS mean FROM parts GROUP BY GROUPING SETS ((dataset), ())""",
            parts=STRATIFIED_SQL,
        ),
    )
    reg.add(
        "e6_positive_rows",
        lambda s, d: sp.positives(scored(s, d), "actual").select("MINE_ID", "dataset", "actual"),
        with_scored("SELECT MINE_ID, dataset, actual FROM scored WHERE actual > 0"),
    )
    reg.add(
        "e7_class_weight",
        lambda s, d: clean(s, d).select("MINE_ID", lb.positive_weight(lb.any_event("NUM_INJURIES"), 20.0).alias("w")),
        with_clean("SELECT MINE_ID, CASE WHEN NUM_INJURIES > 0 THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM clean"),
    )
    reg.add(
        "e8_step_weights",
        lambda s, d: clean(s, d).select("MINE_ID", lb.step_weight("NUM_INJURIES").alias("w")),
        with_clean(
            "SELECT MINE_ID, CASE WHEN NUM_INJURIES > 2 THEN 10.0::DOUBLE WHEN NUM_INJURIES > 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM clean"
        ),
    )
    reg.add(
        "e10_zero_share",
        lambda s, d: sp.zero_share(scored(s, d), "actual").withColumn("zero_share", r6("zero_share")),
        with_scored(
            """SELECT dataset, count(*) FILTER (actual = 0) AS zeros, count(*) FILTER (actual > 0) AS nonzeros,
            round(count(*) FILTER (actual = 0) / CAST(count(*) AS DOUBLE), 6) AS zero_share FROM scored GROUP BY 1"""
        ),
    )
