"""Queries for the cleaning operators (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as cl
from ..roles import MINE
from .base import CLOSED_SQL, GROUP_SQL, Registry, clean, mine_year, r6, table, with_clean, with_mine


def register(reg: Registry) -> None:
    reg.add(
        "b1_drop_nulls",
        lambda s, d: cl.drop_nulls(mine_year(s, d), ["MINE_STATUS", "US_STATE", "PRIMARY_LABELS"]).select(
            "MINE_ID", "US_STATE", "PRIMARY_LABELS", "MINE_STATUS"
        ),
        with_mine(
            "SELECT MINE_ID, US_STATE, PRIMARY_LABELS, MINE_STATUS FROM mine_year WHERE MINE_STATUS IS NOT NULL "
            "AND US_STATE IS NOT NULL AND PRIMARY_LABELS IS NOT NULL"
        ),
    )
    reg.add(
        "b2_cleaning_audit",
        lambda s, d: cl.cleaning_audit(mine_year(s, d)).withColumn("removed_pct", r6("removed_pct")),
        with_mine(
            f"""SELECT count(*) AS rows_in, count(*) FILTER (NOT present) AS removed_null,
              count(*) FILTER (present AND NOT isopen) AS removed_status,
              count(*) FILTER (present AND isopen AND NOT enough) AS removed_exposure,
              count(*) FILTER (present AND isopen AND enough) AS rows_out,
              round(100.0::DOUBLE * (count(*) - count(*) FILTER (present AND isopen AND enough)) / count(*), 6) AS removed_pct,
              count(*) FILTER (NOT present) = 27 AS null_rows_as_expected
            FROM (SELECT MINE_STATUS IS NOT NULL AND US_STATE IS NOT NULL AND PRIMARY_LABELS IS NOT NULL AS present,
                upper(MINE_STATUS) NOT IN {CLOSED_SQL} AS isopen, EMP_HRS_TOTAL >= 2000 AS enough FROM mine_year)"""
        ),
    )

    def aliases(s, d):
        raw = mine_year(s, d).select(
            "MINE_ID",
            F.col("MINE_STATUS").alias("CURRENT_STATUS"),
            F.col("NUM_INJURIES").alias("INJURIES_COUNT"),
            F.col("EMP_HRS_TOTAL").alias("HOURS_WORKED"),
        )
        return cl.apply_aliases(raw)

    reg.add(
        "b3_aliases",
        aliases,
        with_mine(
            """SELECT MINE_ID, MINE_STATUS AS CURRENT_STATUS, NUM_INJURIES AS INJURIES_COUNT, EMP_HRS_TOTAL AS HOURS_WORKED,
            MINE_STATUS, NUM_INJURIES, EMP_HRS_TOTAL FROM mine_year"""
        ),
    )
    reg.add(
        "b4_default_columns",
        lambda s, d: cl.add_defaults(
            mine_year(s, d).select("MINE_ID", "EMP_HRS_TOTAL"),
            {"NUM_INJURIES": F.lit(0).cast("bigint"), "MINE_STATUS": "ACTIVE", "EMP_HRS_TOTAL": 1.0},
        ),
        with_mine(
            "SELECT MINE_ID, EMP_HRS_TOTAL, CAST(0 AS BIGINT) AS NUM_INJURIES, 'ACTIVE' AS MINE_STATUS FROM mine_year"
        ),
    )
    reg.add(
        "b5_exposure_rate",
        lambda s, d: cl.add_rate(mine_year(s, d)).select("MINE_ID", "NUM_INJURIES", "EMP_HRS_TOTAL", r6(MINE.rate)),
        with_mine(
            """SELECT MINE_ID, NUM_INJURIES, EMP_HRS_TOTAL,
            round(CAST(NUM_INJURIES AS DOUBLE) / nullif(EMP_HRS_TOTAL / 2000, 0), 6) AS INJ_RATE_PER2K FROM mine_year"""
        ),
    )
    reg.add(
        "b6_upper_case",
        lambda s, d: cl.upper_case(mine_year(s, d).select("MINE_ID", "MINE_STATUS"), "MINE_STATUS"),
        with_mine("SELECT MINE_ID, upper(MINE_STATUS) AS MINE_STATUS FROM mine_year"),
    )
    reg.add(
        "b7_exclude_statuses",
        lambda s, d: cl.exclude_statuses(mine_year(s, d), "MINE_STATUS").select("MINE_ID", "MINE_STATUS"),
        with_mine(f"SELECT MINE_ID, MINE_STATUS FROM mine_year WHERE coalesce(upper(MINE_STATUS) NOT IN {CLOSED_SQL}, true)"),
    )
    reg.add(
        "b8_min_exposure",
        lambda s, d: cl.min_exposure(mine_year(s, d), "EMP_HRS_TOTAL").select("MINE_ID", "EMP_HRS_TOTAL"),
        with_mine("SELECT MINE_ID, EMP_HRS_TOTAL FROM mine_year WHERE EMP_HRS_TOTAL >= 2000"),
    )

    def recode(s, d):
        both = cl.recode_status(mine_year(s, d), "MINE_STATUS", "ADJ_STATUS")
        both = cl.recode_status(both, "MINE_STATUS", "ADJ_OR_NULL", unmapped=None)
        return both.select("MINE_ID", "MINE_STATUS", "ADJ_STATUS", "ADJ_OR_NULL")

    reg.add(
        "b9_recode_status",
        recode,
        with_mine(
            f"SELECT MINE_ID, MINE_STATUS, {GROUP_SQL} AS ADJ_STATUS, nullif({GROUP_SQL}, 'Other') AS ADJ_OR_NULL FROM mine_year"
        ),
    )
    reg.add(
        "b10_drop_columns",
        lambda s, d: cl.drop_columns(mine_year(s, d), ["PRIMARY_LABELS", "US_STATE"], lambda c: c.startswith("PCT_")),
        with_mine(
            """SELECT MINE_ID, YEAR, COMMODITY, TYPE_OF_MINE, MINE_STATUS, SEAM_HEIGHT, AVG_EMP_TOTAL, EMP_HRS_TOTAL,
            NUM_INJURIES FROM mine_year"""
        ),
    )

    def requests(s, d):
        """Scoring requests as text fields, some of them broken, from the event log."""
        e = table(s, d, "events")
        k = F.col("event_id")
        return e.select(
            k.alias("MINE_ID"),
            F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, "20x4").otherwise(F.year("ts").cast("string")).alias("YEAR"),
            F.when(k % 17 == 0, "").otherwise(F.col("user_id").cast("string")).alias("AVG_EMPLOYEE_CNT"),
            F.when(k % 19 == 0, "many").otherwise((F.col("user_id") * 100).cast("string")).alias("HOURS_WORKED"),
        )

    requests_sql = """SELECT event_id AS MINE_ID,
      CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '20x4' ELSE CAST(year(ts) AS VARCHAR) END AS YEAR,
      CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS AVG_EMPLOYEE_CNT,
      CASE WHEN event_id % 19 = 0 THEN 'many' ELSE CAST(user_id * 100 AS VARCHAR) END AS HOURS_WORKED FROM events"""
    checks = []
    for name, kind, sql_kind in (
        ("YEAR", "int", "INTEGER"),
        ("AVG_EMPLOYEE_CNT", "double", "DOUBLE"),
        ("HOURS_WORKED", "double", "DOUBLE"),
    ):
        checks.append(
            f"""CASE WHEN {name} IS NULL THEN 'missing field: {name}' WHEN trim({name}) = '' THEN 'empty field: {name}'
            WHEN TRY_CAST({name} AS {sql_kind}) IS NULL THEN 'not a {kind}: {name}' END"""
        )
    reg.add(
        "b11_request_rejects",
        lambda s, d: cl.split_valid(requests(s, d))[1].select("MINE_ID", F.concat_ws("; ", "errors").alias("reasons")),
        f"""SELECT * FROM (SELECT MINE_ID, concat_ws('; ', {', '.join(checks)}) AS reasons FROM ({requests_sql})) WHERE reasons <> ''""",
    )
    reg.add(
        "b11_request_valid",
        lambda s, d: cl.split_valid(requests(s, d))[0],
        f"""SELECT MINE_ID, CAST(YEAR AS INTEGER) AS YEAR, CAST(AVG_EMPLOYEE_CNT AS DOUBLE) AS AVG_EMPLOYEE_CNT,
        CAST(HOURS_WORKED AS DOUBLE) AS HOURS_WORKED FROM ({requests_sql}) WHERE concat_ws('; ', {', '.join(checks)}) = ''""",
    )
    reg.add(
        "b12_safe_cast",
        lambda s, d: cl.safe_cast(requests(s, d), {"YEAR": "int", "AVG_EMPLOYEE_CNT": "double", "HOURS_WORKED": "double"}),
        f"""SELECT MINE_ID, TRY_CAST(YEAR AS INTEGER) AS YEAR, TRY_CAST(AVG_EMPLOYEE_CNT AS DOUBLE) AS AVG_EMPLOYEE_CNT,
        TRY_CAST(HOURS_WORKED AS DOUBLE) AS HOURS_WORKED FROM ({requests_sql})""",
    )
    reg.add(
        "b13_align_columns",
        lambda s, d: cl.align_columns(clean(s, d), ["MINE_ID", "PCT_HRS_OFFICE", "PCT_HRS_HARBOUR", "SEAM_HEIGHT"], 0.0).withColumn(
            "PCT_HRS_OFFICE", r6("PCT_HRS_OFFICE")
        ),
        with_clean(
            """SELECT MINE_ID, round(PCT_HRS_OFFICE, 6) AS PCT_HRS_OFFICE, CAST(0 AS DOUBLE) AS PCT_HRS_HARBOUR, SEAM_HEIGHT
            FROM clean"""
        ),
    )
    reg.add(
        "b15_rows_at_extreme",
        lambda s, d: cl.rows_at_extreme(clean(s, d), "INJ_RATE_PER2K").select(
            "MINE_ID", "NUM_INJURIES", "EMP_HRS_TOTAL", r6("INJ_RATE_PER2K")
        ),
        with_clean(
            """SELECT MINE_ID, NUM_INJURIES, EMP_HRS_TOTAL, round(INJ_RATE_PER2K, 6) AS INJ_RATE_PER2K FROM clean
            WHERE INJ_RATE_PER2K = (SELECT max(INJ_RATE_PER2K) FROM clean)"""
        ),
    )
    reg.add(
        "b16_trim_below",
        lambda s, d: cl.trim_below(clean(s, d), "INJ_RATE_PER2K", 0.5).select("MINE_ID", r6("INJ_RATE_PER2K")),
        with_clean("SELECT MINE_ID, round(INJ_RATE_PER2K, 6) AS INJ_RATE_PER2K FROM clean WHERE INJ_RATE_PER2K < 0.5"),
    )
    shares_sql = ", ".join(f"round({c}, 6) AS {c}" for c in MINE.shares)
    reg.add(
        "b17_basic_cleaning",
        lambda s, d: clean(s, d).select(
            "MINE_ID", "YEAR", "US_STATE", "COMMODITY", "TYPE_OF_MINE", "PRIMARY_LABELS", "SEAM_HEIGHT", "AVG_EMP_TOTAL",
            "EMP_HRS_TOTAL", "NUM_INJURIES", "ADJ_STATUS", r6("INJ_RATE_PER2K"), *[r6(c) for c in MINE.shares],
        ),
        with_clean(
            f"""SELECT MINE_ID, YEAR, US_STATE, COMMODITY, TYPE_OF_MINE, PRIMARY_LABELS, SEAM_HEIGHT, AVG_EMP_TOTAL,
            EMP_HRS_TOTAL, NUM_INJURIES, ADJ_STATUS, round(INJ_RATE_PER2K, 6) AS INJ_RATE_PER2K, {shares_sql} FROM clean"""
        ),
    )
    reg.add(
        "b18_sample_rows",
        lambda s, d: cl.sample_rows(clean(s, d), "MINE_ID", 5, 7).select("MINE_ID", "PRIMARY_LABELS"),
        with_clean(
            """SELECT MINE_ID, PRIMARY_LABELS FROM clean ORDER BY md5(concat(CAST(MINE_ID AS VARCHAR), '|7')), MINE_ID LIMIT 5"""
        ),
    )
