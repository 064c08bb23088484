"""Queries for scalar features (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx, labels as lb
from ..operators import evaluate as ev, features as ft
from ..operators.ranking import scalar_quantiles
from .base import LABELS, Registry, clean, r6, scored, table, with_clean, with_scored

RATE_BIN_SQL = """CASE WHEN {c} > 0 AND {c} <= 0.05 THEN '(0, 0.05]' WHEN {c} > 0.05 AND {c} <= 0.1 THEN '(0.05, 0.1]'
  WHEN {c} > 0.1 AND {c} <= 0.2 THEN '(0.1, 0.2]' WHEN {c} > 0.2 AND {c} <= 0.5 THEN '(0.2, 0.5]'
  WHEN {c} > 0.5 AND {c} <= 1 THEN '(0.5, 1]' WHEN {c} > 1 THEN '(1, inf]' ELSE 'Zero' END"""

FEATURE_SQL = """SELECT *,
  ln(AVG_EMP_TOTAL + 1) * PCT_HRS_UNDERGROUND AS EMP_X_UNDERGROUND, ln(AVG_EMP_TOTAL + 1) * PCT_HRS_STRIP AS EMP_X_STRIP,
  ln(AVG_EMP_TOTAL + 1) * PCT_HRS_SURFACE AS EMP_X_SURFACE, ln(AVG_EMP_TOTAL + 1) * PCT_HRS_MILL_PREP AS EMP_X_MILL,
  ln(AVG_EMP_TOTAL + 1) * PCT_HRS_OFFICE AS EMP_X_OFFICE, concat_ws(' ', TYPE_OF_MINE, COMMODITY) AS MINE_CHAR,
  AVG_EMP_TOTAL * AVG_EMP_TOTAL AS AVG_EMP_TOTAL_SQ, ln(AVG_EMP_TOTAL + 1) AS LOG_AVG_EMP_TOTAL,
  coalesce(CASE WHEN AVG_EMP_TOTAL > 0 THEN EMP_HRS_TOTAL / AVG_EMP_TOTAL END,
    (SELECT quantile_cont(EMP_HRS_TOTAL / AVG_EMP_TOTAL, 0.5) FROM clean WHERE AVG_EMP_TOTAL > 0)) AS HRS_PER_EMP,
  (PCT_HRS_UNDERGROUND * 2.0::DOUBLE + PCT_HRS_SURFACE * 1.0::DOUBLE + PCT_HRS_STRIP * 1.5::DOUBLE
    + PCT_HRS_MILL_PREP * 0.8::DOUBLE) * (1.0::DOUBLE + ln(AVG_EMP_TOTAL + 1) * 0.1::DOUBLE) AS RISK_SCORE,
  CAST(PCT_HRS_UNDERGROUND > 0.7 AS INTEGER) AS HIGH_UNDERGROUND,
  CAST(AVG_EMP_TOTAL > (SELECT quantile_cont(AVG_EMP_TOTAL, 0.75) FROM clean) AS INTEGER) AS LARGE_OPERATION,
  CAST(PCT_HRS_OFFICE > 0.5 AS INTEGER) AS HIGH_OFFICE_HRS
FROM clean"""

_REAL = ["LOG_AVG_EMP_TOTAL", "EMP_X_UNDERGROUND", "EMP_X_STRIP", "EMP_X_SURFACE", "EMP_X_MILL", "EMP_X_OFFICE",
         "AVG_EMP_TOTAL_SQ", "HRS_PER_EMP", "RISK_SCORE"]
_FLAGS = ["HIGH_UNDERGROUND", "LARGE_OPERATION", "HIGH_OFFICE_HRS", "MINE_CHAR"]


def register(reg: Registry) -> None:
    def simple(name, columns, sql, source=clean, wrap=with_clean):
        reg.add(name, lambda s, d: source(s, d).select("MINE_ID", *columns()), wrap(f"SELECT MINE_ID, {sql} FROM {source.__name__}"))

    simple("c1_log_plus_one", lambda: [r6(fx.log_plus_one("AVG_EMP_TOTAL"), "v")], "round(ln(AVG_EMP_TOTAL + 1), 6) AS v")
    simple(
        "c2_log_exposure",
        lambda: [r6(fx.log_positive("AVG_EMP_TOTAL"), "log_size"), r6(fx.log_exposure("EMP_HRS_TOTAL"), "offset"),
                 r6(fx.log_positive("NUM_INJURIES"), "log_count")],
        """round(ln(AVG_EMP_TOTAL), 6) AS log_size, round(ln(EMP_HRS_TOTAL / 2000), 6) AS "offset",
        round(CASE WHEN NUM_INJURIES > 0 THEN ln(NUM_INJURIES) END, 6) AS log_count""",
    )
    simple(
        "c3_interactions",
        lambda: [
            r6(fx.interaction(fx.log_plus_one("AVG_EMP_TOTAL"), f"PCT_HRS_{x}"), f"X_{x}")
            for x in ("UNDERGROUND", "STRIP", "SURFACE", "MILL_PREP", "OFFICE")
        ],
        ", ".join(
            f"round(ln(AVG_EMP_TOTAL + 1) * PCT_HRS_{x}, 6) AS X_{x}"
            for x in ("UNDERGROUND", "STRIP", "SURFACE", "MILL_PREP", "OFFICE")
        ),
    )
    simple("c4_square", lambda: [fx.square("AVG_EMP_TOTAL").alias("v")], "AVG_EMP_TOTAL * AVG_EMP_TOTAL AS v")
    reg.add(
        "c5_ratio_median_fill",
        lambda s, d: ft.add_ratio_with_median(
            clean(s, d).withColumn("size", F.col("AVG_EMP_TOTAL") - 3), "EMP_HRS_TOTAL", "size", "v"
        ).select("MINE_ID", r6("v")),
        with_clean(
            """SELECT MINE_ID, round(coalesce(r, (SELECT quantile_cont(r, 0.5) FROM ratios)), 6) AS v FROM ratios""",
            ratios="SELECT MINE_ID, CASE WHEN AVG_EMP_TOTAL - 3 > 0 THEN EMP_HRS_TOTAL / (AVG_EMP_TOTAL - 3) END AS r FROM clean",
        ),
    )
    simple(
        "c6_risk_score",
        lambda: [
            r6(
                fx.weighted_score(
                    [("PCT_HRS_UNDERGROUND", 2.0), ("PCT_HRS_SURFACE", 1.0), ("PCT_HRS_STRIP", 1.5), ("PCT_HRS_MILL_PREP", 0.8)],
                    fx.log_plus_one("AVG_EMP_TOTAL"),
                ),
                "v",
            )
        ],
        """round((PCT_HRS_UNDERGROUND * 2.0::DOUBLE + PCT_HRS_SURFACE * 1.0::DOUBLE + PCT_HRS_STRIP * 1.5::DOUBLE
        + PCT_HRS_MILL_PREP * 0.8::DOUBLE) * (1.0::DOUBLE + ln(AVG_EMP_TOTAL + 1) * 0.1::DOUBLE), 6) AS v""",
    )
    simple(
        "c7_threshold_flags",
        lambda: [fx.exceeds("PCT_HRS_UNDERGROUND", 0.7).alias("u"), fx.exceeds("PCT_HRS_OFFICE", 0.5).alias("o")],
        "CAST(PCT_HRS_UNDERGROUND > 0.7 AS INTEGER) AS u, CAST(PCT_HRS_OFFICE > 0.5 AS INTEGER) AS o",
    )

    def quantile_flag(s, d):
        rows = clean(s, d)
        p75 = scalar_quantiles(rows, {"p": (F.col("AVG_EMP_TOTAL"), 0.75)}).getField("p")
        return rows.select("MINE_ID", fx.exceeds("AVG_EMP_TOTAL", p75).alias("large"))

    reg.add(
        "c8_quantile_flag",
        quantile_flag,
        with_clean("SELECT MINE_ID, CAST(AVG_EMP_TOTAL > (SELECT quantile_cont(AVG_EMP_TOTAL, 0.75) FROM clean) AS INTEGER) AS large FROM clean"),
    )
    simple("c9_composite_category", lambda: [fx.joined_levels("TYPE_OF_MINE", "COMMODITY").alias("v")], "concat_ws(' ', TYPE_OF_MINE, COMMODITY) AS v")

    def relevel(s, d):
        levels = ft.ordered_levels(["5-LOW", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], "3-MEDIUM")
        return ft.level_indicators(clean(s, d).select("MINE_ID", "TYPE_OF_MINE"), "TYPE_OF_MINE", levels, "k_")

    reg.add(
        "c10_reference_level",
        relevel,
        with_clean(
            "SELECT MINE_ID, TYPE_OF_MINE, "
            + ", ".join(f"CAST(TYPE_OF_MINE = '{v}' AS INTEGER) AS \"k_{v}\"" for v in ("1-URGENT", "2-HIGH", "4-NOT SPECIFIED", "5-LOW"))
            + " FROM clean"
        ),
    )
    reg.add(
        "c10_largest_level",
        lambda s, d: ft.largest_level(clean(s, d), "TYPE_OF_MINE"),
        with_clean('SELECT TYPE_OF_MINE, count(*) AS "rows" FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1'),
    )
    reg.add(
        "c11_label_vocabulary",
        lambda s, d: ft.label_vocabulary(clean(s, d), "PRIMARY_LABELS"),
        with_clean(
            """SELECT label, count(*) AS "rows" FROM (SELECT MINE_ID, unnest(list_distinct(string_split(PRIMARY_LABELS, ', '))) AS label
            FROM clean) WHERE label <> '' GROUP BY 1"""
        ),
    )
    reg.add(
        "c11_label_indicators",
        lambda s, d: ft.label_indicators(clean(s, d).select("MINE_ID", "PRIMARY_LABELS"), "PRIMARY_LABELS", [*LABELS, "ABSENT"], "L_"),
        with_clean(
            "SELECT MINE_ID, PRIMARY_LABELS, "
            + ", ".join(f"CAST(list_contains(string_split(PRIMARY_LABELS, ', '), '{v}') AS INTEGER) AS L_{v}" for v in (*LABELS, "ABSENT"))
            + " FROM clean"
        ),
    )
    simple("c12_any_event", lambda: [lb.any_event("NUM_INJURIES").alias("v")], "CAST(NUM_INJURIES > 0 AS INTEGER) AS v")
    simple("c13_capped_class", lambda: [lb.capped_class("INJ_RATE_PER2K").alias("v")], "CAST(trunc(least(INJ_RATE_PER2K, 3)) AS INTEGER) AS v")
    simple(
        "c14_event_classes",
        lambda: [
            lb.class_from_rate("INJ_RATE_PER2K").alias("by_rate"),
            lb.class_from_equal("INJ_RATE_PER2K").alias("by_value"),
            lb.class_from_count("NUM_INJURIES").alias("by_count"),
        ],
        """CASE WHEN INJ_RATE_PER2K > 2 THEN 3 WHEN INJ_RATE_PER2K > 1 THEN 2 WHEN INJ_RATE_PER2K > 0 THEN 1 ELSE 0 END AS by_rate,
        CASE WHEN INJ_RATE_PER2K >= 3 THEN 3 WHEN INJ_RATE_PER2K = 2 THEN 2 WHEN INJ_RATE_PER2K = 1 THEN 1 ELSE 0 END AS by_value,
        CAST(least(NUM_INJURIES, 3) AS INTEGER) AS by_count""",
    )
    simple(
        "c15_rounded_label",
        lambda: [lb.rounded("predicted").alias("p"), lb.rounded(F.col("EMP_HRS_TOTAL") / 200).alias("halves")],
        "CAST(round_even(predicted, 0) AS INTEGER) AS p, CAST(round_even(EMP_HRS_TOTAL / 200, 0) AS INTEGER) AS halves",
        scored,
        with_scored,
    )
    simple("c16_rate_bins", lambda: [lb.right_closed_bin("INJ_RATE_PER2K").alias("bin")], RATE_BIN_SQL.format(c="INJ_RATE_PER2K") + " AS bin")
    simple("c17_exposure_weight", lambda: [fx.exposure_weight("EMP_HRS_TOTAL").alias("w")], "EMP_HRS_TOTAL / 2000 AS w")
    reg.add(
        "c18_epoch_ms",
        lambda s, d: table(s, d, "events")
        .select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
        .select("event_id", "ms", fx.epoch_ms_to_timestamp("ms").alias("at"), fx.epoch_ms_to_date_text("ms").alias("day")),
        """SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('millisecond', ts) AS "at", strftime(ts, '%Y-%m-%d') AS day FROM events""",
    )
    simple(
        "c19_class_names",
        lambda: [lb.class_name(lb.class_from_count("NUM_INJURIES")).alias("name")],
        """CASE WHEN NUM_INJURIES = 0 THEN 'No Injury' WHEN NUM_INJURIES = 1 THEN 'One Injury' WHEN NUM_INJURIES = 2
        THEN 'Two Injuries' ELSE 'Three+ Injuries' END AS name""",
    )
    reg.add(
        "c20_errors",
        lambda s, d: ev.with_errors(scored(s, d)).select("MINE_ID", r6("residual"), r6("abs_error"), r6("squared_error")),
        with_scored(
            """SELECT MINE_ID, round(actual - predicted, 6) AS residual, round(abs(actual - predicted), 6) AS abs_error,
            round((actual - predicted) * (actual - predicted), 6) AS squared_error FROM scored"""
        ),
    )
    reg.add(
        "c21_build_features",
        lambda s, d: ft.build_features(clean(s, d)).select("MINE_ID", *_FLAGS, *[r6(c) for c in _REAL]),
        with_clean(
            f"SELECT MINE_ID, {', '.join(_FLAGS)}, {', '.join(f'round({c}, 6) AS {c}' for c in _REAL)} FROM feats",
            feats=FEATURE_SQL,
        ),
    )
