"""Queries for evaluation (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as lb, measures as ms
from ..operators import evaluate as ev
from .base import Registry, r6, scored, with_scored
from .summaries import THRESHOLD_SQL
from .tables import METRIC_SQL

# Scaled up so that more than two rounded classes occur.
SCALE = 3.0
_A, _P = "CAST(round_even(actual, 0) AS INTEGER)", "CAST(round_even(predicted * 3.0::DOUBLE, 0) AS INTEGER)"


def rounded_rows(s, d):
    return scored(s, d).select(
        "dataset", lb.rounded("actual").alias("a"), lb.rounded(F.col("predicted") * SCALE).alias("p")
    )


CLASS_SCORES_SQL = """SELECT dataset, cls AS class, coalesce(tp / nullif(CAST(named AS DOUBLE), 0), 0) AS "precision",
  coalesce(tp / nullif(CAST(support AS DOUBLE), 0), 0) AS recall, coalesce(2 * tp / nullif(CAST(named + support AS DOUBLE), 0), 0) AS f1,
  CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp
  FROM (SELECT dataset, cls, sum(support) AS support, sum(named) AS named, sum(tp) AS tp FROM (
    SELECT dataset, a AS cls, 1 AS support, 0 AS named, CASE WHEN a = p THEN 1 ELSE 0 END AS tp FROM r
    UNION ALL SELECT dataset, p, 0, 1, 0 FROM r) GROUP BY 1, 2)"""
ROUNDED_SQL = f"SELECT dataset, {_A} AS a, {_P} AS p FROM scored"
AUC_SQL = """SELECT dataset, count(*) AS n, sum(y) AS positives,
  (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS auc
  FROM (SELECT dataset, CAST(actual > 0 AS INTEGER) AS y, rank() OVER (PARTITION BY dataset ORDER BY score)
    + (count(*) OVER (PARTITION BY dataset, score) - 1) / 2.0::DOUBLE AS rk FROM scored) GROUP BY 1"""
AP_SQL = """SELECT dataset, sum(pos * (cpos / CAST(cn AS DOUBLE))) / CAST(max(tot) AS DOUBLE) AS ap FROM (
  SELECT dataset, score, pos, sum(pos) OVER w AS cpos, sum(n) OVER w AS cn, sum(pos) OVER (PARTITION BY dataset) AS tot
  FROM (SELECT dataset, score, count(*) AS n, count(*) FILTER (actual > 0) AS pos FROM scored GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY dataset ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) GROUP BY 1"""


def register(reg: Registry) -> None:
    def measure(name, columns, sql):
        reg.add(
            name,
            lambda s, d: scored(s, d).groupBy("dataset").agg(*[r6(c, n) for n, c in columns().items()]),
            with_scored(
                "SELECT dataset, " + ", ".join(f"round({x}, 6) AS {n}" for n, x in sql.items()) + " FROM (SELECT *, actual - predicted AS e FROM scored) GROUP BY 1"
            ),
        )

    measure(
        "i1_poisson_log_likelihood",
        lambda: {"ll": ms.poisson_log_likelihood("actual", F.col("predicted") - 0.2)},
        {
            "ll": """sum(actual * ln(CASE WHEN predicted - 0.2::DOUBLE <= 0 THEN 1e-6::DOUBLE ELSE predicted - 0.2::DOUBLE END))
            - sum(greatest(predicted - 0.2::DOUBLE, 0))"""
        },
    )
    measure(
        "i2_errors",
        lambda: {
            "mse": ms.mean_squared_error("actual", "predicted"),
            "rmse": ms.root_mean_squared_error("actual", "predicted"),
            "mae": ms.mean_absolute_error("actual", "predicted"),
        },
        {"mse": "avg(e * e)", "rmse": "sqrt(avg(e * e))", "mae": "avg(abs(e))"},
    )
    measure(
        "i3_weighted_errors",
        lambda: {"weighted_rmse": ms.weighted_rmse("actual", "predicted", "weight"), "weighted_mae": ms.weighted_mae("actual", "predicted", "weight")},
        {"weighted_rmse": "sqrt(sum(weight * e * e) / sum(weight))", "weighted_mae": "sum(weight * abs(e)) / sum(weight)"},
    )
    reg.add(
        "i4_segments",
        lambda s, d: ev.segment_scores(scored(s, d), by=["dataset"]).select(
            "dataset", "zero_count", "nonzero_count", *[r6(c) for c in ("zero_avg_pred", "nonzero_avg_pred", "nonzero_avg_actual", "nonzero_rmse")]
        ),
        with_scored(
            """SELECT dataset, count(*) FILTER (actual = 0) AS zero_count, count(*) FILTER (actual > 0) AS nonzero_count,
            round(coalesce(avg(predicted) FILTER (actual = 0), 0), 6) AS zero_avg_pred, round(coalesce(avg(predicted) FILTER (actual > 0), 0), 6) AS nonzero_avg_pred,
            round(coalesce(avg(actual) FILTER (actual > 0), 0), 6) AS nonzero_avg_actual,
            round(coalesce(sqrt(avg((actual - predicted) * (actual - predicted)) FILTER (actual > 0)), 0), 6) AS nonzero_rmse FROM scored GROUP BY 1"""
        ),
    )
    measure(
        "i5_rounded_accuracy",
        lambda: {"rounded_accuracy": ms.hit_rate(F.bround("actual", 0), F.bround("predicted", 0))},
        {"rounded_accuracy": "avg(CASE WHEN round_even(actual, 0) = round_even(predicted, 0) THEN 1.0::DOUBLE ELSE 0 END)"},
    )
    def flag():
        return (F.col("score") >= 0.4).cast("int")

    reg.add(
        "i6_binary_scores",
        lambda s, d: ev.binary_scores(scored(s, d), lb.any_event("actual"), flag(), ["dataset"]).select(
            "dataset", "tp", "fp", "fn", "tn", *[r6(c) for c in ("accuracy", "precision", "recall", "f1")]
        ),
        with_scored(
            """SELECT dataset, tp, fp, fn, tn, round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy,
            round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS "precision", round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
            round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1 FROM (SELECT dataset,
            count(*) FILTER (actual > 0 AND score >= 0.4::DOUBLE) AS tp, count(*) FILTER (actual = 0 AND score >= 0.4::DOUBLE) AS fp,
            count(*) FILTER (actual > 0 AND score < 0.4::DOUBLE) AS fn, count(*) FILTER (actual = 0 AND score < 0.4::DOUBLE) AS tn FROM scored GROUP BY 1)"""
        ),
    )
    reg.add(
        "i7_confusion",
        lambda s, d: ev.confusion(scored(s, d), lb.any_event("actual"), flag()),
        with_scored(
            """SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, count(actual) AS n FROM range(2) x(a) CROSS JOIN range(2) y(p)
            LEFT JOIN scored ON CAST(scored.actual > 0 AS INTEGER) = a AND CAST(score >= 0.4::DOUBLE AS INTEGER) = p GROUP BY 1, 2"""
        ),
    )
    reg.add(
        "i8_classification_report",
        lambda s, d: ev.classification_report(rounded_rows(s, d), "a", "p", ["dataset"]).select(
            "dataset", "class", *[r6(c) for c in ("precision", "recall", "f1")], "support"
        ),
        with_scored(
            """SELECT dataset, CAST(class AS VARCHAR) AS class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cs
            UNION ALL SELECT dataset, 'accuracy', round(sum(tp) / CAST(sum(support) AS DOUBLE), 6), round(sum(tp) / CAST(sum(support) AS DOUBLE), 6),
              round(sum(tp) / CAST(sum(support) AS DOUBLE), 6), CAST(sum(support) AS BIGINT) FROM cs GROUP BY 1
            UNION ALL SELECT dataset, 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM cs GROUP BY 1
            UNION ALL SELECT dataset, 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
              round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM cs GROUP BY 1""",
            r=ROUNDED_SQL,
            cs=CLASS_SCORES_SQL,
        ),
    )
    reg.add(
        "i9_class_accuracy",
        lambda s, d: ev.class_accuracy(rounded_rows(s, d), "a", "p", ["dataset"]).withColumn("accuracy", r6("accuracy")),
        with_scored(
            "SELECT dataset, a AS class, count(*) AS n, round(avg(CASE WHEN a = p THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM r GROUP BY 1, 2",
            r=ROUNDED_SQL,
        ),
    )
    reg.add(
        "i10_detection_rates",
        lambda s, d: ev.detection_rates(scored(s, d), lb.class_from_rate("INJ_RATE_PER2K"), flag()).withColumn("accuracy", r6("accuracy")),
        with_scored(
            """SELECT class, count(*) FILTER (ok) AS correct, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy,
            CASE class WHEN 0 THEN 'No Injury' WHEN 1 THEN 'One Injury' WHEN 2 THEN 'Two Injuries' ELSE 'Three+ Injuries' END AS class_name
            FROM (SELECT class, (class > 0) = (score >= 0.4::DOUBLE) AS ok FROM (SELECT *, CASE WHEN INJ_RATE_PER2K > 2 THEN 3 WHEN INJ_RATE_PER2K > 1 THEN 2
              WHEN INJ_RATE_PER2K > 0 THEN 1 ELSE 0 END AS class FROM scored)) GROUP BY 1"""
        ),
    )
    reg.add(
        "i11_threshold_scan",
        lambda s, d: ev.threshold_scan(scored(s, d), "score", lb.class_from_count("NUM_INJURIES")).select(
            *[r6(c) for c in ("threshold", "class0_accuracy", "class1_rate", "class2_rate", "class3_rate", "overall_accuracy", "diff")]
        ),
        with_scored(
            """SELECT round(threshold, 6) AS threshold, round(class0_accuracy, 6) AS class0_accuracy, round(class1_rate, 6) AS class1_rate,
            round(class2_rate, 6) AS class2_rate, round(class3_rate, 6) AS class3_rate, round(overall_accuracy, 6) AS overall_accuracy,
            round(abs(class0_accuracy - 0.907::DOUBLE), 6) AS diff FROM scan""",
            scan=THRESHOLD_SQL,
        ),
    )
    reg.add(
        "i12_roc_auc",
        lambda s, d: ev.rank_scores(scored(s, d), "score", F.col("actual") > 0, ["dataset"]).select("dataset", "n", "positives", r6("auc")),
        with_scored("SELECT dataset, n, CAST(positives AS BIGINT) AS positives, round(auc, 6) AS auc FROM aucs", aucs=AUC_SQL),
    )
    reg.add(
        "i13_average_precision",
        lambda s, d: ev.rank_scores(scored(s, d), "score", F.col("actual") > 0, ["dataset"]).select("dataset", r6("average_precision")),
        with_scored("SELECT dataset, round(ap, 6) AS average_precision FROM aps", aps=AP_SQL),
    )
    measure("i14_gaussian_log_likelihood", lambda: {"ll": ms.gaussian_log_likelihood("actual", "predicted")}, {"ll": "-sum(e * e) / (2 * count(*))"})
    for name, fn, sql in (
        ("i15_nonzero_macro", ev.nonzero_macro, "sum(CASE WHEN class BETWEEN 1 AND 10 THEN {m} ELSE 0 END) / 10"),
        ("i16_event_weighted", ev.event_weighted, "sum(CASE WHEN class BETWEEN 1 AND 10 THEN (class + 1) * {m} ELSE 0 END) / 65"),
    ):
        reg.add(
            name,
            lambda s, d, fn=fn: fn(ev.class_scores(rounded_rows(s, d), "a", "p", ["dataset"]), ["dataset"]).select(
                "dataset", *[r6(c) for c in ("precision", "recall", "f1")]
            ),
            with_scored(
                "SELECT dataset, " + ", ".join(f'round({sql.format(m=q)}, 6) AS {q}' for q in ('"precision"', "recall", "f1")) + " FROM cs GROUP BY 1",
                r=ROUNDED_SQL,
                cs=CLASS_SCORES_SQL,
            ),
        )
    reg.add(
        "i19_metric_table",
        lambda s, d: ev.metric_table(scored(s, d), probability="score", classes=5).select("metric", r6("value")),
        with_scored(
            METRIC_SQL
            + """ UNION ALL SELECT dataset || '_auc', round(auc, 6) FROM aucs UNION ALL SELECT dataset || '_ap', round(ap, 6) FROM aps
            UNION ALL SELECT dataset || '_class_' || a || '_accuracy', round(avg(CASE WHEN a = p THEN 1.0::DOUBLE ELSE 0 END), 6)
              FROM (SELECT dataset, CAST(round_even(actual, 0) AS INTEGER) AS a, CAST(round_even(predicted, 0) AS INTEGER) AS p FROM scored)
              WHERE a BETWEEN 0 AND 4 GROUP BY dataset, a""",
            aucs=AUC_SQL,
            aps=AP_SQL,
        ),
    )
    reg.add(
        "i20_prediction_summary",
        lambda s, d: ev.prediction_summary(scored(s, d), by=["dataset"]).select(
            "dataset", "n", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        ),
        with_scored(
            """SELECT dataset, count(*) AS n, round(avg(predicted), 6) AS mean, round(stddev_samp(predicted), 6) AS std, round(min(predicted), 6) AS "min",
            round(quantile_cont(predicted, 0.25), 6) AS p25, round(quantile_cont(predicted, 0.5), 6) AS p50, round(quantile_cont(predicted, 0.75), 6) AS p75,
            round(max(predicted), 6) AS "max" FROM scored GROUP BY 1"""
        ),
    )
    reg.add(
        "viz_scored_report",
        lambda s, d: ev.scored_report(scored(s, d).select("MINE_ID", "dataset", "actual", "predicted", "weight")).select(
            "MINE_ID", "dataset", "has_injury", "large_error", *[r6(c) for c in ("residual", "abs_error", "squared_error", "pred_percentile")]
        ),
        with_scored(
            """SELECT MINE_ID, dataset, CAST(actual > 0 AS INTEGER) AS has_injury,
            CAST(abs(e) > (SELECT quantile_cont(abs(actual - predicted), CAST(0.95 AS DOUBLE)) FROM scored) AS INTEGER) AS large_error,
            round(e, 6) AS residual, round(abs(e), 6) AS abs_error, round(e * e, 6) AS squared_error,
            round((rank() OVER (PARTITION BY dataset ORDER BY predicted) + (count(*) OVER (PARTITION BY dataset, predicted) - 1) / 2.0::DOUBLE)
              / count(*) OVER (PARTITION BY dataset), 6) AS pred_percentile FROM (SELECT *, actual - predicted AS e FROM scored)"""
        ),
    )
