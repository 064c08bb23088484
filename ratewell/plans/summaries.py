"""Queries for aggregates (G), windows and top-k (H) and joins (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx, labels as lb, measures as ms
from ..functions.hashing import hash_unit
from ..models import registry as mr
from ..operators import evaluate as ev, ranking as rk, relational as rel, splits as sp, summary as sm
from .base import COMMODITIES, Registry, clean, mine_year, r6, scored, table, with_clean, with_mine, with_scored
from .features import RATE_BIN_SQL

DESCRIBED = ["NUM_INJURIES", "EMP_HRS_TOTAL", "SEAM_HEIGHT", "INJ_RATE_PER2K"]
UNIT_SQL = "CAST(CAST('0x' || substr(md5(concat(CAST({key} AS VARCHAR), '|{seed}')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"

# The event log read as a log of model runs: a user is a run, an event type a metric.
RUN_METRICS_SQL = """SELECT CAST(user_id AS VARCHAR) AS version, event_type AS metric,
  arg_max(value, event_id) AS value FROM events GROUP BY 1, 2"""


def run_metrics(s, d):
    log = table(s, d, "events").select(
        F.col("user_id").cast("string").alias("version"), F.col("event_type").alias("metric"), "value", "event_id"
    )
    return rk.latest(log, ["version", "metric"], ["event_id"]).select("version", "metric", "value")


def versions(s, d):
    return table(s, d, "events").groupBy(F.col("user_id").cast("string").alias("version")).agg(F.min("ts").alias("created_at"))


VERSIONS_SQL = "SELECT CAST(user_id AS VARCHAR) AS version, min(ts) AS created_at FROM events GROUP BY 1"


def latencies(s, d):
    return table(s, d, "events").select(F.col("event_type").alias("version"), (F.col("value") / 10.0).alias("latency"), "ts")


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS name, count({column}) AS n, count(*) - count({column}) AS nulls, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS "min", CAST(max({column}) AS DOUBLE) AS "max",
      round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS p50,
      round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS p75 FROM clean"""


def register(reg: Registry) -> None:
    # --- aggregates
    reg.add(
        "g1_describe",
        lambda s, d: sm.describe(clean(s, d), DESCRIBED).select(
            "name", "n", "nulls", r6("mean"), r6("std"), "min", "max", r6("p25"), r6("p50"), r6("p75")
        ),
        with_clean(" UNION ALL ".join(_describe_sql(c) for c in DESCRIBED)),
    )
    reg.add(
        "g2_value_counts",
        lambda s, d: sm.value_counts(clean(s, d).withColumn("kind", fx.joined_levels("TYPE_OF_MINE", "COMMODITY")), "kind", 10),
        with_clean("SELECT concat_ws(' ', TYPE_OF_MINE, COMMODITY) AS kind, count(*) AS n FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    )
    reg.add(
        "g3_distinct_counts",
        lambda s, d: sm.distinct_counts(clean(s, d), ["PRIMARY_LABELS", "US_STATE"]),
        with_clean("SELECT count(DISTINCT PRIMARY_LABELS) AS PRIMARY_LABELS_distinct, count(DISTINCT US_STATE) AS US_STATE_distinct FROM clean"),
    )
    reg.add(
        "g4_quantiles",
        lambda s, d: rk.quantiles(clean(s, d), "INJ_RATE_PER2K", [0.5, 0.75, 0.95], ["COMMODITY"]).select(
            "COMMODITY", r6("p50"), r6("p75"), r6("p95")
        ),
        with_clean(
            """SELECT COMMODITY, round(quantile_cont(INJ_RATE_PER2K, 0.5), 6) AS p50, round(quantile_cont(INJ_RATE_PER2K, 0.75), 6) AS p75,
            round(quantile_cont(INJ_RATE_PER2K, CAST(0.95 AS DOUBLE)), 6) AS p95 FROM clean GROUP BY 1"""
        ),
    )
    reg.add(
        "g5_basic_stats",
        lambda s, d: sm.basic_stats(ev.with_errors(scored(s, d)), "residual", ["dataset"]).select(
            "dataset", "n", r6("sum"), r6("mean"), r6("std"), r6("min"), r6("max")
        ),
        with_scored(
            """SELECT dataset, count(*) AS n, round(sum(actual - predicted), 6) AS "sum", round(avg(actual - predicted), 6) AS mean,
            round(stddev_samp(actual - predicted), 6) AS std, round(min(actual - predicted), 6) AS "min",
            round(max(actual - predicted), 6) AS "max" FROM scored GROUP BY 1"""
        ),
    )
    reg.add(
        "g6_group_mean",
        lambda s, d: sm.group_mean(ev.with_errors(scored(s, d)), "US_STATE", "abs_error").withColumn("mean", r6("mean")),
        with_scored("SELECT US_STATE, round(avg(abs(actual - predicted)), 6) AS mean FROM scored GROUP BY 1"),
    )
    reg.add(
        "g7_crosstab",
        lambda s, d: sm.crosstab_wide(mine_year(s, d), "MINE_STATUS", "COMMODITY", COMMODITIES),
        with_mine(
            "SELECT MINE_STATUS, " + ", ".join(f"count(*) FILTER (COMMODITY = '{c}') AS {c}" for c in COMMODITIES) + " FROM mine_year GROUP BY 1"
        ),
    )
    reg.add(
        "g7_crosstab_long",
        lambda s, d: sm.crosstab(clean(s, d), "COMMODITY", "TYPE_OF_MINE"),
        with_clean("SELECT COMMODITY, TYPE_OF_MINE, count(*) AS n FROM clean GROUP BY 1, 2"),
    )
    reg.add(
        "g8_share_where",
        lambda s, d: sm.share_where(mine_year(s, d), "MINE_STATUS", F.col("EMP_HRS_TOTAL") < 2000).withColumn("share", r6("share")),
        with_mine(
            """SELECT MINE_STATUS, count(*) AS n, round(avg(CASE WHEN EMP_HRS_TOTAL < 2000 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share
            FROM mine_year GROUP BY 1"""
        ),
    )
    reg.add(
        "g9_summary_per_period",
        lambda s, d: sm.describe(clean(s, d), ["INJ_RATE_PER2K"], ["YEAR"]).select(
            "YEAR", "n", r6("mean"), "min", r6("p25"), r6("p50"), r6("p75"), r6("max")
        ),
        with_clean(
            """SELECT YEAR, count(*) AS n, round(avg(INJ_RATE_PER2K), 6) AS mean, min(INJ_RATE_PER2K) AS "min",
            round(quantile_cont(INJ_RATE_PER2K, 0.25), 6) AS p25, round(quantile_cont(INJ_RATE_PER2K, 0.5), 6) AS p50,
            round(quantile_cont(INJ_RATE_PER2K, 0.75), 6) AS p75, round(max(INJ_RATE_PER2K), 6) AS "max" FROM clean GROUP BY 1"""
        ),
    )
    reg.add(
        "g9_rate_by_commodity_year",
        lambda s, d: sm.rate_by(clean(s, d), ["COMMODITY", "YEAR"]).withColumn("rate", r6("rate")),
        with_clean(
            """SELECT COMMODITY, YEAR, count(*) AS entities, CAST(sum(NUM_INJURIES) AS BIGINT) AS events, sum(EMP_HRS_TOTAL) AS exposure,
            round(sum(NUM_INJURIES) * 2000.0::DOUBLE / sum(EMP_HRS_TOTAL), 6) AS rate FROM clean GROUP BY 1, 2"""
        ),
    )
    reg.add(
        "g9_typical_height",
        lambda s, d: clean(s, d).where(F.col("COMMODITY") == "BUILDING").agg(r6(F.avg("SEAM_HEIGHT"), "mean_height")),
        with_clean("SELECT round(avg(SEAM_HEIGHT), 6) AS mean_height FROM clean WHERE COMMODITY = 'BUILDING'"),
    )
    reg.add(
        "g10_count_classes",
        lambda s, d: sm.count_classes(clean(s, d), "NUM_INJURIES"),
        with_clean(
            """SELECT count(*) FILTER (NUM_INJURIES = 0) AS zero, count(*) FILTER (NUM_INJURIES = 1) AS one,
            count(*) FILTER (NUM_INJURIES = 2) AS two, count(*) FILTER (NUM_INJURIES >= 3) AS three_or_more FROM clean"""
        ),
    )
    reg.add(
        "g11_null_bins",
        lambda s, d: sm.null_count(clean(s, d), F.when(F.col("INJ_RATE_PER2K") > 0, F.col("INJ_RATE_PER2K"))),
        with_clean("SELECT count(*) FILTER (NOT INJ_RATE_PER2K > 0) AS nulls, count(*) AS n FROM clean"),
    )
    reg.add(
        "g12_class_distribution",
        lambda s, d: sm.class_distribution(clean(s, d).withColumn("class", lb.class_from_count("NUM_INJURIES")), "class", 6),
        with_clean(
            """SELECT CAST(i AS INTEGER) AS class, count(NUM_INJURIES) AS n FROM range(6) t(i) LEFT JOIN clean ON least(NUM_INJURIES, 3) = i GROUP BY 1"""
        ),
    )
    reg.add(
        "g13_histogram",
        lambda s, d: sm.histogram(ev.with_errors(scored(s, d)), "residual", 50).select("bin", r6("low"), r6("high"), "n"),
        with_scored(
            """SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS low, round(lo + (i + 1) * w, 6) AS high, coalesce(n, 0) AS n
            FROM range(50) t(i) CROSS JOIN span LEFT JOIN
              (SELECT CAST(least(floor((x - lo) / w), 49) AS BIGINT) AS b, count(*) AS n FROM e CROSS JOIN span GROUP BY 1) ON b = i""",
            e="SELECT actual - predicted AS x FROM scored",
            span="SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM e",
        ),
    )
    reg.add(
        "g14_box_stats",
        lambda s, d: sm.box_stats(clean(s, d), "COMMODITY", "INJ_RATE_PER2K").select(
            "COMMODITY", "n", r6("p25"), r6("p50"), r6("p75"), r6("whisker_low"), r6("whisker_high"), "outliers"
        ),
        with_clean(
            """SELECT COMMODITY, count(*) AS n, round(any_value(p25), 6) AS p25, round(any_value(p50), 6) AS p50, round(any_value(p75), 6) AS p75,
            round(min(INJ_RATE_PER2K) FILTER (ok), 6) AS whisker_low, round(max(INJ_RATE_PER2K) FILTER (ok), 6) AS whisker_high,
            count(*) FILTER (NOT ok) AS outliers
            FROM (SELECT *, INJ_RATE_PER2K BETWEEN p25 - (p75 - p25) * 1.5 AND p75 + (p75 - p25) * 1.5 AS ok FROM clean JOIN q USING (COMMODITY))
            GROUP BY 1""",
            q="""SELECT COMMODITY, quantile_cont(INJ_RATE_PER2K, 0.25) AS p25, quantile_cont(INJ_RATE_PER2K, 0.5) AS p50,
            quantile_cont(INJ_RATE_PER2K, 0.75) AS p75 FROM clean GROUP BY 1""",
        ),
    )
    reg.add(
        "g15_log_log_cells",
        lambda s, d: sm.log_log_cells(clean(s, d), "AVG_EMP_TOTAL", "EMP_HRS_TOTAL", 0.3),
        with_clean(
            """SELECT CAST(floor(ln(AVG_EMP_TOTAL) / 0.3::DOUBLE) AS BIGINT) AS x_cell, CAST(floor(ln(EMP_HRS_TOTAL) / 0.3::DOUBLE) AS BIGINT) AS y_cell,
            count(*) AS n FROM clean WHERE AVG_EMP_TOTAL > 0 AND EMP_HRS_TOTAL > 0 GROUP BY 1, 2"""
        ),
    )
    reg.add(
        "g15_marker_size",
        lambda s, d: scored(s, d).select("MINE_ID", "dataset", r6(sm.marker_size("weight"), "size")),
        with_scored("SELECT MINE_ID, dataset, round(ln(1 + weight) * 10, 6) AS size FROM scored"),
    )
    reg.add(
        "g16_mean_prediction",
        lambda s, d: scored(s, d).agg(r6(F.avg("predicted"), "average_predicted_rate")),
        with_scored("SELECT round(avg(predicted), 6) AS average_predicted_rate FROM scored"),
    )
    reg.add(
        "g17_usage_counts",
        lambda s, d: sm.usage_counts(latencies(s, d), "version", ["1", "2", "3", "4", "5"]),
        """SELECT version, CAST(sum(n) AS BIGINT) AS n FROM (SELECT event_type AS version, 1 AS n FROM events
        UNION ALL SELECT CAST(i AS VARCHAR), 0 FROM range(1, 6) t(i)) GROUP BY 1""",
    )
    les = [f"{b:g}" for b in sm.LATENCY_BOUNDS]
    reg.add(
        "g18_latency_histogram",
        lambda s, d: sm.latency_histogram(latencies(s, d), "version", "latency").withColumn("total", r6("total")),
        "WITH l AS (SELECT event_type AS version, value / 10 AS x FROM events), t AS (SELECT version, count(x) AS n, round(sum(x), 6) AS total FROM l GROUP BY 1) "
        + " UNION ALL ".join(
            f"SELECT version, '{b}' AS le, count(*) FILTER (x <= {b}::DOUBLE) AS cumulative, any_value(n) AS n, any_value(total) AS total FROM l JOIN t USING (version) GROUP BY 1"
            for b in les
        )
        + " UNION ALL SELECT version, '+Inf', n, n, total FROM t",
    )
    reg.add(
        "g19_smallest_class",
        lambda s, d: sm.smallest_class(clean(s, d).withColumn("class", lb.class_from_count("NUM_INJURIES")), "class"),
        with_clean("SELECT min(n) AS smallest FROM (SELECT least(NUM_INJURIES, 3) AS c, count(*) AS n FROM clean GROUP BY 1)"),
    )

    # --- windows, ordering, top-k
    reg.add(
        "h1_percentile_rank",
        lambda s, d: rk.percent_rank_average(scored(s, d).select("MINE_ID", "dataset", "predicted"), "predicted", ["dataset"], "pct").select(
            "MINE_ID", "dataset", r6("pct")
        ),
        with_scored(
            """SELECT MINE_ID, dataset, round((rank() OVER (PARTITION BY dataset ORDER BY predicted) + (count(*) OVER (PARTITION BY dataset, predicted) - 1) / 2.0::DOUBLE)
            / count(*) OVER (PARTITION BY dataset), 6) AS pct FROM scored"""
        ),
    )
    reg.add(
        "h2_large_errors",
        lambda s, d: rk.flag_above_quantile(ev.with_errors(scored(s, d)), "abs_error", 0.95, "large_error").select("MINE_ID", "large_error"),
        with_scored(
            """SELECT MINE_ID, CAST(e > (SELECT quantile_cont(e, CAST(0.95 AS DOUBLE)) FROM errs) AS INTEGER) AS large_error FROM errs""",
            errs="SELECT MINE_ID, abs(actual - predicted) AS e FROM scored",
        ),
    )
    reg.add(
        "h4_top_groups",
        lambda s, d: ev.with_errors(scored(s, d))
        .groupBy("US_STATE")
        .agg(r6(F.avg("abs_error"), "mae"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("mae"), "US_STATE")
        .limit(20),
        with_scored(
            """SELECT US_STATE, round(avg(abs(actual - predicted)), 6) AS mae, count(*) AS n FROM scored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
        ),
    )

    reg.add(
        "h5_best_run",
        lambda s, d: mr.best_run(run_metrics(s, d), "click"),
        f"SELECT version, value FROM ({RUN_METRICS_SQL}) WHERE metric = 'click' ORDER BY value, CAST(version AS BIGINT) LIMIT 1",
    )
    reg.add(
        "h6_best_threshold",
        lambda s, d: ev.best_threshold(ev.threshold_scan(scored(s, d), "score", lb.class_from_count("NUM_INJURIES"))).select(
            r6("threshold"), r6("class0_accuracy"), r6("overall_accuracy")
        ),
        with_scored(
            """SELECT round(threshold, 6) AS threshold, round(class0_accuracy, 6) AS class0_accuracy, round(overall_accuracy, 6) AS overall_accuracy
            FROM scan ORDER BY abs(class0_accuracy - 0.907::DOUBLE), threshold LIMIT 1""",
            scan=THRESHOLD_SQL,
        ),
    )

    reg.add(
        "h7_latest_version",
        lambda s, d: mr.mark_latest(versions(s, d)),
        f"""SELECT version, created_at, CASE WHEN rn = 1 THEN 'Production' ELSE 'Archived' END AS status, rn = 1 AS is_active
        FROM (SELECT *, row_number() OVER (ORDER BY created_at DESC, version DESC) AS rn FROM ({VERSIONS_SQL}))""",
    )
    reg.add("h8_latest_metric_value", run_metrics, RUN_METRICS_SQL)
    reg.add(
        "h9_ordered_grid",
        lambda s, d: ev.confusion(scored(s, d), lb.rounded("actual"), lb.rounded("predicted"), full=False).orderBy("actual", "predicted"),
        with_scored(
            """SELECT CAST(round_even(actual, 0) AS INTEGER) AS actual, CAST(round_even(predicted, 0) AS INTEGER) AS predicted, count(*) AS n
            FROM scored GROUP BY 1, 2 ORDER BY 1, 2"""
        ),
    )

    # --- joins and set operations
    unit = UNIT_SQL.format(key="MINE_ID", seed=3)

    def partition_rows(s, d):
        rows = clean(s, d)
        keys = rows.where(hash_unit("MINE_ID", 3) < 0.75).select("MINE_ID")
        train, test = sp.apply_partition(rows.select("MINE_ID", "NUM_INJURIES"), keys, "MINE_ID")
        return rel.union_tagged({"train": train, "test": test}, "part")

    reg.add(
        "f1_partition_rows",
        partition_rows,
        with_clean(f"SELECT MINE_ID, NUM_INJURIES, CASE WHEN {unit} < 0.75 THEN 'train' ELSE 'test' END AS part FROM clean"),
    )
    reg.add(
        "f2_versions_with_metrics",
        lambda s, d: rel.attach_metrics(versions(s, d), run_metrics(s, d), "version", ["click", "purchase", "absent"]),
        f"""SELECT version, created_at, max(value) FILTER (metric = 'click') AS click, max(value) FILTER (metric = 'purchase') AS purchase,
        CAST(NULL AS DOUBLE) AS absent FROM ({VERSIONS_SQL}) LEFT JOIN ({RUN_METRICS_SQL}) USING (version) GROUP BY 1, 2""",
    )
    reg.add(
        "f3_active_flag",
        lambda s, d: rel.flag_active(
            versions(s, d), versions(s, d).agg(F.max_by("version", F.struct("created_at", "version")).alias("version"))
        ),
        f"SELECT version, created_at, version = (SELECT arg_max(version, (created_at, version)) FROM ({VERSIONS_SQL})) AS is_active FROM ({VERSIONS_SQL})",
    )
    reg.add(
        "f4_rows_of_top_groups",
        lambda s, d: rk.keep_top_groups(clean(s, d).select("MINE_ID", "US_STATE"), "US_STATE", F.count(F.lit(1)), 10),
        with_clean(
            "SELECT MINE_ID, US_STATE FROM clean WHERE US_STATE IN (SELECT US_STATE FROM clean GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"
        ),
    )

    def tagged(s, d):
        rows = scored(s, d)
        return rel.union_tagged(
            {p: rows.where(F.col("dataset") == p).select("MINE_ID", "actual", "weight") for p in ("train", "test")}
        )

    reg.add("f5_union_tagged", tagged, with_scored("SELECT MINE_ID, actual, weight, dataset FROM scored"))
    reg.add(
        "f6_distinct_labels",
        lambda s, d: rel.distinct_union(
            scored(s, d).select(lb.rounded("actual").alias("a"), lb.rounded("predicted").alias("p")), ["a", "p"]
        ),
        with_scored(
            "SELECT CAST(round_even(actual, 0) AS INTEGER) AS label FROM scored UNION SELECT CAST(round_even(predicted, 0) AS INTEGER) FROM scored"
        ),
    )

    def overlay(s, d):
        logged = run_metrics(s, d).select("version", "metric", "value")
        newer = logged.where((F.col("version").cast("bigint") % 3 == 0)).withColumn("value", F.col("value") + 1000)
        older = logged.where((F.col("version").cast("bigint") % 2 == 0))
        return rel.overlay(older, newer, ["version", "metric"])

    reg.add(
        "f7_overlay_metrics",
        overlay,
        f"""SELECT version, metric, CASE WHEN CAST(version AS BIGINT) % 3 = 0 THEN value + 1000 ELSE value END AS value FROM ({RUN_METRICS_SQL})
        WHERE CAST(version AS BIGINT) % 3 = 0 OR CAST(version AS BIGINT) % 2 = 0""",
    )
    reg.add(
        "f8_known_versions",
        lambda s, d: rel.known_keys(
            table(s, d, "events").select("event_id", (F.col("user_id") * 2).cast("string").alias("version")), versions(s, d), "version"
        ),
        f"""SELECT event_id, CAST(user_id * 2 AS VARCHAR) AS version,
        CAST(user_id * 2 AS VARCHAR) IN (SELECT version FROM ({VERSIONS_SQL})) AS known FROM events""",
    )
    reg.add(
        "f9_attach_labels",
        lambda s, d: rel.attach_labels(
            clean(s, d).select("MINE_ID", "COMMODITY"),
            mine_year(s, d).select("MINE_ID", lb.class_from_count("NUM_INJURIES").alias("label")),
            "MINE_ID",
        ),
        with_clean("SELECT MINE_ID, COMMODITY, CAST(least(NUM_INJURIES, 3) AS INTEGER) AS label FROM clean"),
    )
    reg.add(
        "f11_complete_grid",
        lambda s, d: ev.confusion(scored(s, d), lb.rounded("actual"), lb.rounded("predicted"), ["dataset"]),
        with_scored(
            """SELECT dataset, a.l AS actual, p.l AS predicted, coalesce(n, 0) AS n FROM (SELECT DISTINCT dataset FROM scored)
            CROSS JOIN labels a CROSS JOIN labels p LEFT JOIN counts USING (dataset) WHERE false
            UNION ALL SELECT g.dataset, g.a, g.p, coalesce(c.n, 0) FROM
              (SELECT dataset, a.l AS a, p.l AS p FROM (SELECT DISTINCT dataset FROM scored) CROSS JOIN labels a CROSS JOIN labels p) g
            LEFT JOIN counts c ON g.dataset = c.dataset AND g.a = c.a AND g.p = c.p""",
            counts="""SELECT dataset, CAST(round_even(actual, 0) AS INTEGER) AS a, CAST(round_even(predicted, 0) AS INTEGER) AS p, count(*) AS n
            FROM scored GROUP BY 1, 2, 3""",
            labels="SELECT a AS l FROM counts UNION SELECT p FROM counts",
        ),
    )


THRESHOLD_SQL = """SELECT threshold, class0_accuracy, class1_rate, class2_rate, class3_rate, overall_accuracy FROM (
  SELECT threshold, count(*) FILTER (k = 0 AND NOT yes) / CAST(count(*) FILTER (k = 0) AS DOUBLE) AS class0_accuracy,
    count(*) FILTER (k = 1 AND yes) / CAST(nullif(count(*) FILTER (k = 1), 0) AS DOUBLE) AS class1_rate,
    count(*) FILTER (k = 2 AND yes) / CAST(nullif(count(*) FILTER (k = 2), 0) AS DOUBLE) AS class2_rate,
    count(*) FILTER (k = 3 AND yes) / CAST(nullif(count(*) FILTER (k = 3), 0) AS DOUBLE) AS class3_rate,
    count(*) FILTER ((k = 0) <> yes) / CAST(count(*) AS DOUBLE) AS overall_accuracy
  FROM (SELECT t.threshold, least(NUM_INJURIES, 3) AS k, score >= t.threshold AS yes FROM scored CROSS JOIN
    (SELECT CASE WHEN i = 499 THEN 0.99::DOUBLE ELSE 0.01::DOUBLE + i * (0.98::DOUBLE / 499) END AS threshold FROM range(500) r(i)) t)
  GROUP BY 1)"""
