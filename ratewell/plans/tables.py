"""Queries for sources and sinks (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx, labels as lb
from ..functions.hashing import hash_unit
from .. import workflow as wf
from ..operators import encode as en, evaluate as ev, features as ft, relational as rel, splits as sp
from ..roles import SHARE_COLUMNS
from ..session import scratch_dir
from ..sources import requests as rq, runlog as rl, tables as tb, versions as vs
from .base import COMMODITIES, LABELS, Registry, clean, mine_year, r6, scored, table, with_clean, with_mine, with_scored
from .summaries import UNIT_SQL

_RAW = ["MINE_ID", "YEAR", "US_STATE", "COMMODITY", "PRIMARY_LABELS", "MINE_STATUS", "TYPE_OF_MINE", "SEAM_HEIGHT",
        "AVG_EMP_TOTAL", "EMP_HRS_TOTAL", "NUM_INJURIES"]


def metric_log(s, d):
    """The event log as run metrics: a day is a run, an event type a metric."""
    return table(s, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.col("event_type").alias("metric"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        "value",
        F.col("event_id").alias("step"),
    )


#: Exported columns and what they are in SQL.
EXPORTED = {
    **{c: c for c in ("SEAM_HEIGHT", "AVG_EMP_TOTAL", *SHARE_COLUMNS)},
    **{f"COMMODITY_{c}": f"CAST(COMMODITY = '{c}' AS INTEGER)" for c in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")},
    "label_NUM_INJURIES": "NUM_INJURIES",
    "label_any_event": "CAST(NUM_INJURIES > 0 AS INTEGER)",
    "label_class": "CASE WHEN INJ_RATE_PER2K >= 3 THEN 3 WHEN INJ_RATE_PER2K IN (1, 2) THEN INJ_RATE_PER2K ELSE 0 END",
}

METRIC_LOG_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_type AS metric, epoch_us(ts) // 1000 AS ts_ms, value,
  event_id AS step FROM events"""


def register(reg: Registry) -> None:
    def csv_scan(s, d):
        path = scratch_dir(s, "csv")
        tb.write_csv(mine_year(s, d).select([f.name for f in tb.exposure_schema()]), path)
        return tb.read_csv(s, path, tb.exposure_schema()).select(*_RAW, *[r6(c) for c in SHARE_COLUMNS])

    shares_sql = ", ".join(f"round({c}, 6) AS {c}" for c in SHARE_COLUMNS)
    reg.add("a1_csv_scan", csv_scan, with_mine(f"SELECT {', '.join(_RAW)}, {shares_sql} FROM mine_year"))

    def csv_sink(s, d):
        path = scratch_dir(s, "csv")
        tb.write_csv(clean(s, d).select("MINE_ID", "US_STATE", "ADJ_STATUS", "NUM_INJURIES"), path)
        return tb.read_csv(s, path, "MINE_ID bigint, US_STATE string, ADJ_STATUS string, NUM_INJURIES bigint")

    reg.add("a2_csv_sink", csv_sink, with_clean("SELECT MINE_ID, US_STATE, ADJ_STATUS, NUM_INJURIES FROM clean"))

    def snapshot(s, d):
        path = scratch_dir(s, "snapshot")
        build = lambda: clean(s, d).select("MINE_ID", "COMMODITY", "NUM_INJURIES", r6("INJ_RATE_PER2K"))
        return tb.read_or_build(s, path, build)

    reg.add(
        "a3_processed_snapshot",
        snapshot,
        with_clean("SELECT MINE_ID, COMMODITY, NUM_INJURIES, round(INJ_RATE_PER2K, 6) AS INJ_RATE_PER2K FROM clean"),
    )

    def parts(s, d):
        path = scratch_dir(s, "parts")
        tb.write_snapshot(scored(s, d).select("MINE_ID", "dataset", "actual", "weight"), path, "dataset")
        return tb.read_snapshot(s, path).where(F.col("dataset") == "test")

    reg.add("a4_part_snapshot", parts, with_scored("SELECT MINE_ID, dataset, actual, weight FROM scored WHERE dataset = 'test'"))

    def preprocessor_round_trip(s, d):
        rows = clean(s, d)
        path = scratch_dir(s, "preprocessor")
        en.Preprocessor(["COMMODITY"], ["SEAM_HEIGHT"], ["PRIMARY_LABELS"]).fit(rows).save(path)
        fitted = en.FittedPreprocessor.load(path)
        return feature_totals(fitted, fitted.transform(rows)).select("name", "nonzero")

    flags = [f"SELECT 'COMMODITY_{c}' AS name, count(*) FILTER (COMMODITY = '{c}') AS nonzero FROM clean" for c in COMMODITIES[1:]]
    flags += ["SELECT 'SEAM_HEIGHT', count(*) FILTER (SEAM_HEIGHT <> (SELECT avg(SEAM_HEIGHT) FROM clean)) FROM clean"]
    flags += [
        f"SELECT 'PRIMARY_LABELS_{v}', count(*) FILTER (list_contains(string_split(PRIMARY_LABELS, ', '), '{v}')) FROM clean" for v in LABELS
    ]
    reg.add("a5_preprocessor_round_trip", preprocessor_round_trip, with_clean(" UNION ALL ".join(flags)))

    def result_tables(s, d):
        path = scratch_dir(s, "results")
        metrics = ev.to_long(ev.metric_columns(scored(s, d)), "dataset").select("metric", r6("value"))
        tb.write_csv(metrics, path)
        return tb.read_csv(s, path, "metric string, value double")

    reg.add("a7_result_table", result_tables, with_scored(METRIC_SQL))

    def metric_scan(s, d):
        path = scratch_dir(s, "runs")
        rl.write_metric_log(metric_log(s, d), path)
        return rl.scan_metrics(s, path, rl.PARTITIONED_METRIC_PATH)

    reg.add("a8_metric_log", metric_scan, METRIC_LOG_SQL)

    def param_scan(s, d):
        path = scratch_dir(s, "params")
        per_run = table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_id")).agg(
            F.count(F.lit(1)).cast("string").alias("train_samples"), F.max("event_type").alias("tree_method")
        )
        pairs = F.array(*[F.struct(F.lit(c).alias("param"), F.col(c).alias("value")) for c in ("train_samples", "tree_method")])
        rl.write_param_log(per_run.select("run_id", F.explode(pairs).alias("p")).select("run_id", "p.*"), path)
        return rl.scan_params(s, path, rl.PARTITIONED_PARAM_PATH)

    reg.add(
        "a9_param_log",
        param_scan,
        """SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'train_samples' AS param, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY 1
        UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'tree_method', max(event_type) FROM events GROUP BY 1""",
    )

    def upsert(s, d):
        store = vs.metric_table(s, scratch_dir(s, "versions"))
        rows = table(s, d, "events").select(
            F.col("user_id").cast("string").alias("version"),
            F.col("event_type").alias("metric_name"),
            F.col("value").alias("metric_value"),
            F.col("ts").cast("timestamp").alias("updated_at"),
            "event_id",
        )
        store.upsert(rows.where(F.col("event_id") % 2 == 0))
        return store.upsert(rows.where(F.col("event_id") % 2 == 1))

    reg.add(
        "a10_upsert",
        upsert,
        """SELECT CAST(user_id AS VARCHAR) AS version, event_type AS metric_name, arg_max(value, (event_id % 2, ts)) AS metric_value,
        arg_max(ts, (event_id % 2, ts)) AS updated_at FROM events GROUP BY 1, 2""",
    )

    def batches(s, d):
        entry = lambda shift: F.struct(
            (F.col("user_id") + shift).cast("string").alias("MINE_ID"),
            F.col("event_type").alias("CURRENT_STATUS"),
            F.lit(2024).alias("YEAR"),
            F.col("value").alias("HOURS_WORKED"),
        )
        body = F.when(F.col("event_id") % 97 == 0, "{broken").otherwise(F.to_json(F.struct(F.array(entry(0), entry(1)).alias("mines"))))
        rows = rq.parse_batches(table(s, d, "events").select("event_id", body.alias("body")), "body", "event_id")
        return rows.select("event_id", "entry_no", "MINE_ID", "CURRENT_STATUS", "YEAR", "HOURS_WORKED")

    reg.add(
        "a11_batch_requests",
        batches,
        """SELECT event_id, CAST(i AS INTEGER) AS entry_no, CAST(user_id + i AS VARCHAR) AS MINE_ID, event_type AS CURRENT_STATUS,
        CAST(2024 AS INTEGER) AS YEAR, value AS HOURS_WORKED FROM events CROSS JOIN range(2) t(i) WHERE event_id % 97 <> 0
        UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 97 = 0""",
    )
    reg.add(
        "a11_event_props",
        lambda s, d: table(s, d, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k")),
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    )

    def answered(s, d):
        return table(s, d, "events").select("user_id", F.col("event_id").cast("string").alias("mine_id"), "value")

    reg.add(
        "a12_batch_responses",
        lambda s, d: rq.batch_responses(answered(s, d), "user_id", "mine_id", "value", F.lit("2"), 1_000_000).withColumn(
            "average_predicted_rate", r6("average_predicted_rate")
        ),
        """SELECT user_id, CAST(0 AS BIGINT) AS page, '[' || string_agg('{"mine_id":"' || event_id || '","predicted_injury_rate":'
          || CAST(value AS VARCHAR) || '}', ',' ORDER BY CAST(event_id AS VARCHAR)) || ']' AS predictions,
        round(avg(value), 6) AS average_predicted_rate, '2' AS model_version FROM events GROUP BY 1""",
    )
    # One batch with nearly all entries, and some without batch.
    one_batch = "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 49 = 0 THEN user_id ELSE -1 END"
    reg.add(
        "a12_response_rows",
        lambda s, d: rq.response_rows(answered(s, d).select(F.expr(one_batch.replace("event_id", "bigint(mine_id)")).alias("batch"), "mine_id", "value"), "batch", "mine_id", "value", F.lit("2")).withColumn(
            "average_predicted_rate", r6("average_predicted_rate")
        ),
        f"""SELECT {one_batch} AS batch, CAST(event_id AS VARCHAR) AS mine_id, value AS predicted_injury_rate,
        round(avg(value) OVER (PARTITION BY {one_batch}), 6) AS average_predicted_rate, '2' AS model_version FROM events""",
    )

    def export_test_set(s, d):
        rows = clean(s, d)
        keys = rows.where(hash_unit("MINE_ID", 11) >= 0.75).select("MINE_ID")
        test = rel.rows_in(rows, keys, "MINE_ID")
        fitted = en.Preprocessor(["COMMODITY"], ["SEAM_HEIGHT", "AVG_EMP_TOTAL"], scale=False).fit(rows)
        wide = fitted.transform(test).withColumn("f", _to_array("features"))
        path = scratch_dir(s, "export")
        out = wide.select(
            "MINE_ID",
            *[F.col("f")[i].alias(n) for i, n in enumerate(fitted.names)],
            "NUM_INJURIES",
            lb.any_event("NUM_INJURIES").alias("any_event"),
            lb.class_from_equal("INJ_RATE_PER2K").alias("event_class"),
        )
        tb.write_snapshot(out, path)
        return tb.read_snapshot(s, path)

    def export_all_features(s, d):
        """Totals of the exported columns that have a plain form in SQL; the file holds all features."""
        rows = ft.build_features(sp.random_split(clean(s, d), "MINE_ID", 0.75, 11))
        groups = en.feature_groups(rows)
        kinds = [[c for c in groups[k] if c not in ("MINE_ID", "dataset")] for k in ("categorical", "numeric", "labels")]
        fitted = en.Preprocessor(*kinds, scale=False).fit(rows)
        out = wf.export_test_set(rows, fitted, scratch_dir(s, "export"))
        if set(fitted.names) - set(out.columns):
            raise ValueError("a feature is missing in the export")
        sums = out.agg(*[F.round(F.sum(F.col(f"`{c}`").cast("double")), 4).alias(c) for c in EXPORTED], F.count(F.lit(1)).cast("double").alias("rows"))
        return sums.unpivot([], [*EXPORTED, "rows"], "name", "total")

    unit = UNIT_SQL.format(key="MINE_ID", seed=11)
    reg.add(
        "a13_export_all_features",
        export_all_features,
        with_clean(
            " UNION ALL ".join(f"SELECT '{n}' AS name, round(CAST(sum({x}) AS DOUBLE), 4) AS total FROM clean WHERE {unit} >= 0.75" for n, x in (EXPORTED | {"rows": "1"}).items())
        ),
    )
    reg.add(
        "a13_export_test_set",
        export_test_set,
        with_clean(
            "SELECT MINE_ID, "
            + ", ".join(
                f"CAST(COMMODITY = '{c}' AS DOUBLE) AS COMMODITY_{c}" for c in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
            )
            + f""", SEAM_HEIGHT, AVG_EMP_TOTAL, NUM_INJURIES, CAST(NUM_INJURIES > 0 AS INTEGER) AS any_event,
            CASE WHEN INJ_RATE_PER2K >= 3 THEN 3 WHEN INJ_RATE_PER2K = 2 THEN 2 WHEN INJ_RATE_PER2K = 1 THEN 1 ELSE 0 END AS event_class
            FROM clean WHERE {unit} >= 0.75"""
        ),
    )


def _to_array(column: str):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)


def feature_totals(fitted, rows):
    """Sum of every feature by name: one pass, one row per feature."""
    totals = rows.select(F.posexplode(_to_array("features")).alias("index", "v")).groupBy("index").agg(
        F.sum("v").alias("total"), F.count_if(F.col("v") != 0).alias("nonzero")
    )
    return rel.attach_names(totals, fitted.names_table(rows.sparkSession)).select("index", "name", r6("total"), "nonzero")


_METRICS = {
    "mse": "avg(e * e)",
    "rmse": "sqrt(avg(e * e))",
    "mae": "avg(abs(e))",
    "ll": "sum(actual * ln(CASE WHEN predicted <= 0 THEN 1e-6::DOUBLE ELSE predicted END)) - sum(greatest(predicted, 0))",
    "rounded_accuracy": "avg(CASE WHEN round_even(actual, 0) = round_even(predicted, 0) THEN 1.0::DOUBLE ELSE 0 END)",
    "zero_count": "CAST(count(*) FILTER (actual = 0) AS DOUBLE)",
    "nonzero_count": "CAST(count(*) FILTER (actual > 0) AS DOUBLE)",
    "zero_avg_pred": "coalesce(avg(predicted) FILTER (actual = 0), 0)",
    "nonzero_avg_pred": "coalesce(avg(predicted) FILTER (actual > 0), 0)",
    "nonzero_avg_actual": "coalesce(avg(actual) FILTER (actual > 0), 0)",
    "nonzero_rmse": "coalesce(sqrt(avg(e * e) FILTER (actual > 0)), 0)",
    "weighted_rmse": "sqrt(sum(weight * e * e) / sum(weight))",
    "weighted_mae": "sum(weight * abs(e)) / sum(weight)",
}
METRIC_SQL = " UNION ALL ".join(
    f"SELECT dataset || '_{n}' AS metric, round({x}, 6) AS value FROM (SELECT *, actual - predicted AS e FROM scored) GROUP BY dataset"
    for n, x in _METRICS.items()
)
