"""Queries for scoring and the model registry (K)."""

from __future__ import annotations

from pyspark.sql import functions as F, Window as W

from ..models import registry as mr
from ..models.glm import FittedGlm
from ..models.scoring import Scorer
from ..operators import evaluate as ev
from ..session import scratch_dir
from ..sources import runlog as rl
from .base import COMMODITIES, Registry, clean, r6, scored, table, with_clean, with_scored
from .modelling import TOTALS_SQL, level_glm
from .tables import METRIC_LOG_SQL, METRIC_SQL, metric_log


def requests(events):
    """Scoring requests from the event log; every 23rd lacks its hours."""
    kinds = F.array(*[F.lit(c) for c in COMMODITIES])
    return events.select(
        F.col("event_id").cast("string").alias("MINE_ID"),
        F.year("ts").alias("YEAR"),
        F.col("user_id").cast("double").alias("AVG_EMPLOYEE_CNT"),
        F.when(F.col("event_id") % 23 != 0, F.col("value") * 1000).alias("HOURS_WORKED"),
        F.get(kinds, (F.col("user_id") % len(COMMODITIES)).cast("int")).alias("COMMODITY"),
    )


def scorer(s, d) -> Scorer:
    """Fitted on the cleaned rows, registered, saved and loaded again by the version's path."""
    fitted = level_glm(s, d)[1]
    store = mr.ModelRegistry(s, scratch_dir(s, "registry"))
    run = store.log_run({"model_type": "glm", "objective": "poisson"}, {"aic": fitted.aic}, fitted.names)
    fitted.save(store.model_path(run))
    version, path = store.resolve(store.register(run, "rate by commodity"))
    return Scorer(FittedGlm.load(path, fitted.spec), version)


OUTCOME_SQL = with_clean(
    f"""SELECT CAST(event_id AS VARCHAR) AS mine_id, CASE WHEN event_id % 23 <> 0 THEN round(value * 1000 / 2000 * y / e, 5) END AS predicted_injury_rate,
  CASE WHEN event_id % 23 = 0 THEN 'missing field: HOURS_WORKED' END AS reasons, '1' AS model_version
  FROM events LEFT JOIN totals ON COMMODITY = list_extract({list(COMMODITIES)}, CAST(user_id % {len(COMMODITIES)} AS INTEGER) + 1)""",
    totals=TOTALS_SQL,
)

# The event log as a registry: a day is a run and a version, its newest events are its metrics.
DAY = "yyyy-MM-dd"


def run_table(s, d):
    e = table(s, d, "events")
    return e.groupBy(F.date_format("ts", DAY).alias("run_id")).agg(
        F.min(F.unix_millis(F.col("ts").cast("timestamp"))).alias("start_ms"),
        F.lit("run").alias("name"),
        F.count_distinct("event_type").cast("int").alias("feature_count"),
    )


def version_rows(s, d):
    e = table(s, d, "events")
    return e.groupBy(F.date_format("ts", DAY).alias("run_id")).agg(
        F.dayofmonth(F.min("ts")).cast("string").alias("version"), F.min(F.unix_millis(F.col("ts").cast("timestamp"))).alias("created_ms")
    )


def pointer(s, d):
    return version_rows(s, d).agg(F.min("version").alias("version"))


RUNS_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS run_id, min(epoch_us(ts) // 1000) AS start_ms, CAST(count(DISTINCT event_type) AS INTEGER) AS feature_count FROM events GROUP BY 1"
VERSION_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS run_id, CAST(day(min(ts)) AS VARCHAR) AS version, min(epoch_us(ts) // 1000) AS created_ms FROM events GROUP BY 1"
LATEST_SQL = f"SELECT run_id, metric, arg_max(value, (step, ts_ms)) AS value FROM ({METRIC_LOG_SQL}) GROUP BY 1, 2"


def register(reg: Registry) -> None:
    reg.add(
        "k1_batch_score",
        lambda s, d: scorer(s, d).outcomes(requests(table(s, d, "events"))).withColumn("predicted_injury_rate", F.round("predicted_injury_rate", 5)),
        OUTCOME_SQL,
    )

    def resolved(s, d):
        asked = table(s, d, "events").select(
            "event_id", F.when(F.col("event_id") % 2 == 0, (F.col("user_id") % 60).cast("string")).alias("asked")
        )
        return mr.resolve_versions(asked, version_rows(s, d), pointer(s, d))

    reg.add(
        "k2_resolve_version",
        resolved,
        f"""SELECT event_id, asked, CASE WHEN v.version IS NOT NULL THEN v.version ELSE (SELECT min(version) FROM ({VERSION_SQL})) END AS version,
        CASE WHEN v.version IS NOT NULL THEN 'explicit' ELSE 'active' END AS source
        FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 60 AS VARCHAR) END AS asked FROM events) r
        LEFT JOIN (SELECT DISTINCT version FROM ({VERSION_SQL})) v ON v.version = r.asked""",
    )

    def logged(s, d):
        """A run and a version per fold of the scored rows; the one with the lowest test error is active."""
        store = mr.ModelRegistry(s, scratch_dir(s, "registry"))
        hours = clean(s, d).groupBy(F.col("COMMODITY").alias("feature")).agg(F.sum("EMP_HRS_TOTAL").alias("h"))
        share = hours.select("feature", (F.col("h") / F.sum("h").over(W.partitionBy())).alias("importance"))
        names = sorted(share.toArrow().column("feature").to_pylist())
        rows = scored(s, d).withColumn("fold", F.floor(F.col("MINE_ID") / 4) % 2).persist()
        errors = {}
        for fold in (0, 1):
            found = ev.metric_table(rows.where(F.col("fold") == fold)).toArrow()
            metrics = dict(zip(found.column("metric").to_pylist(), found.column("value").to_pylist(), strict=True))
            run = store.log_run({"objective": "poisson", "model_type": f"fold {fold}"}, metrics, names, importance=share)
            errors[store.register(run, f"fold {fold}", activate=False)] = metrics["test_rmse"]
        rows.unpersist()
        store.set_active(min(errors, key=errors.get))
        return store

    def fold_metrics(fold: int) -> str:
        return METRIC_SQL.replace("FROM scored", f"FROM scored WHERE (MINE_ID // 4) % 2 = {fold}")

    both = {f"fold{f}": f"SELECT '{f + 1}' AS version, 'fold {f}' AS description, metric, value FROM ({fold_metrics(f)})" for f in (0, 1)}
    both["runs"] = "SELECT * FROM fold0 UNION ALL SELECT * FROM fold1"
    both["listed"] = "SELECT version, description, max(value) FILTER (metric = 'test_rmse') AS test_rmse FROM runs GROUP BY 1, 2"
    both["best"] = "SELECT version, description FROM listed ORDER BY test_rmse, version LIMIT 1"
    both["shares"] = "SELECT COMMODITY AS name, sum(EMP_HRS_TOTAL) / (SELECT sum(EMP_HRS_TOTAL) FROM clean) AS importance FROM clean GROUP BY 1"

    def by_version(s, d):
        store = logged(s, d)
        return store.metrics.read().join(store.versions.read().select("run_id", "version"), "run_id").select("version", "metric", r6("value"))

    reg.add("k3_log_run", by_version, with_scored("SELECT version, metric, value FROM runs", **both))
    reg.add(
        "k4_register_and_activate",
        lambda s, d: logged(s, d).list().select("version", "description", "is_active", r6("test_rmse")),
        with_scored("SELECT version, description, version = (SELECT version FROM best) AS is_active, test_rmse FROM listed", **both),
    )
    reg.add(
        "k5_list_versions",
        lambda s, d: mr.list_versions(version_rows(s, d), rl.latest_metrics(metric_log(s, d)), pointer(s, d), ["click", "purchase", "test_rmse"]),
        f"""SELECT run_id, version, max(value) FILTER (metric = 'click') AS click, max(value) FILTER (metric = 'purchase') AS purchase, CAST(NULL AS DOUBLE) AS test_rmse,
        make_timestamp(any_value(created_ms) * 1000) AS created_at, version = (SELECT min(version) FROM ({VERSION_SQL})) AS is_active
        FROM ({VERSION_SQL}) LEFT JOIN ({LATEST_SQL}) USING (run_id) GROUP BY 1, 2""",
    )
    reg.add(
        "k6_model_info",
        lambda s, d: logged(s, d).info().withColumn("top_features", F.concat_ws(",", "top_features")).drop("last_updated"),
        with_scored(
            """SELECT version, description AS model_type, 'poisson' AS objective, (SELECT count(*) FROM shares) AS feature_count,
            (SELECT string_agg(name, ',' ORDER BY name) FROM shares) AS top_features FROM best""",
            **both,
        ),
    )
    reg.add(
        "k7_feature_list",
        lambda s, d: logged(s, d).features().withColumn("importance", r6("importance")),
        with_scored("SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS index, name, round(importance, 6) AS importance FROM shares", **both),
    )
    numbered = f"""SELECT run_id, CAST(row_number() OVER (ORDER BY start_ms, run_id) + 1 AS VARCHAR) AS version, make_timestamp(start_ms * 1000) AS created_at,
      CASE WHEN row_number() OVER (ORDER BY start_ms DESC, run_id DESC) = 1 THEN 'Production' ELSE 'Archived' END AS status,
      row_number() OVER (ORDER BY start_ms DESC, run_id DESC) = 1 AS is_active, 'run' AS description, feature_count FROM ({RUNS_SQL})"""
    reg.add("k9_export_versions", lambda s, d: mr.export_runs(run_table(s, d)), numbered)
    reg.add(
        "k9_export_metrics",
        lambda s, d: mr.export_metric_rows(
            mr.export_runs(run_table(s, d)), rl.latest_metrics(metric_log(s, d)), F.lit("2024-02-01 00:00:00").cast("timestamp")
        ),
        f"""SELECT version, metric AS metric_name, value AS metric_value, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
        FROM ({numbered}) JOIN ({LATEST_SQL}) USING (run_id)""",
    )
