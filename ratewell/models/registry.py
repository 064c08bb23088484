"""Runs, versions and the active pointer as tables.

The plain functions work on any tables of this shape; ``ModelRegistry`` keeps
them as snapshots below one folder.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.features import epoch_ms_to_date_text, epoch_ms_to_timestamp
from ..operators import ranking, relational as rel
from ..sources.versions import SnapshotTable, metric_table, version_table

LISTED_METRICS = ("test_rmse", "test_mae", "test_ll")


def list_versions(versions: DataFrame, metrics: DataFrame, pointer: DataFrame, names: Sequence[str] = LISTED_METRICS) -> DataFrame:
    """Versions with chosen run metrics, creation time and active flag.

    ``versions`` has version, run_id and created_ms; ``metrics`` has run_id,
    metric and value, one row each.
    """
    with_metrics = rel.attach_metrics(versions, metrics, "run_id", names)
    dated = with_metrics.withColumn("created_at", epoch_ms_to_timestamp("created_ms")).drop("created_ms")
    return rel.flag_active(dated, pointer)


def latest_version(versions: DataFrame) -> Column:
    """Newest version as a scalar."""
    newest = F.max_by(F.col("version").cast("string"), F.struct("created_ms", F.col("version").cast("bigint")))
    return versions.agg(newest.alias("v")).scalar()


def resolve_versions(requests: DataFrame, versions: DataFrame, pointer: DataFrame, asked: str = "asked", default: str = "local", out: str = "version") -> DataFrame:
    """Version that serves each request, and where it came from.

    An explicit version counts if it is known, then the active one, then the
    newest, then the default store.
    """
    known = versions.select(F.col("version").cast("string").alias("_known")).distinct()
    # Requests that ask for none are spread over keys that no version has.
    key = F.coalesce(F.col(asked), F.concat(F.lit("\0"), F.pmod(F.xxhash64(*requests.columns), F.lit(256)).cast("string")))
    active = pointer.agg(F.max(F.col("version").cast("string")).alias("v")).scalar()
    joined = requests.join(known, key == known["_known"], "left")
    joined = joined.withColumns({"_active": active, "_latest": latest_version(versions)})
    source = (
        F.when(F.col("_known").isNotNull(), "explicit")
        .when(F.col("_active").isNotNull(), "active")
        .when(F.col("_latest").isNotNull(), "latest")
        .otherwise("default")
    )
    served = F.coalesce("_known", "_active", "_latest", F.lit(default))
    return joined.withColumns({out: served, "source": source}).drop("_known", "_active", "_latest")


def best_run(metrics: DataFrame, metric: str, version: str = "version") -> DataFrame:
    """The version with the lowest value of a metric, and the value; of equal ones the smallest version."""
    runs = metrics.where(F.col("metric") == metric)
    best = F.min_by(F.struct(version, "value"), F.struct("value", F.col(version).cast("bigint"), version))
    return runs.agg(best.alias("b")).where("b is not null").select("b.*")


def mark_latest(versions: DataFrame, created: str = "created_at") -> DataFrame:
    """Versions with status and active flag: the newest is in production, the others are archived."""
    newest = versions.agg(F.max(F.struct(created, "version")).alias("m")).scalar()
    last = F.struct(created, "version") == newest
    return versions.select("version", created, F.when(last, "Production").otherwise("Archived").alias("status"), last.alias("is_active"))


def export_runs(runs: DataFrame, first: int = 2) -> DataFrame:
    """Serving rows when nothing is registered: runs numbered by start, the last one in production.

    ``runs`` has run_id, start_ms, name and feature_count.
    """
    numbered = ranking.row_numbers(runs, "start_ms", "run_id", "_n")
    last = F.col("_n") == numbered.agg(F.max("_n").alias("m")).scalar()
    return numbered.select(
        "run_id",
        (F.col("_n") + first - 1).cast("string").alias("version"),
        epoch_ms_to_timestamp("start_ms").alias("created_at"),
        F.when(last, "Production").otherwise("Archived").alias("status"),
        last.alias("is_active"),
        F.col("name").alias("description"),
        F.coalesce(F.col("feature_count"), F.lit(0)).cast("int").alias("feature_count"),
    )


def export_metric_rows(exported: DataFrame, metrics: DataFrame, updated_at: Column) -> DataFrame:
    """Metrics of the exported versions; values that are no number are left out."""
    rows = exported.select("run_id", "version").join(metrics, "run_id")
    return rows.select(
        "version", F.col("metric").alias("metric_name"), F.col("value").try_cast("double").alias("metric_value"), updated_at.alias("updated_at")
    ).where(F.col("metric_value").isNotNull())


class ModelRegistry:
    """Model runs and versions below ``root``."""

    RUNS = "run_id string, start_ms bigint, name string, feature_count int"
    PARAMS = "run_id string, param string, value string, logged_ms bigint"
    METRICS = "run_id string, metric string, value double, logged_ms bigint"
    NAMES = "run_id string, index int, name string, importance double, logged_ms bigint"
    VERSIONS = "version string, run_id string, created_ms bigint, updated_ms bigint, status string, description string, path string"
    POINTER = "slot string, version string, set_ms bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        table = lambda name, schema, keys, order: SnapshotTable(spark, f"{self.root}/{name}", schema, keys, order)
        self.runs = table("runs", self.RUNS, ["run_id"], "start_ms")
        self.params = table("params", self.PARAMS, ["run_id", "param"], "logged_ms")
        self.metrics = table("metrics", self.METRICS, ["run_id", "metric"], "logged_ms")
        self.names = table("names", self.NAMES, ["run_id", "index"], "logged_ms")
        self.versions = table("versions", self.VERSIONS, ["version"], "updated_ms")
        self.pointer = table("pointer", self.POINTER, ["slot"], "set_ms")

    @staticmethod
    def _now() -> int:
        return int(datetime.datetime.now(datetime.timezone.utc).timestamp() * 1000)

    def model_path(self, run_id: str) -> str:
        return f"{self.root}/models/{run_id}"

    def log_run(self, params: Mapping[str, object], metrics: Mapping[str, object], features: Sequence[str], counts: Mapping[str, int] | None = None, importance: DataFrame | None = None, name: str = "model") -> str:
        """Store one training run.  Metrics that are no plain number are skipped."""
        run, now = uuid.uuid4().hex, self._now()
        make = self.spark.createDataFrame
        self.runs.upsert(make([(run, now, name, len(features))], self.RUNS))
        every = {**params, **(counts or {}), "features_count": len(features)}
        self.params.upsert(make([(run, k, str(v), now) for k, v in every.items()], self.PARAMS))
        numbers = [(run, k, float(v), now) for k, v in metrics.items() if isinstance(v, (int, float)) and not isinstance(v, bool)]
        self.metrics.upsert(make(numbers, self.METRICS))
        names = make([(run, i, f, None, now) for i, f in enumerate(features)], self.NAMES)
        if importance is not None:
            gains = importance.select(F.col("feature").alias("name"), F.col("importance").alias("_g"))
            names = names.drop("importance").join(gains, "name", "left").withColumnRenamed("_g", "importance")
        self.names.upsert(names)
        return run

    def register(self, run_id: str, description: str = "", path: str | None = None, activate: bool = True) -> str:
        """Next version for a logged run; it becomes the active one unless told otherwise."""
        if not rel.exists(self.runs.read(), "run_id", run_id):
            raise ValueError(f"unknown run {run_id}")
        top = self.versions.read().agg(F.max(F.col("version").cast("bigint")).alias("m")).first()["m"] or 0
        version, now = str(top + 1), self._now()
        row = (version, run_id, now, now, "Production", description, path or self.model_path(run_id))
        self.versions.upsert(self.spark.createDataFrame([row], self.VERSIONS))
        if activate:
            self.set_active(version)
        return version

    def set_active(self, version: str) -> None:
        if not rel.exists(self.versions.read(), "version", str(version)):
            raise ValueError(f"unknown model version {version}")
        self.pointer.upsert(self.spark.createDataFrame([("active", str(version), self._now())], self.POINTER))

    def active(self) -> str:
        """Active version, or ``latest`` while none is set."""
        row = self.pointer.read().first()
        return row["version"] if row else "latest"

    def list(self) -> DataFrame:
        return list_versions(self.versions.read(), self.metrics.read(), self.pointer.read())

    def resolve(self, version: str | None = None) -> tuple[str, str]:
        """(version, model path): the one asked for, else the active, else the newest."""
        asked = self.spark.createDataFrame([(version,)], "asked string")
        row = resolve_versions(asked, self.versions.read(), self.pointer.read(), default="").first()
        if version is not None and row["version"] != str(version):
            raise ValueError(f"unknown model version {version}")
        if not row["version"]:
            raise ValueError("no model is registered")
        return row["version"], self.versions.read().where(F.col("version") == row["version"]).first()["path"]

    def features(self, version: str | None = None) -> DataFrame:
        """Ordered feature names of a version with their importance."""
        chosen = self.versions.read().where(F.col("version") == self.resolve(version)[0])
        return self.names.read().join(chosen, "run_id", "left_semi").select("index", "name", "importance").orderBy("index")

    def info(self, version: str | None = None) -> DataFrame:
        """Type, objective, feature count, first ten features and date of last change: one row."""
        chosen = self.versions.read().where(F.col("version") == self.resolve(version)[0])
        params = self.params.read().where(F.col("param").isin("model_type", "objective"))
        params = params.groupBy("run_id").pivot("param", ["model_type", "objective"]).agg(F.max("value"))
        listed = F.array_sort(F.collect_list(F.when(F.col("index") < 10, F.struct("index", F.col("name").alias("n")))))
        names = self.names.read().groupBy("run_id").agg(F.count(F.lit(1)).alias("feature_count"), listed.alias("l"))
        names = names.select("run_id", "feature_count", F.transform("l", lambda x: x["n"]).alias("top_features"))
        return chosen.join(params, "run_id", "left").join(names, "run_id", "left").select(
            "version", "model_type", "objective", "feature_count", "top_features", epoch_ms_to_date_text("updated_ms").alias("last_updated")
        )

    def export(self, serving_root: str) -> tuple[DataFrame, DataFrame]:
        """Bring the serving tables up to date: registered versions, or all runs when there are none."""
        versions = self.versions.read()
        if versions.isEmpty():
            rows = export_runs(self.runs.read())
        else:
            flagged = rel.flag_active(versions, self.pointer.read())
            counts = self.runs.read().select("run_id", "feature_count")
            rows = flagged.join(counts, "run_id", "left").withColumn("created_at", epoch_ms_to_timestamp("created_ms"))
        serving = version_table(self.spark, serving_root).upsert(rows)
        metrics = export_metric_rows(rows, self.metrics.read(), F.current_timestamp())
        return serving, metric_table(self.spark, serving_root).upsert(metrics)
