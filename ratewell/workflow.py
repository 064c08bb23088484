"""From raw rows to a registered model, and from a registered model to scores."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import labels as lb
from .models import search as se
from .models.booster import Booster, BoosterSpec, expand_vector, fit_booster, with_params
from .models.registry import ModelRegistry
from .models.scoring import Scorer
from .models.two_stage import TwoStage, fit_two_stage, three_parts
from .operators import clean as cl, encode as en, evaluate as ev, features as ft, splits as sp
from .roles import MINE, Roles
from .session import side_by_side
from .sources import tables as tb


@dataclass(frozen=True)
class TrainingPlan:
    """Settings of one training run."""

    test_size: float = 0.25
    val_size: float = 0.2
    search_points: int = 10
    seed: int = 1234
    n_estimators: int = 100
    max_depth: int = 5
    learning_rate: float = 0.1
    two_stage: bool = False
    oversample: bool = True
    positive_weight: float = 20.0
    target_class0_accuracy: float = 0.907
    optimize_threshold: bool = False
    register: bool = True
    description: str = ""
    fit_statistics_on: str = "all"
    max_bins: int = 64


@dataclass
class ModelBundle:
    """Everything needed to score rows: feature statistics, encoder and model."""

    preprocessor: en.FittedPreprocessor
    model: Booster | TwoStage
    stats: dict[str, float]
    roles: Roles = field(default_factory=lambda: MINE)

    def matrix(self, df: DataFrame) -> DataFrame:
        """Rows with one column per encoded feature; plain names, as feature names may hold any character."""
        rows = self.preprocessor.transform(ft.build_features(df, self.roles, stats=self.stats))
        return expand_vector(rows, feature_columns(len(self.preprocessor.names))).drop("features")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        rows = self.model.predict(self.matrix(df), out)
        return rows.drop(*feature_columns(len(self.preprocessor.names)))

    def importance(self, how: str = "average") -> DataFrame:
        """Feature importance by feature name."""
        names = self.preprocessor.names_table(SparkSession.active()).select(
            F.concat(F.lit("x"), F.col("index")).alias("feature"), "name"
        )
        by_column = self.model.importance(how)
        stage = ["stage"] if "stage" in by_column.columns else []
        return by_column.join(names, "feature").select(*stage, F.col("name").alias("feature"), "importance").orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self.preprocessor.save(f"{path}/preprocessor")
        self.model.save(f"{path}/model")
        kind = "two_stage" if isinstance(self.model, TwoStage) else "single"
        row = [(kind, json.dumps(self.stats))]
        SparkSession.active().createDataFrame(row, "kind string, stats string").write.mode("overwrite").parquet(f"{path}/bundle")

    @classmethod
    def load(cls, path: str, roles: Roles = MINE) -> "ModelBundle":
        row = SparkSession.active().read.parquet(f"{path}/bundle").first()
        model = (TwoStage if row["kind"] == "two_stage" else Booster).load(f"{path}/model")
        return cls(en.FittedPreprocessor.load(f"{path}/preprocessor"), model, json.loads(row["stats"]), roles)

    def scorer(self, version: str = "local") -> Scorer:
        """Scores raw rows; a row without the needed numbers is rejected with its reasons."""
        r = self.roles
        needed = {c: "double" for c in (r.exposure, r.size, r.height, *r.shares)}

        def prepare(df: DataFrame) -> DataFrame:
            df = cl.add_defaults(cl.apply_aliases(df), {r.count: F.lit(0).cast("bigint"), r.status: "ACTIVE"})
            return cl.recode_status(cl.add_rate(df, r), r.status, r.status_group)

        return Scorer(self, version, needed, prepare, r.key)


def feature_columns(n: int) -> list[str]:
    return [f"x{i}" for i in range(n)]


def prepare(raw: DataFrame, root: str, plan: TrainingPlan = TrainingPlan(), roles: Roles = MINE, reuse: bool = False) -> tuple[DataFrame, dict[str, float]]:
    """Cleaned rows with their part, stored below ``root`` and read back, and the fitted statistics.

    With ``reuse`` a stored table of an earlier run is taken as it is.
    """
    spark = raw.sparkSession

    def build() -> DataFrame:
        tb.write_snapshot(cl.basic_cleaning(raw, roles), f"{root}/processed")
        rows = tb.read_snapshot(spark, f"{root}/processed")
        stratum = lb.right_closed_bin(roles.rate)
        parts = sp.stratified_split(rows, roles.key, stratum, 1 - plan.test_size, plan.seed)
        return three_parts(parts, roles.key, share=plan.val_size, seed=plan.seed + 1)

    if not reuse:
        tb.write_snapshot(build(), f"{root}/features", "dataset")
    parts = tb.read_or_build(spark, f"{root}/features", build, "dataset")
    fit_on = F.col("dataset") == "train" if plan.fit_statistics_on == "train" else None
    return parts, ft.feature_stats(parts, roles, fit_on)


def fit_bundle(parts: DataFrame, stats: dict[str, float], plan: TrainingPlan = TrainingPlan(), roles: Roles = MINE) -> ModelBundle:
    """Encoder fitted on the training part, then one model or two stages on the rate.

    The parameters of both stages are first chosen among ``search_points`` points by their
    loss on the validation part; 0 takes those of the plan.
    """
    featured = ft.build_features(parts, roles, stats=stats)
    train = featured.where(F.col("dataset") == "train")
    groups = en.feature_groups(featured, roles)
    own = {roles.key, "dataset"}
    fitted = en.Preprocessor(
        [c for c in groups["categorical"] if c not in own], [c for c in groups["numeric"] if c not in own], groups["labels"]
    ).fit(train)
    bundle = ModelBundle(fitted, None, stats, roles)
    columns = feature_columns(len(fitted.names))
    weight = F.col(roles.exposure) / F.lit(roles.unit)
    raw_train = parts.where(F.col("dataset") == "train")
    matrix = bundle.matrix(raw_train).select(roles.key, *columns, roles.rate, weight.alias("_weight"))
    matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
    spec = BoosterSpec(
        tuple(columns), roles.rate, n_estimators=plan.n_estimators, max_depth=plan.max_depth,
        learning_rate=plan.learning_rate, max_bins=plan.max_bins, seed=plan.seed,
    )
    try:
        if plan.two_stage:
            first, second, weight_of_yes = spec, None, plan.positive_weight
            if plan.search_points:
                first, second, weight_of_yes = _searched(bundle, matrix, parts, spec, plan, columns)
            bundle.model = fit_two_stage(matrix, roles.rate, first, roles.key, weight_of_yes, plan.oversample, second)
        else:
            bundle.model = fit_booster(matrix, replace(spec, objective="poisson", weight="_weight"))
    finally:
        matrix.unpersist()
    return bundle


def _searched(bundle: ModelBundle, train: DataFrame, parts: DataFrame, spec: BoosterSpec, plan: TrainingPlan, columns: list[str]) -> tuple[BoosterSpec, BoosterSpec, float]:
    """Parameters of both stages with the least loss on the validation part."""
    r = bundle.roles
    spec = replace(spec, key=r.key)
    val = bundle.matrix(parts.where(F.col("dataset") == "val")).select(r.key, *columns, r.rate).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        some = [x.where(F.col(r.rate) > 0) for x in (train, val)]
        losses = se.classifier_loss(train, val, r.rate, spec), se.regressor_loss(*some, r.rate, spec)
        spaces = (se.CLASSIFIER_SPACE, se.CLASSIFIER_START), (se.REGRESSOR_SPACE, se.REGRESSOR_START)
        points = [se.candidates(space, plan.search_points, plan.seed, start) for space, start in spaces]
        yes, size = (found.best for found in side_by_side([partial(se.search, loss, p) for loss, p in zip(losses, points)]))
    finally:
        val.unpersist()
    return with_params(spec, **yes), with_params(spec, **size), yes["scale_pos_weight"]


def export_test_set(parts: DataFrame, fitted: en.FittedPreprocessor, path: str, roles: Roles = MINE, part: str = "test") -> DataFrame:
    """Key, all encoded features by name and the labels of one part, stored at ``path`` and read back.

    ``parts`` holds the features' columns and ``dataset``; the labels are the count, whether there is
    any event, and the class of the rate.
    """
    columns = feature_columns(len(fitted.names))
    wide = expand_vector(fitted.transform(parts.where(F.col("dataset") == part)), columns)
    out = wide.select(
        roles.key, *[F.col(c).alias(n) for c, n in zip(columns, fitted.names)],
        F.col(roles.count).alias(f"label_{roles.count}"), lb.any_event(roles.count).alias("label_any_event"), lb.class_from_equal(roles.rate).alias("label_class"),
    )
    tb.write_snapshot(out, path)
    return tb.read_snapshot(parts.sparkSession, path)


def evaluate(bundle: ModelBundle, parts: DataFrame, plan: TrainingPlan = TrainingPlan()) -> DataFrame:
    """(metric, value) over all parts; for two stages also ranks and, if asked for, the best threshold.

    The threshold is chosen on the validation part, which neither the fit nor the test uses.
    """
    r = bundle.roles
    weight = (F.col(r.exposure) / F.lit(r.unit)).alias("weight")
    rows = bundle.matrix(parts)
    if not isinstance(bundle.model, TwoStage):
        scored = bundle.model.predict(rows, "predicted").select(F.col(r.rate).alias("actual"), "predicted", weight, "dataset")
        return ev.metric_table(scored)
    scored = bundle.model.predict_soft(rows, "predicted").select(
        F.col(r.rate).alias("actual"), "predicted", "injury_probability", weight, "dataset"
    )
    out = ev.metric_table(scored, probability="injury_probability")
    if plan.optimize_threshold:
        val = scored.where(F.col("dataset") == "val")
        best = ev.best_threshold(
            ev.threshold_scan(val, "injury_probability", lb.class_from_rate("actual"), target=plan.target_class0_accuracy)
        )
        names = ("threshold", "class0_accuracy", "overall_accuracy")
        pairs = F.array(*[F.struct(F.lit(f"best_{n}").alias("metric"), F.col(n).alias("value")) for n in names])
        out = out.unionByName(best.select(F.explode(pairs).alias("p")).select("p.*"))
    return out


def train(raw: DataFrame, root: str, plan: TrainingPlan = TrainingPlan(), roles: Roles = MINE, reuse: bool = False) -> tuple[ModelBundle, DataFrame, str | None]:
    """Clean, split, encode, fit, evaluate, log and register: (model, metrics, version)."""
    spark = raw.sparkSession
    parts, stats = prepare(raw, root, plan, roles, reuse)
    bundle = fit_bundle(parts, stats, plan, roles)
    registry = ModelRegistry(spark, f"{root}/registry")
    # A few dozen rows.
    metrics = {r["metric"]: r["value"] for r in evaluate(bundle, parts, plan).collect()}
    ends = ("_zero_count", "_nonzero_count")
    names = {m.removesuffix(e) for m in metrics for e in ends if m.endswith(e)}
    sizes = {f"{part}_samples": int(sum(metrics.get(part + e) or 0 for e in ends)) for part in names if part + ends[0] in metrics}
    params = {
        "objective": "two_stage" if plan.two_stage else "count:poisson", "model_type": "boosted", "n_estimators": plan.n_estimators,
        "max_depth": plan.max_depth, "learning_rate": plan.learning_rate, "random_state": plan.seed,
    }
    importance = bundle.importance()
    if "stage" in importance.columns:
        importance = importance.where(F.col("stage") == "regression").drop("stage")
    run = registry.log_run(params, metrics, bundle.preprocessor.names, sizes, importance)
    bundle.save(registry.model_path(run))
    version = None
    if plan.register:
        version = registry.register(run, plan.description)
        registry.export(f"{root}/serving")
    return bundle, registry.metrics.read().where(F.col("run_id") == run).select("metric", "value"), version


def load_scorer(spark: SparkSession, root: str, version: str | None = None, roles: Roles = MINE) -> Scorer:
    """Scorer of a version: the one asked for, else the active, else the newest."""
    found, path = ModelRegistry(spark, f"{root}/registry").resolve(version)
    return ModelBundle.load(path, roles).scorer(found)
