import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ratewell import workflow as wf
from ratewell.models.registry import ModelRegistry
from ratewell.operators import features as ft
from ratewell.plans.base import mine_year


@pytest.mark.parametrize("two_stage", [False, True])
def test_train_register_and_score(spark, tmp_path, two_stage):
    root = str(tmp_path)
    plan = wf.TrainingPlan(n_estimators=2, max_depth=2, two_stage=two_stage, search_points=0, oversample=False, positive_weight=3.0, optimize_threshold=True, description="small")
    raw = mine_year(spark, SMALL)
    bundle, metrics, version = wf.train(raw, root, plan)
    values = {r["metric"]: r["value"] for r in metrics.collect()}
    assert {"train_rmse", "test_rmse", "test_ll", "test_weighted_mae"} <= set(values)
    assert ("best_threshold" in values) == two_stage and ("test_auc" in values) == two_stage
    assert version == "1" and len(bundle.preprocessor.names) > 40
    info = ModelRegistry(spark, f"{root}/registry").info().first()
    assert info["feature_count"] == len(bundle.preprocessor.names) and len(info["top_features"]) == 10
    params = {r["param"]: r["value"] for r in ModelRegistry(spark, f"{root}/registry").params.read().collect()}
    parts = spark.read.parquet(f"{root}/features")
    assert sum(int(params[f"{p}_samples"]) for p in ("train", "val", "test")) == parts.count()
    assert {"val_rmse", "val_mae"} <= set(values)

    # New rows: no count, some without hours.
    requests = raw.drop("NUM_INJURIES").withColumn("EMP_HRS_TOTAL", F.when(F.col("MINE_ID") % 10 != 0, F.col("EMP_HRS_TOTAL")))
    outcomes = wf.load_scorer(spark, root).outcomes(requests)
    bad = outcomes.where("predicted_injury_rate is null")
    assert outcomes.count() == raw.count() and bad.where("reasons <> 'missing field: EMP_HRS_TOTAL'").count() == 0
    assert bad.count() == raw.where("MINE_ID % 10 = 0").count()
    good = outcomes.where("predicted_injury_rate is not null")
    assert good.agg(F.min("predicted_injury_rate")).first()[0] >= 0 and good.select("predicted_injury_rate").distinct().count() > 1
    # A row gets the same score alone as among others: nothing is fitted again while scoring.
    one = requests.where("MINE_ID = 1")
    alone = wf.load_scorer(spark, root, "1").outcomes(one).first()["predicted_injury_rate"]
    assert alone == outcomes.where("mine_id = '1'").first()["predicted_injury_rate"]
    again, _ = wf.prepare(raw.limit(0), root, plan, reuse=True)
    assert again.count() == parts.count()


def test_stats_can_be_frozen(mines):
    stats = ft.feature_stats(mines)
    a = ft.build_features(mines).select("MINE_ID", "HRS_PER_EMP", "LARGE_OPERATION")
    b = ft.build_features(mines, stats=stats).select("MINE_ID", "HRS_PER_EMP", "LARGE_OPERATION")
    assert a.exceptAll(b).count() == 0


def test_search_within_training(spark, tmp_path, monkeypatch):
    from ratewell.models import search as se

    small = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.2}
    space = {"max_depth": se.Stepped(1, 3, 1)}
    for stage, extra in (("CLASSIFIER", {"scale_pos_weight": 3.0}), ("REGRESSOR", {"variance_power": 1.1})):
        monkeypatch.setattr(se, f"{stage}_START", small | extra)
        monkeypatch.setattr(se, f"{stage}_SPACE", {**space, **{k: se.Uniform(v, v + 0.05) for k, v in extra.items()}, "n_estimators": se.Stepped(2, 3, 1)})
    plan = wf.TrainingPlan(two_stage=True, oversample=False, search_points=2, n_estimators=50, register=False)
    parts, stats = wf.prepare(mine_year(spark, SMALL), str(tmp_path), plan)
    assert {r["dataset"] for r in parts.select("dataset").distinct().collect()} == {"train", "val", "test"}
    model = wf.fit_bundle(parts, stats, plan).model
    assert model.classifier.spec.n_estimators <= 3 and model.regressor.spec.n_estimators <= 3 and model.classifier.spec.scale_pos_weight >= 3.0
