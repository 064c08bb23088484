import datetime
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from ratewell.models.registry import ModelRegistry, export_metric_rows, export_runs, list_versions, resolve_versions
from ratewell.models.scoring import ColumnModel, Scorer
from ratewell.sources import requests as rq, runlog as rl, tables as tb, versions as vs


def test_csv_with_schema_and_na(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('MINE_ID,US_STATE,NUM\n1,"Pa, USA",2\n2,NA,NA\n')
    df = tb.read_csv(spark, str(path), "MINE_ID bigint, US_STATE string, NUM bigint")
    assert [tuple(r) for r in df.collect()] == [(1, "Pa, USA", 2), (2, None, None)]
    assert dict(tb.read_csv(spark, str(path)).dtypes)["NUM"] == "int"


def test_csv_round_trip_and_missing_snapshot(spark, mines, tmp_path):
    tb.write_csv(mines.select("MINE_ID", "US_STATE"), str(tmp_path / "csv"))
    assert tb.read_csv(spark, str(tmp_path / "csv"), "MINE_ID bigint, US_STATE string").count() == mines.count()
    with pytest.raises(FileNotFoundError, match="run the cleaning step"):
        tb.read_snapshot(spark, str(tmp_path / "none"))


def test_part_filter_prunes_folders(spark, mines, tmp_path):
    path = str(tmp_path / "parts")
    tb.write_snapshot(mines.withColumn("dataset", F.when(F.col("MINE_ID") % 4 == 0, "test").otherwise("train")), path, "dataset")
    test = tb.read_snapshot(spark, path).where("dataset = 'test'")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    built = tb.read_or_build(spark, path, lambda: pytest.fail("must not be built again"))
    assert built.count() == mines.count()


def test_run_log_scan(spark, tmp_path):
    for run, metric, text in (("r1", "test_ll", "1749182494009 -6389.4 0\n1749182494010 -6000.5 1\n"), ("r2", "test ll", "5 oops 0\n")):
        folder = tmp_path / "exp" / run / "metrics"
        folder.mkdir(parents=True)
        (folder / metric).write_text(text)
    (tmp_path / "exp" / "r1" / "params").mkdir()
    (tmp_path / "exp" / "r1" / "params" / "tree_method").write_text("hist")
    log = rl.scan_metrics(spark, str(tmp_path / "exp"))
    rows = {(r["run_id"], r["metric"], r["step"]): r["value"] for r in log.collect()}
    assert rows == {("r1", "test_ll", 0): -6389.4, ("r1", "test_ll", 1): -6000.5, ("r2", "test ll", 0): None}
    assert {r["metric"]: r["value"] for r in rl.latest_metrics(log).where("run_id = 'r1'").collect()} == {"test_ll": -6000.5}
    assert [tuple(r) for r in rl.scan_params(spark, str(tmp_path / "exp")).collect()] == [("r1", "tree_method", "hist")]


def test_upsert_replaces_by_key_and_survives_a_torn_write(spark, tmp_path):
    store = vs.metric_table(spark, str(tmp_path))
    assert store.read().count() == 0
    t = datetime.datetime(2024, 1, 1)
    make = lambda *rows: spark.createDataFrame([(v, m, x, t) for v, m, x in rows], vs.METRICS_SCHEMA)
    store.upsert(make(("1", "rmse", 0.5), ("1", "mae", 0.3)))
    # A writer that died left a folder without its commit marker.
    torn = pathlib.Path(store.path) / "snapshot-00000002"
    torn.mkdir()
    (torn / "part-0.parquet").write_text("half")
    out = store.upsert(make(("1", "rmse", 0.4), ("2", "rmse", 0.9)))
    assert {(r["version"], r["metric_name"]): r["metric_value"] for r in out.collect()} == {("1", "rmse"): 0.4, ("1", "mae"): 0.3, ("2", "rmse"): 0.9}


def test_registry_life(spark, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    assert reg.active() == "latest"
    with pytest.raises(ValueError, match="no model"):
        reg.resolve()
    run = reg.log_run({"objective": "count:poisson", "model_type": "boosted"}, {"test_rmse": 0.08, "note": "text", "flag": True}, ["a", "b"], {"train_samples": 7})
    assert {r["metric"] for r in reg.metrics.read().collect()} == {"test_rmse"}
    assert reg.params.read().where("param = 'features_count'").first()["value"] == "2"
    one = reg.register(run, "first")
    two = reg.register(reg.log_run({}, {"test_rmse": 0.07}, ["a"]), "second", activate=False)
    assert (one, two, reg.active()) == ("1", "2", "1")
    listed = {r["version"]: (r["is_active"], r["test_rmse"], r["test_mae"]) for r in reg.list().collect()}
    assert listed == {"1": (True, 0.08, None), "2": (False, 0.07, None)}
    reg.set_active("2")
    assert reg.resolve()[0] == "2" and reg.resolve("1")[0] == "1"
    for call in (lambda: reg.set_active("9"), lambda: reg.resolve("9"), lambda: reg.register("nope")):
        with pytest.raises(ValueError, match="unknown"):
            call()
    info = reg.info("1").first()
    assert (info["objective"], info["feature_count"], info["top_features"]) == ("count:poisson", 2, ["a", "b"])
    assert [r["name"] for r in reg.features("1").collect()] == ["a", "b"]
    versions, metrics = reg.export(str(tmp_path / "serving"))
    assert versions.where("is_active").first()["version"] == "2" and metrics.count() == 2
    reg.set_active("1")
    versions, _ = reg.export(str(tmp_path / "serving"))
    assert versions.count() == 2 and versions.where("is_active").first()["version"] == "1"


def test_listing_golden(spark):
    versions = spark.createDataFrame([("1", "run1", 1622505600000), ("2", "run2", 1622592000000)], "version string, run_id string, created_ms bigint")
    metrics = spark.createDataFrame([("run1", "test_rmse", 0.1), ("run2", "test_rmse", 0.2), ("run2", "other", 1.0)], "run_id string, metric string, value double")
    rows = list_versions(versions, metrics, spark.createDataFrame([("1",)], "version string")).orderBy("version").collect()
    assert [(r["is_active"], r["test_rmse"], r["test_ll"]) for r in rows] == [(True, 0.1, None), (False, 0.2, None)]
    assert rows[0]["created_at"] == datetime.datetime(2021, 6, 1)


def test_resolution_order(spark):
    versions = spark.createDataFrame([("1", 10), ("2", 20)], "version string, created_ms bigint")
    asked = spark.createDataFrame([("1",), ("7",), (None,)], "asked string")
    pick = lambda v, p: [(r["version"], r["source"]) for r in resolve_versions(asked, v, p).orderBy(F.asc_nulls_last("asked")).collect()]
    none = spark.createDataFrame([], "version string")
    assert pick(versions, none) == [("1", "explicit"), ("2", "latest"), ("2", "latest")]
    assert pick(versions.where("false"), none) == [("local", "default")] * 3


def test_export_without_versions_numbers_runs_from_two(spark):
    runs = spark.createDataFrame([("b", 30, "x", 5), ("a", 30, "y", None), ("c", 10, "z", 1)], "run_id string, start_ms bigint, name string, feature_count int")
    out = {r["run_id"]: r for r in export_runs(runs).collect()}
    assert {k: r["version"] for k, r in out.items()} == {"c": "2", "a": "3", "b": "4"}
    assert [k for k, r in out.items() if r["is_active"]] == ["b"] and out["a"]["feature_count"] == 0
    metrics = spark.createDataFrame([("a", "rmse", "0.5"), ("a", "note", "text")], "run_id string, metric string, value string")
    assert export_metric_rows(export_runs(runs), metrics, F.current_timestamp()).count() == 1


def test_batch_requests_keep_broken_ones(spark):
    good = json.dumps({"mines": [{"MINE_ID": "m1", "YEAR": 2015, "HOURS_WORKED": 10.5}, {"MINE_ID": "m2"}]})
    df = spark.createDataFrame([(1, good), (2, "{nope"), (3, '{"mines": []}')], "b bigint, body string")
    rows = rq.parse_batches(df, "body", "b").orderBy("b", "entry_no").collect()
    assert [(r["b"], r["entry_no"], r["MINE_ID"], r["HOURS_WORKED"]) for r in rows] == [(1, 0, "m1", 10.5), (1, 1, "m2", None), (2, None, None, None), (3, None, None, None)]


def test_large_batches_are_answered_in_pages(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(2).alias("b"), F.col("id").cast("string").alias("m"), (F.col("id") * 1.0).alias("p"))
    rows = rq.batch_responses(df, "b", "m", "p", F.lit("3"), page_rows=100).collect()
    items = [x for r in rows for x in json.loads(r["predictions"])]
    assert len({r["page"] for r in rows if r["b"] == 1}) == 9 and len(items) == 1000 == len({x["mine_id"] for x in items})
    assert {round(r["average_predicted_rate"], 6) for r in rows if r["b"] == 1} == {449.5}


def test_scorer_never_scores_a_bad_row(spark):
    df = spark.createDataFrame([("a", "2015", "3", "4000"), ("b", "x", "3", "4000")], "MINE_ID string, YEAR string, AVG_EMPLOYEE_CNT string, HOURS_WORKED string")
    rows = {r["mine_id"]: r for r in Scorer(ColumnModel(F.col("EMP_HRS_TOTAL") / 2000)).outcomes(df).collect()}
    assert rows["a"]["predicted_injury_rate"] == 2.0 and rows["a"]["reasons"] is None
    assert rows["b"]["predicted_injury_rate"] is None and rows["b"]["reasons"] == "not a int: YEAR"
