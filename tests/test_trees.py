import os
import time
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewell.functions.measures import sketched_quantiles
from ratewell.models import booster as bo, poisson_tree as pt, search as se, trees as tr, two_stage as ts


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.integers(0, 12, n).astype(float), "b": rng.normal(size=n).round(1), "rare": (rng.random(n) < 0.002).astype(float)})
    pdf["hours"] = rng.uniform(1, 5, n) * 2000
    rate = 0.2 + 0.5 * (pdf.a > 6) * (pdf.b > 0) + 3.0 * pdf.rare
    pdf["y"] = rng.poisson(rate * pdf.hours / 2000)
    pdf["yes"] = (pdf.y > 0).astype(int)
    return spark.createDataFrame(pdf).repartition(4).persist(), pdf


SPEC = pt.TreeSpec(("a", "b", "rare"), count="y", exposure="hours", max_bins=255, cp=0.0)


def test_single_split_equals_brute_force(rows):
    df, pdf = rows
    e = (pdf.hours / 2000).to_numpy()
    best = (0.0, None, None)
    term = lambda y, x: y * np.log(y / x) if y > 0 else 0.0
    for f in ("a", "b"):
        for t in np.unique(pdf[f])[:-1]:
            m = (pdf[f] <= t).to_numpy()
            if min(m.sum(), (~m).sum()) < 25:
                continue
            y = pdf.y.to_numpy()
            gain = 2 * (term(y[m].sum(), e[m].sum()) + term(y[~m].sum(), e[~m].sum()) - term(y.sum(), e.sum()))
            best = max(best, (gain, f, t))
    from dataclasses import replace

    node = pt.fit_poisson_tree(df, replace(SPEC, max_depth=1)).nodes().where("node = 0").first()
    assert (node["feature"], node["threshold"]) == (best[1], best[2]) and node["gain"] == pytest.approx(best[0])


def test_minbucket_rates_and_partitioning(rows):
    df, pdf = rows
    model = pt.fit_poisson_tree(df, SPEC)
    leaves = model.nodes().where("feature is null").collect()
    assert len(leaves) > 2 and min(r["rows"] for r in leaves) >= 25
    # Leaf rates are events over exposure, so the totals agree.
    assert model.predict(df).agg(F.sum("prediction")).first()[0] == pytest.approx(pdf.y.sum())
    for n in (1, 7):
        assert pt.fit_poisson_tree(df.repartition(n), SPEC).rules() == model.rules()


def test_a_rare_indicator_keeps_its_threshold(rows):
    df, pdf = rows
    edges = tr.fit_edges(df, ["rare", "a"], 16)
    assert edges[0].tolist() == [0.0] and 11.0 not in edges[1]
    from dataclasses import replace

    assert pt.fit_poisson_tree(df, replace(SPEC, minbucket=1, max_depth=1, features=("rare",))).nodes().count() == 3


def test_edges_of_many_features_are_merged_by_blocks(spark):
    names = [f"f{i}" for i in range(2 * tr.EDGE_BLOCK + 3)]
    df = spark.range(0, 3000, 1, 7).select(*[(F.col("id") * (i + 1) % (5 + 40 * i)).cast("double").alias(n) for i, n in enumerate(names)])
    df = df.withColumn("empty", F.lit(None).cast("double")).withColumn("gaps", F.when(F.col("f1") > 9, F.col("f1")))
    features = [*names, "empty", "gaps"]
    plan = tr._edge_marks(df, features, 32)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(block" in plan
    edges = tr.fit_edges(df, features, 32)
    whole = df.agg(*[sketched_quantiles(f, 32, 3200).alias(f) for f in features], *[F.min(f).alias(f"lo {f}") for f in features], *[F.max(f).alias(f"hi {f}") for f in features]).first()
    for name, own in zip(features, edges):
        assert own.tolist() == sorted({*(whole[name] or []), whole[f"lo {name}"]} - {whole[f"hi {name}"], None}), name
    assert tr.fit_edges(df, [], 32) == [] and [len(e) for e in tr.fit_edges(df.limit(0), ["f0", "f1"], 8)] == [0, 0]


def test_pruning_is_nested_and_cp_limits_size(rows):
    df, _ = rows
    model = pt.fit_poisson_tree(df, SPEC)
    sequence = pt.prune_sequence(model.tree)
    sizes, alphas = [len(t.leaves()) for _, t in sequence], [a for a, _ in sequence]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == 1 and alphas == sorted(alphas)
    assert len(model.pruned(0.05).tree.leaves()) <= len(model.pruned(0.001).tree.leaves())


def test_complexity_table(rows):
    df, _ = rows
    from dataclasses import replace

    model, table = pt.fit_with_complexity(df, replace(SPEC, cp=0.002, max_depth=4), "id", folds=5)
    cp, splits, rel, xerr, _ = zip(*table.rows)
    assert splits[0] == 0 and rel[0] == pytest.approx(1.0) and xerr[0] == pytest.approx(1.0, abs=0.05)
    assert list(rel) == sorted(rel, reverse=True) and list(cp) == sorted(cp, reverse=True)
    assert len(model.pruned(table.best_cp()).tree.leaves()) - 1 == splits[cp.index(table.best_cp())]
    # The rule that made the data is found again.
    assert min(xerr) < 0.95


def test_shrinkage_pulls_rates_to_the_mean(rows):
    df, pdf = rows
    from dataclasses import replace

    plain = pt.fit_poisson_tree(df, replace(SPEC, max_depth=1)).nodes().agg(F.max("value")).first()[0]
    pulled = pt.fit_poisson_tree(df, replace(SPEC, max_depth=1, shrink=0.1)).nodes().agg(F.max("value")).first()[0]
    assert pulled < plain


@pytest.mark.parametrize("objective,label", [("poisson", "y"), ("logistic", "yes"), ("tweedie", "y"), ("squared", "y")])
def test_loss_falls_and_predictions_fit(rows, objective, label):
    df, pdf = rows
    spec = bo.BoosterSpec(("a", "b", "rare"), label, objective, n_estimators=5, max_depth=2, learning_rate=0.3, refresh=2)
    model = bo.fit_booster(df, spec)
    loss = [r["loss"] for r in model.staged_loss(df).orderBy("trees").collect()]
    assert len(loss) == 6 and all(a > b for a, b in zip(loss, loss[1:]))
    low = model.predict(df).agg(F.min("prediction")).first()[0]
    assert low >= 0 or objective == "squared"
    again = bo.fit_booster(df.repartition(6), spec)
    assert [t.feature for t in again.trees] == [t.feature for t in model.trees]


def test_one_full_step_of_squared_loss_gives_leaf_means(rows):
    df, pdf = rows
    spec = bo.BoosterSpec(("a",), "y", "squared", n_estimators=1, max_depth=1, learning_rate=1.0, reg_lambda=0.0, max_bins=255)
    got = bo.fit_booster(df, spec).predict(df).groupBy("prediction").agg(F.avg("y").alias("m")).collect()
    assert len(got) == 2 and all(r["prediction"] == pytest.approx(r["m"]) for r in got)


def test_sampling_weights_and_limits(rows):
    df, pdf = rows
    spec = bo.BoosterSpec(("a", "b", "rare"), "yes", "logistic", n_estimators=2, max_depth=3, subsample=0.5, colsample_bytree=0.34, key="id", scale_pos_weight=5.0)
    one, two = bo.fit_booster(df, spec), bo.fit_booster(df.repartition(3), spec)
    assert [t.cut for t in one.trees] == [t.cut for t in two.trees]
    assert 0.4 * len(pdf) < one.trees[0].stats[0][0] < 0.6 * len(pdf)
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in one.trees)
    none = bo.fit_booster(df, bo.BoosterSpec(("a",), "yes", "logistic", n_estimators=1, gamma=1e9))
    assert none.trees[0].leaves() == [0]
    with pytest.raises(ValueError):
        bo.BoosterSpec(("a",), "y", subsample=0.5)


def test_booster_round_trip_and_importance(rows, tmp_path):
    df, _ = rows
    model = bo.fit_booster(df, bo.BoosterSpec(("a", "b", "rare"), "y", n_estimators=2, max_depth=2))
    model.save(str(tmp_path / "m"))
    both = bo.Booster.load(str(tmp_path / "m")).predict(model.predict(df, "p"), "q")
    assert both.where("p != q").count() == 0
    assert model.importance().agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_two_stages(rows, tmp_path):
    df, _ = rows
    parts = ts.three_parts(df.withColumn("dataset", F.when(F.col("id") % 4 == 0, "test").otherwise("train")), "id")
    spec = bo.BoosterSpec(("a", "b"), "", n_estimators=3, max_depth=2, learning_rate=0.5)
    model = ts.fit_two_stage(parts.where("dataset = 'train'"), "y", spec, "id", positive_weight=1.0)
    hard, soft = model.predict_hard(parts, "h", 0.4), model.predict_soft(parts, "s")
    assert hard.where("injury_probability < 0.4 and h != 0").count() == 0
    assert soft.where(F.abs(F.col("s") - F.col("injury_probability") * F.col("injury_rate_if_positive")) > 1e-12).count() == 0
    metrics = {r["metric"] for r in ts.evaluate_two_stage(model, parts, "y").collect()}
    assert {"train_rmse", "val_rmse", "test_mae", "test_class_0_accuracy"} <= metrics
    frame = ts.scored_frame(model, parts, "y", "hours")
    assert {"injury_probability", "weight", "residual"} <= set(frame.columns) and frame.count() == df.count()
    model.save(str(tmp_path / "two"))
    assert ts.TwoStage.load(str(tmp_path / "two")).predict(df).count() == df.count()


def test_search_starts_at_the_given_point_and_takes_the_best():
    points = se.candidates(se.REGRESSOR_SPACE, 10, start=se.REGRESSOR_START)
    assert points[0] == se.REGRESSOR_START and len(points) == 10 and points == se.candidates(se.REGRESSOR_SPACE, 10, start=se.REGRESSOR_START)
    for p in points[1:]:
        assert np.exp(-5) <= p["learning_rate"] <= np.exp(-1) and p["n_estimators"] % 10 == 0 and 1.0 <= p["variance_power"] <= 1.2
    assert se.search(lambda p: (p["max_depth"] - 5) ** 2, points).best["max_depth"] == 5


def test_sweep_marks_the_best(rows):
    df, _ = rows
    parts = df.withColumn("dataset", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    configs = (("booster", {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.5}), ("forest", {"n_estimators": 3, "max_depth": 3}))
    out = se.sweep(parts, ["a", "b", "rare"], "y", configs=configs).collect()
    best = [r for r in out if r["best"]]
    assert len(best) == 1 and best[0]["test_rmse"] == min(r["test_rmse"] for r in out)


def test_sweep_registers_and_activates_the_best(spark, rows, tmp_path):
    from ratewell.models.registry import ModelRegistry

    df, _ = rows
    parts = df.withColumn("dataset", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    registry = ModelRegistry(spark, str(tmp_path / "reg"))
    configs = (("booster", {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.01}), ("gbt", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.5}))
    weak, strong = (se.label_of(*c) for c in configs)
    out = {r["model"]: r for r in se.sweep(parts, ["a", "b", "rare"], "y", registry, configs).collect()}
    assert out[strong]["best"] and registry.active() == out[strong]["version"] == "2"
    listed = {r["version"]: r for r in registry.list().collect()}
    assert listed["1"]["test_rmse"] == pytest.approx(out[weak]["test_rmse"]) and listed["1"]["description"] == f"Model version for {weak}"
    assert bo.Booster.load(registry.resolve("1")[1]).predict(df).count() == df.count()


def test_search_losses(rows):
    df, _ = rows
    train, val = df.where("id % 5 <> 0"), df.where("id % 5 = 0")
    spec = bo.BoosterSpec(("a", "b", "rare"), "y", key="id")
    point = {"n_estimators": 3.0, "max_depth": 2.0, "min_child_weight": 1.9, "learning_rate": 0.5}
    f1 = 1 - se.classifier_loss(train, val, "y", spec)({**point, "scale_pos_weight": 2.0})
    assert 0.3 < f1 <= 1
    good = se.regressor_loss(train, val, "y", spec)({**point, "variance_power": 1.1})
    none = se.regressor_loss(train, val, "y", spec)({**point, "variance_power": 1.0, "learning_rate": 1e-6})
    assert 0 < good < none


def test_weighted_variance_tree(rows):
    df, _ = rows
    model = se.weighted_tree(["a", "b"], "y", "hours").fit(df)
    assert model.predict(df).select("prediction").distinct().count() <= 8 and "If" in model.rules()


@pytest.mark.parametrize("bins", [64, tr.MAX_BINS])
def test_largest_values_keep_their_bin(spark, bins):
    """A continuous column whose top values alone have the target: the first split is at the top for any number of bins."""
    rows = spark.range(20_000).selectExpr("id", "double(id) as x", "double(id >= 19000) as y")
    spec = bo.BoosterSpec(("x",), "y", "squared", n_estimators=1, max_depth=1, learning_rate=1.0, reg_lambda=0.0, max_bins=bins)
    model = bo.fit_booster(rows, spec)
    assert abs(model.nodes().where("node = 0").first()["threshold"] - 19_000) < 20_000 / bins
    ends = {r["id"]: r["p"] for r in model.predict(rows, "p").where("id in (0, 19999)").collect()}
    assert ends[0] < 0.05 and ends[19_999] > 0.7


def test_more_edges_than_a_byte_can_number_are_refused(spark):
    with pytest.raises(ValueError, match="edges"):
        tr.bin_rows(spark.range(3).selectExpr("double(id) as x"), ["x"], [tr.np.arange(256.0)], ["x"])
    with pytest.raises(ValueError, match="max_bins"):
        tr.fit_edges(spark.range(3).selectExpr("double(id) as x"), ["x"], 256)


def shapes(models):
    return [(t.feature, t.cut, [round(v, 9) for v in t.value]) for m in models for t in m.trees]


def test_models_fitted_together_equal_single_fits_wherever_nodes_are_grown(rows, monkeypatch):
    """Ten points of a search at once, one by one, with all nodes split on the cluster, and with small subtrees in tasks."""
    df, _ = rows
    base = bo.BoosterSpec(("a", "b", "rare"), "yes", "logistic", key="id", refresh=3)
    points = [{**p, "n_estimators": 2 + i, "max_depth": 1 + i % 4} for i, p in enumerate(se.candidates(se.CLASSIFIER_SPACE, 5))]
    specs = [bo.with_params(base, **p) for p in points]
    together = bo.fit_boosters(df, specs)
    assert shapes(together) == shapes([bo.fit_booster(df, s) for s in specs]) and [len(m.trees) for m in together] == [2, 3, 4, 5, 6]
    assert any(len(t.feature) > 3 for m in together for t in m.trees)
    for small, cells in ((0, 4), (0, 4096), (40_000, 4096)):
        monkeypatch.setattr(tr, "SMALL_BYTES", small)
        monkeypatch.setattr(tr, "BLOCK_CELLS", cells)
        assert shapes(bo.fit_boosters(df.repartition(5), specs)) == shapes(together)
    with pytest.raises(ValueError, match="same"):
        bo.fit_boosters(df, [base, bo.BoosterSpec(("a",), "yes", "logistic", key="id")])


def test_poisson_tree_is_the_same_wherever_nodes_are_grown(rows, monkeypatch):
    df, _ = rows
    whole = pt.fit_poisson_tree(df, SPEC)
    for small in (0, 60_000):
        monkeypatch.setattr(tr, "SMALL_BYTES", small)
        part = pt.fit_poisson_tree(df, SPEC)
        assert sorted(part.rules()) == sorted(whole.rules()) and part.tree.leaves()


def test_sums_of_many_nodes_at_once_equal_those_of_each():
    rng = np.random.default_rng(5)
    edges = [1] * 19 + [0, 4, 30]
    bins = np.column_stack([rng.integers(0, n + 1, 700) for n in edges]).astype("uint8")
    stats = np.column_stack([np.ones(700), rng.normal(size=700), rng.random(700)])
    slot = rng.integers(0, 6, 700)
    for layout in (tr.Layout(edges), tr.Layout(edges, [2, 5]), tr.Layout(edges, [20, 21])):
        together = layout.node_sums(bins, stats, slot, 7)
        for s in range(7):
            assert together[s] == pytest.approx(layout.sums(bins[slot == s], stats[slot == s]), abs=1e-9)


def test_training_rows_travel_in_blocks(spark):
    """One row a block, with the bins that rows had one by one; values without number are above all edges."""
    df = spark.range(0, 5000, 1, 2).selectExpr("id", "double(id % 2) as a", "if(id % 7 = 0, null, double(id % 50)) as b", "if(id % 9 = 0, null, double(id)) as y", "id * 3 as u")
    edges = [np.array([0.0]), np.arange(5.0, 45.0, 5.0)]
    blocks = tr.bin_blocks(df, ["a", "b"], edges, ["y", "u"])
    assert blocks.count() == 2
    got = [(c, b) for batch in blocks.toArrow().to_batches() for c, b in tr.read_blocks(batch, 2, ["u"])]
    u, y, bins = (np.concatenate(x) for x in zip(*[(c["u"], c["y"], b) for c, b in got]))
    rows = tr.bin_rows(df, ["a", "b"], edges, ["u"]).toPandas()
    assert dict(zip(u.tolist(), map(bytes, bins))) == dict(zip(rows["u"].tolist(), map(bytes, rows["bins"])))
    assert np.isnan(y).sum() == 556
    assert tr.block_sums(spark.range(1).where("false").selectExpr("cast(null as binary) as y", "cast(null as binary) as bins"), 2, lambda c: {"y": c["y"]}) == {"n": 0, "y": 0.0}
    assert tr.block_sums(blocks.drop("u"), 2, lambda c: {"s": c["y"]}) == {"n": 5000, "s": sum(i for i in range(5000) if i % 9)}


def test_large_fits_stay_in_memory_and_give_the_same_trees(rows, monkeypatch):
    """All rounds are one job without score tables; the level jobs and models in tasks of their own give the same trees."""
    df, _ = rows
    base = bo.BoosterSpec(("a", "b", "rare"), "yes", "logistic", key="id", refresh=3)
    specs = [bo.with_params(base, **{**p, "n_estimators": 3 + i, "max_depth": 2 + i}) for i, p in enumerate(se.candidates(se.CLASSIFIER_SPACE, 3))]
    together = bo.fit_boosters(df, specs)
    monkeypatch.setattr(tr, "SMALL_BYTES", 0)
    monkeypatch.setattr(tr, "LEAST_BYTES", 1 << 10)
    monkeypatch.setattr(tr, "GATHERED_BYTES", 1 << 10)
    with monkeypatch.context() as m:
        m.setattr(bo, "_round", None)
        m.setattr(bo, "scratch_dir", None)
        assert shapes(bo.fit_boosters(df, specs)) == shapes(together)
        m.setattr(tr, "MODEL_BYTES", 0)
        for parts in (1, 7):
            held = bo.fit_boosters(df.repartition(parts), specs)
            assert shapes(held) == shapes(together) and [len(x.trees) for x in held] == [3, 4, 5]
            for one, other in zip(held, together):
                assert [t.value for t in one.trees] == [pytest.approx(t.value) for t in other.trees]
    monkeypatch.setattr(tr, "HELD_NODES", 0)
    monkeypatch.setattr(tr, "MODEL_BYTES", 0)
    assert shapes(bo.fit_boosters(df, specs)) == shapes(together)


def test_indicators_are_not_sketched(spark, monkeypatch):
    names = [f"f{i}" for i in range(2 * tr.EDGE_BLOCK + 2)]
    df = spark.range(0, 3000, 1, 5).select(*[(F.col("id") % (i + 7) == 0).cast("double").alias(n) for i, n in enumerate(names)], "id")
    df = df.withColumns(
        {
            "third": F.when(F.col("id") == 2900, 0.5).otherwise(F.col("f1")),
            # Each task sees one value, all of them three.
            "parts": F.floor(F.col("id") / 1200).cast("double"),
            "odd": F.when(F.col("f1") > 0, F.lit(float("nan"))).otherwise(1.0),
            "one": F.lit(4.0), "gaps": F.when(F.col("f2") > 0, F.col("f3")), "empty": F.lit(None).cast("double"),
        }
    )
    features = [*names, "third", "parts", "odd", "one", "gaps", "empty"]
    asked, sketch = [], tr._edge_marks
    monkeypatch.setattr(tr, "_edge_marks", lambda d, own, b: (asked.append(list(own)), sketch(d, own, b))[1])
    edges = dict(zip(features, tr.fit_edges(df, features, 32)))
    assert asked == [["third", "parts", "odd"]]
    assert all(edges[n].tolist() == [0.0] for n in (*names, "gaps"))
    assert edges["third"].tolist()[0] == 0.0 and edges["parts"].tolist() == [0.0, 1.0]
    assert edges["one"].tolist() == [] and edges["empty"].tolist() == []


def test_a_node_is_summed_by_columns_or_by_rows_alike(monkeypatch):
    rng = np.random.default_rng(8)
    bins = np.column_stack([rng.integers(0, n + 1, 3000) for n in (1, 7, 1, 0, 12, 1)]).astype("uint8")
    y = rng.integers(0, 5, 3000) + 2.0 * bins[:, 1] + bins[:, 2]
    stats, layout = np.column_stack([np.ones(3000), -y, np.ones(3000)]), tr.Layout([1, 7, 1, 0, 12, 1])
    gain = bo._gain(bo.BoosterSpec(("a",), "y"))
    trees = []
    for least in (1, 10_000):
        monkeypatch.setattr(tr, "COLUMN_ROWS", least)
        trees.append(tr.grow_small(layout, bins, stats, gain, None, 4, 2))
    assert trees[0].feature == trees[1].feature and trees[0].cut == trees[1].cut and len(trees[0].feature) > 15
    np.testing.assert_allclose(trees[0].stats, trees[1].stats)


def test_tasks_side_by_side_exchange_sums_through_the_shared_folder(rows, monkeypatch):
    """An exchange through Spark takes a second; deep trees stay in these tasks too, and their small nodes end in one of them."""
    from ratewell.session import shared_root

    df, _ = rows
    base = bo.BoosterSpec(("a", "b", "rare"), "yes", "logistic", key="id", max_bins=32, min_child_weight=0.5)
    specs = [replace(base, n_estimators=30, max_depth=3), replace(base, n_estimators=2, max_depth=10, subsample=0.7, colsample_bytree=0.7)]
    together = bo.fit_boosters(df, specs)
    monkeypatch.setattr(tr, "LEAST_BYTES", 1 << 10)
    monkeypatch.setattr(tr, "MODEL_BYTES", 0)
    monkeypatch.setattr(bo, "_round", None)
    real, asked = tr.small_rows, []
    monkeypatch.setattr(tr, "small_rows", lambda p, k: (asked.append(k), 0 if len(asked) == 1 else real(p, k))[1])
    start = time.time()
    held = bo.fit_boosters(df.repartition(6), specs)
    assert time.time() - start < 60 and asked == [4, 4]
    assert shapes(held) == shapes(together)
    assert not [x for x in os.listdir(shared_root(df.sparkSession)) if x.startswith("sums-")]
    # Without a folder that all tasks reach they exchange through Spark.
    fewer = [replace(s, n_estimators=1, max_depth=min(s.max_depth, 4)) for s in specs]
    for folder in (None, "/nowhere"):
        del asked[:]
        monkeypatch.setattr(bo, "meeting_folder", lambda spark: folder)
        monkeypatch.setattr(bo, "drop_dir", lambda spark, path: None)
        assert [t.cut for m in bo.fit_boosters(df, fewer) for t in m.trees][0] == together[0].trees[0].cut


def test_features_numbered_together_have_the_sums_of_each():
    rng = np.random.default_rng(3)
    edges = [1] * 15 + [0, 4, 30, 63, 63, 2]
    bins = np.column_stack([rng.integers(0, n + 1, 5000) for n in edges]).astype("uint8")
    bins[:, 19] = bins[:, 18]
    slopes = [rng.normal(size=5000), rng.random(5000)]
    layouts = [tr.Layout(edges, own) for own in ([0, 2, 5, 17, 19], [i for i in range(21) if i not in (0, 2, 5, 17, 19)], [])]
    same = [*range(19), 18, 20]
    held = tr.HeldRows(np.ascontiguousarray(bins.T), edges, same, layouts)
    assert 19 not in [f for pack in held.packs for f in pack] and len(held.packs) < 7
    for rows in (np.arange(5000), np.arange(0, 5000, 3), np.zeros(0, dtype="int64")):
        out = [np.zeros((x.cells + 1, 3)) for x in layouts]
        held.add_sums(out, rows, slopes)
        for layout, own in zip(layouts, out):
            expected = layout.sums(bins[rows], np.column_stack([np.ones(len(rows)), *[s[rows] for s in slopes]]))
            np.testing.assert_allclose(own, expected, atol=1e-9)
    # Columns that are the same tie to the last digit.
    assert layouts[0].wide.tolist() == [17, 19] and layouts[1].wide.tolist() == [16, 18, 20]
    first, second = ([out[j][len(x.single) + i * x.n_bins :][:64] for j, i, x in ((0, 1, layouts[0]), (1, 1, layouts[1]))])
    assert (first == second).all()
