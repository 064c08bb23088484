"""Registered model queries do the whole job: what they ask of the library, without the long fits."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from ratewell.models import booster as bo, glm, poisson_tree as pt, search as se, two_stage as ts

QUERIES = entry.queries()


class Asked(Exception):
    """Ends a query where its fit would begin."""


def asked(monkeypatch, module, name, spark, query):
    """Arguments of the first call of a function in a query."""

    def stop(*args, **settings):
        raise Asked(args, settings)

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Asked) as found:
        QUERIES[query](spark, SMALL)
    return found.value.args


BOOSTERS = {"j12_poisson_booster": "poisson", "j13_logistic_booster": "logistic", "j14_tweedie_booster": "tweedie", "j15_squared_booster": "squared", "a6_model_round_trip": "poisson"}


@pytest.mark.parametrize("query", sorted(BOOSTERS))
def test_boosters_are_full_size(spark, monkeypatch, query):
    (train, spec), _ = asked(monkeypatch, bo, "fit_booster", spark, query)
    assert (spec.objective, spec.n_estimators, spec.max_depth, spec.max_bins) == (BOOSTERS[query], 100, 5, 64)
    assert len(spec.features) > 40 and set(spec.features) <= set(train.columns)
    assert "EMP_HRS_TOTAL" not in spec.features and "NUM_INJURIES" not in spec.features


def test_sweep_fits_registers_and_activates_all(spark, monkeypatch):
    fitted = []

    def cheap(configs, df, features, label, seed=42):
        fitted.extend(configs)
        return bo.fit_boosters(df, [bo.BoosterSpec(tuple(features), label, "squared", n_estimators=i + 1, max_depth=1) for i in range(len(configs))])

    monkeypatch.setattr(se, "fit_kinds", cheap)
    rows = QUERIES["j15_j16_sweep"](spark, SMALL).orderBy("place").collect()
    assert fitted == list(se.SWEEP) and [r["model"] for r in rows] == [se.label_of(*c) for c in se.SWEEP]
    assert [r["version"] for r in rows] == ["1", "2", "3", "4", "5", "6"]
    assert sum(r["best"] for r in rows) == 1 and [r["active"] for r in rows] == [r["best"] for r in rows]


@pytest.mark.parametrize("query,stage", [("j17_random_search", "REGRESSOR"), ("j17_classifier_search", "CLASSIFIER")])
def test_searches_try_ten_points_of_the_whole_space(spark, monkeypatch, query, stage):
    (_, points), _ = asked(monkeypatch, se, "search", spark, query)
    assert len(points) == 10 and points[0] == getattr(se, f"{stage}_START")
    assert all(set(p) == set(getattr(se, f"{stage}_SPACE")) and p["n_estimators"] >= 100 for p in points)


def test_two_stages_are_full_size_weighted_and_oversampled(spark, monkeypatch):
    fits, fit = [], bo.fit_booster

    def cheap(df, spec, edges=None):
        fits.append((df, spec))
        return fit(df, replace(spec, n_estimators=1, max_depth=1), edges)

    monkeypatch.setattr(ts, "fit_booster", cheap)
    table = QUERIES["j21_stage_importance"](spark, SMALL)
    (yes, first), (size, second) = sorted(fits, key=lambda x: x[1].objective)
    assert (first.objective, second.objective) == ("logistic", "tweedie") and len(first.features) > 40
    assert all((spec.n_estimators, spec.max_depth) == (100, 5) for spec in (first, second))
    assert yes.where(F.col("_yes") == 1).select("_pw").distinct().first()[0] == 20
    assert size.where("synthetic").count() > 0 and {r[0] for r in size.select("_sw").distinct().collect()} <= {1.0, 5.0, 10.0}
    assert {r["stage"] for r in table.collect()} == {"classification", "regression"} and table.where("feature = 'SEAM_HEIGHT'").count() == 2


@pytest.mark.parametrize("query", ["j20_scored_frame", "j22_evaluate_parts"])
def test_two_stage_queries_use_the_defaults(spark, monkeypatch, query):
    (_, _, spec, _), settings = asked(monkeypatch, ts, "fit_two_stage", spark, query)
    assert settings == {} and spec == bo.BoosterSpec(spec.features, "") and len(spec.features) > 40


@pytest.mark.parametrize("query,name", [("j7_poisson_tree", "fit_poisson_tree"), ("j8_complexity_table", "fit_with_complexity"), ("j10_tree_rules", "fit_poisson_tree")])
def test_poisson_trees_are_cut_by_cp_alone(spark, monkeypatch, query, name):
    (_, spec, *_), _ = asked(monkeypatch, pt, name, spark, query)
    assert (spec.max_depth, spec.max_bins, spec.cp) == (10, 64, 0.0005)


def test_stepwise_starts_from_the_full_model(spark, monkeypatch):
    (rows, spec), _ = asked(monkeypatch, glm, "step_aic", spark, "j4_step_aic")
    assert spec.terms == glm.full_model_terms() and {c for t in spec.terms for c in t.columns} <= set(rows.columns)
