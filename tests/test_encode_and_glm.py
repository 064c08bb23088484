import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ratewell.models import glm
from ratewell.operators import encode as en
from ratewell.roles import SHARE_COLUMNS


@pytest.fixture
def toy(spark):
    rows = [("b", 1.0, 5.0, "x, y"), ("a", 2.0, 5.0, "x"), ("c'q", 6.0, 5.0, "x, z")]
    return spark.createDataFrame(rows, "k string, v double, same double, l string")


def test_preprocessor_round_trip(spark, toy, tmp_path):
    fitted = en.Preprocessor(["k"], ["v", "same"], ["l"]).fit(toy)
    # The label all rows carry vanishes, and so does the first level.
    assert fitted.names == ["k_b", "k_c'q", "v", "same", "l_y", "l_z"]
    fitted.save(str(tmp_path / "p"))
    loaded = en.FittedPreprocessor.load(str(tmp_path / "p"))
    new = spark.createDataFrame([("never seen", 3.0, 5.0, "w, z"), (None, 2.0, 5.0, None)], toy.schema)
    rows = [r["f"] for r in loaded.transform(new).select(vector_to_array("features").alias("f")).collect()]
    sd = np.std([1.0, 2.0, 6.0])
    assert rows[0] == pytest.approx([0, 0, 0.0, 0.0, 0, 1])
    assert rows[1] == pytest.approx([0, 0, -1.0 / sd, 0.0, 0, 0])


def test_names_are_in_the_vector_metadata(toy):
    fitted = en.Preprocessor(["k"], ["v"]).fit(toy)
    attrs = fitted.transform(toy).schema["features"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in attrs] == fitted.names


def test_null_numbers_raise(spark, toy):
    fitted = en.Preprocessor([], ["v"]).fit(toy)
    with pytest.raises(Exception):
        fitted.transform(spark.createDataFrame([("a", None, 5.0, "x")], toy.schema)).collect()


def test_too_many_levels_raise(spark, monkeypatch):
    monkeypatch.setattr(en, "MAX_LEVELS", 3)
    with pytest.raises(ValueError, match="more than 3 levels"):
        en.fit_levels(spark.range(10).select(F.col("id").cast("string").alias("c")), ["c"])


def test_feature_groups(mines):
    groups = en.feature_groups(mines)
    assert "US_STATE" in groups["categorical"] and "SEAM_HEIGHT" in groups["numeric"] and groups["labels"] == ["PRIMARY_LABELS"]
    assert not {"NUM_INJURIES", "INJ_RATE_PER2K", "EMP_HRS_TOTAL"} & {c for v in groups.values() for c in v}


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(0)
    n = 4000
    e, x, z = rng.uniform(1, 9, n), rng.normal(size=n), rng.normal(size=n)
    k = rng.choice(["a", "b", "c"], n)
    mu = e * np.exp(-1 + 0.4 * x + 0.3 * (k == "b") + 0.2 * x * z)
    pdf = pd.DataFrame({"y": rng.poisson(mu), "hours": e * 2000, "x": x, "z": z, "noise": rng.normal(size=n), "k": k})
    return spark.createDataFrame(pdf).repartition(4).persist(), pdf


def spec(*terms):
    return glm.GlmSpec(tuple(terms), count="y", exposure="hours", tol=1e-12)


def test_score_equations_hold(counts):
    df, _ = counts
    fitted = glm.fit_glm(df, spec(glm.number("x"), glm.category("k", "c"), glm.product("x", "z")))
    assert fitted.names == ["x", "k_a", "k_b", "x:z"]
    gap = F.col("y") - F.col("mu")
    row = fitted.predict(df, "mu").agg(F.avg(gap), F.avg(gap * F.col("x")), F.avg(gap * (F.col("k") == "a").cast("int")), F.avg(gap * F.col("x") * F.col("z"))).first()
    assert np.abs(list(row)).max() < 1e-6


def test_model_round_trip_and_summary(counts, tmp_path):
    df, _ = counts
    s = spec(glm.number("x"), glm.category("k"))
    fitted = glm.fit_glm(df, s)
    table = {r["name"]: r for r in fitted.coefficients().collect()}
    assert abs(table["k_b"]["estimate"] - 0.3) < 4 * table["k_b"]["std_error"]
    assert table["x"]["effect_pct"] == pytest.approx(100 * (np.exp(table["x"]["estimate"]) - 1))
    fitted.save(str(tmp_path / "glm"))
    again = glm.FittedGlm.load(str(tmp_path / "glm"), s)
    both = again.predict(fitted.predict(df, "a"), "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_stepwise_drops_noise_and_keeps_products_whole(counts):
    df, _ = counts
    best, path = glm.step_aic(df, spec(glm.number("x"), glm.number("z"), glm.number("noise"), glm.category("k"), glm.product("x", "z")))
    kept = {t.name for t in best.spec.terms}
    assert {"x", "z", "k", "x:z"} <= kept
    assert all(a.aic > b.aic for a, b in zip(path, path[1:]))


def test_dependent_columns_are_found(mines):
    assert glm.dependent_columns(mines, SHARE_COLUMNS) == [SHARE_COLUMNS[-1]]
    assert glm.dependent_columns(mines.withColumn("c", F.lit(4.0)), ["c", "SEAM_HEIGHT"]) == ["c"]


def test_rank_deficient_fit_has_no_errors_but_estimates(mines):
    terms = tuple(glm.number(c) for c in SHARE_COLUMNS)
    rows = glm.fit_glm(mines, glm.GlmSpec(terms)).coefficients().collect()
    assert len(rows) == 11 and all(r["estimate"] is not None for r in rows)


def test_tweedie_family(counts):
    df, _ = counts
    s = glm.GlmSpec((glm.number("x"),), count="y", exposure="hours", family="tweedie", variance_power=1.1)
    assert glm.fit_glm(df, s).coefficients().where("name = 'x'").first()["estimate"] == pytest.approx(0.4, abs=0.1)


def test_formula_text_equals_terms():
    columns = ("y", "a", "b", "k", "hours")
    spec = glm.formula("y ~ . - b + a:k + offset(log(hours))", columns, ["k"], {"k": "z"}, unit=1.0)
    assert spec.terms == (glm.number("a"), glm.category("k", "z"), glm.product("a", "k", factors=["k"]))
    assert (spec.count, spec.exposure, spec.unit) == ("y", "hours", 1.0)
    assert {t.name for t in glm.formula("y~a*b*k-a:k-k:a:b").terms} == {"a", "b", "k", "a:b", "b:k"}
    assert glm.formula("y ~ a + a + a:b + b:a").terms == (glm.number("a"), glm.product("a", "b")) and glm.formula("y ~ a").exposure is None
    for wrong in ("y", "~ a", "y ~", "y ~ a b:", "y ~ a + + b", "y ~ a ^ 2", "y ~ log(a)"):
        with pytest.raises(ValueError, match="formula"):
            glm.formula(wrong)


def test_category_in_a_product(spark):
    """A category, a number and their product fit each level on its own."""
    rng = np.random.default_rng(2)
    k, a = rng.integers(0, 3, 900), rng.normal(size=900)
    y = rng.poisson(np.exp(0.3 + 0.2 * k + (0.1 + 0.2 * k) * a))
    df = spark.createDataFrame([(int(i), float(j), f"k{c}") for i, j, c in zip(y, a, k)], "y int, a double, k string")
    spec = glm.formula("y ~ a * k", categories=["k"], tol=1e-12)
    got = {r["name"]: r["estimate"] for r in glm.fit_glm(df, spec).coefficients().collect()}
    for level in ("k0", "k1", "k2"):
        one = {r["name"]: r["estimate"] for r in glm.fit_glm(df.where(F.col("k") == level), glm.formula("y ~ a", tol=1e-12)).coefficients().collect()}
        assert one["a"] == pytest.approx(got["a"] + got.get(f"a:k_{level}", 0.0), abs=1e-6)
        assert one["(Intercept)"] == pytest.approx(got["(Intercept)"] + got.get(f"k_{level}", 0.0), abs=1e-6)


@pytest.mark.parametrize("family", ["poisson", "gaussian"])
def test_common_passes_equal_single_fits(spark, monkeypatch, family):
    """The path of dropped terms and its AICs, against the library's fit of every candidate; passes do not grow with the terms."""
    rng = np.random.default_rng(4)
    n = 1200
    pdf = pd.DataFrame({c: rng.normal(size=n) for c in "abcd"} | {"k": rng.integers(0, 3, n).astype(str), "hours": rng.uniform(1, 9, n) * 2000, "w": rng.uniform(0.5, 2, n)})
    pdf["y"] = rng.poisson(np.exp(0.5 * pdf.a - 0.2 * pdf.b + 0.1 * pdf.a * pdf.b + 0.3 * (pdf.k == "2")) * pdf.hours / 2000)
    df = spark.createDataFrame(pdf).repartition(3)
    spec = glm.formula("y ~ a * b + c + d + k + c:d + offset(log(hours))", categories=["k"], weight="w", family=family, link="log" if family == "poisson" else "identity", tol=1e-12)
    passes, once = [], glm.CommonPasses._pass
    monkeypatch.setattr(glm.CommonPasses, "_pass", lambda self, models: passes.append(len(models)) or once(self, models))
    best, path = glm.step_aic(df, spec)
    current, want = glm.fit_glm(df, spec), []
    want.append((None, current.aic))
    while True:
        held = {c for t in current.spec.terms if len(t.columns) > 1 for c in t.columns}
        fits = [(t.name, glm.fit_glm(df, current.spec.without(t.name))) for t in current.spec.terms if len(t.columns) > 1 or t.columns[0] not in held]
        name, fit = min(fits, key=lambda f: f[1].aic)
        if fit.aic >= current.aic:
            break
        current = fit
        want.append((name, fit.aic))
    assert [s.removed for s in path] == [w[0] for w in want] and [s.aic for s in path] == pytest.approx([w[1] for w in want], abs=1e-5)
    assert best.aic == pytest.approx(path[-1].aic, abs=1e-5) and len(path) > 1
    assert not passes if family != "poisson" else len(passes) <= 8 * (len(path) + 1)


def test_stepwise_reads_its_rows_once(spark):
    """Levels, passes and the last fit share one evaluation of the input; nothing of it stays behind."""
    rng = np.random.default_rng(6)
    n = 900
    pdf = pd.DataFrame({c: rng.normal(size=n) for c in "abc"} | {"k": rng.integers(0, 3, n).astype(str), "hours": rng.uniform(1, 9, n) * 2000})
    pdf["y"] = rng.poisson(np.exp(0.5 * pdf.a + 0.3 * (pdf.k == "2")) * pdf.hours / 2000)
    read, source = spark.sparkContext.accumulator(0), spark.createDataFrame(pdf).repartition(3)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = glm.formula("y ~ a * b + c + k + offset(log(hours))", categories=["k"])
    _, path = glm.step_aic(source.mapInArrow(counted, source.schema), model)
    assert len(path) > 1 and read.value == n
    with glm.CommonPasses(source.mapInArrow(counted, source.schema), model, {"k": ["0", "1", "2"]}) as passes:
        assert passes([model]) == pytest.approx([path[0].aic], abs=1e-6) and len(passes([model.without("a:b"), model.without("c")])) == 2
    assert read.value == 2 * n and spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_packed_design_is_whole(monkeypatch):
    """Blocks give back every cell: mostly filled columns, thin ones, empty ones and missing values."""
    monkeypatch.setattr(glm, "BLOCK", 7)
    rng = np.random.default_rng(7)
    x = np.column_stack([np.ones(40), rng.normal(size=40), rng.integers(0, 2, 40) * 3.5, np.zeros(40), np.eye(40, 2, -25)])
    x[3, 1] = x[9, 4] = np.nan
    y, o, w = rng.integers(0, 4, 40) * 1.0, rng.normal(size=40), rng.uniform(size=40)
    batch = pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), y, o, w], ["x", "y", "o", "w"])
    packed = list(glm._packed(x.shape[1], [batch.slice(0, 30), batch.slice(30)]))
    got = [part for block in packed for part in glm._unpacked(x.shape[1], block)]
    assert len(packed) == 7
    for want, parts in zip((x.T, y, o, w), zip(*got)):
        assert np.array_equal(np.concatenate(parts, axis=-1), want, equal_nan=True)
    sums = [sum(block.column(c)[0].as_py() for block in packed) for c in ("y", "e", "constant")]
    assert sums == pytest.approx([w @ y, w @ np.exp(o), sum(a * math.lgamma(b + 1) for a, b in zip(w, y))])


def test_candidates_far_from_the_full_model(spark, monkeypatch):
    """Dropping a term that explains nearly all counts ends where a fit from nothing does; one that explains none takes few passes."""
    rng = np.random.default_rng(8)
    n = 600
    pdf = pd.DataFrame({c: rng.normal(size=n) for c in "abc"})
    pdf["b"] = (pdf.b > 0) * 1.0
    pdf["y"] = rng.poisson(np.exp(2.5 * pdf.a + 1.5 * pdf.a * pdf.b))
    model, sizes, once = glm.formula("y ~ a + b + c + a:b", tol=1e-12), [], glm.CommonPasses._pass
    monkeypatch.setattr(glm.CommonPasses, "_pass", lambda self, models: sizes.append(len(models)) or once(self, models))
    df = spark.createDataFrame(pdf).repartition(2)
    with glm.CommonPasses(df, model, {}) as passes:
        candidates = [model.without("a"), model.without("a:b"), model.without("a").without("a:b"), model.without("b")]
        alone = passes(candidates)
        full = passes([model])
        assert full == pytest.approx([glm.fit_glm(df, model).aic], abs=1e-5) and max(alone) > 1000 * full[0]
        assert passes(candidates) == pytest.approx(alone, rel=1e-9)
        passes([model])
        sizes.clear()
        passes([model.without("c")])
        assert len(sizes) <= 3


def test_numbers_are_not_taken_apart_and_features_become_columns_without_a_vector(spark, monkeypatch):
    df = spark.range(0, 400, 1, 3).selectExpr(
        "id", "if(id % 9 = 0, null, concat('k', id % 3)) as kind", "concat_ws(', ', 'all', if(id % 2 = 0, 'even', null), if(id % 5 = 0, '', null)) as labels",
        "double(id % 7) as x", "int(3) as same", "struct(id) as `_stats`",
    )
    explode, taken = F.explode, []
    monkeypatch.setattr(F, "explode", lambda c: (taken.append(str(c)), explode(c))[1])
    fitted = en.Preprocessor(["kind"], ["x", "same"], ["labels"]).fit(df)
    assert len(taken) == 1 and "double" not in taken[0].lower()
    assert fitted.names == ["kind_k1", "kind_k2", "x", "same", "labels_even"]
    names = [f"f{i}" for i in range(5)]
    wide = fitted.expand(df, names)
    assert "vector" not in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    assert wide.columns == [*df.columns, *names]
    vectors = {r["id"]: r["features"].toArray().tolist() for r in fitted.transform(df).select("id", "features").collect()}
    assert {r["id"]: [r[n] for n in names] for r in wide.collect()} == vectors and len(vectors) == 400
    for broken in ("if(id = 7, null, x)", "if(id = 7, double('NaN'), x)"):
        with pytest.raises(Exception, match="feature x is missing"):
            fitted.expand(df.withColumn("x", F.expr(broken)), names).select("f2").collect()
    assert en.Preprocessor([], ["x"], []).fit(df.where("id < 0")).names == ["x"]
