import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewell.functions import labels as lb
from ratewell.operators import evaluate as ev, ranking as rk, relational as rel, splits as sp, summary as sm


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, half share one group, some groups are null."""
    rng = np.random.default_rng(1)
    n = 6000
    v = rng.normal(size=n).round(2)
    v[: n // 3] = 0.5
    g = np.where(rng.random(n) < 0.5, "hot", np.where(rng.random(n) < 0.5, "a", None))
    pdf = pd.DataFrame({"k": np.arange(n), "g": g, "v": rng.permutation(v), "y": (rng.random(n) < 0.3).astype(int)})
    pdf["g"] = pdf["g"].astype(object)
    return spark.createDataFrame(pdf, "k bigint, g string, v double, y int"), pdf


def test_quantiles_match_pandas(skewed):
    df, pdf = skewed
    got = {r["g"]: r for r in rk.quantiles(df, "v", [0, 0.25, 0.5, 0.95, 1], ["g"]).collect()}
    for g, part in pdf.groupby("g", dropna=False):
        row = got[g if isinstance(g, str) else None]
        want = part["v"].quantile([0, 0.25, 0.5, 0.95, 1]).tolist()
        assert [row[c] for c in ("p0", "p25", "p50", "p95", "p100")] == pytest.approx(want)


def test_percentile_rank_matches_pandas_without_broadcast(spark, skewed):
    df, pdf = skewed
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        got = rk.percent_rank_average(df, "v", ["g"], "r").select("k", "r").toPandas().set_index("k")["r"]
    finally:
        for k, o in zip(keys, old):
            spark.conf.unset(k) if o is None else spark.conf.set(k, o)
    want = pdf.groupby("g", dropna=False)["v"].rank(pct=True)
    assert np.allclose(got.sort_index().to_numpy(), want.to_numpy())


def test_cumulative_counts_cross_many_buckets(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).cast("double").alias("v"))
    c = rk.cumulative_counts(df, "v")
    assert c.where((F.col("n_to") != F.col("v") + 1) | (F.col("n_all") != 50_000)).count() == 0


def test_empty_input_gives_no_rows(spark):
    assert rk.cumulative_counts(spark.createDataFrame([], "v double"), "v").count() == 0


def test_row_numbers_are_gapless(skewed):
    df, pdf = skewed
    numbers = sorted(r["number"] for r in rk.row_numbers(df, "v", "k").select("number").collect())
    assert numbers == list(range(1, len(pdf) + 1))


def test_describe_matches_pandas(skewed):
    df, pdf = skewed
    row = sm.describe(df, ["v"]).first()
    want = pdf["v"].describe()
    assert [row[c] for c in ("n", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(want.tolist())


def test_histogram_matches_numpy(skewed):
    df, pdf = skewed
    got = [r["n"] for r in sm.histogram(df, "v", 50).orderBy("bin").collect()]
    assert sum(got) == len(pdf) and np.abs(np.array(got) - np.histogram(pdf["v"], 50)[0]).sum() <= 4
    constant = sm.histogram(df.withColumn("c", F.lit(2.0)), "c", 5).orderBy("bin").collect()
    assert [r["n"] for r in constant] == [len(pdf), 0, 0, 0, 0]


def test_usage_lists_known_versions(spark):
    log = spark.createDataFrame([("2",), ("2",)], "version string")
    assert {r["version"]: r["n"] for r in sm.usage_counts(log, "version", ["1", "2"]).collect()} == {"1": 0, "2": 2}


def test_stratified_split_is_exact_and_stable(skewed):
    df, pdf = skewed
    parts = lambda d: sp.stratified_split(d, "k", F.col("g"), 0.75, 7).select("k", "g", "dataset").toPandas()
    a, b = parts(df), parts(df.repartition(13))
    assert a.sort_values("k").dataset.tolist() == b.sort_values("k").dataset.tolist()
    assert len(a) == len(pdf)
    for _, part in a.groupby("g", dropna=False):
        assert (part.dataset == "train").sum() == int(len(part) * 0.75)


def test_split_of_tiny_strata(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k bigint, g string")
    rows = {r["k"]: r["dataset"] for r in sp.stratified_split(df, "k", F.col("g"), 0.5).collect()}
    assert rows[1] == "test" and sorted([rows[2], rows[3]]) == ["test", "train"]


def test_overlay_keeps_null_of_the_right_side(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "m string, value double")
    right = spark.createDataFrame([("b", None), ("c", 3.0)], "m string, value double")
    assert {r["m"]: r["value"] for r in rel.overlay(left, right, ["m"]).collect()} == {"a": 1.0, "b": None, "c": 3.0}


def test_grid_is_completed_and_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 0)], "a int, p int")
    grid = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion(df, "a", "p").collect()}
    assert grid == {(0, 0): 1, (0, 2): 1, (2, 0): 1, (2, 2): 0}
    monkeypatch.setattr(rel, "MAX_GRID_LABELS", 1)
    with pytest.raises(Exception, match="a grid takes at most"):
        ev.confusion(df, "a", "p").collect()


def test_auc_and_average_precision_with_ties(skewed):
    df, pdf = skewed
    row = ev.rank_scores(df, "v", F.col("y") == 1).first()
    pos, neg = pdf.v[pdf.y == 1].to_numpy(), pdf.v[pdf.y == 0].to_numpy()
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    t = pdf.groupby("v").y.agg(["sum", "count"]).sort_index(ascending=False).cumsum()
    recall = t["sum"] / t["sum"].iloc[-1]
    ap = (recall.diff().fillna(recall.iloc[0]) * t["sum"] / t["count"]).sum()
    assert row["auc"] == pytest.approx(auc) and row["average_precision"] == pytest.approx(ap)


def test_threshold_scan_matches_five_hundred_passes(spark):
    rng = np.random.default_rng(2)
    grid = np.linspace(0.01, 0.99, 500)
    score = np.concatenate([rng.random(300), grid[::7], [0.0, 1.0]])
    k = rng.integers(0, 4, len(score))
    df = spark.createDataFrame(pd.DataFrame({"s": score, "k": k}))
    got = ev.threshold_scan(df, "s", "k").orderBy("threshold").toPandas()
    for i in (0, 1, 7, 250, 498, 499):
        yes = score >= got.threshold[i]
        assert got.threshold[i] == pytest.approx(grid[i], abs=1e-12)
        assert got.class0_accuracy[i] == pytest.approx((~yes[k == 0]).mean())
        assert got.class2_rate[i] == pytest.approx(yes[k == 2].mean())
        assert got.overall_accuracy[i] == pytest.approx((yes == (k > 0)).mean())


def test_classes_and_rounding(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.5,), (2.5,), (3.0,)], "r double")
    row = df.agg(
        *[F.collect_list(c).alias(n) for n, c in (("rate", lb.class_from_rate("r")), ("value", lb.class_from_equal("r")), ("bin", lb.right_closed_bin("r")), ("round", lb.rounded("r")))]
    ).first()
    assert row["rate"] == [0, 1, 1, 2, 3, 3] and row["value"] == [0, 0, 1, 0, 0, 3]
    assert row["bin"] == ["Zero", "(0.2, 0.5]", "(0.5, 1]", "(1, inf]", "(1, inf]", "(1, inf]"]
    assert row["round"] == [0, 0, 1, 2, 2, 3]


def test_event_weights_sum_to_65(spark):
    df = spark.createDataFrame([(c, c) for c in range(11)], "a int, p int")
    scores = ev.class_scores(df, "a", "p")
    assert ev.event_weighted(scores).first()["recall"] == pytest.approx(1.0)
    assert ev.nonzero_macro(scores).first()["f1"] == pytest.approx(1.0)
    only_one = ev.class_scores(df.where("a = 1"), "a", "p")
    assert ev.event_weighted(only_one).first()["precision"] == pytest.approx(2 / 65)


def test_hot_values_and_nulls(spark):
    """One value on most rows, and rows without value."""
    df = spark.range(400).selectExpr("id", "if(id % 10 = 0, double(id), if(id % 10 = 1, null, 5.0)) as v", "concat('t', lpad(string(399 - id), 3, '0')) as tie")
    ranked = {r["id"]: r["pct"] for r in rk.percent_rank_average(df, "v", (), "pct").collect()}
    values = sorted(r["v"] for r in df.collect() if r["v"] is not None)
    for r in df.collect():
        if r["v"] is None:
            assert ranked[r["id"]] is None
        else:
            low, n = values.index(r["v"]), values.count(r["v"])
            assert abs(ranked[r["id"]] - (low + (n + 1) / 2) / len(values)) < 1e-12
    numbered = {r["id"]: r["number"] for r in rk.row_numbers(df, "v", "tie").collect()}
    order = sorted((r["v"], r["tie"], r["id"]) for r in df.collect() if r["v"] is not None)
    assert numbered == {row[2]: i + 1 for i, row in enumerate(order)}


def test_counted_lookup_spreads_hot_keys_alone(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'hot' ELSE string(id) END AS k")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    out = rel.counted_lookup(rows, groups, "k", "n", F.col("id"), share=4)
    assert out.count() == 5000 and sorted(out.columns) == ["id", "k", "top"]
    assert out.where("k IS NULL AND top <> 4998 OR k = 'hot' AND top <> 4999 OR k NOT IN ('hot') AND top <> id").count() == 0
    # At most `share` keys are broadcast.
    assert groups.where("n * 4 >= 5000").count() == 2
    assert rel.counted_lookup(rows.where("false"), groups.where("false"), "k", "n", F.col("id")).count() == 0
