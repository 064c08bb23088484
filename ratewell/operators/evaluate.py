"""Evaluation of scored rows.

Per-class results come from the small table of (actual, predicted) counts, and
everything about thresholds and ranks from counts per score, so scored rows are
read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions import labels as lb, measures as ms
from . import ranking
from .relational import complete_grid
from .summary import describe

# Weights of the event-weighted scores (class + 1 for classes 1 to 10; they add up to 65).
TOP_CLASS = 10
EVENT_WEIGHT_TOTAL = 65.0


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def with_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Residual, absolute and squared error."""
    e = F.col(actual) - F.col(predicted)
    return df.withColumns({"residual": e, "abs_error": F.abs(e), "squared_error": e * e})


def confusion(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = (), full: bool = True) -> DataFrame:
    """Counts per (actual, predicted); ``full`` adds pairs that never occur."""
    rows = df.select(*by, _c(actual).alias("actual"), _c(predicted).alias("predicted"))
    counts = rows.groupBy(*by, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return complete_grid(counts, "actual", "predicted", "n", by) if full else counts


def binary_scores(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 prediction, 0 where undefined."""
    a, p = _c(actual), _c(predicted)
    counts = df.groupBy(*by).agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    )
    hits, total = F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return counts.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        ms.ratio_or_zero(hits, total).alias("accuracy"),
        ms.precision_of("tp", "fp").alias("precision"),
        ms.recall_of("tp", "fn").alias("recall"),
        ms.f1_of("tp", "fp", "fn").alias("f1"),
    )


def class_scores(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class on either side."""
    counts = confusion(df, actual, predicted, by, full=False)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), zero.alias("named"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("predicted").alias("cls"), zero.alias("support"), F.col("n").alias("named"), zero.alias("tp")),
    )
    sums = (
        counts.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.cls").alias("class"))
        .agg(F.sum("s.support").alias("support"), F.sum("s.named").alias("named"), F.sum("s.tp").alias("tp"))
    )
    return sums.select(
        *by,
        "class",
        ms.ratio_or_zero("tp", "named").alias("precision"),
        ms.ratio_or_zero("tp", "support").alias("recall"),
        ms.ratio_or_zero(F.col("tp") * 2, F.col("named") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def classification_report(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Class rows plus accuracy, macro and support-weighted averages."""
    scores = class_scores(df, actual, predicted, by)
    w = F.col("support")
    total = F.sum(w)
    averages = scores.groupBy(*by).agg(
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[F.try_divide(F.sum(F.col(m) * w), total).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
        F.try_divide(F.sum("tp").cast("double"), total).alias("accuracy"),
        total.alias("support"),
    )

    def line(name: str, cells: Sequence[str]):
        return F.struct(
            F.lit(name).alias("class"),
            *[F.col(c).cast("double").alias(m) for m, c in zip(("precision", "recall", "f1"), cells)],
            F.col("support").alias("support"),
        )

    lines = F.array(
        line("accuracy", ["accuracy"] * 3),
        line("macro avg", ["macro_precision", "macro_recall", "macro_f1"]),
        line("weighted avg", ["weighted_precision", "weighted_recall", "weighted_f1"]),
    )
    bottom = averages.select(*by, F.explode(lines).alias("l")).select(*by, "l.*")
    top = scores.select(*by, F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    return top.unionByName(bottom)


def class_accuracy(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Share of each actual class that is predicted right; empty classes are left out."""
    a, p = _c(actual), _c(predicted)
    return df.groupBy(*by, a.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.avg((a == p).cast("double")).alias("accuracy"))


def detection_rates(df: DataFrame, event_class: Column | str, flagged: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """For class 0 the share not flagged, for higher classes the share flagged."""
    k, f = _c(event_class), _c(flagged)
    right = ((k == 0) & (f == 0)) | ((k > 0) & (f == 1))
    rates = df.groupBy(*by, k.alias("class")).agg(
        F.count_if(right).alias("correct"), F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy")
    )
    return rates.withColumn("class_name", lb.class_name("class"))


def threshold_scan(
    df: DataFrame,
    score: Column | str,
    event_class: Column | str,
    low: float = 0.01,
    high: float = 0.99,
    steps: int = 500,
    target: float = 0.907,
    classes: int = 4,
) -> DataFrame:
    """Class accuracies at every threshold of an even grid, in one pass.

    A row falls in the cell of the last threshold its score reaches; running
    sums over the grid's cells then give all thresholds at once.  Rows of a class
    from ``classes`` up have no rate of their own but count in the overall
    accuracy like all others above 0; a row without class is never right.
    """
    step = (high - low) / (steps - 1)

    def at(i: Column) -> Column:
        return F.when(i == steps - 1, F.lit(high)).otherwise(F.lit(low) + i * F.lit(step))

    s, k = _c(score), _c(event_class)
    guess = F.least(F.greatest(F.floor((s - F.lit(low)) / F.lit(step)), F.lit(-1)), F.lit(steps - 1)).cast("int")
    rows = df.select(s.alias("_s"), k.alias("_k"), guess.alias("_g")).where(F.col("_s").isNotNull())
    up = (F.col("_g") < steps - 1) & (at(F.col("_g") + 1) <= F.col("_s"))
    down = (F.col("_g") >= 0) & (at(F.col("_g")) > F.col("_s"))
    reached = F.col("_g") + F.when(up, 1).when(down, -1).otherwise(0)
    cells = rows.groupBy((reached + 1).cast("int").alias("cell")).agg(
        *[F.count_if(F.col("_k") == c).alias(f"k{c}") for c in range(classes)],
        F.count_if(F.col("_k") >= classes).alias("k_more"),
        F.count_if(F.col("_k").isNull() | (F.col("_k") < 0)).alias("k_none"),
    )
    grid = df.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("cell"))
    ks = [*[f"k{c}" for c in range(classes)], "k_more", "k_none"]
    dense = grid.join(cells, "cell", "left").na.fill(0, ks)
    to_here, all_ = W.orderBy("cell").rowsBetween(W.unboundedPreceding, 0), W.partitionBy()
    sums = dense.select(
        "cell", *[F.sum(k_).over(to_here).alias(f"{k_}_no") for k_ in ks], *[F.sum(k_).over(all_).alias(f"{k_}_all") for k_ in ks]
    ).where(F.col("cell") < steps)
    right = {c: F.col(f"k{c}_no") if c == 0 else F.col(f"k{c}_all") - F.col(f"k{c}_no") for c in range(classes)}
    overall, total = right[0] + F.col("k_more_all") - F.col("k_more_no"), F.col("k0_all") + F.col("k_more_all") + F.col("k_none_all")
    for c in range(1, classes):
        overall, total = overall + right[c], total + F.col(f"k{c}_all")
    class0 = ms.ratio_or_zero(right[0], F.col("k0_all"))
    return sums.select(
        at(F.col("cell")).alias("threshold"),
        class0.alias("class0_accuracy"),
        *[F.try_divide(right[c].cast("double"), F.col(f"k{c}_all")).alias(f"class{c}_rate") for c in range(1, classes)],
        ms.ratio_or_zero(overall, total).alias("overall_accuracy"),
        F.abs(class0 - F.lit(target)).alias("diff"),
    )


def best_threshold(scan: DataFrame) -> DataFrame:
    """The threshold whose class-0 accuracy is nearest the target, lowest first."""
    return scan.agg(F.min_by(F.struct("*"), F.struct("diff", "threshold")).alias("b")).select("b.*")


def rank_scores(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (ties count half) and average precision."""
    hit = positive.cast("boolean").cast("bigint")
    c = ranking.cumulative_counts(df, score, by, {"pos": hit})
    neg, neg_to = F.col("n") - F.col("pos"), (F.col("n_to") - F.col("pos_to"))
    pairs = F.col("pos").cast("double") * (neg_to - neg + neg / 2)
    named = F.col("n_all") - F.col("n_to") + F.col("n")
    true = F.col("pos_all") - F.col("pos_to") + F.col("pos")
    positives = F.max("pos_all").cast("double")
    return c.groupBy(*by).agg(
        F.max("n_all").alias("n"),
        F.max("pos_all").alias("positives"),
        F.try_divide(F.sum(pairs), positives * (F.max("n_all") - F.max("pos_all"))).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * true / named), positives).alias("average_precision"),
    )


def segment_scores(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Counts, mean prediction and mean actual on zero and non-zero rows; 0 for an empty segment."""
    return df.groupBy(*by).agg(*_segment_columns(F.col(actual), F.col(predicted)))


def _segment_columns(a: Column, p: Column) -> list[Column]:
    zero, pos, e = a == 0, a > 0, a - p
    return [
        F.count_if(zero).alias("zero_count"),
        F.count_if(pos).alias("nonzero_count"),
        F.coalesce(F.avg(F.when(zero, p)), F.lit(0.0)).alias("zero_avg_pred"),
        F.coalesce(F.avg(F.when(pos, p)), F.lit(0.0)).alias("nonzero_avg_pred"),
        F.coalesce(F.avg(F.when(pos, a)), F.lit(0.0)).alias("nonzero_avg_actual"),
        F.coalesce(F.sqrt(F.avg(F.when(pos, e * e))), F.lit(0.0)).alias("nonzero_rmse"),
    ]


def metric_columns(df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = "weight", by: Sequence[str] = ("dataset",)) -> DataFrame:
    """All error measures per part, one pass."""
    a, p = F.col(actual), F.col(predicted)
    columns = [
        ms.mean_squared_error(a, p).alias("mse"),
        ms.root_mean_squared_error(a, p).alias("rmse"),
        ms.mean_absolute_error(a, p).alias("mae"),
        ms.poisson_log_likelihood(a, p).alias("ll"),
        ms.hit_rate(F.bround(a, 0), F.bround(p, 0)).alias("rounded_accuracy"),
        *_segment_columns(a, p),
    ]
    if weight is not None and weight in df.columns:
        columns += [ms.weighted_rmse(a, p, weight).alias("weighted_rmse"), ms.weighted_mae(a, p, weight).alias("weighted_mae")]
    return df.groupBy(*by).agg(*columns)


def to_long(wide: DataFrame, part: str) -> DataFrame:
    """(metric, value) rows named ``<part>_<column>``."""
    names = [c for c in wide.columns if c != part]
    pairs = F.array(*[F.struct(F.lit(n).alias("m"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(part, F.explode(pairs).alias("x")).select(
        F.concat_ws("_", F.col(part), F.col("x.m")).alias("metric"), F.col("x.value").alias("value")
    )


def metric_table(df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = "weight", part: str = "dataset", probability: str | None = None, classes: int | None = 0) -> DataFrame:
    """Long metric table over all parts.

    With a probability column it adds ROC AUC and average precision; with
    ``classes`` the accuracy of each rounded class below it, or of every class
    if it is None.  Actual and predicted must
    be in the same unit: a rate scored against counts gives numbers that mean
    nothing.
    """
    out = to_long(metric_columns(df, actual, predicted, weight, [part]), part)
    if probability is not None:
        ranks = rank_scores(df, probability, F.col(actual) > 0, [part])
        out = out.unionByName(to_long(ranks.select(part, "auc", F.col("average_precision").alias("ap")), part))
    if classes is None or classes:
        acc = class_accuracy(df, lb.rounded(actual), lb.rounded(predicted), [part])
        acc = acc.where(F.col("class") >= 0 if classes is None else F.col("class").between(0, classes - 1))
        out = out.unionByName(
            acc.select(F.concat(F.col(part), F.lit("_class_"), F.col("class"), F.lit("_accuracy")).alias("metric"), F.col("accuracy").alias("value"))
        )
    return out


def nonzero_macro(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of class scores over classes 1 to 10; absent classes count 0."""
    inside = F.col("class").between(1, TOP_CLASS)
    return scores.groupBy(*by).agg(
        *[(F.sum(F.when(inside, F.col(m)).otherwise(0.0)) / F.lit(float(TOP_CLASS))).alias(m) for m in ("precision", "recall", "f1")]
    )


def event_weighted(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Class scores 1 to 10 weighted with class + 1; absent classes count 0."""
    weight = F.when(F.col("class").between(1, TOP_CLASS), F.col("class") + 1).otherwise(0)
    return scores.groupBy(*by).agg(
        *[(F.sum(weight * F.col(m)) / F.lit(EVENT_WEIGHT_TOTAL)).alias(m) for m in ("precision", "recall", "f1")]
    )


def prediction_summary(df: DataFrame, predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    return describe(df, [predicted], by)


def scored_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted", part: str = "dataset") -> DataFrame:
    """Scored rows with errors, any-event flag, percentile of the prediction and large-error flag."""
    rows = with_errors(df, actual, predicted).withColumn("has_injury", lb.any_event(actual))
    # The flag first: its quantile is then read off the scored rows and not off the ranked join.
    rows = ranking.flag_above_quantile(rows, "abs_error", 0.95, "large_error")
    return ranking.percent_rank_average(rows, predicted, [part], "pred_percentile")
