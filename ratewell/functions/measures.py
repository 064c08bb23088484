"""Aggregate columns that score a prediction.  Each is one pass with map-side partials."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "sketched_quantiles",
    "poisson_log_likelihood",
    "mean_squared_error",
    "root_mean_squared_error",
    "mean_absolute_error",
    "weighted_rmse",
    "weighted_mae",
    "hit_rate",
    "gaussian_log_likelihood",
    "ratio_or_zero",
    "precision_of",
    "recall_of",
    "f1_of",
]


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def sketched_quantiles(column: str, parts: int, accuracy: int) -> Column:
    """Approximate values at 1/parts, 2/parts, …, as one array.

    Written as SQL text: as a list of literals it takes a call to the JVM for each.
    """
    name = "`" + column.replace("`", "``") + "`"
    probs = ", ".join(f"{i / parts!r}D" for i in range(1, parts))
    return F.expr(f"percentile_approx(CAST({name} AS DOUBLE), array({probs}), {accuracy})")


def poisson_log_likelihood(actual, predicted, floor: float = 1e-6) -> Column:
    """Sum of y·ln(p) − p up to a constant.

    A prediction that is not positive counts as ``floor`` in the log and as 0
    in the sum.
    """
    y, p = _c(actual), _c(predicted)
    safe = F.when(p <= 0, F.lit(float(floor))).otherwise(p)
    return F.sum(y * F.ln(safe)) - F.sum(F.greatest(p, F.lit(0.0)))


def mean_squared_error(actual, predicted) -> Column:
    e = _c(actual) - _c(predicted)
    return F.avg(e * e)


def root_mean_squared_error(actual, predicted) -> Column:
    return F.sqrt(mean_squared_error(actual, predicted))


def mean_absolute_error(actual, predicted) -> Column:
    return F.avg(F.abs(_c(actual) - _c(predicted)))


def weighted_rmse(actual, predicted, weight) -> Column:
    e = _c(actual) - _c(predicted)
    return F.sqrt(F.try_divide(F.sum(_c(weight) * e * e), F.sum(_c(weight))))


def weighted_mae(actual, predicted, weight) -> Column:
    return F.try_divide(F.sum(_c(weight) * F.abs(_c(actual) - _c(predicted))), F.sum(_c(weight)))


def hit_rate(left, right) -> Column:
    return F.avg((_c(left) == _c(right)).cast("double"))


def gaussian_log_likelihood(actual, predicted) -> Column:
    """Minus the sum of squared errors over twice the row count."""
    return -mean_squared_error(actual, predicted) / F.lit(2.0)


def ratio_or_zero(numerator, denominator) -> Column:
    return F.coalesce(F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double")), F.lit(0.0))


def precision_of(tp, fp) -> Column:
    return ratio_or_zero(tp, _c(tp) + _c(fp))


def recall_of(tp, fn) -> Column:
    return ratio_or_zero(tp, _c(tp) + _c(fn))


def f1_of(tp, fp, fn) -> Column:
    return ratio_or_zero(_c(tp) * 2, _c(tp) * 2 + _c(fp) + _c(fn))
