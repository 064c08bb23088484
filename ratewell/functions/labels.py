"""Targets, classes and bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

__all__ = [
    "RATE_EDGES",
    "CLASS_NAMES",
    "any_event",
    "capped_class",
    "class_from_rate",
    "class_from_equal",
    "class_from_count",
    "rounded",
    "right_closed_bin",
    "class_name",
    "positive_weight",
    "step_weight",
    "hard_gate",
    "soft_product",
]

# Edges of the rate strata and names of the event classes.
RATE_EDGES = (0.0, 0.05, 0.1, 0.2, 0.5, 1.0)
CLASS_NAMES = ("No Injury", "One Injury", "Two Injuries", "Three+ Injuries")


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def any_event(column) -> Column:
    return (_c(column) > 0).cast("int")


def capped_class(column, cap: int = 3) -> Column:
    """Whole part of the value, at most ``cap``; rates below one become class 0."""
    return F.least(_c(column), F.lit(cap)).cast("int")


def class_from_rate(column) -> Column:
    """Class by right-closed rate bins: 0, (0,1], (1,2], above 2."""
    c = _c(column)
    return F.when(c > 2, 3).when(c > 1, 2).when(c > 0, 1).otherwise(0)


def class_from_equal(column) -> Column:
    """Class by exact value: 1, 2, at least 3; fractions stay in class 0."""
    c = _c(column)
    return F.when(c >= 3, 3).when(c == 2, 2).when(c == 1, 1).otherwise(0)


def class_from_count(column) -> Column:
    """Class of a whole count: 0, 1, 2, at least 3."""
    c = _c(column)
    return F.when(c >= 3, 3).otherwise(c.cast("int"))


def rounded(column) -> Column:
    """Nearest whole number, halves to the even one."""
    return F.bround(_c(column), 0).cast("int")


def right_closed_bin(column, edges: Sequence[float] = RATE_EDGES, empty: str = "Zero") -> Column:
    """Label of the bin ``(low, high]``; values outside and nulls go to ``empty``."""
    c = _c(column)
    bounds = [*edges, None]
    out = F
    for low, high in zip(bounds, bounds[1:]):
        inside = (c > F.lit(float(low))) & ((c <= F.lit(float(high))) if high is not None else F.lit(True))
        label = f"({low:g}, {high:g}]" if high is not None else f"({low:g}, inf]"
        out = out.when(inside, F.lit(label))
    return out.otherwise(F.lit(empty))


def class_name(column, names: Sequence[str] = CLASS_NAMES) -> Column:
    """Display name of a class; classes past the last name take the last one."""
    c = _c(column)
    out = F
    for i, name in enumerate(names[:-1]):
        out = out.when(c == i, F.lit(name))
    return out.when(c.isNotNull(), F.lit(names[-1]))


def positive_weight(label, weight: float) -> Column:
    return F.when(_c(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def step_weight(column, steps: Sequence[tuple[float, float]] = ((2.0, 10.0), (1.0, 5.0))) -> Column:
    """Weight of the first step the value is above; 1 below all of them."""
    out = F
    for limit, weight in sorted(steps, reverse=True):
        out = out.when(_c(column) > F.lit(limit), F.lit(weight))
    return out.otherwise(F.lit(1.0))


def hard_gate(label, value) -> Column:
    """Second-stage value where the first stage says yes, else 0."""
    return F.when(_c(label) > 0, _c(value)).otherwise(F.lit(0.0))


def soft_product(probability, value) -> Column:
    return _c(probability) * _c(value)
