"""Feature builder and label vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import features as fx
from ..roles import MINE, Roles
from .clean import basic_cleaning  # noqa: F401  (part of the usual chain)
from .ranking import scalar_quantiles

# Risk weights of the shares, flag limits and the base level of the composite category.
RISK_WEIGHTS = {"underground": 2.0, "surface": 1.0, "strip": 1.5, "mill": 0.8}
UNDERGROUND_LIMIT = 0.7
OFFICE_LIMIT = 0.5
BASE_KIND = "Sand & gravel"


def label_vocabulary(df: DataFrame, column: str, sep: str = ", ") -> DataFrame:
    """Distinct labels with the number of rows that carry them."""
    labels = df.select(F.explode(F.array_distinct(fx.label_array(column, sep))).alias("label"))
    return labels.where(F.col("label") != "").groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def label_indicators(df: DataFrame, column: str, labels: Sequence[str], prefix: str = "", sep: str = ", ") -> DataFrame:
    """0/1 columns for known labels; unknown labels of the rows are ignored."""
    return df.withColumns({f"{prefix}{label}": fx.label_flag(column, label, sep) for label in labels})


def ordered_levels(levels: Sequence[str], reference: str | None = None) -> list[str]:
    """Levels in order with the reference level first, where it exists."""
    levels = sorted(levels)
    return [reference, *[v for v in levels if v != reference]] if reference in levels else levels


def largest_level(df: DataFrame, column: str) -> DataFrame:
    """The level with most rows, first by name among equals."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.asc(column)).limit(1)


def level_indicators(df: DataFrame, column: str, levels: Sequence[str], prefix: str | None = None) -> DataFrame:
    """0/1 columns for every level but the first; unknown values give all zeros."""
    prefix = f"{column}_" if prefix is None else prefix
    return df.withColumns({f"{prefix}{v}": fx.level_flag(column, v) for v in levels[1:]})


def add_ratio_with_median(
    df: DataFrame, numerator: str, denominator: str, out: str, fit_on: Column | None = None
) -> DataFrame:
    """Ratio where the denominator is positive, its median elsewhere."""
    base = df if fit_on is None else df.where(fit_on)
    ratio = fx.ratio_where_positive(numerator, denominator)
    median = scalar_quantiles(base, {"median": (ratio, 0.5)}).getField("median")
    return df.withColumn(out, F.coalesce(ratio, median))


def _stats_column(df: DataFrame, roles: Roles, fit_on: Column | None) -> Column:
    base = df if fit_on is None else df.where(fit_on)
    ratio = fx.ratio_where_positive(roles.exposure, roles.size)
    return scalar_quantiles(base, {"median": (ratio, 0.5), "large": (F.col(roles.size), 0.75)})


def feature_stats(df: DataFrame, roles: Roles = MINE, fit_on: Column | None = None) -> dict[str, float]:
    """The two fitted numbers of ``build_features``, to be kept with a model."""
    row = df.sparkSession.range(1).select(_stats_column(df, roles, fit_on).alias("s")).select("s.*").first()
    return row.asDict()


def build_features(
    df: DataFrame, roles: Roles = MINE, fit_on: Column | None = None, sep: str = " ", stats: Mapping[str, float] | None = None
) -> DataFrame:
    """All derived features on a cleaned table.

    The median and the 75th percentile come from all rows, or from the rows of
    ``fit_on`` (say the training part) to keep test rows out of them.  Both are
    one scalar subquery, so the result is a single plan.  New rows are built
    with the ``stats`` of the training table instead.
    """
    have = set(df.columns)
    ratio = fx.ratio_where_positive(roles.exposure, roles.size)
    if stats is None:
        fitted = _stats_column(df, roles, fit_on)
    else:
        fitted = F.struct(*[F.lit(stats[n]).cast("double").alias(n) for n in ("median", "large")])

    df = df.withColumns({"LOG_AVG_EMP_TOTAL": fx.log_plus_one(roles.size), "_stats": fitted})
    log_size = F.col("LOG_AVG_EMP_TOTAL")
    new: dict[str, Column] = {}
    for name, share in (
        ("EMP_X_UNDERGROUND", roles.underground),
        ("EMP_X_STRIP", roles.strip),
        ("EMP_X_SURFACE", roles.surface),
        ("EMP_X_MILL", roles.mill),
        ("EMP_X_OFFICE", roles.office),
    ):
        if share in have:
            new[name] = fx.interaction(log_size, share)
    if {roles.kind, roles.commodity} <= have:
        new["MINE_CHAR"] = fx.joined_levels(roles.kind, roles.commodity, sep=sep)
    new["AVG_EMP_TOTAL_SQ"] = fx.square(roles.size)
    new["HRS_PER_EMP"] = F.coalesce(ratio, F.col("_stats.median"))
    terms = [(getattr(roles, r), w) for r, w in RISK_WEIGHTS.items() if getattr(roles, r) in have]
    new["RISK_SCORE"] = fx.weighted_score(terms, log_size) if terms else F.lit(0.0)
    if roles.underground in have:
        new["HIGH_UNDERGROUND"] = fx.exceeds(roles.underground, UNDERGROUND_LIMIT)
    new["LARGE_OPERATION"] = fx.exceeds(roles.size, F.col("_stats.large"))
    if roles.office in have:
        new["HIGH_OFFICE_HRS"] = fx.exceeds(roles.office, OFFICE_LIMIT)
    return df.withColumns(new).drop("_stats")
