"""Summaries: every aggregate has map-side partials, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..roles import MINE, Roles
from . import ranking
from .relational import salted_lookup

# Upper bounds of the latency buckets in seconds.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, nulls, mean, sample deviation, extremes and exact quartiles per column."""
    by = list(by)
    long = ranking.melt(df, columns, by)
    keys = [*by, "name"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = ranking.quantiles(long, "value", (0.25, 0.5, 0.75), keys)
    right = quartiles.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "p25", "p50", "p75")
    on = F.lit(True)
    for k in keys:
        on = on & moments[k].eqNullSafe(right[f"_k_{k}"])
    return moments.join(right, on, "left").drop(*[f"_k_{k}" for k in keys])


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value; ``n`` keeps the top."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))
    return counts if n is None else counts.limit(n)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"{c}_distinct") for c in columns])


def basic_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    c = F.col(column)
    return df.groupBy(*by).agg(
        F.count(c).alias("n"),
        F.sum(c).alias("sum"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def group_mean(df: DataFrame, group: str, value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias(out)).orderBy(F.desc(out), F.asc(group))


def crosstab(df: DataFrame, left: str, right: str) -> DataFrame:
    """Long two-way table of counts."""
    return df.groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, left: str, right: str, levels: Sequence[object]) -> DataFrame:
    """Two-way table with one column per given level, 0 where no row falls."""
    wide = df.groupBy(left).pivot(right, list(levels)).agg(F.count(F.lit(1)))
    return wide.na.fill(0, [str(v) for v in levels])


def share_where(df: DataFrame, group: str, condition: Column, out: str = "share") -> DataFrame:
    """Part of each group's rows that meet the condition."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias(out)
    )


def rate_by(df: DataFrame, groups: Sequence[str], roles: Roles = MINE) -> DataFrame:
    """Events, exposure and events per unit of exposure for each group."""
    events, hours = F.sum(roles.count), F.sum(roles.exposure)
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("entities"),
        events.alias("events"),
        hours.alias("exposure"),
        F.try_divide(events * F.lit(roles.unit), hours).alias("rate"),
    )


def count_classes(df: DataFrame, column: str) -> DataFrame:
    """Rows at 0, 1, 2 and at least 3."""
    c = F.col(column)
    return df.agg(
        F.count_if(c == 0).alias("zero"),
        F.count_if(c == 1).alias("one"),
        F.count_if(c == 2).alias("two"),
        F.count_if(c >= 3).alias("three_or_more"),
    )


def null_count(df: DataFrame, column: Column | str) -> DataFrame:
    c = F.col(column) if isinstance(column, str) else column
    return df.agg(F.count_if(c.isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, column: str, classes: int | None = None) -> DataFrame:
    """Rows per class; with ``classes`` given, empty ones are listed with 0."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if classes is None:
        return counts
    grid = df.sparkSession.range(classes).select(F.col("id").cast("int").alias(column))
    return grid.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def smallest_class(df: DataFrame, column: str) -> DataFrame:
    return class_distribution(df, column).agg(F.min("n").alias("smallest"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the column's range; the last one is closed on both sides."""
    c = F.col(column)
    span = df.agg(F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias("s")).scalar()
    ranged = df.where(c.isNotNull()).select(c.cast("double").alias("_x")).withColumn("_s", span)
    width = (F.col("_s.high") - F.col("_s.low")).cast("double") / F.lit(float(bins))
    place = F.when(width > 0, F.floor((F.col("_x") - F.col("_s.low")) / width)).otherwise(F.lit(0))
    counts = ranged.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = grid.join(counts, "bin", "left").withColumn("_s", span)
    return filled.select(
        "bin",
        (F.col("_s.low") + F.col("bin") * width).cast("double").alias("low"),
        (F.col("_s.low") + (F.col("bin") + 1) * width).cast("double").alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def box_stats(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and outlier count per group.

    Works on the counts per distinct value, not on the rows.
    """
    counts = ranking.cumulative_counts(df, value, [group])
    boxes = ranking.quantiles_of_counts(counts, value, (0.25, 0.5, 0.75), [group])
    spread = F.col("p75") - F.col("p25")
    boxes = boxes.select(
        group,
        "p25",
        "p50",
        "p75",
        (F.col("p25") - spread * F.lit(reach)).alias("_low"),
        (F.col("p75") + spread * F.lit(reach)).alias("_high"),
    )
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    return (
        salted_lookup(counts, boxes, group, F.col(value))
        .groupBy(group)
        .agg(
            F.sum("n").alias("n"),
            F.first("p25").alias("p25"),
            F.first("p50").alias("p50"),
            F.first("p75").alias("p75"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def log_log_cells(df: DataFrame, x: str, y: str, cell: float = 0.25) -> DataFrame:
    """Points of a log-log scatter thinned to a grid, with the rows of every cell."""
    spots = df.where((F.col(x) > 0) & (F.col(y) > 0)).select(
        F.floor(F.ln(x) / F.lit(cell)).cast("bigint").alias("x_cell"),
        F.floor(F.ln(y) / F.lit(cell)).cast("bigint").alias("y_cell"),
    )
    return spots.groupBy("x_cell", "y_cell").agg(F.count(F.lit(1)).alias("n"))


def marker_size(weight: Column | str, scale: float = 10.0) -> Column:
    """Drawing size of a scored row."""
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.log1p(w) * F.lit(scale)


def usage_counts(log: DataFrame, version: str, known: Sequence[str] = ()) -> DataFrame:
    """Predictions per model version; known versions without any get 0."""
    counts = log.groupBy(F.col(version).cast("string").alias("version")).agg(F.count(F.lit(1)).alias("n"))
    if not known:
        return counts
    zero = log.sparkSession.createDataFrame([(v, 0) for v in known], "version string, n bigint")
    return counts.unionByName(zero).groupBy("version").agg(F.sum("n").alias("n"))


def latency_aggregates(latency: Column, bounds: Sequence[float] = LATENCY_BOUNDS) -> list[Column]:
    """Cumulative bucket counts, total count and sum of one latency column."""
    buckets = [F.count_if(latency <= F.lit(b)).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return [*buckets, F.count(latency).alias("n"), F.sum(latency).alias("total")]


def latency_long(wide: DataFrame, keys: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """One row per bucket (the last is +Inf) with the key's sum and count."""
    pairs = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"le_{i}").alias("c")) for i, b in enumerate(bounds)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("n").alias("c")))
    return wide.select(*keys, F.explode(F.array(*pairs)).alias("p"), "n", "total").select(
        *keys, F.col("p.le").alias("le"), F.col("p.c").alias("cumulative"), "n", "total"
    )


def latency_histogram(log: DataFrame, version: str, latency: Column | str) -> DataFrame:
    lat = F.col(latency) if isinstance(latency, str) else latency
    return latency_long(log.groupBy(version).agg(*latency_aggregates(lat)), [version])
