"""Order statistics without one giant partition or one giant buffer.

Spark's exact ``percentile`` gathers all distinct values of a group in one
buffer, and an unpartitioned window sorts a whole table in one task.  Here the
rows are first counted per distinct value, so a hot value becomes one row.  The
distinct values are then cut into many ordered buckets at sketched edges,
running totals are taken inside each bucket and shifted by the totals of the
buckets before it.  The sketch only decides where the cuts are: results are
exact whatever it returns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.measures import sketched_quantiles
from .relational import counted_lookup

BUCKETS = 1024
_STEPS = [2**i for i in range(10, -1, -1)]


def _edges_at_most(value: Column, edges: Column) -> Column:
    """How many edges are not above the value, by bisection over the array."""
    return F.aggregate(
        F.array(*[F.lit(s) for s in _STEPS]),
        F.lit(0),
        lambda low, step: F.when(F.get(edges, low + step - 1) <= value, low + step).otherwise(low),
    )


def cumulative_counts(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    weights: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per distinct value of each group, with running totals.

    Columns: ``by``, ``value``, ``n`` rows, ``n_to`` rows up to and including
    the value, ``n_all`` rows of the group; and ``<w>``, ``<w>_to``, ``<w>_all``
    for every extra summed weight.  Null values are left out.
    """
    by = list(by)
    weights = dict(weights or {})
    sums = ["n", *weights]
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(w) for w, c in weights.items()])
    )
    sketch = counts.agg(
        F.struct(
            sketched_quantiles(value, BUCKETS, 20 * BUCKETS).alias("edges"),
            *[F.sum(s).alias(f"all_{s}") for s in sums],
        ).alias("s")
    ).scalar()
    # The totals are read too, so that the sketch is made of the very shuffle the counts come from.
    cut = counts.withColumn("_s", sketch)
    bucket = F.when(F.col("_s.all_n") > 0, _edges_at_most(F.col(value), F.col("_s.edges"))).otherwise(F.lit(0))
    for s in sums[1:]:
        bucket = F.when(F.col(f"_s.all_{s}").isNotNull(), bucket).otherwise(F.lit(0))
    # Never null, so that the join adds no null filter with the sketch in it below the counts.
    bucket = F.coalesce(bucket, F.lit(0))
    # One key for all group columns: equal for nulls too, and the same for window and join.
    group = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    cut = cut.select(*by, value, *sums, group.alias("_group"), bucket.alias("_bucket"))

    totals = cut.groupBy("_group", "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    in_order = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("_group")
    totals = totals.select(
        F.col("_group").alias("_k_group"),
        F.col("_bucket").alias("_k_bucket"),
        *[(F.sum(f"_t_{s}").over(in_order) - F.col(f"_t_{s}")).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"{s}_all") for s in sums],
    )
    inside = W.partitionBy("_group", "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    running = cut.select("*", *[F.sum(s).over(inside).alias(f"_i_{s}") for s in sums])
    joined = running.join(totals, (F.col("_group") == F.col("_k_group")) & (F.col("_bucket") == F.col("_k_bucket")))
    out = [*by, value]
    for s in sums:
        out += [F.col(s), (F.col(f"_i_{s}") + F.col(f"_o_{s}")).alias(f"{s}_to"), F.col(f"{s}_all")]
    return joined.select(*out)


def row_numbers(df: DataFrame, value: str, tie: str, out: str = "number") -> DataFrame:
    """Number of every row in the order of a numeric column, then of ``tie``; from 1, without gaps."""
    # Ranges of (value, tie) cut through a value that many rows share; a row's number is its place in
    # its range and the rows of the ranges before.
    rows = df.where(F.col(value).isNotNull()).repartitionByRange(value, tie).sortWithinPartitions(value, tie)
    rows = rows.withColumn("_place", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
    rows = rows.withColumn("_range", F.shiftright("_place", 33))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_place") - F.shiftleft(F.col("_range"), 33) + 1
    return rows.join(starts, "_range").withColumn(out, number.cast("bigint")).select(*df.columns, out)


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group."""
    return quantiles_of_counts(cumulative_counts(df, value, by), value, probs, by)


def quantiles_of_counts(counts: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from a table made by ``cumulative_counts``."""

    def pick(rank: Column) -> Column:
        holds = (F.col("n_to") - F.col("n") <= rank) & (rank < F.col("n_to"))
        return F.max(F.when(holds, F.col(value)))

    aggregates = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n_all") - 1)
        aggregates += [
            pick(F.floor(position)).alias(f"_lo{i}"),
            pick(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_f{i}"),
        ]
    picked = counts.groupBy(*by).agg(*aggregates)
    return picked.select(
        *by,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(quantile_name(p))
            for i, p in enumerate(probs)
        ],
    )


def melt(df: DataFrame, columns: Mapping[str, Column] | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep…, name, value) of several numeric columns."""
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in columns.items()])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.name", "_p.value")


def scalar_quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, float]]) -> Column:
    """One struct of exact quantiles of several expressions, as a scalar subquery.

    ``wanted`` maps a field name to (expression, probability).
    """
    long = melt(df, {name: col for name, (col, _) in wanted.items()})
    table = quantiles(long, "value", sorted({p for _, p in wanted.values()}), ["name"])
    return table.agg(
        F.struct(
            *[
                F.max(F.when(F.col("name") == name, F.col(quantile_name(p)))).alias(name)
                for name, (_, p) in wanted.items()
            ]
        ).alias("q")
    ).scalar()


def percent_rank_average(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "percentile") -> DataFrame:
    """Rank within the group over its size; tied rows share the mean of their ranks."""
    key = F.struct(*[F.col(c) for c in (*by, value)])
    ranks = cumulative_counts(df, value, by).select(
        key.alias("_tied"), F.col("n").alias("_n"), ((F.col("n_to") - F.col("n") + (F.col("n") + 1) / 2) / F.col("n_all")).alias(out)
    )
    # Rows of a value that many share are spread over tasks, and rows without value stay out of the lookup.
    rows = df.withColumn("_tied", key)
    ranked = counted_lookup(rows.where(F.col(value).isNotNull()), ranks, "_tied", "_n", F.struct(*df.columns))
    missing = rows.where(F.col(value).isNull()).withColumn(out, F.lit(None).cast("double"))
    return ranked.select(*df.columns, out).unionByName(missing.select(*df.columns, out))


def flag_above_quantile(df: DataFrame, value: str, p: float, out: str) -> DataFrame:
    """1 where the value is above the exact quantile of the whole column."""
    limit = scalar_quantiles(df, {"limit": (F.col(value), p)})
    return df.withColumn(out, (F.col(value) > limit.getField("limit")).cast("int"))


def top_groups(df: DataFrame, group: str, order: Column, n: int) -> DataFrame:
    """The first ``n`` groups by an aggregate; ties by group name."""
    return df.groupBy(group).agg(order.alias("_o")).orderBy(F.desc("_o"), F.asc(group)).limit(n).select(group)


def keep_top_groups(df: DataFrame, group: str, order: Column, n: int) -> DataFrame:
    """Rows of the first ``n`` groups by an aggregate."""
    return df.join(top_groups(df, group, order, n), group, "left_semi")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns, aggregated map-side first."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)
