"""Repeatable splits and weights.

A row's part depends on its key and the seed alone, so it stays the same under
any partitioning, retry or engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.hashing import hash_text, hash_unit
from ..session import scratch_dir
from . import ranking

_CELL_DIGITS = 4


def random_split(df: DataFrame, key: str, fraction: float, seed: int = 0, out: str = "dataset", names=("train", "test")) -> DataFrame:
    """Each row goes to the first part with the given probability; no shuffle."""
    return df.withColumn(out, F.when(hash_unit(key, seed) < F.lit(float(fraction)), names[0]).otherwise(names[1]))


def stratified_split(
    df: DataFrame,
    key: str,
    stratum: Column,
    fraction: float,
    seed: int = 0,
    out: str = "dataset",
    names: Sequence[str] = ("train", "test"),
    rounding: str = "floor",
) -> DataFrame:
    """Exactly ``fraction`` of every stratum goes to the first part.

    The rows with the smallest hashes of a stratum are taken.  No stratum is
    sorted whole: rows are counted per hash prefix, only the rows of the one
    prefix in which the cut falls are ranked, and the hash at the cut becomes
    the stratum's threshold.  Finding the thresholds runs at once; the rows are
    then compared with them where they are.  The key must be unique.
    """
    tagged = df.withColumns({"_stratum": stratum, "_h": hash_text(key, seed)})
    cell = F.substring("_h", 1, _CELL_DIGITS)
    cells = tagged.groupBy("_stratum", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    running = W.partitionBy("_stratum").orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    wanted = F.sum("_n").over(W.partitionBy("_stratum")) * F.lit(float(fraction))
    wanted = F.ceil(wanted) if rounding == "ceil" else F.floor(wanted)
    cells = cells.select("*", F.sum("_n").over(running).alias("_to"), wanted.alias("_wanted"))
    cut = cells.where((F.col("_to") - F.col("_n") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_to"))).select(
        F.col("_stratum").alias("_s"), F.col("_cell").alias("_c"), (F.col("_wanted") - F.col("_to") + F.col("_n")).alias("_need")
    )
    narrow = tagged.select("_stratum", "_h")
    near = narrow.join(cut, narrow["_stratum"].eqNullSafe(cut["_s"]) & (F.substring("_h", 1, _CELL_DIGITS) == cut["_c"]))
    place = F.row_number().over(W.partitionBy("_s").orderBy("_h"))
    limits = near.withColumn("_place", place).where(F.col("_place") == F.col("_need")).select("_s", F.col("_h").alias("_limit"))
    # Stored, the thresholds are found once, and their size is known: only a small table is broadcast.
    path = scratch_dir(df.sparkSession, "split")
    limits.write.parquet(path)
    limits = df.sparkSession.read.parquet(path)
    first = F.coalesce(F.col("_h") <= F.col("_limit"), F.lit(False))
    joined = tagged.join(limits, tagged["_stratum"].eqNullSafe(limits["_s"]), "left")
    return joined.withColumn(out, F.when(first, names[0]).otherwise(names[1])).drop("_stratum", "_h", "_s", "_limit")


def with_quantile_group(df: DataFrame, column: str, edges: int = 5, out: str = "group") -> DataFrame:
    """Group number by evenly spaced quantiles of the column, right-closed; equal edges merge."""
    probs = [i / (edges - 1) for i in range(edges)]
    marks = ranking.scalar_quantiles(df, {f"q{i}": (F.col(column), p) for i, p in enumerate(probs)})
    above = F.lit(0)
    for i in range(edges - 1):
        above = above + (F.col(column) > F.col(f"_marks.q{i}")).cast("int")
    return df.withColumn("_marks", marks).withColumn(out, F.greatest(above, F.lit(1))).drop("_marks")


def quantile_stratified_split(
    df: DataFrame, key: str, column: str, fraction: float, edges: int = 5, seed: int = 0, out: str = "dataset", names=("train", "test")
) -> DataFrame:
    """Split that keeps the distribution of a numeric column: strata are its quantile groups."""
    grouped = with_quantile_group(df, column, edges, "_group")
    return stratified_split(grouped, key, F.col("_group"), fraction, seed, out, names, "ceil").drop("_group")


def apply_partition(df: DataFrame, train_keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows) of another table by a stored key set."""
    return df.join(train_keys, key, "left_semi"), df.join(train_keys, key, "left_anti")


def split_report(df: DataFrame, value: str, part: str = "dataset") -> DataFrame:
    """Rows, share of all rows and mean value per part, plus a total row."""
    counts = df.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("_sum"), F.count(value).alias("_c"))
    both = counts.unionByName(
        counts.agg(F.lit("total").alias(part), F.sum("n").alias("n"), F.sum("_sum").alias("_sum"), F.sum("_c").alias("_c"))
    )
    whole = counts.agg(F.sum("n").alias("n")).scalar()
    return both.select(
        part, "n", (F.col("n") * F.lit(100.0) / whole).alias("pct"), F.try_divide("_sum", "_c").alias("mean")
    )


def positives(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label) > 0)


def zero_share(df: DataFrame, label: str, part: str = "dataset") -> DataFrame:
    """Zero rows, other rows and the share of zeros per part."""
    zero = F.count_if(F.col(label) == 0)
    return df.groupBy(part).agg(
        zero.alias("zeros"),
        F.count_if(F.col(label) > 0).alias("nonzeros"),
        F.try_divide(zero.cast("double"), F.count(label)).alias("zero_share"),
    )
