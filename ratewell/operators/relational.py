"""Joins and set operations between rows, keys, groups and small state tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

MAX_GRID_LABELS = 10_000


def rows_in(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(keys, on, "left_semi")


def rows_not_in(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(keys, on, "left_anti")


def attach_metrics(versions: DataFrame, metrics: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Versions with one column per chosen metric, null where it was not logged."""
    wide = metrics.where(F.col("metric").isin(list(names))).groupBy(key).pivot("metric", list(names)).agg(F.max("value"))
    return versions.join(wide, key, "left")


def flag_active(versions: DataFrame, pointer: DataFrame, key: str = "version", out: str = "is_active") -> DataFrame:
    """True on the version the one-row pointer table names."""
    active = pointer.agg(F.max(F.col(key).cast("string")).alias("v")).scalar()
    return versions.withColumn(out, F.coalesce(F.col(key).cast("string") == active, F.lit(False)))


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """Stack tables by column name, each with its own tag."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("nothing to stack")
    return out


def distinct_union(df: DataFrame, columns: Sequence[str], out: str = "label") -> DataFrame:
    """All values that occur in any of the columns; each row gives its own once."""
    values = F.explode(F.array_distinct(F.array(*[F.col(c) for c in columns])))
    return df.select(values.alias(out)).distinct()


def overlay(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Entries of both tables; where both have the key, the right one counts."""
    a = left.select(*keys, F.col(value).alias("_left"))
    b = right.select(*keys, F.col(value).alias("_right"), F.lit(True).alias("_in_right"))
    joined = a.join(b, list(keys), "full_outer")
    return joined.select(*keys, F.when(F.col("_in_right"), F.col("_right")).otherwise(F.col("_left")).alias(value))


def exists(df: DataFrame, column: str, value: object) -> bool:
    return not df.where(F.col(column) == F.lit(value)).isEmpty()


def known_keys(df: DataFrame, known: DataFrame, key: str, out: str = "known") -> DataFrame:
    """Flag rows whose key is in the other table."""
    marks = known.select(key).distinct().withColumn("_mark", F.lit(True))
    return df.join(marks, key, "left").withColumn(out, F.coalesce("_mark", F.lit(False))).drop("_mark")


def attach_labels(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Labels joined by key, never by position."""
    return rows.join(labels, key)


def attach_names(values: DataFrame, names: DataFrame, index: str = "index") -> DataFrame:
    return values.join(names, index, "left")


def salted_lookup(rows: DataFrame, groups: DataFrame, key: str, spread: Column, salts: int = 32) -> DataFrame:
    """Join a one-row-per-key table to rows among which one key may be most of them.

    The rows of a key are spread over ``salts`` join keys and the key's single
    row is repeated for each, so no task gets a whole hot key, whatever a later
    grouping asks for.  Null keys meet null keys.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = groups.withColumnRenamed(key, "_lookup_key").withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col(key).eqNullSafe(F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt"))
    return left.join(right, on).drop("_salt", "_lookup_salt", "_lookup_key")


def counted_lookup(rows: DataFrame, groups: DataFrame, key: str, count: str, spread: Column, share: int = 1024, salts: int = 32) -> DataFrame:
    """Join a one-row-per-key table that holds each key's number of rows to those rows.

    At most ``share`` keys can have a 1/``share`` part of all rows each.  These are
    broadcast, and only their rows are spread over ``salts`` join keys; every other key's
    row travels once.  Null keys meet null keys.
    """
    groups = groups.withColumnRenamed(key, "_lookup_key")
    hot = F.col(count) * share >= groups.agg(F.sum(count)).scalar()
    heavy = F.broadcast(groups.where(hot).select(F.col("_lookup_key").alias("_hot_key"), F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    left = rows.join(heavy, F.col(key).eqNullSafe(F.col("_hot_key")), "left").withColumn("_salt", salt).drop("_hot", "_hot_key")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = groups.withColumn("_lookup_salt", F.explode(every)).drop(count)
    on = F.col(key).eqNullSafe(F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt"))
    return left.join(right, on).drop("_salt", "_lookup_salt", "_lookup_key")


def _label_list(labels: DataFrame, column: str, most: int) -> Column:
    """All labels as one array; the table has one row per label already."""
    listed = labels.limit(most + 1).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(column)).alias("v")).alias("s")
    )
    s = listed.scalar()
    too_many = F.raise_error(F.lit(f"a grid takes at most {most} labels a side"))
    kind = f"array<{labels.schema[column].dataType.simpleString()}>"
    return F.when(s.getField("n") > most, too_many.cast(kind)).otherwise(s.getField("v"))


def complete_grid(counts: DataFrame, left: str, right: str, value: str = "n", by: Sequence[str] = (), max_labels: int | None = None) -> DataFrame:
    """Counts for every pair of labels seen on either axis, 0 where none occurred.

    ``counts`` is already aggregated, so the label lists are as small as the
    grid's sides; a grid with more than ``max_labels`` labels a side (``MAX_GRID_LABELS`` unless given) raises, nothing is cut.
    """
    labels = distinct_union(counts, [left, right], "_label")
    axis = _label_list(labels, "_label", MAX_GRID_LABELS if max_labels is None else max_labels)
    groups = counts.select(*by).distinct() if by else counts.limit(1).select()
    grid = groups.select(*by, F.explode(axis).alias(left)).select("*", F.explode(axis).alias(right))
    keys = [*by, left, right]
    return grid.join(counts.select(*keys, value), keys, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(0).cast("bigint"))
    )
