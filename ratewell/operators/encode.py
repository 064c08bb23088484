"""Fit-and-transform encoders: drop-first indicators, population scaling, label flags.

``Preprocessor.fit`` runs two aggregations (moments; levels and labels) and
returns a ``PipelineModel`` of built-in stages, so transforming
stays in the JVM and saving needs no code of ours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import features as fx
from ..roles import MINE, Roles

MAX_LEVELS = 10_000


def feature_groups(df: DataFrame, roles: Roles = MINE) -> dict[str, list[str]]:
    """Text, numeric and multi-label columns of a feature table, from its schema.

    Target, rate and exposure are no features; other columns (key, part) are
    dropped by the caller.
    """
    out: dict[str, list[str]] = {"categorical": [], "numeric": [], "labels": []}
    skip = {roles.count, roles.rate, roles.exposure}
    for f in df.schema.fields:
        if f.name == roles.labels:
            out["labels"].append(f.name)
        elif isinstance(f.dataType, StringType):
            out["categorical"].append(f.name)
        elif isinstance(f.dataType, NumericType) and f.name not in skip:
            out["numeric"].append(f.name)
    return out


def _bounded(rows: list, what: str, limit: int) -> list:
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}; such a column is no category")
    return rows


def _tagged(name: str):
    return lambda v: F.struct(F.lit(name).alias("c"), v.alias("v"))


def value_counts(df: DataFrame, columns: Sequence[str], labels: Sequence[str] = (), sep: str = ", ", max_levels: int | None = None) -> dict[str, dict[str, int]]:
    """Rows per value of each text column and per label of each multi-label column: one pass.

    A column with more than ``max_levels`` values (``MAX_LEVELS`` unless given) is refused, not cut.
    """
    return _profile(df, columns, labels, (), sep, max_levels)[0] if columns or labels else {}


def _profile(
    df: DataFrame, columns: Sequence[str], labels: Sequence[str], numbers: Sequence[str], sep: str = ", ", max_levels: int | None = None
) -> tuple[dict[str, dict[str, int]], dict[str, tuple[float, float]], int]:
    """Counts of values and labels, mean and population deviation of each number, and the rows.

    The numbers are one plain aggregate of the rows as they are; only values and labels are taken out of a row and grouped.
    """
    held = [F.col(c).cast("double") for c in numbers]
    stats = [a(x).alias(f"{k}{i}") for i, x in enumerate(held) for k, a in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(F.count(F.lit(1)).alias("n"), *stats).first()
    moments = {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(numbers)}
    counts: dict[str, dict[str, int]] = {c: {} for c in [*columns, *labels]}
    if not counts:
        return counts, moments, row["n"]
    pairs = [F.array(F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c in columns]
    for c in labels:
        parts = F.coalesce(F.array_distinct(fx.label_array(c, sep)), F.array().cast("array<string>"))
        pairs.append(F.transform(parts, _tagged(c)))
    rows = df.select(F.explode(F.concat(*pairs)).alias("p")).select("p.*")
    kept = rows.where(F.col("v").isNotNull() & ~(F.col("c").isin(list(labels)) & (F.col("v") == "")))
    max_levels = MAX_LEVELS if max_levels is None else max_levels
    limit = max_levels * (len(columns) + len(labels))
    found = kept.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    for r in _bounded(found.limit(limit + 1).collect(), "levels", limit):
        counts[r["c"]][r["v"]] = r["n"]
    for c, levels in counts.items():
        _bounded(list(levels), f"levels of {c}", max_levels)
    return counts, moments, row["n"]


def fit_levels(df: DataFrame, columns: Sequence[str], max_levels: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values of each text column."""
    return {c: sorted(v) for c, v in value_counts(df, columns, max_levels=max_levels).items()}


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, one aggregate."""
    pairs = [(F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")) for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[x for p in pairs for x in p]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(columns)}


def fit_labels(df: DataFrame, column: str, sep: str = ", ") -> list[str]:
    """Labels carried by some rows but not by all: a constant flag says nothing."""
    counts, _, rows = _profile(df, [], [column], [], sep)
    return _varying(counts[column], rows)


def _varying(counts: Mapping[str, int], rows: int) -> list[str]:
    return sorted(v for v, n in counts.items() if n < rows)


def scale(column: str, mean: float, deviation: float) -> Column:
    """Centred and divided by the population deviation; a constant column becomes 0."""
    return (F.col(column) - F.lit(mean)) / F.lit(deviation if deviation > 0 else 1.0)


def scale_columns(df: DataFrame, moments: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scale(c, m, s) for c, (m, s) in moments.items()})


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Indicator per level but the first; unknown values are all zeros."""
    new = {f"{c}_{v}": fx.level_flag(c, v) for c, vs in levels.items() for v in vs[1:]}
    return df.withColumns(new) if new else df


def dummies(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Indicators in place of the text columns."""
    return one_hot(df, levels).drop(*levels)


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class FittedPreprocessor:
    """Fitted stages with the ordered feature names."""

    pipeline: PipelineModel
    names: list[str]
    output: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(df)
        attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(self.names)]}, "num_attrs": len(self.names)}}
        out = out.drop(*[f"x_{i}" for i in range(len(self.names))])
        return out.withMetadata(self.output, attrs)

    def expand(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``transform`` with the features as columns of these names: no vector is made and taken apart again.

        Missing values raise, as they do there.
        """
        (first, *_), own = self.pipeline.stages, df.columns
        checked = []
        for i, (name, out) in enumerate(zip(self.names, columns, strict=True)):
            x = F.col(f"x_{i}")
            bad = F.raise_error(F.lit(f"feature {name} is missing in a row")).cast("double")
            checked.append(F.when(x.isNull() | F.isnan(x), bad).otherwise(x).alias(out))
        return first.transform(df).select(*[F.col(f"`{c}`") for c in own], *checked)

    def names_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.names)), "index int, name string")

    def save(self, path: str) -> None:
        """Stages and names side by side below ``path``."""
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{path}/stages")
        self.names_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/names")

    @classmethod
    def load(cls, path: str) -> "FittedPreprocessor":
        spark = SparkSession.active()
        names = [r["name"] for r in spark.read.parquet(f"{path}/names").orderBy("index").collect()]
        return cls(PipelineModel.load(f"{path}/stages"), names)


@dataclass
class Preprocessor:
    """Indicators of text columns, scaled numbers and label flags in one vector.

    Bad rows (nulls in numbers) raise while transforming; split them off with
    ``operators.clean.split_valid`` first.
    """

    categorical: Sequence[str] = ()
    numeric: Sequence[str] = ()
    labels: Sequence[str] = ()
    sep: str = ", "
    scale: bool = True
    output: str = "features"
    levels: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> FittedPreprocessor:
        counts, moments, size = _profile(df, list(self.categorical), list(self.labels), list(self.numeric) if self.scale else [], self.sep)
        self.levels = {c: sorted(counts[c]) for c in self.categorical}
        if not self.scale:
            moments = {c: (0.0, 1.0) for c in self.numeric}
        exprs: list[str] = []
        names: list[str] = []
        for c in self.categorical:
            for v in self.levels[c][1:]:
                exprs.append(f"CAST(coalesce(`{c}` = {_text(v)}, false) AS DOUBLE)")
                names.append(f"{c}_{v}")
        for c in self.numeric:
            mean, deviation = moments[c]
            exprs.append(f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {(deviation if deviation > 0 else 1.0)!r}D")
            names.append(c)
        for c in self.labels:
            for v in _varying(counts[c], size):
                pattern = _text("\\Q" + self.sep + "\\E")
                exprs.append(f"CAST(coalesce(array_contains(split(`{c}`, {pattern}), {_text(v)}), false) AS DOUBLE)")
                names.append(f"{c}_{v}")
        if len(set(names)) != len(names):
            raise ValueError("two features have the same name")
        columns = [f"x_{i}" for i in range(len(exprs))]
        select = ", ".join(f"{e} AS {c}" for e, c in zip(exprs, columns))
        stages = [
            SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
            VectorAssembler(inputCols=columns, outputCol=self.output, handleInvalid="error"),
        ]
        return FittedPreprocessor(PipelineModel(stages), names, self.output)
