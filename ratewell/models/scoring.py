"""Batch scoring of requests: check, shape, predict; bad rows go to a reject table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import clean as cl


@dataclass
class ColumnModel:
    """A fixed formula used as a model."""

    value: Column

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.value)


@dataclass
class Scorer:
    """Scores request rows with any model that has ``predict(df, out)``.

    ``prepare`` shapes valid rows into what the model takes; a request that
    fails the checks is never scored as zeros.
    """

    model: object
    version: str = "local"
    required: Mapping[str, str] = field(default_factory=lambda: dict(cl.REQUEST_FIELDS))
    prepare: Callable[[DataFrame], DataFrame] = cl.apply_aliases
    entity: str = "MINE_ID"

    def split(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        return cl.split_valid(requests, self.required)

    def score(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(scored rows, rejected rows with reasons)."""
        good, bad = self.split(requests)
        scored = self.model.predict(self.prepare(good), "predicted_injury_rate")
        return scored.withColumn("model_version", F.lit(self.version)), bad

    def outcomes(self, requests: DataFrame) -> DataFrame:
        """Both results in one table: prediction or reasons per request."""
        scored, bad = self.score(requests)
        a = scored.select(F.col(self.entity).cast("string").alias("mine_id"), "predicted_injury_rate", F.lit(None).cast("string").alias("reasons"))
        b = bad.select(F.col(self.entity).cast("string").alias("mine_id"), F.lit(None).cast("double").alias("predicted_injury_rate"), F.concat_ws("; ", "errors").alias("reasons"))
        return a.unionByName(b).withColumn("model_version", F.lit(self.version))
