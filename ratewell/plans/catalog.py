"""All registered queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..operators.summary import rate_by
from . import cleaning, encoding, evaluation, features, modelling, serving, splitting, streams, summaries, tables
from .base import Registry, clean, r6

MODULES = (tables, cleaning, features, encoding, splitting, summaries, evaluation, modelling, serving, streams)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = rate_by(clean(spark, sf_dir), ["COMMODITY", "YEAR"])
    return rates.withColumn("rate", r6("rate"))


@lru_cache(maxsize=1)
def registry() -> Registry:
    reg = Registry()
    for module in MODULES:
        module.register(reg)
    return reg
