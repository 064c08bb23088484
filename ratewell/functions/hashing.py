"""Repeatable pseudo-random columns: the same on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["hash_text", "hash_unit"]


def hash_text(key: Column | str, seed: int | str) -> Column:
    """32 hex digits that depend on key and seed only."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def hash_unit(key: Column | str, seed: int | str) -> Column:
    """A number in [0, 1) from the first 32 bits of the hash."""
    return F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
