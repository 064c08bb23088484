"""Exact deduplication with the frequent digests split off.

A summary of frequent items (Misra-Gries counters, Spark's ``approx_top_k``)
over the digests finds the few that may hold a large share of all rows.  Their
exact counts and winners are then computed with map-side partial sums, those
that really are frequent are broadcast (at most ``candidates`` rows), and their
rows are marked where they lie.  All other digests take an ordinary shuffle,
in which no group can hold more than about a ``1/candidates`` part of the rows.

Defined cases
-------------
* null text counts as the empty text; empty texts are equal to one another;
* texts are equal when identical after lower-casing A-Z only;
* of equal texts the row with the largest id stays; rows that repeat an id and
  its text are one document and share its fate;
* a null id is smaller than any other: such a row stays only if no row of its
  group has an id;
* an empty table gives an empty result; further columns are ignored by ``mark``
  and passed on by ``deduplicate``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window, functions as F

from .shared import written


def normalised(text: str = "text"):
    """The text with A-Z lower-cased and nothing else changed."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", candidates: int = 1024) -> DataFrame:
    """One row per document: its id, `keep_id`, `group_size`, `kept` and the digest `text_sha256`.

    `candidates` bounds the broadcast tables: fewer than that many digests can hold more
    than a 1/`candidates` part of the rows each, and with 16 counters for each of them the
    summary misses none.  A lighter candidate is left to the shuffle.
    """
    digests = written(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.sha2(normalised(f"`{text_col}`").cast("binary"), 256).alias("digest")), "digests"
    ).withColumn("key", F.xxhash64("digest"))
    summary = digests.agg(F.expr(f"approx_top_k(key, {int(candidates)}, {int(candidates) * 16})").alias("top"), F.count("*").alias("total"))
    suspects = summary.select("total", F.explode("top").alias("t")).select(F.col("t.item").alias("key"), "total")
    per_digest = (F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = (
        digests.join(F.broadcast(suspects), "key")
        .groupBy("digest", "total")
        .agg(*per_digest)
        .where((F.col("group_size") > 1) & (F.col("group_size") * candidates >= F.col("total")))
        .select("digest", "keep_id", "group_size")
    )
    winners = written(winners, "frequent-digests")
    heavy = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    same = Window.partitionBy("digest")
    rest = rest.select("*", F.max("id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size"))
    columns = ("id", "keep_id", "group_size", "digest")
    return heavy.select(*columns).unionAll(rest.select(*columns)).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows that stay, with all their columns; a row repeated as a whole is returned as often as it came."""
    stay = mark(docs, id_col, text_col, **settings).where("kept").select(F.col(id_col).alias("id of a row that stays")).distinct()
    return docs.join(stay, docs[f"`{id_col}`"].eqNullSafe(stay["id of a row that stays"]), "left_semi")
