"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Labelled texts become lists of hashed features: words, pairs of neighbours and
pairs with one word between.  They are dealt to shards of bounded size; each
shard runs FTRL-proximal with a rate per coordinate and L1 some times over its rows.
A coordinate's state is then the mean over the shards in which it occurred, so rare
features are not thinned out.  Means are taken on the cluster; only the weights that L1
leaves, a sparse vector, come to the driver and are broadcast to score all texts.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from . import words
from .shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASH_BITS = 22
ALPHA, BETA, L1, L2 = 1.5, 1.0, 3.0, 0.0
PASSES = 2
#: Labelled rows that the model is fitted on at most, the first in the order of a hash of their id.
MOST_LABELS = 30_000
SHARD_ROWS = 6_000


def features(hashed: np.ndarray) -> np.ndarray:
    """Distinct coordinates of a text's words, neighbouring pairs and pairs with one word between."""
    parts = [words.mixed(hashed + np.uint64(1))]
    for gap in (1, 2):
        if len(hashed) > gap:
            parts.append(words.mixed(hashed[:-gap] * np.uint64(words.PRIME) + hashed[gap:] + np.uint64(gap + 1)))
    return np.unique((np.concatenate(parts) >> np.uint64(64 - HASH_BITS)).astype(np.int32))


def texts_features(column: pa.Array):
    for first, last, data, at in words.chunks(column):
        hashed, start = words.word_hashes(data, at, words.PLAIN)
        for i in range(last - first):
            yield features(hashed[start[i] : start[i + 1]])


class Ftrl:
    """State per coordinate: z (gradients less what the weights took up) and n (squared gradients)."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
        self.seen = np.zeros(1 << HASH_BITS, dtype=bool)

    def learn(self, at: np.ndarray, label: float) -> None:
        """One row; coordinate 0 is the bias that every row has."""
        at = at if len(at) and at[0] == 0 else np.concatenate((np.zeros(1, at.dtype), at))
        w = weights(self.z[at], self.n[at])
        g = chance(w.sum()) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / ALPHA * w
        self.seen[at] = True


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def chance(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -35.0), 35.0)))


def held_out(id_col: str):
    """Rows that no label may be learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_LABELS) -> np.ndarray:
    """Weights of all coordinates, learnt from at most `most` labelled rows.

    Rows without id or label, and held-out rows, are not learnt from.  Without any
    labelled row all weights are 0.  A label for a repeated id counts for each of its different texts, once for
    each; shards are dealt by id and text, so an id on very many rows is spread over all of them.
    """
    usable = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).where("id is not null and label is not null")
    chosen = written(usable.where(~held_out("id")).orderBy(F.xxhash64("id"), "id").limit(most), "labelled")
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.select("label", F.xxhash64("id", "text", F.lit(7)).alias("same"), F.xxhash64("id", "text", F.lit(11)).alias("turn"), "text")

    def listed(batches):
        met = set()  # rows of this task, so that copies of one row do not travel
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            fresh = [i for i, key in enumerate(keys) if key not in met and not met.add(key)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            lists, first, size = [], 0, 0
            for i, own in enumerate(texts_features(batch.column(3))):
                lists.append(own)
                size += len(own)
                if size > 1 << 18 or i + 1 == batch.num_rows:
                    at = pa.array(np.cumsum([0] + [len(x) for x in lists]).astype(np.int32))
                    kept = [batch.column(k).slice(first, len(lists)) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(at, pa.array(np.concatenate(lists)))], names=["label", "same", "turn", "at"])
                    lists, first, size = [], i + 1, 0

    rows = written(rows.mapInArrow(listed, "label double, same bigint, turn bigint, at array<int>"), "toxic-features")
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("same", "turn"), F.lit(shards)).cast("int"))
    learnt = rows.groupBy("shard").applyInArrow(_learner(), "at int, z float, n float")
    mixed = learnt.groupBy("at").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).where(F.abs("z") > L1).toArrow()
    out = np.zeros(1 << HASH_BITS)
    out[mixed.column("at").to_numpy()] = weights(mixed.column("z").to_numpy(), mixed.column("n").to_numpy())
    return out


def _learner():
    def learnt(table: pa.Table) -> pa.Table:
        model = Ftrl()
        table = table.sort_by([("turn", "ascending"), ("same", "ascending"), ("label", "ascending")])
        turn, same, given = (table.column(c).to_numpy() for c in ("turn", "same", "label"))
        fresh = np.ones(len(turn), dtype=bool)  # copies of a row from several tasks count once
        fresh[1:] = (turn[1:] != turn[:-1]) | (same[1:] != same[:-1]) | (given[1:] != given[:-1])
        table = table.filter(pa.array(fresh))
        column, label = table.column("at").combine_chunks(), table.column("label").to_numpy()
        flat, cut = np.asarray(column.values), np.asarray(column.offsets)
        for _ in range(PASSES):
            for i in range(len(label)):
                model.learn(flat[cut[i] : cut[i + 1]], label[i])
        at = np.flatnonzero(model.seen)
        return pa.table({"at": at.astype(np.int32), "z": model.z[at].astype(np.float32), "n": model.n[at].astype(np.float32)})

    return learnt


def score(docs: DataFrame, learnt: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `score`, the chance of the label 1, of every text; null and empty texts get the bias alone."""
    there = np.flatnonzero(learnt)
    sparse = docs.sparkSession.sparkContext.broadcast((there, learnt[there].astype(np.float32)))

    def run(batches):
        dense = np.zeros(1 << HASH_BITS, dtype=np.float32)
        dense[sparse.value[0]] = sparse.value[1]
        for batch in batches:
            scores = [chance(float(dense[own].sum()) + (0.0 if len(own) and own[0] == 0 else float(dense[0]))) for own in texts_features(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=names)

    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    schema = docs.select(docs[f"`{id_col}`"].alias(id_col)).schema.add("score", "double")
    names = schema.names
    return rows.mapInArrow(run, schema)
