"""Quality by regularised quadratic discriminant analysis of document statistics.

Statistics of whole texts are made by one pass over the bytes and transformed
to be nearer to normal.  Sums and cross products per class are added up in the tasks and
by a shuffle, so the driver sees two small matrices however many labels there are.  A
class covariance is shrunk towards the pooled one and then towards its diagonal.  A
score is the logistic of the difference of the class log-densities (Mahalanobis distances by
Cholesky factors that are computed once and go to the tasks with their code) and log-priors.

Defined cases: null, empty and blank texts have statistics, too, and get a score;
labels without id or value and held-out rows are not learnt from; of repeated rows each
counts; a class without labelled rows leaves the share of the other as the score of all
texts, and 0.5 stands where there are no labels at all.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from . import words
from .shared import free_name, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Part of a class covariance taken from the pooled one, and part taken from its diagonal.
TO_POOLED, TO_DIAGONAL = 0.7, 0.1
#: Added to variances of standardised statistics.
FLOOR = 1e-3

STATISTICS = (
    "words", "word_length", "word_length_spread", "distinct", "distinct_pairs", "repeats", "most_common",
    "upper", "marks", "symbols", "symbol_ends", "digits", "lines", "stops",
)

# Classes of bytes.  Bytes within a character beyond ASCII count as letters once.
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
STOP = np.zeros(256, bool)
STOP[[0x2E, 0x21, 0x3F]] = True
MARK = np.zeros(256, bool)
MARK[[0x2C, 0x2E, 0x3A, 0x3B, 0x27, 0x2D, 0x28, 0x29, 0x22]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[0x21:0x30] = SYMBOL[0x3A:0x41] = SYMBOL[0x5B:0x61] = SYMBOL[0x7B:0x7F] = True
SYMBOL &= ~MARK
FIRST = np.ones(256, bool)
FIRST[0x80:0xC0] = False
# As words lower-cases its chunks, capitals are looked up in the bytes as they came.


def _share(part, whole, least: float = 1.0):
    """Log odds of a share, both sides raised by a little so that short texts stay near the middle."""
    return np.log((part + least) / (np.maximum(whole - part, 0) + least))


def statistics(column: pa.Array) -> np.ndarray:
    """One line of transformed statistics per text."""
    out = np.zeros((len(column), len(STATISTICS)))
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).fill_null("")
    for first, last, low, at in words.chunks(column):
        raw = _raw(column, first, last)
        sums = lambda mask: _sums(mask, at)
        starts, ends, head = words.spans(low, at, words.SPACED)
        hashed = words.hashes(low, starts, ends)
        n = np.diff(head).astype(float)
        chars = np.concatenate(([0], np.cumsum(words_first(low))))
        length = (chars[ends] - chars[starts]).astype(float)
        long, square = _sums(length, head), _sums(length * length, head)
        mean = long / np.maximum(n, 1)
        spread = np.sqrt(np.maximum(square / np.maximum(n, 1) - mean * mean, 0))
        same = np.zeros(len(hashed))
        same[1:] = hashed[1:] == hashed[:-1]
        same[head[:-1][n > 0]] = 0
        odd_end = SYMBOL[low[ends - 1]].astype(float) if len(ends) else np.zeros(0)
        distinct, pairs, most = np.zeros(last - first), np.zeros(last - first), np.zeros(last - first)
        for i in range(last - first):
            own = hashed[head[i] : head[i + 1]]
            if len(own):
                ordered = np.sort(own)
                cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
                distinct[i], most[i] = len(cuts) - 1, np.diff(cuts).max()
            if len(own) > 1:
                pairs[i] = len(np.unique(own[1:] * np.uint64(words.PRIME) + own[:-1]))
        visible = np.maximum(long, 0)
        out[first:last] = np.stack(
            [
                np.log1p(n), np.log1p(mean), np.log1p(spread), _share(n - distinct, n), _share(np.maximum(n - 1, 0) - pairs, np.maximum(n - 1, 0)),
                _share(_sums(same, head), n), _share(most, n, 2.0), _share(sums(UPPER[raw]), visible, 4.0), _share(sums(MARK[low]), visible, 4.0),
                _share(sums(SYMBOL[low]), visible), _share(_sums(odd_end, head), n), _share(sums(DIGIT[low]), visible), _share(sums(low == 10), n), _share(sums(STOP[low]), n),
            ],
            axis=1,
        )
    return out


def words_first(data: np.ndarray) -> np.ndarray:
    return FIRST[data].astype(np.int64)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[at[1:]] - total[at[:-1]]


def _raw(column: pa.Array, first: int, last: int) -> np.ndarray:
    part = column.slice(first, last - first).cast(pa.large_string())
    at = np.frombuffer(part.buffers()[1], dtype=np.int64, count=len(part) + part.offset + 1)[part.offset :]
    return np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]


def _listed(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(STATISTICS), dtype=np.int32)), pa.array(values.ravel()))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and statistics of every text."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _listed(statistics(batch.column(1)))], names=["id", "x"])

    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    return rows.mapInArrow(run, rows.select("id").schema.add("x", T.ArrayType(T.DoubleType())))


@dataclass
class Discriminant:
    """Centre and scale of the statistics; per class mean, inverse Cholesky factor, log determinant and log prior."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        x = (x - self.centre) / self.scale
        dens = [o - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, o in zip(self.means, self.factors, self.offsets, strict=True)]
        return 1 / (1 + np.exp(-np.clip(dens[1] - dens[0], -35, 35)))


def held_out(id_col: str):
    """Rows that no label may be learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant:
    """Fitted on all rows with a label 0 or 1, but for the held-out ones."""
    usable = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    rows = stats.join(usable.where(~held_out("id")), "id").select("label", "x")
    d = len(STATISTICS)

    def moments(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            for c in (0, 1):
                own = x[label == c]
                total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        at = np.arange(total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], len(at)).astype(np.int32)), pa.array(np.tile(at, 2).astype(np.int32)), pa.array(total.ravel())], names=["label", "at", "v"])

    sums = rows.mapInArrow(moments, "label int, at int, v double").groupBy("label", "at").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros((2, 1 + d + d * d))
    total[sums.column("label").to_numpy(), sums.column("at").to_numpy()] = sums.column("v").to_numpy()
    return discriminant(total)


def discriminant(total: np.ndarray) -> Discriminant:
    """The classifier from count, sums and cross products of both classes."""
    d = len(STATISTICS)
    n = total[:, 0]
    if not n.all():
        share = float(n[1] / n.sum()) if n.sum() else 0.5
        return Discriminant(np.zeros(d), np.ones(d), [], [], [], share)
    mean = total[:, 1 : d + 1] / n[:, None]
    cov = np.stack([total[c, d + 1 :].reshape(d, d) / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)])
    centre = total[:, 1 : d + 1].sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.einsum("cii->ci", cov).T @ (n / n.sum()) + ((mean - centre) ** 2).T @ (n / n.sum()), 1e-12))
    mean = (mean - centre) / scale
    cov = cov / np.outer(scale, scale)
    pooled = (cov * (n / n.sum())[:, None, None]).sum(axis=0)
    factors, offsets = [], []
    for c in (0, 1):
        s = (1 - TO_POOLED) * cov[c] + TO_POOLED * pooled
        s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.diag(s)) + FLOOR * np.eye(d)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        offsets.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(low)).sum()))
    return Discriminant(centre, scale, list(mean), factors, offsets)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """id and `score`, the chance of the label 1, of every row of statistics."""
    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["id", "score"])

    return stats.select("id", "x").mapInArrow(run, stats.select("id").schema.add("score", "double"))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row; statistics are computed once and kept in the shared folder."""
    stats = written(measured(docs, id_col, text_col), "statistics")
    return score(stats, fit(stats, labels, id_col))


def keep_good(docs: DataFrame, labels: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with a score of at least `least`, with all columns.

    Rows are written with their statistics beside them, so that each text is read by Python
    once and the decision needs no join: the model fitted on them is applied to the written rows.
    """
    x = free_name(docs, "statistics")

    @F.arrow_udf("array<double>")
    def beside(texts: pa.Array) -> pa.Array:
        return _listed(statistics(texts))

    rows = written(docs.withColumn(x, beside(docs[f"`{text_col}`"])), "statistics")
    model = fit(rows.select(rows[f"`{id_col}`"].alias("id"), rows[x].alias("x")), labels, id_col)
    @F.arrow_udf("double")
    def chance(x: pa.Array) -> pa.Array:
        return pa.array(model.score(np.asarray(x.flatten()).reshape(-1, len(STATISTICS))))

    return rows.where(chance(rows[x]) >= least).select([rows[f"`{c}`"] for c in docs.columns])
