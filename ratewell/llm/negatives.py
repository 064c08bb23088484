"""Hard negatives by inner product, with coordinate pruning in length buckets.

Rows are stored in descending order of their length.  A task cuts what it reads into
buckets of similar length and keeps for each bucket sorted lists of the coordinates of
its unit vectors.  An anchor needs rows with an inner product of at least t, so with a
cosine of at least c = t / (its length × the bucket's greatest length).  A coordinate a
of the unit anchor then leaves room for cos(acos(a) ± acos(c)) only: that range is cut
out of the sorted list of each of the anchor's largest coordinates, the sets are
intersected, and the rest is verified with exact integer products.  A bucket whose
bound c is above 1 is not looked at.  t is the score of the k-th best row so far; the
longest rows give it a start, so that tasks that hold short rows prune from the first.

Anchors go to the tasks in blocks of ``WAVE_BYTES`` at most; every block meets every
bucket, and what comes back is the k best rows of a task for each anchor.

Defined cases
-------------
* rows with a null id, label or vector, or with a null component, take no part;
* other rows are those with another id; a row repeated as a whole counts as often as it
  comes as a candidate and once as an anchor;
* vectors of another dimension than the anchor's are no candidates; an empty vector
  scores 0 with other empty vectors;
* ties go to the smaller id; an anchor without positives or with no row in the score
  range gives no rows; an empty table gives none;
* components beyond ±2³¹/√dimension count as that number, so that scores fit 64 bits;
* further columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a length bucket at most, and the share of the longest length its shortest row must have.
BUCKET_ROWS, BUCKET_RATIO = 8192, 0.9
#: Coordinates of an anchor whose lists are searched.
FOCUS = 4
#: An anchor whose shortest list range holds more than this share of a bucket is multiplied with all of it.
WIDE = 0.25
#: Bytes of anchor vectors sent to the tasks at a time.
WAVE_BYTES = 4 << 20
#: The longest rows, which only give the thresholds a start.
HEAD_ROWS = 4096
#: Rows of the index that a task reads.
TASK_ROWS = 1 << 16
#: Products held at a time.
CELLS = 1 << 20
NOTHING = np.iinfo(np.int64).min
SLACK = 1e-9
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def packed(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, dim, length, vec): whole-number vectors as 32-bit integers."""
    id_, label, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    rows = vectors.where(id_.isNotNull() & label.isNotNull() & vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull()))
    rows = rows.select(id_.cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.cast("array<bigint>").alias("vector"))

    def pack(batches):
        for batch in batches:
            column = batch.column(2)
            sizes = np.diff(np.asarray(column.offsets))
            flat = column.flatten().to_numpy(zero_copy_only=False)
            most = np.minimum(2.0**31 - 1, 2.0**31 / np.sqrt(np.maximum(sizes, 1))).astype(np.int64).repeat(sizes)
            flat = np.clip(flat, -most, most)
            square = np.add.reduceat(np.append(flat.astype(np.float64) ** 2, 0.0), np.minimum(np.cumsum(sizes) - sizes, len(flat))) if len(sizes) else np.zeros(0)
            square[sizes == 0] = 0.0
            data, ends = flat.astype("<i4").tobytes(), 4 * np.cumsum(sizes)
            vec = [data[e - 4 * n : e] for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(np.sqrt(square)), pa.array(vec, pa.binary())],
                ["id", "label", "dim", "length", "vec"],
            )

    return rows.mapInArrow(pack, "id bigint, label bigint, dim int, length double, vec binary")


def build_index(rows: DataFrame) -> DataFrame:
    """The packed rows stored by dimension and descending length; equal rows may lie in several files."""
    spark = rows.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    order = ("dim", F.desc("length"), "id", "place")
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    return written(placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("place"), "length-index")


@dataclass
class Bucket:
    """Rows of similar length with sorted coordinate lists, each made when it is first needed."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lists: dict = field(default_factory=dict)

    def __post_init__(self):
        self.vectors = self.vectors.astype(np.float64)
        length = np.sqrt((self.vectors**2).sum(axis=1))
        self.longest = float(length.max())
        self.unit = self.vectors / np.where(length > 0, length, 1.0)[:, None]

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]


def buckets(batches, dim: int):
    """Cut a stream of stored rows into buckets."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        length = batch.column("length").to_numpy()
        rows = np.frombuffer(b"".join(batch.column("vec").to_pylist()), dtype="<i4").reshape(n, dim)
        start = 0
        while start < n:
            near = length[start : start + BUCKET_ROWS]
            outside = np.flatnonzero((near < BUCKET_RATIO * near[0]) | (near > near[0]))
            end = start + (int(outside[0]) if len(outside) else len(near))
            yield Bucket(ids[start:end], labels[start:end], rows[start:end])
            start = end


@dataclass
class Best:
    """The k best rows of every window: score descending, then the smaller id."""

    k: int
    floor: np.ndarray

    def __post_init__(self):
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window, score, id_) -> None:
        w, s, i = (np.concatenate(p) for p in ((self.window, window), (self.score, score), (self.id, id_)))
        order = np.lexsort((i, -s, w))
        w, s, i = w[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else np.zeros(0, np.int64)
        rank = np.arange(len(w)) - np.repeat(first, np.diff(np.append(first, len(w))))
        keep = rank < self.k
        self.window, self.score, self.id = w[keep], s[keep], i[keep]
        full = rank == self.k - 1
        self.floor[w[full]] = np.maximum(self.floor[w[full]], s[full])


@dataclass(frozen=True)
class Wave:
    """A block of anchors, and the windows of scores in which each looks for rows.

    Window j belongs to anchor ``of[j]`` (ascending) and takes scores from ``low[j]`` to ``high[j]``;
    ``same`` tells whether rows of the anchor's label or of other labels are wanted.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int


def candidates(bucket: Bucket, wave: Wave, floor: np.ndarray):
    """(anchor, row, score) of all pairs that reach the anchor's floor, in parts of bounded size."""
    n = len(bucket.ids)
    queries = wave.vectors.astype(np.float64)
    length = np.sqrt((queries**2).sum(axis=1))
    reach = length * bucket.longest
    exact = reach.max(initial=0.0) < 2.0**53
    held, asked = (bucket.vectors, queries) if exact else (bucket.vectors.astype(np.int64), wave.vectors.astype(np.int64))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where((floor > 0) & (reach > 0), floor / reach, -1.0)
    active = np.flatnonzero((cosine <= 1 + SLACK) & ((floor <= 0) | (reach > 0)) & (floor < np.iinfo(np.int64).max))
    if not len(active):
        return
    unit = queries[active] / np.where(length[active] > 0, length[active], 1.0)[:, None]
    d = unit.shape[1]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, : min(FOCUS, d)]
    wide = np.ones(len(active), dtype=bool)
    if focus.shape[1]:
        angle = np.arccos(np.clip(np.take_along_axis(unit, focus, 1), -1, 1))
        room = np.arccos(np.clip(cosine[active], -1, 1))[:, None]
        upper = np.cos(np.maximum(angle - room, 0.0)) + SLACK
        lower = np.cos(np.minimum(angle + room, np.pi)) - SLACK
        start, end = np.zeros(focus.shape, np.int64), np.full(focus.shape, n)
        bound = cosine[active] > 0
        for f in np.unique(focus[bound]):
            at = np.nonzero((focus == f) & bound[:, None])
            _, values = bucket.sorted_list(f)
            start[at], end[at] = np.searchsorted(values, lower[at], "left"), np.searchsorted(values, upper[at], "right")
        width = end - start
        shortest = width.argmin(axis=1)
        least = np.take_along_axis(width, shortest[:, None], 1)[:, 0]
        wide = least > WIDE * n
        for j in np.flatnonzero(~wide & (least > 0)):
            s = shortest[j]
            rows = bucket.sorted_list(focus[j, s])[0][start[j, s] : end[j, s]]
            for c in range(focus.shape[1]):
                if c != s and len(rows):
                    values = bucket.unit[rows, focus[j, c]]
                    rows = rows[(values >= lower[j, c]) & (values <= upper[j, c])]
            if len(rows):
                a = active[j]
                score = (held[rows] @ asked[a]).astype(np.int64)
                hit = score >= floor[a]
                yield np.full(int(hit.sum()), a), rows[hit], score[hit]
    rest = active[wide]
    step = max(1, CELLS // n)
    for i in range(0, len(rest), step):
        part = rest[i : i + step]
        score = (asked[part] @ held.T).astype(np.int64)
        a, rows = np.nonzero(score >= floor[part][:, None])
        yield part[a], rows, score[a, rows]


def best_rows(index: DataFrame, wave: Wave, floor: np.ndarray) -> DataFrame:
    """(window, score, id, rank): the k best rows of every window over the whole index."""
    dim = wave.vectors.shape[1]
    first = np.searchsorted(wave.of, np.arange(len(wave.ids) + 1))

    def search(batches):
        best = Best(wave.k, np.maximum(floor, wave.low))
        for bucket in buckets(batches, dim):
            least = np.full(len(wave.ids), np.iinfo(np.int64).max)
            np.minimum.at(least, wave.of, best.floor)
            for a, rows, score in candidates(bucket, wave, least):
                right = (bucket.labels[rows] == wave.labels[a]) & (bucket.ids[rows] != wave.ids[a]) if wave.same else bucket.labels[rows] != wave.labels[a]
                a, rows, score = a[right], rows[right], score[right]
                # Every window of the anchor.
                number = first[a + 1] - first[a]
                pick = np.repeat(np.arange(len(a)), number)
                window = first[a][pick] + np.arange(len(pick)) - np.repeat(np.cumsum(number) - number, number)
                score, rows = score[pick], rows[pick]
                fits = (score >= best.floor[window]) & (score <= wave.high[window])
                if fits.any():
                    best.add(window[fits], score[fits], bucket.ids[rows[fits]])
        yield pa.RecordBatch.from_pydict({"window": best.window, "score": best.score, "id": best.id})

    found = index.where(F.col("dim") == dim).select("id", "label", "length", "vec").mapInArrow(search, "window bigint, score bigint, id bigint")
    order = Window.partitionBy("window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wave.k)


def searched(index: DataFrame, head: DataFrame, wave: Wave) -> DataFrame:
    """``best_rows`` with thresholds that the longest rows give."""
    floor = np.full(len(wave.of), NOTHING)
    # One row a window at most.
    start = best_rows(head, wave, floor).where(F.col("rank") == wave.k).select("window", "score").toArrow()
    floor[start.column("window").to_numpy()] = start.column("score").to_numpy()
    return best_rows(index, wave, floor)


def _waves(anchors: DataFrame, dim: int, n: int) -> int:
    """Number of hash blocks none of which is above the bound."""
    most = max(1, WAVE_BYTES // (4 * max(dim, 1)))
    blocks = -(-n // most)
    while blocks > 1:
        sizes = anchors.where(F.col("dim") == dim).groupBy(F.pmod("hash", F.lit(blocks))).count()
        if sizes.agg(F.max("count")).first()[0] <= most:
            break
        blocks = blocks + -(-blocks // 4)
    return blocks


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """For each anchor and each of its positives the first rows of other labels in a range of scores.

    ``vectors`` holds whole numbers; ``anchor`` is a condition on its columns.  Positives are the
    anchor's first ``n_positives`` other rows of its label; a negative's score is between ``low``
    and ``high`` percent of the positive's.
    """
    spark = vectors.sparkSession
    index = build_index(packed(vectors, id_col, label_col, vector_col))
    chosen = vectors.where(anchor)
    anchors = packed(chosen, id_col, label_col, vector_col).dropDuplicates(["id", "label", "vec"])
    anchors = written(anchors.withColumn("hash", F.xxhash64("id", "label", "vec")), "anchors")
    out = folder(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(out)
    for dim, n in sorted((r["dim"], r["count"]) for r in anchors.groupBy("dim").count().collect()):
        head = written(index.where(F.col("dim") == dim).orderBy(F.desc("length"), "id").limit(HEAD_ROWS), "longest-rows")
        blocks = _waves(anchors, dim, n)
        for b in range(blocks):
            block = anchors.where((F.col("dim") == dim) & (F.pmod("hash", F.lit(blocks)) == b)).select("id", "label", "vec").toArrow()
            ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
            rows = np.frombuffer(b"".join(block.column("vec").to_pylist()), dtype="<i4").reshape(len(ids), dim)
            each = np.arange(len(ids))
            open_ = np.full(len(ids), NOTHING), np.full(len(ids), np.iinfo(np.int64).max)
            found = searched(index, head, Wave(ids, labels, rows, each, *open_, True, n_positives)).orderBy("window", "rank").toArrow()
            of, score, positive = (found.column(c).to_numpy() for c in ("window", "score", "id"))
            # Python's whole numbers: a product of a score may pass 64 bits.
            least = np.array([-(-low * s // 100) for s in score.tolist()], dtype=np.int64)
            most = np.array([high * s // 100 for s in score.tolist()], dtype=np.int64)
            fits = least <= most
            of, score, positive, least, most = of[fits], score[fits], positive[fits], least[fits], most[fits]
            if not len(of):
                continue
            negatives = searched(index, head, Wave(ids, labels, rows, of, least, most, False, n_negatives))
            _named(negatives, ids[of], positive, score).write.mode("append").parquet(out)
    return spark.read.schema(RESULT).parquet(out)


def _named(negatives: DataFrame, anchor: np.ndarray, positive: np.ndarray, score: np.ndarray) -> DataFrame:
    """Windows as the ids of anchor and positive."""

    def name(batches):
        for batch in batches:
            w = batch.column("window").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[w]), pa.array(positive[w]), batch.column("rank"), batch.column("id"), pa.array(score[w]), batch.column("score")],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return negatives.mapInArrow(name, RESULT)
