"""Level-wise histogram trees on DataFrames.

Features are cut once, at 255 edges at most, so that a bin number fits a byte.  A level
of all nodes with many rows is one job: each task sends one packed array of sums per
node, the arrays are added up and searched for the best split where they meet, and the
driver gets one row per node and block of features, whatever the number of bins or rows.
Nodes whose rows fit a task are then grown to their ends in one more job, so a tree costs
as many jobs as it has levels with large nodes, and one.  Where a row stands is worked out
again in each job from the trees, so no row state is kept, no lineage grows and a lost
executor costs only its partitions.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..functions.measures import sketched_quantiles

# Tasks get the code with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges per feature; bin numbers go from 0 to the number of edges.
MAX_BINS = 255

#: Features whose sketches are merged in one task.  A task's map side keeps a buffer per block, and
#: Spark sorts the rows instead beyond 128 of them.
EDGE_BLOCK = 8

#: How blocks hold their columns.
BLOCK_KINDS = {"double": "float64", "bigint": "int64"}


# --- binning


def _edge_marks(df: DataFrame, features: Sequence[str], max_bins: int) -> DataFrame:
    """(block, q0, lo0, hi0, …): a row per block of features, whose sketches meet in a task of their own."""
    blocks = [features[i : i + EDGE_BLOCK] for i in range(0, len(features), EDGE_BLOCK)]
    none = F.lit(None).cast("double")
    structs = []
    for b, own in enumerate(blocks):
        values = [F.col(f).cast("double") for f in own] + [none] * (EDGE_BLOCK - len(own))
        structs.append(F.struct(F.lit(b).alias("block"), *[v.alias(f"v{j}") for j, v in enumerate(values)]))
    rows = df.select(F.explode(F.array(*structs)).alias("b")).select("b.*")
    marks = []
    for j in range(min(EDGE_BLOCK, len(features))):
        marks += [sketched_quantiles(f"v{j}", max_bins, 100 * max_bins).alias(f"q{j}"), F.min(f"v{j}").alias(f"lo{j}"), F.max(f"v{j}").alias(f"hi{j}")]
    return rows.groupBy("block").agg(*marks)


def _plain_marks(df: DataFrame, features: Sequence[str]) -> dict[int, set[float]]:
    """Minimum, without the maximum, of the features with two values at most, by place: no quantile adds to it."""
    p = len(features)

    def look(batches):
        held: dict[int, tuple] = {}
        for batch in batches:
            for i in range(p):
                values = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                if not len(values) or held.get(i, (0, 0, False))[2]:
                    continue
                low, high = (values.min(), values.max()) if i not in held else (min(held[i][0], values.min()), max(held[i][1], values.max()))
                ends = (low, high) if i not in held else (low, high, *held[i][:2])
                # A missing number that is not null equals nothing, so it counts as one more value.
                held[i] = low, high, len({float(x) for x in ends}) > 2 or bool(((values != low) & (values != high)).any())
        rows = [(i, *(float(x) for x in held[i][:2]), held[i][2]) if i in held else (i, None, None, False) for i in range(p)]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int32(), pa.float64(), pa.float64(), pa.bool_()))], ["feature", "low", "high", "more"])

    values = df.select(*[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    parts = values.mapInArrow(look, "feature int, low double, high double, more boolean")
    ends = F.array_union(F.collect_set("low"), F.collect_set("high"))
    found = parts.groupBy("feature").agg(F.min("low").alias("low"), F.max("high").alias("high"), (F.bool_or("more") | (F.size(ends) > 2)).alias("more"))
    return {r["feature"]: {r["low"]} - {r["high"], None} for r in found.where("NOT more").collect()}


def fit_edges(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> list[np.ndarray]:
    """Candidate thresholds per feature: sketched quantiles plus the minimum, without the maximum.

    A rare indicator keeps its one threshold, since the minimum is always there.
    The tasks' sketches of a block of features are merged apart from those of all others.
    Of many features, those with two values at most (indicators) need no sketch and are found beforehand.
    """
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be 2 to {MAX_BINS}")
    if not features:
        return []
    marks = _plain_marks(df, features) if len(features) > 2 * EDGE_BLOCK else {}
    rest = [i for i in range(len(features)) if i not in marks]
    table = _edge_marks(df, [features[i] for i in rest], max_bins).toArrow().to_pylist() if rest else []
    found = {row["block"]: row for row in table}
    for place, i in enumerate(rest):
        row, j = found.get(place // EDGE_BLOCK, {}), place % EDGE_BLOCK
        marks[i] = {row.get(f"lo{j}"), *(row.get(f"q{j}") or [])} - {row.get(f"hi{j}"), None}
    return [np.array(sorted(marks[i]), dtype="float64") + 0.0 for i in range(len(features))]  # no negative zero


def bin_rows(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``bins``: one byte per feature, the number of edges below the value."""
    if max(map(len, edges), default=0) > MAX_BINS:
        raise ValueError(f"a feature can have at most {MAX_BINS} edges")
    kept = [f for f in df.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", bins binary"
    places = [f"_f{i}" for i in range(len(features))]
    p = len(features)

    def encode(batches):
        for pdf in batches:
            m = np.empty((len(pdf), p), dtype="uint8")
            for i, name in enumerate(places):
                m[:, i] = np.searchsorted(edges[i], pdf[name].to_numpy(dtype="float64"), side="left")
            out = pdf.drop(columns=places)
            out["bins"] = [r.tobytes() for r in m]
            yield out

    values = df.select(*keep, *[F.col(f).cast("double").alias(n) for f, n in zip(features, places)])
    return values.mapInPandas(encode, schema)


def bin_blocks(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """Binned rows in blocks, one for an Arrow batch: the bin matrix and each ``keep`` column (double or bigint) as bytes.

    Trees read their rows many times, and a block travels as a whole: what a pass costs besides the sums
    themselves goes by blocks and not by rows.
    """
    if max(map(len, edges), default=0) > MAX_BINS:
        raise ValueError(f"a feature can have at most {MAX_BINS} edges")
    kinds = [f.dataType.simpleString() for f in df.select(*keep).schema.fields]
    kept = [(name, BLOCK_KINDS[kind]) for name, kind in zip(keep, kinds)]
    p = len(features)

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda i: batch.column(i).to_numpy(zero_copy_only=False)
            m = np.empty((batch.num_rows, p), dtype="uint8")
            for i in range(p):
                # Arrow has null where pandas has NaN; both are above all edges.
                values = column(len(kept) + i).astype("float64", copy=False)
                m[:, i] = np.searchsorted(edges[i], values, side="left") if len(edges[i]) != 1 else ~(values <= edges[i][0])
            held = [column(i).astype(kind).tobytes() for i, (_, kind) in enumerate(kept)]
            yield pa.RecordBatch.from_pydict({**{name: pa.array([x], pa.binary()) for (name, _), x in zip(kept, held)}, "bins": pa.array([m.tobytes()], pa.binary())})

    values = df.select(*keep, *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    return values.mapInArrow(encode, ", ".join(f"`{name}` binary" for name in (*keep, "bins")))


def read_blocks(batch: pa.RecordBatch, p: int, wholes: Sequence[str] = ("_u",)):
    """(number columns, bin matrix) of each block, taken from the buffers without a copy; ``wholes`` are bigint, all others double."""
    for i in range(batch.num_rows):
        held = {name: batch.column(name)[i].as_buffer() for name in batch.schema.names}
        bins = np.frombuffer(held.pop("bins"), dtype="uint8").reshape(-1, p)
        yield {name: np.frombuffer(x, dtype="int64" if name in wholes else "float64") for name, x in held.items()}, bins


def block_sums(data: DataFrame, p: int, terms: Callable[[dict], dict]) -> dict[str, float]:
    """Rows (``n``) and the sums of the ``terms`` of all blocks; missing values are left out."""
    names = list(terms({name: np.zeros(0) for name in data.columns}))

    def add(batches):
        total = np.zeros(len(names) + 1)
        for batch in batches:
            for columns, bins in read_blocks(batch, p):
                total += (len(bins), *(np.nansum(x) for x in terms(columns).values()))
        yield pa.RecordBatch.from_pydict({name: pa.array([x]) for name, x in zip(("n", *names), total)})

    parts = data.mapInArrow(add, ", ".join(f"{name} double" for name in ("n", *names)))
    row = parts.agg(*[F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in ("n", *names)]).first().asDict()
    return {**row, "n": int(row["n"])}


def unpack_bins(column: pd.Series, p: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="uint8").reshape(len(column), p)


# --- trees


@dataclass
class Tree:
    """Nodes in parallel lists; a leaf has feature −1.  Rows with bin ≤ cut go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[tuple[float, ...]] = field(default_factory=lambda: [()])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple, right: tuple) -> None:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        for side, stats in ((self.left, left), (self.right, right)):
            side[node] = len(self.feature)
            for part, new in (
                (self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1),
                (self.depth, self.depth[node] + 1), (self.gain, 0.0), (self.stats, stats), (self.value, 0.0),
            ):
                part.append(new)

    def graft(self, node: int, other: "Tree") -> None:
        """Put a tree in the place of a leaf."""
        start, depth = len(self.feature) - 1, self.depth[node]
        moved = [n + start if n > 0 else n for n in range(len(other.feature))]
        for part, more in ((self.feature, other.feature), (self.cut, other.cut), (self.gain, other.gain), (self.stats, other.stats), (self.value, other.value)):
            part[node], rest = more[0], more[1:]
            part += rest
        for part, more in ((self.left, other.left), (self.right, other.right)):
            part[node], *rest = [moved[n] if n > 0 else -1 for n in more]
            part += rest
        self.depth += [d + depth for d in other.depth[1:]]

    def level_order(self) -> "Tree":
        """The same tree with its nodes numbered level by level."""
        order = [0]
        for n in order:
            if self.feature[n] >= 0:
                order += [self.left[n], self.right[n]]
        place = {n: i for i, n in enumerate(order)} | {-1: -1}
        own = {k: [getattr(self, k)[n] for n in order] for k in ("feature", "cut", "depth", "gain", "stats", "value")}
        return Tree(**own, left=[place[self.left[n]] for n in order], right=[place[self.right[n]] for n in order])

    def inner_below(self, node: int) -> list[int]:
        """The splits of a node and of all that come from it, parents first."""
        order = [node]
        for n in order:
            if self.feature[n] >= 0:
                order += [self.left[n], self.right[n]]
        return [n for n in order if self.feature[n] >= 0]

    def leaves(self) -> list[int]:
        """Leaves that can be reached from the root."""
        out, stack = [], [0]
        while stack:
            n = stack.pop()
            if self.feature[n] < 0:
                out.append(n)
            else:
                stack += [self.right[n], self.left[n]]
        return out

    def arrays(self):
        kinds = ("int32", "int32", "int32", "int32", "float64")
        return tuple(np.array(x, dtype=k) for x, k in zip((self.feature, self.cut, self.left, self.right, self.value), kinds))


def route(arrays, bins: np.ndarray) -> np.ndarray:
    """Node of each row."""
    feature, cut, left, right, _ = arrays
    inner = feature >= 0
    # A leaf leads to itself, so all rows take the same number of steps.
    own = np.arange(len(feature))
    f, c = np.where(inner, feature, 0).astype("int64"), cut.astype("int64")
    side = np.column_stack([np.where(inner, left, own), np.where(inner, right, own)]).astype("int64").ravel()
    node = np.zeros(len(bins), dtype="int64")
    flat, rows = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
    live = inner[:1]
    reached = own[:1]
    while live.any():
        go_right = flat.take(rows + f.take(node)) > c.take(node)
        node = side.take(2 * node + go_right)
        # Nodes one level further down.
        reached = np.concatenate([left[reached[live]], right[reached[live]]])
        live = inner[reached]
    return node


def add_trees(score: np.ndarray, bins: np.ndarray, arrays: Sequence) -> np.ndarray:
    """Scores with the values of more trees added."""
    for a in arrays:
        score = score + a[4][route(a, bins)]
    return score


#: Bytes of binned rows a task reads, and those that are worth a task of their own.
TASK_BYTES, LEAST_BYTES = 64 << 20, 1 << 20
#: A node whose rows take no more bytes than this is grown to its end in one task.
SMALL_BYTES = 16 << 20
#: Bytes of binned rows a task of a fit that stays in memory holds at most, and of a model whose rounds are grown in one task.
HELD_BYTES, MODEL_BYTES = 512 << 20, 128 << 20
#: Bytes of binned rows from which on a fit stays in the memory of several tasks, if these share a folder.
HELD_FROM_BYTES = 16 << 20
#: Nodes of a round whose sums such tasks send to each other at most through Spark, and how many times more through a folder.
HELD_NODES, POSTED_NODES = 256, 256
#: Bytes of all tasks in one exchange through Spark.
GATHERED_BYTES = 32 << 20
#: Values of the bins of several features that are numbered together, and rows that are summed by such numbers at a time.
PACK_CELLS, PACKED_ROWS = 4300, 1 << 16
#: Sums a task keeps for a level, and sums of a block of features that is added up by itself.
TASK_CELLS, BLOCK_CELLS = 2_000_000, 4096
#: Rows whose sums are made at a time, and rows from which on a node is summed column by column.
SUMMED_ROWS, COLUMN_ROWS = 1 << 14, 1 << 12


def fewer_tasks(data: DataFrame, rows: int, p: int) -> DataFrame:
    """Put small partitions together, without a shuffle: tasks of a fair number of bytes."""
    size = int(rows) * (p + 32)
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data.coalesce(max(min(cores, -(-size // LEAST_BYTES)), -(-size // TASK_BYTES), 1))


def held_tasks(spark: SparkSession, rows: int, p: int, nodes: int, models: int = 1, posted: bool = False) -> int:
    """Tasks that run at the same time and hold all rows between them; 0 where rows or sums are too many for that.

    Spark runs such tasks only on a fixed number of cores.  Sums are few where they go through Spark, and not ``posted``.
    """
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true" or conf.contains("spark.default.parallelism"):
        return 0
    cores = spark.sparkContext.defaultParallelism // int(conf.get("spark.task.cpus", "1"))
    size = int(rows) * (p + 32)
    most = HELD_NODES * (POSTED_NODES if posted else 1)
    # A row has a score, two slopes and a place for each model.
    return 0 if nodes > most or size + rows * 32 * (models - 1) > cores * HELD_BYTES else min(cores, -(-size // LEAST_BYTES))


# (number columns of a block, bins, tree number) -> (use row?, stats matrix); the first stat is the row count.
RowStats = Callable[[dict, np.ndarray, int], tuple[np.ndarray, np.ndarray]]
# (left stats, right stats, all stats) -> gain, −inf where the split is not allowed.
Gain = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _types(schema: pa.Schema) -> tuple[pa.Schema, StructType]:
    return schema, from_arrow_schema(schema)


# Rows between the tasks and to the driver, with their Spark types made once.
_reals, _wholes = pa.list_(pa.float64()), pa.list_(pa.int32())
_, SUMS_TYPE = _types(pa.schema({"task": pa.int32(), "key": pa.int64(), "sums": pa.binary()}))
_, ROWS_TYPE = _types(pa.schema({"slot": pa.int32(), "bins": pa.binary(), "stats": pa.binary()}))
SPLIT, SPLIT_TYPE = _types(pa.schema({"slot": pa.int32(), "gain": pa.float64(), "feature": pa.int32(), "cut": pa.int32(), "lefts": _reals, "alls": _reals}))
SUBTREE, SUBTREE_TYPE = _types(
    pa.schema({"slot": pa.int32(), "number": pa.int32(), **{n: _wholes for n in ("feature", "cut", "left", "right", "depth")}, "gain": _reals, "value": _reals, "stats": _reals})
)
_LISTS = SUBTREE.names[2:-1]


def tree_row(slot: int, number: int, tree: Tree) -> pa.RecordBatch:
    row = {"slot": slot, "number": number, **{n: getattr(tree, n) for n in _LISTS}, "stats": [x for node in tree.stats for x in node]}
    return pa.RecordBatch.from_pylist([row], schema=SUBTREE)


def tree_of_row(row: dict, n_stats: int) -> Tree:
    stats = np.array(row["stats"]).reshape(-1, n_stats)
    return Tree(**{n: row[n] for n in _LISTS}, stats=[tuple(x) for x in stats])


def small_rows(p: int, n_stats: int) -> int:
    """Rows that fit a task as a whole."""
    return SMALL_BYTES // (p + 8 * n_stats)


class Layout:
    """Where the sums of a node lie: one cell for a feature with one edge, ``n_bins`` for one with more.

    Of a feature with one edge only the left side is kept; features without an edge
    have no cells.  One more row of sums holds the node's totals.
    """

    def __init__(self, n_edges: Sequence[int], features: Sequence[int] | None = None):
        n = np.asarray(n_edges, dtype="int64")
        chosen = np.arange(len(n)) if features is None else np.asarray(features, dtype="int64")
        self.single, self.wide = chosen[n[chosen] == 1], chosen[n[chosen] > 1]
        self.n_bins = int(n[self.wide].max(initial=0)) + 1
        self.cells = len(self.single) + self.n_bins * len(self.wide)
        # Candidate splits.
        self.feature = np.concatenate([self.single, np.repeat(self.wide, self.n_bins)])
        self.cut = np.concatenate([np.zeros(len(self.single), "int64"), np.tile(np.arange(self.n_bins), len(self.wide))])
        self.valid = self.cut < n[self.feature]

    def sums(self, bins: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Sums of the rows' statistics per cell, and their totals; rows are taken in parts of bounded size."""
        k, s, u = stats.shape[1], len(self.single), len(self.wide)
        out = np.zeros((self.cells + 1, k))
        for start in range(0, len(bins), SUMMED_ROWS):
            part, x = bins[start : start + SUMMED_ROWS], stats[start : start + SUMMED_ROWS]
            out[:s] -= part[:, self.single].T.astype("float64") @ x
            out[-1] += x.sum(axis=0)
            place = (part[:, self.wide] + self.n_bins * np.arange(u)).ravel()
            out[s:-1, 0] += np.bincount(place, minlength=self.n_bins * u)
            for j in range(1, k):
                out[s:-1, j] += np.bincount(place, weights=np.repeat(x[:, j], u), minlength=self.n_bins * u)
        out[:s] += out[-1]
        return out

    def node_sums(self, bins: np.ndarray, stats: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """``sums`` of ``n`` groups of rows at once, the groups being numbered in ``slot``.

        Eight features with one edge make a byte: its 256 values are summed up first and then taken apart.
        """
        return self.column_sums(*self.columns(bins), stats, slot, n)

    def columns(self, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bins column by column: eight features with one edge to a byte, and each with more."""
        packed = np.ascontiguousarray(np.packbits(bins[:, self.single], axis=1, bitorder="little").T)
        return packed, np.ascontiguousarray(bins[:, self.wide].T)

    def column_sums(self, packed: np.ndarray, wide: np.ndarray, stats: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        k, s = stats.shape[1], len(self.single)
        out = np.zeros((n, self.cells + 1, k))
        columns = [None, *[np.ascontiguousarray(stats[:, j]) for j in range(1, k)]]

        def add(place: np.ndarray, width: int) -> list[np.ndarray]:
            return [np.bincount(place, weights=x, minlength=n * width).reshape(n, width) for x in columns]

        for j, x in enumerate(add(slot, 1)):
            out[:, -1, j] = x[:, 0]
        base = slot * 256
        for b, byte in enumerate(packed):
            own = slice(8 * b, min(8 * b + 8, s))
            bits = (np.arange(256)[:, None] >> np.arange(own.stop - own.start)) & 1
            for j, x in enumerate(add(base + byte, 256)):
                out[:, own, j] = x @ bits
        out[:, :s] = out[:, -1:] - out[:, :s]
        base = slot * self.n_bins
        for f, column in enumerate(wide):
            own = slice(s + f * self.n_bins, s + (f + 1) * self.n_bins)
            for j, x in enumerate(add(base + column, self.n_bins)):
                out[:, own, j] = x
        return out

    def best(self, sums: np.ndarray, gain: Gain, allowed: Sequence[int] | np.ndarray | None):
        """(gain, feature, cut, sums of the left side) of the best split, or None; ties go to the first feature and cut.

        ``allowed`` are features, or an array that tells which candidate splits are.
        """
        k, end = sums.shape[1], len(self.single)
        left = np.concatenate([sums[:end], sums[end:-1].reshape(-1, self.n_bins, k).cumsum(axis=1).reshape(-1, k)])
        g = np.where(self.valid, gain(left, sums[-1] - left, sums[-1]), -np.inf)
        if allowed is not None:
            g[~(allowed if isinstance(allowed, np.ndarray) else np.isin(self.feature, allowed))] = -np.inf
        top = g.max(initial=-np.inf)
        if not top > 0:
            return None
        ties = np.flatnonzero(g == top)
        i = ties[np.lexsort((self.cut[ties], self.feature[ties]))[0]]
        return float(top), int(self.feature[i]), int(self.cut[i]), left[i]


def _margins(x: np.ndarray, widths: Sequence[int]) -> list[np.ndarray]:
    """Sums over all other digits for each digit of the column number; ``widths`` are the digits' bases."""
    if len(widths) == 1:
        return [x]
    h = len(widths) // 2
    parts = x.reshape(len(x), int(np.prod(widths[:h])), -1)
    return _margins(parts.sum(axis=2), widths[:h]) + _margins(parts.sum(axis=1), widths[h:])


class HeldRows:
    """Binned rows of a task, column by column, that are summed up for many nodes.

    The bins of several features are numbered together (``PACK_CELLS`` numbers at most) and summed at once.
    Of columns that are ``same`` only the first is summed, so that their splits tie as they should.
    """

    def __init__(self, columns: np.ndarray, n_edges: Sequence[int], same: Sequence[int], layouts: Sequence[Layout]):
        self.columns, self.layouts, self.n_edges = columns, layouts, n_edges
        self.copies: dict[int, list[int]] = {}
        for f, first in enumerate(same):
            if n_edges[f]:
                self.copies.setdefault(first, []).append(f)
        # Where a feature's sums go: layout, first cell and number of cells.
        self.place: dict[int, tuple[int, int, int]] = {}
        for j, layout in enumerate(layouts):
            for i, f in enumerate(layout.single):
                self.place[int(f)] = j, i, 1
            for i, f in enumerate(layout.wide):
                self.place[int(f)] = j, len(layout.single) + i * layout.n_bins, n_edges[f] + 1
        self.packs: list[list[int]] = []
        cells = PACK_CELLS + 1
        for f in sorted(self.copies, key=lambda f: (n_edges[f], f)):
            cells *= n_edges[f] + 1
            if cells > PACK_CELLS:
                self.packs.append([])
                cells = n_edges[f] + 1
            self.packs[-1].append(f)
        self.widths = [[n_edges[f] + 1 for f in pack] for pack in self.packs]
        self.codes = []
        for pack, widths in zip(self.packs, self.widths):
            code = np.zeros(columns.shape[1], dtype="uint16")
            for f, width in zip(pack, widths):
                code *= np.uint16(width)
                code += columns[f]
            self.codes.append(code)

    def add_sums(self, out: Sequence[np.ndarray], rows: np.ndarray, slopes: Sequence[np.ndarray]) -> None:
        """Puts the counts and the sums of both ``slopes`` of the rows into ``out``, an array per layout."""
        k = 1 + len(slopes)
        totals = [np.zeros((k, int(np.prod(widths)))) for widths in self.widths]
        whole = np.zeros(k)
        everything = len(rows) == self.columns.shape[1]
        for start in range(0, len(rows), PACKED_ROWS):
            some = slice(start, start + PACKED_ROWS) if everything else rows[start : start + PACKED_ROWS]
            x = [s[some] for s in slopes]
            whole += (len(x[0]), *(s.sum() for s in x))
            for code, total in zip(self.codes, totals):
                place = code[some].astype("int64")
                for j, weights in enumerate((None, *x)):
                    total[j] += np.bincount(place, weights, total.shape[1])
        for pack, widths, total in zip(self.packs, self.widths, totals):
            for f, sums in zip(pack, _margins(total, widths)):
                for copy in self.copies[f]:
                    j, first, cells = self.place[copy]
                    out[j][first : first + cells] = sums.T[:cells]
        for x in out:
            x[-1] = whole

    def split(self, rows: np.ndarray, feature: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        goes_left = self.columns[feature].take(rows) <= cut
        return rows[goes_left], rows[~goes_left]


def grow_small(layout: Layout, bins: np.ndarray, stats: np.ndarray, gain: Gain, allowed, max_depth: int, min_rows: float, columns: tuple | None = None) -> Tree:
    """The tree of rows that fit a task; only the smaller child of a split is summed up, the other is the rest.

    ``columns`` are those of the layout, where a caller has them already.
    """
    packed, wide = layout.columns(bins) if columns is None else columns

    def summed(rows: np.ndarray) -> np.ndarray:
        """A few rows are summed as they are, many column by column."""
        if len(rows) < COLUMN_ROWS:
            return layout.sums(bins[rows], stats[rows])
        part = (packed, wide, stats) if len(rows) == len(bins) else (packed[:, rows], wide[:, rows], stats[rows])
        return layout.column_sums(*part, np.zeros(len(rows), dtype="int64"), 1)[0]

    tree, sums = Tree(), summed(np.arange(len(stats)))
    tree.stats[0] = tuple(sums[-1])
    queue = [(0, np.arange(len(stats)), sums)]
    for node, rows, sums in queue:
        found = layout.best(sums, gain, allowed) if tree.depth[node] < max_depth else None
        if found is None:
            continue
        g, f, cut, left = found
        tree.split(node, f, cut, g, tuple(left), tuple(sums[-1] - left))
        if tree.depth[node] + 1 == max_depth:
            continue
        goes_left = bins[rows, f] <= cut
        sides = rows[goes_left], rows[~goes_left]
        small = int(len(sides[1]) < len(sides[0]))
        if len(sides[1 - small]) < min_rows:
            continue
        own = summed(sides[small])
        for side, child in enumerate((tree.left[node], tree.right[node])):
            if len(sides[side]) >= min_rows:
                queue.append((child, sides[side], own if side == small else sums - own))
    return tree


def _slots(trees: Sequence[Tree], nodes: Sequence[tuple[int, int]]) -> tuple[dict, dict]:
    """Per tree the slot of each node (−1 where none) and the arrays that lead a row to its node."""
    slots = {t: np.full(len(trees[t].feature), -1, dtype="int64") for t, _ in nodes}
    for s, (t, n) in enumerate(nodes):
        slots[t][n] = s
    return slots, {t: trees[t].arrays() for t in slots}


def level_splits(data: DataFrame, trees: Sequence[Tree], nodes: Sequence[tuple[int, int]], row_stats: RowStats, gains: Sequence[Gain], n_edges: Sequence[int], n_stats: int, allowed) -> dict:
    """Best split of each node, {place in ``nodes``: (gain, feature, cut, left sums, all sums)}: one job.

    A task sends one array of sums per node and block of features; they are added up and
    searched where they meet, and one row per node and block comes back.
    """
    slots, frozen = _slots(trees, nodes)
    p = len(n_edges)
    blocks = [Layout(n_edges, part) for part in feature_blocks(n_edges)]
    of_slot = [t for t, _ in nodes]
    tasks = min(len(nodes) * len(blocks), 4 * data.sparkSession.sparkContext.defaultParallelism)

    def partial(batches):
        total: dict = {}
        for batch in batches:
            for columns, bins in read_blocks(batch, p):
                for t, arrays in frozen.items():
                    use, stats = row_stats(columns, bins, t)
                    slot = slots[t][route(arrays, bins)]
                    rows = np.flatnonzero(use & (slot >= 0))
                    if not len(rows):
                        continue
                    part = (bins, stats, slot) if len(rows) == len(bins) else (bins[rows], stats[rows], slot[rows])
                    open_, place = np.unique(part[2], return_inverse=True)
                    for b, layout in enumerate(blocks):
                        sums = layout.node_sums(part[0], part[1], place, len(open_))
                        for s, own in zip(open_.tolist(), sums):
                            key = s * len(blocks) + b
                            if key in total:
                                total[key] += own
                            else:
                                total[key] = own.copy()
        keys = list(total)
        yield pa.RecordBatch.from_pydict(
            {"task": pa.array([k % tasks for k in keys], pa.int32()), "key": pa.array(keys, pa.int64()), "sums": pa.array([total[k].tobytes() for k in keys], pa.binary())}
        )

    def settle(batches):
        total: dict = {}
        for batch in batches:
            for key, sums in zip(batch.column("key").to_pylist(), batch.column("sums").to_pylist()):
                sums = np.frombuffer(sums).reshape(-1, n_stats)
                total[key] = total[key] + sums if key in total else sums
        rows = []
        for key, sums in total.items():
            s, b = divmod(key, len(blocks))
            found = blocks[b].best(sums, gains[of_slot[s]], None if allowed is None else allowed[of_slot[s]])
            gain, f, cut, left = found or (0.0, -1, 0, sums[-1])
            rows.append((s, gain, f, cut, left.tolist(), sums[-1].tolist()))
        yield pa.RecordBatch.from_pylist([dict(zip(SPLIT.names, r)) for r in rows], schema=SPLIT)

    parts = data.mapInArrow(partial, SUMS_TYPE).repartitionById(tasks, "task")
    found = parts.mapInArrow(settle, SPLIT_TYPE).toArrow().to_pylist()
    out: dict = {}
    for r in sorted(found, key=lambda r: (r["slot"], -r["gain"], r["feature"], r["cut"])):
        out.setdefault(r["slot"], (r["gain"], r["feature"], r["cut"], np.array(r["lefts"]), np.array(r["alls"])))
    return out


def feature_blocks(n_edges: Sequence[int]) -> list[list[int]]:
    """Features in blocks of about ``BLOCK_CELLS`` cells."""
    blocks, cells = [[]], 0
    for f, n in enumerate(n_edges):
        if cells + n + 1 > BLOCK_CELLS and blocks[-1]:
            blocks.append([])
            cells = 0
        blocks[-1].append(f)
        cells += n + 1
    return blocks


def small_trees(data: DataFrame, trees: Sequence[Tree], nodes: Sequence[tuple[int, int]], row_stats: RowStats, gains: Sequence[Gain], n_edges: Sequence[int], n_stats: int, depths: Sequence[int], allowed, min_rows: float) -> dict[int, Tree]:
    """Whole subtrees below small nodes, {place in ``nodes``: subtree}: one job in which each node's rows meet in a task."""
    slots, frozen = _slots(trees, nodes)
    p, layout = len(n_edges), Layout(n_edges)
    of_slot = [(t, depths[t] - trees[t].depth[n]) for t, n in nodes]

    def deal(batches):
        for batch in batches:
            out = []
            for columns, bins in read_blocks(batch, p):
                for t, arrays in frozen.items():
                    use, stats = row_stats(columns, bins, t)
                    slot = np.where(use, slots[t][route(arrays, bins)], -1)
                    for s in np.unique(slot[slot >= 0]):
                        rows = slot == s
                        out.append((int(s), bins[rows].tobytes(), stats[rows].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in (1, 2)]], ["slot", "bins", "stats"])

    def finish(batches):
        held: dict = {}
        for batch in batches:
            for s, bins, stats in zip(*[batch.column(c).to_pylist() for c in ("slot", "bins", "stats")]):
                held.setdefault(s, []).append((bins, stats))
        for s, parts in held.items():
            t, depth = of_slot[s]
            bins = np.frombuffer(b"".join(b for b, _ in parts), dtype="uint8").reshape(-1, p)
            stats = np.frombuffer(b"".join(x for _, x in parts)).reshape(-1, n_stats)
            # Rows may arrive in any order; the sums must not depend on it.
            order = np.lexsort(stats.T)
            tree = grow_small(layout, bins[order], stats[order], gains[t], None if allowed is None else allowed[t], depth, min_rows)
            yield tree_row(s, 0, tree)

    parts = data.mapInArrow(deal, ROWS_TYPE).repartitionById(len(nodes), "slot")
    return {r["slot"]: tree_of_row(r, n_stats) for r in parts.mapInArrow(finish, SUBTREE_TYPE).toArrow().to_pylist()}


def grow(
    data: DataFrame,
    n_trees: int,
    row_stats: RowStats,
    gain: Gain | Sequence[Gain],
    n_edges: Sequence[int],
    n_stats: int,
    max_depth: int | Sequence[int],
    allowed: Sequence[Sequence[int] | None] | None = None,
    min_rows: float = 2,
    n_rows: int | None = None,
) -> list[Tree]:
    """Grow several trees over the same rows together; gains, depths and features may differ from tree to tree.

    All nodes of a level with many rows are split by one job.  Nodes whose rows fit a
    task wait until no others are left; then one job grows all of them to their ends.
    Both ways search the same sums, so where a node is grown does not change the tree.
    """
    trees = [Tree() for _ in range(n_trees)]
    gains = [gain] * n_trees if callable(gain) else list(gain)
    depths = [max_depth] * n_trees if isinstance(max_depth, int) else list(max_depth)
    fit = small_rows(len(n_edges), n_stats)
    chunk = max(1, TASK_CELLS // max(1, Layout(n_edges).cells))
    small: list[tuple[int, int]] = []
    large: list[tuple[int, int]] = []

    def open_(t: int, n: int, rows: float | None) -> None:
        if trees[t].depth[n] < depths[t] and (rows is None or rows >= min_rows):
            (large if rows is None or rows > fit else small).append((t, n))

    for t in range(n_trees):
        open_(t, 0, n_rows)
    while large:
        level, large = large, []
        for start in range(0, len(level), chunk):
            part = level[start : start + chunk]
            found = level_splits(data, trees, part, row_stats, gains, n_edges, n_stats, allowed)
            for s, (g, f, cut, left, whole) in found.items():
                t, n = part[s]
                trees[t].stats[n] = trees[t].stats[n] or tuple(whole)
                if f >= 0:
                    trees[t].split(n, f, cut, g, tuple(left), tuple(whole - left))
                    open_(t, trees[t].left[n], left[0])
                    open_(t, trees[t].right[n], whole[0] - left[0])
    if small:
        for s, subtree in small_trees(data, trees, small, row_stats, gains, n_edges, n_stats, depths, allowed, min_rows).items():
            trees[small[s][0]].graft(small[s][1], subtree)
    return [t.level_order() for t in trees]


# --- tables and expressions


def node_table(trees: Sequence[Tree], features: Sequence[str], edges: Sequence[np.ndarray]) -> DataFrame:
    """One row per reachable node: the saved form of tree models."""
    rows = []
    for t, tree in enumerate(trees):
        stack = [0]
        while stack:
            n = stack.pop()
            f = tree.feature[n]
            inner = f >= 0
            if inner:
                stack += [tree.right[n], tree.left[n]]
            rows.append(
                (
                    t, n, tree.depth[n], features[f] if inner else None, float(edges[f][tree.cut[n]]) if inner else None,
                    tree.left[n] if inner else None, tree.right[n] if inner else None, float(tree.value[n]),
                    float(tree.gain[n]), float(tree.stats[n][0]) if tree.stats[n] else None,
                )
            )
    schema = "tree int, node int, depth int, feature string, threshold double, left int, right int, value double, gain double, rows double"
    return SparkSession.active().createDataFrame(rows, schema)


def tree_column(tree: Tree, features: Sequence[str], edges: Sequence[np.ndarray], node: int = 0) -> Column:
    """The tree as nested conditions, scored inside the JVM."""
    f = tree.feature[node]
    if f < 0:
        return F.lit(float(tree.value[node]))
    goes_left = F.col(features[f]).cast("double") <= F.lit(float(edges[f][tree.cut[node]]))
    return F.when(goes_left, tree_column(tree, features, edges, tree.left[node])).otherwise(
        tree_column(tree, features, edges, tree.right[node])
    )


def rules(tree: Tree, features: Sequence[str], edges: Sequence[np.ndarray]) -> list[str]:
    """Indented text of the tree."""
    out = []

    def walk(n: int, label: str) -> None:
        rows = tree.stats[n][0] if tree.stats[n] else 0
        mark = "" if tree.feature[n] >= 0 else " *"
        out.append(f"{'  ' * tree.depth[n]}{label} rows={rows:g} value={tree.value[n]:.6g}{mark}")
        if tree.feature[n] >= 0:
            name, cut = features[tree.feature[n]], edges[tree.feature[n]][tree.cut[n]]
            walk(tree.left[n], f"{name} <= {cut:g}")
            walk(tree.right[n], f"{name} > {cut:g}")

    walk(0, "all")
    return out


def importance(trees: Sequence[Tree], features: Sequence[str], how: str = "average") -> DataFrame:
    """Share of the gain per feature: mean gain of its splits, or ``how='total'`` for the sum."""
    total, uses = np.zeros(len(features)), np.zeros(len(features))
    for tree in trees:
        reachable, stack = [], [0]
        while stack:
            n = stack.pop()
            if tree.feature[n] >= 0:
                reachable.append(n)
                stack += [tree.left[n], tree.right[n]]
        for n in reachable:
            total[tree.feature[n]] += tree.gain[n]
            uses[tree.feature[n]] += 1
    score = total if how == "total" else np.divide(total, uses, out=np.zeros_like(total), where=uses > 0)
    share = score / score.sum() if score.sum() > 0 else score
    rows = [(f, float(s), int(u)) for f, s, u in zip(features, share, uses)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double, splits int")
    return table.orderBy(F.desc("importance"), F.asc("feature"))


def trees_to_json(trees: Sequence[Tree]) -> str:
    return json.dumps([t.__dict__ for t in trees])


def trees_from_json(text: str) -> list[Tree]:
    out = []
    for d in json.loads(text):
        d["stats"] = [tuple(s) for s in d["stats"]]
        out.append(Tree(**d))
    return out
