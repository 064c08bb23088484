"""Poisson regression tree with exposure, its complexity table and pruning."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import hash_unit
from . import trees as tr

# Task code names functions, not the module: a module is looked up on the executor.
from .trees import read_blocks, route

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class TreeSpec:
    """``minbucket`` is on rows, ``cp`` the least share of the root's deviance a split must save.

    ``shrink`` pulls leaf rates towards the overall rate: it is the coefficient
    of variation of a gamma prior; None takes plain rates.
    """

    features: tuple[str, ...]
    count: str = "NUM_INJURIES"
    exposure: str = "EMP_HRS_TOTAL"
    unit: float = 2000.0
    minbucket: int = 25
    cp: float = 0.01
    max_depth: int = 10
    max_bins: int = 64
    shrink: float | None = None


@dataclass
class PoissonTree:
    spec: TreeSpec
    tree: tr.Tree
    edges: list[np.ndarray]

    def rate(self) -> Column:
        """Events per unit of exposure as a column expression."""
        return tr.tree_column(self.tree, self.spec.features, self.edges)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Expected events: rate of the leaf times exposure."""
        return df.withColumn(out, self.rate() * F.col(self.spec.exposure) / F.lit(self.spec.unit))

    def nodes(self) -> DataFrame:
        return tr.node_table([self.tree], self.spec.features, self.edges)

    def rules(self) -> list[str]:
        return tr.rules(self.tree, self.spec.features, self.edges)

    def pruned(self, cp: float) -> "PoissonTree":
        return PoissonTree(self.spec, prune(self.tree, cp * _risk(self.tree, 0)), self.edges)


def _fit_term(y, e, prior):
    """y·ln(rate) − rate·e of a node."""
    a, b = prior
    rate = np.divide(y + a, e + b, out=np.zeros_like(y, dtype="float64"), where=(e + b) > 0)
    log = np.log(np.where(rate > 0, rate, 1.0))
    return np.where(y > 0, y * log, 0.0) - rate * e


def _prior(y: float, e: float, shrink: float | None) -> tuple[float, float]:
    if not shrink or y <= 0:
        return 0.0, 0.0
    a = 1.0 / shrink**2
    return a, a * e / y


def _risk(tree: tr.Tree, node: int) -> float:
    return tree.risk[node]


def _finish(tree: tr.Tree, shrink: float | None) -> None:
    """Rates and deviances of all nodes from their sums."""
    root = tree.stats[0]
    prior = _prior(root[1], root[2], shrink)
    tree.risk = []
    for n, (_, y, e, own) in enumerate(tree.stats):
        yy, ee = np.array(float(y)), np.array(float(e))
        tree.value[n] = float((y + prior[0]) / (e + prior[1])) if e + prior[1] > 0 else 0.0
        tree.risk.append(float(2 * (own - y - _fit_term(yy, ee, prior))))


def _subtree(tree: tr.Tree) -> tuple[np.ndarray, np.ndarray]:
    """(deviance of the leaves below, number of leaves below) of every node."""
    n = len(tree.feature)
    risk, leaves = np.array(tree.risk, dtype="float64"), np.ones(n)
    for i in range(n - 1, -1, -1):
        if tree.feature[i] >= 0:
            l, r = tree.left[i], tree.right[i]
            risk[i], leaves[i] = risk[l] + risk[r], leaves[l] + leaves[r]
    return risk, leaves


def _collapse_weakest(tree: tr.Tree, limit: float | None = None) -> float | None:
    """Cut the links that save least per leaf; their saving, or None when it exceeds ``limit``."""
    risk, leaves = _subtree(tree)
    reach, stack = [], [0]
    while stack:
        i = stack.pop()
        if tree.feature[i] >= 0:
            reach.append(i)
            stack += [tree.left[i], tree.right[i]]
    if not reach:
        return None
    saving = {i: (tree.risk[i] - risk[i]) / (leaves[i] - 1) for i in reach}
    least = min(saving.values())
    if limit is not None and least > limit:
        return None
    for i, s in saving.items():
        if s <= least * (1 + 1e-12) + 1e-12:
            tree.feature[i] = -1
    return least


def prune(tree: tr.Tree, alpha: float) -> tr.Tree:
    """Smallest subtree that is best when each leaf costs ``alpha``."""
    out = deepcopy(tree)
    while _collapse_weakest(out, alpha) is not None:
        pass
    return out


def prune_sequence(tree: tr.Tree) -> list[tuple[float, tr.Tree]]:
    """(alpha from which the subtree is best, subtree), from the full tree to the root."""
    out, current = [(0.0, deepcopy(tree))], deepcopy(tree)
    while True:
        alpha = _collapse_weakest(current)
        if alpha is None:
            return out
        out.append((alpha, deepcopy(current)))


def _gain(minbucket: int, prior: tuple[float, float]):
    def gain(left, right, whole):
        ok = (left[..., 0] >= minbucket) & (right[..., 0] >= minbucket)
        parts = _fit_term(left[..., 1], left[..., 2], prior) + _fit_term(right[..., 1], right[..., 2], prior)
        saved = 2 * (parts - _fit_term(np.asarray(whole[1]), np.asarray(whole[2]), prior))
        return np.where(ok & (saved > 1e-9), saved, -np.inf)

    return gain


def _prepare(df: DataFrame, spec: TreeSpec, fold: Column) -> tuple[DataFrame, list[np.ndarray]]:
    rows = df.select(
        *spec.features,
        F.col(spec.count).cast("double").alias("_y"),
        (F.col(spec.exposure) / F.lit(spec.unit)).cast("double").alias("_e"),
        fold.cast("double").alias("_fold"),
    )
    edges = tr.fit_edges(rows, spec.features, spec.max_bins)
    return tr.bin_blocks(rows, spec.features, edges, ["_y", "_e", "_fold"]), edges


def _stats(columns: dict) -> np.ndarray:
    y, e = columns["_y"], columns["_e"]
    own = np.where(y > 0, y * np.log(np.where(y > 0, y, 1.0) / e), 0.0)
    return np.column_stack([np.ones(len(y)), y, e, own])


def _grow(data: DataFrame, spec: TreeSpec, edges, folds: int) -> list[tr.Tree]:
    """The tree on all rows, then one tree per fold without that fold's rows."""

    def row_stats(columns, bins, t):
        return (np.ones(len(bins), dtype=bool) if t == 0 else columns["_fold"] != t - 1), _stats(columns)

    total = tr.block_sums(data, len(edges), lambda c: {"y": c["_y"], "e": c["_e"]})
    data = tr.fewer_tasks(data, total["n"], len(edges))
    prior = _prior(total["y"], total["e"], spec.shrink)
    n_edges = [len(e) for e in edges]
    grown = tr.grow(
        data, folds + 1, row_stats, _gain(spec.minbucket, prior), n_edges, 4, spec.max_depth, min_rows=2 * spec.minbucket, n_rows=total["n"]
    )
    out = []
    for t in grown:
        _finish(t, spec.shrink)
        out.append(prune(t, spec.cp * _risk(t, 0)))
    return out


def fit_poisson_tree(df: DataFrame, spec: TreeSpec) -> PoissonTree:
    data, edges = _prepare(df, spec, F.lit(0))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PoissonTree(spec, _grow(data, spec, edges, 0)[0], edges)
    finally:
        data.unpersist()


@dataclass
class ComplexityTable:
    """``rows``: (cp, splits, relative error, cross-validated error, its spread), simplest tree first."""

    rows: list[tuple[float, int, float, float, float]]

    def best_cp(self) -> float:
        """cp of the row with the least cross-validated error, the simpler tree on a tie."""
        return min(self.rows, key=lambda r: r[3])[0]

    def cp_at(self, row: int) -> float:
        """cp of a chosen row, counted from 1; the last row when there are fewer."""
        return self.rows[min(row, len(self.rows)) - 1][0]

    def table(self) -> DataFrame:
        rows = [(i + 1, *r) for i, r in enumerate(self.rows)]
        schema = "place int, cp double, nsplit int, rel_error double, xerror double, xstd double"
        return SparkSession.active().createDataFrame(rows, schema)


def fit_with_complexity(df: DataFrame, spec: TreeSpec, key: str, folds: int = 10, seed: int = 0) -> tuple[PoissonTree, ComplexityTable]:
    """Tree plus its complexity table by cross-validation.

    A row's fold comes from its key.  All fold trees grow level by level in
    the same jobs as the full tree, and one more job scores every pruned fold
    tree on the rows it has not seen.
    """
    fold = F.floor(hash_unit(key, f"fold{seed}") * folds)
    data, edges = _prepare(df, spec, fold)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        full, *fold_trees = _grow(data, spec, edges, folds)
        root = _risk(full, 0)
        steps = prune_sequence(full)
        # Simplest first: cp of a row is where the next more complex tree stops being better.
        cps = [a / root for a, _ in steps][::-1]
        cps[-1] = max(spec.cp, 0.0)
        subtrees = [t for _, t in steps][::-1]
        typical = [np.inf] + [float(np.sqrt(cps[i] * cps[i - 1])) for i in range(1, len(cps))]
        variants = [[_arrays(prune(t, b * _risk(t, 0) if np.isfinite(b) else np.inf)) for b in typical] for t in fold_trees]
        p = len(spec.features)

        def score(batches):
            sums = np.zeros((len(typical), 2))
            for columns, bins in (block for batch in batches for block in read_blocks(batch, p)):
                y, e, own, rows_fold = columns["_y"], columns["_e"], _stats(columns)[:, 3], columns["_fold"]
                for k in range(len(variants)):
                    mine = rows_fold == k
                    if not mine.any():
                        continue
                    for i, arrays in enumerate(variants[k]):
                        rate = arrays[4][route(arrays, bins[mine])]
                        # A leaf without events would make any event infinitely unlikely.
                        mu = np.maximum(rate * e[mine], 1e-6)
                        dev = 2 * (own[mine] - np.where(y[mine] > 0, y[mine] * np.log(mu / e[mine]), 0.0) - (y[mine] - mu))
                        sums[i] += (dev.sum(), (dev * dev).sum())
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(typical), dtype="int32")), "d": pa.array(sums[:, 0]), "dd": pa.array(sums[:, 1])})

        scored = {r["i"]: (r["d"], r["dd"]) for r in data.mapInArrow(score, "i int, d double, dd double").groupBy("i").agg(F.sum("d").alias("d"), F.sum("dd").alias("dd")).collect()}
        n = full.stats[0][0]
        rows = []
        for i, t in enumerate(subtrees):
            d, dd = scored[i]
            leaves = t.leaves()
            spread = float(np.sqrt(max(dd - d * d / n, 0.0)) / root)
            rows.append((float(cps[i]), len(leaves) - 1, float(sum(t.risk[j] for j in leaves) / root), float(d / root), spread))
        return PoissonTree(spec, full, edges), ComplexityTable(rows)
    finally:
        data.unpersist()


def _arrays(tree: tr.Tree):
    return tree.arrays()


def poisson_split_gain(left_y, left_e, right_y, right_e) -> Column:
    """Deviance a split saves, from the sums of its two sides."""

    def term(y: Column, e: Column) -> Column:
        return F.when((y > 0) & (e > 0), y * F.ln(y / e)).otherwise(F.lit(0.0))

    ly, le, ry, re = left_y, left_e, right_y, right_e
    return F.lit(2.0) * (term(ly, le) + term(ry, re) - term(ly + ry, le + re))
