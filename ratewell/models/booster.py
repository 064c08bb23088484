"""Gradient-boosted histogram trees for counts, rates and yes/no targets.

Gradients and gains follow the published second-order formulation: a leaf is
−T(G)/(H+λ) and a split gains half the drop of T(G)²/(H+λ), less γ.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import sys
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import drop_dir, scratch_dir
from . import trees as tr
from .exchange import Meeting, meeting_folder

# Task code names functions, not the module: a module is looked up on the executor.
from .trees import HeldRows, Layout, Tree, add_trees, grow_small, read_blocks, tree_row, unpack_bins

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OBJECTIVES = ("squared", "logistic", "poisson", "tweedie")


@dataclass(frozen=True)
class BoosterSpec:
    features: tuple[str, ...]
    label: str
    objective: str = "poisson"
    weight: str | None = None
    n_estimators: int = 100
    max_depth: int = 5
    learning_rate: float = 0.1
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    scale_pos_weight: float = 1.0
    variance_power: float = 1.1
    max_delta_step: float = 0.7
    max_bins: int = 64
    seed: int = 0
    key: str | None = None
    refresh: int = 20

    def __post_init__(self):
        if self.objective not in OBJECTIVES:
            raise ValueError(f"objective must be one of {OBJECTIVES}")
        if self.subsample < 1 and self.key is None:
            raise ValueError("row sampling needs a key column, so that a row's luck is repeatable")


def gradients(spec: BoosterSpec, f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by the raw score."""
    if spec.objective == "squared":
        return f - y, np.ones_like(f)
    if spec.objective == "logistic":
        p = 1.0 / (1.0 + np.exp(-f))
        return p - y, np.maximum(p * (1 - p), 1e-16)
    if spec.objective == "poisson":
        mu = np.exp(f)
        return mu - y, mu * np.exp(spec.max_delta_step)
    r = spec.variance_power
    a, b = np.exp((1 - r) * f), np.exp((2 - r) * f)
    return -y * a + b, -y * (1 - r) * a + (2 - r) * b


def losses(spec: BoosterSpec, f: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Loss of each row, up to a constant."""
    if spec.objective == "squared":
        return 0.5 * (f - y) ** 2
    if spec.objective == "logistic":
        return np.logaddexp(0.0, f) - y * f
    if spec.objective == "poisson":
        return np.exp(f) - y * f
    r = spec.variance_power
    if r == 1:
        return np.exp(f) - y * f
    return -y * np.exp((1 - r) * f) / (1 - r) + np.exp((2 - r) * f) / (2 - r)


def respond(objective: str, f: np.ndarray) -> np.ndarray:
    if objective == "squared":
        return f
    return 1.0 / (1.0 + np.exp(-f)) if objective == "logistic" else np.exp(f)


def base_score(objective: str, mean: float) -> float:
    """Raw score of a model without trees: the link of the mean."""
    if objective == "squared":
        return mean
    if objective == "logistic":
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))
    return float(np.log(max(mean, 1e-6)))


def _soft(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _gain(spec: BoosterSpec):
    a, lam, gamma, least = spec.reg_alpha, spec.reg_lambda, spec.gamma, spec.min_child_weight

    def score(s):
        return _soft(s[..., 1], a) ** 2 / (s[..., 2] + lam + 1e-12)

    def gain(left, right, whole):
        ok = (left[..., 2] >= least) & (right[..., 2] >= least) & (left[..., 0] > 0) & (right[..., 0] > 0)
        g = 0.5 * (score(left) + score(right) - score(np.asarray(whole))) - gamma
        return np.where(ok & (g > 1e-12), g, -np.inf)

    return gain


def _row_luck(key: np.ndarray, number: int) -> np.ndarray:
    """Uniform numbers from the row's key hash and the round (a 64-bit finaliser)."""
    with np.errstate(over="ignore"):
        x = key.astype("uint64") + np.uint64((number * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype("float64") / 2.0**53


def _columns_of_tree(spec: BoosterSpec, number: int) -> list[int]:
    p = len(spec.features)
    take = max(1, int(np.ceil(spec.colsample_bytree * p)))
    order = sorted(range(p), key=lambda i: hashlib.md5(f"{spec.seed}|{number}|{i}".encode()).hexdigest())
    return sorted(order[:take])


@dataclass
class Booster:
    spec: BoosterSpec
    trees: list[tr.Tree]
    edges: list[np.ndarray]
    base: float

    def margin(self, n_trees: int | None = None) -> Column:
        """Raw score as an Arrow-batched column; a model of this size is past what generated code takes."""
        edges, p = self.edges, len(self.spec.features)
        arrays = [t.arrays() for t in self.trees[:n_trees]]
        base = self.base

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            bins = np.empty((len(columns[0]), p), dtype="uint8")
            for i in range(p):
                bins[:, i] = np.searchsorted(edges[i], columns[i].to_numpy(dtype="float64"), side="left")
            return pd.Series(add_trees(np.full(len(bins), base), bins, arrays))

        # Marked so that filters on the score stay above it and rows are scored once.
        score = score.asNondeterministic()
        return score(*[F.col(f).cast("double") for f in self.spec.features])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Response: value, probability of yes, or expected count."""
        f = self.margin()
        if self.spec.objective == "squared":
            return df.withColumn(out, f)
        raw = df.withColumn("_raw", f)
        response = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_raw"))) if self.spec.objective == "logistic" else F.exp("_raw")
        return raw.withColumn(out, response).drop("_raw")

    def staged_loss(self, df: DataFrame) -> DataFrame:
        """Mean training loss after 0, 1, 2, … trees: one pass."""
        spec, p, base = self.spec, len(self.spec.features), self.base
        arrays = [t.arrays() for t in self.trees]
        rows = tr.bin_blocks(_labelled(df, spec), spec.features, self.edges, ["_y", "_w"])

        def partial(batches):
            total = np.zeros((len(arrays) + 1, 2))
            for batch in batches:
                for columns, bins in read_blocks(batch, p):
                    y, f = columns["_y"], np.full(len(bins), base)
                    w = row_weights(spec, y, columns["_w"])
                    total[:, 1] += w.sum()
                    for i in range(len(arrays) + 1):
                        total[i, 0] += (w * losses(spec, f, y)).sum()
                        if i < len(arrays):
                            f = add_trees(f, bins, arrays[i : i + 1])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], ["trees", "l", "w"])

        parts = rows.mapInArrow(partial, "trees int, l double, w double")
        return parts.groupBy("trees").agg((F.sum("l") / F.sum("w")).alias("loss"))

    def importance(self, how: str = "average") -> DataFrame:
        return tr.importance(self.trees, self.spec.features, how)

    def nodes(self) -> DataFrame:
        return tr.node_table(self.trees, self.spec.features, self.edges)

    def save(self, path: str) -> None:
        """Node table to look at, and the whole model as one row."""
        self.nodes().write.mode("overwrite").parquet(f"{path}/nodes")
        state = {"spec": asdict(self.spec), "base": self.base, "edges": [e.tolist() for e in self.edges]}
        row = [(json.dumps(state), tr.trees_to_json(self.trees))]
        SparkSession.active().createDataFrame(row, "state string, trees string").write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, path: str) -> "Booster":
        row = SparkSession.active().read.parquet(f"{path}/model").first()
        state = json.loads(row["state"])
        spec = BoosterSpec(**{**state["spec"], "features": tuple(state["spec"]["features"])})
        return cls(spec, tr.trees_from_json(row["trees"]), [np.array(e) for e in state["edges"]], state["base"])


def row_weights(spec: BoosterSpec, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights of rows with the extra weight of the positive ones."""
    return w * np.where(y == 1, spec.scale_pos_weight, 1.0) if spec.objective == "logistic" else w


def _labelled(df: DataFrame, spec: BoosterSpec) -> DataFrame:
    y = F.col(spec.label).cast("double")
    w = F.lit(1.0) if spec.weight is None else F.col(spec.weight).cast("double")
    u = F.xxhash64(F.col(spec.key)) if spec.key else F.lit(0).cast("bigint")
    return df.select(*spec.features, y.alias("_y"), w.alias("_w"), u.alias("_u"))


def fit_booster(df: DataFrame, spec: BoosterSpec, edges: list[np.ndarray] | None = None) -> Booster:
    """Fit one model."""
    return fit_boosters(df, [spec], edges)[0]


#: What models that are fitted together must have in common.
SHARED = ("features", "label", "objective", "weight", "key", "max_bins")


def fit_boosters(df: DataFrame, specs: Sequence[BoosterSpec], edges: list[np.ndarray] | None = None) -> list[Booster]:
    """Fit several models of one target over the same rows, round by round and all together.

    The models share the binned rows, and every job works for all of them, so ten points of a
    search take as many passes as the longest of them.  Rounds come in blocks of ``refresh``.
    Where all rows fit a task, a block is one job: each model's rows meet in a task
    that grows the block's trees.
    More rows stay in the memory of tasks that run side by side and exchange only sums, in one
    job for all rounds; where such tasks cannot be, or have no folder to meet, models of up to ``trees.MODEL_BYTES``
    are grown in tasks of their own, again by one job.  Where their nodes are too many for that, the jobs of ``trees.grow`` make one round.
    All ways search the same sums with the same rules.  Scores of the rows are kept for the trees up
    to the last block, one number per model; a task adds the few trees since, which are
    broadcast once.  After a block the scores are written to the shared folder, so the work of
    a round does not grow with their number and the plan stays as short as at the start.
    """
    lead, spark = specs[0], df.sparkSession
    if any(getattr(s, name) != getattr(lead, name) for s in specs for name in SHARED):
        raise ValueError(f"models fitted together must have the same {', '.join(SHARED)}")
    rows = _labelled(df, lead)
    edges = tr.fit_edges(rows, lead.features, lead.max_bins) if edges is None else edges
    binned = tr.bin_blocks(rows, lead.features, edges, ["_y", "_w", "_u"]).persist(StorageLevel.MEMORY_AND_DISK)
    held, stored, sent = [binned], [], []
    try:
        p, n_edges = len(lead.features), [len(e) for e in edges]
        sums = tr.block_sums(binned, p, lambda c: {"w": c["_w"], "wy": c["_w"] * c["_y"], "w1": c["_w"][c["_y"] == 1]})
        n = sums["n"]
        extra = [(s.scale_pos_weight - 1.0) * sums["w1"] if s.objective == "logistic" else 0.0 for s in specs]
        bases = np.array([base_score(lead.objective, (sums["wy"] + x) / (sums["w"] + x)) if n else 0.0 for x in extra])
        current = tr.fewer_tasks(binned, n, p)
        grown: list[list[tr.Tree]] = [[] for _ in specs]
        total = max(s.n_estimators for s in specs)
        if n > tr.small_rows(p, 4):
            new, size = None, n * (p + 32)
            folder = meeting_folder(spark) if size > min(tr.HELD_FROM_BYTES, tr.MODEL_BYTES) else None
            try:
                if size > tr.MODEL_BYTES or folder is not None:
                    if tasks := tr.held_tasks(spark, n, p, sum(2 ** (s.max_depth - 1) for s in specs), len(specs), folder is not None):
                        new = _fit_in_memory(binned, specs, bases, n_edges, tasks, folder)
            finally:
                if folder is not None:
                    drop_dir(spark, folder)
            if new is None and size <= tr.MODEL_BYTES:
                new = _block_in_tasks(current, specs, [], bases, 0, total, n_edges)
            if new is not None:
                return [Booster(s, new[c], edges, float(bases[c])) for c, s in enumerate(specs)]
        for start in range(0, total, lead.refresh):
            if start:
                path = scratch_dir(spark, "scores")
                _settled(current, sent, bases, p).write.parquet(path)
                current = tr.fewer_tasks(spark.read.parquet(path), n, p).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(current)
                stored.append(path)
                # The table before this one is no longer read, nor are the trees in it.
                if len(held) > 2:
                    held.pop(1).unpersist()
                    drop_dir(spark, stored.pop(0))
                for b in sent:
                    b.unpersist()
                sent = []
            stop = min(start + lead.refresh, total)
            if n <= tr.small_rows(p, 4):
                new = _block_in_tasks(current, specs, sent, bases, start, stop, n_edges)
                for c, trees in new.items():
                    grown[c] += trees
                sent.append(spark.sparkContext.broadcast({c: [t.arrays() for t in trees] for c, trees in new.items()}))
                continue
            for number in range(start, stop):
                new = _round(current, specs, list(sent), bases, number, n_edges, n)
                for c, tree in new.items():
                    grown[c].append(tree)
                sent.append(spark.sparkContext.broadcast({c: [t.arrays()] for c, t in new.items()}))
        return [Booster(s, t, edges, float(b)) for s, t, b in zip(specs, grown, bases)]
    finally:
        for table in held:
            table.unpersist()
        for path in stored:
            drop_dir(spark, path)
        for b in sent:
            b.unpersist()


def _slopes(spec: BoosterSpec, number: int, f: np.ndarray, y: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a round and their statistics: count, weighted first and second derivative."""
    g, h = gradients(spec, f, y)
    w = row_weights(spec, y, w)
    use = np.ones(len(y), dtype=bool)
    if spec.subsample < 1:
        use = _row_luck(u, spec.seed * 1_000_003 + number) < spec.subsample
    return use, np.column_stack([np.ones(len(y)), w * g, w * h])


def _allowed(spec: BoosterSpec, number: int) -> list[int] | None:
    return _columns_of_tree(spec, number) if spec.colsample_bytree < 1 else None


def _round(current: DataFrame, specs: Sequence[BoosterSpec], recent: Sequence, bases: np.ndarray, number: int, n_edges: Sequence[int], n: int) -> dict[int, tr.Tree]:
    """One tree of every model that still grows."""
    active = [c for c, s in enumerate(specs) if number < s.n_estimators]

    def row_stats(columns, bins, t):
        c = active[t]
        return _slopes(specs[c], number, _scores(columns, bins, recent, bases, c), *(columns[name] for name in ("_y", "_w", "_u")))

    own = [specs[c] for c in active]
    trees = tr.grow(current, len(own), row_stats, [_gain(s) for s in own], n_edges, 3, [s.max_depth for s in own], [_allowed(s, number) for s in own], n_rows=n)
    for s, tree in zip(own, trees):
        _set_steps(s, tree)
    return dict(zip(active, trees))


def _block_in_tasks(current: DataFrame, specs: Sequence[BoosterSpec], recent: Sequence, bases: np.ndarray, start: int, stop: int, n_edges: Sequence[int]) -> dict[int, list[tr.Tree]]:
    """The trees of several rounds of every model that still grows, where a model's rows fit a task."""
    active = [c for c, s in enumerate(specs) if start < s.n_estimators]
    p, layout = len(n_edges), tr.Layout(n_edges)

    def deal(batches):
        for batch in batches:
            for columns, bins in read_blocks(batch, p):
                y, w, u = (columns[name] for name in ("_y", "_w", "_u"))
                rows = [np.column_stack([y, w, _scores(columns, bins, recent, bases, c)]).tobytes() + u.tobytes() for c in active]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(active)), pa.int32()), pa.array([bins.tobytes()] * len(active), pa.binary()), pa.array(rows, pa.binary())], ["slot", "bins", "stats"])

    def boost(batches):
        held: dict = {}
        for batch in batches:
            for slot, bins, rows in zip(*[batch.column(c).to_pylist() for c in ("slot", "bins", "stats")]):
                k = len(bins) // p
                held.setdefault(slot, []).append((np.frombuffer(bins, dtype="uint8").reshape(k, p), np.frombuffer(rows, count=3 * k).reshape(k, 3), np.frombuffer(rows, dtype="int64", offset=24 * k)))
        for slot, parts in held.items():
            bins, numbers, u = (np.concatenate(x) for x in zip(*parts))
            # Rows may arrive in any order; the sums must not depend on it.
            mark = np.concatenate([b @ np.arange(1.0, p + 1) for b, _, _ in parts])
            order = np.lexsort((mark, *numbers.T, u))
            bins, (y, w, f), u = bins[order], numbers[order].T, u[order]
            spec, columns = specs[active[slot]], layout.columns(bins)
            for number in range(start, min(stop, spec.n_estimators)):
                use, stats = _slopes(spec, number, f, y, w, u)
                drawn = (bins, stats) if use.all() else (bins[use], stats[use])
                tree = grow_small(layout, *drawn, _gain(spec), _allowed(spec, number), spec.max_depth, 2, columns if use.all() else None)
                _set_steps(spec, tree)
                f = add_trees(f, bins, [tree.arrays()])
                yield tree_row(slot, number, tree)

    dealt = current.mapInArrow(deal, tr.ROWS_TYPE).repartitionById(len(active), "slot")
    out: dict[int, list[tr.Tree]] = {c: [] for c in active}
    for row in sorted(dealt.mapInArrow(boost, tr.SUBTREE_TYPE).toArrow().to_pylist(), key=lambda r: r["number"]):
        out[active[row["slot"]]].append(tr.tree_of_row(row, 3))
    if any(len(trees) < min(stop, specs[c].n_estimators) - start for c, trees in out.items()):
        raise ValueError("there are no rows to fit a model to")
    return out


def _fit_in_memory(binned: DataFrame, specs: Sequence[BoosterSpec], bases: np.ndarray, n_edges: Sequence[int], tasks: int, folder: str | None) -> dict[int, list[tr.Tree]]:
    """All trees of all models by one job of tasks that run side by side (a barrier stage).

    A task keeps its rows, column by column, with their scores, and the rows of each node.  For a level every
    task sums the smaller child of every split, the other child being the rest, and searches a part
    of the features in the sums of all tasks.  Nodes whose rows are less to send than their sums are grown to
    their ends in one task each.
    """
    p, layout, total = len(n_edges), Layout(n_edges), max(s.n_estimators for s in specs)
    gathered = tr.GATHERED_BYTES
    # Features of each task, so that all have about as many cells.
    shares: list[list[int]] = [[] for _ in range(tasks)]
    for f in sorted(range(p), key=lambda f: -n_edges[f]):
        min(shares, key=lambda own: sum(n_edges[g] + 1 for g in own)).append(f)
    layouts = [Layout(n_edges, sorted(own)) for own in shares]
    at_once = max(1, tr.TASK_CELLS // (layout.cells + 1))
    sums_bytes, most_small = 24 * tasks * (layout.cells + 1), tr.small_rows(p, 4)

    def boost(batches):
        meeting = Meeting(BarrierTaskContext.get(), folder, gathered)
        blocks = [block for batch in batches for block in read_blocks(batch, p)]
        columns = np.empty((p, sum(len(b) for _, b in blocks)), dtype="uint8")
        start = 0
        for _, b in blocks:
            columns[:, start : start + len(b)] = b.T
            start += len(b)
        y, w, u = (np.concatenate([np.zeros(0, dtype=kind), *[c[name] for c, _ in blocks]]) for name, kind in (("_y", "float64"), ("_w", "float64"), ("_u", "int64")))
        del blocks
        digests = meeting.share(b"".join(hashlib.md5(column).digest() for column in columns))
        first: dict = {}
        same = [first.setdefault((n_edges[f], *(d[16 * f : 16 * f + 16] for d in digests)), f) for f in range(p)]
        data, mine = HeldRows(columns, n_edges, same, layouts), layouts[meeting.me]
        scores = [np.full(len(y), float(b)) for b in bases]
        gains = [_gain(s) for s in specs]

        def small(c: int, tree: Tree, node: int) -> bool:
            rows, left = tree.stats[node][0], specs[c].max_depth - tree.depth[node]
            return rows <= most_small and 2 * rows * (p + 24) <= sums_bytes * 2 ** (left - 1)

        for number in range(total):
            active = [c for c, s in enumerate(specs) if number < s.n_estimators]
            trees = {c: Tree() for c in active}
            slopes, rows, drawn = {}, {}, {}
            for c in active:
                use, stats = _slopes(specs[c], number, scores[c], y, w, u)
                slopes[c] = [np.ascontiguousarray(stats[:, j]) for j in (1, 2)]
                # Rows of a node that were drawn for the round, and the others.
                kinds = (np.arange(len(y), dtype="int32"), np.zeros(0, dtype="int32")) if use.all() else (np.flatnonzero(use).astype("int32"), np.flatnonzero(~use).astype("int32"))
                rows[c, 0] = kinds
            allowed = {c: _allowed(specs[c], number) for c in active}
            masks = {c: None if own is None else np.isin(mine.feature, own) for c, own in allowed.items()}

            def divide(c: int, node: int) -> None:
                tree, kinds = trees[c], rows.pop((c, node))
                sides = [data.split(x, tree.feature[node], tree.cut[node]) for x in kinds]
                for child, side in ((tree.left[node], 0), (tree.right[node], 1)):
                    rows[c, child] = tuple(x[side] for x in sides)

            # (model, node to be summed up, its sibling or −1, their parent or −1); the sums of this task's features by node.
            level, kept, waiting = [(c, 0, -1, -1) for c in active], {}, []
            while level:
                found = []
                for start in range(0, len(level), at_once):
                    some = level[start : start + at_once]
                    sums = [np.zeros((len(some), x.cells + 1, 3)) for x in layouts]
                    for i, (c, node, _, _) in enumerate(some):
                        data.add_sums([x[i] for x in sums], rows[c, node][0], slopes[c])
                    own = sum(np.frombuffer(x).reshape(len(some), mine.cells + 1, 3) for x in meeting.swap([x.tobytes() for x in sums]))
                    found += [(c, node, own[i]) for i, (c, node, _, _) in enumerate(some)]
                    found += [(c, other, kept[c, parent] - own[i]) for i, (c, _, other, parent) in enumerate(some) if other >= 0]
                found.sort(key=lambda x: x[:2])
                kept = {(c, node): own for c, node, own in found}
                answers = np.zeros((len(found), 9))
                for i, (c, node, own) in enumerate(found):
                    best = mine.best(own, gains[c], masks[c]) if own[-1, 0] >= 2 and trees[c].depth[node] < specs[c].max_depth else None
                    answers[i] = (0.0, -1, 0, 0, 0, 0, *own[-1]) if best is None else (*best[:3], *best[3], *own[-1])
                answers = np.stack([np.frombuffer(x).reshape(-1, 9) for x in meeting.share(answers.tobytes())])
                level = []
                for i, (c, node, _) in enumerate(found):
                    tree, depth = trees[c], specs[c].max_depth
                    gain, f, cut, *stats = min(answers[:, i].tolist(), key=lambda x: (x[1] < 0, -x[0], x[1], x[2]))
                    tree.stats[node] = tree.stats[node] or tuple(stats[3:])
                    if f < 0:
                        continue
                    left, whole = np.array(stats[:3]), np.array(stats[3:])
                    tree.split(node, int(f), int(cut), gain, tuple(left), tuple(whole - left))
                    divide(c, node)
                    if tree.depth[node] + 1 < depth:
                        pair = sorted((tree.left[node], tree.right[node]), key=lambda k: tree.stats[k][0])
                        if small(c, tree, pair[1]):
                            waiting += [(c, k) for k in pair if tree.stats[k][0] >= 2]
                        elif tree.stats[pair[1]][0] >= 2:
                            level.append((c, *pair, node))
            if waiting:
                # The largest nodes are dealt first, each to the task with least to do.
                work, owner = [0.0] * tasks, {}
                for c, node in sorted(waiting, key=lambda x: (-trees[x[0]].stats[x[1]][0], x)):
                    j = owner[c, node] = min(range(tasks), key=lambda j: (work[j], j))
                    work[j] += trees[c].stats[node][0] + 1000
                dealt = [[x for x in waiting if owner[x] == j] for j in range(tasks)]
                parts = []
                for own in dealt:
                    part = [np.array([len(rows[x][0]) for x in own], dtype="int64").tobytes()]
                    for c, node in own:
                        k = rows[c, node][0]
                        part += [columns[:, k].T.tobytes(), *[s[k].tobytes() for s in slopes[c]]]
                    parts.append(b"".join(part))
                came = meeting.swap(parts)
                own, grown = dealt[meeting.me], []
                sizes = [np.frombuffer(x, count=len(own), dtype="int64") for x in came]
                ends = [8 * len(own)] * tasks
                for i, (c, node) in enumerate(own):
                    bins, stats = [], []
                    for j, x in enumerate(came):
                        k, at = int(sizes[j][i]), ends[j]
                        bins.append(np.frombuffer(x, dtype="uint8", count=k * p, offset=at).reshape(k, p))
                        slope = np.frombuffer(x[at + k * p : at + k * (p + 16)]).reshape(2, k)
                        stats.append(np.column_stack([np.ones(k), *slope]))
                        ends[j] = at + k * (p + 16)
                    subtree = grow_small(layout, np.concatenate(bins), np.concatenate(stats), gains[c], allowed[c], specs[c].max_depth - trees[c].depth[node], 2)
                    grown.append((c, node, subtree.__dict__))
                for c, node, held in sorted((x for part in meeting.share(pickle.dumps(grown)) for x in pickle.loads(part)), key=lambda x: x[:2]):
                    trees[c].graft(node, Tree(**held))
                    for n in trees[c].inner_below(node):
                        divide(c, n)
            for c, tree in trees.items():
                _set_steps(specs[c], tree)
            for (c, node), kinds in rows.items():
                for k in kinds:
                    scores[c][k] += trees[c].value[node]
            if meeting.me == 0:
                for c, tree in trees.items():
                    yield tree_row(c, number, tree.level_order())
        meeting.close()

    dealt = binned.repartition(tasks)
    out: dict[int, list[tr.Tree]] = {c: [] for c in range(len(specs))}
    for row in sorted(dealt.mapInArrow(boost, tr.SUBTREE_TYPE, barrier=True).toArrow().to_pylist(), key=lambda r: r["number"]):
        out[row["slot"]].append(tr.tree_of_row(row, 3))
    return out


def _set_steps(spec: BoosterSpec, tree: tr.Tree) -> None:
    for n, s in enumerate(tree.stats):
        if s:
            step = -_soft(np.array(s[1]), spec.reg_alpha) / (s[2] + spec.reg_lambda + 1e-12)
            if spec.objective == "poisson":
                step = np.clip(step, -spec.max_delta_step, spec.max_delta_step)
            tree.value[n] = float(step) * spec.learning_rate


def _scores(columns: dict, bins: np.ndarray, recent: Sequence, bases: np.ndarray, c: int) -> np.ndarray:
    """Raw scores of model ``c``: those of the table, if it has any, and the trees since."""
    if "_m" in columns:
        f = columns["_m"].reshape(len(bases), len(bins))[c]
    else:
        f = np.full(len(bins), bases[c])
    return add_trees(f, bins, [a for b in recent for a in b.value.get(c, ())])


def _settled(scored: DataFrame, recent: Sequence, bases: np.ndarray, p: int) -> DataFrame:
    """The blocks with the scores of all models in one more column, model by model."""

    def add(batches):
        for batch in batches:
            for columns, bins in read_blocks(batch, p):
                scores = np.concatenate([_scores(columns, bins, recent, bases, c) for c in range(len(bases))])
                own = {name: columns[name].tobytes() for name in ("_y", "_w", "_u")} | {"bins": bins.tobytes(), "_m": scores.tobytes()}
                yield pa.RecordBatch.from_pydict({name: pa.array([x], pa.binary()) for name, x in own.items()})

    return scored.mapInArrow(add, "_y binary, _w binary, _u binary, bins binary, _m binary")


def expand_vector(df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """A feature vector as named double columns."""
    from pyspark.ml.functions import vector_to_array

    wide = df.withColumn("_v", vector_to_array(vector))
    return wide.withColumns({n: F.col("_v")[i] for i, n in enumerate(names)}).drop("_v")


def with_params(spec: BoosterSpec, **params) -> BoosterSpec:
    """Spec with other values; whole-number parameters are rounded down."""
    whole = {k: int(v) for k, v in params.items() if k in ("max_depth", "n_estimators", "min_child_weight")}
    return replace(spec, **{**params, **whole})
