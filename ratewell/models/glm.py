"""Generalised linear models of counts with an exposure offset.

A model is a list of terms, given as such or as text (``formula``).  A term is a numeric
column, a categorical column with a reference level, or a product of columns of
either kind; stepwise selection drops whole terms.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.errors import UnsupportedOperationException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import features as fx
from ..operators.encode import fit_levels
from ..operators.features import ordered_levels
from ..roles import MINE, Roles
from ..session import side_by_side

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Term:
    """One term of a model formula."""

    columns: tuple[str, ...]
    reference: str | None = None
    categorical: bool = False
    #: Categorical columns of a product.
    factors: tuple[str, ...] = ()

    @property
    def categories(self) -> tuple[str, ...]:
        return self.columns if self.categorical else self.factors

    @property
    def name(self) -> str:
        return ":".join(self.columns)


def number(column: str) -> Term:
    return Term((column,))


def category(column: str, reference: str | None = None) -> Term:
    return Term((column,), reference, True)


def product(*columns: str, factors: Sequence[str] = ()) -> Term:
    return Term(columns, factors=tuple(c for c in columns if c in factors))


NAME = r"[A-Za-z_][A-Za-z0-9_]*"


def formula(text: str, columns: Sequence[str] = (), categories: Sequence[str] = (), references: Mapping[str, str] | None = None, **settings) -> "GlmSpec":
    """A model from text such as ``y ~ . - a + b:c + d * e + offset(log(hours))``.

    Terms are added and taken away from left to right; ``.`` stands for all of
    ``columns`` but the response and the exposure, ``a * b`` for ``a + b + a:b``.  Columns among
    ``categories`` enter by their levels, less the reference level (the first one unless
    ``references`` names it), in products, too.  Other settings are those of ``GlmSpec``.
    """
    bare = re.sub(r"\s+", "", text)
    shape = re.fullmatch(rf"({NAME})~(.+)", bare)
    if not shape:
        raise ValueError(f"not a formula: {text}")
    response, right = shape.groups()
    exposure, terms = None, {}

    def term(names: Sequence[str]) -> Term:
        if len(names) == 1 and names[0] in categories:
            return category(names[0], (references or {}).get(names[0]))
        return product(*names, factors=categories)

    parts = [m.groups() for m in re.finditer(rf"([+-]?)(offset\(log\({NAME}\)\)|\.|{NAME}(?:[:*]{NAME})*)", right)]
    if "".join(sign + body for sign, body in parts) != right or any(not sign for sign, _ in parts[1:]):
        raise ValueError(f"not a formula: {text}")
    for _, body in parts:
        if body.startswith("offset"):
            exposure = body[len("offset(log(") : -2]
    for sign, body in parts:
        if body.startswith("offset"):
            continue
        if body == ".":
            new = [(c,) for c in columns if c not in (response, exposure)]
        elif "*" in body:
            names = body.split("*")
            new = [c for size in range(1, len(names) + 1) for c in combinations(names, size)]
        else:
            new = [tuple(body.split(":"))]
        for names in new:
            if sign == "-":
                terms.pop(frozenset(names), None)
            else:
                terms.setdefault(frozenset(names), term(names))
    return GlmSpec(tuple(sorted(terms.values(), key=lambda t: len(t.columns))), count=response, exposure=exposure, **settings)


@dataclass(frozen=True)
class GlmSpec:
    """What to fit; ``family`` may be any the linear-model solver knows."""

    terms: tuple[Term, ...]
    count: str = MINE.count
    exposure: str | None = MINE.exposure
    unit: float = MINE.unit
    weight: str | None = None
    family: str = "poisson"
    link: str | None = "log"
    variance_power: float | None = None
    max_iter: int = 50
    tol: float = 1e-9

    def without(self, name: str) -> "GlmSpec":
        return replace(self, terms=tuple(t for t in self.terms if t.name != name))


@dataclass
class FittedGlm:
    spec: GlmSpec
    model: GeneralizedLinearRegressionModel
    names: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Expected counts, exposure included."""
        scored = self.model.transform(design(df, self.spec, self.levels))
        keep = [c for c in df.columns if c != out]
        return scored.select(*keep, F.col("prediction").alias(out))

    def coefficients(self) -> DataFrame:
        """Name, estimate, error, z, p and percent effect of a unit change; one row per coefficient.

        A rank-deficient design has no standard errors: they are null then.
        """
        values = [*self.model.coefficients.toArray().tolist(), float(self.model.intercept)]
        names = [*self.names, "(Intercept)"]
        try:
            s = self.model.summary
            spread = list(zip(s.coefficientStandardErrors, s.tValues, s.pValues))
        except UnsupportedOperationException:  # the solver that copes with dependent columns gives none
            spread = [(None, None, None)] * len(names)
        rows = [
            (n, float(v), *[None if x is None else float(x) for x in e], 100.0 * (float(np.exp(v)) - 1.0))
            for n, v, e in zip(names, values, spread)
        ]
        schema = "name string, estimate double, std_error double, z double, p double, effect_pct double"
        return SparkSession.active().createDataFrame(rows, schema)

    @property
    def aic(self) -> float:
        return float(self.model.summary.aic)

    @property
    def deviance(self) -> float:
        return float(self.model.summary.deviance)

    def save(self, path: str) -> None:
        """Model and coefficient names; ``load`` needs the same spec."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        rows = [(c, i, v) for c, vs in self.levels.items() for i, v in enumerate(vs)]
        spark.createDataFrame(rows, "column string, place int, level string").coalesce(1).write.mode("overwrite").parquet(f"{path}/levels")
        spark.createDataFrame(list(enumerate(self.names)), "index int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/names")

    @classmethod
    def load(cls, path: str, spec: GlmSpec) -> "FittedGlm":
        spark = SparkSession.active()
        levels: dict[str, list[str]] = {}
        for r in spark.read.parquet(f"{path}/levels").orderBy("column", "place").collect():
            levels.setdefault(r["column"], []).append(r["level"])
        names = [r["name"] for r in spark.read.parquet(f"{path}/names").orderBy("index").collect()]
        return cls(spec, GeneralizedLinearRegressionModel.load(f"{path}/model"), names, levels)


def model_levels(df: DataFrame, terms: Sequence[Term]) -> dict[str, list[str]]:
    """Levels of the categorical terms, reference first."""
    references = {t.columns[0]: t.reference for t in terms if t.categorical}
    names = list(dict.fromkeys(c for t in terms for c in t.categories))
    found = fit_levels(df, names)
    return {c: ordered_levels(found[c], references.get(c)) for c in names}


def _columns(term: Term, levels: dict[str, list[str]]):
    out = [("", None)]
    for c in term.columns:
        flags = [(f"{c}_{v}", fx.level_flag(c, v).cast("double")) for v in levels[c][1:]] if c in term.categories else [(c, F.col(c).cast("double"))]
        out = [(f"{a}:{b}" if a else b, x if y is None else y * x) for a, y in out for b, x in flags]
    return out


def feature_names(terms: Sequence[Term], levels: dict[str, list[str]]) -> list[str]:
    return [n for t in terms for n, _ in _columns(t, levels)]


def design(df: DataFrame, spec: GlmSpec, levels: dict[str, list[str]]) -> DataFrame:
    """The table with ``_x`` (feature vector) and ``_offset`` (log exposure) added."""
    pairs = [p for t in spec.terms for p in _columns(t, levels)]
    new = {f"_x{i}": c for i, (_, c) in enumerate(pairs)}
    new["_offset"] = F.lit(0.0) if spec.exposure is None else fx.log_exposure(spec.exposure, spec.unit)
    wide = df.withColumns(new)
    assembled = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(pairs))], outputCol="_x", handleInvalid="error").transform(wide)
    return assembled.drop(*[f"_x{i}" for i in range(len(pairs))])


def fit_glm(df: DataFrame, spec: GlmSpec, levels: dict[str, list[str]] | None = None) -> FittedGlm:
    """Maximum-likelihood fit; rows are only summed up, once per iteration."""
    levels = model_levels(df, spec.terms) if levels is None else levels
    solver = GeneralizedLinearRegression(
        family=spec.family, labelCol="_y", featuresCol="_x", offsetCol="_offset", maxIter=spec.max_iter, tol=spec.tol
    )
    if spec.link is not None and spec.family != "tweedie":
        solver = solver.setLink(spec.link)
    if spec.family == "tweedie":
        solver = solver.setVariancePower(spec.variance_power or 1.1).setLinkPower(0.0)
    if spec.weight is not None:
        solver = solver.setWeightCol("_w")
    rows = design(df, spec, levels).select(
        "_x", "_offset", F.col(spec.count).cast("double").alias("_y"), *([F.col(spec.weight).cast("double").alias("_w")] if spec.weight else [])
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return FittedGlm(spec, solver.fit(rows), feature_names(spec.terms, levels), levels)
    finally:
        rows.unpersist()


@dataclass
class Step:
    removed: str | None
    aic: float


def step_aic(df: DataFrame, spec: GlmSpec) -> tuple[FittedGlm, list[Step]]:
    """Drop terms one by one while the AIC falls.

    A main effect stays as long as a product of it is in the model.  All candidates of a
    step are blocks of one design and are refined in common passes, so the jobs
    of a step do not grow with the number of terms.  Families other than
    Poisson with the log link are fitted candidate by candidate.
    """
    need = sorted({c for t in spec.terms for c in t.columns} | {spec.count} | {c for c in (spec.exposure, spec.weight) if c})
    rows = df.select(*need).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        levels = model_levels(rows, spec.terms)
        if spec.family == "poisson" and spec.link in (None, "log"):
            # The packed rows go before the last fit holds its own.
            with CommonPasses(rows, spec, levels) as passes:
                best, path = _drop_terms(spec, passes)
        else:
            best, path = _drop_terms(spec, lambda specs: side_by_side([partial(lambda s: fit_glm(rows, s, levels).aic, s) for s in specs]))
        return fit_glm(rows, best, levels), path
    finally:
        rows.unpersist()


def _drop_terms(spec: GlmSpec, measure: Callable[[Sequence[GlmSpec]], list[float]]) -> tuple[GlmSpec, list[Step]]:
    best, path = spec, [Step(None, measure([spec])[0])]
    while len(best.terms) > 1:
        held = {c for t in best.terms if len(t.columns) > 1 for c in t.columns}
        free = [t.name for t in best.terms if len(t.columns) > 1 or t.columns[0] not in held]
        if not free:
            break
        aics = measure([best.without(n) for n in free])
        place = min(range(len(aics)), key=lambda i: aics[i])
        if aics[place] >= path[-1].aic:
            break
        best = best.without(free[place])
        path.append(Step(free[place], aics[place]))
    return best, path


#: Rows of the design in a packed block.
BLOCK = 8192
PACKED = "full binary, dense binary, at binary, value binary, y double, e double, constant double"


class CommonPasses:
    """AIC of several Poisson models that are parts of one design, by Newton steps in common passes.

    The design is evaluated once, packed in blocks of rows and held until ``release``.  A pass reads the blocks
    and sends, for every model that still moves, one packed array a task: X'WX, X'(y − μ) and
    the log-likelihood.  The arrays are added up on the cluster; the driver solves systems as
    large as the number of coefficients.
    """

    def __init__(self, df: DataFrame, spec: GlmSpec, levels: dict[str, list[str]]):
        pairs = [(t.name, n, c) for t in spec.terms for n, c in _columns(t, levels)]
        self.terms, self.spec = [t for t, _, _ in pairs], spec
        offset = F.lit(0.0) if spec.exposure is None else fx.log_exposure(spec.exposure, spec.unit)
        weight = F.lit(1.0) if spec.weight is None else F.col(spec.weight).cast("double")
        columns = F.array(F.lit(1.0), *[c for _, _, c in pairs])
        rows = df.select(columns.alias("x"), F.col(spec.count).cast("double").alias("y"), offset.alias("o"), weight.alias("w"))
        self.blocks = rows.mapInArrow(partial(_packed, len(pairs) + 1), PACKED).persist(StorageLevel.MEMORY_AND_DISK)
        sums = self.blocks.agg(*[F.sum(c).alias(c) for c in ("y", "e", "constant")]).first()
        self.start = np.zeros(len(pairs) + 1)
        self.start[0] = np.log(max(sums["y"] or 0.0, 1e-9) / (sums["e"] or 1.0))
        self.constant = sums["constant"] or 0.0
        #: AIC, log-likelihood, places, coefficients and X'WX of the models of the last call.
        self.settled: list[tuple[float, float, np.ndarray, np.ndarray, np.ndarray]] = []

    def release(self) -> None:
        self.blocks.unpersist()

    def __enter__(self) -> "CommonPasses":
        return self

    def __exit__(self, *error) -> None:
        self.release()

    def _begin(self, places: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, float] | None]:
        """Where a model starts: at the best settled model that holds it, less the terms it lacks.

        That model's X'WX tells how the others change when those terms become zero, so no pass is needed for this
        step.  With it come the coefficients without the step, and the log-likelihood below which they are taken.
        """
        for _, ll, held, beta, gram in sorted(self.settled, key=lambda m: m[0]):
            if set(places.tolist()) <= set(held.tolist()):
                kept = np.isin(held, places)
                lost = beta[~kept]
                pull = gram[np.ix_(kept, ~kept)] @ lost
                move = np.linalg.lstsq(gram[np.ix_(kept, kept)], pull, rcond=None)[0]
                loss = float(lost @ gram[np.ix_(~kept, ~kept)] @ lost - pull @ move) / 2
                return beta[kept] + move, (beta[kept], ll - 2.0 * loss - 1.0)
        return self.start[places], None

    def __call__(self, specs: Sequence[GlmSpec]) -> list[float]:
        kept = [{t.name for t in s.terms} for s in specs]
        places = [np.array([0, *[i + 1 for i, t in enumerate(self.terms) if t in k]]) for k in kept]
        begun = [self._begin(p) for p in places]
        beta, jumps = [b for b, _ in begun], [j for _, j in begun]
        before, value, last, grams = [-np.inf] * len(specs), [None] * len(specs), [None] * len(specs), [None] * len(specs)
        moving = list(range(len(specs)))
        for _ in range(2 * self.spec.max_iter):
            sums = self._pass([(places[c], beta[c]) for c in moving])
            still = []
            for c, (gram, slope, ll) in zip(moving, sums):
                jump, jumps[c] = jumps[c], None
                if jump is not None and not ll >= jump[1]:
                    # The terms matter too much for that step: begin without it.
                    beta[c] = jump[0]
                    still.append(c)
                    continue
                if last[c] is not None and not ll >= before[c] - 1e-9 * (abs(before[c]) + 1.0):
                    # Too long a step: half of it.
                    beta[c] = (beta[c] + last[c]) / 2
                    still.append(c)
                    continue
                value[c], grams[c] = ll, gram
                least = 1e-11 * (abs(ll) + 0.1)
                if abs(ll - before[c]) <= least:
                    continue
                before[c], last[c] = ll, beta[c]
                move = np.linalg.lstsq(gram, slope, rcond=None)[0]
                beta[c] = beta[c] + move
                gain = float(slope @ move) / 2
                if gain <= least:
                    # The step adds no more than that, so no pass is needed to see it.
                    value[c] = ll + gain
                    continue
                still.append(c)
            moving = still
            if not moving:
                break
        aics = [-2.0 * v + 2.0 * len(p) for v, p in zip(value, places)]
        self.settled = list(zip(aics, value, places, beta, grams))
        return aics

    def _pass(self, models: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        p = len(self.terms) + 1

        def partial_sums(batches):
            total = [np.zeros(len(i) ** 2 + len(i) + 1) for i, _ in models]
            for batch in batches:
                for x, y, o, w in _unpacked(p, batch):
                    for s, (i, b) in zip(total, models):
                        part = x if len(i) == p else x[i]
                        eta = b @ part + o
                        mu = np.exp(np.minimum(eta, 700.0))
                        gram = (part * (w * mu)) @ part.T
                        s += np.concatenate([gram.ravel(), part @ (w * (y - mu)), [(w * (y * eta - mu)).sum()]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(models)), pa.int32()), pa.array([s.tobytes() for s in total], pa.binary())], ["model", "sums"])

        def add(batches):
            total: dict = {}
            for batch in batches:
                for m, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    s = np.frombuffer(s)
                    total[m] = total[m] + s if m in total else s
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([s.tobytes() for s in total.values()], pa.binary())], ["model", "sums"])

        parts = self.blocks.mapInArrow(partial_sums, "model int, sums binary").repartitionById(len(models), "model")
        found = parts.mapInArrow(add, "model int, sums binary").toArrow()
        sums = dict(zip(found.column("model").to_pylist(), found.column("sums").to_pylist()))
        out = []
        for m, (i, _) in enumerate(models):
            s, k = np.frombuffer(sums[m]), len(i)
            out.append((s[: k * k].reshape(k, k), s[k * k : -1], float(s[-1]) - self.constant))
        return out


def _packed(p: int, batches):
    """Blocks of a design with ``p`` columns: those mostly filled as they are, one after the other, then
    response, offset and weight; of all others the places and values that are not zero."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            x = some.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p).T
            y, o, w = (some.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            filled = 2 * np.count_nonzero(x, axis=1) > x.shape[1]
            full, thin = np.flatnonzero(filled).astype(np.int32), np.flatnonzero(~filled)
            column, row = np.nonzero(x[thin])
            places = (thin[column] * x.shape[1] + row).astype(np.int32)
            counts, which = np.unique(y, return_inverse=True)
            log_factorial = np.array([math.lgamma(v + 1.0) for v in counts])[which]
            parts = [full, np.concatenate([x[full], [y, o, w]]), places, x[thin[column], row]]
            sums = [(w * y).sum(), (w * np.exp(o)).sum(), (w * log_factorial).sum()]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([v.tobytes()], pa.binary()) for v in parts], *[pa.array([v], pa.float64()) for v in sums]],
                ["full", "dense", "at", "value", "y", "e", "constant"],
            )


def _unpacked(p: int, batch):
    """Design (a line for each column), response, offset and weight of each block."""
    for block in range(batch.num_rows):
        full, dense, at, value = (np.frombuffer(batch.column(c)[block].as_buffer(), t) for c, t in enumerate(("i4", "f8", "i4", "f8")))
        dense = dense.reshape(len(full) + 3, -1)
        x = np.zeros((p, dense.shape[1]))
        x[full] = dense[:-3]
        x.reshape(-1)[at] = value
        yield x, *dense[-3:]


def step_table(path: Sequence[Step]) -> DataFrame:
    rows = [(i, s.removed, s.aic) for i, s in enumerate(path)]
    return SparkSession.active().createDataFrame(rows, "step int, removed string, aic double")


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Sums of products of all column pairs (a constant first) and the row count.

    Every task sends one small matrix, added up by the cluster.
    """
    p = len(columns) + 1

    def partial(batches):
        total = np.zeros((p, p))
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf.to_numpy(dtype="float64")])
            total += x.T @ x
        import pandas as pd

        i, j = np.indices((p, p))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    parts = df.select(*[F.col(c).cast("double") for c in columns]).mapInPandas(partial, "i int, j int, v double")
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((p, p))
    for r in cells:
        gram[r["i"], r["j"]] = r["v"]
    return gram, int(round(gram[0, 0]))


def dependent_columns(df: DataFrame, columns: Sequence[str], tol: float = 1e-9) -> list[str]:
    """Columns that are a linear combination of the constant and the columns before them.

    Constant columns and the last of a set that always adds up to one are
    found this way; leave them out before asking for standard errors.
    """
    gram, _ = gram_matrix(df, columns)
    size = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    a = gram / np.outer(size, size)
    out = []
    for k in range(a.shape[0]):
        pivot = a[k, k]
        if pivot <= tol:
            if k > 0:
                out.append(columns[k - 1])
            continue
        a = a - np.outer(a[:, k], a[k, :]) / pivot
    return out


def full_model_terms(roles: Roles = MINE, kind: str = "MINE_CHAR", reference: str | None = None) -> tuple[Term, ...]:
    """The final model: height, three shares, kind, log size and its products with two shares."""
    log_size = "LOG_AVG_EMP_TOTAL"
    return (
        number(roles.height),
        number(roles.underground),
        number(roles.mill),
        number(roles.office),
        category(kind, reference),
        number(log_size),
        product(log_size, roles.underground),
        product(log_size, roles.strip),
    )
