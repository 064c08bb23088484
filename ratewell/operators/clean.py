"""Cleaning of an exposure table: aliases, null drops, filters, recodes and audits.

What a step does to a missing column is decided from ``df.columns`` while the
plan is built, so no step starts a job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import features as fx
from ..functions.hashing import hash_text
from ..roles import MINE, Roles

# Statuses that end an entity's record, request field names, and status groups.
CLOSED_STATUSES = ("CLOSED BY MSHA", "NON-PRODUCING", "PERMANENTLY ABANDONED", "TEMPORARILY CLOSED")
REQUEST_ALIASES = {
    "CURRENT_STATUS": "MINE_STATUS",
    "INJURIES_COUNT": "NUM_INJURIES",
    "HOURS_WORKED": "EMP_HRS_TOTAL",
}
STATUS_GROUPS = {"ACTIVE": "Open", "FULL-TIME PERMANENT": "Open", "INTERMITTENT": "Intermittent"}
MIN_EXPOSURE = 2000.0


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def apply_aliases(df: DataFrame, aliases: Mapping[str, str] = REQUEST_ALIASES) -> DataFrame:
    """Copy each source column to its target name where the target is absent."""
    new = {t: F.col(s) for s, t in aliases.items() if s in df.columns and t not in df.columns}
    return df.withColumns(new) if new else df


def add_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant columns for names the table lacks."""
    new = {c: v if isinstance(v, Column) else F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def add_rate(df: DataFrame, roles: Roles = MINE) -> DataFrame:
    return df.withColumn(roles.rate, fx.rate_per_unit(roles.count, roles.exposure, roles.unit))


def upper_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(F.col(column)))


def is_listed(column: str, values: Iterable[str]) -> Column:
    """Case-blind membership; null counts as not listed."""
    return F.coalesce(F.upper(F.col(column)).isin([v.upper() for v in values]), F.lit(False))


def exclude_statuses(df: DataFrame, column: str, statuses: Iterable[str] = CLOSED_STATUSES) -> DataFrame:
    return df.where(~is_listed(column, statuses))


def min_exposure(df: DataFrame, column: str, least: float = MIN_EXPOSURE) -> DataFrame:
    return df.where(F.col(column) >= F.lit(float(least)))


def recode_status(
    df: DataFrame,
    status: str,
    out: str,
    groups: Mapping[str, str] = STATUS_GROUPS,
    unmapped: str | None = "Other",
) -> DataFrame:
    """Group statuses case-blind; the rest becomes ``unmapped`` (None keeps null)."""
    column = F
    for source, target in groups.items():
        column = column.when(F.upper(F.col(status)) == source.upper(), F.lit(target))
    return df.withColumn(out, column.otherwise(F.lit(unmapped).cast("string")))


def drop_columns(df: DataFrame, names: Iterable[str] = (), where: Callable[[str], bool] | None = None) -> DataFrame:
    """Drop columns by name and by a test of the name."""
    gone = set(names) | {c for c in df.columns if where is not None and where(c)}
    return df.drop(*gone)


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the given types; text that does not parse becomes null."""
    new = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(new) if new else df


def align_columns(df: DataFrame, names: Sequence[str], fill: object = 0) -> DataFrame:
    """Exactly the named columns in that order; absent ones are filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in names])


def alignment_report(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Which columns a trained list misses in this table, and which it does not know."""
    spark = df.sparkSession
    rows = [(c, "missing") for c in names if c not in df.columns]
    rows += [(c, "extra") for c in df.columns if c not in names]
    return spark.createDataFrame(rows, "column string, finding string")


def rows_at_extreme(df: DataFrame, column: str, which: str = "max") -> DataFrame:
    """Rows that hold the largest (or smallest) value."""
    extreme = df.agg((F.max if which == "max" else F.min)(column).alias("v")).scalar()
    return df.where(F.col(column) == extreme)


def rows_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def trim_below(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.where(F.col(column) < F.lit(float(limit)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` random rows, the same ones on every run."""
    return df.orderBy(hash_text(key, seed), F.col(key)).limit(n)


def basic_cleaning(df: DataFrame, roles: Roles = MINE, unmapped: str | None = "Other") -> DataFrame:
    """The whole cleaning step as one lazy plan.

    Aliases come before the null drop, so a request's status column counts.
    All filters are on raw columns and reach the scan.
    """
    df = apply_aliases(df)
    df = drop_nulls(df, [roles.status, roles.state, roles.labels])
    df = add_defaults(df, {roles.count: F.lit(0).cast("bigint"), roles.status: "ACTIVE"})
    df = exclude_statuses(df, roles.status)
    df = min_exposure(df, roles.exposure)
    df = add_rate(df, roles)
    return recode_status(df, roles.status, roles.status_group, unmapped=unmapped).drop(roles.status)


def cleaning_audit(df: DataFrame, roles: Roles = MINE, expected_null_rows: int | None = 27) -> DataFrame:
    """Rows in, rows each step removes, rows left: one pass, one row out."""
    present = F.lit(True)
    for c in (roles.status, roles.state, roles.labels):
        if c in df.columns:
            present = present & F.col(c).isNotNull()
    open_ = present & ~is_listed(roles.status, CLOSED_STATUSES)
    kept = open_ & F.coalesce(F.col(roles.exposure) >= MIN_EXPOSURE, F.lit(False))
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~present).alias("removed_null"),
        F.count_if(present & ~open_).alias("removed_status"),
        F.count_if(open_ & ~kept).alias("removed_exposure"),
        F.count_if(kept).alias("rows_out"),
    )
    counted = counted.withColumn(
        "removed_pct",
        F.coalesce(
            F.try_divide((F.col("rows_in") - F.col("rows_out")) * F.lit(100.0), F.col("rows_in")), F.lit(0.0)
        ),
    )
    if expected_null_rows is not None:
        counted = counted.withColumn("null_rows_as_expected", F.col("removed_null") == expected_null_rows)
    return counted


# Fields a scoring request must carry, with their types.
REQUEST_FIELDS = {"YEAR": "int", "AVG_EMPLOYEE_CNT": "double", "HOURS_WORKED": "double"}


# Types a column can have so that no value of it fails the cast.
_SURE = {"int": ("int",), "bigint": ("int", "bigint"), "double": ("int", "bigint", "float", "double")}


def _field_checks(df: DataFrame, required: Mapping[str, str]) -> list[tuple[Column, Column]]:
    """(field is fine, reason or null) per required field, as plain as the column's type allows."""
    types = dict(df.dtypes)
    checks = []
    for name, kind in required.items():
        missing = F.lit(f"missing field: {name}")
        if name not in types:
            checks.append((F.lit(False), missing))
        elif types[name] in _SURE.get(kind, (kind,)):
            checks.append((F.col(name).isNotNull(), F.when(F.col(name).isNull(), missing)))
        else:
            empty = F.trim(F.col(name).cast("string")) == ""
            reason = F.when(F.col(name).isNull(), missing).when(empty, F.lit(f"empty field: {name}"))
            fine = F.col(name).try_cast(kind).isNotNull()
            checks.append((fine, reason.when(~fine, F.lit(f"not a {kind}: {name}"))))
    return checks


def validation_errors(df: DataFrame, required: Mapping[str, str] = REQUEST_FIELDS) -> DataFrame:
    """Add ``errors``: one text per missing, empty or unreadable field of the row."""
    return df.withColumn("errors", F.array_compact(F.array(*[reason for _, reason in _field_checks(df, required)])))


def split_valid(df: DataFrame, required: Mapping[str, str] = REQUEST_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(rows that can be scored, typed; rows that cannot, with their reasons).

    Both filters are plain conditions per field, which the optimiser can push
    to the source one by one; reasons are only put together for rejects.
    """
    fine = F.lit(True)
    for ok, _ in _field_checks(df, required):
        fine = fine & ok
    types = dict(df.dtypes)
    good = safe_cast(df.where(fine), {c: t for c, t in required.items() if types.get(c) != t})
    return good, validation_errors(df.where(~fine), required)
