"""Queries for encoders (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..operators import clean as cl, encode as en, features as ft
from ..roles import MINE
from ..session import scratch_dir
from .base import COMMODITIES, LABELS, Registry, clean, mine_year, r6, with_clean
from .features import _REAL, FEATURE_SQL
from .summaries import UNIT_SQL
from .tables import feature_totals

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
GROUPS = ("Intermittent", "Open", "Other")


def _flags(column: str, levels, prefix: str, kind: str = "INTEGER") -> str:
    return ", ".join(f"CAST(coalesce({column} = '{v}', false) AS {kind}) AS \"{prefix}{v}\"" for v in levels[1:])


def register(reg: Registry) -> None:
    def one_hot(s, d):
        rows = clean(s, d)
        levels = en.fit_levels(rows, ["COMMODITY", "TYPE_OF_MINE"])
        # Levels are fitted on the cleaned rows and applied to all, with unknown states as zeros.
        return en.one_hot(mine_year(s, d).select("MINE_ID", "COMMODITY", "TYPE_OF_MINE"), levels)

    reg.add(
        "d2_one_hot_drop_first",
        one_hot,
        with_clean(
            f"SELECT MINE_ID, COMMODITY, TYPE_OF_MINE, {_flags('COMMODITY', COMMODITIES, 'COMMODITY_')}, "
            f"{_flags('TYPE_OF_MINE', PRIORITIES, 'TYPE_OF_MINE_')} FROM mine_year"
        ),
    )

    def scaled(s, d):
        rows = clean(s, d).withColumn("constant", F.lit(3.0))
        cols = ["SEAM_HEIGHT", "AVG_EMP_TOTAL", "constant"]
        return en.scale_columns(rows.select("MINE_ID", *cols), en.fit_moments(rows, cols)).select("MINE_ID", *[r6(c) for c in cols])

    reg.add(
        "d3_population_scale",
        scaled,
        with_clean(
            """SELECT MINE_ID, round((SEAM_HEIGHT - m1) / s1, 6) AS SEAM_HEIGHT, round((AVG_EMP_TOTAL - m2) / s2, 6) AS AVG_EMP_TOTAL,
            CAST(0 AS DOUBLE) AS constant FROM clean CROSS JOIN (SELECT avg(SEAM_HEIGHT) AS m1, stddev_pop(SEAM_HEIGHT) AS s1,
            avg(AVG_EMP_TOTAL) AS m2, stddev_pop(AVG_EMP_TOTAL) AS s2 FROM clean)"""
        ),
    )

    def label_one_hot(s, d):
        # Every row gets one more label, which is constant and so vanishes.
        rows = clean(s, d).select("MINE_ID", F.concat("PRIMARY_LABELS", F.lit(", EVERYWHERE")).alias("labels"))
        return ft.label_indicators(rows, "labels", en.fit_labels(rows, "labels"), "labels_").drop("labels")

    reg.add(
        "d4_label_one_hot",
        label_one_hot,
        with_clean(
            "SELECT MINE_ID, "
            + ", ".join(f"CAST(list_contains(string_split(PRIMARY_LABELS, ', '), '{v}') AS INTEGER) AS labels_{v}" for v in LABELS)
            + " FROM clean"
        ),
    )

    def assembled(s, d):
        rows = ft.build_features(clean(s, d)).drop("US_STATE", "MINE_CHAR", "MINE_ID")
        groups = en.feature_groups(rows)
        fitted = en.Preprocessor(groups["categorical"], groups["numeric"], groups["labels"]).fit(rows)
        return feature_totals(fitted, fitted.transform(rows)).select("name", "nonzero")

    def flag_count(column, levels):
        return [f"SELECT '{column}_{v}' AS name, count(*) FILTER ({column} = '{v}') AS nonzero FROM feats" for v in levels[1:]]

    numeric = ["YEAR", "SEAM_HEIGHT", "AVG_EMP_TOTAL", *MINE.shares, *_REAL, "HIGH_UNDERGROUND", "LARGE_OPERATION", "HIGH_OFFICE_HRS"]
    lines = flag_count("COMMODITY", COMMODITIES) + flag_count("TYPE_OF_MINE", PRIORITIES) + flag_count("ADJ_STATUS", GROUPS)
    # A scaled number is 0 only at the mean.
    lines += [f"SELECT '{c}', count(*) FILTER ({c} <> (SELECT avg({c}) FROM feats)) FROM feats" for c in numeric]
    lines += [
        f"SELECT 'PRIMARY_LABELS_{v}', count(*) FILTER (list_contains(string_split(PRIMARY_LABELS, ', '), '{v}')) FROM feats" for v in LABELS
    ]
    reg.add("d5_d6_assembled_features", assembled, with_clean(" UNION ALL ".join(lines), feats=FEATURE_SQL))

    def minimal_dummies(s, d):
        rows = clean(s, d).select("MINE_ID", "COMMODITY", "TYPE_OF_MINE", "ADJ_STATUS")
        train = rows.where(hash_unit("MINE_ID", 5) < 0.75)
        levels = en.fit_levels(train, ["COMMODITY", "TYPE_OF_MINE", "ADJ_STATUS"])
        names = [c for c in en.dummies(train, levels).columns]
        test = en.dummies(rows.where(hash_unit("MINE_ID", 5) >= 0.75), levels)
        return cl.align_columns(test, [*names, "COMMODITY_UNSEEN"])

    unit5 = UNIT_SQL.format(key="MINE_ID", seed=5)
    reg.add(
        "d7_dummies",
        minimal_dummies,
        with_clean(
            f"""SELECT MINE_ID, {_flags('COMMODITY', COMMODITIES, 'COMMODITY_')}, {_flags('TYPE_OF_MINE', PRIORITIES, 'TYPE_OF_MINE_')},
            {_flags('ADJ_STATUS', GROUPS, 'ADJ_STATUS_')}, CAST(0 AS INTEGER) AS "COMMODITY_UNSEEN" FROM clean WHERE {unit5} >= 0.75"""
        ),
    )

    def fit_train(s, d):
        rows = clean(s, d).select("MINE_ID", "COMMODITY", "SEAM_HEIGHT")
        train, test = rows.where(hash_unit("MINE_ID", 5) < 0.75), rows.where(hash_unit("MINE_ID", 5) >= 0.75)
        fitted = en.Preprocessor(["COMMODITY"], ["SEAM_HEIGHT"]).fit(train)
        from pyspark.ml.functions import vector_to_array

        out = fitted.transform(test).withColumn("f", vector_to_array("features"))
        return out.select("MINE_ID", *[r6(F.col("f")[i], n) for i, n in enumerate(fitted.names)])

    reg.add(
        "d8_fit_train_transform_test",
        fit_train,
        with_clean(
            f"""SELECT MINE_ID, {_flags('COMMODITY', COMMODITIES, 'COMMODITY_', 'DOUBLE')}, round((SEAM_HEIGHT - m) / s, 6) AS SEAM_HEIGHT
            FROM clean CROSS JOIN (SELECT avg(SEAM_HEIGHT) AS m, stddev_pop(SEAM_HEIGHT) AS s FROM clean WHERE {unit5} < 0.75)
            WHERE {unit5} >= 0.75"""
        ),
    )

    def new_rows(s, d):
        rows = clean(s, d).select("MINE_ID", "COMMODITY", "SEAM_HEIGHT", "AVG_EMP_TOTAL")
        path = scratch_dir(s, "preprocessor")
        en.Preprocessor(["COMMODITY"], ["SEAM_HEIGHT"]).fit(rows).save(path)
        broken = rows.withColumn("SEAM_HEIGHT", F.when(F.col("MINE_ID") % 7 != 0, F.col("SEAM_HEIGHT")))
        good, rejects = cl.split_valid(broken, {"SEAM_HEIGHT": "double"})
        fitted = en.FittedPreprocessor.load(path)
        done = fitted.transform(good).select("MINE_ID", F.lit("scored").alias("outcome"), F.lit(0).alias("reasons"))
        return done.unionByName(rejects.select("MINE_ID", F.lit("rejected").alias("outcome"), F.size("errors").alias("reasons")))

    reg.add(
        "d9_new_rows_or_rejects",
        new_rows,
        with_clean(
            """SELECT MINE_ID, CASE WHEN MINE_ID % 7 = 0 THEN 'rejected' ELSE 'scored' END AS outcome,
            CAST(CASE WHEN MINE_ID % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS reasons FROM clean"""
        ),
    )
