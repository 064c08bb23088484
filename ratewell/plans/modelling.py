"""Queries for models (J) and what is read off them (F10, H3, I17, I18, A6, E9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import features as fx, labels as lb
from ..functions.hashing import hash_unit
from ..models import booster as bo, glm, poisson_tree as pt, registry as mr, search as se, trees as tr, two_stage as ts
from ..operators import clean as cl, encode as en, features as ft, relational as rel, resample as rs, splits as sp
from ..roles import SHARE_COLUMNS
from ..session import scratch_dir
from ..workflow import feature_columns
from .base import Registry, clean, r6, scored, with_clean, with_scored
from .summaries import UNIT_SQL


def level_glm(s, d):
    rows = clean(s, d).select("MINE_ID", "COMMODITY", "NUM_INJURIES", "EMP_HRS_TOTAL")
    return rows, glm.fit_glm(rows, glm.GlmSpec((glm.category("COMMODITY"),), tol=1e-12))


# With one factor the maximum-likelihood estimates are the logs of the groups' rate ratios.
LEVEL_SQL = """SELECT CASE WHEN g.COMMODITY = 'AUTOMOBILE' THEN '(Intercept)' ELSE 'COMMODITY_' || g.COMMODITY END AS name,
  CASE WHEN g.COMMODITY = 'AUTOMOBILE' THEN ln(g.y / g.e) ELSE ln(g.y / g.e) - ln(b.y / b.e) END AS estimate,
  CASE WHEN g.COMMODITY = 'AUTOMOBILE' THEN sqrt(1 / g.y) ELSE sqrt(1 / g.y + 1 / b.y) END AS std_error
  FROM totals g CROSS JOIN (SELECT * FROM totals WHERE COMMODITY = 'AUTOMOBILE') b"""
TOTALS_SQL = "SELECT COMMODITY, CAST(sum(NUM_INJURIES) AS DOUBLE) AS y, sum(EMP_HRS_TOTAL) / 2000 AS e FROM clean GROUP BY 1"


def _glm_rows(s, d):
    rows = ft.build_features(clean(s, d))
    return rows.withColumn("LOG_AVG_EMP_TOTAL", fx.log_positive("AVG_EMP_TOTAL"))


def fitted_totals(s, d, kind):
    """Per coefficient of the full model the sum of its column times the fitted counts: at the maximum of the
    likelihood that of the counts themselves, and only there."""
    rows = _glm_rows(s, d).withColumn("MINE_CHAR", fx.joined_levels("TYPE_OF_MINE", "COMMODITY"))
    return totals_of_fit(rows, glm.fit_glm(rows, glm.GlmSpec(glm.full_model_terms(kind=kind), tol=1e-12)))


def totals_of_fit(rows, fitted):
    columns = {n: c for t in fitted.spec.terms for n, c in glm._columns(t, fitted.levels)} | {"(Intercept)": F.lit(1.0)}
    sums = fitted.predict(rows).agg(*[F.sum(c * F.col("prediction")).alias(f"s{i}") for i, c in enumerate(columns.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.round(F.col(f"s{i}"), 2).alias("total")) for i, n in enumerate(columns)])
    return sums.select(F.explode(pairs).alias("p")).select("p.*")


def formula_totals(s, d):
    """The same for a model given as text, with a category in a product and a column taken away again."""
    rows = _glm_rows(s, d)
    columns = ("NUM_INJURIES", "SEAM_HEIGHT", "AVG_EMP_TOTAL", "PCT_HRS_OFFICE", "COMMODITY", "EMP_HRS_TOTAL")
    spec = glm.formula("NUM_INJURIES ~ . - AVG_EMP_TOTAL + LOG_AVG_EMP_TOTAL * COMMODITY + offset(log(EMP_HRS_TOTAL))", columns, ["COMMODITY"], tol=1e-12)
    return totals_of_fit(rows, glm.fit_glm(rows, spec))


def formula_totals_sql():
    total = "round(CAST(sum(NUM_INJURIES * {x}) AS DOUBLE), 2) AS total FROM clean"
    plain = {"SEAM_HEIGHT": "SEAM_HEIGHT", "PCT_HRS_OFFICE": "PCT_HRS_OFFICE", "LOG_AVG_EMP_TOTAL": "ln(AVG_EMP_TOTAL)", "(Intercept)": "1"}
    parts = [f"SELECT '{n}' AS name, {total.format(x=x)}" for n, x in plain.items()]
    for prefix, x in (("COMMODITY_", "1"), ("LOG_AVG_EMP_TOTAL:COMMODITY_", "ln(AVG_EMP_TOTAL)")):
        parts.append(f"SELECT '{prefix}' || COMMODITY AS name, {total.format(x=x)} WHERE COMMODITY <> (SELECT min(COMMODITY) FROM clean) GROUP BY COMMODITY")
    return with_clean(" UNION ALL ".join(parts))


def totals_of_counts_sql(kind, level):
    size = "ln(AVG_EMP_TOTAL)"
    columns = {
        "SEAM_HEIGHT": "SEAM_HEIGHT", "PCT_HRS_UNDERGROUND": "PCT_HRS_UNDERGROUND", "PCT_HRS_MILL_PREP": "PCT_HRS_MILL_PREP",
        "PCT_HRS_OFFICE": "PCT_HRS_OFFICE", "LOG_AVG_EMP_TOTAL": size, "LOG_AVG_EMP_TOTAL:PCT_HRS_UNDERGROUND": f"{size} * PCT_HRS_UNDERGROUND",
        "LOG_AVG_EMP_TOTAL:PCT_HRS_STRIP": f"{size} * PCT_HRS_STRIP", "(Intercept)": "1",
    }
    parts = [f"SELECT '{n}' AS name, round(CAST(sum(NUM_INJURIES * {x}) AS DOUBLE), 2) AS total FROM clean" for n, x in columns.items()]
    parts.append(f"""SELECT '{kind}_' || {level} AS name, round(CAST(sum(NUM_INJURIES) AS DOUBLE), 2) AS total FROM clean
        WHERE {level} <> (SELECT min({level}) FROM clean) GROUP BY 1""")
    return with_clean(" UNION ALL ".join(parts))


FULL_SPEC = glm.GlmSpec(glm.full_model_terms(kind="COMMODITY"), tol=1e-12)


def _parts(s, d):
    rows = clean(s, d).select("MINE_ID", "YEAR", "US_STATE", "NUM_INJURIES", "INJ_RATE_PER2K", "EMP_HRS_TOTAL")
    return sp.random_split(rows, "MINE_ID", 0.75, 42)


def _encoded(s, d):
    """The parts with their assembled features as number columns, those columns, and the features' names."""
    # The fitted statistics, the encoder's fit and its rows all read the cleaned rows, so the source tables are joined once.
    rows = stored(s, sp.random_split(clean(s, d), "MINE_ID", 0.75, 42), "cleaned")
    rows = ft.build_features(rows, stats=ft.feature_stats(rows))
    groups, own = en.feature_groups(rows), ("MINE_ID", "dataset")
    kinds = [[c for c in groups[k] if c not in own] for k in ("categorical", "numeric", "labels")]
    fitted = en.Preprocessor(*kinds).fit(rows.where("dataset = 'train'"))
    columns = tuple(feature_columns(len(fitted.names)))
    # Models read the encoded rows many times.
    return stored(s, fitted.expand(rows, columns), "encoded"), columns, fitted.names


def stored(s, df, purpose):
    path = scratch_dir(s, purpose)
    df.write.parquet(path)
    return s.read.parquet(path)


SPLIT_FEATURES = ("AVG_EMP_TOTAL", "YEAR")


def first_split(objective, label):
    """Root split and leaf steps of a one-tree model."""

    def run(s, d):
        rows = clean(s, d).withColumn("any_event", lb.any_event("NUM_INJURIES"))
        spec = bo.BoosterSpec(SPLIT_FEATURES, label, objective, n_estimators=1, max_depth=1, max_bins=tr.MAX_BINS)
        nodes = bo.fit_booster(rows, spec).nodes()
        return nodes.agg(
            F.max("feature").alias("feature"),
            F.max("threshold").alias("threshold"),
            F.round(F.max("gain"), 5).alias("gain"),
            r6(F.max(F.when(F.col("node") == 1, F.col("value"))), "left_step"),
            r6(F.max(F.when(F.col("node") == 2, F.col("value"))), "right_step"),
        )

    return run


# First and second derivative of the loss at the mean m.
_SLOPES = {
    "squared": ("m - y", "1"),
    "logistic": ("m - y", "m * (1 - m)"),
    "poisson": ("m - y", "m * exp(0.7::DOUBLE)"),
    "tweedie": (
        "-y * pow(m, -0.1::DOUBLE) + pow(m, 0.9::DOUBLE)",
        "y * 0.1::DOUBLE * pow(m, -0.1::DOUBLE) + 0.9::DOUBLE * pow(m, 0.9::DOUBLE)",
    ),
}


def first_split_sql(objective, label):
    y = {"any_event": "CAST(NUM_INJURIES > 0 AS DOUBLE)"}.get(label, f"CAST({label} AS DOUBLE)")
    g, h = _SLOPES[objective]
    sides = " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST(t AS DOUBLE) AS threshold, sum(g) FILTER (x <= t) AS gl, sum(h) FILTER (x <= t) AS hl,
        sum(g) FILTER (x > t) AS gr, sum(h) FILTER (x > t) AS hr
        FROM (SELECT {f} AS x, {g} AS g, {h} AS h FROM targets CROSS JOIN (SELECT avg(y) AS m FROM targets))
        CROSS JOIN (SELECT DISTINCT {f} AS t FROM clean) GROUP BY t"""
        for f in SPLIT_FEATURES
    )
    return with_clean(
        f"""SELECT feature, threshold, round((gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1)) / 2, 5) AS gain,
        round(-gl / (hl + 1) * 0.1::DOUBLE, 6) AS left_step, round(-gr / (hr + 1) * 0.1::DOUBLE, 6) AS right_step
        FROM ({sides}) WHERE hl >= 1 AND hr >= 1 ORDER BY 3 DESC LIMIT 1""",
        targets=f"SELECT *, {y} AS y FROM clean",
    )


# --- trees grown level by level in SQL; a node's path is 1 for the root, 2n and 2n + 1 below n


def node_paths(trees, edges, features, leaf=r6):
    """Inner nodes with their splits and leaves with their values, by path."""
    rows = []
    for number, tree in enumerate(trees):
        stack = [(0, 1)]
        while stack:
            n, path = stack.pop()
            f = tree.feature[n]
            inner = f >= 0
            if inner:
                stack += [(tree.left[n], 2 * path), (tree.right[n], 2 * path + 1)]
            rows.append((number, path, features[f] if inner else None, float(edges[f][tree.cut[n]]) if inner else None, tree.gain[n] if inner else None, None if inner else tree.value[n], int(tree.stats[n][0])))
    return rows, "tree int, path bigint, feature string, threshold double, gain double, step double, n bigint"


def grown_rows(s, trees, edges, features):
    rows, schema = node_paths(trees, edges, features)
    return s.createDataFrame(rows, schema).withColumns({"gain": F.round("gain", 4), "step": F.round("step", 6)})


def grown_sql(source, tree, depth, sums, gain, allowed):
    """CTEs ``t{tree}_{level}`` of rows with their node, ``b{tree}_{level}`` of best splits; ``sums`` name columns of the source."""
    out = [(f"t{tree}_0", f"SELECT *, 1 AS node FROM {source}")]
    for k in range(depth):
        rows = f"(SELECT * FROM t{tree}_{k} WHERE node >= {2**k})"
        sides = ", ".join(f"coalesce(sum({c}) FILTER (x <= t), 0) AS l{c}, coalesce(sum({c}) FILTER (x > t), 0) AS r{c}" for c in sums)
        parts = " UNION ALL ".join(
            f"""SELECT node, '{f}' AS feature, {i} AS place, CAST(t AS DOUBLE) AS threshold, {sides} FROM (SELECT *, {f} AS x FROM {rows})
            JOIN (SELECT DISTINCT node, {f} AS t FROM {rows}) USING (node) GROUP BY node, t"""
            for i, f in enumerate(SPLIT_FEATURES)
        )
        out.append((f"b{tree}_{k}", f"""SELECT * FROM (SELECT *, {gain} AS gain FROM ({parts}) WHERE {allowed}) WHERE gain > 1e-9
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, threshold) = 1"""))
        side = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN r.{f}" for f in SPLIT_FEATURES) + " END <= b.threshold"
        out.append((f"t{tree}_{k + 1}", f"""SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node WHEN {side} THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
            FROM t{tree}_{k} r LEFT JOIN b{tree}_{k} b ON r.node = b.node"""))
    return out


def grown_nodes_sql(tree, depth, step):
    inner = " UNION ALL ".join(
        f"SELECT {tree} AS tree, CAST(node AS BIGINT) AS path, feature, threshold, round(gain, 4) AS gain, CAST(NULL AS DOUBLE) AS step, CAST(ln + rn AS BIGINT) AS n FROM b{tree}_{k}"
        for k in range(depth)
    )
    return f"""{inner} UNION ALL SELECT {tree}, CAST(node AS BIGINT), NULL, NULL, NULL, round({step}, 6), CAST(sum(n) AS BIGINT) FROM t{tree}_{depth} GROUP BY node"""


POISSON_TERM = "(CASE WHEN {y} > 0 AND {e} > 0 THEN {y} * ln({y} / {e}) ELSE 0 END - {y})"
LEVELS, TREES = 3, 3


def poisson_levels(s, d):
    spec = pt.TreeSpec(SPLIT_FEATURES, cp=0.0, max_depth=LEVELS, max_bins=tr.MAX_BINS)
    model = pt.fit_poisson_tree(clean(s, d), spec)
    return grown_rows(s, [model.tree], model.edges, SPLIT_FEATURES)


def poisson_levels_sql():
    l, r, both = (POISSON_TERM.format(y=y, e=e) for y, e in (("ly", "le"), ("ry", "re"), ("(ly + ry)", "(le + re)")))
    parts = grown_sql("targets", 0, LEVELS, ("n", "y", "e"), f"2 * ({l} + {r} - {both})", "ln >= 25 AND rn >= 25")
    targets = f"SELECT {', '.join(SPLIT_FEATURES)}, 1 AS n, CAST(NUM_INJURIES AS DOUBLE) AS y, EMP_HRS_TOTAL / 2000 AS e FROM clean"
    return with_clean(grown_nodes_sql(0, LEVELS, "sum(y) / sum(e)"), targets=targets, **dict(parts))


def boosted_levels(objective, label):
    """Several trees, each on the scores that those before it leave."""

    def run(s, d):
        rows = clean(s, d).withColumn("any_event", lb.any_event("NUM_INJURIES"))
        spec = bo.BoosterSpec(SPLIT_FEATURES, label, objective, n_estimators=TREES, max_depth=LEVELS, max_bins=tr.MAX_BINS, learning_rate=0.3)
        model = bo.fit_booster(rows, spec)
        return grown_rows(s, model.trees, model.edges, SPLIT_FEATURES)

    return run


# Link of the mean and its inverse.
_LINKS = {"squared": ("avg(y)", "f"), "logistic": ("ln(avg(y) / (1 - avg(y)))", "1 / (1 + exp(-f))"), "poisson": ("ln(avg(y))", "exp(f)"), "tweedie": ("ln(avg(y))", "exp(f)")}


def boosted_levels_sql(objective, label):
    y = {"any_event": "CAST(NUM_INJURIES > 0 AS DOUBLE)"}.get(label, f"CAST({label} AS DOUBLE)")
    (g, h), (link, mean) = _SLOPES[objective], _LINKS[objective]
    columns = ", ".join(SPLIT_FEATURES)
    step = "-sum(g) / (sum(h) + 1)"
    if objective == "poisson":
        step = f"greatest(-0.7::DOUBLE, least(0.7::DOUBLE, {step}))"
    step += " * 0.3::DOUBLE"
    gain = "(lg * lg / (lh + 1) + rg * rg / (rh + 1) - (lg + rg) * (lg + rg) / (lh + rh + 1)) / 2"
    parts = {"targets": f"SELECT {columns}, {y} AS y FROM clean", "f0": f"SELECT *, (SELECT {link} FROM targets) AS f FROM targets"}
    for t in range(TREES):
        parts[f"s{t}"] = f"SELECT {columns}, y, f, 1 AS n, {g} AS g, {h} AS h FROM (SELECT *, {mean} AS m FROM f{t})"
        parts |= dict(grown_sql(f"s{t}", t, LEVELS, ("n", "g", "h"), gain, "lh >= 1 AND rh >= 1"))
        parts[f"f{t + 1}"] = f"SELECT {columns}, y, f + step AS f FROM t{t}_{LEVELS} JOIN (SELECT node, {step} AS step FROM t{t}_{LEVELS} GROUP BY node) USING (node)"
    return with_clean(" UNION ALL ".join(grown_nodes_sql(t, LEVELS, step) for t in range(TREES)), **parts)


# --- oversampling by brute force: neighbours of all rare vectors, hardness, and the copies that follow from it
CLASS_SQL = "CAST(least(floor(NUM_INJURIES), 3) AS INTEGER)"
QUOTAS_SQL = with_clean(
    """SELECT cls, FALSE AS synthetic, CAST(sum(m) AS BIGINT) AS n FROM vectors GROUP BY cls
    UNION ALL SELECT cls, TRUE, CAST(sum(round_even(ratio / t * gap, 0) * m) AS BIGINT) AS n FROM hard JOIN totals USING (cls) JOIN sizes USING (cls)
    GROUP BY cls HAVING sum(round_even(ratio / t * gap, 0) * m) > 0""",
    vectors=f"""SELECT EMP_HRS_TOTAL / 10000 AS x1, SEAM_HEIGHT / 20 AS x2, PCT_HRS_UNDERGROUND AS x3, {CLASS_SQL} AS cls, count(*) AS m,
        min(CAST(MINE_ID AS BIGINT)) AS id FROM clean WHERE NUM_INJURIES > 0 GROUP BY ALL""",
    sizes="SELECT cls, sum(m) AS size, max(sum(m)) OVER () - sum(m) AS gap FROM vectors GROUP BY cls",
    settings="SELECT least(5, CASE WHEN min(size) > 1 THEN min(size) - 1 ELSE 1 END) AS k FROM sizes",
    near="""SELECT a.id, a.cls, a.m, b.cls AS n_cls, b.m - CASE WHEN a.id = b.id THEN 1 ELSE 0 END AS own,
        row_number() OVER (PARTITION BY a.id ORDER BY (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3), b.id) AS place
        FROM vectors a JOIN sizes s ON s.cls = a.cls AND s.gap > 0 CROSS JOIN vectors b QUALIFY place <= (SELECT k + 1 FROM settings)""",
    takes="""SELECT *, greatest(least(own, (SELECT k FROM settings) - coalesce(sum(own) OVER (PARTITION BY id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 0) AS take FROM near""",
    hard="SELECT id, cls, m, CAST(sum(CASE WHEN n_cls <> cls THEN take ELSE 0 END) AS DOUBLE) / (SELECT k FROM settings) AS ratio FROM takes GROUP BY id, cls, m",
    totals="SELECT cls, sum(m * ratio) AS t FROM hard GROUP BY cls",
)


def register(reg: Registry) -> None:
    # --- linear models
    reg.add(
        "j1_glm_by_level",
        lambda s, d: level_glm(s, d)[1].coefficients().select("name", F.round("estimate", 5).alias("estimate")),
        with_clean(f"SELECT name, round(estimate, 5) AS estimate FROM ({LEVEL_SQL})", totals=TOTALS_SQL),
    )

    def score_equations(s, d):
        """Per design column the mean of x·(y − μ): zero at the maximum of the likelihood."""
        rows = _glm_rows(s, d)
        fitted = glm.fit_glm(rows, FULL_SPEC)
        gap = F.col("NUM_INJURIES") - F.col("prediction")
        scored_rows = fitted.predict(rows)
        columns = {n: c for t in FULL_SPEC.terms for n, c in glm._columns(t, fitted.levels)}
        columns["(Intercept)"] = F.lit(1.0)
        sums = scored_rows.agg(*[F.avg(c * gap).alias(n) for n, c in columns.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.abs(F.round(F.col(f"`{n}`"), 5)).alias("score")) for n in columns])
        return sums.select(F.explode(pairs).alias("p")).select("p.*")

    names = [
        "SEAM_HEIGHT", "PCT_HRS_UNDERGROUND", "PCT_HRS_MILL_PREP", "PCT_HRS_OFFICE", "COMMODITY_BUILDING", "COMMODITY_FURNITURE",
        "COMMODITY_HOUSEHOLD", "COMMODITY_MACHINERY", "LOG_AVG_EMP_TOTAL", "LOG_AVG_EMP_TOTAL:PCT_HRS_UNDERGROUND",
        "LOG_AVG_EMP_TOTAL:PCT_HRS_STRIP", "(Intercept)",
    ]
    reg.add(
        "j1_glm_score_equations",
        score_equations,
        "SELECT unnest([" + ", ".join(f"'{n}'" for n in names) + "]) AS name, CAST(0 AS DOUBLE) AS score",
    )
    def level_response(s, d):
        rows, fitted = level_glm(s, d)
        return fitted.predict(rows).select("MINE_ID", F.round("prediction", 5).alias("prediction"))

    reg.add(
        "j2_glm_response",
        level_response,
        with_clean("SELECT MINE_ID, round(EMP_HRS_TOTAL / 2000 * y / e, 5) AS prediction FROM clean JOIN totals USING (COMMODITY)", totals=TOTALS_SQL),
    )
    reg.add(
        "j3_glm_summary",
        lambda s, d: level_glm(s, d)[1]
        .coefficients()
        .select("name", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"), F.round("z", 3).alias("z")),
        with_clean(
            f"SELECT name, round(estimate, 5) AS estimate, round(std_error, 5) AS std_error, round(estimate / std_error, 3) AS z FROM ({LEVEL_SQL})",
            totals=TOTALS_SQL,
        ),
    )
    reg.add(
        "i17_coefficient_effect",
        lambda s, d: level_glm(s, d)[1].coefficients().select("name", F.round("effect_pct", 4).alias("effect_pct")),
        with_clean(f"SELECT name, round(100 * (exp(estimate) - 1), 4) AS effect_pct FROM ({LEVEL_SQL})", totals=TOTALS_SQL),
    )

    def aic(s, d):
        rows, fitted = level_glm(s, d)
        return rows.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(round(fitted.aic, 3)).alias("aic"))

    reg.add(
        "i18_aic",
        aic,
        with_clean(
            """SELECT count(*) AS n, round(-2 * sum(NUM_INJURIES * ln(w * y / e) - w * y / e - lgamma(NUM_INJURIES + 1)) + 2 * 5, 3) AS aic
            FROM (SELECT *, EMP_HRS_TOTAL / 2000 AS w FROM clean) JOIN totals USING (COMMODITY)""",
            totals=TOTALS_SQL,
        ),
    )

    def stepwise(s, d):
        rows = _glm_rows(s, d).withColumn("MINE_CHAR", fx.joined_levels("TYPE_OF_MINE", "COMMODITY"))
        return glm.step_table(glm.step_aic(rows, glm.GlmSpec(glm.full_model_terms()))[1])

    reg.add("j4_step_aic", stepwise)

    def candidate_aics(s, d):
        """Models of one design measured in common passes; those of one factor, and of two with their product, have closed forms."""
        rows = clean(s, d)
        both = glm.formula("NUM_INJURIES ~ TYPE_OF_MINE * COMMODITY + offset(log(EMP_HRS_TOTAL))", categories=["TYPE_OF_MINE", "COMMODITY"])
        models = {"both": both, "COMMODITY": both.without("TYPE_OF_MINE").without("TYPE_OF_MINE:COMMODITY"), "TYPE_OF_MINE": both.without("COMMODITY").without("TYPE_OF_MINE:COMMODITY")}
        with glm.CommonPasses(rows, both, glm.model_levels(rows, both.terms)) as passes:
            aics = passes(list(models.values()))
        values = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(round(a, 3)).alias("aic")) for n, a in zip(models, aics)])
        return rows.agg(F.count(F.lit(1)).alias("n")).select("n", F.explode(values).alias("m")).select("n", "m.*")

    own_aic = """SELECT count(*) AS n, '{name}' AS model, round(-2 * sum(NUM_INJURIES * ln(w * y / e) - w * y / e - lgamma(NUM_INJURIES + 1)) + 2 * {k}, 3) AS aic
        FROM (SELECT *, EMP_HRS_TOTAL / 2000 AS w FROM clean) JOIN (SELECT {keys}, sum(NUM_INJURIES) AS y, sum(EMP_HRS_TOTAL) / 2000 AS e FROM clean GROUP BY ALL) USING ({keys})"""
    levels_of = "(SELECT count(DISTINCT {0}) FROM clean)".format
    reg.add(
        "j4_candidate_aics",
        candidate_aics,
        with_clean(
            " UNION ALL ".join(
                own_aic.format(name=n, keys=", ".join(keys), k=" * ".join(map(levels_of, keys)))
                for n, keys in (("both", ("TYPE_OF_MINE", "COMMODITY")), ("COMMODITY", ("COMMODITY",)), ("TYPE_OF_MINE", ("TYPE_OF_MINE",)))
            )
        ),
    )
    reg.add(
        "j5_dependent_columns",
        lambda s, d: s.createDataFrame([(c,) for c in glm.dependent_columns(clean(s, d), SHARE_COLUMNS)], "dependent string"),
        with_clean(f"SELECT 'PCT_HRS_OFFICE' AS dependent FROM clean HAVING max(abs({' + '.join(SHARE_COLUMNS)} - 1)) < 1e-9"),
    )
    reg.add(
        "j5_rank_repair",
        lambda s, d: cl.drop_columns(
            clean(s, d).select("MINE_ID", fx.joined_levels("TYPE_OF_MINE", "COMMODITY").alias("MINE_CHAR"), "PCT_HRS_STRIP", r6("PCT_HRS_OFFICE")),
            ["PCT_HRS_STRIP"],
        ),
        with_clean("SELECT MINE_ID, concat_ws(' ', TYPE_OF_MINE, COMMODITY) AS MINE_CHAR, round(PCT_HRS_OFFICE, 6) AS PCT_HRS_OFFICE FROM clean"),
    )
    reg.add("j6_final_refit", lambda s, d: fitted_totals(s, d, "MINE_CHAR"), totals_of_counts_sql("MINE_CHAR", "concat_ws(' ', TYPE_OF_MINE, COMMODITY)"))

    # --- Poisson trees
    split_features = ("AVG_EMP_TOTAL", "YEAR")
    def single_split(s, d):
        spec = pt.TreeSpec(split_features, cp=0.0, max_depth=1, max_bins=tr.MAX_BINS)
        root = pt.fit_poisson_tree(clean(s, d), spec).nodes().where("node = 0")
        return root.select("feature", "threshold", F.round("gain", 4).alias("gain"))

    sides = " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST(t AS DOUBLE) AS threshold, sum(NUM_INJURIES) FILTER (x <= t) AS ly, sum(w) FILTER (x <= t) AS le,
        sum(NUM_INJURIES) FILTER (x > t) AS ry, sum(w) FILTER (x > t) AS re, count(*) FILTER (x <= t) AS ln, count(*) FILTER (x > t) AS rn
        FROM (SELECT {f} AS x, NUM_INJURIES, EMP_HRS_TOTAL / 2000 AS w FROM clean) CROSS JOIN (SELECT DISTINCT {f} AS t FROM clean) GROUP BY t"""
        for f in split_features
    )
    reg.add(
        "j7_poisson_split",
        single_split,
        with_clean(
            f"""SELECT feature, threshold, round(2 * (ly * ln(ly / le) + ry * ln(ry / re) - (ly + ry) * ln((ly + ry) / (le + re))), 4) AS gain
            FROM ({sides}) WHERE ln >= 25 AND rn >= 25 ORDER BY 3 DESC LIMIT 1"""
        ),
    )
    def poisson_tree(s, d):
        rows, columns, names = _encoded(s, d)
        return rows, pt.fit_poisson_tree(rows, pt.TreeSpec(columns, cp=0.0005)), dict(zip(columns, names))

    def poisson_nodes(s, d):
        _, model, names = poisson_tree(s, d)
        named = s.createDataFrame(list(names.items()), "feature string, name string")
        return model.nodes().join(named, "feature", "left").select("node", "depth", F.col("name").alias("feature"), r6("threshold"), r6("value"), r6("gain"), "rows")

    reg.add("j7_poisson_tree", poisson_nodes)
    reg.add("j7_poisson_levels", poisson_levels, poisson_levels_sql())

    def complexity(s, d):
        rows, columns, _ = _encoded(s, d)
        return pt.fit_with_complexity(rows, pt.TreeSpec(columns, cp=0.0005), "MINE_ID", folds=10)[1].table()

    reg.add("j8_complexity_table", complexity)

    def pruned(s, d):
        """The tree of the least cross-validated error, and that of the second row: in each, the leaves' events add up."""
        rows, columns, _ = _encoded(s, d)
        model, table = pt.fit_with_complexity(rows, pt.TreeSpec(columns, cp=0.0005), "MINE_ID", folds=10)
        chosen = {"least_xerror": model.pruned(table.best_cp()), "second_row": model.pruned(table.cp_at(2)), "root": model.pruned(1.0)}
        scores = rows.select("dataset", F.lit(0).alias("_"), *[(m.rate() * F.col("EMP_HRS_TOTAL") / 2000).alias(n) for n, m in chosen.items()])
        return scores.agg(*[F.round(F.sum(n), 4).alias(n) for n in chosen], F.count(F.lit(1)).alias("n"))

    total = "round(CAST(sum(NUM_INJURIES) AS DOUBLE), 4)"
    reg.add("j8_pruned_trees", pruned, with_clean(f"SELECT {total} AS least_xerror, {total} AS second_row, {total} AS root, count(*) AS n FROM clean"))

    def fixed_tree(s, d):
        import numpy as np

        tree = tr.Tree()
        tree.split(0, 0, 0, 1.0, (), ())
        tree.split(2, 1, 0, 1.0, (), ())
        tree.value = [0.0, 0.05, 0.0, 0.07, 0.11]
        model = pt.PoissonTree(pt.TreeSpec(("SEAM_HEIGHT", "AVG_EMP_TOTAL")), tree, [np.array([30.0]), np.array([4.0])])
        return model.predict(clean(s, d)).select("MINE_ID", r6("prediction"))

    reg.add(
        "j9_tree_response",
        fixed_tree,
        with_clean(
            """SELECT MINE_ID, round(CASE WHEN SEAM_HEIGHT <= 30 THEN 0.05::DOUBLE WHEN AVG_EMP_TOTAL <= 4 THEN 0.07::DOUBLE ELSE 0.11::DOUBLE END
            * EMP_HRS_TOTAL / 2000, 6) AS prediction FROM clean"""
        ),
    )
    reg.add(
        "j10_tree_rules",
        lambda s, d: s.createDataFrame(list(enumerate(poisson_tree(s, d)[1].rules())), "line int, rule string"),
    )

    # --- library trees and boosters
    def weighted(s, d):
        rows, columns, names = _encoded(s, d)
        rows = rows.withColumn("w", F.col("EMP_HRS_TOTAL") / 2000)
        return rows, se.weighted_tree(columns, "NUM_INJURIES", "w").fit(rows.where("dataset = 'train'")), dict(zip(columns, names))

    reg.add("j11_weighted_tree", lambda s, d: (lambda r: r[1].predict(r[0]).groupBy("dataset", r6("prediction")).agg(F.count(F.lit(1)).alias("n")))(weighted(s, d)))

    def weighted_totals(s, d):
        """In the training part a leaf is the weighted mean of its rows, so the weighted totals agree."""
        rows, model, _ = weighted(s, d)
        gap = F.sum(F.col("w") * F.col("prediction"))
        return model.predict(rows).where("dataset = 'train'").agg(F.count(F.lit(1)).alias("n"), F.round(gap, 3).alias("weighted_total"))

    reg.add(
        "j11_weighted_totals",
        weighted_totals,
        with_clean(f"SELECT count(*) AS n, round(sum(EMP_HRS_TOTAL / 2000 * NUM_INJURIES), 3) AS weighted_total FROM clean WHERE {UNIT_SQL.format(key='MINE_ID', seed=42)} < 0.75"),
    )

    def top_importance(s, d):
        _, model, names = weighted(s, d)
        named = s.createDataFrame(list(names.items()), "feature string, name string")
        top = model.importance().join(named, "feature").select(F.col("name").alias("feature"), "importance")
        return top.orderBy(F.desc("importance"), "feature").limit(10)

    reg.add("h3_top_importance", top_importance)

    def boosted(objective, label, **params):
        def run(s, d):
            rows, columns, _ = _encoded(s, d)
            rows = rows.withColumn("any_event", lb.any_event("NUM_INJURIES"))
            if objective == "tweedie":
                rows = rows.where(F.col(label) > 0)
            train = rows.where("dataset = 'train'")
            spec = bo.BoosterSpec(columns, label, objective, **params)
            return bo.fit_booster(train, spec).staged_loss(train).select("trees", r6("loss"))

        return run

    reg.add("j12_poisson_booster", boosted("poisson", "NUM_INJURIES"))
    reg.add("j13_logistic_booster", boosted("logistic", "any_event", scale_pos_weight=3.0))
    reg.add("j14_tweedie_booster", boosted("tweedie", "INJ_RATE_PER2K", variance_power=1.1))
    reg.add("j15_squared_booster", boosted("squared", "INJ_RATE_PER2K"))

    for name, objective, label in (
        ("j12_poisson_first_split", "poisson", "NUM_INJURIES"),
        ("j13_logistic_first_split", "logistic", "any_event"),
        ("j14_tweedie_first_split", "tweedie", "INJ_RATE_PER2K"),
        ("j15_squared_first_split", "squared", "INJ_RATE_PER2K"),
    ):
        reg.add(name, first_split(objective, label), first_split_sql(objective, label))
        reg.add(name.replace("first_split", "levels"), boosted_levels(objective, label), boosted_levels_sql(objective, label))

    def swept(s, d):
        rows, columns, _ = _encoded(s, d)
        store = mr.ModelRegistry(s, scratch_dir(s, "sweep"))
        table = se.sweep(rows, columns, "INJ_RATE_PER2K", store)
        return table.select(
            "place", "model", "version", *[r6(c) for c in ("train_rmse", "test_rmse", "train_mae", "test_mae", "test_ll")], "best",
            F.col("version").eqNullSafe(store.pointer.read().agg(F.max("version")).scalar()).alias("active"),
        )

    reg.add("j15_j16_sweep", swept)

    SEARCH_POINTS = 10

    def searched(loss, space, start, positive):
        def run(s, d):
            parts, columns, _ = _encoded(s, d)
            rows = ts.three_parts(parts, "MINE_ID").select("MINE_ID", "dataset", "NUM_INJURIES", "INJ_RATE_PER2K", *columns)
            rows = (rows.where("NUM_INJURIES > 0") if positive else rows).persist()
            spec = bo.BoosterSpec(columns, "INJ_RATE_PER2K", key="MINE_ID")
            value = loss(rows.where("dataset = 'train'"), rows.where("dataset = 'val'"), "INJ_RATE_PER2K", spec)
            try:
                return se.search(value, se.candidates(space, SEARCH_POINTS, start=start)).table()
            finally:
                rows.unpersist()

        return run

    reg.add("j17_random_search", searched(se.regressor_loss, se.REGRESSOR_SPACE, se.REGRESSOR_START, True))
    reg.add("j17_classifier_search", searched(se.classifier_loss, se.CLASSIFIER_SPACE, se.CLASSIFIER_START, False))

    def gate():
        return (F.col("score") >= 0.4).cast("int")

    reg.add(
        "j18_hard_gate",
        lambda s, d: scored(s, d).select("MINE_ID", r6(lb.hard_gate(gate(), "predicted"), "prediction")),
        with_scored("SELECT MINE_ID, round(CASE WHEN score >= 0.4::DOUBLE THEN predicted ELSE 0 END, 6) AS prediction FROM scored"),
    )
    reg.add(
        "j19_soft_product",
        lambda s, d: scored(s, d).select("MINE_ID", r6(lb.soft_product("score", "predicted"), "prediction")),
        with_scored("SELECT MINE_ID, round(score * predicted, 6) AS prediction FROM scored"),
    )

    def two_stage(s, d):
        parts, columns, names = _encoded(s, d)
        rows = ts.three_parts(parts, "MINE_ID")
        model = ts.fit_two_stage(rows.where("dataset = 'train'"), "INJ_RATE_PER2K", bo.BoosterSpec(columns, ""), "MINE_ID")
        return rows, model, dict(zip(columns, names))

    def frame(s, d):
        rows, model, _ = two_stage(s, d)
        out = ts.scored_frame(model, rows, "INJ_RATE_PER2K")
        return out.groupBy("dataset").agg(
            F.count(F.lit(1)).alias("n"), r6(F.avg("predicted"), "predicted"), r6(F.avg("injury_probability"), "injury_probability"), r6(F.avg("residual"), "residual")
        )

    def stage_importance(s, d):
        _, model, names = two_stage(s, d)
        named = s.createDataFrame(list(names.items()), "feature string, name string")
        table = model.importance().join(named, "feature").select("stage", F.col("name").alias("feature"), r6("importance"), "splits")
        return table.orderBy(F.desc("importance"), "feature")

    reg.add("j20_scored_frame", frame)
    reg.add("j21_stage_importance", stage_importance)
    reg.add("j22_evaluate_parts", lambda s, d: (lambda r: ts.evaluate_two_stage(r[1], r[0], "INJ_RATE_PER2K"))(two_stage(s, d)).select("metric", r6("value")))
    u42, u53 = UNIT_SQL.format(key="MINE_ID", seed=42), UNIT_SQL.format(key="MINE_ID", seed=53)
    reg.add(
        "j22_three_parts",
        lambda s, d: ts.three_parts(_parts(s, d), "MINE_ID").groupBy("dataset").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("NUM_INJURIES") > 0).alias("positives")
        ),
        with_clean(
            f"""SELECT CASE WHEN {u42} >= 0.75 THEN 'test' WHEN {u53} < 0.2 THEN 'val' ELSE 'train' END AS dataset, count(*) AS n,
            count(*) FILTER (NUM_INJURIES > 0) AS positives FROM clean GROUP BY 1"""
        ),
    )

    def attached(s, d):
        rows = clean(s, d)
        fitted = en.Preprocessor(["COMMODITY"], ["SEAM_HEIGHT", "AVG_EMP_TOTAL"], ["PRIMARY_LABELS"], scale=False).fit(rows)
        from .tables import feature_totals

        return feature_totals(fitted, fitted.transform(rows)).select("name", "nonzero")

    flags = [f"SELECT 'COMMODITY_{c}' AS name, count(*) FILTER (COMMODITY = '{c}') AS nonzero FROM clean" for c in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]
    flags += [f"SELECT '{c}', count(*) FILTER ({c} <> 0) FROM clean" for c in ("SEAM_HEIGHT", "AVG_EMP_TOTAL")]
    flags += [
        f"SELECT 'PRIMARY_LABELS_{v}', count(*) FILTER (list_contains(string_split(PRIMARY_LABELS, ', '), '{v}')) FROM clean"
        for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    ]
    reg.add("f10_attach_names", attached, with_clean(" UNION ALL ".join(flags)))

    def round_trip(s, d):
        rows, columns, _ = _encoded(s, d)
        model = bo.fit_booster(rows.where("dataset = 'train'"), bo.BoosterSpec(columns, "NUM_INJURIES"))
        path = scratch_dir(s, "model")
        model.save(path)
        both = bo.Booster.load(path).predict(model.predict(rows, "a"), "b")
        return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") != F.col("b")).alias("different"))

    reg.add("a6_model_round_trip", round_trip, with_clean("SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM clean"))

    def oversampled(s, d):
        rows = clean(s, d).where("NUM_INJURIES > 0").withColumn("cls", lb.capped_class("NUM_INJURIES"))
        rows = rows.withColumns({"x1": F.col("EMP_HRS_TOTAL") / 10000, "x2": F.col("SEAM_HEIGHT") / 20, "x3": F.col("PCT_HRS_UNDERGROUND")})
        # Sizes, vectors, targets and originals are all read from the rows.
        rows = stored(s, rows.select("MINE_ID", "NUM_INJURIES", "cls", "x1", "x2", "x3"), "rare")
        out = rs.adasyn(rows, "MINE_ID", ["x1", "x2", "x3"], "cls", "NUM_INJURIES")
        return out.groupBy("cls", "synthetic").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("x1"), "x1"))

    reg.add("e9_adaptive_oversampling", oversampled)
    reg.add("e9_class_quotas", lambda s, d: oversampled(s, d).select("cls", "synthetic", "n"), QUOTAS_SQL)

    def oversampled_features(s, d):
        """All assembled features; a synthetic row lies between two rows of its class, so inside the class's range."""
        rows, columns, _ = _encoded(s, d)
        rows = rows.where("NUM_INJURIES > 0").withColumn("cls", lb.capped_class("NUM_INJURIES"))
        out = rs.adasyn(rows, "MINE_ID", list(columns), "cls", "NUM_INJURIES")
        ranges = out.where("NOT synthetic").groupBy("cls").agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
        # Four rows: one per class.  Each synthetic row is made, compared and counted in the same pass.
        slack = 1e-9
        outside = reduce(lambda a, b: a | b, [(F.col(c) < F.col(f"lo_{c}") - slack) | (F.col(c) > F.col(f"hi_{c}") + slack) for c in columns])
        counts = F.count_if(~F.col("synthetic")).alias("originals"), F.count_if(F.col("synthetic") & outside).alias("outside")
        return out.join(F.broadcast(ranges), "cls").groupBy("cls").agg(*counts)

    reg.add(
        "e9_assembled_oversampling",
        oversampled_features,
        with_clean(f"SELECT {CLASS_SQL} AS cls, count(*) AS originals, CAST(0 AS BIGINT) AS outside FROM clean WHERE NUM_INJURIES > 0 GROUP BY 1"),
    )
    reg.add("d10_formula_text", formula_totals, formula_totals_sql())
    reg.add("d10_formula_terms", lambda s, d: fitted_totals(s, d, "COMMODITY"), totals_of_counts_sql("COMMODITY", "COMMODITY"))
