"""Inputs shared by the registered queries: the entity-period table and its derived forms.

``mine_year`` shapes the order tables into one row per entity and period.  The
SQL texts say the same for the checking engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import basic_cleaning
from ..roles import SHARE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

# Part types that serve as labels, in text order.
LABELS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
COMMODITIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


class Registry:
    """Collects queries and their SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} exists")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mine_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order.

    Line items are summed per order before the order, customer and nation
    columns are joined, so the wide joins see one narrow row per order, and a
    hot order is summed up map-side.
    """
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    qty = F.col("l_quantity")
    hit = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.075)
    joined = line.join(part, line["l_partkey"] == part["p_partkey"])
    per_order = joined.groupBy("l_orderkey").agg(
        *[F.max((F.col("p_type") == t).cast("int")).alias(f"is_{t}") for t in LABELS],
        F.max("p_size").cast("double").alias("SEAM_HEIGHT"),
        F.count(F.lit(1)).cast("double").alias("AVG_EMP_TOTAL"),
        (F.lit(100.0) * F.sum(qty)).alias("EMP_HRS_TOTAL"),
        F.count_if(hit).alias("NUM_INJURIES"),
        *[
            F.try_divide(F.sum(F.when(F.col("l_partkey") % 10 == i, qty).otherwise(0.0)), F.sum(qty)).alias(name)
            for i, name in enumerate(SHARE_COLUMNS)
        ],
    )
    rows = (
        per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"])
        .join(customer, F.col("o_custkey") == customer["c_custkey"])
        .join(nation, F.col("c_nationkey") == nation["n_nationkey"])
    )
    key = F.col("o_orderkey")
    closed = F.when(key % 5 == 0, "Permanently abandoned").when(key % 5 == 1, "New mine").otherwise("Full-time permanent")
    return rows.select(
        key.alias("MINE_ID"),
        F.year("o_orderdate").cast("bigint").alias("YEAR"),
        F.when(F.col("c_custkey") % 50 != 0, F.col("n_name")).alias("US_STATE"),
        F.col("c_mktsegment").alias("COMMODITY"),
        F.col("o_orderpriority").alias("TYPE_OF_MINE"),
        F.when(F.col("o_orderstatus") == "O", "Active")
        .when(F.col("o_orderstatus") == "P", "Intermittent")
        .otherwise(closed)
        .alias("MINE_STATUS"),
        F.concat_ws(", ", *[F.when(F.col(f"is_{t}") == 1, t) for t in LABELS]).alias("PRIMARY_LABELS"),
        "SEAM_HEIGHT",
        "AVG_EMP_TOTAL",
        "EMP_HRS_TOTAL",
        "NUM_INJURIES",
        *SHARE_COLUMNS,
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basic_cleaning(mine_year(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with a made-up but fixed prediction, all in counts."""
    predicted = F.col("EMP_HRS_TOTAL") / 2000.0 * 0.03 * (1 + F.col("SEAM_HEIGHT") / 50.0)
    return (
        clean(spark, sf_dir)
        .withColumns(
            {
                "actual": F.col("NUM_INJURIES").cast("double"),
                "predicted": predicted,
                "weight": F.col("EMP_HRS_TOTAL") / 2000.0,
                "dataset": F.when(F.col("MINE_ID") % 4 == 0, "test").otherwise("train"),
            }
        )
        .withColumn("score", F.col("predicted") / (1 + F.col("predicted")))
    )


_SHARES_SQL = ",\n".join(
    f"  sum(CASE WHEN l.l_partkey % 10 = {i} THEN l.l_quantity ELSE CAST(0 AS DOUBLE) END)/sum(l.l_quantity) AS {name}"
    for i, name in enumerate(SHARE_COLUMNS)
)
_LABELS_SQL = ", ".join(f"max(CASE WHEN p.p_type='{t}' THEN p.p_type END)" for t in LABELS)

MINE_YEAR_SQL = f"""
SELECT o.o_orderkey AS MINE_ID, CAST(year(o.o_orderdate) AS BIGINT) AS YEAR,
  CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE n.n_name END AS US_STATE,
  c.c_mktsegment AS COMMODITY, o.o_orderpriority AS TYPE_OF_MINE,
  CASE o.o_orderstatus WHEN 'O' THEN 'Active' WHEN 'P' THEN 'Intermittent'
    ELSE CASE WHEN o.o_orderkey % 5 = 0 THEN 'Permanently abandoned'
              WHEN o.o_orderkey % 5 = 1 THEN 'New mine' ELSE 'Full-time permanent' END END AS MINE_STATUS,
  concat_ws(', ', {_LABELS_SQL}) AS PRIMARY_LABELS,
  CAST(max(p.p_size) AS DOUBLE) AS SEAM_HEIGHT,
  CAST(count(*) AS DOUBLE) AS AVG_EMP_TOTAL,
  CAST(100 AS DOUBLE) * sum(l.l_quantity) AS EMP_HRS_TOTAL,
  CAST(sum(CASE WHEN l.l_returnflag='R' AND l.l_discount > 0.075 THEN 1 ELSE 0 END) AS BIGINT) AS NUM_INJURIES,
{_SHARES_SQL}
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN part p ON l.l_partkey=p.p_partkey
GROUP BY o.o_orderkey, o.o_orderdate, c.c_custkey, n.n_name, c.c_mktsegment, o.o_orderpriority, o.o_orderstatus
"""

CLOSED_SQL = "('CLOSED BY MSHA','NON-PRODUCING','PERMANENTLY ABANDONED','TEMPORARILY CLOSED')"
GROUP_SQL = """CASE upper(MINE_STATUS) WHEN 'ACTIVE' THEN 'Open' WHEN 'FULL-TIME PERMANENT' THEN 'Open'
  WHEN 'INTERMITTENT' THEN 'Intermittent' ELSE 'Other' END"""

CLEAN_SQL = f"""
SELECT * EXCLUDE (MINE_STATUS), CAST(NUM_INJURIES AS DOUBLE) / (EMP_HRS_TOTAL / 2000) AS INJ_RATE_PER2K,
  {GROUP_SQL} AS ADJ_STATUS
FROM mine_year
WHERE MINE_STATUS IS NOT NULL AND US_STATE IS NOT NULL AND PRIMARY_LABELS IS NOT NULL
  AND upper(MINE_STATUS) NOT IN {CLOSED_SQL} AND EMP_HRS_TOTAL >= 2000
"""

SCORED_SQL = """
SELECT *, predicted / (1 + predicted) AS score FROM (
  SELECT *, CAST(NUM_INJURIES AS DOUBLE) AS actual,
    EMP_HRS_TOTAL / 2000 * CAST(0.03 AS DOUBLE) * (1 + SEAM_HEIGHT / 50) AS predicted,
    EMP_HRS_TOTAL / 2000 AS weight,
    CASE WHEN MINE_ID % 4 = 0 THEN 'test' ELSE 'train' END AS dataset
  FROM clean)
"""


def with_mine(body: str) -> str:
    return f"WITH mine_year AS ({MINE_YEAR_SQL})\n{body}"


def with_clean(body: str, **more: str) -> str:
    extra = "".join(f",\n{name} AS ({sql})" for name, sql in more.items())
    return f"WITH mine_year AS ({MINE_YEAR_SQL}),\nclean AS ({CLEAN_SQL}){extra}\n{body}"


def with_scored(body: str, **more: str) -> str:
    return with_clean(body, scored=SCORED_SQL, **more)


def r6(column, name: str | None = None):
    """Six digits, so that sums in another order compare equal."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.round(c, 6)
    return out.alias(name or column) if name or isinstance(column, str) else out
