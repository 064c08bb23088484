import pytest
from pyspark.sql import functions as F

from ratewell.operators import clean as cl, features as ft
from ratewell.roles import MINE

ROLES = MINE.with_columns(labels="PRIMARY")

RAW = "MINE_ID bigint, US_STATE string, PRIMARY string, NUM_INJURIES bigint, EMP_HRS_TOTAL double, MINE_STATUS string, SEAM_HEIGHT double"


@pytest.fixture
def raw(spark):
    rows = [
        (1, "PA", "Coal", 10, 20000.0, "Active", 60.0),
        (2, None, "Gold", 0, 5000.0, "Active", 0.0),
        (3, "WV", "Coal", 1, 1000.0, "Intermittent", 50.0),
        (4, "NV", "Gold", 2, 8000.0, "Full-time permanent", 0.0),
        (5, "AZ", "Copper", 0, 2000.0, "New mine", 0.0),
    ]
    return spark.createDataFrame(rows, RAW)


def test_basic_cleaning_golden(raw):
    rows = {r["MINE_ID"]: r for r in cl.basic_cleaning(raw, ROLES).collect()}
    assert sorted(rows) == [1, 4, 5]
    assert rows[1]["INJ_RATE_PER2K"] == 1.0
    assert [rows[i]["ADJ_STATUS"] for i in (1, 4, 5)] == ["Open", "Open", "Other"]
    assert "MINE_STATUS" not in rows[1].asDict()


def test_end_to_end_keeps_the_2000_hour_row(spark):
    statuses = ["Active"] * 6 + ["Closed by MSHA", "Intermittent", "Non-producing", "Active"]
    rows = [(i, "PA", "Coal", i % 3, 2000.0 + 100 * i, s, 1.0) for i, s in enumerate(statuses)]
    assert cl.basic_cleaning(spark.createDataFrame(rows, RAW), ROLES).count() == 8


def test_cleaning_is_case_blind(raw):
    upper = cl.upper_case(raw, "MINE_STATUS")
    assert sorted(r["ADJ_STATUS"] for r in cl.basic_cleaning(upper, ROLES).collect()) == ["Open", "Open", "Other"]


def test_request_aliases_come_before_the_null_drop(spark):
    rows = [("a", "PA", "Coal", "Active", 4000.0), ("b", "PA", "Coal", None, 4000.0)]
    df = spark.createDataFrame(rows, "MINE_ID string, US_STATE string, PRIMARY string, CURRENT_STATUS string, HOURS_WORKED double")
    out = cl.basic_cleaning(df, ROLES).collect()
    assert [r["MINE_ID"] for r in out] == ["a"] and out[0]["NUM_INJURIES"] == 0 and out[0]["INJ_RATE_PER2K"] == 0.0


def test_audit_adds_up(raw):
    a = cl.cleaning_audit(raw, ROLES).first()
    assert (a["rows_in"], a["removed_null"], a["removed_status"], a["removed_exposure"], a["rows_out"]) == (5, 1, 0, 1, 3)
    assert a["removed_pct"] == 40.0 and a["null_rows_as_expected"] is False


def test_exclusion_keeps_null_status(spark):
    df = spark.createDataFrame([("Closed by MSHA",), (None,), ("x",)], "s string")
    assert cl.exclude_statuses(df, "s").count() == 2


def test_unmapped_status_may_stay_null(raw):
    out = cl.recode_status(raw, "MINE_STATUS", "g", unmapped=None)
    assert out.where("MINE_ID = 5").first()["g"] is None


def test_validation_reasons(spark):
    df = spark.createDataFrame(
        [("1", "2015", "5", "100"), ("2", None, "", "x")], "MINE_ID string, YEAR string, AVG_EMPLOYEE_CNT string, HOURS_WORKED string"
    )
    good, bad = cl.split_valid(df)
    assert good.dtypes[1:] == [("YEAR", "int"), ("AVG_EMPLOYEE_CNT", "double"), ("HOURS_WORKED", "double")]
    assert [r["MINE_ID"] for r in good.collect()] == ["1"]
    assert bad.first()["errors"] == ["missing field: YEAR", "empty field: AVG_EMPLOYEE_CNT", "not a double: HOURS_WORKED"]


def test_missing_column_rejects_every_row(spark):
    good, bad = cl.split_valid(spark.createDataFrame([("1", 2015)], "MINE_ID string, YEAR int"))
    assert good.count() == 0 and bad.count() == 1


def test_align_and_report(raw):
    out = cl.align_columns(raw, ["SEAM_HEIGHT", "NEW"], 0)
    assert out.columns == ["SEAM_HEIGHT", "NEW"] and out.agg(F.sum("NEW")).first()[0] == 0
    found = {(r["column"], r["finding"]) for r in cl.alignment_report(raw.select("MINE_ID"), ["SEAM_HEIGHT"]).collect()}
    assert found == {("SEAM_HEIGHT", "missing"), ("MINE_ID", "extra")}


def test_sample_does_not_depend_on_partitioning(mines):
    ids = lambda df: [r["MINE_ID"] for r in cl.sample_rows(df, "MINE_ID", 20, 3).collect()]
    assert ids(mines.repartition(1)) == ids(mines.repartition(7))


def test_label_dummies_golden(spark):
    primary = ["Coal", "Silver, Gold", "Gold", "Coal, Silver", "Coal, Gold"]
    df = spark.createDataFrame(list(enumerate(primary)), "i int, p string")
    vocabulary = sorted(r["label"] for r in ft.label_vocabulary(df, "p").collect())
    assert vocabulary == ["Coal", "Gold", "Silver"]
    rows = ft.label_indicators(df, "p", vocabulary).orderBy("i").collect()
    assert [r["Coal"] for r in rows] == [1, 0, 0, 1, 1]
    assert [r["Gold"] for r in rows] == [0, 1, 1, 0, 1]
    assert [r["Silver"] for r in rows] == [0, 1, 0, 1, 0]


def test_statistics_can_be_fitted_on_one_part(mines):
    part = F.col("MINE_ID") % 2 == 0
    both = ft.build_features(mines).select("MINE_ID", F.col("LARGE_OPERATION").alias("a"))
    one = ft.build_features(mines.withColumn("AVG_EMP_TOTAL", F.when(part, F.lit(1.0)).otherwise(F.col("AVG_EMP_TOTAL"))), fit_on=part)
    # The part's 75th percentile is 1, so every other row with more than one is large.
    want = mines.where(~part & (F.col("AVG_EMP_TOTAL") > 1)).count()
    assert one.agg(F.sum("LARGE_OPERATION")).first()[0] == want
    assert both.count() == mines.count()
