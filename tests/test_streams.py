import json

from pyspark.sql import functions as F

from ratewell.models.scoring import ColumnModel, Scorer
from ratewell.streaming import jobs

SCHEMA = "MINE_ID string, YEAR int, AVG_EMPLOYEE_CNT double, HOURS_WORKED double"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_scoring_goes_on_where_it_stopped(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    scorer = Scorer(ColumnModel(F.col("EMP_HRS_TOTAL") / 2000), "4")
    put(inbox, "1.json", [{"MINE_ID": "a", "YEAR": 2015, "AVG_EMPLOYEE_CNT": 1, "HOURS_WORKED": 2000}, {"MINE_ID": "b"}])
    jobs.score_stream(jobs.json_stream(spark, str(inbox), SCHEMA), scorer, out, check)
    put(inbox, "2.json", [{"MINE_ID": "c", "YEAR": 2016, "AVG_EMPLOYEE_CNT": 1, "HOURS_WORKED": 6000}])
    for _ in range(2):  # the second run finds nothing new
        jobs.score_stream(jobs.json_stream(spark, str(inbox), SCHEMA), scorer, out, check)
    scored = {r["MINE_ID"]: r["predicted_injury_rate"] for r in spark.read.parquet(f"{out}/scored").collect()}
    assert scored == {"a": 1.0, "c": 3.0}
    assert [r["MINE_ID"] for r in spark.read.parquet(f"{out}/rejected").collect()] == ["b"]


LOG = "ts timestamp, version string, id bigint, latency double"


def log_rows(*minutes, version="1"):
    return [{"ts": f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z", "version": version, "id": m, "latency": m / 1000} for m in minutes]


def test_windows_count_and_drop_what_is_too_late(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = jobs.usage_per_window(jobs.json_stream(spark, str(inbox), LOG), "version")
        jobs.run_to_folder(stream, out, check, "update")
        return {(r["window_start"].hour, r["version"]): r["n"] for r in jobs.read_updates(spark, out, ["window_start", "version"]).collect()}

    put(inbox, "1.json", log_rows(5, 10, 50))
    assert run() == {(0, "1"): 3}
    put(inbox, "2.json", log_rows(55, 185))
    assert run() == {(0, "1"): 4, (3, "1"): 1}
    # The first hour is past the watermark now, the third is not.
    put(inbox, "3.json", log_rows(20, 190))
    assert run() == {(0, "1"): 4, (3, "1"): 2}


def test_latency_buckets_per_window(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    put(inbox, "1.json", log_rows(1, 6, 30, 59))
    stream = jobs.latency_per_window(jobs.json_stream(spark, str(inbox), LOG), "version", F.col("latency"))
    jobs.run_to_folder(stream, out, str(tmp_path / "check"), "update")
    rows = {r["le"]: r for r in jobs.read_updates(spark, out, ["window_start", "version", "le"]).collect()}
    assert len(rows) == 15 and [rows[b]["cumulative"] for b in ("0.005", "0.01", "0.025", "0.05", "0.075", "+Inf")] == [1, 2, 2, 3, 4, 4]


def test_repeats_are_dropped_across_runs(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        jobs.run_to_folder(jobs.without_repeats(jobs.json_stream(spark, str(inbox), LOG), ["id"]), out, check)
        return sorted(r["id"] for r in spark.read.parquet(out).select("id").collect())

    put(inbox, "1.json", log_rows(5, 6, 5))
    assert run() == [5, 6]
    put(inbox, "2.json", log_rows(6, 7))
    assert run() == [5, 6, 7]


def test_counters_go_on_after_a_restart_and_known_versions_start_at_zero(spark, tmp_path):
    """After each trigger, each a restart from the checkpoint, the counters equal those of all rows so far."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema, seen = "version string, ms double", []
    known = spark.createDataFrame([("1",), ("2",), ("9",)], "version string")
    for part in ([("1", 5.0), ("2", 90.0)], [("1", 7.0)] * 3, [("3", None), (None, 1.0)]):
        spark.createDataFrame(part, schema).write.mode("append").json(folder)
        seen += part
        jobs.run_to_folder(jobs.usage_total(jobs.json_stream(spark, folder, schema), "version"), out, check, "update")
        got = {r["version"]: r["n"] for r in jobs.with_known(jobs.read_updates(spark, out, ["version"]), known).collect() if r["version"] is not None}
        want = {v: sum(s[0] == v for s in seen) for v in {"1", "2", "9", *(s[0] for s in seen if s[0])}}
        assert got == want
