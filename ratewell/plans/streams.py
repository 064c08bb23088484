"""Queries for streams (L): each runs over the whole event table and must equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.summary import LATENCY_BOUNDS
from ..session import scratch_dir
from ..streaming import jobs
from .base import Registry, r6, table
from .serving import OUTCOME_SQL, requests, scorer


def events_stream(s, d):
    stream = jobs.parquet_stream(s, d, "events.parquet", table(s, d, "events").schema)
    # A watermark needs an instant, the file has a wall-clock time.
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def register(reg: Registry) -> None:
    def scored_stream(s, d):
        path = scratch_dir(s, "scored")
        model = scorer(s, d)
        jobs.score_stream(requests(events_stream(s, d)), model, path, scratch_dir(s, "stream"))
        good = s.read.parquet(f"{path}/scored").select(
            F.col("MINE_ID").alias("mine_id"), F.round("predicted_injury_rate", 5).alias("predicted_injury_rate"), F.lit(None).cast("string").alias("reasons")
        )
        bad = s.read.parquet(f"{path}/rejected").select(
            F.col("MINE_ID").alias("mine_id"), F.lit(None).cast("double").alias("predicted_injury_rate"), F.concat_ws("; ", "errors").alias("reasons")
        )
        return good.unionByName(bad).withColumn("model_version", F.lit(model.version))

    reg.add("l1_stream_scoring", scored_stream, OUTCOME_SQL)

    def updates(s, stream, keys):
        path = scratch_dir(s, "updates")
        jobs.run_to_folder(stream, path, scratch_dir(s, "stream"), "update")
        return jobs.read_updates(s, path, keys)

    reg.add(
        "l2_usage_per_window",
        lambda s, d: updates(s, jobs.usage_per_window(events_stream(s, d), "event_type", window="1 day"), ["window_start", "version"]),
        "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type AS version, count(*) AS n FROM events GROUP BY 1, 2",
    )
    les = [f"{b:g}" for b in LATENCY_BOUNDS]
    reg.add(
        "l3_latency_per_window",
        lambda s, d: updates(
            s, jobs.latency_per_window(events_stream(s, d), "event_type", F.col("value") / 10.0, window="7 days"), ["window_start", "version", "le"]
        ).withColumn("total", r6("total")),
        """WITH l AS (SELECT TIMESTAMP '1970-01-01' + to_days(CAST(floor(epoch(ts) / 604800) AS INTEGER) * 7) AS window_start, event_type AS version, value / 10 AS x FROM events),
        t AS (SELECT window_start, version, count(x) AS n, round(sum(x), 6) AS total FROM l GROUP BY 1, 2) """
        + " UNION ALL ".join(
            f"SELECT window_start, version, '{b}' AS le, count(*) FILTER (x <= {b}::DOUBLE) AS cumulative, any_value(n) AS n, any_value(total) AS total FROM l JOIN t USING (window_start, version) GROUP BY 1, 2"
            for b in les
        )
        + " UNION ALL SELECT window_start, version, '+Inf', n, n, total FROM t",
    )

    def totals(s, d):
        """Counters over the life of the stream; a version without requests stands at 0."""
        counted = updates(s, jobs.usage_total(events_stream(s, d), "event_type"), ["version"])
        known = table(s, d, "events").select(F.concat(F.lit("new "), "event_type").alias("version")).distinct()
        return jobs.with_known(counted, known)

    reg.add(
        "l2_usage_total",
        totals,
        "SELECT event_type AS version, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT DISTINCT 'new ' || event_type, 0 FROM events",
    )
    reg.add(
        "l3_latency_total",
        lambda s, d: updates(s, jobs.latency_total(events_stream(s, d), "event_type", F.col("value") / 10.0), ["version", "le"]).withColumn("total", r6("total")),
        """WITH l AS (SELECT event_type AS version, value / 10 AS x FROM events), t AS (SELECT version, count(x) AS n, round(sum(x), 6) AS total FROM l GROUP BY 1) """
        + " UNION ALL ".join(
            f"SELECT version, '{b}' AS le, count(*) FILTER (x <= {b}::DOUBLE) AS cumulative, any_value(n) AS n, any_value(total) AS total FROM l JOIN t USING (version) GROUP BY 1"
            for b in les
        )
        + " UNION ALL SELECT version, '+Inf', n, n, total FROM t",
    )

    def deduplicated(s, d):
        log = events_stream(s, d).select("ts", F.floor(F.col("event_id") / 3).cast("bigint").alias("request_id"))
        path = scratch_dir(s, "unique")
        jobs.run_to_folder(jobs.without_repeats(log, ["request_id"]), path, scratch_dir(s, "stream"))
        return s.read.parquet(path).select("request_id")

    reg.add("l4_deduplicate", deduplicated, "SELECT DISTINCT event_id // 3 AS request_id FROM events")
