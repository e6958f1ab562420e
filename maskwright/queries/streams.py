"""Streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.operators.policy import RedactOptions
from maskwright.operators.redact import spans_of
from maskwright.queries.base import (
    KEY,
    ORACLES,
    REDACTED,
    Tables,
    query,
    sql_candidates,
    sql_rebuilt,
    sql_resolved,
    sql_shifted,
    with_ctes,
)
from maskwright.streaming.streams import (
    events_per_window,
    first_values,
    job_status,
    redact_stream,
    run_available,
    scratch,
    table_stream,
    track_jobs,
)


@query(
    "z1_redact_stream",
    with_ctes(
        sql_candidates("documents", "doc_id", "text"), sql_resolved(), sql_shifted(REDACTED),
        sql_rebuilt("documents", "doc_id", "text"),
        select="SELECT k AS doc_id, redacted_text, entities_found FROM rebuilt",
    ),
)
def z1_redact_stream(t: Tables) -> DataFrame:
    """Documents redacted as they arrive, with the batch result."""
    stream = table_stream(t.spark, t.folder, "documents").select("doc_id", "text")
    done = redact_stream(stream, "text").select("doc_id", "redacted_text", "entities_found")
    return run_available(done, "redact")


@query(
    "z2_events_per_window",
    """WITH w AS (
         SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events
         FROM events GROUP BY ALL)
       SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, events FROM w
       WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def z2_events_per_window(t: Tables) -> DataFrame:
    """Events per tumbling window, closed windows only."""
    counted = events_per_window(table_stream(t.spark, t.folder, "events"), "ts", "event_type")
    return run_available(counted, "windows").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "event_type", "events",
    )


def _job_events(events: DataFrame) -> DataFrame:
    """Users as jobs: a purchase completes a job, an error fails it."""
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("job_id"),
        F.when(kind == "purchase", "Completed").when(kind == "error", "Failed")
        .otherwise("Running").alias("status"),
        F.col("ts").alias("at"),
    )


@query(
    "z3_job_tracker",
    """WITH j AS (
         SELECT user_id AS job_id, ts, CASE event_type WHEN 'purchase' THEN 'Completed'
           WHEN 'error' THEN 'Failed' ELSE 'Running' END AS status FROM events),
       f AS (SELECT job_id, min(ts) AS first_at,
           min(ts) FILTER (status <> 'Running') AS done_at,
           arg_min(status, ts) FILTER (status <> 'Running') AS done_status FROM j GROUP BY job_id)
       SELECT job_id, CASE WHEN done_at <= first_at + INTERVAL 900 SECOND THEN done_status
         ELSE 'timed_out' END AS status
       FROM f WHERE done_at IS NOT NULL
         OR first_at + INTERVAL 900 SECOND < (SELECT max(ts) FROM j) - INTERVAL 10 MINUTE""",
)
def z3_job_tracker(t: Tables) -> DataFrame:
    """Z3: outcome per job from a stateful stream with an event-time timeout."""
    events = _job_events(table_stream(t.spark, t.folder, "events"))
    return run_available(track_jobs(events), "jobs").select("job_id", "status")


@query("z3_job_tracker_batches", ORACLES["z3_job_tracker"])
def z3_job_tracker_batches(t: Tables) -> DataFrame:
    """Z3: the same outcomes when the events arrive in eight batches, each job reported once."""
    base = scratch(t.spark, "events")
    span = t.events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    eighth = F.floor(
        (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("a").cast("timestamp")))
        / (F.unix_micros(F.col("b").cast("timestamp")) - F.unix_micros(F.col("a").cast("timestamp"))
           + 1) * 8
    )
    parts = t.events.crossJoin(F.broadcast(span)).withColumn("part", eighth).drop("a", "b")
    # Some files each, in the order of time; a batch reads the files of one eighth.
    files = 4
    for i in range(8):
        parts.filter(F.col("part") == i).drop("part").repartition(files).write.mode("append").parquet(base)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", files).parquet(base)
    return run_available(track_jobs(_job_events(stream)), "jobs").select("job_id", "status")


@query(
    "z3_job_status",
    """WITH j AS (
         SELECT user_id AS job_id, ts, event_id, CASE event_type WHEN 'purchase' THEN 'Completed'
           WHEN 'error' THEN 'Failed' ELSE 'Running' END AS status FROM events),
       f AS (SELECT job_id, min(ts) AS first_at,
           min(ts) FILTER (status <> 'Running') AS done_at,
           arg_min(status, ts) FILTER (status <> 'Running') AS done_status,
           arg_max(status, ts) AS last_status FROM j GROUP BY job_id)
       SELECT job_id, CASE WHEN done_at <= first_at + INTERVAL 900 SECOND THEN done_status
         WHEN done_at IS NOT NULL OR first_at + INTERVAL 900 SECOND < TIMESTAMP '2024-02-01'
         THEN 'timed_out' ELSE last_status END AS status FROM f""",
)
def z3_job_status(t: Tables) -> DataFrame:
    """The batch twin of the tracker."""
    return job_status(_job_events(t.events), F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "z4_first_values",
    with_ctes(
        sql_candidates("documents", "doc_id", "text"), sql_resolved(),
        select="SELECT DISTINCT label, text FROM spans",
    ),
)
def z4_first_values(t: Tables) -> DataFrame:
    """One row per distinct detected value of a stream."""
    stream = table_stream(t.spark, t.folder, "documents").select(
        "doc_id", "text",
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") % 3000).alias("arrived"),
    )
    done = redact_stream(stream, "text", RedactOptions(generator_default="Synthesis", key=KEY))
    return run_available(first_values(spans_of(done, ["arrived"]), "arrived"), "values").select(
        "label", "text"
    )
