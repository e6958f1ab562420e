"""Registries of datasets, jobs and custom entities as append-only event tables.

A table is only ever appended to; its current state is the latest event per key without
tombstones.  Rows therefore stay correct when a task is retried or two writers meet.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.text import duration_seconds
from maskwright.operators.ordinals import latest_per_key

FILE_SOURCES = ("Local", "S3", "Azure", "GoogleCloud")
ENTITY_STATUSES = ("TestDataSetup", "GuidelinesRefinement", "PreTraining", "Training", "Ready")
VERSION_STATUSES = (
    "Annotating", "QueuedForSuggestions", "GeneratingSuggestions", "Ready", "Failed",
)
MODEL_STATUSES = (
    "WaitingForFiles", "Annotating", "ReadyForTraining", "Training", "Ready", "Failed",
)
TEST_FILE_STATUSES = (
    "QueuedForAnalysis", "Analyzing", "QueuedForAnnotation", "Annotating", "ReadyForReview",
    "ReviewInProgress", "Reviewed", "Failed",
)
VERSION_FILE_STATUSES = (
    "Attached", "QueuedForAnnotation", "Annotating", "PendingReview", "Annotated", "Failed",
)
TRAINING_FILE_STATUSES = ("QueuedForAnalysis", "Analyzing", "Ready", "Failed")
NO_ERROR_LOG = "No error logs available for this job."


def check_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Fail on a row whose value is outside a closed set of strings."""
    value = F.col(column)
    return df.withColumn(
        column,
        F.when(value.isNull() | value.isin(*domain), value).otherwise(
            F.raise_error(F.concat(F.lit(f"{column} outside its domain: "), value))
        ),
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def current(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str | None = "deleted"
) -> DataFrame:
    """Latest event per key, tombstoned keys left out."""
    rows = latest_per_key(events, keys, [F.col(o) for o in order])
    return rows.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else rows


def tombstones(rows: DataFrame, at: Column, time_col: str = "at") -> DataFrame:
    """Events that delete the given rows."""
    return rows.withColumn("deleted", F.lit(True)).withColumn(time_col, at)


def upsert(rows: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Named fields of ``updates`` replace those of ``rows``; absent (NULL) ones stay.

    A key that ``rows`` lacks is created, with NULL in the fields that nobody named.  Of several
    updates of a key the greatest value of each field counts.
    """
    fields = [c for c in updates.columns if c != key and c in rows.columns]
    new = updates.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.lit(1).alias("__any"), *[F.max(c).alias(f"__new_{c}") for c in fields]
    )
    joined = rows.join(new, F.col(key) == F.col("__key"), "full_outer")
    return joined.select(*[
        F.coalesce(F.col(f"__new_{c}") if c in fields else F.col("__key"), F.col(c)).alias(c)
        if c in fields or c == key else F.col(c)
        for c in rows.columns
    ])


def new_datasets(names: DataFrame, at: str) -> DataFrame:
    """Events that create datasets(name); ids depend on name and time, so retries agree."""
    return names.select(
        F.sha2(F.concat_ws("|", "name", F.lit(at)), 256).substr(1, 32).alias("id"),
        "name",
        F.lit(at).cast("timestamp").alias("at"),
        F.lit(False).alias("deleted"),
    )


def new_entity_files(paths: DataFrame, entity_id: str, kind: str, at: Column) -> DataFrame:
    """Events that add test or training files(path, content) to an entity."""
    if kind not in ("test", "training"):
        raise ValueError("kind must be 'test' or 'training'")
    return paths.select(
        F.sha2(F.concat_ws("|", F.lit(entity_id), F.lit(kind), "path"), 256)
        .substr(1, 32)
        .alias("id"),
        F.lit(entity_id).alias("entity_id"),
        F.lit(kind).alias("kind"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("content"),
        F.lit("QueuedForAnalysis").alias("status"),
        at.alias("created_at"),
        F.lit(False).alias("deleted"),
    )


def list_datasets(datasets: DataFrame, files: DataFrame) -> DataFrame:
    """Datasets with their file counts, 0 for empty ones."""
    counts = files.groupBy(F.col("dataset_id").alias("id")).agg(F.count("*").alias("file_count"))
    return datasets.select("id", "name").join(counts, "id", "left").select(
        "id", "name", F.coalesce("file_count", F.lit(0)).alias("file_count")
    )


def files_with_datasets(
    datasets: DataFrame, files: DataFrame, dataset_id: str | None = None
) -> DataFrame:
    """One dataset, or all, with their files: one row per file, one without a file when empty."""
    own = files.withColumnRenamed("dataset_id", "id")
    if dataset_id is not None:
        datasets = datasets.filter(F.col("id") == dataset_id)
        own = own.filter(F.col("id") == dataset_id)
    return datasets.select("id", "name").join(own, "id", "left")


def resolve_uploads(uploads: DataFrame, files: DataFrame) -> DataFrame:
    """The file row of every upload(dataset_id, uploaded_file_id, file_name): by id, else by name."""
    by_id = files.select(
        "dataset_id",
        F.col("file_id").alias("uploaded_file_id"),
        F.col("file_id").alias("id_match"),
        F.col("processing_status").alias("id_status"),
    )
    by_name = files.groupBy("dataset_id", "file_name").agg(
        F.min_by(
            F.struct(F.col("file_id"), F.col("processing_status")), F.col("file_id")
        ).alias("first")
    )
    return (
        uploads.join(by_id, ["dataset_id", "uploaded_file_id"], "left")
        .join(by_name, ["dataset_id", "file_name"], "left")
        .select(
            *uploads.columns,
            F.coalesce("uploaded_file_id", "id_match", "first.file_id").alias("file_id"),
            F.coalesce("id_status", "first.processing_status").alias("status"),
        )
    )


def jobs_since(jobs: DataFrame, window: str | None, as_of: Column) -> DataFrame:
    """Jobs published within a look-back window such as ``30m``, ``1h`` or ``7d``."""
    if window is None:
        return jobs
    if not re.fullmatch(r"(?i)\d+\s*[smhd]|(\d+\.)?\d+:\d{2}:\d{2}", window):
        raise ValueError(f"not a duration: {window!r}")
    span = F.make_dt_interval(secs=duration_seconds(F.lit(window)).cast("decimal(18,6)"))
    return jobs.filter(F.col("published_time") >= as_of - span)


def job_errors(jobs: DataFrame) -> DataFrame:
    """Error text of failed jobs, with a default when it is missing or empty."""
    return jobs.filter(F.lower("status") == "failed").select(
        "id",
        F.coalesce(F.nullif("error_messages", F.lit("")), F.lit(NO_ERROR_LOG)).alias("error_log"),
    )


def active_entities_by_dataset(bridge: DataFrame, dataset_id: str | None = None) -> DataFrame:
    """Entities switched on for datasets by the latest (entity_id, dataset_id) event."""
    if dataset_id is not None:
        bridge = bridge.filter(F.col("dataset_id") == dataset_id)
    latest = latest_per_key(
        bridge, ["entity_id", "dataset_id"], [F.col("at"), F.col("event_id")]
    )
    return latest.filter("active").select("entity_id", "dataset_id")


def summarize_entity(entities: DataFrame, details: bool = False) -> DataFrame:
    """Public projection of entities."""
    columns = [
        F.col("id").alias("entity_id"), "name", "display_name", "status", "active_model_id",
        F.col("last_modified").alias("last_modified_date"),
    ]
    if details:
        columns += ["file_source", F.col("created_by").alias("created_by_user_id")]
    return entities.select(*columns)
