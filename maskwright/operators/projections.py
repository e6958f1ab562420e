"""Public projections of models and versions, with counts and scores derived from their files.

Files stay rows: a version of a million files is a million rows in a table of its own, and never
an array in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.operators.evaluate import active_models, micro, scores

_ERRORS = ("error_type", "error_details")


def _derived(files: DataFrame, key: str) -> DataFrame:
    """(key, file_count, entity_count, scores) from files(key, num_entities, counts): files are
    counted once each, and scores are averaged over spans, not over files."""
    counted = files.groupBy(key).agg(
        F.count("*").alias("file_count"), F.coalesce(F.sum("num_entities"), F.lit(0)).cast("long").alias("entity_count")
    )
    rated = scores(micro(files, [key])).select(key, "precision_score", "recall_score", "f1_score")
    return counted.join(rated, key)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)


def trained_models(
    models: DataFrame,
    files: DataFrame,
    activations: DataFrame,
    entity_id: object = None,
    model_id: object = None,
) -> DataFrame:
    """The models of all entities, of one, or one model, with their state.

    ``models`` are rows (id, number, entity_id, version_id, status), ``files`` rows (model_id,
    status, num_entities, predicted, gold, pred_hits, gold_hits), one per training file;
    ``activations`` rows (entity_id, model_id, at, event_id).  ``progress`` is the share of files
    that are ready, ``benchmark_score`` the F1 over all spans of the files; both are NULL for a
    model without files.  The model that was activated last is the active one of its entity.
    """
    if entity_id is not None:
        models = models.filter(F.col("entity_id") == F.lit(entity_id))
        activations = activations.filter(F.col("entity_id") == F.lit(entity_id))
    if model_id is not None:
        models = models.filter(F.col("id") == F.lit(model_id))
        files = files.filter(F.col("model_id") == F.lit(model_id))
    done = files.groupBy("model_id").agg(
        F.avg(F.when(F.col("status") == "Ready", 1.0).otherwise(0.0)).alias("progress")
    )
    active = active_models(activations).select("entity_id", F.col("model_id").alias("active_id"))
    named = models.withColumnRenamed("id", "model_id")
    return (
        named.join(_derived(files, "model_id"), "model_id", "left")
        .join(done, "model_id", "left").join(active, "entity_id", "left")
        .select(
            "model_id", F.col("number").alias("model_number"), "entity_id", "version_id", "status",
            F.coalesce(F.col("active_id") == F.col("model_id"), F.lit(False)).alias("is_active"),
            "progress", F.col("f1_score").alias("benchmark_score"),
            _or_zero("entity_count"), _or_zero("file_count"),
        )
    )


def version_summaries(
    versions: DataFrame, files: DataFrame, guidelines: bool = False, errors: bool = True
) -> DataFrame:
    """Versions(id, entity_id, version_number, status, guidelines, error_type, error_details) with
    counts and scores of their files(version_id, num_entities, predicted, gold, pred_hits,
    gold_hits); the groups ``guidelines`` and ``errors`` are optional.
    """
    extra = [*(["guidelines"] if guidelines else []), *(_ERRORS if errors else [])]
    own = _derived(files.withColumnRenamed("version_id", "id"), "id")
    return versions.join(own, "id", "left").select(
        F.col("id").alias("version_id"), "entity_id", "version_number", "status",
        _or_zero("entity_count"), "f1_score", "recall_score", "precision_score",
        _or_zero("file_count"), *extra,
    )


def version_files(files: DataFrame, errors: bool = True) -> DataFrame:
    """Files of versions, a row each, with their own scores."""
    extra = _ERRORS if errors else []
    return scores(files).select(
        "version_id", "file_id", "file_name", "status", "num_entities", "f1_score", "recall_score",
        "precision_score", *extra,
    )
