"""Evaluation of detected spans against reviewed ones, and the tables around versions.

Span tables are keyed (file_id, start, end); every gold and every predicted span counts once,
however many spans of the other side it meets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.operators.ordinals import latest_per_key

# Width of the position buckets of the overlap join.
BUCKET = 256
SPAN_KEYS = ("file_id", "start", "end")


def exact_outcomes(pred: DataFrame, gold: DataFrame, keys: Sequence[str] = SPAN_KEYS) -> DataFrame:
    """One row per distinct span with its membership on either side."""
    tagged = pred.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("g")).unionByName(
        gold.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("g"))
    )
    return tagged.groupBy(*keys).agg(
        F.max("p").alias("in_pred"), F.max("g").alias("in_gold")
    )


def exact_counts(pred: DataFrame, gold: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: predicted and gold spans, and how many of each are matched exactly."""
    both = F.col("in_pred") * F.col("in_gold")
    keys = [*SPAN_KEYS, *[b for b in by if b not in SPAN_KEYS]]
    return exact_outcomes(pred, gold, keys).groupBy(*by).agg(
        F.sum("in_pred").cast("long").alias("predicted"),
        F.sum("in_gold").cast("long").alias("gold"),
        F.sum(both).cast("long").alias("pred_hits"),
        F.sum(both).cast("long").alias("gold_hits"),
    )


def _bucketed(spans: DataFrame) -> DataFrame:
    last = F.greatest(F.col("end") - 1, F.col("start"))
    return spans.select(
        "*",
        F.explode(
            F.sequence((F.col("start") / BUCKET).cast("int"), (last / BUCKET).cast("int"))
        ).alias("bucket"),
    )


def overlapping(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct spans of ``left`` that overlap any span of ``right`` in the same file.

    Joined per stretch of text, so a file with very many spans is spread over many tasks and
    only near neighbours meet.
    """
    near = _bucketed(right.select(
        F.col("file_id").alias("r_file"), F.col("start").alias("r_start"),
        F.col("end").alias("r_end"), F.col("start"), F.col("end"),
    )).drop("start", "end").withColumnRenamed("bucket", "r_bucket")
    own = _bucketed(left.select(*SPAN_KEYS))
    hit = (
        (F.col("file_id") == F.col("r_file"))
        & (F.col("bucket") == F.col("r_bucket"))
        & (F.col("start") < F.col("r_end"))
        & (F.col("r_start") < F.col("end"))
    )
    return own.join(near, hit, "left_semi").select(*SPAN_KEYS).distinct()


def overlap_counts(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Per file: predicted and gold spans, and how many of each meet the other side."""
    pred, gold = pred.select(*SPAN_KEYS).distinct(), gold.select(*SPAN_KEYS).distinct()

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select("file_id", F.lit(name).alias("kind"))

    rows = (
        tagged(pred, "predicted")
        .unionByName(tagged(gold, "gold"))
        .unionByName(tagged(overlapping(pred, gold), "pred_hits"))
        .unionByName(tagged(overlapping(gold, pred), "gold_hits"))
    )
    return rows.groupBy("file_id").agg(
        *[
            F.count_if(F.col("kind") == name).alias(name)
            for name in ("predicted", "gold", "pred_hits", "gold_hits")
        ]
    )


def scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from counts; a ratio over nothing is NULL."""
    p = F.col("pred_hits") / F.nullif(F.col("predicted"), F.lit(0))
    r = F.col("gold_hits") / F.nullif(F.col("gold"), F.lit(0))
    rated = counts.select("*", p.alias("precision_score"), r.alias("recall_score"))
    total = F.col("precision_score") + F.col("recall_score")
    return rated.select(
        "*",
        F.when(
            total > 0, 2 * F.col("precision_score") * F.col("recall_score") / total
        ).alias("f1_score"),
    )


def micro(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts summed over files, for micro-averaged scores."""
    names = ("predicted", "gold", "pred_hits", "gold_hits")
    sums = [F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names]
    return counts.groupBy(*by).agg(*sums) if by else counts.agg(*sums)


def saved_ground_truth(batches: DataFrame, files: DataFrame) -> DataFrame:
    """Gold spans of batches(file_id, batch, annotations, mark_reviewed): the latest batch wins.

    A span outside the file is reported in ``error`` instead of being stored silently.  A file
    reviewed as having no spans is one row without a span.
    """
    last = latest_per_key(batches, ["file_id"], [F.col("batch")])
    sized = last.join(files.select("file_id", F.length("content").alias("n")), "file_id")
    spans = sized.select(
        "file_id", "n", "mark_reviewed", F.explode_outer("annotations").alias("a")
    ).select("file_id", "n", "mark_reviewed", "a.start", "a.end")
    valid = (F.col("start") >= 0) & (F.col("start") <= F.col("end")) & (F.col("end") <= F.col("n"))
    return spans.select(
        "file_id", "start", "end",
        F.when(F.col("mark_reviewed"), "Reviewed").otherwise("ReviewInProgress").alias("status"),
        F.when(~valid, "span outside the file").alias("error"),
    )


def next_versions(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """New versions(entity_id, guidelines) numbered after the highest existing one."""
    highest = versions.groupBy("entity_id").agg(F.max("version_number").alias("highest"))
    return requests.join(highest, "entity_id", "left").select(
        "entity_id",
        (F.coalesce("highest", F.lit(0)) + 1).alias("version_number"),
        "guidelines",
        F.lit("Annotating").alias("status"),
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """The highest version per entity; on ties the row seen first (lowest id) wins."""
    best = F.max_by(F.struct("id", "version_number"), F.struct("version_number", F.negate("seq")))
    return versions.groupBy("entity_id").agg(best.alias("b")).select(
        "entity_id", F.col("b.id").alias("id"), F.col("b.version_number").alias("version_number")
    )


def file_annotations(
    version_files: DataFrame, spans: DataFrame, versions: DataFrame, version_id: Column | None = None
) -> DataFrame:
    """Annotation spans of files for a version, the latest one of the entity by default."""
    chosen = (
        latest_versions(versions).select(F.col("id").alias("version_id"))
        if version_id is None
        else versions.filter(F.col("id") == version_id).select(F.col("id").alias("version_id"))
    )
    files = version_files.join(chosen, "version_id", "left_semi")
    return files.join(spans, ["version_id", "file_id"], "left")


def detected_values(spans: DataFrame, value: str = "text") -> DataFrame:
    """Most common detected values with their counts, ready for paging."""
    return spans.groupBy(F.col(value).alias("name")).agg(F.count("*").alias("count"))


def active_models(activations: DataFrame) -> DataFrame:
    """One active model per entity: the latest activation event."""
    return latest_per_key(
        activations, ["entity_id"], [F.col("at"), F.col("event_id")]
    ).select("entity_id", "model_id")


def to_retry(version_files: DataFrame) -> DataFrame:
    """Files whose annotation failed and has to run again."""
    return version_files.filter(F.col("status") == "Failed")
