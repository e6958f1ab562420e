"""Evaluation, versions, models and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.functions import spans as sp
from maskwright.operators import evaluate as ev
from maskwright.operators.audit import call_stats
from maskwright.operators.detectors import pattern_detector, register_detector
from maskwright.operators.listing import Listing, ListQuery, page
from maskwright.operators.models import train
from maskwright.operators.policy import RedactOptions
from maskwright.operators.projections import trained_models, version_summaries
from maskwright.operators.redact import detect, flat_candidates, redact
from maskwright.operators.registry import upsert
from maskwright.operators.sizing import spread
from maskwright.operators.span_store import SpanStore
from maskwright.queries import fixtures as fx
from maskwright.queries.base import (
    REDACTED,
    Tables,
    query,
    sql_candidates,
    sql_matches,
    sql_rebuilt,
    sql_resolved,
    sql_shifted,
    with_ctes,
)
from maskwright.sources.tables import write_table
from maskwright.streaming.streams import scratch

# Predictions: the built-in types, and every lone three-digit number (false positives).
# Reviewed spans: phone numbers start one character later, addresses of hosts are no entities,
# and long words were marked that no detector knows.
_NUMBER, _LONG_WORD = r"\b\d{3}\b", r"[A-Za-z]{14,}"
_PRED_LABELS = list(fx.DOC_LABELS)
_GOLD_LABELS = ["EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD", "SECRET_TOKEN"]


def pred_spans(t: Tables) -> DataFrame:
    text = F.col("text")
    every = sp.pattern_candidates(
        text,
        [
            *sp.built_in_patterns(_detectors(_PRED_LABELS)),
            sp.Pattern(_NUMBER, "NUMBER", 1),
        ],
    )
    found = spread(t.documents.select("doc_id", "source", "text")).select(
        "doc_id", "source", sp.once(every).alias("spans")
    )
    return flat_candidates(found, ["doc_id", "source"]).select(
        F.col("doc_id").alias("file_id"), "source", "label", "text", "start", "end", "score"
    )


def gold_spans(t: Tables) -> DataFrame:
    patterns = [
        *sp.built_in_patterns(_detectors(_GOLD_LABELS)), sp.Pattern(_LONG_WORD, "LONG_WORD", 1)
    ]
    found = spread(t.documents.select("doc_id", "source", "text")).select(
        "doc_id", "source",
        sp.once(sp.pattern_candidates(F.col("text"), patterns)).alias("spans"),
    )
    moved = F.when(F.col("label") == "PHONE_NUMBER", 1).otherwise(0)
    return flat_candidates(found, ["doc_id", "source"]).select(
        F.col("doc_id").alias("file_id"), "source", "label",
        (F.col("start") + moved).alias("start"), "end",
    )


def stored(t: Tables, spans: DataFrame, name: str) -> DataFrame:
    """Spans written once: an evaluation reads them several times, the texts only once."""
    path = f"{scratch(t.spark, 'spans')}/{name}"
    write_table(spans, path)
    return t.spark.read.parquet(path)


def stored_pair(t: Tables) -> tuple[DataFrame, DataFrame]:
    return stored(t, pred_spans(t), "pred"), stored(t, gold_spans(t), "gold")


def _detectors(labels):
    from maskwright.functions.catalog import DETECTORS

    return [DETECTORS[label] for label in labels]


SPANS = [
    sql_candidates(
        "documents", "doc_id", "text", _PRED_LABELS,
        [sql_matches("documents", "doc_id", "text", "NUMBER", _NUMBER, 1)], name="pred_raw",
    ),
    sql_candidates(
        "documents", "doc_id", "text", _GOLD_LABELS,
        [sql_matches("documents", "doc_id", "text", "LONG_WORD", _LONG_WORD, 1)], name="gold_raw",
    ),
    """pred AS (SELECT p.k AS file_id, d.source, p.label, p.text, p."start", p."end", p.score
      FROM pred_raw p JOIN documents d ON d.doc_id = p.k)""",
    """gold AS (SELECT g.k AS file_id, d.source, g.label,
        g."start" + CASE WHEN g.label = 'PHONE_NUMBER' THEN 1 ELSE 0 END AS "start", g."end"
      FROM gold_raw g JOIN documents d ON d.doc_id = g.k)""",
]
# Distinct spans with their counterparts, each counted once.
_EXACT = """p AS (SELECT DISTINCT file_id, source, "start", "end" FROM pred),
g AS (SELECT DISTINCT file_id, source, "start", "end" FROM gold),
pm AS (SELECT p.*, EXISTS (SELECT 1 FROM g WHERE g.file_id = p.file_id
         AND g."start" = p."start" AND g."end" = p."end") AS hit FROM p),
gm AS (SELECT g.*, EXISTS (SELECT 1 FROM p WHERE g.file_id = p.file_id
         AND g."start" = p."start" AND g."end" = p."end") AS hit FROM g)"""
_OVERLAP = _EXACT.replace(
    """AND g."start" = p."start" AND g."end" = p."end")""",
    """AND g."start" < p."end" AND p."start" < g."end")""",
)


def _sql_scores(by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}predicted, gold, pred_hits, gold_hits,
        pred_hits / nullif(predicted, 0) AS precision_score,
        gold_hits / nullif(gold, 0) AS recall_score,
        CASE WHEN pred_hits > 0 THEN 2 * (pred_hits / predicted) * (gold_hits / gold)
          / (pred_hits / predicted + gold_hits / gold) END AS f1_score
      FROM (SELECT {keys}sum(predicted)::BIGINT AS predicted, sum(gold)::BIGINT AS gold,
              sum(pred_hits)::BIGINT AS pred_hits, sum(gold_hits)::BIGINT AS gold_hits
            FROM (SELECT file_id, source, 1 AS predicted, 0 AS gold, hit::INT AS pred_hits,
                    0 AS gold_hits FROM pm
                  UNION ALL SELECT file_id, source, 0, 1, 0, hit::INT FROM gm) u {group}) c"""


@query("m3_exact_scores_per_file", with_ctes(*SPANS, _EXACT, select=_sql_scores("file_id")))
def m3_exact_scores_per_file(t: Tables) -> DataFrame:
    """Precision, recall and F1 per file on exact spans."""
    return ev.scores(ev.exact_counts(pred_spans(t), gold_spans(t), ["file_id"]))


@query("m3_exact_scores_per_version", with_ctes(*SPANS, _EXACT, select=_sql_scores("source")))
def m3_exact_scores_per_version(t: Tables) -> DataFrame:
    """M3: the same per version (a source of documents stands for a version)."""
    return ev.scores(ev.exact_counts(pred_spans(t), gold_spans(t), ["source"]))


@query("m3_overlap_scores_per_file", with_ctes(*SPANS, _OVERLAP, select=_sql_scores("file_id")))
def m3_overlap_scores_per_file(t: Tables) -> DataFrame:
    """Scores on any overlap, every span counted once."""
    return ev.scores(ev.overlap_counts(*stored_pair(t)))


@query("m3_overlap_scores_overall", with_ctes(*SPANS, _OVERLAP, select=_sql_scores("")))
def m3_overlap_scores_overall(t: Tables) -> DataFrame:
    """M3: micro average over all files."""
    return ev.scores(ev.micro(ev.overlap_counts(*stored_pair(t))))


@query(
    "j5_overlapping_spans",
    with_ctes(
        *SPANS, _OVERLAP, select='SELECT file_id, "start", "end" FROM pm WHERE hit',
    ),
)
def j5_overlapping_spans(t: Tables) -> DataFrame:
    """Predicted spans that meet a reviewed span, joined per stretch of text."""
    return ev.overlapping(pred_spans(t), gold_spans(t))


@query(
    "j6_exact_outcomes",
    with_ctes(
        *SPANS, _EXACT,
        select="""SELECT coalesce(p.file_id, g.file_id) AS file_id,
            coalesce(p."start", g."start") AS "start", coalesce(p."end", g."end") AS "end",
            (p.file_id IS NOT NULL)::INT AS in_pred, (g.file_id IS NOT NULL)::INT AS in_gold
          FROM p FULL JOIN g ON g.file_id = p.file_id AND g."start" = p."start"
            AND g."end" = p."end" """,
    ),
)
def j6_exact_outcomes(t: Tables) -> DataFrame:
    """Both sides of the exact match with their membership."""
    return ev.exact_outcomes(pred_spans(t), gold_spans(t))


@query(
    "m1_ground_truth",
    """WITH batches AS (
         SELECT o.o_custkey AS file_id, o.o_orderkey AS batch, o.o_orderstatus <> 'O' AS mark,
           l_linenumber * 3 AS "start",
           l_linenumber * 3 + (l_quantity * (CASE WHEN l_returnflag = 'A' THEN 30 ELSE 1 END))::INT AS "end"
         FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
       last AS (SELECT file_id, max(batch) AS batch FROM batches GROUP BY file_id)
       SELECT b.file_id, b."start", b."end",
         CASE WHEN b.mark THEN 'Reviewed' ELSE 'ReviewInProgress' END AS status,
         CASE WHEN b."end" > length(d.text) THEN 'span outside the file' END AS error
       FROM batches b JOIN last ON last.file_id = b.file_id AND last.batch = b.batch
       JOIN documents d ON d.doc_id = b.file_id""",
)
def m1_ground_truth(t: Tables) -> DataFrame:
    """M1: the latest reviewed batch of every file; spans outside the file are reported."""
    length = F.col("l_quantity") * F.when(F.col("l_returnflag") == "A", 30).otherwise(1)
    start = F.col("l_linenumber") * 3
    spans = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(
            F.struct(start.alias("start"), (start + length.cast("int")).alias("end"))
        ).alias("annotations")
    )
    batches = t.orders.join(spans, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("file_id"), F.col("o_orderkey").alias("batch"), "annotations",
        (F.col("o_orderstatus") != "O").alias("mark_reviewed"),
    )
    files = t.documents.select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))
    return ev.saved_ground_truth(batches, files)


@query(
    "m2_next_version",
    with_ctes(
        fx.ENTITY_VERSIONS,
        select="""SELECT o.o_orderkey AS entity_id,
            coalesce((SELECT max(version_number) FROM entity_versions v
                      WHERE v.entity_id = o.o_orderkey), 0) + 1 AS version_number,
            'refined ' || o.o_orderpriority AS guidelines, 'Annotating' AS status FROM orders o""",
    ),
)
def m2_next_version(t: Tables) -> DataFrame:
    """M2: new versions numbered after the highest one of their entity."""
    requests = t.orders.select(
        F.col("o_orderkey").alias("entity_id"),
        F.concat(F.lit("refined "), "o_orderpriority").alias("guidelines"),
    )
    return ev.next_versions(fx.entity_versions(t), requests)


_LATEST = """latest AS (
  SELECT entity_id, id FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY version_number DESC, seq) AS rn
    FROM entity_versions) x WHERE rn = 1)"""


@query(
    "m4_latest_version_annotations",
    with_ctes(
        fx.ENTITY_VERSIONS, _LATEST,
        select="""SELECT l.entity_id, l.id AS version_id, v.guidelines, v.status
          FROM latest l JOIN entity_versions v ON v.id = l.id""",
    ),
)
def m4_latest_version_annotations(t: Tables) -> DataFrame:
    """M4 A4: records of the latest version of every entity; the first seen wins a tie."""
    versions = fx.entity_versions(t)
    records = versions.select(
        F.col("id").alias("version_id"), "entity_id", F.col("id").alias("file_id"), "status"
    )
    notes = versions.select(
        F.col("id").alias("version_id"), F.col("id").alias("file_id"), "guidelines"
    )
    return ev.file_annotations(records, notes, versions).select(
        "entity_id", "version_id", "guidelines", "status"
    )


@query(
    "m5_versions_of_entities",
    with_ctes(
        fx.ENTITY_VERSIONS, fx.ENTITIES,
        select="""SELECT e.id AS entity_id, e.name, v.version_number, v.status, v.guidelines
          FROM entities e JOIN entity_versions v ON v.entity_id = e.id""",
    ),
)
def m5_versions_of_entities(t: Tables) -> DataFrame:
    """Versions of live entities with their guidelines; many ids are one join."""
    versions = fx.entity_versions(t).withColumnRenamed("id", "version_id")
    return fx.entities(t).withColumnRenamed("id", "entity_id").drop("status").join(
        versions, "entity_id"
    ).select("entity_id", "name", "version_number", "status", "guidelines")


@query(
    "m6_detected_values",
    with_ctes(
        *SPANS,
        select="""SELECT text AS name, count(*) AS count FROM pred
          WHERE contains(lower(text), '1') GROUP BY text ORDER BY count DESC, name OFFSET 2 LIMIT 50""",
    ),
)
def m6_detected_values(t: Tables) -> DataFrame:
    """Most common detected values, searched and paged."""
    listing = Listing(key="name", search="name", sortable=["count"])
    return page(
        ev.detected_values(pred_spans(t)), listing,
        ListQuery(search="1", sort_by="count", sort_direction="desc", offset=2, limit=50),
    )


@query(
    "m7_training_files",
    with_ctes(
        *SPANS,
        select="""SELECT d.doc_id AS file_id, 'd' || d.doc_id || '.txt' AS file_name,
            count(g.file_id) AS num_entities
          FROM documents d LEFT JOIN gold g ON g.file_id = d.doc_id GROUP BY d.doc_id""",
    ),
)
def m7_training_files(t: Tables) -> DataFrame:
    """M7 A3: training files with their span counts."""
    counts = gold_spans(t).groupBy("file_id").agg(F.count("*").alias("n"))
    files = fx.dataset_files(t).select("file_id", "file_name")
    return files.join(counts, "file_id", "left").select(
        "file_id", "file_name", F.coalesce("n", F.lit(0)).alias("num_entities")
    )


@query("m8_trained_detector")
def m8_trained_detector(t: Tables) -> DataFrame:
    """M8: a detector trained on reviewed spans and run over all documents."""
    files = t.documents.select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))
    reviewed = gold_spans(t).filter("label IN ('EMAIL_ADDRESS', 'CREDIT_CARD')").select(
        "file_id", "start", "end"
    )
    model = train(spread(files), reviewed, "CONTACT", iterations=10)
    register_detector("contact-model", model.detector())
    options = RedactOptions(labels=[], custom_entities=["contact-model"])
    found = detect(spread(t.documents.select("doc_id", "text")), "text", options)
    return flat_candidates(found, ["doc_id"]).select("doc_id", "label", "text", "start", "end")


@query(
    "m9_active_models",
    """SELECT entity_id, model_id FROM (
         SELECT o_custkey AS entity_id, 'm' || o_orderkey AS model_id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) x WHERE rn = 1""",
)
def m9_active_models(t: Tables) -> DataFrame:
    """M9: one active model per entity, the one activated last."""
    activations = t.orders.select(
        F.col("o_custkey").alias("entity_id"),
        F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("model_id"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("event_id"),
    )
    return ev.active_models(activations)


@query(
    "m10_retry_annotation",
    with_ctes(
        "failed AS (SELECT doc_id, text FROM documents WHERE doc_id % 3 = 2)",
        sql_candidates("failed", "doc_id", "text"), sql_resolved(), sql_shifted(REDACTED),
        sql_rebuilt("failed", "doc_id", "text"), fx.DATASET_FILES,
        select="""SELECT f.file_id,
            CASE WHEN f.processing_status = 'Failed' THEN 'Annotated' ELSE f.processing_status END AS status,
            CASE WHEN f.processing_status = 'Failed' THEN r.entities_found END AS num_entities
          FROM dataset_files f LEFT JOIN rebuilt r ON r.k = f.file_id""",
    ),
)
def m10_retry_annotation(t: Tables) -> DataFrame:
    """Files whose annotation failed are detected again and updated."""
    files = fx.dataset_files(t).select(
        "file_id", F.col("processing_status").alias("status"),
        F.lit(None).cast("int").alias("num_entities"),
    )
    texts = t.documents.select(F.col("doc_id").alias("file_id"), "text")
    again = spread(ev.to_retry(files).select("file_id").join(texts, "file_id"))
    done = redact(again, "text").select(
        "file_id", F.lit("Annotated").alias("status"),
        F.col("entities_found").alias("num_entities"),
    )
    return upsert(files, done, "file_id")


@query(
    "a9_call_statistics",
    """SELECT event_type AS tool, count(*) AS calls,
         count(*) FILTER (event_type = 'error') AS errors,
         round(avg(value), 6) AS mean_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms
       FROM events GROUP BY event_type""",
)
def a9_call_statistics(t: Tables) -> DataFrame:
    """Calls, errors, mean and 95th percentile duration per operation."""
    audit = t.events.select(
        F.col("event_type").alias("tool"), F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"),
    )
    return call_stats(audit).select(
        "tool", "calls", "errors", F.round("mean_ms", 6).alias("mean_ms"),
        F.round("p95_ms", 6).alias("p95_ms"),
    )


@query(
    "r17_dataset_detectors",
    with_ctes(
        *[
            sql_candidates(
                "documents", "doc_id", "text", [],
                [sql_matches("documents", "doc_id", "text", "LONG_WORD", _LONG_WORD, 1)],
            ),
            sql_resolved(),
        ],
        select="SELECT label, count(*) AS spans, count(DISTINCT text) AS variants FROM spans GROUP BY label",
    ),
)
def r17_dataset_detectors(t: Tables) -> DataFrame:
    """A custom detector run alone, without any built-in type in the plan."""
    register_detector("long-word", pattern_detector("LONG_WORD", _LONG_WORD))
    options = RedactOptions(labels=[], custom_entities=["long-word"])
    found = detect(spread(t.documents.select("doc_id", "text")), "text", options)
    spans = flat_candidates(found, ["doc_id"])
    return spans.groupBy("label").agg(
        F.count("*").alias("spans"), F.countDistinct("text").alias("variants")
    )


_CHANGED = "CASE WHEN lang = 'de' THEN text || ' or 10.9.8.7' ELSE text END"


@query(
    "m4_forced_prediction",
    with_ctes(
        f"before AS (SELECT doc_id, {_CHANGED} AS text FROM documents)",
        sql_candidates("documents", "doc_id", "text"), sql_resolved(),
        sql_candidates("before", "doc_id", "text", name="cand_2"), sql_resolved("cand_2", "spans_2"),
        """counts AS (SELECT
             (SELECT count(DISTINCT text) FROM before) AS n_before,
             (SELECT count(DISTINCT text) FROM documents) AS n_now,
             (SELECT count(DISTINCT text) FROM documents WHERE text NOT IN (
                SELECT text FROM before WHERE text IS NOT NULL)) AS n_changed,
             (SELECT count(*) FROM spans) AS s_now, (SELECT count(*) FROM spans_2) AS s_before)""",
        select="""SELECT 1 AS run, n_before AS scanned, s_before AS spans FROM counts
          UNION ALL SELECT 2, n_changed, s_now FROM counts
          UNION ALL SELECT 3, 0, s_now FROM counts
          UNION ALL SELECT 4, n_now, s_now FROM counts""",
    ),
)
def m4_forced_prediction(t: Tables) -> DataFrame:
    """Only changed texts are scanned again, none in a second run, and all by force."""
    store = SpanStore(t.spark, f"{scratch(t.spark, 'span_store')}/spans")
    now = spread(t.documents.select("doc_id", "text", "lang"))
    before = now.withColumn("text", F.expr(_CHANGED))
    done = None
    for run, (docs, force) in enumerate([(before, False), (now, False), (now, False), (now, True)], 1):
        told = store.predict(docs, "text", run=run, force=force)
        one = told.rows.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).select(
            F.lit(run).alias("run"), F.lit(told.scanned).cast("long").alias("scanned"), "spans")
        done = one if done is None else done.unionByName(one)
    return done


# Files of models and versions, one per line of an order, with counts of their spans.
_LINE_FILES = """files AS (
  SELECT l_orderkey AS owner, l_linenumber AS file_id, 'file ' || l_partkey AS file_name,
    CASE WHEN l_linestatus = 'F' THEN 'Ready' ELSE 'Analyzing' END AS status,
    l_quantity::BIGINT AS num_entities, l_quantity::BIGINT AS predicted,
    l_quantity::BIGINT + l_linenumber AS gold, (l_quantity::BIGINT * 3) // 4 AS hits FROM lineitem),
rated AS (
  SELECT *, hits / nullif(predicted, 0) AS p, hits / nullif(gold, 0) AS r FROM (
    SELECT owner, sum(num_entities)::BIGINT AS entity_count, count(*) AS file_count,
      avg((status = 'Ready')::INT) AS progress, sum(hits) AS hits, sum(predicted) AS predicted,
      sum(gold) AS gold FROM files GROUP BY owner) x)"""


def _line_files(t: Tables, key: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("long")
    hits = F.call_function("div", quantity * 3, F.lit(4))
    return t.lineitem.select(
        F.col("l_orderkey").alias(key), F.col("l_linenumber").alias("file_id"),
        F.concat(F.lit("file "), F.col("l_partkey").cast("string")).alias("file_name"),
        F.when(F.col("l_linestatus") == "F", "Ready").otherwise("Analyzing").alias("status"),
        quantity.alias("num_entities"), quantity.alias("predicted"),
        (quantity + F.col("l_linenumber")).alias("gold"), hits.alias("pred_hits"), hits.alias("gold_hits"),
    )


@query(
    "m9_trained_models",
    with_ctes(
        _LINE_FILES,
        """last AS (SELECT o_custkey AS entity_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS active
           FROM orders GROUP BY o_custkey)""",
        select="""SELECT o_orderkey AS model_id, o_orderkey % 7 AS model_number, o_custkey AS entity_id,
            o_orderpriority AS version_id, o_orderstatus AS status, active = o_orderkey AS is_active,
            progress, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END AS benchmark_score,
            coalesce(entity_count, 0) AS entity_count, coalesce(file_count, 0) AS file_count
          FROM orders o LEFT JOIN rated f ON f.owner = o.o_orderkey JOIN last l ON l.entity_id = o.o_custkey""",
    ),
)
def m9_trained_models(t: Tables) -> DataFrame:
    """All models with progress, benchmark score, counts and whether they are active."""
    models = t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7).alias("number"),
        F.col("o_custkey").alias("entity_id"), F.col("o_orderpriority").alias("version_id"),
        F.col("o_orderstatus").alias("status"),
    )
    activations = t.orders.select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("model_id"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("event_id"),
    )
    return trained_models(models, _line_files(t, "model_id"), activations)


@query(
    "g15_version_counts",
    with_ctes(
        _LINE_FILES,
        select="""SELECT o_orderkey AS version_id, o_custkey AS entity_id, o_orderkey % 7 AS version_number,
            o_orderstatus AS status, coalesce(entity_count, 0) AS entity_count,
            CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END AS f1_score, r AS recall_score,
            p AS precision_score, coalesce(file_count, 0) AS file_count, o_orderpriority AS guidelines
          FROM orders o LEFT JOIN rated f ON f.owner = o.o_orderkey""",
    ),
)
def g15_version_counts(t: Tables) -> DataFrame:
    """Versions with counts and scores of their files, guidelines included, errors not."""
    none = F.lit(None).cast("string")
    versions = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity_id"),
        (F.col("o_orderkey") % 7).alias("version_number"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("guidelines"), none.alias("error_type"), none.alias("error_details"),
    )
    return version_summaries(versions, _line_files(t, "version_id"), guidelines=True, errors=False)
