"""Registries, jobs and response envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.operators.listing import unwrap_page
from maskwright.operators.ordinals import latest_per_key
from maskwright.operators.registry import (
    active_entities_by_dataset,
    append,
    current,
    files_with_datasets,
    job_errors,
    jobs_since,
    list_datasets,
    new_datasets,
    new_entity_files,
    resolve_uploads,
    summarize_entity,
    tombstones,
    upsert,
)
from maskwright.operators.snapshots import SnapshotRegistry
from maskwright.queries import fixtures as fx
from maskwright.queries.base import Tables, query, with_ctes
from maskwright.streaming.streams import scratch


@query(
    "s8_registry_state",
    with_ctes(fx.ENTITIES, select='SELECT id, name, status, "at" FROM entities'),
)
def s8_registry_state(t: Tables) -> DataFrame:
    """Events appended in batches; the state is the latest event per key."""
    path = f"{scratch(t.spark, 'registry')}/entities"
    append(fx.entity_events(t), path)
    return current(t.spark.read.parquet(path), ["id"], ["at"]).select("id", "name", "status", "at")


@query(
    "g1_create_datasets",
    """SELECT substr(sha256(source || '|2024-01-01'), 1, 32) AS id, source AS name, false AS deleted
       FROM (SELECT DISTINCT source FROM documents) d""",
)
def g1_create_datasets(t: Tables) -> DataFrame:
    """G1: creation events; ids depend on name and time, so a retried write repeats them."""
    names = t.documents.select(F.col("source").alias("name")).distinct()
    return new_datasets(names, "2024-01-01").select("id", "name", "deleted")


@query(
    "g2_list_datasets",
    with_ctes(
        fx.DATASETS, fx.DATASET_FILES,
        select="""SELECT d.id, d.name, count(f.file_id) AS file_count FROM datasets d
          LEFT JOIN dataset_files f ON f.dataset_id = d.id GROUP BY d.id, d.name""",
    ),
)
def g2_list_datasets(t: Tables) -> DataFrame:
    """Datasets with file counts, 0 for empty ones."""
    return list_datasets(fx.datasets(t), fx.dataset_files(t))


@query(
    "g3_dataset_details",
    with_ctes(
        fx.DATASETS, fx.DATASET_FILES,
        select="""SELECT d.id, d.name, f.file_id, f.file_name, f.num_rows, f.processing_status
          FROM datasets d LEFT JOIN dataset_files f ON f.dataset_id = d.id""",
    ),
)
def g3_dataset_details(t: Tables) -> DataFrame:
    """Every dataset with its files, one row per file."""
    return files_with_datasets(fx.datasets(t), fx.dataset_files(t))


@query(
    "g4_resolve_uploads",
    with_ctes(
        fx.DATASET_FILES,
        """uploads AS (SELECT source AS dataset_id,
            CASE WHEN lang = 'en' THEN doc_id WHEN lang = 'fr' THEN -doc_id - 1 END AS uploaded_file_id,
            CASE WHEN lang = 'de' THEN 'gone.txt' ELSE 'd' || doc_id || '.txt' END AS file_name
          FROM documents)""",
        select="""SELECT u.dataset_id, u.uploaded_file_id, u.file_name,
            coalesce(u.uploaded_file_id, n.file_id) AS file_id,
            coalesce(i.processing_status, n.processing_status) AS status
          FROM uploads u
          LEFT JOIN dataset_files i ON i.dataset_id = u.dataset_id AND i.file_id = u.uploaded_file_id
          LEFT JOIN dataset_files n ON n.dataset_id = u.dataset_id AND n.file_name = u.file_name""",
    ),
)
def g4_resolve_uploads(t: Tables) -> DataFrame:
    """An uploaded file is found by id, else by name."""
    lang, doc = F.col("lang"), F.col("doc_id")
    uploads = t.documents.select(
        F.col("source").alias("dataset_id"),
        F.when(lang == "en", doc).when(lang == "fr", -doc - 1).alias("uploaded_file_id"),
        F.when(lang == "de", "gone.txt")
        .otherwise(F.concat(F.lit("d"), doc.cast("string"), F.lit(".txt")))
        .alias("file_name"),
    )
    return resolve_uploads(uploads, fx.dataset_files(t))


@query(
    "g5_jobs_in_window",
    with_ctes(
        fx.JOBS,
        select="""SELECT id, status, strftime(published_time, '%Y-%m-%dT%H:%M:%S') AS published
          FROM jobs WHERE published_time >=
            (SELECT max(published_time) FROM jobs) - INTERVAL 700 DAY""",
    ),
)
def g5_jobs_in_window(t: Tables) -> DataFrame:
    """Jobs of a look-back window that ends at the newest job."""
    jobs = fx.jobs(t)
    # One row, the end of the window, joins all jobs.
    newest = jobs.agg(F.max("published_time").alias("as_of"))
    dated = jobs.crossJoin(F.broadcast(newest))
    return jobs_since(dated, "700d", F.col("as_of")).select(
        "id", "status",
        F.date_format("published_time", "yyyy-MM-dd'T'HH:mm:ss").alias("published"),
    )


@query(
    "g6_job_by_id",
    with_ctes(
        fx.JOBS,
        select="""SELECT l.l_orderkey AS asked, l.l_linenumber AS line, j.file_name, j.status
          FROM lineitem l JOIN jobs j ON j.id = l.l_orderkey""",
    ),
)
def g6_job_by_id(t: Tables) -> DataFrame:
    """Jobs looked up by id, many lookups as one join."""
    asked = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"))
    return asked.join(fx.jobs(t), "id").select(
        F.col("id").alias("asked"), "line", "file_name", "status"
    )


@query(
    "g7_job_errors",
    with_ctes(
        fx.JOBS,
        select="""SELECT id, coalesce(nullif(error_messages, ''),
            'No error logs available for this job.') AS error_log FROM jobs WHERE status = 'Failed'""",
    ),
)
def g7_job_errors(t: Tables) -> DataFrame:
    """Error text of failed jobs with a default."""
    return job_errors(fx.jobs(t))


@query(
    "g8_add_entity_files",
    """SELECT substr(sha256('e1|test|in/' || source || '/d' || doc_id || '.txt'), 1, 32) AS id,
         'e1' AS entity_id, 'test' AS kind, 'd' || doc_id || '.txt' AS file_name,
         'in/' || source || '/d' || doc_id || '.txt' AS file_path, text AS content,
         'QueuedForAnalysis' AS status, false AS deleted
       FROM documents""",
)
def g8_add_entity_files(t: Tables) -> DataFrame:
    """Test files added to an entity."""
    paths = t.documents.select(
        F.concat(
            F.lit("in/"), "source", F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".txt")
        ).alias("path"),
        F.col("text").alias("content"),
    )
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return new_entity_files(paths, "e1", "test", at).drop("created_at")


@query(
    "g9_entity_files",
    with_ctes(
        fx.DATASET_FILES,
        select="""SELECT dataset_id AS entity_id, file_id, file_name, processing_status AS status
          FROM dataset_files WHERE contains(lower(file_name), 'd1')
          ORDER BY file_name, file_id OFFSET 5 LIMIT 40""",
    ),
)
def g9_entity_files(t: Tables) -> DataFrame:
    """Files searched by name and paged."""
    from maskwright.operators.listing import Listing, ListQuery, page

    listing = Listing(key="file_id", search="file_name", sortable=["file_name"])
    files = page(
        fx.dataset_files(t), listing, ListQuery(search=" D1 ", sort_by="file_name", offset=5, limit=40)
    )
    return files.select(
        F.col("dataset_id").alias("entity_id"), "file_id", "file_name",
        F.col("processing_status").alias("status"),
    )


@query(
    "g10_deletions",
    with_ctes(
        fx.DATASET_FILES,
        select="""SELECT file_id, file_name FROM dataset_files
          WHERE file_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    ),
)
def g10_deletions(t: Tables) -> DataFrame:
    """Tombstones of files labelled toxic hide them from later reads."""
    files = fx.dataset_files(t).select(
        "file_id", "file_name", F.lit(1).alias("at"), F.lit(False).alias("deleted")
    )
    toxic = t.labels.filter("toxic = 1").select(F.col("doc_id").alias("file_id"))
    gone = tombstones(files.join(toxic, "file_id", "left_semi"), F.lit(2))
    return current(files.unionByName(gone), ["file_id"], ["at"]).select("file_id", "file_name")


@query(
    "g11_update_entities",
    with_ctes(
        fx.ENTITIES,
        select="""SELECT coalesce(e.id, s.s_suppkey) AS id,
            coalesce('renamed ' || s.s_nationkey, e.name) AS name,
            CASE WHEN s.s_acctbal > 0 THEN 'Ready' ELSE e.status END AS status
          FROM entities e FULL JOIN supplier s ON s.s_suppkey = e.id""",
    ),
)
def g11_update_entities(t: Tables) -> DataFrame:
    """Named fields of an update replace the stored ones, absent fields stay, new keys are
    created."""
    updates = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("renamed "), F.col("s_nationkey").cast("string")).alias("name"),
        F.when(F.col("s_acctbal") > 0, "Ready").alias("status"),
    )
    return upsert(fx.entities(t), updates, "id").select("id", "name", "status")


@query(
    "g12_active_entities",
    with_ctes(
        fx.ENTITIES,
        select="""SELECT id AS entity_id, name, display_name, status, active_model_id,
            last_modified AS last_modified_date, file_source, created_by AS created_by_user_id
          FROM entities WHERE status = 'Ready'""",
    ),
)
def g12_active_entities(t: Tables) -> DataFrame:
    """Entities in use with their public fields."""
    return summarize_entity(fx.entities(t).filter("status = 'Ready'"), details=True)


@query(
    "g14_entities_of_datasets",
    """WITH bridge AS (
         SELECT l_suppkey AS entity_id, 'set ' || l_linenumber AS dataset_id, l_shipdate AS "at",
           l_orderkey * 1000 + l_partkey AS event_id, l_returnflag <> 'R' AS active FROM lineitem),
       last AS (SELECT *, row_number() OVER (PARTITION BY entity_id, dataset_id
                  ORDER BY "at" DESC, event_id DESC) AS rn FROM bridge)
       SELECT entity_id, dataset_id FROM last WHERE rn = 1 AND active""",
)
def g14_entities_of_datasets(t: Tables) -> DataFrame:
    """Entities switched on for datasets by their latest attach or detach event."""
    bridge = t.lineitem.select(
        F.col("l_suppkey").alias("entity_id"),
        F.concat(F.lit("set "), F.col("l_linenumber").cast("string")).alias("dataset_id"),
        F.col("l_shipdate").alias("at"),
        (F.col("l_orderkey") * 1000 + F.col("l_partkey")).alias("event_id"),
        (F.col("l_returnflag") != "R").alias("active"),
    )
    return active_entities_by_dataset(bridge)


@query(
    "g15_version_summaries",
    with_ctes(
        fx.ENTITY_VERSIONS,
        select="""SELECT entity_id, count(*) AS versions,
            count(*) FILTER (status = 'Ready') AS ready,
            count(DISTINCT guidelines) AS guideline_texts
          FROM entity_versions GROUP BY entity_id""",
    ),
)
def g15_version_summaries(t: Tables) -> DataFrame:
    """Derived counts of the versions of each entity."""
    return fx.entity_versions(t).groupBy("entity_id").agg(
        F.count("*").alias("versions"),
        F.count_if(F.col("status") == "Ready").alias("ready"),
        F.countDistinct("guidelines").alias("guideline_texts"),
    )


@query(
    "g16_envelopes",
    """SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE 2 END AS records,
         CASE o_orderkey % 5 WHEN 0 THEN 2 WHEN 1 THEN o_custkey WHEN 2 THEN 2 WHEN 3 THEN o_custkey + 1
           END AS total,
         CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_custkey END AS first_id,
         CASE WHEN o_orderkey % 5 = 1 THEN 7 END AS "offset",
         CASE WHEN o_orderkey % 5 = 4 THEN 'Unexpected response shape' END AS error
       FROM orders""",
)
def g16_envelopes(t: Tables) -> DataFrame:
    """Pages in every accepted shape, and one in none."""
    key, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    items = F.concat(F.lit('[{"id": '), c, F.lit(', "name": "a"}, {"id": 2, "name": "b"}]'))
    page = (
        F.when(key % 5 == 0, items)
        .when(key % 5 == 1, F.concat(
            F.lit('{"totalRecords": '), c, F.lit(', "offset": 7, "records": '), items, F.lit("}")))
        .when(key % 5 == 2, F.concat(F.lit('{"entities": '), items, F.lit("}")))
        .when(key % 5 == 3, F.concat(
            F.lit('{"count": '), (F.col("o_custkey") + 1).cast("string"),
            F.lit(', "items": '), items, F.lit("}")))
        .otherwise(F.lit('{"rows": []}'))
    )
    pages = t.orders.select(key.alias("id"), page.alias("page"))
    done = unwrap_page(
        pages, "page", "struct<id:bigint,name:string>",
        ["records", "entities", "items", "customEntities"], ["totalRecords", "total", "count"],
        {"offset": "bigint"},
    )
    return done.select(
        "id", F.size("records").alias("records"), "total",
        F.get("records", F.lit(0))["id"].alias("first_id"), "offset", "error",
    )


@query(
    "w1_latest_row",
    with_ctes(
        fx.ENTITY_VERSIONS,
        select="""SELECT entity_id, id, version_number FROM (
            SELECT *, row_number() OVER (PARTITION BY entity_id
              ORDER BY version_number DESC, seq DESC, id DESC) AS rn FROM entity_versions) x
          WHERE rn = 1""",
    ),
)
def w1_latest_row(t: Tables) -> DataFrame:
    """Latest version per entity under a total order."""
    return latest_per_key(
        fx.entity_versions(t), ["entity_id"], [F.col(c) for c in ("version_number", "seq", "id")]
    ).select("entity_id", "id", "version_number")


@query(
    "s8_snapshots",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
         AND event_type <> 'error'""",
)
def s8_snapshots(t: Tables) -> DataFrame:
    """State from a sorted snapshot and the batches after it."""
    events = t.events.select(
        "user_id", "event_id", "event_type", "value", "ts",
        (F.col("event_type") == "error").alias("deleted"),
    )
    registry = SnapshotRegistry(
        f"{scratch(t.spark, 'registry')}/users", events.schema, ["user_id"], ["ts", "event_id"]
    )
    # Batches by a hash: later batches bring older events, too.
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for batch in range(4):
        registry.append(events.filter(part == batch), batch)
        if batch in (0, 2):
            registry.compact(t.spark)
    return registry.current(t.spark).select("user_id", "event_id", "event_type", "value")
