"""Tables derived from the given ones by formula, in Spark and, independently, in SQL.

Nothing is sampled or cut: every row and every whole text of a source table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.queries.base import Tables

DOC_LABELS = ("EMAIL_ADDRESS", "PHONE_NUMBER", "IP_ADDRESS", "CREDIT_CARD", "SECRET_TOKEN")


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _lp(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def notes(t: Tables) -> DataFrame:
    """One note per order that mentions every kind of pattern, some nested in others."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(
        F.lit("Order "), _s(k), F.lit(" on "), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit(", ssn "), _lp(c % 1000, 3), F.lit("-"), _lp(k % 100, 2), F.lit("-"),
        _lp(k % 10000, 4),
        F.lit("; call ("), _s(c % 700 + 200), F.lit(") 555-"), _lp(k % 10000, 4),
        F.lit(", see https://shop.example.com/u"), _s(c), F.lit("@host"), _s(c % 9),
        F.lit(".example.org/10.0."), _s(k % 256), F.lit("."), _s(c % 256), F.lit("?id="), _s(k),
        F.lit(" mac aa:bb:"), _lp(k % 100, 2), F.lit(":"), _lp(c % 100, 2), F.lit(":00:ff"),
        F.lit(" iban DE"), _lp(k % 100, 2), _lp(c, 18),
        F.lit(" card "), _lp(k * 12345677 + 4000000000000000, 16),
        F.lit(" id "), _lp(k, 8), F.lit("-"), _lp(c % 10000, 4), F.lit("-4000-8000-"), _lp(k, 12),
        F.lit(" mail User."), _s(c), F.lit("@Mail.example.comé "), F.col("o_orderpriority"),
    )
    return t.orders.select(k.alias("id"), text.alias("note"), c.alias("custkey"))


NOTES = """notes AS (
  SELECT o_orderkey AS id, o_custkey AS custkey,
    'Order ' || o_orderkey || ' on ' || strftime(o_orderdate, '%Y-%m-%d')
    || ', ssn ' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') || '-'
    || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '-' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0')
    || '; call (' || (o_custkey % 700 + 200) || ') 555-' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0')
    || ', see https://shop.example.com/u' || o_custkey || '@host' || (o_custkey % 9)
    || '.example.org/10.0.' || (o_orderkey % 256) || '.' || (o_custkey % 256) || '?id=' || o_orderkey
    || ' mac aa:bb:' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || ':'
    || lpad((o_custkey % 100)::VARCHAR, 2, '0') || ':00:ff'
    || ' iban DE' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || lpad(o_custkey::VARCHAR, 18, '0')
    || ' card ' || lpad((o_orderkey * 12345677 + 4000000000000000)::VARCHAR, 16, '0')
    || ' id ' || lpad(o_orderkey::VARCHAR, 8, '0') || '-' || lpad((o_custkey % 10000)::VARCHAR, 4, '0')
    || '-4000-8000-' || lpad(o_orderkey::VARCHAR, 12, '0')
    || ' mail User.' || o_custkey || '@Mail.example.comé ' || o_orderpriority AS note
  FROM orders)""".replace("\\u00e9", "é")


def jobs(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "Running")
        .otherwise("Failed")
    )
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("f"), _s("o_orderkey"), F.lit(".txt")).alias("file_name"),
        status.alias("status"),
        F.when(
            F.col("o_orderstatus") == "P",
            F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).otherwise(""),
        ).alias("error_messages"),
        F.col("o_orderdate").cast("timestamp").alias("published_time"),
        F.lit("Text").alias("job_type"),
    )


JOBS = """jobs AS (
  SELECT o_orderkey AS id, 'f' || o_orderkey || '.txt' AS file_name,
    CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Running' ELSE 'Failed' END AS status,
    CASE WHEN o_orderstatus = 'P' THEN
      CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority ELSE '' END END AS error_messages,
    o_orderdate AS published_time, 'Text' AS job_type
  FROM orders)"""


def datasets(t: Tables) -> DataFrame:
    """One dataset per source of documents and an empty one per language."""
    named = t.documents.select(F.col("source").alias("id")).distinct()
    empty = t.documents.select(F.concat(F.lit("empty_"), F.col("lang")).alias("id")).distinct()
    return named.unionByName(empty).select("id", F.concat(F.lit("set "), "id").alias("name"))


DATASETS = """datasets AS (
  SELECT id, 'set ' || id AS name FROM (
    SELECT DISTINCT source AS id FROM documents
    UNION ALL SELECT DISTINCT 'empty_' || lang FROM documents) x)"""

FILE_STATES = ("Completed", "Queued", "Failed")


def dataset_files(t: Tables) -> DataFrame:
    status = F.element_at(
        F.array(*[F.lit(s) for s in FILE_STATES]), (F.col("doc_id") % 3 + 1).cast("int")
    )
    return t.documents.select(
        F.col("source").alias("dataset_id"),
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("d"), _s("doc_id"), F.lit(".txt")).alias("file_name"),
        F.size(F.split("text", "\n")).cast("long").alias("num_rows"),
        status.alias("processing_status"),
    )


DATASET_FILES = """dataset_files AS (
  SELECT source AS dataset_id, doc_id AS file_id, 'd' || doc_id || '.txt' AS file_name,
    len(string_split(text, chr(10))) AS num_rows,
    (['Completed', 'Queued', 'Failed'])[doc_id % 3 + 1] AS processing_status
  FROM documents)"""

STATUSES = ("TestDataSetup", "GuidelinesRefinement", "PreTraining", "Training", "Ready")
SOURCES = ("Local", "S3", "Azure", "GoogleCloud")


def entity_events(t: Tables) -> DataFrame:
    """Created at 1; large parts renamed at 2; discontinued sizes deleted at 3."""
    key = F.col("p_partkey")
    base = t.part.select(
        key.alias("id"),
        F.col("p_name").alias("name"),
        F.upper("p_name").alias("display_name"),
        F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (key % 4 + 1).cast("int")).alias(
            "file_source"
        ),
        F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (key % 5 + 1).cast("int")).alias(
            "status"
        ),
        F.when(key % 5 == 4, F.concat(F.lit("m"), _s(key))).alias("active_model_id"),
        F.col("p_brand").alias("created_by"),
        F.col("p_retailprice").alias("last_modified"),
        F.col("p_size").alias("size"),
        F.lit(1).alias("at"),
        F.lit(False).alias("deleted"),
    )
    renamed = base.filter("size > 30").withColumn(
        "name", F.concat(F.lit("big "), "name")
    ).withColumn("at", F.lit(2))
    deleted = base.filter("size BETWEEN 10 AND 14").withColumn("at", F.lit(3)).withColumn(
        "deleted", F.lit(True)
    )
    return base.unionByName(renamed).unionByName(deleted)


ENTITY_EVENTS = """base_entities AS (
  SELECT p_partkey AS id, p_name AS name, upper(p_name) AS display_name,
    (['Local', 'S3', 'Azure', 'GoogleCloud'])[p_partkey % 4 + 1] AS file_source,
    (['TestDataSetup', 'GuidelinesRefinement', 'PreTraining', 'Training', 'Ready'])[p_partkey % 5 + 1]
      AS status,
    CASE WHEN p_partkey % 5 = 4 THEN 'm' || p_partkey END AS active_model_id,
    p_brand AS created_by, p_retailprice AS last_modified, p_size AS size, 1 AS "at",
    false AS deleted
  FROM part),
entity_events AS (
  SELECT * FROM base_entities
  UNION ALL SELECT id, 'big ' || name, display_name, file_source, status, active_model_id,
    created_by, last_modified, size, 2, deleted FROM base_entities WHERE size > 30
  UNION ALL SELECT id, name, display_name, file_source, status, active_model_id,
    created_by, last_modified, size, 3, true FROM base_entities WHERE size BETWEEN 10 AND 14)"""

# Live entities: the latest event per id, tombstones left out.
ENTITIES = ENTITY_EVENTS + """,
entities AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY "at" DESC) AS rn FROM entity_events) x
  WHERE rn = 1 AND NOT deleted)"""


def entities(t: Tables) -> DataFrame:
    from maskwright.operators.registry import current

    return current(entity_events(t), ["id"], ["at"])


def entity_versions(t: Tables) -> DataFrame:
    """Versions of entities; equal version numbers occur and are told apart by ``seq``."""
    row = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_extendedprice").cast("decimal(18,2)"),
    )
    return t.lineitem.select(
        F.sha2(row, 256).alias("id"),
        F.col("l_orderkey").alias("entity_id"),
        F.col("l_linenumber").alias("version_number"),
        F.concat(F.lit("rule "), _s("l_partkey")).alias("guidelines"),
        F.when(F.col("l_returnflag") == "A", "Ready")
        .when(F.col("l_returnflag") == "R", "Failed")
        .otherwise("Annotating").alias("status"),
        F.col("l_extendedprice").alias("seq"),
    )


ENTITY_VERSIONS = """entity_versions AS (
  SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      strftime(l_shipdate, '%Y-%m-%d'), l_extendedprice::DECIMAL(18,2))) AS id,
    l_orderkey AS entity_id, l_linenumber AS version_number, 'rule ' || l_partkey AS guidelines,
    CASE l_returnflag WHEN 'A' THEN 'Ready' WHEN 'R' THEN 'Failed' ELSE 'Annotating' END AS status,
    l_extendedprice AS seq
  FROM lineitem)"""

PATH_EXTENSIONS = (
    ".txt", ".json", ".html", ".htm", ".xml", ".csv", ".pdf", ".log", ".TXT", "",
)


def file_tree(t: Tables) -> DataFrame:
    """The tree of the crawled pages: host / language / a file named after a mailbox."""
    host = F.regexp_extract("url", r"^https?://([^/]*)", 1)
    lang = F.regexp_extract("url", r"^https?://[^/]*/([a-z]+)", 1)
    ext = F.element_at(
        F.array(*[F.lit(e) for e in PATH_EXTENSIONS]), (F.col("page_id") % 10 + 1).cast("int")
    )
    name = F.concat(F.lit("user"), _s("page_id"), F.lit("@mail.example.com "), F.lit("x"), ext)
    return t.pages.select(
        "page_id", F.concat_ws("/", host, lang, name).alias("path"),
        F.length("html").cast("long").alias("size"), "url",
    )


FILE_TREE = """file_tree AS (
  SELECT page_id,
    regexp_extract(url, '^https?://([^/]*)', 1) || '/' || regexp_extract(url, '^https?://[^/]*/([a-z]+)', 1)
    || '/user' || page_id || '@mail.example.com x'
    || (['.txt', '.json', '.html', '.htm', '.xml', '.csv', '.pdf', '.log', '.TXT', ''])[page_id % 10 + 1]
    AS path, length(html) AS size, url
  FROM pages)"""


def json_docs(t: Tables, broken: bool = False) -> DataFrame:
    """One JSON text per document, built by concatenation."""
    body = F.col("text")
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(escaped))
    close = F.lit("}")
    if broken:
        close = F.when(F.col("lang") == "fr", "").otherwise("}")
    return t.documents.select(
        F.col("doc_id").alias("id"),
        F.concat(
            F.lit('{"id": "d'), _s("doc_id"), F.lit('@id.example.com", "name": {"first":"'),
            F.col("lang"), F.lit('","last":"'), F.col("source"), F.lit('"}, "n": '),
            _s("n_chars"), F.lit('.50,\n "notes":["'), body, F.lit('", '), _s("n_chars"),
            F.lit(', true, null], "meta":{"ts":"10.1.2.3","by":"10.1.2.4"}'), close,
        ).alias("json"),
    )


_JSON_BODY = (
    r"""replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), """
    r"""chr(13), '\r'), chr(9), '\t')"""
)


def sql_json(id_value: str, first: str, last: str, body: str, ts: str, by: str, close: str) -> str:
    """The JSON text of a document from its parts (SQL expressions)."""
    return (
        f"""'{{"id": "' || {id_value} || '", "name": {{"first":"' || {first} || '","last":"' """
        f"""|| {last} || '"}}, "n": ' || n_chars || '.50,' || chr(10) || ' "notes":["' || {body} """
        f"""|| '", ' || n_chars || ', true, null], "meta":{{"ts":"' || {ts} || '","by":"' """
        f"""|| {by} || '"}}' || {close}"""
    )


JSON_BODY = _JSON_BODY


def xml_docs(t: Tables) -> DataFrame:
    """One XML text per customer with its largest order note."""
    name = F.col("c_name")
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.concat(
            F.lit('<?xml version="1.0"?>\n<c id="'), _s("c_custkey"), F.lit('" mail="u'),
            _s("c_custkey"), F.lit('@example.com"><n>'), name, F.lit(" &amp; co</n><!-- 10.0.0.1 --><t a='10.9."),
            _s(F.col("c_custkey") % 256), F.lit(".1'>host 10.8."), _s(F.col("c_custkey") % 256),
            F.lit(".2 &lt;"), F.col("c_mktsegment"), F.lit("&gt;</t><t><![CDATA[<10.7."),
            _s(F.col("c_custkey") % 256), F.lit(".3>]]></t><e/></c>"),
        ).alias("xml"),
    )
