"""File trees (S1, S2, S5, F1-F9) and the path functions they use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.functions.text import (
    base_name,
    clip,
    clip_array,
    dir_name,
    duration_clock,
    duration_seconds,
    error_message,
    extension,
    media_type,
    normalize_duration,
    relative_path,
)
from maskwright.operators.policy import RedactOptions
from maskwright.plans.folder import (
    FolderOptions,
    deidentify_folder,
    directories,
    distinct_names,
    in_extensions,
    inventory_totals,
    plan_work,
    redact_routes,
    route_of,
    skipped_at,
    skipped_results,
    summarize,
    with_outputs,
)
from maskwright.operators.sizing import spread
from maskwright.queries import fixtures as fx
from maskwright.queries.base import (
    KEY,
    REDACTED,
    Tables,
    query,
    sql_candidates,
    sql_generator,
    sql_rebuilt,
    sql_resolved,
    sql_shifted,
    with_ctes,
)
from maskwright.sources.files import list_tree, read_whole, write_tree
from maskwright.streaming.streams import scratch

SKIP = ("/fr/", "*.log", "node_modules")


def _document_tree(t: Tables) -> str:
    """A tree with one file per document below a folder per source."""
    path = f"{scratch(t.spark, 'tree')}/files"
    write_tree(spread(t.documents.select("doc_id", "source", "text")).select(
        F.concat("source", F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".txt"))
        .alias("output_path"),
        F.coalesce("text", F.lit("")).alias("redacted_text"),
    ), path)
    return path


_DOCUMENT_PATH = "source || '/d' || doc_id || '.txt'"


@query(
    "s1_inventory",
    f"""SELECT {_DOCUMENT_PATH} AS path, strlen(coalesce(text, ''))::BIGINT AS size, '.txt' AS ext,
         1 AS depth, 'text/plain' AS type FROM documents""",
)
def s1_inventory(t: Tables) -> DataFrame:
    """The tree of all documents, listed from metadata only."""
    return list_tree(t.spark, _document_tree(t)).select("path", "size", "ext", "depth", "type")


@query(
    "s5_written_tree",
    f"SELECT {_DOCUMENT_PATH} AS path, coalesce(text, '') AS text FROM documents",
)
def s5_written_tree(t: Tables) -> DataFrame:
    """A tree written file by file, and read back whole."""
    return read_whole(t.spark, _document_tree(t))


@query(
    "f10_folder_job",
    with_ctes(
        sql_candidates("documents", "doc_id", "text"), sql_resolved(), sql_shifted(REDACTED),
        sql_rebuilt("(SELECT doc_id, coalesce(text, '') AS text FROM documents)", "doc_id", "text"),
        select=f"""SELECT {_DOCUMENT_PATH} AS path,
            source || '/d' || doc_id || '.txt' AS output_path, r.redacted_text, r.entities_found
          FROM documents d JOIN rebuilt r ON r.k = d.doc_id""",
    ),
)
def f10_folder_job(t: Tables) -> DataFrame:
    """The whole folder job over the tree of all documents."""
    job = deidentify_folder(t.spark, _document_tree(t), RedactOptions(key=KEY))
    return job.outputs.select(
        "path", "output_path", "redacted_text", "entities_found"
    )


@query(
    "s2_read_whole_files",
    "SELECT source, sum(n_chars + 1)::BIGINT AS chars FROM documents GROUP BY source",
)
def s2_read_whole_files(t: Tables) -> DataFrame:
    """Texts written as files below one folder per source and read back whole."""
    path = f"{scratch(t.spark, 'tree')}/files"
    t.documents.select("source", "text").write.partitionBy("source").text(path)
    files = read_whole(t.spark, path).filter(F.endswith("path", F.lit(".txt")))
    return files.groupBy(
        F.regexp_extract("path", "^source=([^/]*)/", 1).alias("source")
    ).agg(F.sum(F.length("text")).alias("chars"))


_DIRS = """dirs AS (
  SELECT DISTINCT d FROM (
    SELECT regexp_extract(path, '^([^/]*/)', 1) AS d FROM file_tree
    UNION ALL SELECT regexp_extract(path, '^([^/]*/[^/]*/)', 1) FROM file_tree) x)"""


@query(
    "f1_inventory_totals",
    with_ctes(
        fx.FILE_TREE, _DIRS,
        select="""SELECT (SELECT count(*) FROM file_tree) AS total_files,
          (SELECT count(*) FROM dirs) AS total_directories,
          (SELECT sum(size)::BIGINT FROM file_tree) AS total_size_bytes""",
    ),
)
def f1_inventory_totals(t: Tables) -> DataFrame:
    """F1 A1: files, directories and bytes of a tree."""
    return inventory_totals(fx.file_tree(t))


@query("f1_directories", with_ctes(fx.FILE_TREE, _DIRS, select="SELECT d AS directory FROM dirs"))
def f1_directories(t: Tables) -> DataFrame:
    """All directories of a tree."""
    return directories(fx.file_tree(t))


_SKIPPED = """skipped AS (
  SELECT path, CASE
    WHEN contains(split_part(path, '/', 1), '/fr/') OR contains(split_part(path, '/', 1), 'node_modules')
      OR suffix(split_part(path, '/', 1), '.log') THEN split_part(path, '/', 1)
    WHEN contains(split_part(path, '/', 1) || '/' || split_part(path, '/', 2), '/fr/')
      OR suffix(split_part(path, '/', 2), '.log')
      THEN split_part(path, '/', 1) || '/' || split_part(path, '/', 2)
    WHEN contains(path, '/fr/') OR suffix(path, '.log') OR contains(path, 'node_modules') THEN path
    END AS skipped_at FROM file_tree)"""


@query(
    "f2_skip_rule",
    with_ctes(fx.FILE_TREE, _SKIPPED, select="SELECT path, skipped_at FROM skipped"),
)
def f2_skip_rule(t: Tables) -> DataFrame:
    """F2 P5: the topmost ancestor that a pattern skips."""
    return fx.file_tree(t).select("path", skipped_at(F.col("path"), SKIP).alias("skipped_at"))


@query(
    "f2_skipped_host",
    with_ctes(
        fx.FILE_TREE,
        select="""SELECT DISTINCT CASE WHEN contains(split_part(path, '/', 1), 'example.net')
              THEN split_part(path, '/', 1) ELSE path END AS source,
            '' AS output, 'skipped' AS status, 'Matched skip pattern' AS error
          FROM file_tree WHERE contains(path, 'example.net')""",
    ),
)
def f2_skipped_host(t: Tables) -> DataFrame:
    """F2 F8: a skipped directory is one result for its whole subtree."""
    work = plan_work(fx.file_tree(t), folder=FolderOptions(skip_patterns=["example.net"]))
    return skipped_results(work.filter("skipped_at IS NOT NULL"))


@query(
    "f3_extension_filter",
    with_ctes(
        fx.FILE_TREE,
        select="""SELECT path FROM file_tree
          WHERE lower(regexp_extract(path, '.(\\.[^./]*)$', 1)) IN ('.txt', '.json')""",
    ),
)
def f3_extension_filter(t: Tables) -> DataFrame:
    """Extensions are compared without case."""
    tree = fx.file_tree(t)
    return tree.filter(in_extensions(base_name(F.col("path")), [".TXT", ".json"])).select("path")


@query(
    "f4_paths",
    with_ctes(
        fx.FILE_TREE,
        select="""SELECT path, split_part(path, '/', 3) AS name,
            split_part(path, '/', 1) || '/' || split_part(path, '/', 2) AS folder,
            (['.txt', '.json', '.html', '.htm', '.xml', '.csv', '.pdf', '.log', '.TXT',
              '.com x'])[page_id % 10 + 1] AS ext,
            split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS below_host,
            (['text/plain', 'application/json', 'text/html', 'text/html', 'application/xml',
              'text/csv', 'application/pdf', 'text/plain', 'text/plain', 'unknown'])[page_id % 10 + 1]
              AS type
          FROM file_tree""",
    ),
)
def f4_paths(t: Tables) -> DataFrame:
    """Name, folder, extension, relative path and media type."""
    path = F.col("path")
    return fx.file_tree(t).select(
        "path",
        base_name(path).alias("name"),
        dir_name(path).alias("folder"),
        extension(base_name(path)).alias("ext"),
        relative_path(path, F.split(path, "/")[0]).alias("below_host"),
        media_type(base_name(path)).alias("type"),
    )


@query(
    "f5_routes",
    with_ctes(
        fx.FILE_TREE,
        select="""SELECT route, count(*) AS files FROM (
            SELECT (['text', 'json', 'html', 'html', 'xml', 'csv', 'binary', NULL, 'text', NULL]
              )[page_id % 10 + 1] AS route FROM file_tree) x GROUP BY route""",
    ),
)
def f5_routes(t: Tables) -> DataFrame:
    """files per route; unsupported types have none."""
    return fx.file_tree(t).groupBy(route_of(base_name(F.col("path"))).alias("route")).agg(
        F.count("*").alias("files")
    )


def _contents(t: Tables) -> DataFrame:
    """A small text per page, wrapped in the format of its extension."""
    ext = F.lower(extension(base_name(F.col("path"))))
    value = F.concat(
        F.lit("id "), F.col("page_id").cast("string"), F.lit(" of "), F.length("html").cast("string"),
        F.lit(" mail u"), F.col("page_id").cast("string"), F.lit("@example.com"),
    )
    tree = fx.file_tree(t).join(t.pages.select("page_id", "html"), "page_id")

    def wrap(before: str, after: str):
        return F.concat(F.lit(before), value, F.lit(after))

    return tree.select(
        "page_id", "path",
        F.when(ext == ".json", wrap('{"a": "', '"}'))
        .when(ext.isin(".html", ".htm"), wrap("<p title='a@b.com'>", "</p>"))
        .when(ext == ".xml", wrap("<x a='1.2.3.4'>", "</x>"))
        .when(ext == ".csv", wrap("a@b.com,h\n1,", ",z\n"))
        .otherwise(value)
        .alias("text"),
    )


_VALUE = "'id ' || p.page_id || ' of ' || length(p.html) || ' mail [EMAIL_ADDRESS]'"


@query(
    "f6_dispatch",
    with_ctes(
        fx.FILE_TREE,
        select=f"""SELECT f.path,
            CASE f.page_id % 10
              WHEN 1 THEN '{{"a": "' || {_VALUE} || '"}}'
              WHEN 2 THEN '<p title=''a@b.com''>' || {_VALUE} || '</p>'
              WHEN 3 THEN '<p title=''a@b.com''>' || {_VALUE} || '</p>'
              WHEN 4 THEN '<x a=''[IP_ADDRESS]''>' || {_VALUE} || '</x>'
              WHEN 5 THEN 'a@b.com,h' || chr(10) || '1,' || {_VALUE} || ',z' || chr(10)
              ELSE {_VALUE} END AS redacted_text, 'success' AS status
          FROM file_tree f JOIN pages p ON p.page_id = f.page_id
          WHERE f.page_id % 10 NOT IN (6, 7, 9)""",
    ),
)
def f6_dispatch(t: Tables) -> DataFrame:
    """Every content is redacted by the operator of its route."""
    return redact_routes(_contents(t)).select("path", "redacted_text", "status")


@query(
    "f7_names",
    with_ctes(
        fx.FILE_TREE,
        """names AS (
          SELECT DISTINCT unnest(string_split(path, '/')) AS name FROM file_tree)""",
        # without a dot after the blank, ".com x" is the extension and stays
        """parts AS (SELECT name, regexp_extract(name, CASE WHEN suffix(name, '.com x')
            THEN '[a-z0-9]+@mail\\.example' ELSE '[a-z0-9]+@mail\\.example\\.com' END, 0) AS mail
          FROM names)""",
        select=f"""SELECT name, CASE WHEN mail = '' THEN name
            ELSE replace(name, mail, {sql_generator('Email', "'EMAIL_ADDRESS'", 'mail')})
            END AS new_name FROM parts""",
    ),
)
def f7_names(t: Tables) -> DataFrame:
    """Every distinct folder and file name once, base name only, Synthesis by default."""
    return distinct_names(fx.file_tree(t), RedactOptions(key=KEY))


_OUTPUTS = """kept AS (
  SELECT path, split_part(path, '/', 1) || '/' || split_part(path, '/', 2) AS folder,
    (['.txt', '.json', '.html', '.htm', '.xml', '.csv', '.pdf', '.log', '.TXT', ''])[page_id % 10 + 1]
      AS ext, page_id
  FROM file_tree WHERE page_id % 10 NOT IN (6, 7, 9)),
outputs AS (
  SELECT path, folder || '/[EMAIL_ADDRESS] x'
      || CASE WHEN n > 1 THEN '~' || n ELSE '' END || ext AS output_path
  FROM (SELECT *, row_number() OVER (PARTITION BY folder, ext ORDER BY path) AS n FROM kept) x)"""


@query(
    "f7_output_paths",
    with_ctes(fx.FILE_TREE, _OUTPUTS, select="SELECT path, output_path FROM outputs"),
)
def f7_output_paths(t: Tables) -> DataFrame:
    """Names that become equal are told apart in the order of their sources."""
    work = plan_work(
        fx.file_tree(t), RedactOptions(generator_default="Redaction", key=KEY),
        FolderOptions(deidentify_names=True),
    )
    return with_outputs(work).select("path", "output_path")


_RESULTS = """results AS (
  SELECT DISTINCT coalesce(s.skipped_at, f.path) AS source,
    CASE WHEN s.skipped_at IS NOT NULL THEN 'skipped'
         WHEN f.page_id % 10 IN (6, 7, 9) THEN 'skipped' ELSE 'success' END AS status,
    CASE WHEN s.skipped_at IS NOT NULL THEN 'Matched skip pattern'
         WHEN f.page_id % 10 = 6 THEN 'Binary format without a text reader'
         WHEN f.page_id % 10 IN (7, 9) THEN 'Unsupported file type' END AS error,
    CASE WHEN s.skipped_at IS NULL AND f.page_id % 10 NOT IN (6, 7, 9) THEN f.path ELSE '' END AS output
  FROM file_tree f JOIN skipped s ON s.path = f.path)"""


def _results(t: Tables) -> DataFrame:
    folder = FolderOptions(skip_patterns=SKIP)
    work = plan_work(fx.file_tree(t), folder=folder)
    contents = _contents(t).filter(skipped_at(F.col("path"), SKIP).isNull())
    done = redact_routes(contents, folder=folder).select(
        F.col("path").alias("source"), F.col("path").alias("output"), "status", "error"
    )
    return done.unionByName(skipped_results(work))


@query(
    "f8_results",
    with_ctes(
        fx.FILE_TREE, _SKIPPED, _RESULTS, select="SELECT source, output, status, error FROM results"
    ),
)
def f8_results(t: Tables) -> DataFrame:
    """One outcome per file, one per skipped directory."""
    return _results(t)


@query(
    "f9_summary",
    with_ctes(
        fx.FILE_TREE, _SKIPPED, _RESULTS,
        select="""SELECT count(*) FILTER (status <> 'skipped') AS total_files,
            count(*) AS total_processed, count(*) FILTER (status = 'success') AS succeeded,
            count(*) FILTER (status = 'error') AS failed,
            count(*) FILTER (status = 'skipped') AS skipped FROM results""",
    ),
)
def f9_summary(t: Tables) -> DataFrame:
    """Outcome counts of the job."""
    return summarize(_results(t))


@query(
    "x1_durations",
    """SELECT o_orderkey AS id, (o_orderkey * 97 + o_custkey) || u AS raw,
         CASE u WHEN 's' THEN 1 WHEN ' M' THEN 60 WHEN 'h' THEN 3600 ELSE 86400 END
           * (o_orderkey * 97 + o_custkey) AS seconds
       FROM orders, (SELECT unnest(['s', ' M', 'h', 'D']) AS u) v""",
)
def x1_durations(t: Tables) -> DataFrame:
    """Durations such as ``30m`` or ``7d`` read as seconds."""
    units = F.array(*[F.lit(u) for u in ("s", " M", "h", "D")])
    raw = t.orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") * 97 + F.col("o_custkey")).alias("n"),
        F.explode(units).alias("u"),
    ).select("id", F.concat(F.col("n").cast("string"), "u").alias("raw"))
    return raw.select("id", "raw", duration_seconds(F.col("raw")).alias("seconds"))


@query(
    "x2_clock_text",
    """SELECT o_orderkey AS id, CASE WHEN s >= 86400 THEN (s // 86400) || '.' ELSE '' END
         || lpad((s % 86400 // 3600)::VARCHAR, 2, '0') || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0')
         || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS clock,
         o_orderpriority AS passed
       FROM (SELECT *, o_orderkey * 97 + o_custkey AS s FROM orders) x""",
)
def x2_clock_text(t: Tables) -> DataFrame:
    """Seconds as ``[d.]HH:mm:ss``; text that is no duration passes through."""
    seconds = F.col("o_orderkey") * 97 + F.col("o_custkey")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        duration_clock(seconds).alias("clock"),
        normalize_duration(F.col("o_orderpriority")).alias("passed"),
    )


@query(
    "x7_clip",
    """SELECT doc_id, CASE WHEN length(text) > 1000
         THEN substr(text, 1, 1000) || '... (' || length(text) || ' chars)' ELSE text END AS clipped,
         '[Array(' || len(string_split(text, ' ')) || ')]' AS words
       FROM documents""",
)
def x7_clip(t: Tables) -> DataFrame:
    """Long arguments shortened for the audit table, arrays shown by size."""
    return t.documents.select(
        "doc_id", clip(F.col("text")).alias("clipped"),
        clip_array(F.split("text", " ")).alias("words"),
    )


@query(
    "x9_error_messages",
    """SELECT o_orderkey AS id, CASE o_orderstatus
         WHEN 'F' THEN o_orderpriority WHEN 'O' THEN 'detail ' || o_custkey ELSE 'plain text' END
         AS message FROM orders""",
)
def x9_error_messages(t: Tables) -> DataFrame:
    """First non-empty of message, detail and title, else the body."""
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    payload = (
        F.when(status == "F", F.concat(
            F.lit('{"message": "'), "o_orderpriority", F.lit('", "detail": "no"}')))
        .when(status == "O", F.concat(
            F.lit('{"message": "", "title": "no", "detail": "detail '), key, F.lit('"}')))
        .otherwise("plain text")
    )
    return t.orders.select(
        F.col("o_orderkey").alias("id"), error_message(payload, payload).alias("message")
    )
