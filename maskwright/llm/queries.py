"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import (
    anchor_tree, ball_tree, byte_bpe, chat, exact_dedup, hash_forest, jaccard, langid, merkle,
    packing, secret_scan, url_filter, warc_zip,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@_query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Power-of-two pieces of all documents, with a checksum of each piece's ids."""
    packed = packing.pack(_table(spark, folder, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )


@_query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents and the bytes they decode to, as digests."""
    decoded = byte_bpe.decode(byte_bpe.encode(_table(spark, folder, "documents")))
    return decoded.select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents, judged by how many sources hold them."""
    kinds = secret_scan.BASE_KINDS
    found = secret_scan.scan(_table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        number = secret_scan.KINDS.index(kind)
        of_kind = F.filter("spans", lambda s: s["kind"] == number)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    base = secret_scan.spans_text(F.col("spans"), kinds).cast("binary")
    return found.select(
        "doc_id", *map(count, kinds), F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_SQL_KINDS = (
    ("assign", "(" + _either_case("password|passwd|secret|token|api_?key") + ")"
     + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    ("forge", "(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9_-]{16,}"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*"
            r"(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
)


def _sql_kind(order: int, name: str, pattern: str) -> str:
    """The matches of one kind: (doc_id, owner, ord, kind, start, end, value)."""
    p = pattern.replace("'", "''")
    value = f"regexp_extract(m[i], '{p}', 2)" if name == "assign" else "m[i]"
    least = {"assign": 8, "access": 16, "hex": 32}.get(name, 0)
    return f"""SELECT doc_id, owner, {order} AS ord, '{name}' AS kind,
        (list_sum(list_transform(g[1:i], lambda z: length(z)))
          + coalesce(list_sum(list_transform(m[1:i - 1], lambda z: length(z))), 0))::BIGINT AS s,
        length(m[i]) AS n, {value} AS value
      FROM (SELECT doc_id, coalesce(source, chr(0)) AS owner,
          regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g
        FROM documents) x, unnest(range(1, len(m) + 1)) AS u(i) WHERE length({value}) >= {least}"""


ORACLES["op2_secret_scan"] = f"""
WITH found AS ({" UNION ALL ".join(_sql_kind(i, *k) for i, k in enumerate(_SQL_KINDS))}),
vals AS (SELECT value, count(DISTINCT owner) AS owners,
    count(DISTINCT {{'owner': owner, 'id': doc_id}}) AS repositories FROM found GROUP BY value),
chars AS (SELECT value, c, count(*) / length(value) AS p
  FROM (SELECT value, unnest(string_split(value, '')) AS c FROM vals) x WHERE c <> ''
  GROUP BY value, c),
judged AS (
  SELECT v.value, CASE WHEN any_value(owners) > {secret_scan.MAX_OWNERS}
        OR any_value(repositories) > {secret_scan.MAX_REPOSITORIES} THEN 'example'
      WHEN -sum(p * log2(p)) >= 3.0 - 1e-9 AND regexp_matches(v.value, '[0-9]')
        AND NOT regexp_matches(v.value,
          '(?i)example|placeholder|changeme|your_|xxxx|0000000000|1234567890') THEN 'live' END AS kind
  FROM vals v JOIN chars USING (value) GROUP BY v.value),
spans AS (
  SELECT doc_id, ord, kind, s, s + n AS e FROM found
  UNION ALL SELECT DISTINCT f.doc_id, CASE j.kind WHEN 'live' THEN 6 ELSE 7 END, j.kind,
    f.s + f.n - length(f.value), f.s + f.n
  FROM found f JOIN judged j USING (value) WHERE j.kind IS NOT NULL),
told AS (
  SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access,
    count(*) FILTER (ord = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord, e) FILTER (ord < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord, e) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id"""


URL_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
    ("net/es/", "block"), ("net/fr/", "block"),
)
# The list of the query: hosts with one of these words between dots or hyphens, and hosts with a
# page whose html has a SHA-256 that begins so.
LISTED_HOSTS = r"(^|[.-])(spam|casino|pills)([.-]|$)"
LISTED_PAGES = "0"


@_query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every url by the rules, or else by the cascade of a table of listed hosts."""
    pages = _table(spark, folder, "pages")
    host = url_filter.host_of(F.coalesce("url", F.lit("")))
    bad = F.startswith(F.sha2(F.coalesce("html", F.lit("")), 256), F.lit(LISTED_PAGES))
    listed = pages.filter(bad | host.rlike(LISTED_HOSTS)).select(host.alias("key")).distinct()
    return url_filter.filter_urls(pages, listed, URL_RULES)


ORACLES["op3_url_filter"] = """
WITH cut AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, digest,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(site, tail, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting AS (
  SELECT page_id, arg_max(site || tail, length(site || tail)) AS rule,
         arg_max(verdict, length(site || tail)) AS verdict
  FROM parsed JOIN rules
    ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, tail)
  GROUP BY page_id)
SELECT p.page_id, host, path, f.rule,
  coalesce(f.verdict, CASE WHEN host IN (SELECT host FROM parsed WHERE starts_with(digest, '0')
      OR regexp_matches(host, '(^|[.-])(spam|casino|pills)([.-]|$)'))
    THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p LEFT JOIN fitting f ON p.page_id = f.page_id"""


@_query
def op4_ball_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector with all others."""
    return ball_tree.search(_table(spark, folder, "embeddings"))


ORACLES["op4_ball_tree"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 20"""


@_query
def op5_hash_forest(spark: SparkSession, folder: str) -> DataFrame:
    """About the 10 nearest vectors of every 100th."""
    return hash_forest.search(_table(spark, folder, "embeddings"))


@_query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of similar shingle sets."""
    return jaccard.join(_table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 3 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM worded),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM parts a JOIN parts b ON a.shingle = b.shingle
    AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT r.doc_id, any_value(len(s))::BIGINT AS n_shingles, min(other) AS component_id
FROM reached r JOIN sets ON sets.doc_id = r.doc_id GROUP BY r.doc_id"""


@_query
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted, and what is read back from the formatted texts."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", marked), (-7, 1, "assistant", marked)], turns.schema
    )
    return chat.read_back(chat.format_turns(turns.unionByName(own)))


ORACLES["op8_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
long AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(
    text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'
    )) AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(24 + length(role) + escaped)::BIGINT AS formatted_chars
FROM long GROUP BY conv_id"""


@_query
def op9_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records in packages, and the records read back by ranges."""
    archives = warc_zip.write_archives(_table(spark, folder, "pages"))
    return warc_zip.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op9_warc_zip"] = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, k // 4 * 5 + 1, 5))::INTEGER >> (15 - 5 * (k % 4))::INTEGER) & 31) + 1, 1)),
    '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts"""


@_query
def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = _table(spark, folder, "documents")
    prototypes = langid.train_on_folds(docs)
    return langid.predict(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", langid.in_fold("doc_id").alias("held_out"), "lang_pred", "score"
    )


@_query
def op11_anchor_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector, for each of its five positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return anchor_tree.mine(_table(spark, folder, "embeddings"), moved)


ORACLES["op11_anchor_tree"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


def _tampered(text: Column) -> Column:
    """A text with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, proof and root of every document, and the root that a tampered copy leads to."""
    docs = _table(spark, folder, "documents")
    own = merkle.FIELDS
    changed = merkle.leaf([_tampered(F.col(n)) if n == "text" else F.col(n) for n in own])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    listed = merkle.manifest(docs, carry={"claimed": F.when(chosen, changed)})
    folded = merkle.as_hex(merkle.fold(F.coalesce("claimed", "leaf"), F.col("proof")))
    root = merkle.as_hex(F.col("root"))
    return listed.select(
        "doc_id", merkle.as_hex(F.col("leaf")).alias("leaf"),
        merkle.as_hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"),
    )


def _sql_leaf(columns: list[str]) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns]
    return f"sha256({' || '.join(parts)})"


# The CRC-32 of the decimal id, bit by bit.
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""
_SQL_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_levels(name: str, base: str) -> str:
    """All nodes of trees (tree, level, idx, h, n): n is the number of nodes of the level."""
    return f"""{name} AS (
  {base}
  UNION ALL SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 16, n)"""


def _sql_siblings(rows: str, nodes: str, offset: int) -> str:
    """The siblings before and after the node above each row, per level."""
    own = "(l.idx >> (4 * s.level))"
    return f"""SELECT l.k, s.level + {offset} AS lev,
      coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < {own}), '') AS before,
      coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > {own}), '') AS after
    FROM {rows} l JOIN {nodes} s ON s.tree = l.tree AND s.n > 1
      AND s.idx // 16 = (l.idx >> (4 * s.level + 4)) GROUP BY l.k, s.level"""


_OWN = ["doc_id", "source", "lang", "n_chars"]
_BASE = "SELECT tree, 0::BIGINT AS level, idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves"
_TOP = "SELECT '' AS tree, 0::BIGINT AS level, idx, h, count(*) OVER () AS n FROM subroots"
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_sql_leaf([*_OWN, "text"])} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_SQL_CRC} % 5 = 0 THEN {_sql_leaf([*_OWN, _SQL_LOWER])} END AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS k,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
{_sql_levels("nodes", _BASE)},
subroots AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS idx FROM nodes WHERE n = 1),
{_sql_levels("tops", _TOP)},
root AS (SELECT h AS root FROM tops WHERE n = 1),
upper AS (SELECT k, '' AS tree, s.idx FROM leaves l JOIN subroots s ON s.name = l.tree),
steps AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY lev) AS step FROM (
    {_sql_siblings("leaves", "nodes", 0)} UNION ALL {_sql_siblings("upper", "tops", 1000)}) x),
folded AS (
  SELECT k, 0::BIGINT AS step, coalesce(claimed, leaf) AS h FROM leaves
  UNION ALL SELECT f.k, s.step, sha256(s.before || f.h || s.after) FROM folded f
    JOIN steps s ON s.k = f.k AND s.step = f.step + 1),
told AS (
  SELECT k, max(step) AS last, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY k)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.root, sha256(coalesce(t.proof, '')) AS proof_sha256,
  f.h AS folded_root, f.h = r.root AS verified
FROM leaves l JOIN subroots s ON s.name = l.tree CROSS JOIN root r LEFT JOIN told t ON t.k = l.k
JOIN folded f ON f.k = l.k AND f.step = coalesce(t.last, 0)"""


@_query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The row of equal texts that stays, for every document."""
    return exact_dedup.groups(_table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLES["op13_exact_dedup"] = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, h AS text_sha256
FROM digests WINDOW same AS (PARTITION BY h)"""
