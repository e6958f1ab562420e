"""JSON, XML and HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.operators.policy import RedactOptions
from maskwright.operators.sizing import spread
from maskwright.operators.structured import (
    any_path,
    html_token_table,
    json_leaf_table,
    redact_html,
    redact_json,
    redact_xml,
    xml_leaf_table,
)
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

LEAVES = """leaves AS (
  SELECT doc_id AS id, '$.id' AS path, 'd' || doc_id || '@id.example.com' AS value FROM documents
  UNION ALL SELECT doc_id, '$.name.first', lang FROM documents
  UNION ALL SELECT doc_id, '$.name.last', source FROM documents
  UNION ALL SELECT doc_id, '$.notes[0]', text FROM documents
  UNION ALL SELECT doc_id, '$.meta.ts', '10.1.2.3' FROM documents
  UNION ALL SELECT doc_id, '$.meta.by', '10.1.2.4' FROM documents)"""


@query("t1_json_leaves", with_ctes(LEAVES, select="SELECT id, path, value FROM leaves"))
def t1_json_leaves(t: Tables) -> DataFrame:
    """String leaves of JSON texts with their paths; keys and other scalars are not leaves."""
    return json_leaf_table(spread(fx.json_docs(t)), ["id"], "json").select("id", "path", "value")


_TEXT_REDACTED = [
    sql_candidates("documents", "doc_id", "text"), sql_resolved(), sql_shifted(REDACTED),
    sql_rebuilt("documents", "doc_id", "text"),
]
_BODY = fx.JSON_BODY.replace("(text,", "(r.redacted_text,")


@query(
    "t1_redact_json",
    with_ctes(
        *_TEXT_REDACTED,
        select=f"""SELECT d.doc_id AS id, {fx.sql_json("'[EMAIL_ADDRESS]'", "d.lang", "d.source",
            _BODY, "'[IP_ADDRESS]'", "'[IP_ADDRESS]'", "'}'")} AS redacted_text,
            r.entities_found + 3 AS entities_found
          FROM documents d JOIN rebuilt r ON r.k = d.doc_id""",
    ),
)
def t1_redact_json(t: Tables) -> DataFrame:
    """Values are replaced; key order, spacing and number text are kept."""
    return redact_json(spread(fx.json_docs(t)), "json").select(
        "id", "redacted_text", "entities_found"
    )


@query(
    "t2_json_ignore_paths",
    with_ctes(
        LEAVES,
        select="SELECT id, path, value FROM leaves WHERE path NOT IN ('$.id', '$.meta.ts')",
    ),
)
def t2_json_ignore_paths(t: Tables) -> DataFrame:
    """Leaves that stay in scope after the ignore rules."""
    leaves = json_leaf_table(spread(fx.json_docs(t)), ["id"], "json")
    return leaves.filter(~any_path(F.col("path"), ["$.id", "$.meta.ts", "$[*].id.*"])).select(
        "id", "path", "value"
    )


@query(
    "t3_json_path_rules",
    with_ctes(
        *_TEXT_REDACTED,
        select=f"""SELECT d.doc_id AS id, {fx.sql_json("'d' || d.doc_id || '@id.example.com'",
            '(' + sql_generator('Name', "'NAME_GIVEN'", 'd.lang') + ')', "d.source",
            _BODY, "'10.1.2.3'", "'[IP_ADDRESS]'", "'}'")} AS redacted_text
          FROM documents d JOIN rebuilt r ON r.k = d.doc_id""",
    ),
)
def t3_json_path_rules(t: Tables) -> DataFrame:
    """Ignored paths stay, an allow path becomes one span of its label."""
    options = RedactOptions(generator_config={"NAME_GIVEN": "Synthesis"}, key=KEY)
    return redact_json(
        spread(fx.json_docs(t)), "json", options,
        path_allow_lists={"NAME_GIVEN": ["$.name.first", "$.id"]},
        path_ignore=["$.id", "$..ts"],
    ).select("id", "redacted_text")


_C = "c_custkey % 256"


@query(
    "t4_xml_tokens",
    f"""SELECT c_custkey AS id, unnest([
          {{'kind': 'attribute', 'path': '/c[1]/@id', 'value': c_custkey::VARCHAR}},
          {{'kind': 'attribute', 'path': '/c[1]/@mail', 'value': 'u' || c_custkey || '@example.com'}},
          {{'kind': 'text', 'path': '/c[1]/n[1]', 'value': c_name || ' & co'}},
          {{'kind': 'quoted attribute', 'path': '/c[1]/t[1]/@a', 'value': '10.9.' || ({_C}) || '.1'}},
          {{'kind': 'text', 'path': '/c[1]/t[1]',
            'value': 'host 10.8.' || ({_C}) || '.2 <' || c_mktsegment || '>'}},
          {{'kind': 'cdata', 'path': '/c[1]/t[2]', 'value': '<10.7.' || ({_C}) || '.3>'}}],
        recursive := true) FROM customer""",
)
def t4_xml_tokens(t: Tables) -> DataFrame:
    """T4: attribute values, texts and CDATA with their paths; comments are not values."""
    return xml_leaf_table(spread(fx.xml_docs(t)), ["id"], "xml").select(
        "id", "kind", "path", "value"
    )


@query(
    "t4_redact_xml",
    """SELECT c_custkey AS id, '<?xml version="1.0"?>' || chr(10) || '<c id="' || c_custkey
         || '" mail="[EMAIL_ADDRESS]"><n>' || c_name || ' &amp; co</n><!-- 10.0.0.1 -->'
         || '<t a=''[IP_ADDRESS]''>host [IP_ADDRESS] &lt;' || c_mktsegment
         || '&gt;</t><t><![CDATA[<[IP_ADDRESS]>]]></t><e/></c>' AS redacted_text,
         4 AS entities_found FROM customer""",
)
def t4_redact_xml(t: Tables) -> DataFrame:
    """T4: texts and attributes are redacted, markup and comments stay."""
    return redact_xml(spread(fx.xml_docs(t)), "xml").select(
        "id", "redacted_text", "entities_found"
    )


_HTML_TOKENS = r"""tokens AS (
  SELECT page_id, i - 1 AS ord, page_id * 1000000 + i - 1 AS tk, m[i] AS token
  FROM (SELECT page_id, regexp_extract_all(html,
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>|[^<]+|<') AS m
    FROM pages) x, unnest(range(1, len(m) + 1)) AS u(i)),
runs AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(token,
      '&copy;', chr(169)), '&middot;', chr(183)), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&apos;', ''''), '&nbsp;', chr(160)), '&amp;', '&') AS value
  FROM tokens WHERE token[1] <> '<')"""


@query(
    "t5_html_tokens",
    with_ctes(_HTML_TOKENS, select="SELECT page_id, ord::INT AS ord, token, value FROM runs"),
)
def t5_html_tokens(t: Tables) -> DataFrame:
    """T5: text runs of pages, entities decoded; tags, scripts, styles and comments are not text."""
    return html_token_table(spread(t.pages.select("page_id", "html")), ["page_id"], "html")


# References as single characters of their own: texts keep their length, and what is left of
# them after redaction is put back byte by byte.
_STAND_INS = {"&lt;": 0xE010, "&gt;": 0xE011, "&quot;": 0xE012, "&apos;": 0xE013,
              "&nbsp;": 0xE014, "&amp;": 0xE015}
_STOOD_IN, _PUT_BACK = "token", "coalesce(r.redacted_text, t.token)"
for _ref, _point in _STAND_INS.items():
    _STOOD_IN = f"replace({_STOOD_IN}, '{_ref}', chr({_point}))"
    _PUT_BACK = f"replace({_PUT_BACK}, chr({_point}), '{_ref}')"
_TAIL = "<p>&copy; Caf&eacute; bob&#00000064;mail{0}.example.com, amy&commat;mail{0}.example.com " \
        "&quot;5&quot; &lt; 6 &unknown; &amp</p>"


@query(
    "t5_redact_html",
    with_ctes(
        _HTML_TOKENS.replace("runs AS", "decoded AS"),
        f"runs AS (SELECT *, {_STOOD_IN} AS stood_in FROM tokens WHERE token[1] <> '<')",
        sql_candidates("runs", "tk", "stood_in"), sql_resolved(),
        sql_shifted(REDACTED), sql_rebuilt("runs", "tk", "stood_in"),
        select=f"""SELECT t.page_id,
            string_agg({_PUT_BACK}, '' ORDER BY t.ord)
              || '<p>&copy; Caf&eacute; [EMAIL_ADDRESS], [EMAIL_ADDRESS] &quot;5&quot; &lt; 6 '
              || '&unknown; &amp</p>' AS redacted_text,
            (coalesce(sum(r.entities_found), 0) + 2)::INT AS entities_found
          FROM tokens t LEFT JOIN rebuilt r ON r.k = t.tk GROUP BY t.page_id""",
    ),
)
def t5_redact_html(t: Tables) -> DataFrame:
    """T5: text content is redacted, references in any notation included; every byte outside a
    span stays."""
    head, middle, tail = _TAIL.split("{0}")
    number = F.col("page_id").cast("string")
    pages = t.pages.select("page_id", F.concat(
        "html", F.lit(head), number, F.lit(middle), number, F.lit(tail)).alias("html"))
    return redact_html(spread(pages), "html").select("page_id", "redacted_text", "entities_found")


@query(
    "t6_isolated_rows",
    """SELECT doc_id AS id, CASE WHEN doc_id % 4 IN (0, 2) THEN 'error' ELSE 'success' END AS json,
         CASE WHEN doc_id % 4 IN (0, 2) THEN NULL WHEN doc_id % 4 = 1
           THEN '{"n": ' || repeat('7', 5000) || ', "m": "[EMAIL_ADDRESS]"}'
           ELSE '{"m": "[EMAIL_ADDRESS]"}' END AS redacted_text,
         CASE WHEN doc_id % 3 = 0 THEN 'success' ELSE 'error' END AS xml FROM documents""",
)
def t6_isolated_rows(t: Tables) -> DataFrame:
    """Lone surrogates and cut texts are errors of their rows, long numbers are none; the
    same for XML."""
    i = F.col("doc_id")
    texts = t.documents.select(
        i.alias("id"),
        F.when(i % 4 == 0, F.lit('{"m": "\\ud800 a@b.com"}'))
        .when(i % 4 == 1, F.concat(F.lit('{"n": '), F.repeat(F.lit("7"), 5000),
                                   F.lit(', "m": "a@b.com"}')))
        .when(i % 4 == 2, F.lit('{"m": "a@b.com"')).otherwise(F.lit('{"m": "a@b.com"}')).alias("j"),
        F.when(i % 3 == 0, F.lit("<a>a@b.com</a>")).when(i % 3 == 1, F.lit("<a>&#xD800;</a>"))
        .otherwise(F.lit("<a>&#99999999999;</a>")).alias("x"),
    )
    done = redact_json(spread(texts), "j").select(
        "id", "x", F.col("status").alias("json"), F.col("redacted_text").alias("redacted_json"))
    return redact_xml(done, "x").select(
        "id", "json", F.col("redacted_json").alias("redacted_text"), F.col("status").alias("xml")
    )


@query(
    "t6_malformed_rows",
    """SELECT doc_id AS id, CASE WHEN lang = 'fr' THEN 'error' ELSE 'success' END AS status,
         lang = 'fr' AS withheld FROM documents""",
)
def t6_malformed_rows(t: Tables) -> DataFrame:
    """A malformed text is an error row without text; its neighbours are not affected."""
    return redact_json(spread(fx.json_docs(t, broken=True)), "json").select(
        "id", "status", F.col("redacted_text").isNull().alias("withheld")
    )
