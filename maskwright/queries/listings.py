"""Search, filter, sort and page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.operators.listing import (
    Listing,
    ListQuery,
    deep_page,
    matches,
    page,
    totals,
)
from maskwright.operators.registry import summarize_entity
from maskwright.queries import fixtures as fx
from maskwright.queries.base import Tables, query, with_ctes

LISTING = Listing(
    key="id", search="name", user="created_by", status="status",
    sortable=["name", "last_modified", "status"],
)
PAGE = ListQuery(
    search="  WIDGET ", users=[" Brand#2 ", "", *(f"Brand#{i}" for i in range(3, 18))],
    statuses=["Ready", "Training", "PreTraining"], sort_by="name", sort_direction="DESC",
    offset=3, limit=25,
)
_FILTER = """contains(lower(name), 'widget')
  AND regexp_full_match(created_by, 'Brand#([2-9]|1[0-7])')
  AND status IN ('Ready', 'Training', 'PreTraining')"""


@query(
    "g13_list_entities",
    with_ctes(
        fx.ENTITIES,
        select=f"""SELECT id AS entity_id, name, display_name, status, active_model_id,
            last_modified AS last_modified_date
          FROM entities WHERE {_FILTER} ORDER BY name DESC, id OFFSET 3 LIMIT 25""",
    ),
)
def g13_list_entities(t: Tables) -> DataFrame:
    """One page of the filtered, sorted entities."""
    return summarize_entity(page(fx.entities(t), LISTING, PAGE))


@query(
    "g13_list_totals",
    with_ctes(
        fx.ENTITIES,
        f"n AS (SELECT count(*) FILTER ({_FILTER}) AS total, count(*) AS everything FROM entities)",
        select="""SELECT total AS total_records, everything AS absolute_total_records,
            1::BIGINT AS page_number, ceil(total / 25)::BIGINT AS total_pages,
            true AS has_previous_page, 28 < total AS has_next_page FROM n""",
    ),
)
def g13_list_totals(t: Tables) -> DataFrame:
    """Totals before and after filtering, from one pass."""
    return totals(fx.entities(t), LISTING, PAGE)


@query(
    "l1_search",
    with_ctes(
        fx.ENTITIES, select="SELECT id, name FROM entities WHERE contains(lower(name), 'red')"
    ),
)
def l1_search(t: Tables) -> DataFrame:
    """Case-insensitive search of the trimmed text, not paged."""
    return fx.entities(t).filter(matches(LISTING, ListQuery(search="\tRed "))).select("id", "name")


@query(
    "l3_last_page",
    with_ctes(
        fx.ENTITIES,
        select="""SELECT id FROM entities ORDER BY last_modified, id
          OFFSET (SELECT count(*) - 7 FROM base_entities WHERE size NOT BETWEEN 10 AND 14)""",
    ),
)
def l3_last_page(t: Tables) -> DataFrame:
    """L2 L3: the page that runs past the end."""
    live = fx.entities(t)
    start = live.count() - 7
    return page(
        live, LISTING, ListQuery(sort_by="last_modified", offset=start, limit=100)
    ).select("id")


@query(
    "p6_regex_filter",
    "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '#0*[1-9]\\d?5$')",
)
def p6_regex_filter(t: Tables) -> DataFrame:
    """Rows whose value contains a match."""
    return t.customer.filter(F.rlike("c_name", F.lit(r"#0*[1-9]\d?5$"))).select(
        "c_custkey", "c_name"
    )


@query(
    "l3_deep_page",
    """SELECT l_orderkey, l_linenumber FROM (
         SELECT *, l_orderkey * 8 + l_linenumber AS id FROM lineitem)
       ORDER BY l_shipdate DESC, id OFFSET 3000 LIMIT 500""",
)
def l3_deep_page(t: Tables) -> DataFrame:
    """L3: a page far behind the front, found by ranges."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
    )
    listing = Listing(key="id", search="id", sortable=["l_shipdate"])
    wanted = ListQuery(sort_by="l_shipdate", sort_direction="desc", offset=3000, limit=500)
    order = [F.desc("l_shipdate"), F.asc("id")]
    return deep_page(lines.filter(matches(listing, wanted)), order, wanted).select(
        "l_orderkey", "l_linenumber"
    )


@query(
    "x12_map_entries",
    """SELECT o_orderkey AS id, o_orderstatus || ',' || o_orderpriority AS map_values,
         'priority=' || o_orderpriority || ';status=' || o_orderstatus AS entries FROM orders""",
)
def x12_map_entries(t: Tables) -> DataFrame:
    """The values of a map, and its entries in the order of their keys."""
    pairs = F.create_map(
        F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")
    )
    entries = F.array_sort(F.map_entries(pairs))
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.array_join(F.map_values(pairs), ",").alias("map_values"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
        .alias("entries"),
    )
