"""Search, filter, sort and page over registry tables, with totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.sources.shared import shared_path

# Rows before a page that one sort may keep; pages further back are found by ranges.
DEEP_OFFSET = 10_000


def _cleaned(values: Sequence[str]) -> list[str]:
    return [v.strip() for v in values if v.strip()]


@dataclass(frozen=True)
class ListQuery:
    """One page request; blank search text and blank list items mean "no filter"."""

    search: str | None = None
    users: Sequence[str] = ()
    statuses: Sequence[str] = ()
    sort_by: str | None = None
    sort_direction: str = "asc"
    offset: int = 0
    limit: int | None = None

    def __post_init__(self) -> None:
        if self.offset < 0:
            raise ValueError("offset must not be negative")
        if self.limit is not None and self.limit < 1:
            raise ValueError("limit must be positive")
        if self.sort_direction.lower() not in ("asc", "desc"):
            raise ValueError(f"unknown sort direction {self.sort_direction!r}")


@dataclass(frozen=True)
class Listing:
    """Which columns of a table play which part in a listing."""

    key: str
    search: str
    user: str | None = None
    status: str | None = None
    sortable: Sequence[str] = ()


def matches(listing: Listing, query: ListQuery) -> Column:
    """The filter of a query: search, users and statuses together."""
    test = F.lit(True)
    text = (query.search or "").strip()
    if text:
        test = test & F.contains(F.lower(listing.search), F.lower(F.lit(text)))
    users, statuses = _cleaned(query.users), _cleaned(query.statuses)
    if users and listing.user:
        test = test & F.col(listing.user).isin(*users)
    if statuses and listing.status:
        test = test & F.col(listing.status).isin(*statuses)
    return test


def page(df: DataFrame, listing: Listing, query: ListQuery) -> DataFrame:
    """The rows of one page; the key breaks ties, so pages never overlap.

    A page near the front is the top of a sort that keeps no more rows than it needs.  For one
    further back the rows are sorted in ranges and counted per range, so that no task holds all
    that come before it.
    """
    field = query.sort_by or listing.key
    if field not in (listing.key, *listing.sortable):
        raise ValueError(f"cannot sort by {field!r}")
    first = F.desc(field) if query.sort_direction.lower() == "desc" else F.asc(field)
    order = [first, F.asc(listing.key)]
    wanted = df.filter(matches(listing, query))
    if query.offset > DEEP_OFFSET:
        return deep_page(wanted, order, query)
    rows = wanted.orderBy(*order)
    if query.offset:
        rows = rows.offset(query.offset)
    return rows.limit(query.limit) if query.limit is not None else rows


def deep_page(rows: DataFrame, order: Sequence[Column], query: ListQuery) -> DataFrame:
    """Rows sorted in ranges and written, so that their places do not change; then those whose
    place in their range, shifted by the sizes of the ranges before it, is on the page."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, "page")
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "__place", F.monotonically_increasing_id()
    ).write.parquet(path)
    sorted_rows = spark.read.parquet(path)
    # The upper bits of a place are the range, the lower ones count from 0 within it.
    part = F.shiftright("__place", 33)
    sizes = sorted_rows.groupBy(part.alias("__range")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    at = F.col("__shift") + F.col("__place").bitwiseAND((1 << 33) - 1)
    test = at >= query.offset
    if query.limit is not None:
        test = test & (at < query.offset + query.limit)
    # One row per range: broadcast.
    placed = sorted_rows.withColumn("__range", part).join(F.broadcast(shifts), "__range")
    return placed.filter(test).select(*[F.col(f"`{c}`") for c in rows.columns])


def totals(df: DataFrame, listing: Listing, query: ListQuery) -> DataFrame:
    """Counts before and after filtering and the place of the page, from one pass."""
    counted = df.agg(
        F.count_if(matches(listing, query)).alias("total_records"),
        F.count("*").alias("absolute_total_records"),
    )
    size = F.lit(query.limit).cast("long") if query.limit else F.greatest("total_records", F.lit(1))
    start = F.lit(query.offset)
    return counted.select(
        "total_records",
        "absolute_total_records",
        (F.floor(start / size) + 1).cast("long").alias("page_number"),
        F.ceil(F.col("total_records") / size).cast("long").alias("total_pages"),
        (start > 0).alias("has_previous_page"),
        (start + size < F.col("total_records")).alias("has_next_page"),
    )


def unwrap_page(
    df: DataFrame,
    json_col: str,
    record_type: str,
    record_keys: Sequence[str],
    total_keys: Sequence[str] = ("totalRecords",),
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a page of records from any of its known shapes.

    A page is a bare array or an object with the array under one of ``record_keys`` (first
    array wins); its total is the first number among ``total_keys``, else the record count.
    Adds ``records``, ``total``, the ``extra`` fields and ``error`` for unknown shapes.
    """
    extra = extra or {}
    fields = [f"{k} array<{record_type}>" for k in record_keys]
    fields += [f"{k} bigint" for k in total_keys]
    fields += [f"{k} {t}" for k, t in extra.items()]
    text = F.col(json_col)
    parsed = df.select(
        "*",
        F.from_json(text, ", ".join(fields)).alias("__o"),
        F.when(
            F.rlike(text, F.lit(r"^\s*\[")), F.from_json(text, f"array<{record_type}>")
        ).alias("__a"),
    )
    records = F.coalesce(F.col("__a"), *[F.col(f"__o.{k}") for k in record_keys])
    total = F.coalesce(
        *[F.col(f"__o.{k}") for k in total_keys], F.size("records").cast("long")
    )
    named = parsed.select("*", records.alias("records"))
    return named.select(
        *df.columns,
        "records",
        F.when(F.col("records").isNotNull(), total).alias("total"),
        *[F.col(f"__o.{k}").alias(k) for k in extra],
        F.when(F.col("records").isNull(), "Unexpected response shape").alias("error"),
    )
