"""Audit aggregates.  They hold counts, labels and clipped arguments, never entity values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskwright.functions.text import clip


def label_profile(spans: DataFrame, doc_key: str) -> DataFrame:
    """Spans and documents per label of a span table(label, <doc_key>).

    Counted per document first, so the distinct count needs no second pass over the spans.
    """
    per_doc = spans.groupBy("label", doc_key).agg(F.count("*").alias("n"))
    return per_doc.groupBy("label").agg(
        F.sum("n").alias("spans"), F.count("*").alias("documents")
    )


def label_rollup(spans: DataFrame, by: str) -> DataFrame:
    """Span counts per (by, label) with subtotals; NULL stands for "all"."""
    return spans.rollup(by, "label").agg(F.count("*").alias("spans"))


def exact_percentile(
    df: DataFrame, by: str, value: str, share: float, width: int = 1000, out: str = "percentile"
) -> DataFrame:
    """(by, out): the percentile of a numeric column, interpolated between neighbours.

    Equal values are counted first.  The counts are summed in ranges of ``width``; only the
    ranges that hold the wanted ranks are then looked into, so no group sits in one buffer.
    """
    wide = F.floor(F.col(value) / width).alias("__range")
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(
        F.count("*").alias("__n")).withColumn("__range", wide)
    per_range = counts.groupBy(by, "__range").agg(F.sum("__n").alias("__c"))
    order = Window.partitionBy(by).orderBy("__range")
    whole = Window.partitionBy(by)
    placed = per_range.select(
        by, "__range",
        (F.sum("__c").over(order) - F.col("__c")).alias("__before"), "__c",
        ((F.sum("__c").over(whole) - 1) * F.lit(share)).alias("__at"),
    )
    low, high = F.floor("__at"), F.ceil("__at")
    wanted = placed.filter(
        (F.col("__before") <= high) & (F.col("__before") + F.col("__c") > low)
    ).drop("__c")
    inner = Window.partitionBy(by, "__range").orderBy(value)
    ranked = counts.join(wanted, [by, "__range"]).withColumn(
        "__end", F.sum("__n").over(inner) + F.col("__before")
    )
    return ranked.groupBy(by).agg(
        F.max("__at").alias("__at"),
        F.min(F.when(F.col("__end") > low, F.col(value))).alias("__low"),
        F.min(F.when(F.col("__end") > high, F.col(value))).alias("__high"),
    ).select(
        by,
        (F.col("__low") + (F.col("__high") - F.col("__low")) * (F.col("__at") - low)).alias(out),
    )


def call_stats(events: DataFrame) -> DataFrame:
    """Calls, errors, mean and 95th percentile duration per tool(tool, level, duration_ms)."""
    stats = events.groupBy("tool").agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("level") == "error").alias("errors"),
        F.avg("duration_ms").alias("mean_ms"),
    )
    slow = exact_percentile(events, "tool", "duration_ms", 0.95, out="p95_ms")
    return stats.join(slow, "tool", "left")


def clipped(events: DataFrame, column: str) -> DataFrame:
    """Arguments shortened before they are stored."""
    return events.withColumn(column, clip(F.col(column)))
