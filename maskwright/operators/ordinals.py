"""Exact ordinals and latest rows per key that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.operators.sizing import lookup_join

# Groups above this size are numbered in ranges instead of in one sort.
HOT_ROWS = 5_000_000
RANGES = 64


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate, so versions of one key are combined before the shuffle; ``order`` has to be
    a total order for the result to be unique.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def ordinal_within(
    df: DataFrame, key: str, order: str, out: str = "ordinal", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the rows of every key from 1 in the order of a unique string column.

    Groups of ordinary size are numbered by one window.  When a group has more than
    ``hot_rows`` rows it is cut into ranges at boundary values taken from the group; each range
    is numbered on its own and shifted by the sizes of the ranges before it.  The boundaries
    only decide how evenly the work is cut, never the result.
    """
    hot = df.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows)
    if hot.isEmpty():
        numbered = F.row_number().over(Window.partitionBy(key).orderBy(order))
        return df.withColumn(out, numbered.cast("long"))
    # About two boundary candidates per range and group, whatever the size of the group.
    members = lookup_join(df.select(key, order), hot, [key], "inner", [order])
    picked = members.filter(
        F.pmod(F.xxhash64(order), F.ceil(F.col("__n") / (2 * RANGES))) == 0
    )
    cuts = picked.groupBy(key).agg(F.sort_array(F.collect_set(order)).alias("__cuts"))
    ranged = lookup_join(df, cuts, [key], "left", [order]).withColumn(
        "__range", F.coalesce(F.expr(f"size(filter(__cuts, x -> x <= `{order}`))"), F.lit(0))
    ).drop("__cuts")
    own = Window.partitionBy(key, "__range").orderBy(order)
    before = Window.partitionBy(key).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = ranged.groupBy(key, "__range").agg(F.count("*").alias("__c")).select(
        key, "__range", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__offset")
    )
    # A range is a small part of its group, so this join has no hot key of its own.
    return (
        ranged.withColumn("__rn", F.row_number().over(own))
        .join(sizes, [key, "__range"])
        .withColumn(out, (F.col("__rn") + F.col("__offset")).cast("long"))
        .select(*df.columns, out)
    )
