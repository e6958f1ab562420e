"""Size checks behind every broadcast and every repartition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it is known to stay below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 32 * 1024 * 1024
# Copies of a table too large to broadcast, so that one hot key is spread over many tasks.
SALTS = 32
# Below this many bytes per task slot an input is spread over all slots.
SPREAD_BYTES_PER_SLOT = 32 * 1024 * 1024
# Bounds of the Arrow batches between the JVM and Python workers: texts can be long.
BATCH_BOUNDS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": 2 * 1024 * 1024,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2048,
}


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of Arrow batches to those above, if they are higher: a worker
    holds a few megabytes of texts at a time, however long they are."""
    for name, bound in BATCH_BOUNDS.items():
        now = int(spark.conf.get(name).rstrip("b"))
        if now <= 0 or now > bound:
            spark.conf.set(name, str(bound))


def is_bounded(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS
) -> bool:
    """Whether a table has at most ``max_rows`` rows and ``max_chars`` characters of text.

    Runs one job that stops after ``max_rows + 1`` rows.
    """
    strings = [F.length(f.name) for f in table.schema.fields if f.dataType.typeName() == "string"]
    width = F.lit(0)
    for s in strings:
        width = width + F.coalesce(s, F.lit(0))
    row = (
        table.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("chars"))
        .first()
    )
    return row["n"] <= max_rows and row["chars"] <= max_chars


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str],
) -> DataFrame:
    """Join a large left side to a lookup table (``left``, ``inner``, ``left_anti``, ``left_semi``).

    A bounded table is broadcast.  Beyond the bound the table is copied once per salt and the
    left side is salted by ``spread_by``, so that a value held by a third of all rows is
    joined in many tasks.
    """
    if is_bounded(table):
        return left.join(F.broadcast(table), list(keys), how)
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def broadcast_if_bounded(table: DataFrame, **bounds: int) -> DataFrame:
    return F.broadcast(table) if is_bounded(table, **bounds) else table


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame; no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Give every task slot work when a small input sits in few row groups.

    A large input already has more splits than slots and is returned untouched: shuffling
    its texts would cost more than it could win.
    """
    if df.isStreaming:
        return df
    slots = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) >= slots * SPREAD_BYTES_PER_SLOT:
        return df
    return df.repartition(slots * 2, *keys)
