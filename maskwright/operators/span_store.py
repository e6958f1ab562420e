"""Detected spans kept by content, so that texts are scanned again only if they have to be.

The store is an append-only table (content, version, run, spans).  ``content`` is the hash of a
text, ``version`` that of everything detection depends on.  A prediction scans the texts whose
(content, version) the store lacks, equal ones once; with ``force`` it scans all.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions import spans as sp
from maskwright.operators.lookups import HOT
from maskwright.operators.ordinals import latest_per_key
from maskwright.operators.policy import RedactOptions
from maskwright.operators.redact import _name, detect, enabled, refuse_clashes
from maskwright.sources.shared import stored

SCHEMA = f"content string, version string, run long, spans array<{sp.CANDIDATE_TYPE}>"


def detector_version(options: RedactOptions, custom: str = "") -> str:
    """A hash of the patterns and lists that decide which spans are found.

    ``custom`` names the state of the custom detectors, whose code cannot be hashed.
    """
    parts = [
        [(d.label, d.pattern, d.check) for d in enabled(options)],
        sorted(options.custom_entities), custom,
        sorted((k, sorted(v.strings), sorted(v.regexes)) for k, v in options.label_allow_lists.items()),
        sorted((k, sorted(v.strings), sorted(v.regexes)) for k, v in options.label_block_lists.items()),
    ]
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


def content_of(text: Column) -> Column:
    return F.sha2(text, 256)


@dataclass(frozen=True)
class Prediction:
    """What a run did: rows with ``spans``, and the number of texts that were scanned."""

    rows: DataFrame
    scanned: int


class SpanStore:
    """Spans below a path that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        # The table exists before the first run, so that it can be read.
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)

    def _known(self, version: str) -> DataFrame:
        """(content, spans) of a version; of repeated scans the latest run counts."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("version") == version)
        return latest_per_key(rows, ["content"], [F.col("run")]).select("content", "spans")

    def predict(
        self, df: DataFrame, text_col: str, options: RedactOptions = RedactOptions(), *, run: int,
        force: bool = False, custom: str = "",
    ) -> Prediction:
        """Add ``spans`` to every row; only what the store lacks is scanned, or all by ``force``.

        ``run`` numbers the runs, ascending.  A null text has no spans and is not scanned.  A
        repeated run writes the same spans again, which changes nothing.
        """
        refuse_clashes(df, ["spans"])
        version = detector_version(options, custom)
        order = df.columns
        placed = df.toDF(*[f"__c{i}" for i in range(len(order))])
        text = f"__c{order.index(text_col)}"
        keyed = placed.withColumn("__content", content_of(F.col(text)))
        key = F.col("__content").alias("content")
        # One pass for what there is and how often; texts are written nowhere.
        counted = keyed.filter("__content IS NOT NULL").groupBy(key).agg(F.count("*").alias("n"))
        contents = stored(counted, "span_store_contents")
        wanted = contents.select("content") if force else contents.select("content").join(
            self._known(version).select("content"), "content", "left_anti")
        wanted = stored(wanted, "span_store_wanted")
        scanned = wanted.count()
        if scanned:
            # One text of each content: the others do not leave their tasks.
            texts = keyed.select(key, F.col(text).alias("text")).join(
                wanted, "content", "left_semi").dropDuplicates(["content"])
            found = detect(texts, "text", options).select(
                "content", F.lit(version).alias("version"), F.lit(run).cast("long").alias("run"), "spans")
            found.write.mode("append").parquet(self.path)
        spans = F.coalesce("spans", sp.empty_candidates()).alias("spans")
        known = stored(
            contents.join(self._known(version), "content", "left").select(
                F.col("content").alias("__content"), "n", spans), "span_store_known")
        # A text that many rows hold is a hot key: there are fewer than HOT, which go by broadcast.
        total = contents.agg(F.sum("n")).first()[0] or 0
        often = F.broadcast(known.filter(F.col("n") * HOT > total).drop("n"))
        seldom = known.filter(F.col("n") * HOT <= total).drop("n")
        present = keyed.filter("__content IS NOT NULL")
        met = (
            present.join(often, "__content")
            .unionByName(present.join(often.select("__content"), "__content", "left_anti").join(
                seldom, "__content", "left"))
            .unionByName(keyed.filter("__content IS NULL").withColumn("spans", sp.empty_candidates()))
        )
        rows = met.select(*[_name(c) for c in placed.columns], spans).toDF(*order, "spans")
        return Prediction(rows, scanned)
