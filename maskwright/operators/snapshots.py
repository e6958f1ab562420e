"""Registries that do not replay their whole history: sorted snapshots plus later events.

Events are appended in numbered batches.  Now and then the state is written as a snapshot, sorted
by key ranges, together with the number of the last batch in it.  The current state is then the
latest snapshot merged with the newer batches: rows of keys without a newer event pass as they
are, only the others are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.operators.ordinals import latest_per_key
from maskwright.operators.sizing import broadcast_if_bounded

BATCH = "__batch"


@dataclass(frozen=True)
class SnapshotRegistry:
    """A registry below a shared path.

    ``order`` has to rank the events of a key without ties, over all batches; ``deleted`` names
    the column that marks an event as the end of its key.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[str]
    deleted: str | None = "deleted"

    def _latest(self, events: DataFrame) -> DataFrame:
        return latest_per_key(events, self.keys, [F.col(o) for o in self.order])

    def _alive(self, rows: DataFrame) -> DataFrame:
        if self.deleted is None:
            return rows
        return rows.filter(~F.coalesce(F.col(self.deleted), F.lit(False)))

    def append(self, events: DataFrame, batch: int) -> None:
        """Add a batch; one that is written again replaces itself."""
        self._write(events, f"events/{BATCH}={batch}")

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def _folders(self, spark: SparkSession, kind: str) -> list[int]:
        """The numbers of the written batches or snapshots; unfinished ones do not count."""
        context = spark.sparkContext
        top = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = top.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(top):
            return []
        done = [
            status.getPath() for status in files.listStatus(top)
            if files.exists(context._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        ]
        return sorted(int(p.getName().rpartition("=")[2]) for p in done)

    def _read(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def _parts(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        snapshots = self._folders(spark, "snapshots")
        last = snapshots[-1] if snapshots else None
        newer = [b for b in self._folders(spark, "events") if last is None or b > last]
        return last, newer

    def _merged(self, spark: SparkSession) -> DataFrame:
        """The latest event of every key, deleted ones too."""
        last, newer = self._parts(spark)
        events = self._read(spark, [f"events/{BATCH}={b}" for b in newer])
        if last is None:
            return self._latest(events)
        snapshot = self._read(spark, [f"snapshots/upto={last}"])
        touched = broadcast_if_bounded(events.select(*self.keys).distinct())
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in self.keys]
        condition = same[0]
        for one in same[1:]:
            condition = condition & one
        def met(how: str) -> DataFrame:
            return snapshot.alias("s").join(touched.alias("t"), condition, how)

        return met("left_anti").unionByName(self._latest(events.unionByName(met("left_semi"))))

    def current(self, spark: SparkSession) -> DataFrame:
        """The state: reads the latest snapshot and the batches after it."""
        return self._alive(self._merged(spark))

    def replay(self, spark: SparkSession) -> DataFrame:
        """The state from all events."""
        every = self._folders(spark, "events")
        return self._alive(self._latest(self._read(spark, [f"events/{BATCH}={b}" for b in every])))

    def compact(self, spark: SparkSession) -> None:
        """Write the state as a snapshot, in ranges of keys.

        Deleted keys stay in it: an older event could arrive in a later batch.
        """
        _, newer = self._parts(spark)
        if newer:
            rows = self._merged(spark).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
            self._write(rows, f"snapshots/upto={newer[-1]}")
