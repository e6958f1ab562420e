"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or where none is set a folder of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return re.sub(r"^file:/(?!/)", "file:///", named.rstrip("/"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's file system closes."""
    path = f"{shared_dir(spark)}/maskwright/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there.

    With ``by`` it is parted by those columns, and filters on them prune files.
    """
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
