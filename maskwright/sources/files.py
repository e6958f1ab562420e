"""File trees as tables: listed, read and written by the tasks, through the file system of the path.

No list of paths passes the driver.  A tree is listed level by level: its folders are dealt to
tasks, each of which lists them, and what is found is rows.  The driver sees one number a level.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.text import base_name, extension, media_type
from maskwright.sources.shared import stored

MAX_DEPTH = 10
# Bytes of files that one task reads, about, and rows that a task hands on at a time.
TASK_BYTES = 64 * 1024 * 1024
BATCH_BYTES, BATCH_ROWS = 2 * 1024 * 1024, 2048


def file_system(uri: str) -> tuple[Any, str]:
    """The file system of a URI or local path, and the path within it.

    Local paths keep every character; other URIs (hdfs, s3, gs) are read by pyarrow.
    """
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:/{0,2}(?=/))?(/.*)", uri, re.DOTALL)
    if local:
        return fs.LocalFileSystem(), posixpath.normpath(local[1])
    if not re.match(r"[a-z][a-z0-9+.-]*://", uri):
        raise ValueError(f"a path must be absolute: {uri!r}")
    return fs.FileSystem.from_uri(uri.rstrip("/"))


def describe(paths: DataFrame) -> DataFrame:
    """Add name, extension, depth and media type to a table with a relative ``path``."""
    name = base_name(F.col("path"))
    return paths.select(
        "*",
        name.alias("name"),
        F.lower(extension(name)).alias("ext"),
        (F.size(F.split("path", "/")) - 1).alias("depth"),
        media_type(name).alias("type"),
    )


def _visible(name: str) -> bool:
    return not name.startswith((".", "_"))


def _level(folders: DataFrame, root: str) -> DataFrame:
    """(path, size, is_folder): what the folders hold, each listed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = file_system(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                at = posixpath.join(base, folder) if folder else base
                found = [
                    (f"{folder}/{info.base_name}" if folder else info.base_name, info)
                    for info in files.get_file_info(fs.FileSelector(at)) if _visible(info.base_name)
                ]
                for i in range(0, len(found), BATCH_ROWS):
                    part = found[i:i + BATCH_ROWS]
                    folders_here = [info.type == fs.FileType.Directory for _, info in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path for path, _ in part], pa.string()),
                         pa.array([info.size or 0 for _, info in part], pa.int64()),
                         pa.array(folders_here, pa.bool_())],
                        names=["path", "size", "is_folder"],
                    )

    return folders.select("path").mapInArrow(run, "path string, size bigint, is_folder boolean")


def listing(spark: SparkSession, root: str, max_depth: int | None = MAX_DEPTH) -> DataFrame:
    """(path, size) of all files of a tree, empty ones too, as a written table.

    Paths are relative to the root.  As in every Spark file source, names that start with a dot
    or an underscore are invisible; so are empty folders.  Files below ``max_depth`` folders are
    left out (None: no bound).
    """
    if max_depth is not None and max_depth < 0:
        raise ValueError("max_depth must not be negative")
    slots = spark.sparkContext.defaultParallelism
    folders, count, depth, files = spark.createDataFrame([("",)], "path string"), 1, 0, None
    while count and (max_depth is None or depth <= max_depth):
        # Every task gets a few folders; a level of many folders is many tasks.
        tasks = max(1, min(count, 4 * slots), count // 1000)
        level = stored(_level(folders.repartition(tasks, "path"), root), "listed_level")
        here = level.filter("NOT is_folder").select("path", "size")
        files = here if files is None else files.unionByName(here)
        folders = level.filter("is_folder").select("path")
        count, depth = folders.count(), depth + 1
    return files


def list_tree(spark: SparkSession, root: str, max_depth: int | None = MAX_DEPTH) -> DataFrame:
    """Inventory of a directory tree from metadata only (see ``listing``)."""
    return describe(listing(spark, root, max_depth))


def read_listed(files: DataFrame, root: str) -> DataFrame:
    """Texts of listed files(path, size) as (path, text); that of an empty file is empty.

    Filter the list before: only files that are left are opened.  They are dealt to tasks of
    about ``TASK_BYTES``; bytes that are no UTF-8 become replacement characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, base = file_system(root)

        def told(rows: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["path", "text"]
            )

        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with storage.open_input_stream(posixpath.join(base, path)) as source:
                    text = source.read().decode("utf-8", "replace")
                if rows and (size + len(text) > BATCH_BYTES or len(rows) >= BATCH_ROWS):
                    yield told(rows)
                    rows, size = [], 0
                rows.append((path, text))
                size += len(text)
        if rows:
            yield told(rows)

    total = files.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    slots = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(total["n"], 2 * slots), -(-(total["bytes"] or 0) // TASK_BYTES))
    return files.select("path").repartition(tasks, F.xxhash64("path")).mapInArrow(
        run, "path string, text string"
    )


def read_whole(spark: SparkSession, root: str) -> DataFrame:
    """Text of every file below a root as (path, text)."""
    return read_listed(listing(spark, root, None), root)


def _safe(path: str) -> str:
    """A relative path that stays below its root."""
    plain = posixpath.normpath(path)
    if plain.startswith("/") or plain in (".", "..") or plain.startswith("../"):
        raise ValueError("output path leaves the output directory")
    return plain


def write_tree(outputs: DataFrame, root: str) -> None:
    """Write (output_path, redacted_text) as single files below a root, on any file system.

    Every attempt of a task writes under names of its own and reports them; Spark keeps the
    reports of the attempts that won, as a written table.  Only what this manifest names is then
    moved to its place, so a failed or repeated task leaves each file once and whole.  Moving
    again is harmless.  What lost attempts wrote goes with the staging folder.
    """
    spark = outputs.sparkSession
    staging = f"_staging-{uuid.uuid4().hex}"
    storage, base = file_system(root)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = file_system(root)
        own = posixpath.join(at, staging, uuid.uuid4().hex)
        files.create_dir(own, recursive=True)
        number = 0
        for batch in batches:
            staged, targets = [], []
            for path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                targets.append(_safe(path))
                staged.append(posixpath.join(own, str(number)))
                with files.open_output_stream(staged[-1]) as sink:
                    sink.write((text or "").encode("utf-8", "surrogatepass"))
                number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(staged, pa.string()), pa.array(targets, pa.string())],
                names=["staged", "target"],
            )

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, at = file_system(root)
        made: set[str] = set()
        for batch in batches:
            for staged, target in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = posixpath.join(at, target)
                folder = posixpath.dirname(place)
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                if files.get_file_info(staged).type == fs.FileType.NotFound:
                    # An earlier attempt of this task moved it.
                    if files.get_file_info(place).type != fs.FileType.File:
                        raise FileNotFoundError(place)
                else:
                    files.move(staged, place)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    storage.create_dir(posixpath.join(base, staging), recursive=True)
    named = outputs.select(
        F.col("output_path").cast("string"), F.col("redacted_text").cast("string")
    )
    try:
        manifest = stored(named.mapInArrow(stage, "staged string, target string"), "written_manifest")
        manifest.mapInArrow(move, "n bigint").agg(F.sum("n")).collect()
    finally:
        storage.delete_dir(posixpath.join(base, staging))

