"""De-identification of a whole file tree.

Everything that depends on the path alone - skipping, filtering, routing, output names - is
decided on metadata.  The tree is listed once, by the tasks; the files that are left are read once
and redacted by the operator of their route.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions import spans as sp
from maskwright.functions.catalog import BUILT_INS, FILE_TYPES
from maskwright.functions.text import base_name, extension
from maskwright.operators.ordinals import ordinal_within
from maskwright.operators.policy import RedactOptions
from maskwright.operators.redact import redact, text_spans
from maskwright.operators.structured import redact_html, redact_json, redact_xml
from maskwright.sources.files import describe, listing, read_listed
from maskwright.sources.shared import stored

# Why a file is skipped.
SKIP_PATTERN = "Matched skip pattern"
SKIP_EXTENSION = "Extension not in filter list"
SKIP_TYPE = "Unsupported file type"
SKIP_BINARY = "Binary format without a text reader"
# Repeats are possessive: the regex engine loops over them and never calls itself.
CSV_HEAD = r'^((?:"(?:[^"]++|"")*+"|[^"\r\n]++)*+)'


def csv_token(separator: str) -> str:
    """Quoted cells, plain cells, separators with line ends, and stray quotes."""
    return rf'"(?:[^"]++|"")*+"|[^{separator}\r\n"]++|[{separator}\r\n]++|"'


def matches_pattern(path: Column, patterns: Sequence[str]) -> Column:
    """Substring of the path, ``*.ext`` suffix of the name or equal name; case counts."""
    name, test = base_name(path), F.lit(False)
    for pattern in patterns:
        test = test | F.contains(path, F.lit(pattern))
        if pattern.startswith("*."):
            test = test | F.endswith(name, F.lit(pattern[1:]))
        else:
            test = test | (name == pattern)
    return test


def skipped_at(path: Column, patterns: Sequence[str]) -> Column:
    """The topmost ancestor, or the path itself, that a pattern skips; NULL if none does."""
    if not patterns:
        return F.lit(None).cast("string")
    segments = F.split(path, "/")
    prefixes = sp.let(
        segments,
        lambda s: F.transform(
            s, lambda _, i: F.array_join(F.slice(s, F.lit(1), i + 1), "/")
        ),
    )
    return F.get(F.filter(prefixes, lambda p: matches_pattern(p, patterns)), F.lit(0))


def route_of(name: Column) -> Column:
    """text, json, html, xml, csv or binary by extension; NULL when unsupported."""
    routes = F.create_map(*[F.lit(x) for ext, _, route in FILE_TYPES for x in (ext, route)])
    return F.try_element_at(routes, F.lower(extension(name)))


def in_extensions(name: Column, extensions: Sequence[str]) -> Column:
    if not extensions:
        return F.lit(True)
    return F.lower(extension(name)).isin(*[e.lower() for e in extensions])


def name_options(options: RedactOptions) -> RedactOptions:
    """Names are synthesised unless the caller set a default handling.

    A segment of a path holds no URL, and the surrogate of one would bring slashes into names.
    """
    labels = options.labels if options.labels is not None else [d.label for d in BUILT_INS]
    return replace(
        options, generator_default=options.generator_default or "Synthesis",
        labels=[label for label in labels if label != "URL"],
    )


def redacted_name(name: Column, options: RedactOptions) -> Column:
    """A file or folder name with its base redacted and its extension kept."""
    ext = extension(name)
    base = F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    entities = sp.let(
        text_spans(base, options),
        lambda s: sp.to_entities(s, options.replacement(), F.lit(None)),
    )
    return F.concat(sp.let(entities, lambda e: sp.apply_entities(base, e)), ext)


def redacted_path(path: Column, options: RedactOptions) -> Column:
    """Every segment redacted.  A pure function of the name: equal names stay equal."""
    return F.array_join(
        F.transform(F.split(path, "/"), lambda s: redacted_name(s, options)), "/"
    )


def distinct_names(paths: DataFrame, options: RedactOptions) -> DataFrame:
    """One row per distinct segment with its new name."""
    names = paths.select(F.explode(F.split("path", "/")).alias("name")).distinct()
    return names.select("name", redacted_name(F.col("name"), name_options(options)).alias("new_name"))


@dataclass(frozen=True)
class FolderOptions:
    """Options of a folder job next to the redaction policy."""

    deidentify_names: bool = False
    file_extensions: Sequence[str] = ()
    skip_patterns: Sequence[str] = ()
    json_path_allow_lists: Mapping[str, Sequence[str]] = field(default_factory=dict)
    json_path_ignore: Sequence[str] = ()


def plan_work(
    files: DataFrame, options: RedactOptions = RedactOptions(), folder: FolderOptions = FolderOptions()
) -> DataFrame:
    """Decide every file of an inventory(path): where it is skipped, its route and its target."""
    name = base_name(F.col("path"))
    ext_ok = in_extensions(name, folder.file_extensions)
    route = route_of(name)
    decided = files.select(
        "*", skipped_at(F.col("path"), folder.skip_patterns).alias("skipped_at")
    ).select(
        "*",
        F.when(F.col("skipped_at").isNotNull(), SKIP_PATTERN)
        .when(~ext_ok, SKIP_EXTENSION)
        .when(route.isNull(), SKIP_TYPE)
        .when(route == "binary", SKIP_BINARY)
        .alias("reason"),
        route.alias("route"),
    )
    target = (
        redacted_path(F.col("path"), name_options(options))
        if folder.deidentify_names
        else F.col("path")
    )
    return decided.withColumn("target", F.when(F.col("reason").isNull(), target))


def unnumbered(target: Column) -> Column:
    """A target that cannot be taken for a numbered one: ``x~2.txt`` becomes ``x~2~1.txt``."""
    ext = extension(base_name(target))
    stem = F.substring(target, F.lit(1), F.length(target) - F.length(ext))
    return F.concat(F.regexp_replace(stem, "(~[0-9]+)$", "$1~1"), ext)


def with_outputs(work: DataFrame) -> DataFrame:
    """Give every routed file its own output path: equal targets get ``~2``, ``~3``, ...

    A target that ends like a numbered one is set apart first, so all paths are different.
    """
    # Written once: the targets are used four times, and names are costly to redact.
    routed = stored(
        work.filter(F.col("reason").isNull()).withColumn("target", unnumbered(F.col("target"))),
        "folder_targets",
    )
    # Only targets that more than one file claims are numbered.
    clashes = routed.groupBy("target").agg(F.count("*").alias("n")).filter("n > 1").select("target")
    clashing = routed.join(clashes, "target", "left_semi")
    numbered = ordinal_within(clashing.select("target", "path"), "target", "path")
    name = base_name(F.col("target"))
    ext = extension(name)
    stem = F.substring(
        F.col("target"), F.lit(1), F.length("target") - F.length(ext)
    )
    suffix = F.when(
        F.col("ordinal") > 1, F.concat(F.lit("~"), F.col("ordinal").cast("string"))
    ).otherwise("")
    return routed.join(numbered.select("path", "ordinal"), "path", "left").select(
        *[F.col(c) for c in work.columns],
        F.concat(stem, F.coalesce(suffix, F.lit("")), ext).alias("output_path"),
        (F.coalesce("ordinal", F.lit(1)) > 1).alias("renamed"),
    )


def skipped_results(work: DataFrame) -> DataFrame:
    """One result per skipped file; a skipped directory is one result for its subtree."""
    pruned = work.filter(F.col("reason") == SKIP_PATTERN).select(
        F.col("skipped_at").alias("source"), F.col("reason").alias("error")
    ).distinct()
    single = work.filter(
        F.col("reason").isNotNull() & (F.col("reason") != SKIP_PATTERN)
    ).select(F.col("path").alias("source"), F.col("reason").alias("error"))
    return pruned.unionByName(single).select(
        "source", F.lit("").alias("output"), F.lit("skipped").alias("status"), "error"
    )


def redact_csv_text(
    df: DataFrame, text_col: str, options: RedactOptions, separator: str = ","
) -> DataFrame:
    """Cells of delimited text; the header, separators and quoting stay.

    A doubled quote inside a quoted cell is one quote of its value, and a line break inside
    quotes does not end the header or a line.
    """
    text = F.col(text_col)
    head = F.regexp_extract(text, CSV_HEAD, 1)
    body = F.regexp_extract_all(
        F.substring(text, F.length(head) + 1, F.length(text)),
        F.lit(csv_token(separator)), F.lit(0),
    )

    def cell(token: Column) -> Column:
        quoted = F.startswith(token, F.lit('"')) & (F.length(token) > 1)
        inner = F.when(
            quoted,
            F.replace(F.substring(token, F.lit(2), F.length(token) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(token)
        entities = sp.let(
            text_spans(inner, options),
            lambda s: sp.to_entities(s, options.replacement(), F.lit(None)),
        )
        made = sp.let(entities, lambda e: F.struct(
            F.size(e).alias("n"), sp.apply_entities(inner, e).alias("value"),
        ))
        return sp.let(
            made,
            lambda m: F.struct(
                m["n"].alias("n"),
                F.when(m["n"] == 0, token)
                .when(quoted, F.concat(
                    F.lit('"'), F.replace(m["value"], F.lit('"'), F.lit('""')), F.lit('"')))
                .otherwise(m["value"]).alias("value"),
            ),
        )

    cut = df.select("*", head.alias("__head"), sp.once(F.transform(body, cell)).alias("__cells"))
    return cut.select(
        *df.columns,
        F.concat(
            F.col("__head"), F.array_join(F.transform("__cells", lambda c: c["value"]), "")
        ).alias("redacted_text"),
        F.aggregate("__cells", F.lit(0), lambda a, c: a + c["n"]).alias("entities_found"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


def redact_routes(
    contents: DataFrame, options: RedactOptions = RedactOptions(), folder: FolderOptions = FolderOptions()
) -> DataFrame:
    """Redact contents(path, text) by the route of each path.

    Each route is a separate branch; where the contents have a column ``route``, by which they are
    written, a branch reads its part only.
    """
    known = "route" in contents.columns
    route = F.col("route") if known else route_of(base_name(F.col("path")))

    tabs = F.endswith(F.lower("path"), F.lit(".tsv"))

    def branch(name: str) -> DataFrame:
        return contents.filter(route == name).select("path", "text")

    plain = redact(branch("text"), "text", options).select(
        "path", "redacted_text", "entities_found",
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"),
    )
    others = [
        redact_json(
            branch("json"), "text", options,
            path_allow_lists=folder.json_path_allow_lists, path_ignore=folder.json_path_ignore,
        ),
        redact_html(branch("html"), "text", options),
        redact_xml(branch("xml"), "text", options),
        redact_csv_text(branch("csv").filter(~tabs), "text", options),
        redact_csv_text(branch("csv").filter(tabs), "text", options, "\t"),
    ]
    done = plain
    for other in others:
        done = done.unionByName(
            other.select("path", "redacted_text", "entities_found", "status", "error")
        )
    return done


def summarize(results: DataFrame) -> DataFrame:
    """One row: routed files, result rows and their outcomes."""
    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return results.agg(
        (F.count("*") - count("skipped")).alias("total_files"),
        F.count("*").alias("total_processed"),
        count("success").alias("succeeded"),
        count("error").alias("failed"),
        count("skipped").alias("skipped"),
    )


def inventory_totals(files: DataFrame) -> DataFrame:
    """Files, directories and bytes of an inventory(path, size)."""
    totals = files.agg(
        F.count("*").alias("total_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size_bytes")
    )
    folders = directories(files).agg(F.count("*").alias("total_directories"))
    # Two one-row aggregates side by side.
    return totals.withColumn("k", F.lit(1)).join(folders.withColumn("k", F.lit(1)), "k").select(
        "total_files", "total_directories", "total_size_bytes"
    )


def directories(files: DataFrame) -> DataFrame:
    """All directories that hold a file, with a trailing slash."""
    segments = F.split("path", "/")
    above = F.when(
        F.size(segments) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(segments) - 1),
            lambda n: F.concat(F.array_join(F.slice(segments, F.lit(1), n), "/"), F.lit("/")),
        ),
    )
    # Parents are combined per task first: a directory of many files is one row per task.
    return files.select(F.explode(above).alias("directory")).distinct()


@dataclass(frozen=True)
class FolderJob:
    """Lazy results of a folder job."""

    outputs: DataFrame
    results: DataFrame
    summary: DataFrame


def deidentify_folder(
    spark: SparkSession,
    source: str,
    options: RedactOptions = RedactOptions(),
    folder: FolderOptions = FolderOptions(),
) -> FolderJob:
    """Redact a file tree: outputs(output_path, redacted_text), results and summary."""
    # Listed, and planned, once: names are redacted here and nowhere else.
    work = stored(plan_work(listing(spark, source, None), options, folder), "folder_work")
    wanted = work.filter(F.col("reason").isNull())
    # Texts are written by route, so that each route reads its own files only.
    route = route_of(base_name(F.col("path")))
    texts = stored(read_listed(wanted, source).withColumn("route", route), "folder_texts", ["route"])
    done = redact_routes(texts, options, folder)
    if folder.deidentify_names:
        placed = done.join(with_outputs(work).select("path", "output_path"), "path")
    else:
        placed = done.withColumn("output_path", F.col("path"))
    outputs = placed.filter(F.col("status") == "success").select(
        "path", "output_path", "redacted_text", "entities_found"
    )
    results = placed.select(
        F.col("path").alias("source"),
        F.when(F.col("status") == "success", F.col("output_path")).otherwise("").alias("output"),
        "status", "error",
    ).unionByName(skipped_results(work))
    return FolderJob(outputs, results, summarize(results))


__all__ = [
    "FolderJob", "FolderOptions", "deidentify_folder", "describe", "directories",
    "distinct_names", "inventory_totals", "plan_work", "redact_routes", "redacted_name",
    "redacted_path", "skipped_at", "skipped_results", "summarize", "with_outputs",
]
