"""Headline queries, timed end to end; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from maskwright.queries import QUERIES
from maskwright.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINES = (
    "r2_redact_text", "r4_spans", "r5_overlaps", "r8_handling_per_label", "r10_synthesis",
    "r14_generator_versions", "r16_swaps", "r19_allow_lists", "r23_dictionary",
    "a8_label_profile", "t1_redact_json", "t4_redact_xml", "t5_redact_html", "f7_output_paths",
    "f9_summary", "m3_exact_scores_per_file", "m3_overlap_scores_per_file", "w1_latest_row",
    "g13_list_totals", "z1_redact_stream",
)


REPEAT_BELOW = 15


def timed(spark: SparkSession, name: str) -> float:
    began = time.perf_counter()
    # The noop sink computes every row and column; a count would prune most of them.
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = local_session(CPUS, memory="16g", app="bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINES:
        runs = [timed(spark, name)]
        # The first run warms the session and compiles; short queries are run three times.
        while len(runs) < 3 and runs[0] < REPEAT_BELOW:
            runs.append(timed(spark, name))
        seconds[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "total time of the headline queries (median of three runs where the first is short)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
