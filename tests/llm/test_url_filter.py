import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import url_filter as U

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"))
URLS = [
    (1, "http://a.example.com/en/x?q=1"), (2, "https://WWW.Example.com/en/"),
    (3, "http://b.net/es/1#f"), (4, "http://b.net/de/1"), (5, "http://com"), (6, "http://com/"),
    (7, None), (8, ""), (9, "no-scheme/x"), (10, "ftp://notexample.com/en/1"), (4, "http://b.net/de/1"),
    (11, "http://spam.net?x=/es/"), (None, "http://spam.net/a://b"), (12, "http://ÄB.net:80/es/1"),
    (13, "http://b.net\n/es/1"), (14, "http://x.com/" + "y" * 100_000),
]


def _brute(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(r, v) for r, v in RULES for site, _, t in [r.partition("/")]
            if (host == site or host.endswith("." + site)) and path.startswith("/" + t)]
    if fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    return host, path, None, "block" if host.startswith("spam") else "allow"


def test_urls_equal_brute_force(frame):
    pages = frame(URLS, "page_id bigint, url string, html string, host string, listed string")
    got = U.filter_urls(pages, F.col("host").startswith("spam"), RULES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *_brute(u))) for i, u in URLS)


def test_no_pages(frame):
    pages = frame([], "page_id bigint, url string")
    assert U.filter_urls(pages, F.lit(True), RULES).collect() == []


@pytest.mark.parametrize("shard_keys,block_bytes", [(10**6, 10**9), (300, 200)])
def test_cascade_is_exact_over_its_universe(spark, shard_keys, block_bytes):
    keys = spark.range(3000).select(
        F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed")
    )
    # One key holds a third of all rows, some of them unlisted.
    keys = keys.unionByName(spark.range(1500).select(
        F.lit("host0").alias("key"), F.lit(None).cast("boolean").alias("listed")))
    filters, shards = U.build(keys, shard_keys)
    assert (shards > 1) == (shard_keys < 3000)
    judged = U.judge(keys.select("key"), "key", filters, shards, block_bytes=block_bytes)
    wrong = judged.filter(F.col("listed") != (F.substr("key", F.lit(5)).cast("int") % 7 == 0))
    assert judged.count() == 4500 and wrong.count() == 0


def test_levels_alternate_and_shrink():
    random = np.random.default_rng(1)
    low, high = random.integers(0, 2**63, (2, 50_000), dtype=np.uint64)
    listed = np.arange(50_000) % 10 == 0
    levels = U.build_levels(low, high, listed)
    assert (U.is_listed(levels, low, high) == listed).all()
    assert len(levels) > 2 and sum(len(x["filter"]) for x in levels) < 5_000 * 2
    assert not U.is_listed([], low, high).any()
    everything = U.build_levels(low, high, np.ones(50_000, bool))
    assert U.is_listed(everything, low, high).all()


def test_equal_hashes_of_both_sides_are_refused():
    same = np.ones(2, dtype=np.uint64)
    with pytest.raises(ValueError):
        U.build_levels(same, same, np.array([True, False]))


def test_a_table_of_listed_hosts(frame, spark):
    """The table names the keys; odd rows of it do no harm, other hosts stay."""
    pages = frame(URLS, "page_id bigint, url string, html string, key string")
    keys = [("spam.net",), ("spam.net",), (None,), ("never.seen",), ("b.net",), ("com",)]
    listed = spark.createDataFrame(keys, "key string")
    got = {str(r["page_id"]): r["verdict"] for r in U.filter_urls(pages, listed, RULES).collect()}
    assert got["11"] == "block" and got["None"] == "block"
    assert got["4"] == got["3"] == got["5"] == "block"  # /de/ by the list, /es/ by the rule
    assert got["6"] == "allow" and got["10"] == "allow" and got["7"] == "allow"
    none = U.filter_urls(pages, listed.limit(0), ()).collect()
    assert len(none) == len(URLS) and {r["verdict"] for r in none} == {"allow"}


def test_the_query_lists_some_hosts_and_not_others(spark, folder):
    from maskwright.llm.queries import QUERIES

    done = QUERIES["op3_url_filter"](spark, folder).filter("rule IS NULL")
    by_list = done.groupBy("verdict").count().collect()
    assert {r["verdict"] for r in by_list} == {"allow", "block"}
