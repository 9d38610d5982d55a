"""URL filter against the rules read plainly, and cascades against sets."""

import pytest
from pyspark.sql import functions as F

from upkeep.llm import queries, url_filter


def brute(pages, rules, hosts):
    out = []
    for page, url in pages:
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
            tail = rest[end:]
            path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
        fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit)[2:] if fit else (None, None)
        parents = {host.split(".", i)[-1] for i in range(host.count(".") + 1)}
        out.append((page, host, path, rule, verdict or ("block" if parents & hosts else "allow")))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def unsafe(pages):
    every = {r[1] for r in brute(pages, [], set())}
    return {h for h in every if set(h.replace("-", ".").split(".")) & set(url_filter.UNSAFE_HOST_WORDS)}


def test_query(spark, sf_dir):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    want = brute(pages, url_filter.RULES, unsafe(pages))
    assert {r[3] for r in want} >= {None, "org/", "com/fr/", "com/de/"} and {r[4] for r in want if r[3] is None} == {"allow", "block"}
    df = queries.op5_url_filter(spark, sf_dir)
    assert got(df) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTPS://EXAMPLE.ORG/es/x?y#z", "http://a.b.example.org/en/12", "http://example.org/en/",
    "http://org", "http://org/", "http://notorg/", "http://x.org?/", "http://x.org#/", "http://x.org/?q=http://y.com/de/", "http://a..com/de/x",
    "http://com/fr/", "http://x.com/FR/", "http://É.com/fr/é", "http://x.spam-farm.net/", "http://spam-farm.net/a", "http://y.net:80/de/",
    "x://user@com/fr/", "http://x.com/de/" + "p" * 5000, "a\nb://h.org/e\ns/", "http://x.com/de/", "http://x.com/de/",
]


@pytest.mark.parametrize("limit", [url_filter.MAX_LISTED, 0])
def test_edges(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "MAX_LISTED", limit or 2)
    pages = [*enumerate(URLS), (None, "http://x.com/de/")]
    df = spark.createDataFrame([(p, u, "clash", 1) for p, u in pages], "page_id bigint, url string, host string, rule int")
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    out = url_filter.filter_urls(df, rules, url_filter.unsafe_hosts(df))
    assert got(out) == brute(pages, url_filter.RULES, unsafe(pages))


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert url_filter.filter_urls(pages, rules, url_filter.unsafe_hosts(pages)).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert got(url_filter.filter_urls(one, rules, url_filter.unsafe_hosts(pages))) == [(1, "a.org", "/", None, "allow")]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("cast(substring(key, 2) as int) % 7 = 3")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    kept = universe.where(cascade.has(F.col("key")))
    assert kept.exceptAll(listed).count() == 0 and kept.count() == listed.count()


@pytest.mark.parametrize("listed_of_seven", [3, -1])
def test_sharded_cascade_is_exact_over_its_universe(spark, monkeypatch, listed_of_seven):
    monkeypatch.setattr(url_filter, "SHARD_KEYS", 128)
    monkeypatch.setattr(url_filter, "ROWS_PER_TASK", 64)
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(f"cast(substring(key, 2) as int) % 7 = {listed_of_seven}")
    cascade = url_filter.build_shards(listed, universe)
    kept = cascade.holding(universe, 4000)
    assert kept.exceptAll(listed).count() == 0 and kept.count() == listed.count()
    if listed_of_seven >= 0:
        assert cascade.shards == 5 and cascade.table.count() == 5
        assert cascade.table.selectExpr("max(size(levels))").first()[0] > 2


def test_keys_that_agree_in_no_level(spark):
    """Levels hash anew: a list that is nearly the whole universe still ends."""
    universe = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key != 'k7'")
    assert [r.key for r in universe.where(~url_filter.build_cascade(listed, universe).has(F.col("key"))).collect()] == ["k7"]
