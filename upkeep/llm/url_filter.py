"""URL filter lists as Bloom filter cascades, in SQL functions only.

A cascade gives exact membership for every key of a known universe: level 0 is a Bloom filter of the listed keys, level 1
one of the universe's keys that level 0 takes falsely, level 2 one of the listed keys that level 1 takes, and so on until
nothing is taken falsely. A key is listed if the first level that refuses it is odd-numbered (or none refuses and their
number is odd). The universe here is every key that any url of the corpus can ask for, so the answers are exact.

The first level's rate follows the ratio of listed keys to universe, so all levels together take some tens of bits a
listed key; they are put into the plan as literals. Lists of more than ``MAX_LISTED`` keys do not get a cascade but an
equi-join on distinct urls, with the same result.

Rules are keys ``host + path``: they fit their host and its subdomains if the url's path starts with the rule's path; the
longest fitting rule gives the verdict (of equally long ones the one with the longer host). Urls that no rule fits are
judged by the listed hosts: ``block`` if the url's host or a parent domain is listed, else ``allow``.

Null urls and urls without ``://`` have an empty host and path and are allowed; repeated rows are judged each; extra
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import written

MAX_LISTED = 1 << 17
SHARD_KEYS = 1 << 12
ROWS_PER_TASK = 1 << 20

# fixed values: rules (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# words that put a host of the corpus on the list of blocked hosts
UNSAFE_HOST_WORDS = ["ads", "adult", "bets", "casino", "malware", "phishing", "pills", "poker", "porn", "spam", "viagra", "xxx"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + F.lit(1), F.size(labels)), "."))


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every rule that could fit: each host suffix with each prefix of the path that has a rule path's length."""
    starts = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: F.length(path) >= n)
    return F.flatten(
        F.transform(host_suffixes(host), lambda h: F.transform(starts, lambda n: F.concat(h, F.substring(path, F.lit(1), n))))
    )


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: str  # 64-bit words, comma-separated

    def takes(self, key: Column) -> Column:
        table = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to one literal by the optimizer
        out = F.lit(True)
        for p in positions(key, self.number, self.bits, self.hashes):
            word = F.get(table, F.shiftright(p, 6).cast("int"))
            out = out & (F.getbit(word, p.bitwiseAND(F.lit(63))) == F.lit(1))
        return out


def positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    a, b = F.xxhash64(F.lit(2 * number), key), F.xxhash64(F.lit(2 * number + 1), key)  # numbers first: levels are independent
    # both are reduced first, so the sum cannot overflow
    a, b = F.pmod(a, F.lit(bits).cast("bigint")), F.pmod(b, F.lit(bits).cast("bigint"))
    return [F.pmod(a + F.lit(i) * b, F.lit(bits).cast("bigint")) for i in range(hashes)]


def hash_count(rate: float) -> int:
    return max(1, round(-math.log2(rate)))


def first_rate(listed: int, asked: int) -> float:
    return min(0.5, max(2.0**-40, math.sqrt(0.5) * listed / max(1, asked)))


def bloom_level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A Bloom filter of ``keys`` (column key): its words are ORed by word number, so at most ``bits / 64`` rows return."""
    hashes = hash_count(rate)
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), number, bits, hashes))).alias("p"))
    rows = (
        at.groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
        .collect()
    )
    words = [0] * (bits // 64)
    for w, b in rows:
        words[w] = b
    return Level(number, bits, hashes, ",".join(map(str, words)))


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def has(self, key: Column) -> Column:
        out = None
        for level in reversed(self.levels):
            out = level.takes(key) if out is None else level.takes(key) & ~out
        return F.lit(False) if out is None else out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade exact for ``listed`` and every key of ``universe`` (both: column key; repeats do no harm)."""
    listed = written(listed.where("key is not null").distinct(), "listed")
    count = listed.count()
    if not count:
        return Cascade([])
    asked = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels = [bloom_level(listed, 0, count, first_rate(count, asked))]
    inside, outside = listed, universe
    while True:  # every level hashes anew and takes about half of the keys falsely, so the levels end
        taken = outside.where(levels[-1].takes(F.col("key"))).select("key").distinct()
        if len(levels) == 1:
            taken = taken.join(listed, "key", "left_anti")
        taken = written(taken, "taken")
        size = taken.count()
        if not size:
            return Cascade(levels)
        levels.append(bloom_level(taken, len(levels), size, 0.5))
        inside, outside = taken, inside


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)).cast("int")


def _places(key: Column, number: Column, bits: Column, hashes: Column) -> Column:
    """``positions`` for a filter whose size stands in columns."""
    a = F.pmod(F.xxhash64(number * F.lit(2), key), bits)
    b = F.pmod(F.xxhash64(number * F.lit(2) + F.lit(1), key), bits)
    return F.transform(F.sequence(F.lit(0), hashes - F.lit(1)), lambda i: F.pmod(a + i * b, bits))


def _taken(key: Column, level: Column) -> Column:
    places = _places(key, level["number"], level["bits"], level["hashes"])
    return F.forall(places, lambda p: F.getbit(F.get(level["words"], F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63))) == F.lit(1))


def _beside(keys: DataFrame, table: DataFrame, shards: int, rows: int) -> DataFrame:
    """``keys`` (with shard) joined with the row of their shard; the keys of a shard are dealt to tasks of about ``ROWS_PER_TASK``."""
    salts = -(-rows // (ROWS_PER_TASK * shards))
    dealt = keys.withColumn("_salt", F.pmod(F.xxhash64(*keys.columns), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, ["shard", "_salt"]).drop("_salt")


def _shard_level(keys: DataFrame, number: int, hashes: int) -> DataFrame:
    """(shard, level): a Bloom filter of the ``keys`` (key, shard) of each shard that has any."""
    bits = F.greatest(F.lit(64), F.lit(64) * F.ceil(F.count("*") * F.lit(hashes / math.log(2) / 64))).cast("bigint")
    sized = written(keys.groupBy("shard").agg(bits.alias("bits")), "shard-sizes")
    every = sized.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("bits div 64 - 1"))).alias("w"), F.lit(0).cast("bigint").alias("v"))
    at = keys.join(sized, "shard").select("shard", F.explode(_places(F.col("key"), F.lit(number), F.col("bits"), F.lit(hashes))).alias("p"))
    ones = at.select("shard", F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("v"))
    words = every.unionByName(ones).groupBy("shard", "w").agg(F.bit_or("v").alias("v"))
    words = words.groupBy("shard").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("words"))
    level = F.struct(F.lit(number).alias("number"), (F.size("words").cast("bigint") * F.lit(64)).alias("bits"), F.lit(hashes).alias("hashes"), "words")
    return written(words.select("shard", level.alias("level")), "shard-level")


@dataclass(frozen=True)
class ShardedCascade:
    table: DataFrame  # shard, levels
    shards: int

    def holding(self, keys: DataFrame, rows: int) -> DataFrame:
        """The rows of ``keys`` (about ``rows``; column key) whose key is listed."""
        found = _beside(keys.withColumn("shard", _shard(F.col("key"), self.shards)), self.table, self.shards, rows)
        refused = F.array_position(F.transform("levels", lambda level: _taken(F.col("key"), level)), F.lit(False))
        listed = F.when(refused > 0, refused % 2 == 0).otherwise(F.size("levels") % 2 == 1)
        return found.where(listed).select(*keys.columns)


def build_shards(listed: DataFrame, universe: DataFrame) -> ShardedCascade:
    """The same as ``build_cascade``, split by a hash of the key; the keys of all shards make a level together, in one job."""
    count = listed.agg(F.count("key")).first()[0]
    shards = max(1, -(-count // SHARD_KEYS))

    def dealt(keys: DataFrame, name: str) -> DataFrame:
        return written(keys.where("key is not null").select("key").distinct().withColumn("shard", _shard(F.col("key"), shards)), name)

    inside, outside = dealt(listed, "listed"), dealt(universe, "universe")
    everything, sizes = inside, (inside.count(), outside.count())
    hashes, levels = hash_count(first_rate(*sizes)), []
    while sizes[0]:
        level = _shard_level(inside, len(levels), hashes)
        levels.append(level)
        taken = _beside(outside, level, shards, max(1, sizes[1])).where(_taken(F.col("key"), F.col("level"))).select("key", "shard")
        if len(levels) == 1:
            taken = taken.join(everything, ["key", "shard"], "left_anti")
        taken = written(taken, "taken")
        inside, outside, sizes, hashes = taken, inside, (taken.count(), sizes[0]), hash_count(0.5)
    spark = listed.sparkSession
    if not levels:
        kind = "struct<number: int, bits: bigint, hashes: int, words: array<bigint>>"
        return ShardedCascade(spark.createDataFrame([], f"shard int, levels array<{kind}>"), shards)
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = table.groupBy("shard").agg(F.array_sort(F.collect_list("level")).alias("levels"))
    return ShardedCascade(written(table, "cascades"), shards)


def filter_urls(pages: DataFrame, rules: DataFrame, hosts: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, listed_host.

    ``rules``: verdict, host, path. ``hosts``: key, a blocked host.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    named = rules.select(F.concat("host", "path").alias("key"), "verdict", F.length("path").alias("n"))
    named = written(named.where("key is not null"), "rules")
    lengths = [r["n"] for r in named.select("n").distinct().orderBy("n").collect()]
    asked = rule_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")
    hosts = written(hosts.select("key").distinct(), "blocked-hosts")
    if named.count() > MAX_LISTED or hosts.count() > MAX_LISTED:
        return _by_shards(parts, asked, named, hosts)

    fits = build_cascade(named.select("key"), parts.select(F.explode(asked).alias("key")))
    blocks = build_cascade(named.where("verdict = 'block'").select("key"), named.select("key"))
    blocked = build_cascade(hosts, parts.select(F.explode(host_suffixes(F.col("host"))).alias("key")))
    found = parts.withColumn("_asked", asked)
    # keys come with the longest host first; of equally long rules the first, which has the longest host, is kept
    fitting = F.filter("_asked", fits.has)
    longest = F.array_max(F.transform("_fitting", F.length))
    rule = F.get(F.filter("_fitting", lambda k: F.length(k) == longest), F.lit(0))
    found = found.withColumn("_fitting", fitting).withColumn("rule", rule)
    listed = F.get(F.filter(host_suffixes(F.col("host")), blocked.has), F.lit(0))
    found = found.withColumn("listed_host", listed)
    verdict = F.when(F.col("rule").isNotNull(), F.when(blocks.has(F.col("rule")), "block").otherwise("allow")).otherwise(
        F.when(F.col("listed_host").isNotNull(), "block").otherwise("allow")
    )
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed_host")


def _by_shards(parts: DataFrame, asked: Column, named: DataFrame, hosts: DataFrame) -> DataFrame:
    """The same with sharded cascades; distinct (host, path) pairs ask, never rows."""
    urls = written(parts.select("host", "path").distinct(), "urls")
    keys = written(urls.select("host", "path", F.posexplode(asked).alias("at", "key")), "asked-rules")
    fits = build_shards(named.select("key"), keys.select("key")).holding(keys, max(1, keys.count()))
    longest = F.max_by("key", F.struct(F.length("key"), -F.col("at"))).alias("rule")
    rule = written(fits.groupBy("host", "path").agg(longest), "fitting")
    found = rule.select("host", "path", F.col("rule").alias("key"))
    blocks = build_shards(named.where("verdict = 'block'").select("key"), named.select("key"))
    blocks = blocks.holding(found, max(1, found.count())).select("host", "path", F.lit(True).alias("blocks"))
    rule = rule.join(blocks, ["host", "path"], "left")

    suffixes = urls.select("host").distinct().select("host", F.posexplode(host_suffixes(F.col("host"))).alias("at", "key"))
    suffixes = written(suffixes, "asked-hosts")
    listed = build_shards(hosts, suffixes.select("key")).holding(suffixes, max(1, suffixes.count()))
    listed = listed.groupBy("host").agg(F.min_by("key", "at").alias("listed_host"))
    found = parts.join(rule, ["host", "path"], "left").join(listed, "host", "left")
    by_rule = F.when(F.col("rule").isNotNull(), F.when(F.col("blocks"), "block").otherwise("allow"))
    verdict = F.coalesce(by_rule, F.when(F.col("listed_host").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed_host")


def unsafe_hosts(pages: DataFrame, words: list[str] = UNSAFE_HOST_WORDS) -> DataFrame:
    """Hosts of the corpus with an unsafe word among their parts."""
    host, _ = url_parts(F.col("url"))
    hosts = pages.select(host.alias("key")).distinct()
    return hosts.where(F.arrays_overlap(F.split("key", r"[.\-]"), F.array(*(F.lit(w) for w in words))))
