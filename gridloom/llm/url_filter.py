"""URL filters: rules on host and path, and a cascade of Bloom filters over the corpus's keys.

The keys of a url are its host and all parent domains. The distinct keys of the whole corpus are the
universe. Level 0 of the cascade encodes the listed keys, level 1 those other keys that pass level 0,
level 2 the listed keys that pass level 1, and so on until nothing passes wrongly: membership is exact
for every key of the universe, and no row is joined with the list. All levels are built and read with
built-in functions. The keys are divided by a hash into shards, each with a cascade of bounded size, which
are applied one after the other: a list of any length is judged in the same way.

Edge cases: a null url or one without ``://`` has an empty host and path, no keys, no rule and the
verdict ``allow``. Repeated rows are judged alike. An empty table gives an empty result. The result has
only the columns named here, so extra input columns can't clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, read, spool

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: About the size of a shard's cascade, which is a literal of the plan.
MOST_BYTES = 16 << 20
#: Shards whose cascades one pass over the rows holds: 64 MB of bits.
PER_PASS = 4
#: Bits of a Bloom filter that are put together in one row.
BLOCK = 1 << 15


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its bits, packed, and the number of hash functions."""

    number: int
    bits: int
    hashes: int
    packed: bytes

    def places(self, key: Column) -> list[Column]:
        return places(key, self.number, self.bits, self.hashes)

    def has(self, key: Column) -> Column:
        packed = F.lit(self.packed)
        found = F.lit(True)
        for at in self.places(key):
            byte = F.conv(F.hex(F.substring(packed, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1)
        return found


def places(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))), F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parent domains, longest first; none for an empty host."""
    cut = F.split(host, r"\.")
    n = F.size(cut)
    all_of = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(cut, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(all_of)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards).cast("long"))


def rate_of(inside: int, others: int) -> float:
    """The share of other keys that level 0 may let pass: about as many of them as there are listed keys."""
    return min(0.5, max(1e-9, math.sqrt(0.5) * inside / max(others, 1)))


def shards_for(inside: int, others: int, most_bytes: int) -> int:
    """How many shards keep each cascade at about most_bytes; the levels after the first halve from one to the next but one."""
    rate = rate_of(inside, others)
    return max(1, math.ceil(1.4427 * (inside * math.log2(1 / rate) + 2 * others * rate + inside) / 8 / most_bytes))


def packed_bits(at: DataFrame, bits: int) -> bytes:
    """The bits numbered in the column at, as bytes; they reach the driver in rows of BLOCK bits."""
    inner = F.col("at").bitwiseAND(F.lit(7)) + 56 - F.shiftright(F.col("at"), 3).bitwiseAND(F.lit(7)) * 8
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), inner.cast("int"))).alias("bits"))
    own, size = F.struct((F.col("word") % (BLOCK // 64)).cast("int"), "bits"), BLOCK // 64
    blocks = words.groupBy(F.expr(f"word div {size}").alias("block")).agg(F.map_from_entries(F.collect_list(own)).alias("m"))
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.element_at("m", i), F.lit(0))), 16, "0")), "")
    found = {r["block"]: bytes(r["bytes"]) for r in blocks.select("block", F.unhex(text).alias("bytes")).toLocalIterator()}
    return b"".join(found.get(i, bytes(BLOCK // 8)) for i in range(-(-bits // BLOCK)))[: bits // 8]


def build(universe: DataFrame) -> list[Level]:
    """The cascade for a table (key, listed) of distinct keys."""
    left = {True: universe.where("listed"), False: universe.where("NOT listed")}
    counts = {x["listed"]: x["n"] for x in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    inside, side, levels = counts.get(True, 0), True, []
    while inside:
        rate = 0.5 if levels else rate_of(inside, counts.get(False, 0))
        bits = max(64, 64 * math.ceil(inside * 1.4427 * math.log2(1 / rate) / 64))
        hashes, number = max(1, round(math.log2(1 / rate))), len(levels)
        at = left[side].select(F.explode(F.array(*places(F.col("key"), number, bits, hashes))).alias("at"))
        level = Level(number, bits, hashes, packed_bits(at, bits))
        levels.append(level)
        left[not side] = left[not side].where(level.has(F.col("key")))
        side = not side
        inside = left[side].count()
        if number % 6 == 5:  # a long chain of filters over the universe is cut
            left = {k: spool(v, "cascade") for k, v in left.items()}
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    found = F.lit(False)
    for level in reversed(levels):
        found = level.has(key) & ~found
    return found


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...], *, listed_verdict: str = "block", other_verdict: str = "allow", most_bytes: int = MOST_BYTES) -> DataFrame:
    """Judge each row of pages (page_id, url) by rules, or else by whether a key of its host is listed.

    listed: a table with a column ``key`` of domains, which may be large. Returns page_id, host, path,
    rule (host and path of the longest rule that fits, or null), listed and verdict.
    """
    host, path = parts(F.col("url"))
    found = pages.select("page_id", host.alias("host"), path.alias("path"))
    ordered = sorted(set(rules), key=lambda r: (-len(r.text), r.text))
    best = [((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path) for r in ordered]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, fits in reversed(list(zip(ordered, best, strict=True))):
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    keys = found.select("host").distinct().select(F.explode(domains(F.col("host"))).alias("key")).distinct()
    both = keys.select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed")).union(listed.select(ascii_lower(F.col("key")), F.lit(False), F.lit(True)))
    merged = both.groupBy("key").agg(F.bool_or("seen").alias("seen"), F.bool_or("listed").alias("listed"))
    universe = spool(merged.where(F.col("seen") & F.col("key").isNotNull()).select("key", "listed"), "universe")
    sizes = {r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    shards = shards_for(sizes.get(True, 0), sizes.get(False, 0), most_bytes)
    if shards > 1:  # the keys are dealt to shards once, in folders of their own
        whole, shard = universe, shard_of(F.col("key"), shards).cast("int")
        universe = spool(whole.withColumn("shard", shard).repartition("shard", F.pmod(F.xxhash64("key"), F.lit(8))), "shards", by="shard")
        discard(whole)
    judged, written = found.withColumn("listed", F.lit(False)), None
    for first in range(0, shards, PER_PASS):
        for shard in range(first, min(first + PER_PASS, shards)):
            levels = build(universe.where(F.col("shard") == shard).select("key", "listed") if shards > 1 else universe)
            own = F.filter(domains(F.col("host")), lambda x: shard_of(x, shards) == shard)  # noqa: B023
            judged = judged.withColumn("listed", F.col("listed") | F.exists(own, lambda x: member(levels, x)))  # noqa: B023
        if first + PER_PASS < shards:  # the rows are written once for so many shards, and the bits of those before are done with
            judged = spool(judged, "judged")
            if written is not None:
                discard(written)
            written = judged
    by_list = F.when(F.col("listed"), F.lit(listed_verdict)).otherwise(F.lit(other_verdict))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"), "listed")


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))
#: Domains that the query's list blocks.
LISTED = ("cheap-pills.example.com", "cheap-pills.example.net", "cheap-pills.example.org", "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org")


def op1_url_filter(spark, sf_dir):
    """Every url of pages under RULES and the list of domains."""
    listed = spark.createDataFrame([(x,) for x in LISTED], "key string")
    return judge_urls(read(spark, sf_dir, "pages"), listed, RULES)


OP1_SQL = f"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}),
fit AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path),
listed(k) AS (VALUES {", ".join(f"('{x}')" for x in LISTED)}),
hit AS (SELECT DISTINCT host FROM u JOIN listed ON host = k OR ends_with(host, '.' || k))
SELECT u.page_id, u.host, u.path, rule, coalesce(v, CASE WHEN hit.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  hit.host IS NOT NULL AS listed
FROM u LEFT JOIN fit USING (page_id, host, path) LEFT JOIN hit ON u.host = hit.host
"""
