import random

from pyspark.sql import functions as F

from gridloom.llm.url_filter import RULES, Rule, build, judge_urls, member, packed_bits, shards_for


def plain(url, listed, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    parts = host.split(".")
    hit = bool(host) and any(".".join(parts[i:]) in listed for i in range(len(parts)))
    return host, path, best.text if best else None, best.verdict if best else ("block" if hit else "allow"), hit


def test_same_as_sets(spark):
    rng = random.Random(4)
    names = ["a", "b", "bad", "Xy", "é", "", "example", "spam-farm", "www"]
    urls = [None, "", "no scheme", "http://", "http:///x", "https://EXAMPLE.org/en/1?q", "x://org", "x://org/", "a://b.com/fr/://c"]
    urls += [f"http{rng.choice(['', 's'])}://{'.'.join(rng.choice(names) for _ in range(rng.randint(1, 4)))}.{rng.choice(['org', 'com', 'net'])}{rng.choice(['', '/', '/fr/x', '/de/', '/en/12', '?a', '#b', '/es/?x'])}" for _ in range(400)]
    listed = {"bad.com", "spam-farm.net", "b.bad.org", "example.net", "not.there"}
    df = spark.createDataFrame([(i, u, "n", "x", "r", "v", True) for i, u in enumerate(urls)] * 2, "page_id long, url string, host string, key string, rule string, verdict string, listed boolean").repartition(3)
    keys = spark.createDataFrame([(x.upper() if x != "not.there" else x,) for x in listed] + [(None,)], "key string")
    for most in (1 << 20, 3):
        got = judge_urls(df, keys, RULES, most_bytes=most).collect()
        assert len(got) == 2 * len(urls)
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict, r.listed) == plain(urls[r.page_id], listed, RULES)
    assert judge_urls(df.limit(0), keys, (Rule("org", "/", "allow"),)).count() == 0
    assert judge_urls(df, keys.limit(0), ()).where("verdict <> 'allow'").count() == 0


def test_cascade_is_exact_for_its_universe(spark):
    universe = spark.range(6000).selectExpr("concat('k', id) AS key", "id % 7 = 0 AS listed")
    levels = build(universe)
    assert len(levels) > 2 and sum(x.bits for x in levels) < 6000 * 4
    assert universe.where(member(levels, universe["key"]) != universe["listed"]).count() == 0


def test_bits_are_packed_whole(spark):
    rng = random.Random(8)
    at = {rng.randrange(200_000) for _ in range(3000)} | {0, 63, 64, 199_999}
    packed = packed_bits(spark.createDataFrame([(x,) for x in [*at, *list(at)[:50]]], "at long"), 200_000)
    assert {i for i in range(200_000) if packed[i >> 3] >> (i & 7) & 1} == at and len(packed) == 25_000


def test_long_lists_go_by_shards(spark):
    assert shards_for(3000, 9000, 1 << 20) == 1 and shards_for(3000, 9000, 500) > 3
    pages = spark.range(4000).selectExpr("id AS page_id", "concat('http://h', id, '.net/x') AS url")
    keys = spark.range(4000).where("id % 3 = 0").select(F.concat(F.lit("h"), "id", F.lit(".net")).alias("key"))
    judged = judge_urls(pages, keys, (), most_bytes=500)
    assert judged.where("(verdict = 'block') <> (page_id % 3 = 0)").count() == 0 and judged.count() == 4000
