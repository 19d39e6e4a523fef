"""URL filter and sharding."""

import zlib

from pyspark.sql import functions as F

from millrace.llm import bloom_cascade, hash_tree

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/fr/", "block"), ("net", "", "allow"), ("twice.org", "/", "allow"), ("twice.org", "/", "block"), (None, "/", "block"),
]
URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/x?q#f", "http://a.b.example.com/en/", "http://example.com/EN/",
    "http://com/", "http://example.com", "http://xexample.com/en/", "ftp://x.net/fr/?a", "http://x.net?fr", "http://x.net/fr",
    "http://twice.org/z", "no scheme", "", None, "http://", "http:///en/", "a://b://c.com/", "http://example.com./en/",
    "http://example.com/en/1", "http://" + "a." * 3000 + "net/fr/" + "p" * 50000, "http://user@example.com:80/en/",
]


def rule_of(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = rest[:end].translate(str.maketrans(bloom_cascade.UPPER, bloom_cascade.LOWER))
        path = rest[end:].split("?")[0].split("#")[0]
    fit = [
        (len(h + p), len(h), h + p) for h, p, _ in RULES
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule = max(fit)[2] if fit else None
    said = {v for h, p, v in RULES if h is not None and h + p == rule}
    return host, path, rule, "block" if "block" in said else "allow" if said else "other"


def judged(spark, urls, rules=RULES, **kw):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "id int, url string, host string, verdict string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    return bloom_cascade.judge_urls(pages, "url", listed, "other", **kw)


def test_urls_against_plain_rules(spark):
    got = judged(spark, URLS)
    assert got.columns == ["id", "url", "host", "path", "rule", "verdict"]
    for row in got.collect():
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == rule_of(row["url"]), row["url"][:60]


def test_a_list_cut_into_parts_judges_alike(spark):
    whole, parts = judged(spark, URLS).collect(), judged(spark, URLS, max_filter_bytes=16).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))


def test_no_rules_and_no_pages(spark):
    assert {(r["rule"], r["verdict"]) for r in judged(spark, URLS, []).collect()} == {(None, "other")}
    assert judged(spark, []).collect() == []


def test_a_cascade_answers_exactly_for_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key LIKE 'k1%7'").union(spark.createDataFrame([("away",), (None,)], "key string"))
    levels = bloom_cascade.cascade(universe, listed, 20000)
    assert len(levels) > 1
    said = universe.select("key", bloom_cascade.member(F.col("key"), levels).alias("m"))
    assert said.where("m <> (key LIKE 'k1%7')").count() == 0


DOCS = [(i, f"text {i % 7} ñ" * (i % 5), "z") for i in range(500)] + [
    (7, "text 0 ñ", "z"), (600, None, "z"), (601, "", "z"), (None, "x", "z"), (3, "text 3 ñ" * 3, "z"), (3, "text 3 ñ" * 3, "z"), (602, "w" * 300_000, "z"),
]


def shards(spark, rows, *args):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    return hash_tree.shard_documents(docs, *args).collect()


def test_sharding_of_odd_rows(spark):
    got = shards(spark, DOCS, 12, 9)
    assert len(got) == len(DOCS)
    text = {i: t for i, t, _ in DOCS if i is not None and i > 599}
    for row in got:
        assert 0 <= row["shard"] < 12 and row["law"] == "key"
        assert row["grown_shard"] in (row["shard"], 12)
        if row["doc_id"] in text:
            t = text[row["doc_id"]]
            assert row["size"] == len((t or "").encode()) + 16
            assert row["text_crc32"] == (None if t is None else zlib.crc32(t.encode()))
    of = {}
    for row in got:
        assert of.setdefault(row["doc_id"], row["shard"]) == row["shard"]
    for s in range(12):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert shards(spark, [], 4) == []


def test_each_added_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    trees = [hash_tree.layout(n, 10) for n in (10, 11, 12, 13)]
    rows = ids.select(*[hash_tree.assign(F.col("k"), t).alias(str(len(t))) for t in trees]).collect()
    for small, large in ((10, 11), (11, 12), (12, 13)):
        moved = [r for r in rows if r[str(small)] != r[str(large)]]
        assert moved and all(r[str(large)] == large - 1 for r in moved)
    counts = [sum(r["13"] == s for r in rows) for s in range(13)]
    assert min(counts) > 0.75 * 4000 / 13 and max(counts) < 1.25 * 4000 / 13


def test_a_weight_moves_rows_only_through_its_subtree(spark):
    before = hash_tree.layout(16, 16)
    after = [hash_tree.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else x.weight) for x in before]
    ids = spark.range(6000).select(F.col("id").cast("string").alias("k"))
    rows = ids.select(hash_tree.assign(F.col("k"), before).alias("a"), hash_tree.assign(F.col("k"), after).alias("b")).collect()
    region = {x.shard: x.region for x in before}
    for r in rows:
        if region[r["a"]] != region[r["b"]]:
            assert region[r["b"]] == region[5]
        if r["a"] != r["b"] and region[r["a"]] == region[5] == region[r["b"]]:
            assert r["b"] in (4, 5, 6, 7)
    assert 2 < sum(r["b"] == 5 for r in rows) / sum(r["a"] == 5 for r in rows) < 3.3
