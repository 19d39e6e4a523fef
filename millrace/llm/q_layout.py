"""Queries of the URL filter and of sharding."""

from __future__ import annotations

from . import bloom_cascade, hash_tree
from .catalog import query, table

#: The rules of the query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
SHARDS = 40

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op4_bloom_cascade",
    rf"""WITH rules(rh, rp, v) AS (VALUES {_RULES_SQL}),
    cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] END AS rest FROM pages),
    parsed AS (SELECT page_id,
        translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{bloom_cascade.UPPER}', '{bloom_cascade.LOWER}') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
    fit AS (SELECT page_id, max_by(struct_pack(rule := rh || rp, verdict := v), length(rh || rp)) AS best
        FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
    FROM parsed LEFT JOIN fit USING (page_id)""",
)
def op4_bloom_cascade(spark, sf):
    rules = spark.sql(f"SELECT * FROM VALUES {_RULES_SQL} AS rules(host, path, verdict)")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return bloom_cascade.judge_urls(pages, "url", rules).drop("url")


def _draw_sql(level: str, node: str, weight: str = "weight") -> str:
    digest = f"md5('{level}:' || {node} || ':' || doc_id)"
    return f"-ln((CAST('0x' || {digest}[1:13] AS BIGINT) + 0.5) / {float(1 << 52)}) / {weight}"


def _tree_sql(name: str, shards: int) -> str:
    leaves = ", ".join(f"({x.region}, {x.rack}, {x.shard}, {x.weight})" for x in hash_tree.layout(shards, SHARDS))
    return f"""{name}_leaf(region, rack, shard, w) AS (VALUES {leaves}),
    {name}_region AS (SELECT doc_id, arg_min(region, {_draw_sql('region', 'region')}) AS region FROM ids,
        (SELECT region, sum(w)::DOUBLE AS weight FROM {name}_leaf GROUP BY region) GROUP BY doc_id),
    {name}_rack AS (SELECT doc_id, arg_min(rack, {_draw_sql('rack', 'rack')}) AS rack FROM {name}_region JOIN
        (SELECT region, rack, sum(w)::DOUBLE AS weight FROM {name}_leaf GROUP BY region, rack) USING (region) GROUP BY doc_id),
    {name} AS (SELECT doc_id, arg_min(shard, {_draw_sql('shard', 'shard', 'w::DOUBLE')}) AS shard
        FROM {name}_rack JOIN {name}_leaf USING (rack) GROUP BY doc_id)"""


#: CRC-32 of a text in SQL: the checksum's table, then one step for each byte.
_CRC_SQL = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
    sums AS (SELECT text, xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(text))),
        lambda k: ('0x' || hex(encode(text))[2 * k + 1:2 * k + 2])::BIGINT),
        lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM (SELECT DISTINCT text FROM documents), crc_table)"""


@query(
    "op5_hash_tree",
    f"""WITH ids AS (SELECT DISTINCT doc_id FROM documents), {_tree_sql('now', SHARDS)}, {_tree_sql('grown', SHARDS + 1)},
    {_CRC_SQL},
    placed AS (SELECT d.doc_id, coalesce(octet_length(encode(d.text)), 0) + {hash_tree.RECORD_BYTES} AS size,
        sums.crc AS text_crc32, now.shard, grown.shard AS grown_shard
        FROM documents d JOIN now USING (doc_id) JOIN grown USING (doc_id) LEFT JOIN sums ON sums.text = d.text)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard
        ORDER BY md5(doc_id || ':' || coalesce(text_crc32::VARCHAR, '-') || ':' || size)) - 1 AS slot, grown_shard FROM placed""",
)
def op5_hash_tree(spark, sf):
    return hash_tree.shard_documents(table(spark, sf, "documents").select("doc_id", "text"), SHARDS)
