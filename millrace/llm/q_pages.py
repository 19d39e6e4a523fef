"""Queries over web pages: main text, archives."""

from __future__ import annotations

from ..session import scratch_path
from . import templates, warc
from .catalog import query, table

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query("op6_templates")
def op6_templates(spark, sf):
    return templates.extract_text(table(spark, sf, "pages"))


@query(
    "op8_warc",
    f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, max(page_id) OVER (PARTITION BY b) AS keeper,
        list_aggregate(list_transform(range(32), lambda i: '{_ALPHABET}'[
            (('0x' || h[i // 4 * 5 + 1:i // 4 * 5 + 5])::INT >> (15 - 5 * (i % 4))) % 32 + 1]), 'string_agg', '') AS payload_digest FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM d""",
)
def op8_warc(spark, sf):
    folder = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf, "pages"), folder)
    return warc.read_archive(spark, folder).drop("url")
