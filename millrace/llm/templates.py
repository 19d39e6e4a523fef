"""Main text of web pages, without the templates of their sites.

Element subtrees, within a page's article as well, are hashed and counted by host; a subtree that recurs on many
pages of its host whose text otherwise differs is a template and deleted. Menus, headers, footers, adverts, forms, scripts,
comments and other parts named as such go as well, so that a page that is alone on its host loses them too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom_cascade import MAX_FILTER_BYTES, cascade, filter_bytes, host_and_path, member
from .common import settle
from .page_text import Page, used, without
from .words import mix

#: Different pages of a host on which a template recurs at least.
MIN_PAGES = 10
#: A page tells templates if what is left of its text without all that recurs has so many characters, or such a share of the whole.
OWN_CHARS, OWN_SHARE = 40, 0.25

_PARSED = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("texts", pa.list_(pa.string())), ("elements", pa.list_(pa.int32())),
    ("keys", pa.list_(pa.int64())), ("parents", pa.list_(pa.int32())), ("others", pa.list_(pa.int64())),
])
_TOLD = pa.schema([("key", pa.int64()), ("own", pa.int64())])
_TEXTS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_templates", pa.int64()),
])


def _of_host(keys, host: int) -> np.ndarray:
    """Hashes of subtrees as keys of their host; 0 stays 0."""
    keys = np.array(list(keys), np.uint64)
    return np.where(keys == 0, np.uint64(0), mix(keys ^ np.uint64(host & (1 << 64) - 1)) | np.uint64(1)).view(np.int64)


def _parse(batches):
    """The blocks of the main content, the subtrees that hold them, and the hashes of others."""
    known: dict = {}
    for batch in batches:
        rows: list[tuple] = []
        for h, host in zip(batch.column("html").to_pylist(), batch.column("host").to_pylist()):
            page = Page(h, known)
            _, blocks = page.main_blocks()
            within, others = page.subtrees()
            elements, keys, parents = used([b[2] for b in blocks], within, page.parents)
            rows.append(([b[1] for b in blocks], elements, _of_host(keys, host), parents, _of_host(sorted(others), host)))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_PARSED)[2:])]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], schema=_PARSED)


def _tell(batches):
    """Of pages with a text of their own its hash, with each recurring subtree."""
    for batch in batches:
        found: list[tuple[int, int]] = []
        for r in batch.to_pylist():
            recurring = set(r["recurring"])
            left = without(r["texts"], r["elements"], r["keys"], r["parents"], recurring)
            whole = sum(map(len, r["texts"])) + max(len(r["texts"]) - 1, 0)
            if left and len(left) >= min(OWN_CHARS, OWN_SHARE * whole):
                own = xxhash.xxh3_64_intdigest(left.encode("utf-8", "surrogatepass")) >> 1
                found += [(key, own) for key in recurring]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))], schema=_TOLD)


def _delete(batches):
    """Texts without the subtrees found to be templates."""
    for batch in batches:
        texts = []
        for r in batch.select(["texts", "elements", "keys", "parents", "deleted"]).to_pylist():
            texts.append(without(r["texts"], r["elements"], r["keys"], r["parents"], set(r["deleted"])))
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()), batch.column("n_templates"),
        ], schema=_TEXTS)


def _listed_in(rows: DataFrame, keys: dict[str, Column], universe: DataFrame, size: int, listed: DataFrame, max_filter_bytes: int) -> DataFrame:
    """``rows`` with, for each name in ``keys``, those of an array's keys that are listed, told by Bloom cascades, without a join.

    A list whose filters pass ``max_filter_bytes`` is judged in parts, each in a pass of its own.
    """
    count = listed.count()
    parts = max(1, math.ceil(filter_bytes(count, size) / max_filter_bytes))
    for part in range(parts):
        mine = F.pmod(F.xxhash64("key"), F.lit(parts)) == part
        some, here = (universe.where(mine), listed.where(mine)) if parts > 1 else (universe, listed)
        levels = cascade(some, here, max(1, size // parts))

        def told(key):
            return member(key, levels) if parts == 1 else (F.pmod(F.xxhash64(key), F.lit(parts)) == part) & member(key, levels)

        for name, column in keys.items():
            found = F.filter(F.array_distinct(column), told) if levels else F.array().cast("array<bigint>")
            rows = rows.withColumn(name, F.concat(name, found) if part else found)
        if part < parts - 1:
            rows = settle(rows, "listed_subtrees")
    return rows


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) of every row of ``pages`` (page_id, url, html).

    ``text`` is the article's blocks in page order, joined by newlines: character references decoded,
    white space within a block one blank, ends trimmed. Where the page marks no article, the main
    element counts, and without that the whole page. A subtree of the text, within an article a container only, is a template and deleted
    where it stands on at least ``min_pages`` pages of the host whose own texts differ. A page's own text is what is left without all subtrees that
    recur on ``min_pages`` rows of the host; less than ``OWN_CHARS`` characters that are also less than ``OWN_SHARE`` of the page tell nothing. So copied pages,
    and nearly copied ones, are kept however often they recur, and the size of the host decides nothing. ``n_templates`` counts the
    subtrees deleted, and those outside the text that recur on ``min_pages`` rows. A NULL or empty html, and a page of nothing but
    templates, has the empty text. Pages without a host (no ``://``) count as one host. Repeated rows are all
    returned; an empty table gives no rows; other columns are not looked at.

    Pages are parsed once and their texts never shuffled: hashes alone are counted, combined before the shuffle, and the lists of recurring
    subtrees and of templates come back to the texts as Bloom cascades over all subtrees of the corpus, which answer exactly.
    """
    host, _ = host_and_path(F.col("url"))
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(host).alias("host"))
    parsed = pages.mapInArrow(
        _parse,
        "page_id bigint, url string, texts array<string>, elements array<int>, keys array<bigint>, parents array<int>, others array<bigint>",
    )
    parsed = settle(parsed, "parsed")
    # arrays of hashes are taken apart after a plain read, so nothing is computed twice
    counted = parsed.select(F.explode(F.array_distinct(F.concat("keys", "others"))).alias("key")).where("key <> 0")
    counted = settle(counted.groupBy("key").agg(F.count("*").alias("rows")), "subtrees")
    universe, size = counted.select("key"), counted.count()
    within = F.filter("keys", lambda k: k != 0)
    recurring = counted.where(F.col("rows") >= min_pages).select("key")
    met = _listed_in(parsed, {"recurring": within, "outside": F.col("others")}, universe, size, recurring, max_filter_bytes)
    met = met.withColumn("outside", F.size("outside").cast("bigint"))
    told = met.where(F.size("recurring") > 0).select("texts", "elements", "keys", "parents", "recurring").mapInArrow(_tell, "key bigint, own bigint")
    told = told.groupBy("key").agg(F.count_distinct("own").alias("pages")).where(F.col("pages") >= min_pages).select("key")
    final = _listed_in(met, {"deleted": F.col("recurring")}, recurring, size, settle(told, "templates"), max_filter_bytes)
    final = final.withColumn("n_templates", F.size("deleted").cast("bigint") + F.col("outside"))
    return final.mapInArrow(_delete, "page_id bigint, url string, text string, n_chars bigint, n_templates bigint")
