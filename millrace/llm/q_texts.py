"""Queries over documents: languages, near-duplicates, token ids, mixing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import lang_id, minhash_lsh, soft_mix, trie_bpe
from .catalog import query, table

SHINGLE_WORDS = 2
SIMILARITY = 0.8
#: Shares of the tokens that the mixture is to have from each domain of the labels.
MIXTURE = {"clean": 0.85, "junk": 0.15, "toxic": 0.0}


@query("op1_lang_id")
def op1_lang_id(spark, sf):
    return lang_id.identify(table(spark, sf, "documents")).drop("spans")


@query(
    "op7_minhash_lsh",
    rf"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM t),
    class AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
    one AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM class),
    common AS (SELECT a.rep AS a, b.rep AS b, a.n + b.n AS sizes, count(*) AS shared
        FROM one a JOIN one b ON a.g = b.g AND a.rep <> b.rep AND least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n) GROUP BY ALL),
    link AS (SELECT a, b FROM common WHERE 100 * shared >= 80 * (sizes - shared)),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, coalesce(len(s.s), 0) AS n_shingles, least(coalesce(rep, doc_id), coalesce(b, doc_id)) AS component_id,
        doc_id = component_id AS kept
    FROM s LEFT JOIN class ON class.s = list_sort(s.s) LEFT JOIN least ON least.a = rep""",
)
def op7_minhash_lsh(spark, sf):
    return minhash_lsh.near_duplicates(table(spark, sf, "documents"), SHINGLE_WORDS, SIMILARITY)


def vocabulary_path() -> str:
    """The vocabulary file of the token queries."""
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_trie_bpe")
def op9_trie_bpe(spark, sf):
    return trie_bpe.digest_documents(table(spark, sf, "documents"), vocabulary_path())


def domains(labels):
    """(doc_id, domain): toxic, else by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")
    return labels.select("doc_id", domain.alias("domain"))


@query("op10_soft_mix")
def op10_soft_mix(spark, sf):
    return soft_mix.mix(table(spark, sf, "documents"), domains(table(spark, sf, "labels")), MIXTURE)
