"""Similarity queries: near-duplicates by Jaccard distance, batch and streaming, and vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import functions as F

from ..operators import features, minhash, prefix_join, token_sets
from ..operators.vector_join import near_vectors
from ..session import scratch_path, settle
from ..sources.files import stream_table
from ..streaming.near_dup import Index, build_index, stream_corpus, stream_near_duplicates
from .catalog import query, table
from .q_text import DOC_VECTOR_SQL, sign_vectors

NEAR = 0.2
JOIN_DISTANCE = 0.7
STREAM_DISTANCE = 0.6
SIGNATURE = 16
#: Folders of the indexes of the streaming queries; large corpora want more.
INDEX_PARTS = 16
VECTOR_DISTANCE, LOOSE_DISTANCE = 0.001, 0.05
PAIR = ["id_a", "id_b", "distance", "copies_a", "copies_b"]


def _sets_sql(source: str, id_col: str, name: str, stop_words: Sequence[str] = ()) -> str:
    """Distinct token sets of a table under their smallest id, and their words as rows."""
    stop = ", ".join(f"'{w}'" for w in ("", *stop_words))
    return rf"""{name}_t AS (SELECT {id_col} AS id, list_distinct(list_filter(
            string_split_regex(lower(text), '\s'), lambda x: x NOT IN ({stop}))) AS t FROM {source}),
        {name} AS (SELECT min(id) AS id, count(*) AS copies, list_sort(t) AS t FROM {name}_t
            WHERE len(t) > 0 GROUP BY list_sort(t)),
        {name}_w AS (SELECT id, copies, len(t) AS n, unnest(t) AS w FROM {name})"""


def _measure_sql(a: str, b: str, distance: float, where: str = "TRUE") -> str:
    """Pairs of two word tables below the distance, counted word by word."""
    t = token_sets.exact(distance)
    return f"""common AS (SELECT a.id AS id_a, b.id AS id_b, a.copies AS copies_a, b.copies AS copies_b,
            a.n + b.n AS sizes, count(*) AS shared
          FROM {a}_w a JOIN {b}_w b ON a.w = b.w WHERE {where} GROUP BY ALL)
        SELECT id_a, id_b, round(1 - shared / (sizes - shared), 6) AS distance, copies_a, copies_b FROM common
        WHERE shared * {t.denominator} > (sizes - shared) * {t.denominator - t.numerator}"""


_HASH_SQL = f"CAST(('0x' || md5(w)[1:8]) AS BIGINT) % {minhash.PRIME}"


def _between_sql(distance: float, stop_words: Sequence[str] = ()) -> str:
    """All near pairs of a benchmark text and a document, by counting common words."""
    return f"""WITH {_sets_sql('benchmark', 'item_id', 'x', stop_words)}, {_sets_sql('documents', 'doc_id', 'y', stop_words)},
        {_measure_sql('x', 'y', distance)}"""


def _within_sql(distance: float) -> str:
    return f"WITH {_sets_sql('documents', 'doc_id', 's')}, {_measure_sql('s', 's', distance, 'a.id < b.id')}"


NEAR_SQL = _within_sql(NEAR)


def documents(spark, sf):
    return table(spark, sf, "documents", spread=True)


@query("near_dup_pairs", NEAR_SQL)
def near_dup_pairs(spark, sf):
    return minhash.minhash_near_pairs(documents(spark, sf), "doc_id", "text", NEAR)


@query("near_dup_pairs_exact", NEAR_SQL)
def near_dup_pairs_exact(spark, sf):
    return prefix_join.prefix_near_pairs(documents(spark, sf), "doc_id", "text", NEAR)


@query(
    "near_dup_copies",
    f"WITH {_sets_sql('documents', 'doc_id', 's')} SELECT t.id, s.id AS rep FROM s_t t JOIN s ON list_sort(t.t) = s.t",
)
def near_dup_copies(spark, sf):
    return token_sets.copy_links(token_sets.token_sets(documents(spark, sf), "doc_id", "text"))


@query("lsh_join", _between_sql(JOIN_DISTANCE))
def lsh_join(spark, sf):
    return prefix_join.prefix_near_pairs_between(
        table(spark, sf, "benchmark"), documents(spark, sf), "item_id", "doc_id", "text", "text", JOIN_DISTANCE
    )


@query("lsh_self_join", _within_sql(STREAM_DISTANCE))
def lsh_self_join(spark, sf):
    """A loose threshold within one table."""
    return prefix_join.prefix_near_pairs(documents(spark, sf), "doc_id", "text", STREAM_DISTANCE)


@query(
    "minhash_signatures",
    f"WITH {_sets_sql('documents', 'doc_id', 's')}, h AS (SELECT id, n, {_HASH_SQL} AS h FROM s_w) SELECT id, "
    "CAST(n AS INTEGER) AS size, "
    + ", ".join(f"min(({a}::BIGINT * h + {b}) % {minhash.PRIME}) AS m{i}" for i, (a, b) in enumerate(minhash.coefficients(SIGNATURE)))
    + " FROM h GROUP BY id, n",
)
def minhash_signatures(spark, sf):
    sets = token_sets.distinct_sets(token_sets.token_sets(documents(spark, sf), "doc_id", "text"))
    return minhash.signatures(sets, SIGNATURE)


def _looked_up(spark, sf, sets_of):
    """The benchmark texts arrive as a stream and are looked up in the index of the documents."""
    root = scratch_path(spark, "stream_near_dup")
    shape = build_index(documents(spark, sf), "doc_id", "text", STREAM_DISTANCE, f"{root}/index", sets_of=sets_of, parts=INDEX_PARTS)
    index = Index(spark, f"{root}/index", shape, sets_of=sets_of, parts=INDEX_PARTS)
    schema = table(spark, sf, "benchmark").schema
    stream = stream_table(spark, f"{sf}/benchmark.parquet*", schema)
    stream_near_duplicates(
        stream, index, "item_id", "text", STREAM_DISTANCE, f"{root}/out", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*PAIR)


@query("stream_near_dup", _between_sql(STREAM_DISTANCE))
def stream_near_dup(spark, sf):
    return _looked_up(spark, sf, token_sets.token_sets)


#: Words that the second stream leaves out of all sets.
STREAM_STOP = ["the", "of", "and", "to", "is", "de", "la", "der", "die", "que"]


@query("stream_near_dup_stop", _between_sql(STREAM_DISTANCE, STREAM_STOP))
def stream_near_dup_stop(spark, sf):
    return _looked_up(spark, sf, partial(token_sets.token_sets, stop_words=STREAM_STOP))


#: Files in which the growing corpus arrives.
ARRIVALS = 4


@query("stream_growing_corpus", _between_sql(STREAM_DISTANCE))
def stream_growing_corpus(spark, sf):
    """The documents arrive file by file in an index that starts empty; the benchmark texts are looked up when all are there and the index is compacted."""
    root = scratch_path(spark, "stream_growing_corpus")
    docs = documents(spark, sf).select("doc_id", "text")
    docs.repartition(ARRIVALS).write.parquet(f"{root}/arrivals")
    shape = build_index(docs.limit(0), "doc_id", "text", STREAM_DISTANCE, f"{root}/index", parts=INDEX_PARTS)
    index = Index(spark, f"{root}/index", shape, parts=INDEX_PARTS)
    arriving = stream_table(spark, f"{root}/arrivals", docs.schema, max_files=1)
    stream_corpus(arriving, index, "doc_id", "text", f"{root}/checkpoint").awaitTermination()
    index.compact()
    return index.lookup(table(spark, sf, "benchmark"), "item_id", "text", STREAM_DISTANCE)


def _vectors_sql(a: str, b: str, distance: float) -> str:
    """All pairs of two columns of vectors, of equal length, below a cosine distance."""
    return f"""WITH a AS (SELECT vec_id AS id, {a} AS v FROM embeddings), b AS (SELECT vec_id AS id, {b} AS v FROM embeddings),
        a1 AS (SELECT min(id) AS id, count(*) AS copies, v FROM a GROUP BY v),
        b1 AS (SELECT min(id) AS id, count(*) AS copies, v FROM b GROUP BY v),
        c AS (SELECT a1.id AS id_a, b1.id AS id_b, 1 - list_dot_product(a1.v, b1.v) / (sqrt(list_dot_product(a1.v, a1.v)) * sqrt(list_dot_product(b1.v, b1.v))) AS d,
            a1.copies AS copies_a, b1.copies AS copies_b FROM a1 JOIN b1 ON len(a1.v) = len(b1.v))
        SELECT id_a, id_b, round(d, 6) AS distance, copies_a, copies_b FROM c WHERE d < {distance}"""


@query("embedding_near_dup", _vectors_sql("embedding::DOUBLE[]", "list_transform(embedding::DOUBLE[], lambda x: round(x, 2))", VECTOR_DISTANCE))
def embedding_near_dup(spark, sf):
    """Vectors against the same vectors kept to two decimals, of whatever length."""
    vectors = table(spark, sf, "embeddings", spread=True)
    rounded = F.transform("embedding", lambda x: F.round(x.cast("double"), 2))
    return near_vectors(vectors, vectors, "vec_id", "vec_id", F.col("embedding"), rounded, None, VECTOR_DISTANCE)


@query(
    "embedding_near_dup_lengths",
    _vectors_sql(
        "list_transform((embedding::DOUBLE[])[1:64 - 12 * (vec_id % 3)], lambda x: round(x, 1))",
        "list_transform((embedding::DOUBLE[])[1:64 - 12 * (vec_id % 3)], lambda x: round(x, 2))", LOOSE_DISTANCE,
    ),
)
def embedding_near_dup_lengths(spark, sf):
    """Vectors of three lengths, kept to one decimal, against the same kept to two, at a loose distance."""
    vectors = table(spark, sf, "embeddings", spread=True)
    cut = F.slice("embedding", F.lit(1), (64 - 12 * (F.col("vec_id") % 3)).cast("int"))

    def rounded(places: int):
        return F.transform(cut, lambda x: F.round(x.cast("double"), places))

    return near_vectors(vectors, vectors, "vec_id", "vec_id", rounded(1), rounded(2), None, LOOSE_DISTANCE)


@query(
    "text_vector_near_dup",
    f"""WITH {DOC_VECTOR_SQL}, r AS (SELECT doc_id AS id, list_transform(v, lambda x: round(x, 6) + 0) AS v FROM v),
        a AS (SELECT min(id) AS id, count(*) AS copies, v FROM r GROUP BY v)
        SELECT x.id AS id_a, y.id AS id_b, round(1 - list_cosine_similarity(x.v, y.v), 6) AS distance,
            x.copies AS copies_a, y.copies AS copies_b
        FROM a x, a y WHERE 1 - list_cosine_similarity(x.v, y.v) < {VECTOR_DISTANCE}""",
)
def text_vector_near_dup(spark, sf):
    """Texts to vectors of one space, and these joined by cosine."""
    vectors = settle(sign_vectors(spark, sf), "doc_vectors")
    return near_vectors(
        vectors, vectors, "doc_id", "doc_id", F.col("vector"), F.col("vector"), None, VECTOR_DISTANCE
    )
