"""Queries over vectors: near-duplicates and exact top-k search."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pivot_index, va_file
from .catalog import query, table

THRESHOLD = 0.98
K = 20
EVERY = 20


@query(
    "op2_pivot_index",
    f"""WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
        vec_id <= coalesce(b, vec_id) AS kept
    FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id""",
)
def op2_pivot_index(spark, sf):
    return pivot_index.near_duplicates(table(spark, sf, "embeddings"), THRESHOLD)


@query(
    "op3_va_file",
    f"""WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    met AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM e q JOIN e c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM met)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}""",
)
def op3_va_file(spark, sf):
    rows = table(spark, sf, "embeddings").where(va_file.whole_vector(F.col("embedding"))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(64.0 * x.cast("double"))).alias("v")
    )
    return va_file.top_k(rows, F.col("vec_id") % EVERY == 0, K)
