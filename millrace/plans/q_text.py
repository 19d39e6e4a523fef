"""Queries over texts: cleaning, tokens, word statistics, markup, delimited round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.stop_words import ENGLISH
from ..operators import features
from ..operators.tables import preview
from ..schemas import LABELLED_TEXT
from ..session import scratch_path
from ..sources.files import read_delimited
from ..sources.sinks import feed_lines, write_lines
from .catalog import query, table

WORDS_SQL = r"""words AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s')) AS word FROM documents),
    tokens AS (SELECT doc_id, word FROM words WHERE word <> '')"""
_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)


def documents(spark, sf):
    return table(spark, sf, "documents", spread=True)


@query("clean_text", r"SELECT doc_id, regexp_replace(lower(text), '[^a-z\s]', '', 'g') AS clean_text FROM documents")
def clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", X.clean_text(F.col("text")).alias("clean_text"))


@query("tokens", f"WITH {WORDS_SQL} SELECT doc_id, word FROM tokens")
def tokens(spark, sf):
    return X.token_rows(documents(spark, sf), "text", "doc_id")


@query("space_pieces", "SELECT doc_id, unnest(string_split(text, ' ')) AS piece FROM documents")
def space_pieces(spark, sf):
    return documents(spark, sf).select("doc_id", F.explode(X.space_pieces(F.col("text"))).alias("piece"))


@query("tokens_no_stop", f"WITH {WORDS_SQL} SELECT doc_id, word FROM tokens WHERE word NOT IN ({_STOP_SQL})")
def tokens_no_stop(spark, sf):
    return X.without_stop_words(X.token_rows(documents(spark, sf), "text", "doc_id"), ENGLISH)


def word_totals(spark, sf):
    return X.token_rows(documents(spark, sf), "text").groupBy("word").agg(F.count("*").alias("count"))


@query(
    "word_prefix",
    f"WITH {WORDS_SQL} SELECT word, count(*) AS count FROM tokens WHERE word LIKE 'th%' GROUP BY word",
)
def word_prefix(spark, sf):
    return word_totals(spark, sf).where(F.col("word").like("th%"))


@query(
    "top_words",
    f"WITH {WORDS_SQL} SELECT word, count(*) AS count FROM tokens GROUP BY word ORDER BY count DESC, word LIMIT 100",
)
def top_words(spark, sf):
    return preview(word_totals(spark, sf), [F.desc("count"), F.asc("word")], 100)


@query(
    "idf_weights",
    f"""WITH {WORDS_SQL}, f AS (SELECT word, count(DISTINCT doc_id) AS df FROM tokens GROUP BY word)
        SELECT word, df, round(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 9) AS idf FROM f""",
)
def idf_weights(spark, sf):
    return features.idf_weights(documents(spark, sf), "text").withColumn("idf", F.round("idf", 9))


@query("hashed_tf")
def hashed_tf(spark, sf):
    counted = features.hashed_counts(documents(spark, sf), "doc_id", "text")
    return counted.select("doc_id", F.array_join(F.transform("counts", lambda c: c.cast("int").cast("string")), ",").alias("counts"))


@query(
    "hashed_tf_totals",
    f"""WITH {WORDS_SQL}, n AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS total, TRUE AS whole FROM documents LEFT JOIN n USING (doc_id)""",
)
def hashed_tf_totals(spark, sf):
    counted = features.hashed_counts(documents(spark, sf), "doc_id", "text")
    total = F.aggregate("counts", F.lit(0.0), lambda s, c: s + c)
    whole = F.forall("counts", lambda c: (c >= 0) & (c == F.floor(c)))
    return counted.select("doc_id", total.cast("bigint").alias("total"), whole.alias("whole"))


DOC_VECTOR_SQL = f"""{WORDS_SQL}, f AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) AS idf,
        CAST('0x' || md5(word)[1:15] AS BIGINT) AS h FROM tokens GROUP BY word),
    v AS (SELECT doc_id, [{', '.join(f'sum(idf * (2 * ((h >> {i}) & 1) - 1)) / count(*)' for i in range(features.VECTOR_SIZE))}] AS v
        FROM tokens JOIN f USING (word) GROUP BY doc_id)"""


def sign_vectors(spark, sf):
    """Vectors of random signs, as ``DOC_VECTOR_SQL`` has them."""
    vectors = features.document_vectors(documents(spark, sf), "doc_id", "text")
    return vectors.select("doc_id", F.transform("vector", lambda x: F.round(x, 6) + 0.0).alias("vector"))


@query("doc_vectors")
def doc_vectors(spark, sf):
    """Learned: what SQL can say of them is in ``doc_vectors_check``."""
    vectors = features.word2vec_vectors(documents(spark, sf), "doc_id", "text")
    return vectors.select("doc_id", F.transform("vector", lambda x: F.round(x, 6) + 0.0).alias("vector"))


@query("doc_vectors_check", f"WITH {WORDS_SQL} SELECT DISTINCT doc_id, {features.VECTOR_SIZE} AS size, TRUE AS finite, TRUE AS filled FROM tokens")
def doc_vectors_check(spark, sf):
    """Every text with a token has one finite vector, which is not all zero."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return doc_vectors(spark, sf).select("doc_id", F.size("vector").alias("size"), finite.alias("finite"), F.exists("vector", lambda x: x != 0).alias("filled"))


@query(
    "strip_anchors",
    r"""WITH s AS (SELECT url, regexp_replace(html, '<a.+/a>', '', 'g') AS text FROM pages)
        SELECT concat(url, ' = ', regexp_replace(text, '[\r\n]+', ' ', 'g')) AS value FROM s WHERE text <> ''""",
)
def strip_anchors(spark, sf):
    pages = table(spark, sf, "pages", spread=True)
    return feed_lines(pages, F.col("url"), X.strip_anchors(F.col("html")))


@query(
    "src_delimited",
    r"""WITH c AS (SELECT lang, trim(regexp_replace(regexp_replace(lower(text), '[^a-z\s]', '', 'g'), '\s+', ' ', 'g'))
                   AS description FROM documents)
        SELECT lang AS label1, description FROM c WHERE description <> ''""",
)
def src_delimited(spark, sf):
    text = F.trim(F.regexp_replace(X.clean_text(F.col("text")), r"\s+", " "))
    path = scratch_path(spark, "src_delimited")
    write_lines(feed_lines(documents(spark, sf), F.col("lang"), text), path)
    back = read_delimited(spark, path, LABELLED_TEXT, sep="=")
    return back.select(F.trim("label1").alias("label1"), F.trim("description").alias("description"))
