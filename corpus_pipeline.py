"""A corpus cleaned, mixed and tokenized: each stage works on the documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import lang_id, minhash_lsh, soft_mix, trie_bpe
from millrace.llm.catalog import table
from millrace.llm.common import settle
from millrace.llm.q_texts import MIXTURE, domains, vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document of which less than this share of the letters is in learned languages, all together, is rejected.
LEAST_SHARE = 0.5
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; ``lang`` is set to what was found.

    Documents without a letter, and those of which the learned languages together have less than half, go. NULL texts go with them.
    """
    docs = docs.select(*COLUMNS)
    model = lang_id.train(docs.where(~lang_id.held_out("doc_id")))
    told = lang_id.label_documents(docs, model, keep_text=True, known=True)
    known = (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("known") >= LEAST_SHARE)
    return told.where(known).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    docs = docs.select(*COLUMNS)
    found = minhash_lsh.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY)
    gone = settle(found.where("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate in the mixture says; documents without an id stay once.

    Where no domain that the mixture wants was learned, the rates say nothing and every document stays once.
    """
    docs = docs.select(*COLUMNS)
    rated = soft_mix.mix(docs, domains(table(spark, sf_dir, "labels")), MIXTURE)
    wanted = F.arrays_overlap(F.map_keys("posterior"), F.array(*[F.lit(d) for d, weight in MIXTURE.items() if weight > 0]))
    rated = rated.where("doc_id IS NOT NULL").withColumn("copies", F.when(wanted, F.col("copies")).otherwise(1))
    copies = rated.groupBy("doc_id").agg(F.max("copies").alias("_copies"))
    placed = docs.join(copies, "doc_id", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    return placed.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the token ids and of the text decoded from them."""
    return trie_bpe.digest_documents(docs, vocabulary_path())


STAGES = [("language", language), ("near_dup", near_dup), ("mixing", mixing), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A language model, a sampled classifier and token ids are not for SQL; the stages are tested one by one.
ORACLE_SQL = None
