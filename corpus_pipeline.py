"""Corpus preparation: five stages, each on all that the one before kept.

1. ``language``: texts without letters, and texts of which no language holds half of the
   letters, go. A missing ``lang`` is filled in.
2. ``near_duplicates``: of each group of documents linked by their fingerprints, the one of
   smallest id stays. A document is a row's id and text: rows that share both are one, rows that
   share an id with different, unlinked texts are two.
3. ``decontamination``: documents that leak a benchmark item go.
4. ``personal_data``: spans are replaced by their kind, ``n_chars`` follows.
5. ``tokens``: ids of the text, their number, and the text they decode to.

All but the last return the columns of ``documents``. Null texts have no language and go
in the first stage. Rows without an id cannot name a group and stay.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm import (op3_language, op5_decontamination, op6_pii, op7_byte_bpe, op9_simhash)
from litsearch.operators.joins import lookup_join
from litsearch.sources.scratch import materialise

#: A text is in a language if that holds this share of its letters.
LEAST_SHARE = 0.5
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op3_language.learn(docs)
    found = op3_language.identify(docs, model, spans=False)
    kept = (F.col("lang_pred") != op3_language.UNKNOWN) & (F.col("lang_score") >= LEAST_SHARE)
    return found.filter(kept).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = "row_key"
    while key in docs.columns:
        key += "_"
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    named = rows.filter("doc_id IS NOT NULL")
    groups = materialise(op9_simhash.link_documents(rows, id_col=key).select(
        F.col("doc_id").alias(key), "component"), "document_groups")
    members = materialise(named.select(key, "doc_id").distinct().join(groups.distinct(), key), "group_members")
    least = F.min(F.struct("doc_id", key))[key]
    several = materialise(members.groupBy("component").agg(least.alias("stays"), F.count(F.lit(1)).alias("n"))
                          .filter("n > 1").select("component", "stays"), "groups_of_several")
    gone = (lookup_join(members, several, ["component"], spread=(key,))
            .filter(F.col(key) != F.col("stays")).select(key))
    kept = rows.join(gone, key, "left_anti")
    repeated = groups.groupBy(key).count().filter("count > 1").join(members.select(key), key, "left_semi")
    if not repeated.isEmpty():
        kept = (kept.filter("doc_id IS NOT NULL").dropDuplicates([key])
                .unionByName(kept.filter("doc_id IS NULL")))
    return kept.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = op5_decontamination.mark_leaks(docs, benchmark, column="leaked_items")
    return marked.filter(F.size("leaked_items") == 0).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op6_pii.find_personal_data(docs, op6_pii.learn(docs))
    return (found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("redacted").cast("long"))
            .select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: ids as little-endian 32-bit numbers, text as decoded from them."""
    encoded = op7_byte_bpe.encode(docs, public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", "n_tokens", "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Models and byte-pair merging cannot be said in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
