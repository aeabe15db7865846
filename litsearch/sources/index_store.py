"""Searchable tables on disk.

Layout: one folder per table. Postings lie in ``field=…/bucket=…``, where the
bucket is a hash of the term; dictionaries in ``bucket=…``. A search knows its
fields and terms, so it opens only the folders of its buckets. Before the write postings are
dealt by (field, bucket); Spark cuts large shares by size, so a frequent term is split over
several tasks and files, and nothing is computed twice to find ranges. Files are sorted by term, and a scan that
is told its terms skips the pages without them. The document store is cut by
range of ``doc_id`` for the same reason.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.sources.documents import require_unique
from litsearch.operators.expansion import Lookups, bucketed, gram_counts, term_grams, term_segments
from litsearch.operators.index import (
    IndexConfig, build_key_postings, build_token_postings, doc_store, field_stats, term_dictionary,
)

# a corpus of this many scan splits fills one bucket of each field
SPLITS_PER_BUCKET = 8
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096


@dataclass(frozen=True)
class Index:
    """Tables of one index; ``buckets`` is 0 when they are not laid out by bucket."""

    postings: DataFrame
    dictionary: DataFrame
    stats: DataFrame
    key_postings: DataFrame
    key_dictionary: DataFrame
    docs: DataFrame
    buckets: int = 0
    config: IndexConfig | None = None
    lookups: Lookups | None = None


def bucket_of(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_index(docs: DataFrame, config: IndexConfig, doc_id: str = "doc_id") -> Index:
    """All tables as plans; nothing runs before they are written or searched."""
    config = config.within(docs, doc_id)
    postings = build_token_postings(docs, config, doc_id)
    keys = build_key_postings(docs, config.list_fields, doc_id) if config.list_fields else (
        postings.select("field", "term", "doc_id", "tf").limit(0))
    return Index(postings, term_dictionary(postings), field_stats(postings), keys,
                 term_dictionary(keys), doc_store(docs, config, doc_id), config=config)


def _buckets_for(stored_docs: DataFrame) -> int:
    """Number of buckets by the size of the document store just written."""
    fitting = stored_docs.rdd.getNumPartitions() // SPLITS_PER_BUCKET
    return min(MOST_BUCKETS, max(FEWEST_BUCKETS, fitting))


def _write_postings(postings: DataFrame, path: str, buckets: int) -> None:
    (postings.withColumn("bucket", bucket_of("term", buckets))
     .hint("rebalance", "field", "bucket")
     .sortWithinPartitions("field", "bucket", "term", "doc_id")
     .write.mode("errorifexists").partitionBy("field", "bucket").parquet(path))


def _write_dictionary(dictionary: DataFrame, path: str, buckets: int) -> None:
    (dictionary.withColumn("bucket", bucket_of("term", buckets))
     .hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "term")
     .write.mode("errorifexists").partitionBy("bucket").parquet(path))


def _write_lookup(table: DataFrame, column: str, path: str, buckets: int) -> None:
    """A gram in many terms lies in several files."""
    order = ["bucket", "field", column, *(["term"] if "term" in table.columns else [])]
    (bucketed(table, column, buckets).hint("rebalance", "bucket").sortWithinPartitions(*order)
     .write.mode("errorifexists").partitionBy("bucket").parquet(path))


def write_index(index: Index, path: str, buckets: int | None = None,
                table_prefix: str | None = None) -> None:
    """Write every table; raises before any work if an index is there already.

    Postings are built from the document store just written, dictionaries and statistics
    from the postings, so what lies before the index runs once and text is split once. With ``table_prefix`` the dictionary and the
    document store also become catalog tables bucketed by ``term`` and
    ``doc_id``, whose keys are unique and hence even.
    """
    spark = index.docs.sparkSession
    (index.docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .write.mode("errorifexists").parquet(f"{path}/docs"))
    stored = spark.read.schema(index.docs.schema).parquet(f"{path}/docs")
    require_unique(stored)
    if index.config:
        index = build_index(stored, index.config)
    buckets = buckets or _buckets_for(stored)
    _write_postings(index.postings, f"{path}/postings", buckets)
    _write_postings(index.key_postings, f"{path}/key_postings", buckets)
    for name, source in (("dictionary", "postings"), ("key_dictionary", "key_postings")):
        _write_dictionary(term_dictionary(_open(spark, path, source)), f"{path}/{name}", buckets)
    dictionary = _open(spark, path, "dictionary")
    _write_lookup(term_grams(dictionary), "gram", f"{path}/grams", buckets)
    _write_lookup(gram_counts(_open(spark, path, "grams")), "gram", f"{path}/gram_counts", buckets)
    _write_lookup(term_segments(dictionary), "key", f"{path}/segments", buckets)
    (field_stats(_open(spark, path, "postings"))
     .write.mode("errorifexists").parquet(f"{path}/stats"))
    (spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(True).alias("lookups"),
                           F.lit(True).alias("segments"))
     .write.mode("errorifexists").json(f"{path}/meta"))
    if table_prefix:
        stored = read_index(spark, path)
        for name, table, key in (("dictionary", stored.dictionary, "term"),
                                 ("docs", stored.docs, "doc_id")):
            (table.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
             .saveAsTable(f"{table_prefix}_{name}"))


_POSTINGS = "field string, term string, doc_id bigint, tf bigint"
_SCHEMAS = {
    "postings": _POSTINGS + ", doc_len bigint, positions array<int>, bucket int",
    "key_postings": _POSTINGS + ", bucket int",
    "dictionary": "field string, term string, df bigint, cf bigint, bucket int",
    "key_dictionary": "field string, term string, df bigint, cf bigint, bucket int",
    "stats": "field string, n_docs bigint, avg_len double",
}
_LOOKUPS = {
    "grams": "field string, gram string, term string, bucket int",
    "gram_counts": "field string, gram string, n bigint, bucket int",
    "deletions": "field string, key bigint, term string, bucket int",
    "segments": "field string, key bigint, term string, bucket int",
}


def _open(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema((_SCHEMAS | _LOOKUPS)[name]).parquet(f"{path}/{name}")


def read_index(spark: SparkSession, path: str) -> Index:
    """Open a written index. One written before there were lookup tables is searched without them, one written
    before there were segments by its deletions."""
    meta = spark.read.schema("buckets int, lookups boolean, segments boolean").json(f"{path}/meta").first()
    tables = {name: _open(spark, path, name) for name in _SCHEMAS}
    lookups = None
    if meta["lookups"]:
        words = _open(spark, path, "segments" if meta["segments"] else "deletions")
        lookups = Lookups(*[_open(spark, path, name) for name in ("grams", "gram_counts")],
                          None if meta["segments"] else words, meta["buckets"], words if meta["segments"] else None)
    return Index(docs=spark.read.parquet(f"{path}/docs"), buckets=meta["buckets"], lookups=lookups, **tables)
