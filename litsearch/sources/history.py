"""Visited links on disk, in folders by hash of the link.

Files are sorted by link and hold Bloom filters of them. A batch of few links opens only the
folders of its hashes and skips files and row groups that cannot hold one of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsearch.operators.joins import asked_rows, few_values

# part of the layout: folders written with another number would not be found
HISTORY_BUCKETS = 64
LINKS = "url string, page_id bigint"


def link_bucket(url: Column | str) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(HISTORY_BUCKETS)).cast("int")


def with_bucket(links: DataFrame) -> DataFrame:
    """``url, bucket`` of links, whether they were stored by bucket or not."""
    if "bucket" in links.columns:
        return links.select("url", "bucket")
    return links.select("url", link_bucket("url").alias("bucket"))


def write_links(links: DataFrame, path: str, mode: str) -> None:
    (links.select("url", "page_id", link_bucket("url").alias("bucket"))
     .hint("rebalance", "bucket").sortWithinPartitions("bucket", "url")
     .write.mode(mode).partitionBy("bucket")
     .option("parquet.bloom.filter.enabled#url", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))


def possible_rows(history: DataFrame, candidates: DataFrame) -> DataFrame:
    """``url`` of the part of a history that may hold some of few candidates (``url``, stored).

    Folders are chosen by the candidates' hashes; few links are handed to the scan too. A history
    without buckets is only filtered.
    """
    buckets = few_values(candidates.select(link_bucket("url").alias("bucket")), "bucket", HISTORY_BUCKETS)
    found = asked_rows(with_bucket(history), "bucket", buckets)
    return asked_rows(found, "url", few_values(candidates, "url")).select("url")
