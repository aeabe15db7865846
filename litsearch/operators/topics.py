"""Topic enrichment: keys of documents matched with pages of a wiki."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsearch.fixed_values import (
    CATEGORY_PATTERN, CATEGORY_START, KEY_IS_TOPIC_PHRASES, NEXT_WORD_IS_TOPIC_PHRASES, NO_KEYS, NOT_FOUND,
)
from litsearch.functions.text import encode_list
from litsearch.operators.joins import fits_broadcast, lookup_join
from litsearch.sources.scratch import materialise


def merge_keys(docs: DataFrame) -> DataFrame:
    """``merged_keys``: keys of both lists, each once, in order."""
    none = F.array().cast("array<string>")
    return docs.withColumn("merged_keys", F.array_union(
        F.coalesce("ieee_keys", none), F.coalesce("author_keys", none)))


def distinct_documents(docs: DataFrame, by: str | None = None) -> DataFrame:
    """Documents without repeats: rows equal in all columns but ``doc_id`` are one.

    With ``by`` documents that share that column are one; those in which it is empty or
    null are never merged. The document with the lowest ``doc_id`` stays. With ``by`` it is
    picked from narrow rows, task by task before the shuffle.
    """
    if by is None:
        names = [c for c in docs.columns if c != "doc_id"]
        if "doc_id" not in docs.columns:
            return docs.dropDuplicates(names)
        # equal rows are small groups of whole documents; the first id of each is kept
        return docs.groupBy(*names).agg(F.min("doc_id").alias("doc_id")).select(*docs.columns)
    named = F.length(by) > 0
    first = docs.filter(named).groupBy(by).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    merged = docs.filter(named).join(first, "doc_id", "left_semi")
    return merged.unionByName(docs.filter(~F.coalesce(named, F.lit(False)))).select(*docs.columns)


def distinct_keys(docs: DataFrame, column: str) -> DataFrame:
    """Different lower-cased keys of one list column: ``key``."""
    keys = docs.select(F.explode_outer(column).alias("key"))
    return keys.select(F.lower("key").alias("key")).filter(F.length("key") > 0).distinct()


def match_wiki_pages(wiki: DataFrame, keys: DataFrame, small: bool | None = None) -> DataFrame:
    """What pages named by a key say of it: ``id, key, title_match, n_chars, topics``.

    The title counts before the redirect title; pages matching neither are
    dropped. Small keys are broadcast, pages stay where they are, and topics are
    worked out for matches. For large keys each page gives its answers for its own two
    names first, which are stored: the dump is read once and no page text is shuffled.
    """
    pages = wiki.select(
        "id",
        F.lower("title").alias("by_title"),
        F.lower("redirect.title").alias("by_redirect"),
        F.coalesce("revision.text", F.lit("")).alias("text"),
    )
    answer = ["id", "key", "title_match", F.length("text").cast("bigint").alias("n_chars"), "topics"]
    if small is None:
        small = fits_broadcast(keys)
    if small:
        for name in ("by_title", "by_redirect"):
            hit = keys.select(F.col("key").alias(name), F.lit(True).alias(f"{name}_hit"))
            pages = pages.join(F.broadcast(hit), name, "left")
        return page_topics(pages.filter("by_title_hit or by_redirect_hit").select(
            "id",
            F.when(F.col("by_title_hit"), F.col("by_title"))
            .otherwise(F.col("by_redirect")).alias("key"),
            F.col("by_title_hit").isNotNull().alias("title_match"), "text")).select(*answer)
    names = pages.select("id", "text", F.inline(F.array(
        F.struct(F.lit(True).alias("title_match"), F.col("by_title").alias("key")),
        F.struct(F.lit(False).alias("title_match"), F.col("by_redirect").alias("key")),
    ))).filter(F.col("key").isNotNull())
    answers = materialise(page_topics(names).select(*answer), "page_answers")
    best = F.struct((~F.col("title_match")).alias("by_redirect"), "key", "n_chars", "topics")
    return (lookup_join(answers, keys, ["key"], spread=("id",), small=False)
            .groupBy("id").agg(F.min(best).alias("best"))
            .select("id", "best.key", (~F.col("best.by_redirect")).alias("title_match"),
                    "best.n_chars", "best.topics"))


def extract_categories(text: Column) -> Column:
    """Names of all category links in a page, without sort keys."""
    found = F.transform(
        F.regexp_extract_all(text, F.lit(CATEGORY_PATTERN), F.lit(1)),
        lambda c: F.substring_index(c, "|", 1))
    # the plain test keeps the pattern from running twice
    return (F.when(F.contains(text, F.lit(CATEGORY_START)), found)
            .otherwise(F.array(F.lit(NOT_FOUND))))


def _says(text: Column, phrases: list[str], before: Column | None = None,
          after: str = "") -> Column:
    """Does the text hold one of the phrases, next to what is given?"""
    lead = F.concat(before, F.lit(" ")) if before is not None else F.lit("")
    tests = [F.contains(text, F.concat(lead, F.lit(p + after))) for p in phrases]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def topic_rule(key: Column, text: Column, categories: Column) -> Column:
    """Topics of a key, best first, from the page that describes it.

    The page calls the key itself a field: the key. It names the field after one
    of the phrases: the second category goes first. Otherwise the categories.
    """
    flat = F.translate(F.lower(text), "\n\t\r\f\x0b", "     ")
    swapped = F.concat(
        F.array(F.get(categories, F.lit(1)), F.get(categories, F.lit(0))),
        F.slice(categories, 3, F.size(categories)))
    # inside the lambda the text is a value: it is lower-cased once, not per phrase
    return F.flatten(F.transform(F.array(flat), lambda t: (
        F.when(_says(t, KEY_IS_TOPIC_PHRASES, before=key), F.array(key))
        .when((F.size(categories) > 1) & _says(t, NEXT_WORD_IS_TOPIC_PHRASES, after=" "), swapped)
        .otherwise(categories))))


def page_topics(matched: DataFrame) -> DataFrame:
    """``topics`` of pages with their ``key`` and ``text``."""
    with_categories = matched.withColumn("categories", extract_categories(F.col("text")))
    return with_categories.withColumn(
        "topics", topic_rule(F.col("key"), F.col("text"), F.col("categories")))


def topic_dictionary(matched: DataFrame) -> DataFrame:
    """One ``(key, topics)`` row per key.

    Several pages may share a key: a title match wins, then the lowest page id.
    The best page is kept task by task before the shuffle, so a key that a third
    of the pages share costs one row per task, and page text is never shuffled.
    """
    order = F.struct((~F.col("title_match")).alias("by_redirect"), F.col("id"))
    return matched.groupBy("key").agg(F.min_by("topics", order).alias("topics"))


def explode_keys(docs: DataFrame, column: str, doc_id: str = "doc_id") -> DataFrame:
    """One ``(doc_id, key)`` row per key; a document without keys keeps a null key."""
    keys = F.filter(column, lambda k: k != "")
    return docs.select(doc_id, F.explode_outer(keys).alias("key"))


def _first_topics(dictionary: DataFrame) -> DataFrame:
    """``(key, first)``: all a document needs from the dictionary."""
    return dictionary.select(F.lower("key").alias("_key"), F.get("topics", F.lit(0)).alias("_first"))


def attach_topics(doc_keys: DataFrame, dictionary: DataFrame,
                  small: bool | None = None) -> DataFrame:
    """First topic of every key, ``Not found`` where there is none: adds ``topic``."""
    rows = doc_keys.withColumn("_key", F.lower("key"))
    joined = lookup_join(rows, _first_topics(dictionary), ["_key"], "left", small=small)
    return joined.withColumn(
        "topic", F.when(F.col("key").isNotNull(), F.coalesce("_first", F.lit(NOT_FOUND)))
    ).drop("_key", "_first")


def combine_topics(docs: DataFrame, topics: DataFrame) -> DataFrame:
    """Documents with ``combined_topics``, the sorted set of their keys' topics.

    Only ``(doc_id, topic)`` is grouped; the wide columns are joined back.
    """
    per_doc = topics.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("topic")).alias("combined_topics"))
    return docs.join(per_doc, "doc_id", "left").withColumn(
        "combined_topics",
        F.coalesce("combined_topics", F.array().cast("array<string>")))


def attach_topics_ordered(docs: DataFrame, dictionary: DataFrame, column: str,
                          small: bool | None = None) -> DataFrame:
    """Topics in key order with repeats; unmatched keys skipped, no list → ``None``."""
    keys = (docs.select("doc_id", F.posexplode_outer(column).alias("pos", "key"))
            .filter(F.col("key").isNotNull()).withColumn("_key", F.lower("key")))
    found = _first_topics(dictionary).filter(F.col("_first").isNotNull())
    ordered = (lookup_join(keys, found, ["_key"], small=small)
               .groupBy("doc_id")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "_first"))).alias("_found")))
    topics = F.coalesce(F.transform("_found", lambda t: t["_first"]),
                        F.array().cast("array<string>"))
    return (docs.join(ordered, "doc_id", "left")
            .withColumn("topics", F.when(F.col(column).isNull(), F.array(F.lit(NO_KEYS)))
                        .otherwise(topics))
            .drop("_found"))


def export_dictionary(dictionary: DataFrame) -> DataFrame:
    """The dictionary as two text columns, ready to be written."""
    return dictionary.select("key", encode_list(F.col("topics")).alias("topics"))
