"""Search over the index tables.

Queries are rows, so a thousand of them are one job:
``clauses(query_id, clause_id, field, kind, value, occur)`` with ``kind`` one of
``key, term, phrase, any_word, prefix, wildcard, fuzzy, range`` and ``occur`` one
of ``must, should, must_not``. Each kind gives ``clause_hits(query_id,
clause_id, doc_id, score)`` with one row per clause and document or more;
:func:`boolean_search` combines them into documents.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from litsearch.fixed_values import (
    DEFAULT_FIELD, MISSING_TERM, WRONG_PAIR,
)
from litsearch.functions import bm25
from litsearch.functions.text import words
from litsearch.operators.expansion import Lookups, fuzzy_candidates, pattern_grams, wildcard_candidates
from litsearch.operators.joins import (
    asked_rows, even_slice, few_values, fits_broadcast, lookup_join, survey,
)
from litsearch.sources.index_store import Index, bucket_of
from litsearch.sources.scratch import materialise

#: Documents of the rarest clauses that one search may hold in memory of each task.
MOST_LIMITING = 100_000

WORD_KINDS = ["term", "phrase", "any_word"]
PATTERN_KINDS = ["prefix", "wildcard", "fuzzy", "range"]
KINDS = ["key", *WORD_KINDS, *PATTERN_KINDS]


# --- clause rows ------------------------------------------------------------

def split_pairs(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """``f1:v1,f2:v2`` texts to one row per pair: ``field, value``, or a ``reason``.

    Names and values are trimmed and lower-cased. What is not a pair stays as a
    row with the reason it was rejected for.
    """
    pairs = queries.select("query_id", F.posexplode(F.split(text, ",")).alias("clause_id", "pair"))
    parts = F.split("pair", ":")
    is_pair = F.size(parts) == 2
    return pairs.select(
        "query_id", "clause_id",
        F.when(is_pair, F.lower(F.trim(F.get(parts, F.lit(0))))).alias("field"),
        F.when(is_pair, F.lower(F.trim(F.get(parts, F.lit(1))))).alias("value"),
        F.when(~is_pair, F.lit(WRONG_PAIR)).alias("reason"),
    )


def pair_clauses(pairs: DataFrame, kind: str, occur: str) -> DataFrame:
    """Accepted pairs as clauses of one kind: ``key``/``must`` for exact keys,
    ``any_word``/``should`` for a comparison of topics."""
    return pairs.filter(F.col("reason").isNull()).select(
        "query_id", "clause_id", "field", F.lit(kind).alias("kind"), "value",
        F.lit(occur).alias("occur"))


def clause_words(clauses: DataFrame, default_field: str = DEFAULT_FIELD,
                 rest_field: str | None = None) -> DataFrame:
    """Word rows of term, phrase and any-word clauses.

    A clause without a field asks the default field. ``rest_field`` moves the
    second and later words of an any-word clause to another field, which is what
    ``field:two words`` means in free text: the field binds the first word only.
    """
    tokens = clauses.filter(F.col("kind").isin(WORD_KINDS)).select(
        "query_id", "clause_id", "kind",
        F.coalesce("field", F.lit(default_field)).alias("field"),
        words(F.col("value")).alias("tokens"))
    rows = tokens.select(
        "query_id", "clause_id", "kind", "field", F.size("tokens").alias("n_words"),
        F.posexplode("tokens").alias("word_no", "term")).filter(F.length("term") > 0)
    if rest_field:
        moved = (F.col("kind") == "any_word") & (F.col("word_no") > 0)
        rows = rows.withColumn("field", F.when(moved, F.lit(rest_field)).otherwise(F.col("field")))
    return rows


# --- exact keys ---------------------------------------------------------------

def _key_terms(clauses: DataFrame) -> DataFrame:
    """Keys asked for, one row per clause, exploded like words are: see ``placed_terms``."""
    return clauses.filter(F.col("kind") == "key").select(
        "query_id", "clause_id", "field", F.explode(F.array(F.lower("value"))).alias("term"))


def placed_terms(terms: DataFrame, buckets: int) -> tuple[DataFrame, list[str]]:
    """Terms with the columns an index table is looked up by.

    Spark prunes the folders of a scan by the other side of a join if that side is
    filtered. A filter over literal rows is evaluated while planning and would be
    gone; over exploded rows it stays.
    """
    if not buckets:
        return terms, ["field", "term"]
    return (terms.withColumn("bucket", bucket_of("term", buckets)).filter(F.length("term") > 0),
            ["field", "bucket", "term"])


def key_lookup(key_postings: DataFrame, clauses: DataFrame, buckets: int = 0,
               small: bool | None = None) -> DataFrame:
    """Documents holding exactly one key in one column: ``…, doc_id, tf``."""
    terms, on = placed_terms(_key_terms(clauses), buckets)
    if small is None:
        small = fits_broadcast(terms)
    wanted = asked_rows(key_postings, "term", few_values(terms, "term") if small else None)
    hits = lookup_join(wanted, terms, on, small=small)
    return hits.select("query_id", "clause_id", "doc_id", "tf")


def key_status(key_dictionary: DataFrame, clauses: DataFrame, buckets: int = 0) -> DataFrame:
    """Every key clause with its document frequency, or the note that there is none."""
    terms = _key_terms(clauses)
    found = term_frequencies(key_dictionary, terms, buckets)
    return terms.join(found, ["field", "term"], "left").select(
        "query_id", "clause_id", "field", "term", F.coalesce("df", F.lit(0)).alias("df"),
        F.when(F.col("df").isNull(), F.lit(MISSING_TERM)).otherwise(F.lit("found")).alias("status"))


def key_and(key_hits: DataFrame, clauses: DataFrame) -> DataFrame:
    """Documents that hold the keys of all clauses of a query: ``query_id, doc_id``.

    Clauses count by id, so one key asked in two columns is two conditions.
    """
    needed = _key_terms(clauses).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_clauses"))
    # a key has one posting per column and document: each hit is another clause
    found = key_hits.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("n_found"))
    return (lookup_join(found, needed, ["query_id"])
            .filter(F.col("n_found") == F.col("n_clauses")).select("query_id", "doc_id"))


def key_search(key_postings: DataFrame, key_dictionary: DataFrame, clauses: DataFrame,
               buckets: int = 0) -> DataFrame:
    """Documents that hold the keys of all clauses of a query, rarest key first: ``query_id, doc_id``.

    The documents of each query's rarest key are found first; of the other keys only postings of these documents
    are counted, the rest is left behind by the scan that reads them.
    """
    small = fits_broadcast(clauses)
    keep = limit_to_rarest(clauses, small, [(_key_terms(clauses), key_dictionary, key_postings)], buckets)
    return key_and(keep(key_lookup(key_postings, clauses, buckets, small)), clauses)


def limit_to_rarest(clauses: DataFrame, small: bool, sources: list[tuple[DataFrame, DataFrame, DataFrame]],
                    buckets: int) -> Callable[[DataFrame], DataFrame]:
    """A filter for hits of queries that ask for two things or more, one of them a single term: only documents of
    the rarest such term stay.

    ``sources``: rows of terms that must be there (``query_id, clause_id, field, term``), the dictionary and the
    postings they are in. Documents of the rarest terms are found in one pass over their buckets, measured
    by the dictionary before they are read, and broadcast; queries whose rarest term has too many go unlimited.
    """
    needs = clauses.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("query_id")
    terms = [t.join(needs, "query_id", "left_semi") for t, _, _ in sources]
    if not small or not any(t.take(1) for t in terms):
        return lambda hits: hits
    counted = [
        t.join(term_frequencies(dictionary, t, buckets, True), ["field", "term"], "left")
        .select("query_id", "field", "term", F.coalesce("df", F.lit(0)).alias("df"), F.lit(no).alias("source"))
        for no, (t, (_, dictionary, _)) in enumerate(zip(terms, sources))]
    first = W.partitionBy("query_id").orderBy("df", "source", "field", "term")
    # a row for each query; the clauses are measured to be few
    together = W.orderBy("df", "query_id").rowsBetween(W.unboundedPreceding, 0)
    rarest = materialise(
        reduce(DataFrame.unionByName, counted).withColumn("_no", F.row_number().over(first)).filter("_no = 1")
        .withColumn("_sum", F.sum("df").over(together)).filter(F.col("_sum") <= MOST_LIMITING)
        .select("query_id", "field", "term", "source"), "rarest_terms")
    found = []
    for no, (_, _, postings) in enumerate(sources):
        asked = rarest.filter(F.col("source") == no)
        placed, on = placed_terms(asked.select("query_id", "field", F.explode(F.array("term")).alias("term")), buckets)
        wanted = asked_rows(postings, "term", few_values(asked, "term"))
        found.append(lookup_join(wanted, placed, on, small=True).select("query_id", "doc_id"))
    docs = materialise(reduce(DataFrame.unionByName, found).distinct(), "rarest_documents")
    limited = F.broadcast(rarest.select("query_id", F.lit(True).alias("_limited")))
    inside = F.broadcast(docs.withColumn("_inside", F.lit(True)))
    return lambda hits: (hits.join(limited, "query_id", "left").join(inside, ["query_id", "doc_id"], "left")
                         .filter(F.col("_limited").isNull() | F.col("_inside")).drop("_limited", "_inside"))


def clause_selectivity(key_dictionary: DataFrame, clauses: DataFrame,
                       buckets: int = 0) -> DataFrame:
    """Key clauses of each query, rarest key first. Unknown keys have frequency 0."""
    terms = _key_terms(clauses)
    found = term_frequencies(key_dictionary, terms, buckets)
    rows = terms.join(found, ["field", "term"], "left").select(
        "query_id", "clause_id", "field", "term", F.coalesce("cf", F.lit(0)).alias("cf"))
    order = W.partitionBy("query_id").orderBy("cf", "clause_id")
    return rows.withColumn("place", F.row_number().over(order))


def term_frequencies(dictionary: DataFrame, terms: DataFrame, buckets: int = 0,
                     small: bool | None = None) -> DataFrame:
    """Dictionary rows of the different terms asked for."""
    asked, on = placed_terms(terms.select("field", "term").distinct(), buckets)
    # unique on both sides, so neither form of the join can be skewed
    if small is None:
        small = fits_broadcast(asked)
    asked = F.broadcast(asked) if small else asked
    return dictionary.join(asked, on).select("field", "term", "df", "cf")


# --- words --------------------------------------------------------------------

def weigh_words(index: Index, rows: DataFrame, small: bool | None = None) -> DataFrame:
    """Word rows with ``idf`` and ``avg_len``; words the index lacks are dropped."""
    df = term_frequencies(index.dictionary, rows, index.buckets, small)
    # one row per field of the index
    weights = df.join(F.broadcast(index.stats), "field").select(
        "field", "term", bm25.idf(F.col("n_docs"), F.col("df")).alias("idf"), "avg_len")
    return lookup_join(rows, weights, ["field", "term"], spread=("query_id", "clause_id"),
                       small=small)


def term_search(index: Index, weighted: DataFrame, small: bool | None = None) -> DataFrame:
    """Hits of term and any-word clauses, one row per word and document."""
    terms, on = placed_terms(weighted.filter(F.col("kind") != "phrase"), index.buckets)
    hits = _postings_of(index, terms, on, ["doc_id", "tf", "doc_len"], small)
    return hits.select("query_id", "clause_id", "doc_id", bm25.score(
        F.col("idf"), F.col("tf"), F.col("doc_len"), F.col("avg_len")).alias("score"))


def _postings_of(index: Index, terms: DataFrame, on: list[str], columns: list[str],
                 small: bool | None) -> DataFrame:
    """Postings of the terms asked for, read once.

    Few terms are pushed into the scan. Of many, the dictionary knows which have very
    many postings.
    """
    if small is None:
        small = fits_broadcast(terms)
    postings = index.postings.select(*on, *columns)
    if small:
        return lookup_join(asked_rows(postings, "term", few_values(terms, "term")), terms, on, small=True)
    counts = index.dictionary.join(terms.select(*on).distinct(), on).select(*on, F.col("df").alias("_n"))
    return lookup_join(postings, terms, on, small=False, counts=counts)


def _all(hits: DataFrame) -> DataFrame:
    return hits


def phrase_search(index: Index, weighted: DataFrame, small: bool | None = None,
                  keep: Callable[[DataFrame], DataFrame] = _all) -> DataFrame:
    """Hits of phrase clauses: all words next to each other, in order.

    Documents that hold all words are found first, without positions, and stored;
    positions are then read and moved for those only. Word starts are intersected inside
    the row of a document. The frequency of a phrase is the number of its starts, its
    idf the sum over its words. ``keep`` filters documents before anything is shuffled.
    """
    words_of, on = placed_terms(weighted.filter(F.col("kind") == "phrase"), index.buckets)
    place = ["query_id", "clause_id", "doc_id"]
    # a phrase with a word the index lacks has too few rows and drops out here
    whole = materialise(
        keep(_postings_of(index, words_of, on, ["doc_id"], small)).groupBy(*place)
        .agg(F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words"))
        .filter("n = n_words").select(*place), "documents_with_all_words")
    hits = lookup_join(_postings_of(index, words_of, on, ["doc_id", "doc_len", "positions"], small),
                       whole, place, "left_semi")
    docs = hits.groupBy("query_id", "clause_id", "doc_id").agg(
        F.first("n_words").alias("n_words"),
        F.collect_list(F.transform("positions", lambda p: p - F.col("word_no"))).alias("starts"),
        F.sum("idf").alias("idf"),
        F.first("doc_len").alias("doc_len"), F.first("avg_len").alias("avg_len"),
    ).filter(F.size("starts") == F.col("n_words"))
    common = F.aggregate(
        F.slice("starts", 2, F.size("starts")), F.get("starts", F.lit(0)),
        lambda kept, word: F.array_intersect(kept, word))
    return (docs.withColumn("tf", F.size(common)).filter("tf > 0")
            .select("query_id", "clause_id", "doc_id", bm25.score(
                F.col("idf"), F.col("tf"), F.col("doc_len"), F.col("avg_len")).alias("score")))


# --- patterns -----------------------------------------------------------------

def term_expand(dictionary: DataFrame, clauses: DataFrame, default_field: str = DEFAULT_FIELD,
                small: bool | None = None, lookups: Lookups | None = None) -> DataFrame:
    """Dictionary terms that fit prefix, wildcard, fuzzy (two edits) and range clauses.

    A range is written ``low to high``, both ends included; in a wildcard ``*``
    stands for any characters and ``?`` for one.

    Patterns that say how their terms begin meet only such terms. With the lookup tables of a written
    index wildcards meet the terms of their rarest grams and fuzzy words those that share a deletion
    key; only wildcards without three characters in a row, and ranges over several first letters, still meet all
    terms of their field.
    """
    value = F.lower("value")
    ends = F.split(value, " to ")
    patterns = clauses.filter(F.col("kind").isin(PATTERN_KINDS)).select(
        "query_id", "clause_id", F.coalesce("field", F.lit(default_field)).alias("field"), "kind",
        value.alias("wanted"), F.get(ends, F.lit(0)).alias("low"), F.get(ends, F.lit(1)).alias("high"),
        F.concat(F.lit(r"^\Q"), F.replace(F.replace(value, F.lit("*"), F.lit(r"\E.*\Q")),
                                          F.lit("?"), F.lit(r"\E.\Q")), F.lit(r"\E$")).alias("regex"))
    kind = F.col("kind")
    fits = (F.when(kind == "prefix", F.startswith("term", "wanted"))
            .when(kind == "wildcard", F.rlike("term", "regex"))
            .when(kind == "fuzzy", F.levenshtein("term", "wanted", 2) >= 0)
            .otherwise(F.col("term").between(F.col("low"), F.col("high"))))
    # most patterns say how their terms begin: those meet only such terms
    first = F.nullif(F.substring("wanted", 1, 1), F.lit(""))
    begin = (F.when(kind == "prefix", first)
             .when((kind == "wildcard") & ~first.isin("*", "?"), first)
             .when((kind == "range") & (F.substring("low", 1, 1) == F.substring("high", 1, 1)),
                   F.substring("low", 1, 1)))
    way = F.when(begin.isNotNull(), "begin")
    if lookups:
        way = (way.when((kind == "wildcard") & (F.size(pattern_grams(F.col("wanted"))) > 0), "grams")
               .when(kind == "fuzzy", "deletions"))
    if small is None:
        small = fits_broadcast(clauses)
    patterns = patterns.withColumn("begin", begin).withColumn("way", way.otherwise("all"))
    terms = dictionary.select("field", "term", F.substring("term", 1, 1).alias("begin"))
    ways = {
        "begin": lambda asked: lookup_join(terms, asked, ["field", "begin"], spread=("term",), small=small),
        "grams": lambda asked: wildcard_candidates(lookups, asked, small),
        "deletions": lambda asked: fuzzy_candidates(lookups, asked, small),
        "all": lambda asked: lookup_join(terms.drop("begin"), asked, ["field"], spread=("term",), small=small),
    }
    needed = {r["way"] for r in patterns.select("way").distinct().collect()}  # at most four rows
    parts = [meet(patterns.filter(F.col("way") == name)) for name, meet in ways.items()
             if name in needed or name == "begin" and not needed]
    return reduce(DataFrame.unionByName, [
        p.filter(fits).select("query_id", "clause_id", "field", "term") for p in parts])


def pattern_search(index: Index, expanded: DataFrame,
                   keep: Callable[[DataFrame], DataFrame] = _all) -> DataFrame:
    """Hits of pattern clauses, one row per clause and document, all scored 1."""
    terms, on = placed_terms(expanded, index.buckets)
    hits = keep(_postings_of(index, terms, on, ["doc_id"], None))
    return (hits.select("query_id", "clause_id", "doc_id").distinct()
            .withColumn("score", F.lit(1.0)))


# --- documents ------------------------------------------------------------------

def _slice(hits: DataFrame) -> Column:
    """Slices grow with the cluster's shuffles, so they stay as small as partitions."""
    return even_slice(int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def _documents(hits: DataFrame, clauses: DataFrame, small: bool) -> DataFrame:
    """Matching documents of each query with ``slice``, their hash slice.

    One shuffle, by (query, slice): clause rows, documents and later the ranking
    inside a slice all use it. The hits of one query are spread over all slices.
    """
    if not small:
        hits = materialise(hits, "clause_hits")  # looked at more than once below
    placed = (hits.withColumn("slice", _slice(hits))
              .repartition(F.col("query_id"), F.col("slice")))
    per_clause = placed.groupBy("query_id", "slice", "doc_id", "clause_id").agg(
        F.sum("score").alias("score"))
    occur = clauses.select("query_id", "clause_id", "occur")
    needed = clauses.groupBy("query_id").agg(
        F.count_if(F.col("occur") == "must").alias("n_must"))
    known = lookup_join(per_clause, occur, ["query_id", "clause_id"], small=small)
    wanted = F.col("occur") != "must_not"
    docs = known.groupBy("query_id", "slice", "doc_id").agg(
        F.sum(F.when(wanted, F.col("score"))).alias("score"),
        F.count_if(F.col("occur") == "must").alias("must"),
        F.count_if(F.col("occur") == "must_not").alias("banned"))
    return (lookup_join(docs, needed, ["query_id"], small=small)
            .filter((F.col("must") == F.col("n_must")) & (F.col("banned") == 0)
                    & F.col("score").isNotNull())
            .select("query_id", "slice", "doc_id", "score"))


def boolean_search(hits: DataFrame, clauses: DataFrame) -> DataFrame:
    """Documents that meet all ``must`` clauses and no ``must_not`` clause.

    Without a ``must`` at least one ``should`` has to match. Scores add up.
    """
    return _documents(hits, clauses, fits_broadcast(clauses)).drop("slice")


def rank_bm25(matches: DataFrame, n: int | None = None) -> DataFrame:
    """The best ``n`` documents of each query, or all: adds ``rank``; ties by ``doc_id``.

    The best ``n`` are ranked inside slices first, then among what the slices kept.
    All are ranked by :func:`rank_all`.
    """
    if n is None:
        return rank_all(matches.drop("slice"))
    if "slice" not in matches.columns:
        matches = matches.withColumn("slice", _slice(matches))
    # sums of the same scores differ in the last digits with their order
    best_first = [F.round("score", 6).desc(), F.col("doc_id")]
    inside = W.partitionBy("query_id", "slice").orderBy(*best_first)
    among = W.partitionBy("query_id").orderBy(*best_first)
    kept = matches.withColumn("rank", F.row_number().over(inside)).filter(F.col("rank") <= n)
    return (kept.drop("slice").withColumn("rank", F.row_number().over(among))
            .filter(F.col("rank") <= n))


def rank_all(matches: DataFrame) -> DataFrame:
    """Every match with its rank. No task sorts all hits of a query.

    Matches are cut by range of (query, score, document), numbered inside a range, and
    moved on by the number of the query's matches in the ranges before.
    """
    parts = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["query_id", "_order", "doc_id"]
    # sums of the same scores differ in the last digits with their order
    placed = materialise(matches.withColumn("_order", -F.round("score", 6))
                         .repartitionByRange(parts, *order)
                         .withColumn("_range", F.spark_partition_id()), "ranges_of_hits")
    inside = W.partitionBy("query_id", "_range").orderBy("_order", "doc_id")
    before = W.partitionBy("query_id").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy("query_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    moved = sizes.select("query_id", "_range",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_at", F.row_number().over(inside))
    return (lookup_join(numbered, moved, ["query_id", "_range"])
            .withColumn("rank", F.col("_before") + F.col("_at"))
            .select(*matches.columns, "rank"))


def all_clause_hits(index: Index, clauses: DataFrame, default_field: str = DEFAULT_FIELD,
                    rest_field: str | None = None) -> DataFrame:
    """Hits of every kind of clause together. Small jobs look at the clauses first."""
    small, asked = survey(clauses, "kind", KINDS)
    return _clause_hits(index, clauses, small, asked, default_field, rest_field)


def _clause_hits(index: Index, clauses: DataFrame, small: bool, asked: set[str],
                 default_field: str, rest_field: str | None,
                 keep: Callable[[DataFrame], DataFrame] = _all) -> DataFrame:
    """Hits of the kinds asked for; branches for the others are left out of the plan.

    ``keep`` filters hits where postings are read, before they are shuffled.
    """
    parts = []
    if "key" in asked or not asked:
        keys = keep(key_lookup(index.key_postings, clauses, index.buckets, small))
        parts.append(keys.select("query_id", "clause_id", "doc_id", F.lit(0.0).alias("score")))
    if asked & set(WORD_KINDS):
        rows = clause_words(clauses, default_field, rest_field)
        few_words = fits_broadcast(rows)
        weighted = weigh_words(index, rows, few_words)
        if asked & {"term", "any_word"}:
            parts.append(keep(term_search(index, weighted, few_words)))
        if "phrase" in asked:
            parts.append(phrase_search(index, weighted, few_words, keep))
    if asked & set(PATTERN_KINDS):
        # the terms are needed twice: to measure them and to look them up
        expanded = materialise(
            term_expand(index.dictionary, clauses, default_field, small, index.lookups), "expanded_terms")
        parts.append(pattern_search(index, expanded, keep))
    return reduce(DataFrame.unionByName, parts)


def search(index: Index, clauses: DataFrame, n: int | None = None,
           default_field: str = DEFAULT_FIELD, rest_field: str | None = None) -> DataFrame:
    """Ranked hits of all queries: ``query_id, doc_id, score, rank``.

    Where a key or a word must be there beside other clauses, documents of the rarest one limit the hits of all others
    as they are read.
    """
    small, asked = survey(clauses, "kind", KINDS)
    must = clauses.filter(F.col("occur") == "must")
    sources = []
    if "key" in asked:
        sources.append((_key_terms(must), index.key_dictionary, index.key_postings))
    if "term" in asked:
        one = clause_words(must.filter(F.col("kind") == "term"), default_field).filter("n_words = 1")
        sources.append((one.select("query_id", "clause_id", "field", "term"), index.dictionary, index.postings))
    keep = limit_to_rarest(clauses, small, sources, index.buckets)
    hits = _clause_hits(index, clauses, small, asked, default_field, rest_field, keep)
    return rank_bm25(_documents(hits, clauses, small), n)
