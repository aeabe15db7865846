"""Lookup tables that find the dictionary terms of a pattern without meeting all terms.

``grams(field, gram, term)`` holds every run of ``GRAM`` characters of a term, its begin and its end marked;
``gram_counts(field, gram, n)`` how many terms have it. A wildcard's terms have all grams of its
literal parts, so those of its rarest grams are enough to test.

``segments(field, key, term)`` holds the three parts a term is cut into, hashed with its length and their number. Two
edits leave one of the three as it is, at most two places away: a fuzzy word asks for all its runs that may be a part of
a term of nearly its length. Three rows a term, however long it is.

An index written before there were segments has ``deletions(field, key, term)`` instead. It holds what is left of a term's first ``PREFIX`` characters when up to
``EDITS`` of them are deleted, hashed. Two terms at most ``EDITS`` apart share such a key: both come to the
first ``PREFIX - EDITS`` characters (or all) of what they have in common by deletions alone, at most
``EDITS`` each. A term has at most 37 keys, however long it is.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from litsearch.operators.joins import asked_rows, few_values, lookup_join
from litsearch.sources.scratch import materialise

GRAM = 3
# marks before the first and behind the last character of a term
BEGIN, END = "\u0002", "\u0003"
#: Grams of a pattern that are looked up; the others are left to the pattern itself.
RAREST = 2
EDITS, PREFIX = 2, 8
PARTS = EDITS + 1


@dataclass(frozen=True)
class Lookups:
    """The tables of one index, laid out in ``buckets`` folders."""

    grams: DataFrame
    gram_counts: DataFrame
    deletions: DataFrame | None
    buckets: int
    segments: DataFrame | None = None


def _grams_of(text: Column) -> Column:
    """Runs of ``GRAM`` characters; none of a shorter text."""
    last = F.length(text) - GRAM + 1
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, F.lit(GRAM))))
    ).otherwise(F.array().cast("array<string>"))


def term_grams(dictionary: DataFrame) -> DataFrame:
    """``field, gram, term``; a term of one character has one gram."""
    marked = F.concat(F.lit(BEGIN), "term", F.lit(END))
    return dictionary.select("field", F.explode(_grams_of(marked)).alias("gram"), "term")


def gram_counts(grams: DataFrame) -> DataFrame:
    return grams.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n"))


def deletion_keys(text: Column) -> Column:
    """Hashes of the text's first ``PREFIX`` characters without none, one or two of them."""
    prefix = F.substring(text, 1, PREFIX)
    n = F.length(prefix)
    left = [prefix]
    for i in range(1, PREFIX + 1):
        without = F.concat(F.substring(prefix, 1, i - 1), F.substring(prefix, i + 1, PREFIX))
        left.append(F.when(n >= i, without))
        for j in range(i + 1, PREFIX + 1):
            both = F.concat(F.substring(prefix, 1, i - 1), F.substring(prefix, i + 1, j - i - 1),
                            F.substring(prefix, j + 1, PREFIX))
            left.append(F.when(n >= j, both))
    return F.array_distinct(F.array_compact(F.array(*[F.when(x.isNotNull(), F.xxhash64(x)) for x in left])))


def term_deletions(dictionary: DataFrame) -> DataFrame:
    """``field, key, term``."""
    return dictionary.select("field", F.explode(deletion_keys(F.col("term"))).alias("key"), "term")


def _part_key(length: Column, part: Column, text: Column, begin: Column, size: Column) -> Column:
    return F.xxhash64(length.cast("int"), part.cast("int"), F.substr(text, begin + 1, size))


def _cut(length: Column, part: Column) -> Column:
    """Where a part of a term of this length begins."""
    return F.floor(length * part / PARTS).cast("int")


def segment_keys(text: Column) -> Column:
    """Keys of a term's parts."""
    n = F.length(text)
    parts = [F.lit(i) for i in range(PARTS)]
    return F.array(*[_part_key(n, i, text, _cut(n, i), _cut(n, i + 1) - _cut(n, i)) for i in parts])


def asked_segment_keys(text: Column) -> Column:
    """Keys one of which every term at most ``EDITS`` away has."""
    n = F.length(text)

    def of_part(length, part):
        begin, size = _cut(length, part), _cut(length, part + 1) - _cut(length, part)
        first, last = F.greatest(begin - EDITS, F.lit(0)), F.least(begin + EDITS, n - size)
        found = F.transform(F.sequence(first, F.greatest(first, last)), lambda at: _part_key(length, part, text, at, size))
        return F.when(first <= last, found).otherwise(F.array().cast("array<bigint>"))

    def of_length(length):
        return F.flatten(F.array(*[of_part(length, F.lit(i)) for i in range(PARTS)]))

    return F.array_distinct(F.flatten(F.transform(
        F.sequence(F.greatest(n - EDITS, F.lit(0)), n + EDITS), of_length)))


def term_segments(dictionary: DataFrame) -> DataFrame:
    """``field, key, term``."""
    return dictionary.select("field", F.explode(segment_keys(F.col("term"))).alias("key"), "term")


def bucketed(table: DataFrame, column: str, buckets: int) -> DataFrame:
    return table.withColumn("bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))


def pattern_grams(wanted: Column) -> Column:
    """Grams that every term of a wildcard has."""
    literal = F.split(F.concat(F.lit(BEGIN), wanted, F.lit(END)), r"[*?]+")
    return F.array_distinct(F.flatten(F.transform(literal, _grams_of)))


def _looked_up(table: DataFrame, asked: DataFrame, column: str, buckets: int, small: bool) -> DataFrame:
    """Rows of a lookup table that are asked for; only their buckets are opened."""
    asked = bucketed(asked, column, buckets).filter(F.col(column).isNotNull())
    on = ["field", "bucket", column]
    return lookup_join(asked_rows(table, column, few_values(asked, column) if small else None), asked, on,
                       spread=("term",) if "term" in table.columns else ("field",), small=small)


def wildcard_candidates(lookups: Lookups, patterns: DataFrame, small: bool) -> DataFrame:
    """``patterns`` with the terms that have their rarest grams; a pattern without a gram gets none."""
    place = ["query_id", "clause_id"]
    asked = patterns.select(*place, "field", F.explode(pattern_grams(F.col("wanted"))).alias("gram"))
    counted = _looked_up(lookups.gram_counts, asked.select("field", "gram").distinct(), "gram",
                         lookups.buckets, small).select("field", "gram", "n")
    # a gram no term has is the rarest
    known = asked.join(counted, ["field", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = W.partitionBy(*place).orderBy("n", "gram")
    rarest = materialise(known.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= RAREST)
                         .select(*place, "field", "gram"), "rarest_grams")
    needed = rarest.groupBy(*place).agg(F.count(F.lit(1)).alias("_needed"))
    met = _looked_up(lookups.grams, rarest, "gram", lookups.buckets, small)
    found = met.groupBy(*place, "field", "term").agg(F.count(F.lit(1)).alias("_met"))
    return (found.join(needed, place).filter("_met = _needed").select(*place, "field", "term")
            .join(patterns, [*place, "field"]))


def fuzzy_candidates(lookups: Lookups, patterns: DataFrame, small: bool) -> DataFrame:
    """``patterns`` with the terms that share a key."""
    place = ["query_id", "clause_id", "field"]
    table, keys = ((lookups.deletions, deletion_keys) if lookups.segments is None
                   else (lookups.segments, asked_segment_keys))
    asked = patterns.select(*place, F.explode(keys(F.col("wanted"))).alias("key"))
    met = _looked_up(table, asked, "key", lookups.buckets, small)
    return met.select(*place, "term").distinct().join(patterns, place)
