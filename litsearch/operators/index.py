"""Inverted index tables.

``token_postings(field, term, doc_id, tf, doc_len, positions)`` for words,
``key_postings(field, term, doc_id, tf)`` for whole keys, a term dictionary for
either, and per-field statistics. Postings are made inside the row of each
document, so building them shuffles nothing.
"""

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsearch.fixed_values import KEY_COLUMNS
from litsearch.functions.runs import cut_runs, sorted_places, term_runs
from litsearch.functions.text import lower_keys, words


@dataclass(frozen=True)
class IndexConfig:
    """Which columns are key lists, which are searched, which are only returned.

    ``rest`` says what becomes of columns no other part names: ``searched`` (text and
    key lists; other types are stored), ``stored``, or nothing.
    """

    list_fields: tuple[str, ...] = ()
    text_fields: tuple[str, ...] = ()
    stored_fields: tuple[str, ...] = field(default=())
    position_gap: int = 0
    rest: str = ""

    @property
    def searched(self) -> tuple[str, ...]:
        return self.text_fields + self.list_fields

    def within(self, docs: DataFrame, doc_id: str = "doc_id") -> "IndexConfig":
        """The same choice for the columns the table has, every column of the rest named."""
        def have(names):
            return tuple(n for n in names if n in docs.columns)
        lists, texts, stored = (have(n) for n in (
            self.list_fields, self.text_fields, self.stored_fields))
        kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
        rest = [n for n in docs.columns if n not in {doc_id, *lists, *texts, *stored}]
        if self.rest == "searched":
            lists += tuple(n for n in rest if kinds[n] == "array<string>")
            texts += tuple(n for n in rest if kinds[n] == "string")
        if self.rest:
            stored += tuple(n for n in rest if n not in lists + texts)
        return replace(self, list_fields=lists, text_fields=texts, stored_fields=stored, rest="")


_TEXT = ("link", "title", "author", "content", "publisher", "year", "pages")

GENERAL = IndexConfig(
    list_fields=("ieee_keys", "author_keys", "merged_keys", "combined_topics"),
    text_fields=_TEXT,
    rest="searched",
)
TOPICS = IndexConfig(
    list_fields=("combined_topics", "merged_keys"),
    stored_fields=_TEXT + ("ieee_keys", "author_keys"),
    rest="stored",
)
KEYS = IndexConfig(
    list_fields=("ieee_keys", "author_keys", "merged_keys"),
    stored_fields=_TEXT,
    rest="stored",
)
PRESETS = {"general": GENERAL, "topics": TOPICS, "keys": KEYS}


def _token_stream(values: Column, gap: int) -> Column:
    """Words of all values of a field, one after the other.

    ``gap`` null places separate two values, so that no phrase spans them.
    """
    lists = F.filter(F.transform(values, words), lambda w: F.size(w) > 0)
    if gap:
        blank = F.array_repeat(F.lit(None).cast("string"), gap)
        lists = F.transform(lists, lambda w, i: F.when(i > 0, F.concat(blank, w)).otherwise(w))
    return F.flatten(lists)


def _per_field(docs: DataFrame, fields: dict[str, Column], doc_id: str) -> DataFrame:
    """One row per document and field: ``doc_id, field, entry``."""
    if not fields:
        return docs.select(F.col(doc_id).alias("doc_id"), F.lit("").alias("field"),
                           F.array().cast("array<string>").alias("entry")).filter(F.lit(False))
    entries = F.array(*[
        F.struct(F.lit(name).alias("field"), entry.alias("entry"))
        for name, entry in fields.items()
    ])
    return (docs.select(F.col(doc_id).alias("doc_id"), F.explode(entries).alias("e"))
            .select("doc_id", "e.field", "e.entry"))


def build_token_postings(docs: DataFrame, config: IndexConfig, doc_id: str = "doc_id") -> DataFrame:
    """Word postings of all searched fields, with the length of the field.

    Spark splits the texts and sorts the words of each row; runs of equal words are cut over many rows at a time.
    """
    config = config.within(docs, doc_id)
    none = F.array().cast("array<string>")
    fields = {f: F.array(F.coalesce(F.col(f), F.lit(""))) for f in config.text_fields}
    fields |= {f: F.coalesce(F.col(f), none) for f in config.list_fields}
    rows = _per_field(docs, fields, doc_id).select(
        "doc_id", "field", sorted_places(_token_stream(F.col("entry"), config.position_gap),
                                         with_nulls=config.position_gap > 0).alias("places"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut_runs(), f"field string, term string, doc_id {kind}, tf bigint, doc_len bigint, "
                                         "positions array<int>")


def build_key_postings(docs: DataFrame, fields: tuple[str, ...] = tuple(KEY_COLUMNS),
                       doc_id: str = "doc_id") -> DataFrame:
    """Whole-key postings: lower-cased keys, ``tf`` counts repeats in a document."""
    lists = {f: F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields}
    return (_per_field(docs, lists, doc_id)
            .select("doc_id", "field",
                    F.explode_outer(term_runs(lower_keys(F.col("entry")))).alias("run"))
            .filter(F.col("run").isNotNull())
            .select("field", "run.term", "doc_id", "run.tf"))


def term_dictionary(postings: DataFrame) -> DataFrame:
    """``(field, term, df, cf)``: documents holding a term, and its occurrences."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def sorted_dictionary(dictionary: DataFrame) -> DataFrame:
    """The dictionary in term order per field."""
    return dictionary.orderBy("field", "term")


def field_stats(postings: DataFrame) -> DataFrame:
    """``(field, n_docs, avg_len)``.

    Exactly one posting of a document's field holds position 0, so documents are
    counted without grouping by document.
    """
    opens = F.get("positions", F.lit(0)) == 0
    return postings.groupBy("field").agg(
        F.count_if(opens).alias("n_docs"),
        (F.sum("tf") / F.count_if(opens)).alias("avg_len"))


def doc_lengths(postings: DataFrame) -> DataFrame:
    """``(field, doc_id, doc_len)`` of every document that has words in the field."""
    return (postings.filter(F.get("positions", F.lit(0)) == 0)
            .select("field", "doc_id", "doc_len"))


def doc_store(docs: DataFrame, config: IndexConfig, doc_id: str = "doc_id") -> DataFrame:
    """What is returned with a hit."""
    config = config.within(docs, doc_id)
    names = config.stored_fields + config.searched
    return docs.select(F.col(doc_id).alias("doc_id"), *dict.fromkeys(names))
