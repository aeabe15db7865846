"""Schemas of the tables that cross a file boundary."""

from pyspark.sql import types as T

from litsearch.fixed_values import DOCUMENT_COLUMNS


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema, as every delimited file of the corpus has."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


DOCUMENTS = text_schema(DOCUMENT_COLUMNS)
ENRICHED_DOCUMENTS = text_schema(DOCUMENT_COLUMNS + ["merged_keys", "combined_topics"])

WIKI_PAGES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
    T.StructField("redirect", T.StructType([T.StructField("title", T.StringType())])),
])

CLAUSES = "query_id string, clause_id int, field string, kind string, value string, occur string"
