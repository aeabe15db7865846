"""Tab-separated document tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litsearch.functions.text import decode_list, encode_list
from litsearch.schemas import DOCUMENTS

# Quotes inside a quoted field are doubled, and blanks at the ends are data.
_FORMAT = {
    "sep": "\t",
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_docs_tsv(spark: SparkSession, path: str, schema: T.StructType = DOCUMENTS,
                  multi_line: bool = False) -> DataFrame:
    """Documents as text columns; an empty field is null.

    Tables written from flattened pages have no newline inside a row and large
    files are split. With ``multi_line`` a quoted field may hold a newline, and a
    file is one task.
    """
    return spark.read.schema(schema).options(**_FORMAT, multiLine=multi_line).csv(path)


def with_lists(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Key-list text columns as arrays."""
    return docs.withColumns({c: decode_list(F.col(c)) for c in columns})


def with_doc_id(docs: DataFrame) -> DataFrame:
    """A stable ``doc_id`` from all columns, for tables that carry none.

    Only rows that are equal in every column share it: two documents with one link,
    or with none, stay two. ``distinct_documents`` merges equal rows; writing an
    index raises if two documents still share an id.
    """
    names = [c for c in docs.columns if c != "doc_id"]
    return docs.withColumn("doc_id", F.xxhash64(F.to_json(F.struct(*names))))


def require_unique(docs: DataFrame, doc_id: str = "doc_id") -> None:
    """Raise if two rows share an id: searches count on one row per document."""
    repeated = docs.groupBy(doc_id).count().filter("count > 1").first()
    if repeated:
        raise ValueError(f"{doc_id} {repeated[doc_id]} belongs to {repeated['count']} documents")


def write_docs_tsv(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write with a header; arrays become ``;``-joined text."""
    columns = [
        (encode_list(F.col(f.name)) if isinstance(f.dataType, T.ArrayType)
         else F.col(f.name)).alias(f.name)
        for f in docs.schema.fields
    ]
    docs.select(*columns).write.mode(mode).options(**_FORMAT).csv(path)
