"""Stored HTML pages as text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.functions.text import flatten_html


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """One page per line of text: ``value``. Splittable at any size."""
    return spark.read.text(path)


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """One page per file: ``file``, ``value`` on one line without newlines."""
    return spark.read.text(folder, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"),
        flatten_html(F.col("value")).alias("value"),
    )


def write_page_files(pages: DataFrame, path: str, page_id: str, column: str = "value") -> None:
    """Write pages to a new folder, one per file; rows that share an id are one page.

    Files lie beside each other, without a folder each. Tasks move their own files into place: nobody reads the
    folder before all are written, and a task that runs again writes files of the same names.
    """
    text = F.array_join(F.collect_list(F.coalesce(column, F.lit(""))), "\n")
    # the cost is that of the files, so tasks are even by pages, not by bytes
    tasks = 4 * pages.sparkSession.sparkContext.defaultParallelism
    (pages.repartition(tasks, page_id).groupBy(page_id).agg(text.alias("value")).select("value")
     .write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path))


def write_page_lines(pages: DataFrame, path: str, column: str = "value") -> None:
    """Append pages to a folder of text files, one page per line."""
    pages.select(flatten_html(F.col(column)).alias("value")).write.mode("append").text(path)


def row_cap(df: DataFrame, n: int = -1, order_by: str = "doc_id") -> DataFrame:
    """The first ``n`` rows in ``order_by`` order; -1 keeps all rows."""
    return df if n < 0 else df.orderBy(order_by).limit(n)


def peek(df: DataFrame, n: int = 1, order_by: str = "doc_id") -> DataFrame:
    """A look at the first rows."""
    return row_cap(df, n, order_by)


def count_documents(df: DataFrame) -> DataFrame:
    """One row holding the number of documents."""
    return df.agg(F.count(F.lit(1)).alias("n_documents"))
