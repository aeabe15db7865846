"""Wiki dumps in XML."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.schemas import WIKI_PAGES


PAGE_END = "</page>"
PAGE_START = r"<page(?:\s[^>]*)?>"


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<page>``; a folder reads all its dumps.

    The end tag of a page separates records, so one dump is cut into as many splits as its size
    asks for, and a page across two of them is read whole by the first. What lies before a page's begin, as the
    header of a dump does, and what follows the last page is no page. Texts hold end tags only escaped, as XML asks
    for. Only the fields of the schema are parsed. The redirect title is an XML attribute,
    hence the empty attribute prefix. Files that can be split when compressed (bzip2) are split too.
    """
    records = spark.read.option("lineSep", PAGE_END).text(path).select(
        F.regexp_extract("value", f"(?s){PAGE_START}.*", 0).alias("page"))
    page = F.from_xml(F.concat("page", F.lit(PAGE_END)), WIKI_PAGES, {"rowTag": "page", "attributePrefix": ""})
    return records.filter(F.length("page") > 0).select(page.alias("page")).select("page.*")


def write_wiki_dump(pages: DataFrame, path: str) -> None:
    """Write pages in the layout :func:`read_wiki_dump` reads."""
    as_attribute = pages.select(
        "id", "title", "revision",
        F.when(F.col("redirect.title").isNotNull(),
               F.struct(F.col("redirect.title").alias("_title"))).alias("redirect"),
    )
    (as_attribute.write.format("xml")
     .options(rootTag="mediawiki", rowTag="page", attributePrefix="_")
     .save(path))
