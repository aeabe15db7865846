"""Stand-ins for papers and a wiki, derived from the test tables.

The test tables hold neither paper pages nor a wiki dump; these views give them
the columns the operators work on. The same expressions are in ``oracle.py``.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.operators.index import GENERAL, IndexConfig
from litsearch.operators.pages import extract_fields, extract_list, normalise_html
from litsearch.operators.topics import merge_keys
from litsearch.plans.enrich import Enriched, enrich_corpus
from litsearch.sources.index_store import Index, build_index, read_index, write_index
from litsearch.sources.scratch import materialise, scratch_folder, spread_scan

PAGE_RULES = {
    "lang": (r'<html lang="([^"]*)"', 1),
    "page_title": (r"<title>(.*?)</title>", 1),
    "heading": (r"<h1>(.*?)</h1>", 1),
    "tracker": (r"track\(([0-9]+)\)", 1),
}
NAV_BLOCK = r"<nav>.*?<ul[^>]*>(.*?)</ul>"
NAV_ITEM = r"<li[^>]*><a[^>]*>(.*?)</a>"
LINK_PATTERN = r'href="(/[^"]*)"'
LINK_BASE = "https://example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_html(spread_scan(table(spark, sf_dir, "pages")))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document table from ``pages``."""
    html, url = F.col("html"), F.col("url")
    found = extract_list(flat_pages(spark, sf_dir), "ieee_keys", NAV_BLOCK, NAV_ITEM)
    found = extract_fields(found, {"title": PAGE_RULES["heading"]})
    docs = found.select(
        F.col("page_id").alias("doc_id"),
        url.alias("link"),
        "title",
        F.lit("").alias("author"),
        F.array_join(F.regexp_extract_all(html, F.lit(r"<p>(.*?)</p>"), F.lit(1)), " ").alias("content"),
        F.regexp_extract(url, r"^[a-z]+://([^/]*)", 1).alias("publisher"),
        F.regexp_extract(url, r"^[a-z]+://[^/]*/[^0-9]*([0-9]+)", 1).alias("year"),
        F.lit("").alias("pages"),
        "ieee_keys",
        F.filter(F.split("title", " "), lambda w: w != "").alias("author_keys"),
    )
    return merge_keys(docs)


def paper_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the layout of the paper rules, filled from ``papers``.

    With blanks and line ends of other kinds where real pages have them.
    """
    docs = papers(spark, sf_dir)

    def items(column):
        return F.concat(F.lit("<ul class=\"u\">"), F.array_join(F.transform(
            column, lambda k: F.concat(F.lit("<li class=\"i\"><a href=\"#\">"), k, F.lit("</a></li>"))),
            ""), F.lit("</ul>"))

    def meta(start, value):
        return F.concat(F.lit(start), F.replace(value, F.lit('"'), F.lit("")), F.lit('">'))

    odd = F.col("doc_id") % 2 == 1
    shortened = F.when(F.col("doc_id") % 7 == 1, F.lit("...")).otherwise(F.lit(""))
    blank = F.when(odd, F.lit("\u00a0")).otherwise(F.lit(" "))
    ending = F.when(F.col("doc_id") % 5 == 0, F.lit("\u2028and more\u0085.")).otherwise(F.lit(""))
    html = F.concat(
        meta('<meta name="parsely-link" content="', F.col("link")),
        meta('<meta  name="parsely-author" content="', F.col("publisher")),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(
            meta('<meta property="og:description" content="', F.concat(F.col("content"), shortened))),
        F.lit('<h1 class="document-title"><span>'), F.col("title"), ending, F.lit("</span></h1>"),
        F.lit("<strong>Page(s): </strong>"), blank, F.col("doc_id").cast("string"), F.lit("</div>"),
        F.lit("<span>Publisher:"), blank, F.lit('</span><!----><span class="p">'), F.col("publisher"), F.lit("</span>"),
        F.when(odd, F.lit("<b>Copyright Year: <b> ")).otherwise(F.lit("<b>Date of Publication: <b> ")),
        F.col("year"), F.lit("</b>"),
        F.lit("<strong>IEEE Keywords</strong>"), items("ieee_keys"),
        F.when(odd, F.lit("<strong>Author(s) Keywords</strong>"))
        .otherwise(F.lit("<strong>Author Keywords</strong>")), items("author_keys"),
    )
    return docs.select(F.col("doc_id").alias("page_id"), html.alias("html"))


def wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wiki pages from ``documents``."""
    docs = spread_scan(table(spark, sf_dir, "documents"))
    title = F.regexp_extract("text", r"(\S+)", 1)
    n = F.col("doc_id")
    text = F.concat(
        F.col("text"),
        F.when(n % 5 == 0, F.concat(F.lit(" "), title, F.lit(" is a field of study.")))
        .when(n % 5 == 1, F.concat(F.lit(" "), title, F.lit(" is a branch of science.")))
        .otherwise(F.lit("")),
        F.when(n % 11 == 0, F.lit("")).otherwise(F.concat(
            F.lit(" [[Category:"), F.col("source"), F.lit("|"), F.col("lang"), F.lit("]] [[Category:"),
            F.col("lang"), F.lit("]]"))),
    )
    redirect = F.when(n % 3 == 0, F.regexp_extract("text", r"^\s*\S+\s+(\S+)", 1))
    return docs.select(
        n.alias("id"), title.alias("title"),
        F.struct(text.alias("text")).alias("revision"),
        F.when(redirect.isNotNull(), F.struct(redirect.alias("title"))).alias("redirect"),
    )


def abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents some of which have no abstract or a shortened one."""
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(n % 7 == 0, F.lit("")).when(n % 7 == 1, F.concat("text", F.lit("...")))
        .otherwise(F.col("text")).alias("content"))


def clause_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Clause rows known to the driver, as a local relation whose size Spark knows."""
    names = ["query_id", "clause_id", "field", "kind", "value", "occur"]
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    return spark.createDataFrame(
        pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=schema))


# --- shared results: written once per session, read by many queries ------------

_shared: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def stored_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "papers", lambda: materialise(papers(spark, sf_dir), "papers"))


def enriched_papers(spark: SparkSession, sf_dir: str) -> Enriched:
    """Papers with topics from the keys of ``ieee_keys``."""
    def build():
        found = enrich_corpus(stored_papers(spark, sf_dir), wiki(spark, sf_dir), "ieee_keys", stored=True)
        return Enriched(materialise(found.docs, "enriched"), found.dictionary)
    return _once(spark, sf_dir, "enriched", build)


def _stored_index(spark: SparkSession, docs: DataFrame, config: IndexConfig) -> Index:
    path = scratch_folder(spark, "index")
    write_index(build_index(docs, config), path)
    return read_index(spark, path)


def document_index(spark: SparkSession, sf_dir: str) -> Index:
    """Index of the texts of ``documents``."""
    def build():
        docs = spread_scan(table(spark, sf_dir, "documents"))
        config = IndexConfig(text_fields=("text",), stored_fields=("lang", "source"))
        return _stored_index(spark, docs, config)
    return _once(spark, sf_dir, "document_index", build)


def plain_paper_index(spark: SparkSession, sf_dir: str) -> Index:
    """Index of the papers as they were extracted."""
    return _once(spark, sf_dir, "plain_paper_index", lambda: _stored_index(
        spark, stored_papers(spark, sf_dir), GENERAL))


def paper_index(spark: SparkSession, sf_dir: str) -> Index:
    """Index of the enriched papers, all columns searched."""
    return _once(spark, sf_dir, "paper_index", lambda: _stored_index(
        spark, enriched_papers(spark, sf_dir).docs, GENERAL))
