"""Page extraction and the link frontier."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litsearch.fixed_values import (
    PAPER_LINK_BASE, PAPER_LINK_PATTERN, PAPER_LISTS, PAPER_RULES, SHORTENED_ENDING,
)
from litsearch.functions.text import flatten_html
from litsearch.operators.joins import fits_broadcast
from litsearch.sources.history import possible_rows
from litsearch.sources.scratch import materialise

Rules = dict[str, tuple[str, int]]

# blanks and digits of every script count, and a dot stands for any character
WHOLE_UNICODE = "(?sU)"


def normalise_html(pages: DataFrame, column: str = "html") -> DataFrame:
    """Pages on one line each. Patterns below do not cross newlines: do this first."""
    return pages.withColumn(column, flatten_html(F.col(column)))


def extract_fields(pages: DataFrame, rules: Rules | None = None, html: str = "html") -> DataFrame:
    """First match of each rule as a column, ``''`` where there is none."""
    return pages.withColumns({
        column: F.regexp_extract(html, WHOLE_UNICODE + pattern, group)
        for column, (pattern, group) in (rules or PAPER_RULES).items()
    })


def extract_list(pages: DataFrame, column: str, block_pattern: str, item_pattern: str,
                 html: str = "html") -> DataFrame:
    """All items inside the first block as an array; no block gives an empty array."""
    block = F.regexp_extract(html, WHOLE_UNICODE + block_pattern, 1)
    return pages.withColumn(column, F.regexp_extract_all(
        block, F.lit(WHOLE_UNICODE + item_pattern), F.lit(1)))


def extract_papers(pages: DataFrame, html: str = "html") -> DataFrame:
    """All nine document columns of paper pages; other columns but the HTML are kept."""
    docs = extract_fields(normalise_html(pages, html), PAPER_RULES, html)
    for column, (block, item) in PAPER_LISTS.items():
        docs = extract_list(docs, column, block, item, html)
    return docs.drop(html)


def drop_without_content(docs: DataFrame) -> DataFrame:
    """Documents that have an abstract."""
    return docs.filter(F.length("content") > 0)


def extraction_quality(docs: DataFrame) -> DataFrame:
    """How many documents have no abstract, and how many a shortened one."""
    content = F.coalesce(F.col("content"), F.lit(""))
    return docs.agg(
        F.count_if(content == "").alias("n_no_content"),
        F.count_if(F.endswith(content, F.lit(SHORTENED_ENDING))).alias("n_shortened"),
    )


def extract_outlinks(pages: DataFrame, pattern: str = PAPER_LINK_PATTERN,
                     base: str = PAPER_LINK_BASE, html: str = "html",
                     page: str = "page_id") -> DataFrame:
    """Every document link of every page, absolute: ``page_id``, ``url``."""
    paths = F.regexp_extract_all(html, F.lit(WHOLE_UNICODE + pattern), F.lit(1))
    # outer explode: the inner form would add a filter that runs the pattern twice
    return (pages.select(page, F.explode_outer(paths).alias("path"))
            .filter(F.col("path").isNotNull())
            .select(page, F.concat(F.lit(base), F.col("path")).alias("url")))


def visited_links(pages: DataFrame) -> DataFrame:
    """Different links already fetched."""
    return pages.select("url").distinct()


def frontier(candidates: DataFrame, visited: DataFrame, page: str = "page_id",
             small: bool | None = None) -> DataFrame:
    """Links to fetch next, each with the first page that names it.

    Repeats of a link are merged before the shuffle, so a link that every page
    holds costs one row per task. Candidates measured to be small are broadcast to
    the history, which then is not shuffled and of which, if it is stored by bucket, only
    their folders are opened; others share the hash of ``url`` with it.
    """
    first_seen = materialise(candidates.groupBy("url").agg(F.min(page).alias(page)), "candidates")
    if small is None:
        small = fits_broadcast(first_seen)
    if small:
        known = possible_rows(visited, first_seen)
        known = known.join(F.broadcast(first_seen.select("url")), "url", "left_semi").distinct()
        # no more rows than there are candidates
        return first_seen.join(F.broadcast(known), "url", "left_anti")
    return first_seen.join(visited.select("url").distinct(), "url", "left_anti")


def frontier_counts(new_links: DataFrame, page: str = "page_id") -> DataFrame:
    """Number of links each page added."""
    return new_links.groupBy(page).agg(F.count(F.lit(1)).alias("n_added"))
