"""New pages are taken in once, however often the job runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.fixed_values import PAPER_LINK_BASE, PAPER_LINK_PATTERN
from litsearch.operators.pages import extract_outlinks, extract_papers, frontier, normalise_html
from litsearch.sources.history import LINKS, with_bucket, write_links


def extract_incremental(spark: SparkSession, source: str, out: str, checkpoint: str,
                        extract=extract_papers, whole_files: bool = False,
                        files_per_batch: int | None = None) -> None:
    """Extract pages not extracted before and append them to Parquet at ``out``.

    ``source`` is a folder of page-line files, or of one page per file with
    ``whole_files``. The checkpoint remembers which files were read; the sink
    commits each batch once. Returns when all files present are done.
    """
    reader = spark.readStream.format("text").option("wholetext", whole_files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.load(source).withColumnRenamed("value", "html")
    (extract(pages).writeStream.format("parquet")
     .option("path", out).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def visited_table(spark: SparkSession, path: str) -> DataFrame:
    """Links emitted so far, with the batch that emitted them and the hash they are stored by."""
    return spark.read.schema(f"{LINKS}, batch bigint, bucket int").parquet(path)


def add_new_links(pages: DataFrame, batch: int, visited_path: str,
                  pattern: str = PAPER_LINK_PATTERN, base: str = PAPER_LINK_BASE,
                  seed: DataFrame | None = None) -> None:
    """Write links of one batch of pages that no earlier batch emitted and ``seed`` lacks.

    The result goes to the folder of the batch, which a replay overwrites, and a
    replay does not count its own first try as visited. Of the history only folders that may
    hold links of the batch are opened.
    """
    spark = pages.sparkSession
    links = extract_outlinks(normalise_html(pages), pattern, base)
    try:
        seen = with_bucket(visited_table(spark, visited_path).filter(F.col("batch") < batch))
    except Exception as error:  # first batch: nothing was written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        seen = spark.createDataFrame([], "url string, bucket int")
    if seed is not None:
        seen = seen.unionByName(with_bucket(seed))
    write_links(frontier(links, seen), f"{visited_path}/batch={batch}", "overwrite")


def refresh_frontier_stream(pages: DataFrame, visited_path: str, checkpoint: str,
                            pattern: str = PAPER_LINK_PATTERN,
                            base: str = PAPER_LINK_BASE,
                            seed: DataFrame | None = None) -> None:
    """Run :func:`add_new_links` for every batch of a stream of pages.

    Emitted links live in a table, not in stream state, which would grow with
    the crawl. ``seed`` holds links visited before (``url``): a crawl's own list, or
    what :func:`compact_visited` made of an earlier stream's many small folders.
    """
    (pages.writeStream
     .foreachBatch(lambda df, batch: add_new_links(df, batch, visited_path, pattern, base, seed))
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def compact_visited(spark: SparkSession, visited_path: str, out: str) -> DataFrame:
    """Write all links emitted so far as one table of few files, to seed the next stream.

    It keeps the folders by hash, so a batch opens only its part of the seed too.
    """
    write_links(visited_table(spark, visited_path), out, "errorifexists")
    return spark.read.schema(f"{LINKS}, bucket int").parquet(out)
