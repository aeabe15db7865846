"""Connected components of an edge table, without collecting it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litsearch.sources.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges(a, b)``.

    Alternates large-star (larger neighbours of a node move to its smallest) and
    small-star (smaller ones do) until nothing changes; a chain of n nodes takes about
    log n rounds. Each round is written, so a lost executor repeats one round at most.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialise(edges.distinct(), "edges")
    state = _digest(edges)
    while state["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (large.join(least, "a").filter("b <> least")
                 .select(F.col("b").alias("a"), F.col("least").alias("b")))
        edges = materialise(small.unionByName(least.withColumnRenamed("least", "b")).distinct(), "edges")
        before, state = state, _digest(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _digest(edges: DataFrame) -> dict:
    return edges.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first().asDict()
