"""Vectors of one label linked by cosine, found by counting collisions of projections.

All vectors are projected on ``PROJECTIONS`` random directions. On each, sorted, a query
collides with the points in a window centred on it, as wide to both sides as two unit vectors at the
least cosine are apart. A pair at that cosine collides on each direction with probability
0.683, independently, so the number of its collisions is binomial; pairs with at least the
count that such a pair reaches but once in 1 / ``MISSED`` times are verified by their cosine in
double precision. Pairs of higher cosine collide more often.

Equal vectors of a label are one class, compared once and counted with their number. The
classes of a label are cut into parts of ``PART``, and each pair of parts is a group of its own, so no task holds
a whole label; the work grows with the square of a label's classes, as windows hold a fixed
share of them. A task emits for each class how many it is linked with, and a spanning
forest, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite numbers, and rows
without a label, link with nothing. Vectors of different length do not link. Repeated rows
are vectors of their own. Columns other than id, vector and label are not read.
"""

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import table
from litsearch.llm.components import components
from litsearch.sources.scratch import materialise

COSINE = 0.93
PROJECTIONS, MISSED, SEED = 64, 1e-6, 9
PART, ROWS_AT_ONCE = 2048, 512


def least_count(projections: int = PROJECTIONS, missed: float = MISSED) -> int:
    """The highest count that a pair at the least cosine misses with at most this probability."""
    p, below = 0.6826894921370859, 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > missed:
            return count
    return projections


def collisions(points: np.ndarray, queries: np.ndarray, half: float) -> np.ndarray:
    """Queries x points: on how many directions (columns) the point is in the query's window."""
    out = np.zeros((len(queries), len(points)), np.uint8)
    for direction in range(points.shape[1]):
        order = np.argsort(points[:, direction])
        line = points[order, direction]
        centre = queries[:, direction]
        first = np.searchsorted(line, centre - half, "left").tolist()
        last = np.searchsorted(line, centre + half, "right").tolist()
        for row, a, b in zip(out, first, last):
            row[order[a:b]] += 1
    return out


def linked_pairs(vectors: np.ndarray, first: np.ndarray, other: np.ndarray, cosine: float = COSINE):
    """Pairs (of ``first``, of ``other``) that reach the cosine, some rows at a time."""
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
    lines = vectors / norm[:, None] @ directions
    half = np.sqrt(2 - 2 * cosine) * (1 + 1e-9)
    for at in range(0, len(first), ROWS_AT_ONCE):
        rows = first[at:at + ROWS_AT_ONCE]
        q, p = np.nonzero(collisions(lines[other], lines[rows], half) >= least_count())
        for some in range(0, len(q), 1 << 16):
            i, j = rows[q[some:some + (1 << 16)]], other[p[some:some + (1 << 16)]]
            near = np.einsum("ij,ij->i", vectors[i], vectors[j]) / (norm[i] * norm[j]) >= cosine
            yield i[near], j[near]


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked pairs; roots are the smallest of a tree."""
    n = len(root)
    a, b = root[i], root[j]
    for pair in np.unique(np.minimum(a, b) * n + np.maximum(a, b)).tolist():
        x, y = divmod(pair, n)
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        root[max(x, y)] = min(x, y)
    while (root[root] != root).any():
        root[:] = root[root]


def link_cell(rows: pa.Table) -> pa.Table:
    """A pair of parts: per class the vectors it is linked with here, and an edge towards its tree."""
    n = rows.num_rows
    dimension = len(rows["vector"][0])
    vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, dimension)
    number, copies, part = (rows[c].to_numpy() for c in ("class", "copies", "part"))
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    order = np.argsort(number)
    vectors, number, copies, part = vectors[order], number[order], copies[order], part[order]
    first, other = np.flatnonzero(part == low), np.flatnonzero(part == high)
    links, root = np.zeros(n, np.int64), np.arange(n)
    for i, j in linked_pairs(vectors, first, other):
        if low == high:
            i, j = i[i != j], j[i != j]
        else:
            np.add.at(links, j, copies[i])
        np.add.at(links, i, copies[j])
        merge(root, i, j)
    some = np.flatnonzero((links > 0) | (root != np.arange(n)))
    return pa.table({"class": number[some], "links": links[some], "towards": number[root[some]]})


def finite(vector) -> F.Column:
    """Can the vector have a cosine?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    named = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    fit = finite(F.col("vector")) & F.col("label").isNotNull()
    keys = ["label", "vector"]
    classes = (named.filter(fit).groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
               .withColumn("class", F.monotonically_increasing_id()))
    classes = materialise(classes, "vector_classes")  # numbers stay as they are
    group = ["label", "dimension"]
    sized = classes.withColumn("dimension", F.size("vector"))
    sizes = sized.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    cells = (sized.join(sizes, group)
             .withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(*group, F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"),
                     "part", "class", "copies", "vector"))
    found = materialise(cells.groupBy(*group, "low", "high").applyInArrow(
        link_cell, "class long, links long, towards long"), "vector_links")
    linked = components(found.select(F.col("class").alias("a"), F.col("towards").alias("b")))
    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    marked = (classes.join(counted, "class", "left")
              .join(linked.withColumnRenamed("node", "class"), "class", "left")
              .withColumn("component", F.coalesce("component", "class")))
    least = marked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    marked = marked.join(least, "component").select(
        *keys, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    with_class = named.filter(fit).join(marked, keys).select("vec_id", "n_links", "component_id")
    alone = named.filter(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return with_class.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)
"""
