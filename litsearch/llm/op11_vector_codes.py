"""Codes of vectors: four codebooks by Lloyd's rounds over partition-local cover trees.

Vectors become integers and are cut into ``PARTS`` equal parts; each part position has a codebook
of its own. A task takes ``BLOCK`` vectors at a time and builds a cover tree over the different
values of each part: a node has one of its points as centre and a radius; its children's
centres, its own among them, lie more than half of the radius apart and cover all its points within
that half. Points are ordered so that a subtree is a run of them, and cumulative counts
and sums over that order give those of any subtree by one subtraction. Trees are written once to the
shared folder; all rounds read them.

In a round, a node whose centre is nearer to one entry than to any other by more than
twice the radius goes to that entry as a whole, by the triangle inequality; only ambiguous nodes
are opened, and the points of ambiguous leaves are compared exactly. Distances are integers, and
radii are held against their roots with a margin, so a tie is always seen and goes to the lower
index.

Nothing but counts and sums of the entries, task by task, is shuffled in a round; the driver
holds the codebooks, ``PARTS * ENTRIES`` short vectors. Copies of a vector are one
point of a tree with a weight.

Defined cases: rows whose vector is null or holds null or non-finite components are left out, and
so are those whose length is not the commonest (the smaller of equally common ones) among lengths that
``PARTS`` divides; of a table without any, no row is left. Fewer than ``ENTRIES`` vectors make as many entries.
Repeated rows are vectors of their own: each of the smallest ids' rows starts an entry, rows of one
id by their components. Rows without an id get a code but start no entry. Components beyond
``vectors.largest`` (134 million of 64) count as that; a sum of errors that a long cannot hold is null.
Columns other than id, vector and label are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import run_starts, table
from litsearch.llm.vectors import (decimals, fitting_rows, floor_means, is_finite, label_sums, squared_distances,
                                   whole_numbers)
from litsearch.operators.joins import lookup_join
from litsearch.sources.scratch import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors to a tree, and points that a node keeps without children.
BLOCK, LEAF = 1024, 16
MARGIN = 1e-9
TREES = ("ids array<long>, labels array<string>, points array<binary>, weights array<binary>, "
         "nodes array<binary>, places array<binary>")
CODED = "vec_id long, label_key string, code string, error long"
BEGIN, END, CENTRE, RADIUS, CHILD, CHILDREN = range(6)


class CoverTree:
    """Points in tree order, and a row of ``nodes`` for each node: its run of points, centre, radius and children."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, nodes: np.ndarray):
        self.points, self.weights, self.nodes = points, weights, nodes
        # cumulative counts and sums: a subtree's are a difference of two rows
        self.counts = np.concatenate(([0], np.cumsum(weights)))
        weighted = points.astype(np.int64) * weights[:, None]
        self.sums = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(weighted, axis=0)))

    @classmethod
    def build(cls, vectors: np.ndarray) -> tuple["CoverTree", np.ndarray]:
        """The tree over the different vectors, and each vector's place among its points."""
        order = np.lexsort(vectors.T[::-1])
        new = np.concatenate(([True], (vectors[order[1:]] != vectors[order[:-1]]).any(axis=1)))
        points, which = vectors[order[new]], np.empty(len(vectors), np.int64)
        which[order] = np.cumsum(new) - 1
        far = np.sqrt(np.maximum(squared_distances(points, points), 0).astype(np.float64))
        run, nodes = np.arange(len(points)), []
        waiting = [(0, len(points), 0)]  # begin, end and centre of nodes not made yet, in order
        for begin, end, centre in waiting:
            inside = run[begin:end]
            radius = far[centre, inside].max()
            if end - begin <= LEAF or radius == 0:
                nodes.append((begin, end, centre, radius, 0, 0))
                continue
            centres, owner = cover(far, inside, centre, radius / 2)
            by_owner = np.argsort(owner, kind="stable")
            run[begin:end] = inside[by_owner]
            bounds = np.append(run_starts(owner[by_owner]), end - begin) + begin
            nodes.append((begin, end, centre, radius, len(waiting), len(centres)))
            waiting += zip(bounds[:-1].tolist(), bounds[1:].tolist(), centres)
        place = np.empty(len(points), np.int64)
        place[run] = np.arange(len(points))
        nodes = np.array(nodes, np.float64).reshape(-1, 6)
        nodes[:, CENTRE] = place[nodes[:, CENTRE].astype(np.int64)]
        weights = np.bincount(which, minlength=len(points))
        return cls(points[run], weights[run], nodes), place[which]

    def assign(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Runs of points (begin, end, entry) that cover all, and for how many points entries were compared."""
        n = len(self.points)
        nearest, first, second = np.full(n, -1), np.zeros(n), np.zeros(n)

        def compare(at: np.ndarray) -> None:
            at = np.unique(at[nearest[at] < 0])
            if not len(at):
                return
            squares = squared_distances(self.points[at], codebook)
            best = squares.argmin(axis=1)
            rows = np.arange(len(at))
            nearest[at], first[at] = best, np.sqrt(squares[rows, best].astype(np.float64))
            if squares.shape[1] > 1:
                squares[rows, best] = squares.max()
                second[at] = np.sqrt(squares.min(axis=1).astype(np.float64))
            else:
                second[at] = np.inf

        begin, end, entry = [], [], []

        def settle(begins: np.ndarray, ends: np.ndarray, entries: np.ndarray) -> None:
            begin.append(begins)
            end.append(ends)
            entry.append(entries)

        frontier = np.arange(min(1, len(self.nodes)))
        while len(frontier):
            node = self.nodes[frontier]
            centre = node[:, CENTRE].astype(np.int64)
            compare(centre)
            whole = (node[:, RADIUS] == 0) | (
                second[centre] * (1 - MARGIN) > first[centre] * (1 + MARGIN) + 2 * node[:, RADIUS])
            settle(*(node[whole][:, [BEGIN, END]].astype(np.int64).T), nearest[centre[whole]])
            node = node[~whole]
            leaf = node[:, CHILDREN] == 0
            points = spread(node[leaf, BEGIN], node[leaf, END] - node[leaf, BEGIN])
            compare(points)
            settle(points, points + 1, nearest[points])
            frontier = spread(node[~leaf, CHILD], node[~leaf, CHILDREN])
        none = [np.zeros(0, np.int64)]
        return *(np.concatenate(x or none) for x in (begin, end, entry)), int((nearest >= 0).sum())

    def codes(self, codebook: np.ndarray) -> np.ndarray:
        """Entry of each point."""
        begin, end, entry, _ = self.assign(codebook)
        out = np.zeros(len(self.points), np.int64)
        out[spread(begin, end - begin)] = np.repeat(entry, end - begin)
        return out

    def add_to(self, counts: np.ndarray, sums: np.ndarray, codebook: np.ndarray) -> None:
        """Counts and sums of the entries' members."""
        begin, end, entry, _ = self.assign(codebook)
        np.add.at(counts, entry, self.counts[end] - self.counts[begin])
        np.add.at(sums, entry, self.sums[end] - self.sums[begin])


def cover(far: np.ndarray, inside: np.ndarray, centre: int, reach: float) -> tuple[list[int], np.ndarray]:
    """Centres, the given one first, each farther than ``reach`` from the others; and the nearest one's number."""
    centres, near, owner = [centre], far[centre, inside], np.zeros(len(inside), np.int64)
    while near.max() > reach:
        centres.append(int(inside[near.argmax()]))
        other = far[centres[-1], inside]
        closer = other < near
        owner[closer] = len(centres) - 1
        near = np.where(closer, other, near)
    return centres, owner


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All whole numbers of the runs."""
    begin, size = begin.astype(np.int64), size.astype(np.int64)
    if not len(size):
        return begin
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def vector_length(rows: DataFrame, parts: int) -> int | None:
    """The commonest length that the number of parts divides."""
    sizes = rows.filter(is_finite("vector")).groupBy(F.size("vector").alias("n")).count()
    found = sizes.filter((F.col("n") > 0) & (F.col("n") % parts == 0)).orderBy(F.desc("count"), "n").first()
    return found["n"] if found else None


def first_codebooks(rows: DataFrame, dimension: int, scale: int, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors of smallest ids."""
    chosen = (rows.filter(is_finite("vector") & (F.size("vector") == dimension) & F.col("vec_id").isNotNull())
              .orderBy("vec_id", "vector").limit(entries).select("vector").collect())
    values = np.array([r.vector for r in chosen], np.float64).reshape(len(chosen), dimension)
    return np.split(whole_numbers(values, scale, dimension).astype(np.int64), parts, axis=1)


def build_trees(rows: DataFrame, dimension: int, scale: int, parts: int) -> DataFrame:
    """A row for each block of vectors: ids, labels and a tree for each part."""

    def block(ids: list, labels: list, numbers: np.ndarray) -> pa.RecordBatch:
        built = [CoverTree.build(part) for part in np.split(numbers, parts, axis=1)]
        blobs = [[tree.points.astype(np.int32) for tree, _ in built], [tree.weights for tree, _ in built],
                 [tree.nodes for tree, _ in built], [place.astype(np.int32) for _, place in built]]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())),
             *(pa.array([[x.tobytes() for x in some]], pa.list_(pa.binary())) for some in blobs)],
            names=["ids", "labels", "points", "weights", "nodes", "places"])

    def run(batches):
        ids, labels, numbers = [], [], np.zeros((0, dimension), np.int32)
        for batch in batches:
            at, new = fitting_rows(batch.column("vector"), dimension, scale)
            ids += batch.column("vec_id").take(pa.array(at)).to_pylist()
            labels += batch.column("label_key").take(pa.array(at)).to_pylist()
            numbers = np.concatenate((numbers, new))
            while len(numbers) >= BLOCK:
                yield block(ids[:BLOCK], labels[:BLOCK], numbers[:BLOCK])
                ids, labels, numbers = ids[BLOCK:], labels[BLOCK:], numbers[BLOCK:]
        if len(numbers):
            yield block(ids, labels, numbers)

    return rows.mapInArrow(run, TREES)


def trees_of(batch: pa.RecordBatch, width: int):
    """Ids, labels, trees and places of each block, one block at a time."""
    for i in range(batch.num_rows):
        points, weights, nodes, places = (
            [x.as_buffer() for x in batch.column(c)[i].values] for c in ("points", "weights", "nodes", "places"))
        trees = [CoverTree(np.frombuffer(p, np.int32).reshape(-1, width).astype(np.int64),
                           np.frombuffer(w, np.int64), np.frombuffer(n, np.float64).reshape(-1, 6))
                 for p, w, n in zip(points, weights, nodes)]
        yield (batch.column("ids")[i].values, batch.column("labels")[i].values, trees,
               [np.frombuffer(p, np.int32) for p in places])


def one_round(stored: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after all parts went to the nearest entry."""
    width, entries, parts = codebooks[0].shape[1], len(codebooks[0]), len(codebooks)

    def run(batches):
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, _, trees, _ in trees_of(batch, width):
                for k, tree in enumerate(trees):
                    tree.add_to(counts[k], sums[k], codebooks[k])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    added = (stored.mapInArrow(run, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
             .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")))
    found = added.collect()  # a row for each entry of each part
    return [floor_means(codebooks[k], {r.entry: (r.n, r.sums) for r in found if r.part == k}) for k in range(parts)]


def encode_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
                   rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label_key, code, error`` of every vector that fits, and the final codebooks.

    ``label_key`` is the label as a string; the code has two hex digits for each part.
    """
    named = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label_key"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    dimension = vector_length(named, parts)
    if dimension is None:
        return rows.sparkSession.createDataFrame([], CODED), []
    codebooks = first_codebooks(named, dimension, scale, parts, entries)
    if not len(codebooks[0]):
        return rows.sparkSession.createDataFrame([], CODED), []
    stored = materialise(build_trees(named, dimension, scale, parts), "cover_trees")
    for _ in range(rounds):
        codebooks = one_round(stored, codebooks)
    width = dimension // parts

    def run(batches):
        for batch in batches:
            for ids, labels, trees, places in trees_of(batch, width):
                codes, error = np.empty((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for k, (tree, place) in enumerate(zip(trees, places)):
                    entry = tree.codes(codebooks[k])
                    away = ((tree.points - codebooks[k][entry]) ** 2).sum(axis=1)
                    codes[:, k], error = entry[place], error + away[place]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(error)],
                    names=["vec_id", "label_key", "code", "error"])

    return materialise(stored.mapInArrow(run, CODED), "vector_codes"), codebooks


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = encode_vectors(table(spark, sf_dir, "embeddings"))
    # a null label is a label of its own
    keyed = found.withColumn("known", F.col("label_key").isNotNull()).fillna({"label_key": ""})
    sums = materialise(label_sums(keyed, "error", ["known", "label_key"], "label_error"), "label_errors")
    digest = hashlib.sha256(decimals(np.concatenate([c.ravel() for c in codebooks])).encode()).hexdigest() if codebooks else ""
    return lookup_join(keyed, sums, ["known", "label_key"], spread=("vec_id",)).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    steps = [f"""
WITH fine AS MATERIALIZED (
  SELECT vec_id, label, embedding AS v0, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
lengths AS (
  SELECT len(v) AS n FROM fine WHERE len(v) > 0 AND len(v) % {parts} = 0 GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, n // {parts} AS w, fine.* FROM fine JOIN lengths ON len(v) = n),
pieces AS MATERIALIZED (
  SELECT r, part, v[part * w + 1:part * w + w] AS v FROM vectors, range({parts}) AS t(part)),
c0 AS MATERIALIZED (
  SELECT part, e, pieces.v AS m FROM pieces JOIN (
    SELECT r, (row_number() OVER (ORDER BY vec_id, v0) - 1)::INTEGER AS e FROM vectors
    WHERE vec_id IS NOT NULL ORDER BY e LIMIT {entries}) USING (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, part, min((d, e)) AS best FROM (
    SELECT r, p.part, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, m)])::BIGINT AS d
    FROM pieces p JOIN c{i} c ON p.part = c.part)
  GROUP BY r, part)""")
        if i < rounds:
            steps.append(f"""
s{i} AS MATERIALIZED (
  SELECT part, e, list(floor_mean ORDER BY place) AS m FROM (
    SELECT part, best[2] AS e, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean FROM (
      SELECT part, best, unnest(v) AS x, unnest(generate_series(1, len(v))) AS place FROM a{i} JOIN pieces USING (r, part))
    GROUP BY ALL) GROUP BY part, e),
c{i + 1} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(s.m::BIGINT[], c.m) AS m FROM c{i} c LEFT JOIN s{i} s ON c.part = s.part AND c.e = s.e)""")
    final = f""",
coded AS (
  SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1]) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error::BIGINT AS error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY part, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN vectors USING (r)"""
    return ",".join(steps) + final


OP11_SQL = _sql()
