"""Lloyd's clusters of integer vectors, with a table of distances to pivots (LAESA).

A few fixed vectors are the pivots. Each vector's distance to all pivots is stored once,
beside its integer components. In a round the centroids' distances to the pivots are
taken; as ``|d(vector, pivot) - d(centroid, pivot)|`` never exceeds the distance of vector
and centroid, the largest over the pivots is a lower bound. The centroid of least bound gets
its exact distance first, then those whose bound does not exceed that. Bounds are floating point
and held against the exact distance with a margin, distances are integers, so ties go to
the smaller number exactly.

Vectors lie in the shared folder and are not shuffled; a task sends one row of counts and
sums for each centroid. Centroids and pivots, at most ``CLUSTERS`` and ``PIVOTS`` vectors, are all
that the driver holds.

Defined cases: rows whose vector is null, has another number of components, or holds null
or non-finite ones, are left out; repeated rows are vectors of their own, so a centroid may
have an equal of smaller number and stay empty. Rows without an id are clustered but start no
centroid. Of fewer vectors than ``CLUSTERS`` each starts one; without any the result is empty.
Components beyond ``vectors.largest`` (134 million of 64) count as that; sums over many vectors that
a long cannot hold are null. Columns other than id and vector are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import table
from litsearch.llm.vectors import (decimals, exact_sum, fitting_rows, floor_means, is_finite, squared_distances,
                                   whole_numbers)
from litsearch.sources.scratch import materialise

DIMENSION, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1"
#: Pivots are drawn, far from each other, from so many vectors.
PIVOTS, PIVOT_SAMPLE = 12, 256
MARGIN = 1e-9
STORED = "vec_id long, vector binary, pivots binary"
ASSIGNED = "vec_id long, cluster int, distance long"


def first_vectors(rows: DataFrame, dimension: int, scale: int, n: int, seed: str) -> np.ndarray:
    """The n vectors of smallest hash of seed and id, hashes ascending; of one id by their components."""
    chosen = (rows.filter(is_finite("vector") & (F.size("vector") == dimension) & F.col("vec_id").isNotNull())
              .withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
              .orderBy("hash", "vector").limit(n).select("vector").collect())
    values = np.array([r.vector for r in chosen], np.float64).reshape(len(chosen), dimension)
    return whole_numbers(values, scale, dimension).astype(np.int64)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Vectors of the sample, each as far as can be from those before it."""
    chosen, near = [0], squared_distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared_distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def store(rows: DataFrame, pivots: np.ndarray, dimension: int, scale: int) -> DataFrame:
    """The pivot table: every vector that fits, and its distances to the pivots."""

    def run(batches):
        for batch in batches:
            at, numbers = fitting_rows(batch.column("vector"), dimension, scale)
            far = np.sqrt(squared_distances(numbers, pivots).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), packed(numbers), packed(far)],
                names=["vec_id", "vector", "pivots"])

    return rows.mapInArrow(run, STORED)


def packed(matrix: np.ndarray) -> pa.Array:
    """Each row as bytes."""
    width = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


def unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def lower_bounds(far: np.ndarray, centroids_far: np.ndarray) -> np.ndarray:
    """Vectors x centroids: the largest difference of their distances to a pivot."""
    out = np.zeros((len(far), len(centroids_far)))
    for p in range(far.shape[1]):
        np.maximum(out, np.abs(far[:, p, None] - centroids_far[None, :, p]), out=out)
    return out


def nearest(vectors: np.ndarray, far: np.ndarray, centroids: np.ndarray,
            centroids_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, the exact squared distance, and how many distances that took."""
    bound = lower_bounds(far, centroids_far)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    first = bound.argmin(axis=1)
    left = np.zeros(bound.shape, bool)
    left[np.arange(len(first)), first] = True
    _fill(exact, left, vectors, centroids)
    reached = np.sqrt(exact[np.arange(len(first)), first].astype(np.float64))
    rest = (bound <= (reached * (1 + MARGIN) + MARGIN)[:, None]) & ~left
    _fill(exact, rest, vectors, centroids)
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(len(cluster)), cluster], len(vectors) + int(rest.sum())


def _fill(exact: np.ndarray, asked: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> None:
    for c in range(len(centroids)):
        rows = np.flatnonzero(asked[:, c])
        if len(rows):
            exact[rows, c] = squared_distances(vectors[rows], centroids[c:c + 1])[:, 0]


def assigned(batches, centroids: np.ndarray, pivots: np.ndarray):
    """Of each batch: ids, vectors, clusters, squared distances."""
    centroids_far = np.sqrt(squared_distances(centroids, pivots).astype(np.float64))
    for batch in batches:
        if batch.num_rows:
            vectors = unpacked(batch.column("vector"), np.int32, centroids.shape[1])
            far = unpacked(batch.column("pivots"), np.float64, len(pivots))
            yield batch.column("vec_id"), vectors, *nearest(vectors, far, centroids, centroids_far)[:2]


def one_round(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after all vectors went to the nearest."""

    def run(batches):
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for _, vectors, cluster, _ in assigned(batches, centroids, pivots):
            counts += np.bincount(cluster, minlength=len(counts))
            for c in np.unique(cluster):
                sums[c] += vectors[cluster == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    added = (stored.mapInArrow(run, "cluster int, n long, sums array<long>").groupBy("cluster")
             .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(centroids.shape[1])]).alias("sums")))
    return floor_means(centroids, {r.cluster: (r.n, r.sums) for r in added.collect()})  # a row for each centroid


def cluster_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dimension: int = DIMENSION, scale: int = SCALE, clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every vector that fits, and the final centroids."""
    named = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    chosen = first_vectors(named, dimension, scale, clusters + PIVOT_SAMPLE, seed)
    centroids = chosen[:clusters]
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], ASSIGNED), centroids
    pivots = choose_pivots(chosen[clusters:] if len(chosen) > clusters else chosen, PIVOTS)
    stored = materialise(store(named, pivots, dimension, scale), "pivot_table")
    for _ in range(rounds):
        centroids = one_round(stored, centroids, pivots)

    def run(batches):
        for ids, _, cluster, distance in assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return materialise(stored.mapInArrow(run, ASSIGNED), "clusters"), centroids


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    # at most CLUSTERS rows
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(exact_sum("distance").alias("inertia")).collect()}
    whole = None if None in inertia.values() else sum(inertia.values())
    about = [(c, x, whole if whole is not None and whole < 2**63 else None,
              hashlib.sha256(decimals(centroids[c]).encode()).hexdigest()) for c, x in inertia.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(dimension: int = DIMENSION, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    steps = [f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding AS v0,
         [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dimension} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v0) - 1)::INTEGER AS c, v AS m FROM vectors
  WHERE vec_id IS NOT NULL ORDER BY c LIMIT {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min((d, c)) AS best FROM (
    SELECT r, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, m)])::BIGINT AS d FROM vectors, c{i})
  GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
s{i} AS MATERIALIZED (
  SELECT c, list(floor_mean ORDER BY place) AS m FROM (
    SELECT best[2] AS c, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean FROM (
      SELECT best, unnest(v) AS x, unnest(generate_series(1, {dimension})) AS place FROM a{i} JOIN vectors USING (r))
    GROUP BY ALL) GROUP BY c),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(s{i}.m::BIGINT[], c{i}.m) AS m FROM c{i} LEFT JOIN s{i} ON c{i}.c = s{i}.c)""")
    final = f"""
SELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance,
       sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia, sum(best[1]) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN vectors USING (r) JOIN c{rounds} ON c = best[2]"""
    return ",".join(steps) + final


OP13_SQL = _sql()
