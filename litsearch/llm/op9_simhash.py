"""SimHash fingerprints, linked within a Hamming distance by vantage-point trees.

Fingerprints within 4 bits agree in all bits of at least B - 4 of B blocks. Every choice of
B - 4 blocks is the root of a forest: fingerprints equal in them (their distance to any
vantage point over these bits is the same, so the triangle bound leaves no other branch)
lie in one shard. Inside a shard a vantage-point tree halves the fingerprints by their
Hamming distance to a point; a query at distance d visits the near half if d <= median + 4
and the far half if d > median - 4, hence both only near the boundary. B grows with the
number of distinct fingerprints so that shards stay small.

Only distinct fingerprints are compared, once for any number of copies. A shard with more
than ``SHARD`` of them is cut into parts and each pair of parts is a task. A task emits the
edges of a spanning forest, not all pairs.

Defined cases: a text without words (null, empty, blanks) has fingerprint zero and links
like any other. Rows without an id take part but name no component; a component of such
rows only has id null. Repeated rows give repeated rows. Columns other than id and text
are not read.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import strings, table, texts
from litsearch.llm.components import components
from litsearch.operators.joins import lookup_join
from litsearch.sources.scratch import materialise

SHINGLE, SEED, BITS, DISTANCE = 4, 42, 64, 4
#: Distinct fingerprints a task compares with each other at most; pairs compared at a time.
SHARD, LEAF = 8192, 1 << 20
#: More blocks are used when shards of random fingerprints would be larger than this.
FULL_SHARD = 20_000


def fingerprint(text: str) -> int:
    """Bits set in more than half of the hashes of all 4-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(SHINGLE, len(words))
    begin = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begin, ends[k - 1:].tolist())], "<u8")
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bits`` (the fingerprint as a signed number) of every text."""

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t) for t in strings(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def block_masks(n: int) -> list[int]:
    """Masks of all choices of B - 4 blocks, for n distinct fingerprints."""
    blocks = DISTANCE + 1
    while n >> (BITS * (blocks - DISTANCE) // blocks) > FULL_SHARD and blocks < DISTANCE + 4:
        blocks += 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:])]
    return [sum(chosen) for chosen in combinations(single, blocks - DISTANCE)]


def near_pairs(points: np.ndarray, queries: np.ndarray, distance: int = DISTANCE):
    """Index arrays (point, query) of all pairs within the distance, a block at a time."""
    stack = [(np.arange(len(points)), np.arange(len(queries)))]
    while stack:
        p, q = stack.pop()
        if not len(p) or not len(q):
            continue
        if len(p) * len(q) > LEAF // 4:
            point = points[p[len(p) // 2]]
            to_p, to_q = np.bitwise_count(points[p] ^ point), np.bitwise_count(queries[q] ^ point)
            middle = int(np.median(to_p))
            near, far = to_p <= middle, to_p > middle
            q_near, q_far = to_q <= middle + distance, to_q.astype(int) > middle - distance
            if near.sum() * q_near.sum() + far.sum() * q_far.sum() < 0.9 * len(p) * len(q):
                stack += [(p[near], q[q_near]), (p[far], q[q_far])]
                continue
        step = max(1, LEAF // len(q))
        for at in range(0, len(p), step):
            i, j = np.nonzero(np.bitwise_count(points[p[at:at + step], None] ^ queries[q]) <= distance)
            if len(i):
                yield p[at + i], q[j]


def forest(values: np.ndarray, part: np.ndarray) -> np.ndarray:
    """For each value the first one it is linked with, directly or not, by pairs of two parts
    (or of one, if all are of one part)."""
    root = np.arange(len(values))
    first = np.flatnonzero(part == part[0])
    other = np.flatnonzero(part != part[0])
    other = other if len(other) else first
    for i, j in near_pairs(values[first], values[other]):
        a, b = root[first[i]], root[other[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        for x, y in {(x, y) for x, y in zip(*(u.tolist() for u in np.divmod(
                np.unique(low * len(values) + high), len(values)))) if x != y}:
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (root[root] != root).any():
            root = root[root]
    return root


def edges(distinct: DataFrame) -> DataFrame:
    """``a, b``: links that connect all fingerprints of ``distinct(bits)`` within the distance."""
    masks = block_masks(distinct.count())
    signed = F.array(*[F.lit(np.uint64(m).astype(np.int64).item()) for m in masks])
    shards = (distinct.select("bits", F.posexplode(signed).alias("tree", "mask"))
              .select("tree", F.col("bits").bitwiseAND(F.col("mask")).alias("shard"), "bits"))
    large = (shards.groupBy("tree", "shard").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > SHARD)
             .select("tree", "shard", F.ceil(F.col("n") * 2 / SHARD).cast("int").alias("parts")))
    # a part meets each part from itself on, and is met by those before it
    own = F.pmod(F.xxhash64("bits"), "parts").cast("int")
    cells = (shards.join(large, ["tree", "shard"], "left")
             .withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("tree", "shard", F.least("part", "with").alias("low"),
                     F.greatest("part", "with").alias("high"), "part", "bits"))
    keys = ["tree", "shard", "low", "high"]

    def link(batches):
        """Cells come sorted, whole cells in a row; only the unfinished one is held."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = tuple(held[k][-1].as_py() for k in keys)
            done = held.num_rows
            while done and tuple(held[k][done - 1].as_py() for k in keys) == last:
                done -= 1
            if done:
                yield from emit(held.slice(0, done))
                held = held.slice(done).combine_chunks()
        if held is not None and held.num_rows:
            yield from emit(held)

    def emit(rows: pa.Table):
        bits = rows["bits"].to_numpy().view(np.uint64)
        part = rows["part"].to_numpy()
        new = np.zeros(len(bits), bool)
        for k in keys:
            column = rows[k].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        new[0] = True
        bounds = np.append(np.flatnonzero(new), len(bits))
        a, b = [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo < 2:
                continue
            values = bits[lo:hi]
            root = forest(values, part[lo:hi])
            linked = np.flatnonzero(root != np.arange(hi - lo))
            a.append(values[linked])
            b.append(values[root[linked]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return (cells.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(link, "a long, b long").distinct())


def cluster(marked: DataFrame) -> DataFrame:
    """``bits, component, component_id`` (least fingerprint and least id that links reach) of every
    distinct fingerprint of ``marked(doc_id, bits)``."""
    distinct = marked.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    linked = components(edges(distinct.select("bits"))).withColumnRenamed("node", "bits")
    members = materialise(distinct.join(linked, "bits"), "linked_fingerprints")
    least = materialise(members.groupBy("component").agg(F.min("first_id").alias("component_id")), "component_ids")
    named = lookup_join(members, least, ["component"], spread=("bits",)).select("bits", "component", "component_id")
    # what has no link is its own component; a null id of linked ones stays null
    return distinct.join(named, "bits", "left").select(
        "bits", F.coalesce("component", "bits").alias("component"),
        F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, component`` (its least fingerprint as a signed number) of every row."""
    marked = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    found = lookup_join(marked, materialise(cluster(marked), "clusters"), ["bits"])
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id", "component")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents")).drop("component")
