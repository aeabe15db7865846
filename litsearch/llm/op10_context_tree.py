"""Code length of texts by context-tree weighting, beside a word unigram base.

A byte is eight binary decisions, the decision nodes being the prefixes of its bits. Each
has its own tree of contexts: the bytes before, up to ``DEPTH`` of them. A node of that
tree holds the Krichevsky-Trofimov estimate of its counts; its weighted probability is half
its own estimate and half the product of its children's. The prediction for a bit mixes the
estimates along the path of contexts by the weights that follow from the training counts.

Training counts are gathered from all training texts: every task counts byte strings of
``DEPTH`` + 1 and words, Spark adds the counts up. A context has a node of its own if at
least ``LEAST`` training bytes follow it: all but those that occur once, of which the children of a node share one leaf.
So a node stays whatever else is added. Contexts that
``NODE_SHARE`` of all bytes follow (at most 1 / NODE_SHARE of a depth) are weighed in the
driver and sent to all tasks. All others stay a Spark table: below each frequent context they
are weighed in the task of its bucket, by the decisions that were seen there and no others, which adds their weights up for it, and a place of a text
whose path leaves the frequent contexts is sent, once for each different byte string of some
texts, to the bucket of the context it enters. An entered context holds less than NODE_SHARE of
all places. A text ends with the byte FF, which UTF-8 does not use, and begins after such bytes.

Base: words lower-cased, then one end token; sum of log10((c + 0.1) / (N + 0.1 (V + 1))).
Counts of words that make up ``HOT_SHARE`` of all tokens (at most 1 / HOT_SHARE words) are
broadcast. Of all others each task sends every distinct word of its texts once, with its
places, to the bucket of its hash, where it meets its count; sums come back by text. Words
are told apart by 64 bits.

Defined cases: a null text is empty (one token, the end). Without training texts c, N and V
are 0 and every bit costs one bit. Repeated rows are scored one by one and each counts in
training. Columns other than id and text are not read.
"""

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import (joined_bytes, lower_ascii, run_starts, strings, table, word_hashes,
                                  word_spans)
from litsearch.llm.op3_language import held_out
from litsearch.llm.op7_byte_bpe import groups
from litsearch.sources.scratch import materialise

DEPTH = 4
LEAST = 2
NODE_SHARE = 2.0 ** -15
HOT_SHARE = 2.0 ** -12
END = 0xFF
CHARS_AT_ONCE = 2_000_000
WORDS_IN_BUCKET, TOKENS_IN_BUCKET = 200_000, 1 << 21
NODES_IN_BUCKET, BYTES_IN_BUCKET = 8_000, 1 << 23
NODES_AT_ONCE = 8_000
GRAM_BITS = 8 * (DEPTH + 1)
LOG2 = np.log10(2.0)


def context_bytes(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts with their ends, places to predict, and the text of each place."""
    parts = [x.encode("utf-8", "surrogatepass") for x in values]
    gap = bytes([END]) * DEPTH
    data = np.frombuffer(gap + b"".join(x + gap for x in parts), np.uint8)
    size = np.array([len(x) + 1 for x in parts], np.int64)
    start = DEPTH + np.cumsum(size + DEPTH - 1) - (size + DEPTH - 1)
    text = np.repeat(np.arange(len(parts)), size)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return data, np.repeat(start, size) + inside, text


def count_rows(values: list[str]):
    """Counted keys of some texts: kind 0 byte strings, 1 words, 2 texts."""
    data, places = context_bytes(values)[:2]
    gram = np.zeros(len(places), np.uint64)
    for back in range(DEPTH, -1, -1):
        gram <<= np.uint64(8)
        gram |= data[places - back]
    del data, places
    yield 0, *np.unique(gram, return_counts=True)
    raw, starts = joined_bytes(values)
    begin, end, _ = word_spans(raw, starts)
    yield 1, *np.unique(word_hashes(lower_ascii(raw), begin, end), return_counts=True)
    yield 2, np.zeros(1, np.uint64), np.array([len(values)])


def training_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, key, n`` over all texts; each task adds up its own before the shuffle."""

    def count(batches):
        for batch in batches:
            for group in groups(strings(batch.column("text")), CHARS_AT_ONCE * 2):
                for kind, key, n in count_rows(group):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), kind, np.int8)), pa.array(key.view(np.int64)),
                         pa.array(n.astype(np.int64))], names=["kind", "key", "n"])

    return (docs.select(F.col(text_col).alias("text"))
            .mapInArrow(count, "kind byte, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: Stirling's series after moving up by eight."""
    up = np.zeros_like(x)
    for i in range(8):
        up += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - up


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones seen at each of the 255 decisions of a byte, by level; nodes x 255."""
    levels = [counts.reshape(len(counts), 1 << i, 2, 128 >> i).sum(-1) for i in range(8)]
    both = np.concatenate(levels, axis=1)
    return both[..., 0], both[..., 1]


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    out = np.zeros(zeros.shape)
    seen = np.nonzero(zeros + ones)
    zeros, ones = zeros[seen], ones[seen]
    out[seen] = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)
    return out


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


def byte_log10(one: np.ndarray) -> np.ndarray:
    """log10 of each byte's probability from the probability of a one at each decision."""
    out = np.zeros((len(one), 256))
    at = 0
    for i in range(8):
        p = one[:, at:at + (1 << i)]
        both = np.stack([np.log10(1 - p), np.log10(p)], axis=2).reshape(len(one), 2 << i)
        out += np.repeat(both, 128 >> i, axis=1)
        at += 1 << i
    return out


def packed(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def suffix(context: np.ndarray, n: int) -> np.ndarray:
    """The nearest ``n`` bytes of contexts."""
    return context & np.uint64((1 << 8 * n) - 1)


def places_in(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, -1 if it is not there."""
    if not len(sorted_keys):
        return np.full(np.shape(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


@dataclass
class Nodes:
    """Contexts of each depth as sorted numbers, nearest byte lowest, and what their counts say."""

    context: list[np.ndarray]
    counts: list[np.ndarray]  # node x following byte
    parent: list[np.ndarray]  # place one depth up, -1 if the parent is not among these nodes
    rest: list[np.ndarray]  # counts without those of children
    stop: list[np.ndarray]  # weight of a node's own estimate, node x decision
    weight: list[np.ndarray]  # log of the weighted probability, node x decision


def weigh(context: list[np.ndarray], counts: list[np.ndarray], below: list[np.ndarray] | None = None,
          taken: list[np.ndarray] | None = None) -> Nodes:
    """Weights from the deepest contexts up. ``below`` and ``taken`` are the weights and counts of
    children that are not among these nodes."""
    levels = range(DEPTH + 1)
    parent = [np.full(len(context[0]), -1)] + [
        places_in(context[d - 1], suffix(context[d], d - 1)) for d in levels[1:]]
    rest, stop, weight = ([np.zeros(0)] * (DEPTH + 1) for _ in range(3))
    for d in reversed(levels):
        own = log_kt(*bit_counts(counts[d]))
        rest[d], stop[d], weight[d] = counts[d], np.ones_like(own), own
        if d < DEPTH:
            rest[d] = counts[d] - taken[d] if taken else counts[d].copy()
            split = below[d].copy() if below else np.zeros_like(own)
            has = parent[d + 1] >= 0
            np.subtract.at(rest[d], parent[d + 1][has], counts[d + 1][has])
            np.add.at(split, parent[d + 1][has], weight[d + 1][has])
            split += log_kt(*bit_counts(rest[d]))
            weight[d] = np.logaddexp(own, split) - np.log(2)
            stop[d] = np.exp(own - np.log(2) - weight[d])
    return Nodes(context, counts, parent, rest, stop, weight)


def predict(nodes: Nodes, start: list[tuple[np.ndarray, np.ndarray]]):
    """By depth: log10 of each byte where a path ends at a node, and the mixture and the weight left
    after it. ``start``: these two before each node whose parent is not among the nodes."""
    mixed, left = np.zeros((0, 255)), np.zeros((0, 255))
    for d in range(DEPTH + 1):
        at = nodes.parent[d]
        before = [np.zeros((len(at), 255)) for _ in range(2)]
        for mine, above, given in zip(before, (mixed, left), start[d]):
            mine[at >= 0] = above[at[at >= 0]]
            mine[at < 0] = given
        mixed, left = before
        mixed = mixed + left * nodes.stop[d] * kt_one(*bit_counts(nodes.counts[d]))
        left = left * (1 - nodes.stop[d])
        leaf = mixed if d == DEPTH else mixed + left * kt_one(*bit_counts(nodes.rest[d]))
        yield byte_log10(leaf).astype(np.float32), mixed, left


NODE = "depth int, context long, bytes array<struct<byte:int,n:bigint>>"


def by_depth(depth: np.ndarray, context: np.ndarray, lists: pa.ListArray):
    """For each depth: contexts in order; the place there, the byte and the count of all that follows them; rows."""
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    values = lists.flatten()
    byte, n = values.field("byte").to_numpy().astype(np.int64), values.field("n").to_numpy().astype(np.float64)
    for d in range(DEPTH + 1):
        mine = np.flatnonzero(depth == d)
        mine = mine[np.argsort(context[mine])]
        place = np.full(len(depth), -1)
        place[mine] = np.arange(len(mine))
        here = place[row] >= 0
        yield context[mine], (place[row[here]], byte[here], n[here]), mine


def dense(n_nodes: int, node: np.ndarray, byte: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros((n_nodes, 256))
    out[node, byte] = n
    return out


def decisions_of(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of each byte and what they were."""
    level = np.arange(8)
    return (1 << level) - 1 + (byte[:, None] >> (8 - level)), byte[:, None] >> (7 - level) & 1


@dataclass
class RareNodes:
    """Rare contexts of each depth in order, and of each decision seen after them what its counts say. The last row of
    these is that of every other decision."""

    context: list[np.ndarray]
    entry: list[np.ndarray]  # of each node: the frequent context its path leaves, and the byte it leaves by
    parent: list[np.ndarray]
    follows: list[tuple]  # node, byte, count
    key: list[np.ndarray]  # node * 256 + decision
    one: list[np.ndarray]  # estimate of a one
    rest_one: list[np.ndarray]  # the same by the counts without those of children
    stop: list[np.ndarray]
    weight: list[np.ndarray]


def weigh_rare(context: list[np.ndarray], follows: list[tuple], entry: list[np.ndarray]) -> RareNodes:
    """What :func:`weigh` does, for the decisions seen only: of all others the weight is one and a node's own
    estimate is as good as what is below it."""
    parent = [np.full(len(context[0]), -1)] + [
        places_in(context[d - 1], suffix(context[d], d - 1)) for d in range(1, DEPTH + 1)]
    out = RareNodes(context, entry, parent, follows, *([np.zeros(0)] * (DEPTH + 1) for _ in range(5)))
    below = None
    for d in reversed(range(DEPTH + 1)):
        node, byte, n = follows[d]
        decision, bit = decisions_of(byte)
        key, at = np.unique(node[:, None] * 256 + decision, return_inverse=True)
        n = np.repeat(n, 8)
        total, ones = (np.bincount(at.ravel(), x, minlength=len(key)) for x in (n, n * bit.ravel()))
        own = log_kt(total - ones, ones)
        rest, rest_ones, weight, stop = total, ones, own, np.ones(len(key))
        if d < DEPTH:
            up = parent[d + 1][out.key[d + 1] >> 8]
            at = np.searchsorted(key, up[up >= 0] * 256 + (out.key[d + 1][up >= 0] & 255))
            less, less_ones, split = (np.bincount(at, x[up >= 0], minlength=len(key)) for x in below)
            rest, rest_ones = total - less, ones - less_ones
            weight = np.logaddexp(own, split + log_kt(rest - rest_ones, rest_ones)) - np.log(2)
            stop = np.exp(own - np.log(2) - weight)
        below = total, ones, weight
        out.key[d], out.weight[d] = key, weight
        out.one[d] = np.append(kt_one(total - ones, ones), 0.5)
        out.rest_one[d] = np.append(kt_one(rest - rest_ones, rest_ones), 0.5)
        out.stop[d] = np.append(stop, 0.5 if d < DEPTH else 1.0)
    return out


def weighed_pieces(rows: pa.Table):
    """Rare contexts of a bucket, weighed, some entered contexts with all below them at a time."""
    rows = rows.combine_chunks().sort_by([("exit", "ascending"), ("byte", "ascending")])
    entry = rows["exit"].to_numpy().astype(np.int64) * 256 + rows["byte"].to_numpy()
    cuts = np.append(run_starts(entry), len(entry))
    a = 0
    while a < len(entry):
        b = int(max(cuts[np.searchsorted(cuts, a, "right")],
                    cuts[np.searchsorted(cuts, a + NODES_AT_ONCE, "right") - 1]))
        piece = rows.slice(a, b - a).combine_chunks()
        context, follows, order = zip(*by_depth(
            piece["depth"].to_numpy(), piece["context"].to_numpy().view(np.uint64), piece["bytes"].combine_chunks()))
        yield weigh_rare(list(context), list(follows), [entry[a:b][mine] for mine in order])
        a = b


def add_up(rows: pa.Table) -> pa.Table:
    """For each frequent context of a bucket: weights, counts and bytes of the rare ones entered from it."""
    exits = np.unique(rows["exit"].to_numpy())
    below, taken, entered = np.zeros((len(exits), 255)), np.zeros((len(exits), 256)), [bytearray() for _ in exits]
    for nodes in weighed_pieces(rows):
        for d in range(1, DEPTH + 1):
            exit_ = np.searchsorted(exits, nodes.entry[d] >> 8)
            top = nodes.parent[d] < 0
            for i in np.flatnonzero(top):
                entered[exit_[i]].append(int(nodes.entry[d][i]) & 255)
            at = nodes.key[d] >> 8
            mine = top[at]
            np.add.at(below, (exit_[at[mine]], nodes.key[d][mine] & 255), nodes.weight[d][mine])
            at, byte, n = nodes.follows[d]
            mine = top[at]
            np.add.at(taken, (exit_[at[mine]], byte[mine]), n[mine])
    return pa.table({"exit": pa.array(exits, pa.int32()),
                     "below": pa.array([packed(x) for x in below], pa.binary()),
                     "taken": pa.array([packed(x) for x in taken], pa.binary()),
                     "entered": pa.array([bytes(x) for x in entered], pa.binary())})


@dataclass
class Tree:
    """Frequent contexts; ``rare`` holds all others that have a node, by the context a path leaves and the byte
    it leaves by."""

    child: np.ndarray  # node x byte before -> node; n + node: the path ends there; 2 n + node: it enters a rare one
    first: np.ndarray  # first node of each depth
    log10: np.ndarray  # node x byte, where a path ends
    mixed: np.ndarray  # node x decision: the mixture down to a node that paths leave
    left: np.ndarray  # node x decision: the weight left for what is below
    rare: DataFrame
    n_rare: int
    n_bytes: int


def context_nodes(counts: DataFrame, least: int) -> DataFrame:
    """``depth, context, bytes, total`` of every context that at least ``least`` bytes follow."""
    mask = F.array(*[F.lit((1 << 8 * (d + 1)) - 1) for d in range(DEPTH + 1)])
    return (counts.filter("kind = 0").select("n", "key", F.posexplode(mask).alias("depth", "mask"))
            .groupBy("depth", F.col("key").bitwiseAND(F.col("mask")).alias("gram"))
            .agg(F.sum("n").alias("n"))
            .groupBy("depth", F.shiftright("gram", 8).alias("context"))
            .agg(F.collect_list(F.struct(F.col("gram").bitwiseAND(255).cast("int").alias("byte"), "n"))
                 .alias("bytes"),  # at most 256 of a context
                 F.sum("n").alias("total"))
            .filter((F.col("total") >= least) | (F.col("depth") == 0)))


def left_by(nodes: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rare contexts with the frequent one (``exit``) their path leaves and the ``byte`` it leaves by."""
    found = nodes
    for d in range(1, DEPTH):
        # at most 1 / NODE_SHARE rows of a depth
        known = frequent.filter(F.col("at_depth") == d).select(
            F.col("at_context").alias(f"c{d}"), F.col("state").alias(f"s{d}"))
        found = found.join(F.broadcast(known), (F.col("context").bitwiseAND((1 << 8 * d) - 1) == F.col(f"c{d}"))
                           & (F.col("depth") > d), "left")
    deepest = F.coalesce(*[F.when(F.col(f"s{d}").isNotNull(), d) for d in range(DEPTH - 1, 0, -1)], F.lit(0))
    exit_ = F.coalesce(*[F.col(f"s{d}") for d in range(DEPTH - 1, 0, -1)], F.lit(0))
    byte = F.expr("cast(shiftright(context, 8 * at) & 255 as int)")
    return found.withColumn("at", deepest).select(
        exit_.cast("int").alias("exit"), byte.alias("byte"), *[field.split()[0] for field in NODE.split(", ")])


def learn_tree(counts: DataFrame, least: int | None = None, share: float | None = None) -> Tree:
    """Nodes are the contexts that at least ``least`` bytes follow, frequent ones those that a ``share`` does."""
    spark = counts.sparkSession
    least, share = least or LEAST, share or NODE_SHARE
    n_bytes = counts.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    limit = max(least, int(np.ceil(n_bytes * share)))
    nodes = materialise(context_nodes(counts, least), "context_nodes")
    is_frequent = (F.col("total") >= limit) | (F.col("depth") == 0)
    names = [field.split()[0] for field in NODE.split(", ")]
    rows = nodes.filter(is_frequent).select(*names).toArrow().combine_chunks()
    lists = rows["bytes"].combine_chunks()
    context, follows, _ = map(list, zip(*by_depth(
        rows["depth"].to_numpy(), rows["context"].to_numpy().view(np.uint64),
        lists if isinstance(lists, pa.ListArray) else lists.chunk(0))))
    seen = [dense(len(c), *f) for c, f in zip(context, follows)]
    if not len(context[0]):
        context[0], seen[0] = np.zeros(1, np.uint64), np.zeros((1, 256))
    first = np.cumsum([0] + [len(c) for c in context])
    n, inner = int(first[-1]), int(first[DEPTH])
    frequent = spark.createDataFrame(pa.table({
        "at_depth": np.repeat(np.arange(DEPTH + 1, dtype=np.int32), np.diff(first)),
        "at_context": np.concatenate(context).view(np.int64), "state": np.arange(n, dtype=np.int32)}))
    rare = materialise(left_by(nodes.filter(~is_frequent), frequent), "rare_contexts")
    n_rare = rare.count()
    below, taken = np.zeros((inner, 255)), np.zeros((inner, 256))
    child = np.repeat(np.arange(n, n + inner, dtype=np.int32), 256).reshape(inner, 256)
    if n_rare:
        bucket = F.pmod("exit", F.lit(n_rare // NODES_IN_BUCKET + 64))
        sums = (rare.groupBy(bucket.alias("bucket"))
                .applyInArrow(lambda rows: add_up(rows), "exit int, below binary, taken binary, entered binary"))
        for row in sums.toLocalIterator():  # at most one of each frequent context
            below[row.exit], taken[row.exit] = np.frombuffer(row.below), np.frombuffer(row.taken)
            child[row.exit, list(row.entered)] = 2 * n + row.exit
    cut = first[1:DEPTH]
    weighed = weigh(context, seen, np.split(below, cut), np.split(taken, cut))
    for d in range(1, DEPTH + 1):
        byte = (context[d] >> np.uint64(8 * (d - 1))).astype(np.int64)
        child[first[d - 1] + weighed.parent[d], byte] = first[d] + np.arange(len(context[d]))
    none = (np.zeros((0, 255)), np.zeros((0, 255)))
    start = [(np.zeros((1, 255)), np.ones((1, 255)))] + [none] * DEPTH
    tables, mixed, left = zip(*predict(weighed, start))
    return Tree(child.reshape(-1), first, np.concatenate(tables), np.concatenate(mixed[:DEPTH]).astype(np.float32),
                np.concatenate(left[:DEPTH]).astype(np.float32), rare, n_rare, n_bytes)


def tree_scores(values: list[str], child: np.ndarray, first: np.ndarray, log10: np.ndarray):
    """log10 probability of the bytes of each text whose path stays among frequent contexts, and the number
    of all; of the others the byte string, the entered context and the text."""
    data, places, text = context_bytes(values)
    n, inner = len(log10), first[DEPTH]
    state = np.zeros(len(places), np.int32)
    for back in range(1, DEPTH + 1):
        going = np.flatnonzero(state < inner)
        state[going] = child[state[going].astype(np.int64) * 256 + data[places[going] - back]]
    away = np.flatnonzero(state >= 2 * n)
    cost = log10.reshape(-1)[(state % n).astype(np.int64) * 256 + data[places]].astype(np.float64)
    cost[away] = 0
    gram, exit_ = np.zeros(len(away), np.uint64), state[away].astype(np.int64) - 2 * n
    byte = np.zeros(len(away), np.int64)
    depth = np.searchsorted(first[:DEPTH], exit_, "right") - 1
    for back in range(DEPTH, -1, -1):
        gram = gram << np.uint64(8) | data[places[away] - back]
        if back:
            byte[depth == back - 1] = data[places[away] - back][depth == back - 1]
    return (np.bincount(text, cost, minlength=len(values)), np.bincount(text, minlength=len(values)),
            gram, exit_ * 256 + byte, text[away])


def rare_costs(gram: np.ndarray, rows: pa.Table, mixed: np.ndarray, left: np.ndarray) -> np.ndarray:
    """log10 of the last byte of each byte string whose path enters a rare context of the bucket."""
    context, (decision, bit) = gram >> np.uint64(8), decisions_of((gram & np.uint64(255)).astype(np.int64))
    cost = np.zeros(len(gram))
    for nodes in weighed_pieces(rows):
        path = [places_in(nodes.context[d], suffix(context, d)) for d in range(1, DEPTH + 1)]
        mine = np.flatnonzero(np.max(path, axis=0) >= 0)
        started = np.zeros(len(mine), bool)
        mix, rest, tail = np.zeros((len(mine), 8)), np.zeros((len(mine), 8)), np.zeros((len(mine), 8))
        for d, place in enumerate(path, 1):
            place = place[mine]
            on = np.flatnonzero(place >= 0)
            first = on[~started[on]]
            at = (nodes.entry[d][place[first]] >> 8)[:, None], decision[mine[first]]
            mix[first], rest[first] = mixed[at], left[at]
            started[on] = True
            at = places_in(nodes.key[d], place[on, None] * 256 + decision[mine[on]])
            mix[on] += rest[on] * nodes.stop[d][at] * nodes.one[d][at]
            rest[on] *= 1 - nodes.stop[d][at]
            tail[on] = nodes.rest_one[d][at]
        one = mix + rest * tail
        cost[mine] = np.log10(np.where(bit[mine] == 1, one, 1 - one)).sum(axis=1)
    return cost


def base_score(known: Column, c_end: int, n_tokens: Column, total: int, distinct: int) -> Column:
    return (known + float(np.log10(c_end + 0.1))
            - n_tokens * float(np.log10(total + 0.1 * (distinct + 1))))


TEXT, WORDS, CONTEXTS = range(3)
SCORED = ("part long, place int, doc_id long, n_tokens long, n_bytes long, score double, base double, known long, "
          "kind byte, bucket int, asked binary, at binary")
FOUND = "part long, place int, base double, known long"
FOUND_BELOW = "part long, place int, score double"


def asked_blobs(key: np.ndarray, text: np.ndarray, shift: np.uint64, n_texts: int):
    """By bucket (the key's highest bits): different keys with their uses, and the text of each use."""
    order = np.argsort(key, kind="stable")
    key, text = key[order], text[order].astype(np.uint16 if n_texts <= 1 << 16 else np.uint32)
    here = run_starts(key)
    distinct, where = key[here], np.append(here, len(key))
    uses = np.diff(where).astype(np.uint32)
    cut = run_starts(distinct >> shift)
    bounds = np.append(cut, len(distinct))
    press = zstandard.ZstdCompressor(level=1).compress
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield (int(distinct[a] >> shift), press(packed(distinct[a:b], uses[a:b])),
               press(packed(text[where[a]:where[b]])))


def read_blobs(asked: pa.Table):
    """What :func:`asked_blobs` wrote: part, keys, uses, texts, by row."""
    unpress = zstandard.ZstdDecompressor().decompress
    for part, blob, spots in zip(*(asked[c].to_pylist() for c in ("part", "asked", "at"))):
        blob, spots = unpress(blob), unpress(spots)
        n = len(blob) // 12
        uses = np.frombuffer(blob, np.uint32, n, n * 8)
        short = len(spots) == 2 * uses.sum(dtype=np.int64)
        yield part, np.frombuffer(blob, np.uint64, n), uses, np.frombuffer(spots, np.uint16 if short else np.uint32)


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every text.

    The last is the code length of a text's bytes and its end."""
    counts = materialise(training_counts(training, text_col), "training_counts")
    tree = learn_tree(counts)
    # an odd number parts exits and bytes evenly
    entries = max(64, tree.n_rare // NODES_IN_BUCKET, tree.n_bytes // BYTES_IN_BUCKET) | 1
    child, starts_at, log10, mixed, left = tree.child, tree.first, tree.log10, tree.mixed, tree.left
    words = counts.filter("kind = 1").select("key", F.col("n").alias("c"))
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.filter("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, distinct = sums[0] + ends, sums[1] + (1 if ends else 0)
    least = max(1, int(np.ceil(sums[0] * HOT_SHARE)))
    hot_rows = words.filter(F.col("c") >= least).toPandas()
    hot = hot_rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, hot_log = hot[order], np.log10(hot_rows["c"].to_numpy(np.float64)[order] + 0.1)
    bits = max(6, int(np.ceil(np.log2(max(2, sums[1] / WORDS_IN_BUCKET, sums[0] / TOKENS_IN_BUCKET)))))
    shift = np.uint64(64 - bits)

    def scan(values, doc_ids):
        """Rows of texts, and rows of words for the buckets."""
        part = int.from_bytes(os.urandom(8), "little", signed=True)
        raw, starts = joined_bytes(values)
        begin, end, first = word_spans(raw, starts)
        key = word_hashes(lower_ascii(raw), begin, end)
        n = np.diff(first)
        text = np.repeat(np.arange(len(values)), n)
        base, known = np.zeros(len(values)), np.zeros(len(values), np.int64)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            is_hot = hot[at] == key
            base = np.bincount(text[is_hot], hot_log[at[is_hot]], minlength=len(values))
            known = np.bincount(text[is_hot], minlength=len(values))
            key, text = key[~is_hot], text[~is_hot]
        places = len(values)
        cost, size, gram, entry, of = tree_scores(values, child, starts_at, log10)
        yield rows_of(
            part=pa.array(np.full(places, part)), place=pa.array(np.arange(places, dtype=np.int32)), doc_id=doc_ids,
            n_tokens=pa.array(n + 1, pa.int64()), n_bytes=pa.array(size.astype(np.int64)),
            score=pa.array(cost, pa.float64()), base=pa.array(base, pa.float64()),
            known=pa.array(known.astype(np.int64)), kind=pa.array(np.full(places, TEXT, np.int8)))
        gram |= (entry % entries).astype(np.uint64) << np.uint64(GRAM_BITS)
        for kind, asked in ((WORDS, asked_blobs(key, text, shift, places)),
                            (CONTEXTS, asked_blobs(gram, of, np.uint64(GRAM_BITS), places))):
            asked = list(asked)
            buckets, blobs, spots = zip(*asked) if asked else ((), (), ())
            yield rows_of(
                part=pa.array(np.full(len(asked), part)), kind=pa.array(np.full(len(asked), kind, np.int8)),
                bucket=pa.array(buckets, pa.int32()), asked=pa.array(blobs, pa.binary()),
                at=pa.array(spots, pa.binary()))

    def rows_of(**columns):
        n = len(columns["part"])
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kind)) for name, kind in fields],
                                          names=[name for name, _ in fields])

    arrow = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "byte": pa.int8(), "binary": pa.binary()}
    fields = [(field.split()[0], arrow[field.split()[1]]) for field in SCORED.split(", ")]

    def run(batches):
        for batch in batches:
            at = 0
            for group in groups(strings(batch.column("text")), CHARS_AT_ONCE):
                yield from scan(group, batch.column("doc_id").slice(at, len(group)))
                at += len(group)

    def look_up(asked: pa.Table, counted: pa.Table) -> pa.Table:
        key = counted["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        key = key[order]
        log = np.log10(counted["c"].to_numpy().astype(np.float64)[order] + 0.1)
        out = []
        for part, word, uses, text in read_blobs(asked):
            at = places_in(key, word)
            seen = at >= 0
            value = np.full(len(word), -1.0)
            value[seen] = log[at[seen]]
            place, of = np.unique(text, return_inverse=True)
            out.append(pa.table({
                "part": np.full(len(place), part), "place": place.astype(np.int32),
                "base": np.bincount(of, np.repeat(value, uses)).astype(np.float64),
                "known": np.bincount(of, np.repeat(seen, uses)).astype(np.int64)}))
        return pa.concat_tables(out) if out else pa.schema(
            [("part", pa.int64()), ("place", pa.int32()), ("base", pa.float64()),
             ("known", pa.int64())]).empty_table()

    def look_below(asked: pa.Table, rows: pa.Table) -> pa.Table:
        in_gram = np.uint64((1 << GRAM_BITS) - 1)
        grams = np.unique(np.concatenate([np.zeros(0, np.uint64)] + [g & in_gram for _, g, _, _ in read_blobs(asked)]))
        costs = rare_costs(grams, rows, mixed, left)
        out = []
        for part, gram, uses, text in read_blobs(asked):
            place, of = np.unique(text, return_inverse=True)
            cost = np.repeat(costs[np.searchsorted(grams, gram & in_gram)], uses)
            out.append(pa.table({"part": np.full(len(place), part), "place": place.astype(np.int32),
                                 "score": np.bincount(of, cost).astype(np.float64)}))
        return pa.concat_tables(out) if out else pa.schema(
            [("part", pa.int64()), ("place", pa.int32()), ("score", pa.float64())]).empty_table()

    scanned = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                      F.col(text_col).alias("text")).mapInArrow(run, SCORED), "scanned")
    bucket = F.shiftrightunsigned("key", int(shift)).cast("int").alias("bucket")
    columns = ["bucket", "part", "asked", "at"]
    found = (scanned.filter(F.col("kind") == WORDS).select(*columns).groupBy("bucket")
             .cogroup(words.filter(F.col("c") < least).select(bucket, "key", "c").groupBy("bucket"))
             .applyInArrow(look_up, FOUND))
    entered = F.pmod(F.col("exit").cast("long") * 256 + F.col("byte"), F.lit(entries)).cast("int").alias("bucket")
    below = (scanned.filter(F.col("kind") == CONTEXTS).select(*columns).groupBy("bucket")
             .cogroup(tree.rare.select(entered, *tree.rare.columns).groupBy("bucket"))
             .applyInArrow(look_below, FOUND_BELOW))
    own = scanned.filter(F.col("kind") == TEXT)
    sums = (own.select("part", "place", "doc_id", "n_tokens", "n_bytes", "score", "base", "known")
            .unionByName(found, allowMissingColumns=True).unionByName(below, allowMissingColumns=True)
            .groupBy("part", "place").agg(
                F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
                F.max("n_bytes").alias("n_bytes"), F.sum("score").alias("score"), F.sum("base").alias("base"), F.sum("known").alias("known")))
    end_known = 1 if ends else 0
    return sums.select(
        "doc_id", "n_tokens", (F.col("known") + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base_score(F.col("base"), ends, F.col("n_tokens"), total, distinct).alias("base_score"), "score",
        (F.col("score") / float(-LOG2) / F.col("n_bytes")).alias("bits_per_byte"))


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, docs.filter(~held_out("doc_id", 10, 0)))
    return scored.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "bits_per_byte")
