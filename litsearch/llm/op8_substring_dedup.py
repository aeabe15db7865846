"""Removal of word sequences that occurred before, by fixed-block anchors.

The blocks of ``BLOCK`` words at places 0, BLOCK, 2 BLOCK ... of every text are the index.
As a window of ``WINDOW`` = 2 BLOCK words holds one of its own document's blocks whole, a
repeated window holds a block that occurs elsewhere at any place. So:

1. Every rolling window of BLOCK words is looked up in the index. Both go, as hashes, to
   the task of their bucket; a window is hit if its hash is that of a block and occurs
   twice or more. The answer is one bit for a window.
2. Around hits, windows of WINDOW words are compared in full (64 bits besides the bucket,
   which comes from other bits); all but the earliest are repeats, again one bit for each.
3. Overlapping repeats join into maximal ones and their words are removed.

Hashes travel packed, by part of a few megabytes of text and bucket, in text order, so that
no position has to be sent and bits find their way back. The number of buckets follows the
size of the texts. A passage in all documents takes four or eight bytes of each. Texts are
joined with their bits compressed.

Defined cases: a text that is null or has no words is empty, and no text under WINDOW words
loses any. Rows without an id come after all others. Rows that share an id are documents of
their own, none earlier than another. Columns other than id and text are not read.
"""

import numpy as np
import os
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import joined_bytes, mix, run_starts, table, texts, word_hashes, word_spans
from litsearch.sources.scratch import materialise

WINDOW = 20
BLOCK = WINDOW // 2
#: Bytes of text to a bucket, characters of text to a part, texts compressed at a time.
BUCKET_BYTES, PART_CHARS, TEXTS_AT_ONCE = 32 << 20, 1_000_000, 500
NO_ID = 2**63 - 1
ASKED = "bucket int, part long, counts binary, keys binary, ids binary"
ANSWERED = "part long, bucket int, counts binary, bits binary, ids binary"
DOCS = "doc_id long, digest long, packed binary"


def compress(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest, packed``; equal rows have equal digests."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for batch in (whole.slice(a, TEXTS_AT_ONCE) for a in range(0, whole.num_rows, TEXTS_AT_ONCE)):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").fill_null(NO_ID),
                    pa.array(np.array([xxhash.xxh64_intdigest(x) for x in raw], np.uint64).view(np.int64)),
                    pa.array([squeeze(x) for x in raw], pa.binary())], names=["doc_id", "digest", "packed"])

    return texts(docs, id_col, text_col).mapInArrow(run, DOCS)


class Part:
    """Words of some texts, hashed."""

    def __init__(self, values: list[str]):
        data, starts = joined_bytes(values)
        begin, end, first = word_spans(data, starts)
        self.first = first
        self.hash = word_hashes(data, begin, end)
        self.doc = np.repeat(np.arange(len(values)), np.diff(first))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words inside a text, and their hashes."""
        at = np.flatnonzero(np.arange(len(self.hash)) + k <= self.first[1:][self.doc])
        sums = np.zeros(len(at), np.uint64)
        for j in range(k):
            sums = sums * np.uint64(0xD6E8FEB86659FD93) + self.hash[at + j]
        return at, mix(sums)

    def places(self, at: np.ndarray) -> np.ndarray:
        return at - self.first[self.doc[at]]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def asked_rows(docs: int, doc: np.ndarray, bucket: np.ndarray, keys: np.ndarray, doc_ids: np.ndarray,
               digests: np.ndarray, buckets: int, with_ids: bool) -> pa.RecordBatch:
    """A row for each bucket that is asked, and one that names the part's documents."""
    part = int.from_bytes(os.urandom(8), "little", signed=True)
    order = np.argsort(bucket, kind="stable")
    doc, bucket, keys = doc[order], bucket[order], keys[order]
    cut = run_starts(bucket)
    bounds = np.append(cut, len(bucket)).tolist()
    rows = {"bucket": [part % buckets], "counts": [None], "keys": [digests.tobytes()],
            "ids": [doc_ids.tobytes()]}
    for a, b in zip(bounds[:-1], bounds[1:]):
        counts = np.bincount(doc[a:b], minlength=docs).astype(np.uint32)
        rows["bucket"].append(int(bucket[a]))
        rows["counts"].append(counts.tobytes())
        rows["keys"].append(keys[a:b].tobytes())
        rows["ids"].append(doc_ids[counts > 0].tobytes() if with_ids else None)
    n = len(rows["bucket"])
    return pa.RecordBatch.from_arrays([
        pa.array(rows["bucket"], pa.int32()), pa.array(np.full(n, part)),
        *(pa.array(rows[c], pa.binary()) for c in ("counts", "keys", "ids"))],
        names=["bucket", "part", "counts", "keys", "ids"])


def ask_blocks(buckets: int):
    """Step 1: rolling windows of BLOCK words; the lowest bit says if it is a block of the index."""

    def run(batches):
        for batch in batches:
            for ids, digests, values in parts(batch):
                part = Part(values)
                at, hashes = part.windows(BLOCK)
                block = part.places(at) % BLOCK == 0
                keys = (hashes.astype(np.uint32) & np.uint32(0xFFFFFFFE)) | block.astype(np.uint32)
                yield asked_rows(len(values), part.doc[at], bucket_of(hashes, buckets), keys,
                                 ids, digests, buckets, False)

    return run


def parts(batch: pa.RecordBatch):
    """Ids, digests and texts of some rows at a time; only those are unpacked."""
    ids, digests = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "digest"))
    expand = zstandard.ZstdDecompressor().decompress
    held, chars, at = [], 0, 0
    for i, packed in enumerate(batch.column("packed"), 1):
        held.append(expand(packed.as_py()).decode("utf-8", "surrogatepass"))
        chars += len(held[-1])
        if chars >= PART_CHARS or i == batch.num_rows:
            yield ids[at:i], digests[at:i], held
            held, chars, at = [], 0, i


def bits_of(blob: bytes | None, n: int) -> np.ndarray:
    """The first n answers of a text; without any, no."""
    if blob is None:
        return np.zeros(n, bool)
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def by_place(bits: list[np.ndarray], doc: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Answers came by text and bucket; put them in the order of the windows."""
    out = np.zeros(len(doc), bool)
    out[np.lexsort((bucket, doc))] = np.concatenate([*bits, np.zeros(0, bool)])
    return out


def near_hits(part: Part, blobs: list, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of WINDOW words that hold a window hit in step 1, and their hashes."""
    at, hashes = part.windows(BLOCK)
    n = np.bincount(part.doc[at], minlength=len(blobs)).tolist()
    hit = by_place([bits_of(b, k) for b, k in zip(blobs, n)], part.doc[at], bucket_of(hashes, buckets))
    before = np.zeros(len(part.hash) + 1, np.int64)
    before[at + 1] = hit
    before = np.cumsum(before)
    whole, keys = part.windows(WINDOW)
    some = before[whole + WINDOW - BLOCK + 1] > before[whole]
    return whole[some], keys[some]


def ask_windows(buckets: int):
    """Step 2: whole windows around the hits."""

    def run(batches):
        for batch in batches:
            answers, at = batch.column("bits").to_pylist(), 0
            for ids, digests, values in parts(batch):
                part = Part(values)
                where, keys = near_hits(part, answers[at:at + len(values)], buckets)
                at += len(values)
                yield asked_rows(len(values), part.doc[where], bucket_of(keys, buckets), keys,
                                 ids, digests, buckets, True)

    return run


def answer(decide, with_ids: bool):
    """All askers of a bucket at once; rows that name documents pass through."""

    def run(asked: pa.Table) -> pa.Table:
        rows = {c: asked[c].to_pylist() for c in ("part", "counts", "keys", "ids")}
        bucket = asked["bucket"][0].as_py()
        asking = [i for i, c in enumerate(rows["counts"]) if c is not None]
        out = {"part": rows["part"], "bucket": [bucket if c is not None else None for c in rows["counts"]],
               "counts": list(rows["counts"]), "bits": list(rows["keys"]), "ids": list(rows["ids"])}
        if asking:
            keys = [np.frombuffer(rows["keys"][i], np.uint64 if with_ids else np.uint32) for i in asking]
            doc_ids, own = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if with_ids:
                counts = [np.frombuffer(rows["counts"][i], np.uint32) for i in asking]
                counts = np.concatenate([c[c > 0] for c in counts])
                ids = np.concatenate([np.frombuffer(rows["ids"][i], np.int64) for i in asking])
                doc_ids, own = np.repeat(ids, counts), np.repeat(np.arange(len(ids)), counts)
            yes = decide(np.concatenate(keys), doc_ids, own)
            for i, bits in zip(asking, np.split(yes, np.cumsum([len(k) for k in keys])[:-1])):
                out["bits"][i], out["ids"][i] = np.packbits(bits).tobytes(), None
        return pa.table({"part": pa.array(out["part"], pa.int64()), "bucket": pa.array(out["bucket"], pa.int32()),
                         **{c: pa.array(out[c], pa.binary()) for c in ("counts", "bits", "ids")}})

    return run


def hit_blocks(keys: np.ndarray, *_) -> np.ndarray:
    """Does a window's hash occur twice, and once as a block of the index?"""
    order = np.argsort(keys >> np.uint32(1), kind="stable")
    sorted_keys = keys[order]
    first = run_starts(sorted_keys >> np.uint32(1))
    size = np.diff(np.append(first, len(keys)))
    indexed = np.maximum.reduceat(sorted_keys & np.uint32(1), first) > 0 if len(keys) else size > 0
    out = np.zeros(len(keys), bool)
    out[order] = np.repeat(indexed & (size > 1), size)
    return out


def repeats(keys: np.ndarray, doc_ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Did the window start before, in a document of smaller id or earlier in its own?"""
    order = np.argsort(keys, kind="stable")
    k, d, o = keys[order], doc_ids[order], own[order]
    first = run_starts(k)
    size = np.diff(np.append(first, len(k)))
    again = np.zeros(len(k), bool)
    again[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    least = np.repeat(np.minimum.reduceat(d, first), size) if len(k) else d
    out = np.zeros(len(k), bool)
    out[order] = again | (d > least)
    return out


def collect_part(answered: pa.Table) -> pa.Table:
    """Bits of a part by document, each document's by bucket."""
    rows = [answered[c].to_pylist() for c in ("bucket", "counts", "bits", "ids")]
    head = next(i for i, c in enumerate(rows[1]) if c is None)
    doc_ids, digests = (np.frombuffer(rows[c][head], np.int64) for c in (3, 2))
    bits, doc = [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    for i in sorted((i for i, c in enumerate(rows[1]) if c is not None), key=lambda i: rows[0][i]):
        counts = np.frombuffer(rows[1][i], np.uint32)
        doc.append(np.repeat(np.arange(len(counts)), counts))
        bits.append(bits_of(rows[2][i], int(counts.sum())))
    doc, bits = np.concatenate(doc), np.concatenate(bits)
    order = np.argsort(doc, kind="stable")
    bounds = np.searchsorted(doc[order], np.arange(len(doc_ids) + 1))
    bits = bits[order]
    some = [i for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if bits[a:b].any()]
    blobs = [np.packbits(bits[bounds[i]:bounds[i + 1]]).tobytes() for i in some]
    return pa.table({"doc_id": doc_ids[some], "digest": digests[some], "bits": pa.array(blobs, pa.binary())})


def exchange(asked: DataFrame, decide, with_ids: bool) -> DataFrame:
    """``doc_id, digest, bits`` of documents with a yes."""
    return (asked.groupBy("bucket").applyInArrow(answer(decide, with_ids), ANSWERED)
            .groupBy("part").applyInArrow(collect_part, "doc_id long, digest long, bits binary")
            .dropDuplicates(["doc_id", "digest"]))


def cut_out(buckets: int):
    """Step 3: words that are left, one blank between them."""

    def run(batches):
        for batch in batches:
            hits, again = (batch.column(c).to_pylist() for c in ("bits", "again"))
            at = 0
            for _, _, values in parts(batch):
                n_words, n_removed, kept = [], [], []
                part = Part(values)
                where, keys = near_hits(part, hits[at:at + len(values)], buckets)
                n = np.bincount(part.doc[where], minlength=len(values)).tolist()
                yes = by_place([bits_of(b, k) for b, k in zip(again[at:at + len(values)], n)],
                               part.doc[where], bucket_of(keys, buckets))
                edge = np.zeros(len(part.hash) + 1, np.int64)
                np.add.at(edge, where[yes], 1)
                np.add.at(edge, where[yes] + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                for i, text in enumerate(values):
                    words = text.encode("utf-8", "surrogatepass").split()
                    out = gone[part.first[i]:part.first[i + 1]]
                    n_words.append(len(words))
                    n_removed.append(int(out.sum()))
                    if n_removed[-1]:
                        words = [words[j] for j in np.flatnonzero(~out).tolist()]
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[at:at + len(values)], pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])
                at += len(values)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    packed = compress(docs, id_col, text_col)
    # written first: a part has a random number, which a task that is run again would draw anew
    asked = materialise(packed.mapInArrow(ask_blocks(buckets), ASKED), "asked_blocks")
    hits = materialise(exchange(asked, hit_blocks, False), "hits")
    hit = packed.join(hits, ["doc_id", "digest"], "left")
    asked = materialise(hit.mapInArrow(ask_windows(buckets), ASKED), "asked_windows")
    again = exchange(asked, repeats, True)
    marked = hit.join(again.withColumnRenamed("bits", "again"), ["doc_id", "digest"], "left")
    kept = marked.mapInArrow(cut_out(buckets), "doc_id long, n_words long, n_removed long, kept string")
    return kept.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
words AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM docs),
windows AS (
  SELECT doc_id, pos, md5(string_agg(word, ' ') OVER w) AS key, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (
  SELECT key, min((doc_id, pos)) AS first FROM windows WHERE n = 20 GROUP BY key),
marked AS (
  SELECT doc_id, pos, n = 20 AND (doc_id, pos) > first AS again FROM windows JOIN firsts USING (key)),
kept AS (
  SELECT w.doc_id, w.pos, w.word, coalesce(max(m.again::INTEGER) OVER (
           PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM words w LEFT JOIN marked m ON m.doc_id = w.doc_id AND m.pos = w.pos)
SELECT docs.doc_id, len(docs.words)::BIGINT AS n_words, count(*) FILTER (kept.gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT kept.gone), '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) GROUP BY docs.doc_id, docs.words
"""
