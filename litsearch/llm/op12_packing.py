"""Packing of documents into sequences: first fit decreasing in randomised groups.

A document is its token ids and the end id. What fills whole sequences is cut off its front;
the rest, shorter than a sequence, goes to a random group of about ``GROUP`` rests. In
a group, longest first, each rest goes to the first sequence with room for it, which a
tournament tree over the sequences' room finds in logarithmic time: a node holds the most
room below it. Sequences that are not full then take the rests of the emptiest ones, cut where
they have to be; what is left, less than a sequence for a group, is cut into
sequences whose lengths are powers of two, which need no padding. So nothing is padded, and few
documents are cut that would fit whole.

Groups are drawn by a hash of the row, not of the id, so rows that share an id spread too; their number
follows that of the rows. Rests are short, so a group is bounded however long the
texts are. Ids are written once, before anything is shuffled, with a number for each row: a
repeated task gives the same pieces.

Ids are those of the tokenizer's library. Where the vocabulary drops white space, no token spans it, and
each different word is encoded once by the library and remembered, up to a bound; see ``Encoder``.

Defined cases: a null or empty text is the end id alone. Rows that share an id, repeated ones too, are
documents of their own. A text of any length is cut into as many sequences as it fills. An empty table
gives no pieces. Columns other than id and text are not read.
"""

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import run_starts, table, texts
from litsearch.llm.op1_token_counts import byte_symbols
from litsearch.sources.scratch import materialise

LENGTH, END_ID = 2048, 1
GROUP, SEED = 1024, 12
#: Words a worker remembers, and the longest it remembers; bounds of memory, not of the result.
REMEMBERED, LONGEST_REMEMBERED = 1_000_000, 32
#: Fixed value: how vocabularies of this kind cut a text; what is between is white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for plain characters: those that have one small letter whatever stands beside them, never join
#: with others, and are letters, digits or signs to every library alike: printable ASCII, Latin and Cyrillic
#: letters, quotes and dashes.
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
OTHER = re.compile("[^!-~\u00a1\u00ab\u00bb\u00bf\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148"
                   "\u014a-\u017e\u0400-\u045f\u2013\u2014\u2018-\u201e\u2026]")
#: The printable character for each byte.
SHOWN = {byte: char for char, byte in byte_symbols().items()}
#: Bytes of text that are encoded at once, and of ids that are handed on.
BYTES_AT_ONCE = 12_000_000
CUT = "row long, doc_id long, doc_tokens long, start long, ids binary"
PACKED = "doc_id long, start long, ids binary, doc_tokens long, bin long, offset long"


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Ids of a piece that the vocabulary's merges see as one word, as bytes; those asked of late are remembered."""

    def __init__(self, model):
        self.model, self.older = model, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            shown = word if word.isascii() else "".join([SHOWN[b] for b in word.encode()])
            ids = as_bytes([t.id for t in self.model.tokenize(shown)])
        if len(word) <= LONGEST_REMEMBERED:
            self[word] = ids
        return ids

    def trim(self) -> None:
        """Words that were not asked since the last time go."""
        if len(self) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of a text, as the library has them.

    Where the vocabulary drops white space, each different chunk between ASCII blanks is looked at once for many
    texts. One of plain characters is put in small letters and cut by the vocabulary's pattern here, and its words
    handed to the library; one that is not plain, or holds an added token, goes to the library as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = is_plain_vocabulary(spec)
        self.words = Words(self.tokenizer.model)
        self.added = [t["content"] for t in spec["added_tokens"]]

    def encode(self, text: str) -> bytes:
        return as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def chunk(self, text: str) -> bytes:
        """Ids of a text without blanks."""
        if text.isascii():
            plain = text.isprintable()
        else:
            plain = not OTHER.search(text)
        if plain:
            small, words = text.lower(), self.words
            if small.isalpha():
                return words[small]
            if small[:-1].isalpha() and not small[-1].isdigit():  # a word and a sign
                return words[small[:-1]] + words[small[-1]]
            if not any(token in text for token in self.added):
                return b"".join([words[x] for x in PLAIN_WORDS.findall(small)])
        return self.encode(text)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin."""
        if self.by_word:
            self.words.trim()
            lists = pc.ascii_split_whitespace(texts)
            chunks = lists.flatten().dictionary_encode()
            known = [self.chunk(x) for x in chunks.dictionary.to_pylist()]
            which, bounds = chunks.indices.to_numpy(), lists.offsets.to_numpy()
        else:
            known = [self.encode(x) for x in texts.to_pylist()]
            which, bounds = np.arange(len(known)), np.arange(len(known) + 1)
        n = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begin, length = (np.cumsum(n) - n)[which], n[which]
        end = np.cumsum(length)
        at = np.repeat(begin - (end - length), length) + np.arange(end[-1] if len(end) else 0)
        return np.frombuffer(b"".join(known), "<u4")[at], np.concatenate(([0], end))[bounds - bounds[0]]


def is_plain_vocabulary(spec: dict) -> bool:
    """Does the vocabulary put texts in small letters, cut them by ``WORDS`` and drop the white space between?"""
    def steps(step: dict | None, inner: str) -> list[dict]:
        return (step or {}).get(inner) or [step or {}]

    before, cuts = steps(spec.get("normalizer"), "normalizers"), steps(spec.get("pre_tokenizer"), "pretokenizers")
    if [x.get("type") for x in before] != ["NFC", "Replace", "Lowercase"] or [
            x.get("type") for x in cuts] != ["Split", "ByteLevel"]:
        return False
    beside = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec["added_tokens"])
    return (cuts[0]["pattern"].get("Regex") == WORDS and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and not cuts[1].get("add_prefix_space") and not beside)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_documents(docs: DataFrame, vocabulary: str, length: int, end_id: int) -> DataFrame:
    """Pieces of at most ``length`` ids of every document; all but its last are full."""
    end, width = as_bytes([end_id]), 4 * length

    def record(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in columns[:4]), pa.array(columns[4], pa.binary())],
            names=["row", "doc_id", "doc_tokens", "start", "ids"])

    def run(batches):
        known = encoder(vocabulary)
        for batch in batches:
            texts_of = batch.column("text").fill_null("")
            size = pc.binary_length(texts_of).to_numpy(zero_copy_only=False).cumsum()
            first = np.append(run_starts(size // BYTES_AT_ONCE), len(size)).tolist()
            names = [batch.column(c).to_pylist() for c in ("row", "doc_id")]
            for a, b in zip(first[:-1], first[1:]):
                ids, bounds = known.ids(texts_of[a:b])
                rows, held = [], 0
                for i in range(a, b):
                    mine = ids[bounds[i - a]:bounds[i - a + 1]].tobytes() + end
                    for at in range(0, len(mine), width):
                        rows.append((names[0][i], names[1][i], len(mine) // 4, at // 4, mine[at:at + width]))
                    held += len(mine)
                    if held >= BYTES_AT_ONCE:
                        yield record(rows)
                        rows, held = [], 0
                yield record(rows)

    numbered = texts(docs).withColumn("row", F.monotonically_increasing_id())
    return numbered.select("row", "doc_id", "text").mapInArrow(run, CUT)


class Room:
    """Tournament tree over the room of sequences: finds the first with enough of it."""

    def __init__(self, sequences: int, length: int):
        self.size = 1
        while self.size < sequences:
            self.size *= 2
        self.most = [length] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        """Number of the first sequence with this much room, which is taken."""
        most, at = self.most, 1
        while at < self.size:
            at *= 2
            if most[at] < need:
                at += 1
        found = at - self.size
        most[at] -= need
        while at > 1:
            at //= 2
            left, right = most[2 * at], most[2 * at + 1]
            most[at] = left if left >= right else right
        return found


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Items of each sequence, the longest placed first; equal ones in their order."""
    room, bins = Room(len(sizes), length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = room.first_fit(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def fill(bins: list[list[int]], sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, begin, end), full or of a power of two: the emptiest ones fill the others' room."""
    held = [[(i, 0, sizes[i]) for i in items] for items in bins]
    full = [sum(sizes[i] for i in items) for items in bins]
    order = sorted((k for k in range(len(bins)) if full[k] < length), key=lambda k: -full[k])
    out = [held[k] for k in range(len(bins)) if full[k] == length]
    low, high = 0, len(order) - 1
    while low < high:
        target, donor = held[order[low]], held[order[high]]
        need = length - full[order[low]]
        while need and donor:
            item, begin, end = donor.pop()
            taken = min(need, end - begin)
            if taken < end - begin:
                donor.append((item, begin, end - taken))
            target.append((item, end - taken, end))
            need -= taken
            full[order[low]] += taken
            full[order[high]] -= taken
        if not need:
            out.append(target)
            low += 1
        if not donor:
            high -= 1
    if low == high and held[order[low]]:
        out += powers_of_two(held[order[low]], length)
    return out


def powers_of_two(pieces: list[tuple[int, int, int]], length: int) -> list[list[tuple[int, int, int]]]:
    """Cut a sequence into some whose lengths are powers of two; one of full length stays whole."""
    left, out = sum(end - begin for _, begin, end in pieces), []
    if left == length:
        return [pieces]
    pieces = pieces[::-1]
    while left:
        need, some = 1 << left.bit_length() - 1, []
        left -= need
        while need:
            item, begin, end = pieces.pop()
            taken = min(need, end - begin)
            some.append((item, begin, begin + taken))
            if taken < end - begin:
                pieces.append((item, begin + taken, end))
            need -= taken
        out.append(some)
    return out


def pack_group(length: int):
    """All rests of a group, packed."""

    def run(rests: pa.Table) -> pa.Table:
        ids, doc, tokens, start = (rests[c].to_pylist() for c in ("ids", "doc_id", "doc_tokens", "start"))
        order = np.argsort(rests["row"].to_numpy(), kind="stable").tolist()
        sizes = [len(ids[i]) // 4 for i in order]
        out = []
        for number, pieces in enumerate(fill(first_fit_decreasing(sizes, length), sizes, length)):
            offset = 0
            for item, begin, end in pieces:
                i = order[item]
                out.append((doc[i], start[i] + begin, ids[i][4 * begin:4 * end], tokens[i], number, offset))
                offset += end - begin
        columns = list(zip(*out))
        return pa.table({"doc_id": pa.array(columns[0], pa.int64()), "start": pa.array(columns[1], pa.int64()),
                         "ids": pa.array(columns[2], pa.binary()), "doc_tokens": pa.array(columns[3], pa.int64()),
                         "bin": pa.array(columns[4], pa.int64()), "offset": pa.array(columns[5], pa.int64()),
                         "group": pa.array([rests["group"][0].as_py()] * len(out), pa.int64())})

    return run


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """``doc_id, start, ids, doc_tokens, sequence_id, offset`` of every piece; ``ids`` little-endian 32-bit numbers.

    Full pieces have even sequence ids, those of groups odd ones.
    """
    named = texts(docs, id_col, text_col)
    pieces = materialise(cut_documents(named, vocabulary, length, end_id), "pieces")
    size = F.octet_length("ids")
    whole = (pieces.withColumn("sequence_id", F.monotonically_increasing_id() * 2).filter(size == 4 * length)
             .select("doc_id", "start", "ids", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset")))
    rests = pieces.filter(size < 4 * length)
    groups = max(1, -(-rests.count() // group))
    drawn = rests.withColumn("group", F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(groups)))
    packed = drawn.groupBy("group").applyInArrow(pack_group(length), PACKED + ", group long")
    # a group has at most as many sequences as ids
    number = F.col("group") * (2 * group * length) + F.col("bin")
    return whole.unionByName(packed.select("doc_id", "start", "ids", "doc_tokens",
                                           (2 * number + 1).alias("sequence_id"), "offset"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
