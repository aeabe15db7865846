"""Token counts by byte-pair merging with a heap and a linked list.

The pieces of a text (words with their leading blank, numbers, signs, blanks) are
merged one by one: all adjacent pairs lie in a heap by merge rank, the lowest is
popped, its two symbols become one in a doubly linked list and the two new
neighbouring pairs are pushed. A piece has as many tokens as it had bytes, less its
merges; identifiers are never written out.

Defined cases: a null text counts as empty (0 bytes, 0 tokens). The string of an
added token in a text is that one token, as the tokenizer's library has it. Repeated
rows give repeated rows. Columns other than the id and the text are not read.
"""

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from litsearch.llm.common import strings, table, texts

#: Fixed value: how byte-level vocabularies of this kind cut a text into pieces.
#: Blanks are listed because libraries disagree on the control characters 1C-1F.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
          rf"| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
TOKEN_LIMIT = 1024
#: Pieces a worker remembers, and the longest it remembers; bounds of memory, not of the result.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 40
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PieceCounts(dict):
    """Tokens of a piece, worked out when first asked for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.byte_id = [0] * 256
        for char, byte in byte_symbols().items():
            self.byte_id[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # rank and merged symbol in one number: the lower the earlier
        self.base = max(vocab.values()) + 1
        self.merge = {vocab[a] * self.base + vocab[b]: rank * self.base + vocab[a + b]
                      for rank, (a, b) in reversed(list(enumerate(pairs)))}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(PIECES)

    def __missing__(self, piece: str) -> int:
        n = self.tokens(piece.encode())
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = n
        return n

    def tokens(self, data: bytes) -> int:
        n, base, merge = len(data), self.base, self.merge
        if n < 2:
            return n
        symbol = [self.byte_id[b] for b in data]
        heap = []
        for i in range(n - 1):
            found = merge.get(symbol[i] * base + symbol[i + 1])
            if found is not None:
                heap.append(found * n + i)
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            found, i = divmod(heappop(heap), n)
            j = after[i]
            if j >= n or merge.get(symbol[i] * base + symbol[j]) != found:
                continue  # one of the two is gone by now
            merged = found % base
            symbol[i], symbol[j] = merged, base * base  # no pair begins with the latter
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                found = merge.get(merged * base + symbol[k])
                if found is not None:
                    heappush(heap, found * n + i)
            h = before[i]
            if h >= 0:
                found = merge.get(symbol[h] * base + merged)
                if found is not None:
                    heappush(heap, found * n + h)
        return left

    def count(self, text: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        parts, n = [text], 0
        if self.added:
            parts = self.added.split(text)
            n = len(parts) - 1
        return n + sum(sum(map(self.__getitem__, self.pieces.findall(part))) for part in parts)


@lru_cache(maxsize=2)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = TOKEN_LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text; no shuffle."""

    def count(batches):
        counts = piece_counts(vocabulary)
        for batch in batches:
            values = strings(batch.column("text"))
            tokens = [counts.count(text) for text in values]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(text.encode()) for text in values], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs, id_col, text_col).mapInArrow(count, SCHEMA)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
