"""Byte-level BPE encoding and decoding by DuckDB's recursive queries, one connection per task.

Each batch of a partition is cut into pieces; pieces not seen yet become rows
``(piece, position, symbol, next symbol)`` of a DuckDB table. The recursive query joins
the rows with the merge table, contracts every piece's leftmost pair of minimum rank, and
goes on until no pair of a piece can be merged. Decoding joins the rows with the
vocabulary and strings the bytes together by ordered aggregation. Pieces longer than
``LONG_PIECE`` bytes take the same query with all occurrences of the minimum contracted
at once where that cannot change the result, so that their steps are counted in distinct
pairs and not in bytes.

Defined cases: a null text counts as empty (no ids, no bytes). Special strings are ordinary
text. Repeated rows give repeated rows. Columns other than the id and the text are not read.
"""

import base64
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import groups, strings, table, texts
from litsearch.llm.op1_token_counts import PIECES

LONG_PIECE = 48
#: Pieces a worker remembers, rows of symbols per recursive query, characters cut at a time.
REMEMBERED, SYMBOLS_AT_ONCE, CHARS_AT_ONCE = 300_000, 250_000, 1_000_000
ENCODED = "doc_id long, n_tokens long, ids binary, decoded binary"

#: Rows before the contracted pair move up by one, so the positions of a piece stay
#: without gaps: the pair's left row goes, its right row becomes the merged symbol.
CONTRACT_LEFTMOST = """
WITH RECURSIVE merging(piece, pos, id, next_id, going) AS (
  SELECT piece, pos, id, next_id, true FROM symbols
  UNION ALL
  (WITH paired AS (
     SELECT s.piece, s.pos, s.id, s.next_id, m.merged
     FROM merging s LEFT JOIN merges m ON m.a = s.id AND m.b = s.next_id
     WHERE s.going),
   best AS (
     SELECT piece, min(merged::BIGINT * 1048576 + pos) AS k
     FROM paired WHERE merged IS NOT NULL GROUP BY piece),
   chosen AS (SELECT piece, (k >> 20)::INTEGER AS merged, (k & 1048575)::INTEGER AS at FROM best)
   SELECT p.piece,
          CASE WHEN p.pos < c.at THEN p.pos + 1 ELSE p.pos END,
          CASE WHEN p.pos = c.at + 1 THEN c.merged ELSE p.id END,
          CASE WHEN p.pos = c.at - 1 THEN c.merged ELSE p.next_id END,
          c.piece IS NOT NULL
   FROM paired p LEFT JOIN chosen c USING (piece)
   WHERE p.pos IS DISTINCT FROM c.at))
SELECT piece, id FROM merging WHERE NOT going ORDER BY piece, pos
"""

#: A merge is safe if no later merge of its result has a lower rank; then all its
#: occurrences are contracted, every second one where they overlap (as in "aaaa").
CONTRACT_ALL = """
WITH RECURSIVE merging(piece, pos, id, going) AS (
  SELECT piece, pos, id, true FROM symbols
  UNION ALL
  (WITH following AS (
     SELECT piece, pos, id, lead(id) OVER w AS next_id, row_number() OVER w AS n
     FROM merging WHERE going WINDOW w AS (PARTITION BY piece ORDER BY pos)),
   paired AS (
     SELECT s.*, m.merged, m.safe, min(m.merged) OVER (PARTITION BY piece) AS least,
            min(CASE WHEN m.merged IS NOT NULL THEN m.merged::BIGINT * 1073741824 + n END)
              OVER (PARTITION BY piece) AS leftmost
     FROM following s LEFT JOIN merges m ON m.a = s.id AND m.b = s.next_id),
   candidates AS (
     SELECT piece, n, n - row_number() OVER (PARTITION BY piece ORDER BY n) AS run
     FROM paired WHERE merged = least AND (safe OR n = leftmost % 1073741824)),
   chosen AS (
     SELECT piece, n FROM candidates
     QUALIFY row_number() OVER (PARTITION BY piece, run ORDER BY n) % 2 = 1)
   SELECT p.piece, p.pos, CASE WHEN c.n IS NOT NULL THEN p.merged ELSE p.id END,
          p.least IS NOT NULL
   FROM paired p LEFT JOIN chosen c ON c.piece = p.piece AND c.n = p.n
                 LEFT JOIN chosen d ON d.piece = p.piece AND d.n = p.n - 1
   WHERE d.n IS NULL))
SELECT piece, id FROM merging WHERE NOT going ORDER BY piece, pos
"""

DECODE = """
SELECT piece, unhex(string_agg(v.hex, '' ORDER BY t.n)) AS bytes
FROM tokens t JOIN vocabulary v USING (id) GROUP BY piece ORDER BY piece
"""


def spans(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


class Codec:
    """A vocabulary in DuckDB, and the pieces encoded so far."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        rows = [(ranks[token[:i]], ranks[token[i:]], rank) for token, rank in ranks.items()
                for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        lowest: dict[int, int] = {}
        for a, b, rank in rows:
            lowest[a] = min(rank, lowest.get(a, rank))
            lowest[b] = min(rank, lowest.get(b, rank))
        a, b, merged = (pa.array(x, pa.int32()) for x in zip(*rows))
        safe = pa.array([lowest.get(m, m + 1) > m for _, _, m in rows])
        self.con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        for name, made in (
                ("merges", pa.table({"a": a, "b": b, "merged": merged, "safe": safe})),
                ("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int32()),
                                         "hex": [token.hex() for token in ranks]}))):
            self.con.register("made", made)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM made")
            self.con.unregister("made")
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.cut = regex.compile(PIECES).findall
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.lengths: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.bytes: list[bytes] = []

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet."""
        short, long = [], []
        for piece in pieces:
            data = piece.encode()
            (short if len(data) <= LONG_PIECE else long).append((piece, data))
        step = SYMBOLS_AT_ONCE // LONG_PIECE * 4
        for i in range(0, len(short), step):
            self._merge(short[i:i + step], CONTRACT_LEFTMOST)
        if long:
            self._merge(long, CONTRACT_ALL)

    def _merge(self, pieces: list[tuple[str, bytes]], contract: str) -> None:
        lengths = np.array([len(data) for _, data in pieces])
        first = spans(lengths)
        ids = self.byte_id[np.frombuffer(b"".join(data for _, data in pieces), np.uint8)]
        following = np.append(ids[1:], np.int32(-1))
        following[first[1:] - 1] = -1
        numbers = np.arange(len(pieces), dtype=np.int32)
        found = self._query(contract, "symbols", pa.table({
            "piece": np.repeat(numbers, lengths),
            "pos": (np.arange(len(ids)) - np.repeat(first[:-1], lengths)).astype(np.int32),
            "id": ids, "next_id": following}))
        piece, token = found["piece"].to_numpy(), found["id"].to_numpy()
        decoded = self._query(DECODE, "tokens", pa.table({
            "piece": piece, "id": token, "n": np.arange(len(token))}))
        for number, (text, _) in enumerate(pieces, len(self.index)):
            self.index[text] = number
        self.ids.append(token)
        self.lengths.append(np.bincount(piece, minlength=len(pieces)))
        self.bytes += decoded["bytes"].to_pylist()

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.con.register(name, rows)
        found = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return found

    def encode(self, values: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian, 32 bits) and decoded bytes of each text."""
        if len(self.index) > REMEMBERED:
            self.clear()
        cut = [self.cut(text) for text in values]
        new = set().union(*cut) - self.index.keys()
        if new:
            self.learn(sorted(new))
            self.ids = [np.concatenate(self.ids)]
            self.lengths = [np.concatenate(self.lengths)]
        ids, lengths, known = self.ids[0], self.lengths[0], self.bytes
        start = spans(lengths)
        out = []
        for pieces in cut:
            at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
            n = lengths[at]
            step = np.repeat(start[at] - spans(n)[:-1], n)
            text_ids = ids[step + np.arange(len(step))]
            out.append((text_ids.astype("<u4").tobytes(), b"".join([known[i] for i in at.tolist()])))
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: ids as little-endian 32-bit numbers, and what they decode to."""

    def run(batches):
        coder = codec(vocabulary)
        for batch in batches:
            found = [x for group in groups(strings(batch.column("text"))) for x in coder.encode(group)]
            ids = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array([x[1] for x in found], pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return texts(docs, id_col, text_col).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of stored ids; null ids decode to nothing."""

    def run(batches):
        coder = codec(vocabulary)
        for batch in batches:
            ids = [np.frombuffer(x or b"", "<u4") for x in batch.column("text").to_pylist()]
            n = np.array([len(x) for x in ids])
            rows = pa.table({"piece": np.repeat(np.arange(len(ids)), n),
                             "id": np.concatenate(ids).astype(np.int32), "n": np.arange(n.sum())})
            found = coder._query(DECODE, "tokens", rows)
            decoded = dict(zip(found["piece"].to_pylist(), found["bytes"].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([decoded.get(i, b"") for i in range(len(ids))], pa.binary())],
                names=["doc_id", "decoded"])

    return texts(encoded, id_col, ids_col).mapInArrow(run, "doc_id long, decoded binary")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
