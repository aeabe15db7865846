"""Small helpers shared by the text operators."""

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII blanks; everything else belongs to a word.
BLANKS = (9, 10, 11, 12, 13, 32)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns needed, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def strings(column: pa.Array) -> list[str]:
    """Values of an Arrow string column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def groups(values: list[str], chars: int = 1_000_000):
    """Consecutive texts of about so many characters together."""
    held, size = [], 0
    for text in values:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def joined_bytes(values: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts, each followed by one blank; and where each text begins."""
    parts = [x.encode("utf-8", "surrogatepass") for x in values]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in parts], out=starts[1:])
    return np.frombuffer(b" ".join(parts) + b" ", np.uint8)[: starts[-1]], starts


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


#: ASCII bytes that are no letter or digit.
NOT_ALPHANUMERIC = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, starts: np.ndarray,
               between: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word ``[^\\x20\\x09-\\x0D]+`` in joined bytes, and each text's first word;
    other bytes ``between`` words if given."""
    blank = between[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate(([0], edge))
    begin, end = edge[0::2], edge[1::2]
    return begin, end, np.searchsorted(begin, starts)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in small letters, all other bytes as they are."""
    return _LOWER[data]


def powers(n: int) -> np.ndarray:
    """Powers of the hash base, modulo 2**64."""
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: a polynomial of random byte values, mixed at the end."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    first = np.cumsum(length) - length
    inside = np.arange(first[-1] + length[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), length)
    at = np.repeat(begin.astype(np.int32), length)
    at += inside
    values = _MIX[data[at]]
    values *= powers(int(length.max()))[inside]
    return mix(np.add.reduceat(values, first))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_limit(wanted: int, rows: int) -> int:
    """About ``wanted`` of ``rows`` rows have a 64-bit hash up to this, at any number of rows."""
    return min(1 << 64, (wanted << 64) // max(1, rows)) - (1 << 63) - 1
