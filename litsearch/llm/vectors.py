"""Vectors as whole numbers: what the operators that quantise and cluster them share."""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vector: Column | str) -> Column:
    """Is the vector there, and are all its components finite numbers?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def largest(dimension: int) -> int:
    """Components beyond this, either way, count as this: so that a squared distance fits a long."""
    return isqrt(2**62 // max(1, dimension)) // 2


def whole_numbers(values: np.ndarray, scale: int, dimension: int) -> np.ndarray:
    """``floor(scale * x)`` of each component, in 32 bits."""
    most = largest(dimension)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values.astype(np.float64) * scale), -most, most).astype(np.int32)


def fitting_rows(column: pa.Array, dimension: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dimension`` finite numbers, and these in whole numbers."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sizes == dimension)
    flat = column.take(pa.array(at)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dimension)
    fine = np.isfinite(values).all(axis=1)
    return at[fine], whole_numbers(values[fine], scale, dimension)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a to all rows of b.

    Products of doubles are exact as long as all sums stay below 2**53; larger numbers
    are multiplied as integers.
    """
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    kind = np.float64 if 4 * a.shape[1] * most * most < 2**53 else np.int64
    a, b = a.astype(kind), b.astype(kind)
    out = a @ b.T
    out *= -2
    out += np.einsum("ij,ij->i", a, a)[:, None]
    out += np.einsum("ij,ij->i", b, b)[None, :]
    return out


def exact_sum(column: Column | str) -> Column:
    """Sum of a column of longs; null where a long cannot hold it."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(38,0)")).try_cast("long")


def floor_means(old: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Componentwise floor of sum / count for each entry that has members; others stay."""
    new = old.copy()
    for entry, (count, total) in sums.items():
        new[entry] = np.array(total, np.int64) // count
    return new


def decimals(numbers: np.ndarray) -> str:
    """All numbers, as decimal integers with commas between them."""
    return ",".join(map(str, numbers.ravel().tolist()))


def label_sums(rows: DataFrame, value: str, key: list[str], name: str) -> DataFrame:
    """``key, name``: a value summed over the rows of each key, task by task first."""
    return rows.groupBy(*key).agg(exact_sum(value).alias(name))
