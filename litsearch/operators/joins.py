"""Joins against a table that may be small or large."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsearch.sources.scratch import materialise

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# rows of one key that one task may get; a key with more is split
HOT_ROWS = 1_000_000
# values handed to a scan, so that it skips files and row groups without them
MOST_PUSHED = 500


def _size(max_rows: int, max_bytes: int) -> Column:
    """Aggregate: are all rows together within the bounds?"""
    octets = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    return (F.count(F.lit(1)) <= max_rows) & (octets <= max_bytes)


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a table (one aggregation over it) against the broadcast bounds."""
    return table.agg(_size(max_rows, max_bytes).alias("fits")).first()["fits"]


def survey(table: DataFrame, column: str, values: list[str]) -> tuple[bool, set[str]]:
    """Does the table fit a broadcast, and which of a few values does a column hold?"""
    held = F.collect_set(F.when(F.col(column).isin(values), F.col(column)))
    row = table.agg(_size(BROADCAST_ROWS, BROADCAST_BYTES).alias("fits"), held.alias("held")).first()
    return row["fits"], set(row["held"])


def even_slice(slices: int | Column, *columns: str) -> Column:
    """Slice number of a row by the hash of some columns."""
    count = F.lit(slices) if isinstance(slices, int) else slices
    return F.pmod(F.xxhash64(*columns), count).cast("int")


def hot_keys(rows: DataFrame, on: list[str], hot_rows: int = HOT_ROWS,
             counts: DataFrame | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of parts to cut each into.

    ``counts(*on, _n)`` are used where they are known. Otherwise rows are counted task
    by task before the shuffle, so a hot key is one row per task.
    """
    if counts is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return materialise(counts.filter(F.col("_n") > hot_rows).select(
        *on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")), "hot_keys")


def few_values(table: DataFrame, column: str, most: int = MOST_PUSHED) -> list | None:
    """The different values of a column if there are some and at most ``most``, else nothing."""
    found = [r[0] for r in table.select(column).distinct().limit(most + 1).collect()]
    return found if 0 < len(found) <= most else None


def asked_rows(table: DataFrame, column: str, values: list | None) -> DataFrame:
    """The table's rows with these values; the scan gets them as a pushed filter."""
    return table if values is None else table.filter(F.col(column).isin(values))


def lookup_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner",
                spread: tuple[str, ...] = ("doc_id",), small: bool | None = None,
                hot_rows: int = HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Join ``rows`` (large, any skew) with ``table`` (few rows per key).

    A table measured to be small is broadcast and ``rows`` are not shuffled.
    A larger one is joined by shuffle; keys with very many rows are cut into parts
    by their ``spread`` columns, and only their table rows are copied, one copy
    per part. Hot keys are found from ``counts(*on, _n)`` if given. Inner, left, semi and anti joins give the same result either way,
    as each row meets exactly one copy.
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return rows.join(F.broadcast(table), on, how)
    hot = hot_keys(rows, on, hot_rows, counts)
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    parts = F.coalesce("_parts", F.lit(1))
    cut = rows.join(hot, on, "left").withColumn("_part", even_slice(parts, *spread)).drop("_parts")
    copies = (table.join(hot, on, "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return cut.join(copies, [*on, "_part"], how).drop("_part")
