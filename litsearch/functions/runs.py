"""Term runs inside one row, by expressions or over many rows by arrays.

A document is one row, so its words can be grouped where they are: sort
(term, position) pairs and cut the sorted array where the term changes. The
work per row is O(n log n) and nothing is shuffled; grouping exploded words
instead would move every word of the corpus across the network.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Words grouped at a time, or those of one row.
WORDS_AT_ONCE = 500_000


def sorted_places(terms: Column, with_nulls: bool = False) -> Column:
    """Array of terms → array of ``(term, pos)`` in order. Null terms take up a position and are left out."""
    pairs = F.transform(terms, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
    if with_nulls:
        pairs = F.filter(pairs, lambda p: p["term"].isNotNull())
    return F.sort_array(pairs)


def cut_runs(most: int = WORDS_AT_ONCE):
    """For ``mapInArrow``: rows ``doc_id, field, places`` (see :func:`sorted_places`) to one row per different term, as
    :func:`term_runs` has them.

    The function holds all it needs, so that workers need not find this module.
    """
    def runs(ids, fields, lists):
        places = lists.flatten()
        terms, places = places.field("term"), places.field("pos")
        n = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(n)), n)
        new = np.ones(len(row), bool)
        if len(row):
            new[1:] = np.asarray(pc.not_equal(terms[1:], terms[:-1])) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        ends, of = np.append(first, len(row)), pa.array(row[first])
        return pa.RecordBatch.from_arrays([
            fields.take(of), terms.take(pa.array(first)), ids.take(of), pa.array(np.diff(ends), pa.int64()),
            pa.array(n[row[first]], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places)],
            names=["field", "term", "doc_id", "tf", "doc_len", "positions"])

    def run(batches):
        for batch in batches:
            lists, a = batch.column("places"), 0
            offsets = lists.offsets.to_numpy()
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
                yield runs(batch.column("doc_id").slice(a, b - a), batch.column("field").slice(a, b - a),
                           lists.slice(a, b - a))
                a = b

    return run


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which returns an array."""
    return F.flatten(F.transform(F.array(value), body))


def term_runs(terms: Column, with_nulls: bool = False) -> Column:
    """Array of terms → array of ``(term, tf, positions, n_terms)``, one per different term.

    ``n_terms`` is the number of terms. It is part of every run, because a column
    beside the array would be carried along and computed again for every exploded
    row. ``with_nulls`` says that there are null terms: they take up a position and
    are otherwise ignored.
    """
    pairs = sorted_places(terms, with_nulls)

    def cut(run):
        def emit(b):
            def one(start, k):
                tf = F.coalesce(F.get(b["starts"], k + 1), F.size(b["terms"])) - start
                return F.struct(
                    F.get(b["terms"], start).alias("term"),
                    tf.cast("bigint").alias("tf"),
                    F.slice(b["positions"], start + 1, tf).alias("positions"),
                    F.size(b["terms"]).cast("bigint").alias("n_terms"),
                )
            return F.transform(b["starts"], one)

        starts = F.filter(
            F.when(F.size(run["terms"]) > 0, F.sequence(F.lit(0), F.size(run["terms"]) - 1))
            .otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get(run["terms"], i) != F.get(run["terms"], i - 1)),
        )
        return _bind(F.struct(run["terms"].alias("terms"), run["positions"].alias("positions"),
                              starts.alias("starts")), emit)

    split = F.transform(F.array(pairs), lambda p: F.struct(
        p["term"].alias("terms"), p["pos"].alias("positions")))
    return F.flatten(F.transform(split, cut))
