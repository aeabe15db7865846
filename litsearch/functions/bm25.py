"""BM25 as column arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from litsearch.fixed_values import BM25_B, BM25_K1


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def score(idf_: Column, tf: Column, doc_len: Column, avg_len: Column,
          k1: float = BM25_K1, b: float = BM25_B) -> Column:
    return idf_ * tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avg_len))
