"""Weights of the two retrieval models, as Column expressions in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the BM25 model.
K1 = 2.0
B = 0.75


def tfdf_weight(tf: Column, df: Column) -> Column:
    """Term count over document frequency; used for documents and for the query alike."""
    return tf.cast("double") / df


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))


def bm25_term(idf: Column, tf: Column, doc_len: Column, avg_len: Column,
              k1: float = K1, b: float = B) -> Column:
    """What one term adds to the BM25 score of one document."""
    norm = F.lit(1.0 - b) + F.lit(b) * doc_len / avg_len
    return idf * (tf * F.lit(k1 + 1.0)) / (tf + F.lit(k1) * norm)
