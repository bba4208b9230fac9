"""Job: from a corpus to an index of document frequencies, postings, lengths and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from gleanrank.operators.ranking import check_model
from gleanrank.operators.terms import (
    corpus_stats, doc_freq, merge_lengths, merge_term_freq, row_postings, with_lengths,
)
from gleanrank.session import Scratch, drop_folder, rename_folder
from gleanrank.sinks.tables import write_df, write_lengths, write_postings, write_stats, write_titles
from gleanrank.sources.tables import path_exists, read_lengths


def build_index(docs: DataFrame, index: str, model: str = "bm25", id_col: str = "id",
                text_col: str = "text") -> None:
    """Build an index at a path that does not exist yet.

    The texts are read and tokenised once, into a scratch table of term counts; document frequencies,
    lengths, statistics and the sorted postings are all made from its columns. Postings move once, into their sorted
    layout; TF/DF weights are made from the frequencies on reading. Where the documents have a
    `title` and a `url`, these are stored as well, for `search(titles=True)`.

    All tables are written beside the path and renamed when the last one, `built`, is there; readers ask for that one. A
    build that is stopped leaves no index, and can be repeated; one that is killed leaves its folder
    `<index>.building-...` behind.
    """
    check_model(model)
    spark = docs.sparkSession
    if path_exists(spark, index):
        raise FileExistsError(f"index exists already: {index}")
    staged = f"{index.rstrip('/')}.building-{uuid.uuid4().hex}"
    with Scratch(spark, "index") as scope:
        try:
            _write_tables(docs, staged, model, id_col, text_col, scope)
            spark.createDataFrame([(model,)], "model string").coalesce(1).write.parquet(f"{staged}/built")
            rename_folder(spark, staged, index)
        except BaseException:
            drop_folder(spark, staged)
            raise


def _write_tables(docs: DataFrame, index: str, model: str, id_col: str, text_col: str, scope: Scratch) -> None:
    spark = docs.sparkSession
    rows = scope.keep(row_postings(docs, id_col, text_col), "rows")
    heads = rows.filter("head").select("doc_id", "doc_len")
    postings = rows.filter(F.col("term").isNotNull()).select("doc_id", "term", "tf", "doc_len")
    repeated = heads.groupBy("doc_id").count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        heads = scope.keep(merge_lengths(heads), "lengths")
        postings = scope.keep(with_lengths(merge_term_freq(rows), heads), "postings")
    counted = scope.keep(doc_freq(postings), "df")
    sizes = counted.agg(F.count(F.lit(1)).alias("terms"), F.sum("df").alias("postings")).first()
    n_docs = heads.count()
    write_df(counted, index, sizes["terms"])
    write_lengths(heads, index, n_docs)
    write_stats(corpus_stats(read_lengths(spark, index)), index)
    if {"title", "url"} <= set(docs.columns):
        write_titles(docs.select(F.col(id_col).alias("doc_id"), "title", "url"), index, n_docs)
    write_postings(postings, index, sizes["postings"] or 0)
