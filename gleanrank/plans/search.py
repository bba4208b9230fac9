"""Jobs: ranked search over an index, or over documents that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank import schemas
from gleanrank.functions.scoring import tfdf_weight
from gleanrank.operators.ranking import (
    add_rank, attach_titles, check_model, check_top, pad_with_zeros, query_postings, query_terms,
    query_weights, score, top_k, weights_from_summary, with_zero_scores,
)
from gleanrank.sinks.tables import write_ranking
from gleanrank.sources.tables import (
    check_built, read_df, read_lengths, read_postings, read_ranking, read_stats, read_titles,
)


def index_scores(spark: SparkSession, index: str, query: str, model: str = "bm25") -> DataFrame:
    """(doc_id, score) of the documents that hold a term of the query."""
    check_model(model)
    check_built(spark, index)
    wanted = query_terms(spark, query)
    names = [row["term"] for row in wanted.collect()]
    # The terms are literals here, so the parquet reader skips the row groups of all other terms.
    df = read_df(spark, index).filter(F.col("term").isin(names))
    stats = read_stats(spark, index) if model == "bm25" else None
    weights = query_weights(wanted, df, model, stats)
    return score(read_postings(spark, index, model, names), weights, model)


def search(spark: SparkSession, index: str, query: str, n: int, model: str = "bm25",
           corpus: DataFrame | None = None, include_zero: bool = True,
           ranking: str | None = None, titles: bool = False) -> DataFrame:
    """The n best documents for a query: (rank, doc_id[, title, url], score).

    With `include_zero`, documents without a match fill the list up to n. `ranking` is a path that
    receives the whole ranking, from which the list is then taken. With `titles`, titles and urls come from the
    index, otherwise from `corpus` if it is given; the ids go to the reader as values, as they are at most 1000.
    """
    check_top(n)
    scores = index_scores(spark, index, query, model)
    if ranking is not None:
        everything = with_zero_scores(scores, read_lengths(spark, index)) if include_zero else scores
        write_ranking(everything, ranking)
        scores = read_ranking(spark, ranking)
    best = scores.orderBy(F.desc("score"), "doc_id").limit(n)
    if include_zero and ranking is None:
        best = pad_with_zeros(best, read_lengths(spark, index), n)
    hits = add_rank(best)
    if titles:
        corpus = read_titles(spark, index)
    if corpus is None:
        return hits
    rows = hits.collect()
    found = corpus.filter(F.col("id").isin([row["doc_id"] for row in rows]))
    return attach_titles(spark.createDataFrame(rows, schemas.HITS), found)


def document_scores(docs: DataFrame, query: str, model: str = "bm25", id_col: str = "id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document, straight from the texts, in one pass over them."""
    check_model(model)
    terms = query_terms(docs.sparkSession, query).collect()
    postings, summary = query_postings(docs, terms, id_col, text_col)
    if model == "tfdf":
        frequencies = F.broadcast(summary.select("term", "df"))
        postings = postings.join(frequencies, "term", "left").withColumn(
            "weight", tfdf_weight(F.col("tf"), F.col("df"))
        )
    return score(postings, weights_from_summary(summary, model), model, keep_all=True)


def search_documents(docs: DataFrame, query: str, n: int, model: str = "bm25", id_col: str = "id",
                     text_col: str = "text", include_zero: bool = True) -> DataFrame:
    """The n best documents for a query without an index: (rank, doc_id, score)."""
    check_top(n)
    scores = document_scores(docs, query, model, id_col, text_col)
    if not include_zero:
        scores = scores.filter(F.col("score") > 0)
    return top_k(scores, n)
