"""Query weights, scores, top N and titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from gleanrank.functions.scoring import bm25_idf, bm25_term, tfdf_weight
from gleanrank.functions.text import tokenize
from gleanrank.operators.numbering import number_rows
from gleanrank.operators.terms import count_in_row, with_tokens

MODELS = ("tfdf", "bm25")
MAX_TOP = 1000


def check_model(model: str) -> None:
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}, not {model!r}")


def check_top(n: int) -> None:
    if not 0 <= n <= MAX_TOP:
        raise ValueError(f"n must be between 0 and {MAX_TOP}, not {n}")


def query_terms(spark: SparkSession, query: str) -> DataFrame:
    """(term, qtf) of a query string, through the tokenizer that the documents go through."""
    text = spark.range(0, 1, 1, 1).select(F.lit(0).alias("doc_id"), tokenize(F.lit(query)).alias("tokens"))
    return count_in_row(text).select(F.inline("_runs")).select("term", F.col("tf").alias("qtf"))


def query_weights(terms: DataFrame, df: DataFrame, model: str, stats: DataFrame | None = None) -> DataFrame:
    """Weight of each query term that the corpus knows.

    TF/DF: (term, weight) with weight = qtf / df. BM25: (term, weight, avg_len) with weight = idf; how
    often the query repeats a term does not count. The query's terms are the small side here, bounded
    by the query string.
    """
    check_model(model)
    if model == "tfdf":
        known = df.join(F.broadcast(terms), "term")
        return known.select("term", tfdf_weight(F.col("qtf"), F.col("df")).alias("weight"))
    known = df.join(F.broadcast(terms.select("term")), "term")
    # The one-row statistics join the few query terms, so the postings carry no cross join.
    return known.crossJoin(F.broadcast(stats)).select(
        "term", bm25_idf(F.col("n_docs"), F.col("df")).alias("weight"), "avg_len"
    )


def score(postings: DataFrame, weights: DataFrame, model: str, keep_all: bool = False) -> DataFrame:
    """(doc_id, score): sum over a document's postings of what each query term adds.

    `keep_all` keeps every document that has a row in `postings`, with score 0 if nothing matches.
    TF/DF postings carry `weight` = tf / df.
    """
    check_model(model)
    named = weights.withColumnRenamed("weight", "_q")
    joined = postings.join(F.broadcast(named), "term", "left" if keep_all else "inner")
    if model == "tfdf":
        part = F.col("_q") * F.col("weight")
    else:
        part = bm25_term(F.col("_q"), F.col("tf"), F.col("doc_len"), F.col("avg_len"))
    return joined.groupBy("doc_id").agg(F.sum(F.coalesce(part, F.lit(0.0))).alias("score"))


def with_zero_scores(scores: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every document of the corpus, with score 0 where it has none."""
    return (
        lengths.select("doc_id")
        .join(scores, "doc_id", "left")
        .select("doc_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    )


def query_postings(docs: DataFrame, terms: Sequence[Row], id_col: str = "id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Postings of a query's terms straight from documents, and the numbers their weights need.

    Returns (postings, summary). Postings are (doc_id, term, tf, doc_len); a document without a match
    keeps one row with a null term. The summary is one row per known term: (term, qtf, df, n_docs,
    avg_len). Both read the same per-document aggregate, which holds one length and one count per query
    term, so the texts are read once and never shuffled.
    """
    names = [row["term"] for row in terms]
    counts = [f"_tf{i}" for i in range(len(names))]
    matched = F.filter("tokens", lambda token: token.isin(names)) if names else F.array()
    rows = with_tokens(docs, id_col, text_col).select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("_len"),
        matched.alias("_hits"),
    )
    found = rows.select("doc_id", "_len", *[
        F.size(F.filter("_hits", _equals(name))).cast("bigint").alias(col)
        for name, col in zip(names, counts)
    ])
    per_doc = found.groupBy("doc_id").agg(
        F.sum("_len").alias("doc_len"), *[F.sum(col).alias(col) for col in counts]
    )
    entries = F.filter(
        _structs([(F.lit(n).alias("term"), F.col(c).alias("tf")) for n, c in zip(names, counts)],
                 "array<struct<term:string,tf:bigint>>"),
        lambda entry: entry["tf"] > 0,
    )
    postings = per_doc.select("doc_id", "doc_len", F.inline_outer(entries)).select(
        "doc_id", "term", "tf", "doc_len"
    )
    totals = per_doc.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg("doc_len").alias("avg_len"),
        *[F.count_if(F.col(col) > 0).alias(col) for col in counts],
    )
    frequencies = _structs(
        [(F.lit(row["term"]).alias("term"), F.lit(row["qtf"]).alias("qtf"), F.col(c).alias("df"))
         for row, c in zip(terms, counts)],
        "array<struct<term:string,qtf:bigint,df:bigint>>",
    )
    summary = totals.select(F.inline(frequencies), "n_docs", "avg_len").filter(F.col("df") > 0)
    return postings, summary


def _equals(name: str):
    return lambda token: token == name


def _structs(fields: list[tuple[Column, ...]], array_type: str) -> Column:
    return F.array(*[F.struct(*row) for row in fields]).cast(array_type)


def weights_from_summary(summary: DataFrame, model: str) -> DataFrame:
    """Query weights, as `query_weights` gives them, from the summary of `query_postings`."""
    check_model(model)
    if model == "tfdf":
        return summary.select("term", tfdf_weight(F.col("qtf"), F.col("df")).alias("weight"))
    return summary.select("term", bm25_idf(F.col("n_docs"), F.col("df")).alias("weight"), "avg_len")


def top_k(scores: DataFrame, n: int) -> DataFrame:
    """(rank, doc_id, score) of the n best documents; equal scores go to the lower id first."""
    check_top(n)
    best = scores.orderBy(F.desc("score"), "doc_id").limit(n)
    return add_rank(best)


def add_rank(best: DataFrame) -> DataFrame:
    """Number the rows of a top list, which has at most MAX_TOP of them."""
    place = F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")).cast("bigint")
    return best.select(place.alias("rank"), "doc_id", "score")


def pad_with_zeros(best: DataFrame, lengths: DataFrame, n: int) -> DataFrame:
    """Fill up (doc_id, score) rows to n with the lowest ids that are not among them, at score 0.

    The document table is joined to a one-row test that is empty when n rows are there already; adaptive
    execution then drops that side without reading it.
    """
    check_top(n)
    short = best.agg(F.count(F.lit(1)).alias("_have")).filter(F.col("_have") < n)
    others = (
        lengths.select("doc_id")
        .join(F.broadcast(short), how="cross")
        .join(F.broadcast(best.select("doc_id")), "doc_id", "left_anti")
        .orderBy("doc_id")
        .limit(n)
        .select("doc_id", F.lit(0.0).alias("score"))
    )
    return best.unionByName(others).orderBy(F.desc("score"), "doc_id").limit(n)


def rank_all(scores: DataFrame) -> DataFrame:
    """(rank, doc_id, score) of every scored document, numbered over the whole order."""
    return number_rows(scores, [F.desc("score"), F.col("doc_id")], name="rank").select(
        "rank", "doc_id", "score"
    )


def attach_titles(hits: DataFrame, corpus: DataFrame, columns: Sequence[str] = ("title", "url")) -> DataFrame:
    """Hits with the title and url of their documents, null where the corpus lacks the id.

    Only the hits, at most MAX_TOP rows, are broadcast: first to pick their documents out of the corpus,
    then the documents found, one per id, are joined back.
    """
    wanted = F.broadcast(hits.select("doc_id"))
    found = (
        corpus.select(F.col("id").alias("doc_id"), *columns)
        .join(wanted, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*columns)).alias("_doc"))
    )
    return hits.join(F.broadcast(found), "doc_id", "left").select(
        "rank", "doc_id", *[F.col(f"_doc.{name}").alias(name) for name in columns], "score"
    )


def format_results(hits: DataFrame) -> DataFrame:
    """(rank, line): the printed form of each hit."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    line = F.concat(
        F.lit("Id: "), shown("doc_id"), F.lit("    Title: "), shown("title"),
        F.lit("    URL: "), shown("url"), F.lit("   Score: "), shown("score"),
    )
    return hits.select("rank", line.alias("line"))
