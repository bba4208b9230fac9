"""From documents to term counts, lengths, document frequencies, postings and vectors.

A document is an id: rows that share an id are merged, their counts and lengths adding up. Where ids are
known to be unique, `unique_ids=True` skips the merge and its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gleanrank.functions.arithmetic import whole_div
from gleanrank.functions.scoring import tfdf_weight
from gleanrank.functions.text import run_lengths, run_starts, tokenize
from gleanrank.operators.joins import join_counted, join_frequent
from gleanrank.session import materialize


def with_tokens(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens), one row per input row."""
    return docs.select(F.col(id_col).alias("doc_id"), tokenize(F.col(text_col)).alias("tokens"))


def count_in_row(tokenized: DataFrame) -> DataFrame:
    """(doc_id, doc_len, _runs) from (doc_id, tokens): each row's tokens as (term, tf) structs."""
    return _runs_in_row(tokenized).select("doc_id", "doc_len", run_lengths("_ordered", "_starts").alias("_runs"))


def _runs_in_row(tokenized: DataFrame) -> DataFrame:
    """(doc_id, doc_len, _ordered, _starts): each row's tokens in order, and where runs of equal ones start.

    A count is the distance between two run starts. The arrays are columns of their own, so each is made once per row.
    """
    ordered = tokenized.select("doc_id", F.sort_array("tokens").alias("_ordered"))
    return ordered.select(
        "doc_id", F.size("_ordered").cast("bigint").alias("doc_len"), "_ordered",
        run_starts("_ordered").alias("_starts"),
    )


def row_postings(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_len, head, term, tf): one row per input row and distinct term, without a shuffle.

    `head` marks exactly one row per input row, so lengths can be taken from the result; an input row
    without any term keeps one head row, with a null term. Counts are made from the run starts after these became
    rows, in generated code, which takes less time than structs made inside the row.
    """
    runs = _runs_in_row(with_tokens(docs, id_col, text_col))
    counts = runs.select("doc_id", "doc_len", "_ordered", "_starts", F.posexplode_outer("_starts").alias("_i", "_at"))
    following = F.coalesce(F.get("_starts", F.col("_i") + 1).cast("bigint"), "doc_len")
    return counts.select(
        "doc_id",
        "doc_len",
        (F.coalesce("_i", F.lit(0)) == 0).alias("head"),
        F.get("_ordered", F.col("_at")).alias("term"),
        (following - F.col("_at")).alias("tf"),
    )


def merge_term_freq(postings: DataFrame) -> DataFrame:
    """(doc_id, term, tf) with the counts of rows that share an id added up."""
    known = postings.filter(F.col("term").isNotNull())
    return known.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))


def split_repeated(counts: DataFrame, heads: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[
        DataFrame, DataFrame | None, DataFrame]:
    """(rows of `counts` whose ids occur once in `heads`, those of other ids or None, lengths by id).

    `heads` has one (doc_id, doc_len) for each input row. Counts of an id that occurs once are whole as they are, so
    only the others have to be merged.
    """
    merged = keep(heads.groupBy("doc_id").agg(F.sum("doc_len").alias("doc_len"), F.count("*").alias("rows")), "lengths")
    lengths, several = merged.select("doc_id", "doc_len"), merged.filter("rows > 1").select(F.col("doc_id").alias("_id"))
    if several.isEmpty():
        return counts, None, lengths
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    return counts.join(several, same, "left_anti"), counts.join(several, same, "left_semi"), lengths


def term_freq(docs: DataFrame, id_col: str = "id", text_col: str = "text",
              unique_ids: bool = False) -> DataFrame:
    """Occurrences of each term in each document: (doc_id, term, tf)."""
    if unique_ids:
        rows = row_postings(docs, id_col, text_col)
        return rows.filter(F.col("term").isNotNull()).select("doc_id", "term", "tf")
    return _exploded(docs, id_col, text_col).groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def _exploded(docs: DataFrame, id_col: str, text_col: str, distinct: bool = False) -> DataFrame:
    """(doc_id, term), one row per token or per distinct token of an input row."""
    tokens = F.array_distinct("tokens") if distinct else F.col("tokens")
    # The outer form keeps the planner from evaluating the token array a second time in a filter.
    return with_tokens(docs, id_col, text_col).select(
        "doc_id", F.explode_outer(tokens).alias("term")
    ).filter(F.col("term").isNotNull())


def distinct_terms(docs: DataFrame, id_col: str = "id", text_col: str = "text",
                   unique_ids: bool = False) -> DataFrame:
    """The set of terms of each document: (doc_id, term)."""
    if unique_ids:
        return _exploded(docs, id_col, text_col, distinct=True)
    return _exploded(docs, id_col, text_col, distinct=True).dropDuplicates(["doc_id", "term"])


def doc_freq(terms: DataFrame) -> DataFrame:
    """In how many documents each term occurs, from rows that are unique in (doc_id, term)."""
    return terms.groupBy("term").agg(F.count("doc_id").alias("df"))


def doc_lengths(docs: DataFrame, id_col: str = "id", text_col: str = "text",
                unique_ids: bool = False) -> DataFrame:
    """Number of clean tokens per document, 0 included: (doc_id, doc_len)."""
    rows = with_tokens(docs, id_col, text_col).select(
        "doc_id", F.size("tokens").cast("bigint").alias("doc_len")
    )
    return rows if unique_ids else merge_lengths(rows)


def merge_lengths(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("doc_id").agg(F.sum("doc_len").alias("doc_len"))


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row: number of documents and mean length."""
    return lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avg_len"))


def with_lengths(tf: DataFrame, lengths: DataFrame) -> DataFrame:
    """Attach each document's length to its term counts; a length bounds the document's terms."""
    return join_counted(tf, lengths, "doc_id", "doc_len", spread_by="term")


def with_tfdf_weight(tf: DataFrame, df: DataFrame) -> DataFrame:
    """Attach weight = tf / df; a term without a document frequency is dropped."""
    joined = join_frequent(tf, df, "term", "df")
    return joined.withColumn("weight", tfdf_weight(F.col("tf"), F.col("df"))).drop("df")


def row_vectors(counts: DataFrame) -> DataFrame:
    """(doc_id, part, doc_len, vector) with the counts of terms, straight from rows of `count_in_row` whose ids differ.

    As in `doc_vectors`, a null id has an empty vector.
    """
    known = F.when(F.col("doc_id").isNotNull(), F.col("_runs"))
    vector = F.map_from_entries(F.coalesce(known, F.slice("_runs", 1, 0)))
    return counts.select("doc_id", F.lit(0).alias("part"), "doc_len", vector.alias("vector"))


def doc_vectors(postings: DataFrame, lengths: DataFrame, value: str = "weight", parts: int = 1) -> DataFrame:
    """(doc_id, part, doc_len, vector): each document of `lengths` with its terms as a map, empty for none.

    With `parts` above 1 the terms of every document are dealt over so many rows, for corpora whose longest
    documents have too many terms for one map.
    """
    entry = F.struct("term", F.col(value).alias("value"))
    maps = (
        postings.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int"))
        # Dealt out before lists are made: a scan's rows are too many to be sorted for them without spilling.
        .repartition("doc_id", "part")
        .groupBy("doc_id", "part")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("vector"))
    )
    kind = maps.schema["vector"].dataType
    rows = lengths.select("doc_id", "doc_len", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return rows.join(maps, ["doc_id", "part"], "left").select(
        "doc_id", "part", "doc_len", F.coalesce("vector", F.create_map().cast(kind)).alias("vector")
    )
