"""Readers of captures, corpora and index tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank import schemas
from gleanrank.functions.scoring import tfdf_weight
from gleanrank.operators.terms import with_tfdf_weight


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_captures(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Crawl index rows: (crawl, url, status, filename)."""
    return spark.read.schema(schemas.CAPTURES).format(format).load(path)


def read_capture_index(spark: SparkSession, path: str) -> DataFrame:
    """Captures written by `write_capture_index`: (pos, crawl, url, status, filename, host_key)."""
    return spark.read.schema(schemas.CAPTURE_INDEX).parquet(path)


def read_corpus(spark: SparkSession, path: str, format: str = "json", multi_line: bool = False,
                mode: str = "FAILFAST") -> DataFrame:
    """Documents (id, url, title, text) in every file below `path`.

    JSON lines by default; `multi_line` reads files that hold one JSON array. Ids are digits in a JSON
    string or number. A line that is not JSON stops the job, unless another reader `mode` is given.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if format == "json":
        as_text = schemas.CORPUS.replace("id bigint", "id string")
        docs = reader.schema(as_text).option("multiLine", multi_line).option("mode", mode).json(path)
        return docs.withColumn("id", F.col("id").cast("bigint"))
    return reader.schema(schemas.CORPUS).format(format).load(path)


def read_df(spark: SparkSession, index: str) -> DataFrame:
    """Document frequencies of an index: (term, df)."""
    return spark.read.schema(schemas.DOC_FREQ).parquet(f"{index}/df")


def check_built(spark: SparkSession, index: str) -> None:
    """Refuse a folder that is not a finished index, as a missing table."""
    spark.read.schema("model string").parquet(f"{index}/built")


def read_postings(spark: SparkSession, index: str, model: str, terms: list[str] | None = None) -> DataFrame:
    """Postings of an index: (doc_id, term, tf, doc_len), and weight = tf / df for TF/DF.

    The weight is made from the index's document frequencies on reading. With `terms`, only their postings and
    frequencies are read; they are as many as the query's words, and the frequencies are sent to every task.
    """
    postings = spark.read.schema(schemas.POSTINGS).parquet(f"{index}/postings")
    df = read_df(spark, index)
    if terms is not None:
        postings, df = (t.filter(F.col("term").isin(terms)) for t in (postings, df))
    if model != "tfdf":
        return postings
    if terms is None:
        return with_tfdf_weight(postings, df)
    return postings.join(F.broadcast(df), "term").withColumn("weight", tfdf_weight(F.col("tf"), F.col("df"))).drop("df")


def read_lengths(spark: SparkSession, index: str) -> DataFrame:
    """Every document of an index with its length: (doc_id, doc_len)."""
    return spark.read.schema(schemas.DOC_LENGTHS).parquet(f"{index}/docs")


def read_titles(spark: SparkSession, index: str) -> DataFrame:
    """Titles and urls of an index whose documents had them: (id, title, url)."""
    titles = spark.read.schema("doc_id bigint, title string, url string").parquet(f"{index}/titles")
    return titles.withColumnRenamed("doc_id", "id")


def read_stats(spark: SparkSession, index: str) -> DataFrame:
    """Corpus statistics of an index: one row (n_docs, avg_len)."""
    return spark.read.schema(schemas.STATS).parquet(f"{index}/stats")


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    """A stored ranking: (doc_id, score)."""
    return spark.read.schema(schemas.RANKING).parquet(path)
