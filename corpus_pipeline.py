"""From raw documents to token files: five stages, each written as Parquet and read back for the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank.llm.decontaminate import without_leaks
from gleanrank.llm.mixing import mixed_documents
from gleanrank.llm.parity_join import similar_sets
from gleanrank.llm.queries import TOKENIZER, table
from gleanrank.llm.token_files import token_digests, write_tokens
from gleanrank.llm.toxicity import without_toxic
from gleanrank.session import materialize, new_scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose score reaches the threshold go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of similar documents, the one with the least id stays; nulls come last.

    Where ids are null or repeated, rows are compared under a stored number of their own.
    """
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("rows_of_id")).filter("doc_id is null or rows_of_id > 1")
    if repeated.isEmpty():
        least = similar_sets(docs)[0].filter("doc_id = component_id").select("doc_id")
        return docs.join(least, "doc_id", "left_semi").select(docs.columns)
    numbered = materialize(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("number")),
        "pipeline-numbered",
    )
    sets = similar_sets(numbered.select(F.col("number").alias("doc_id"), "row.text"))[0]
    place = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "number")
    least = (
        numbered.join(sets.select(F.col("doc_id").alias("number"), "component_id"), "number")
        .groupBy("component_id").agg(F.min(place).alias("first")).select("first.number")
    )
    return numbered.join(least, "number", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token files, and the digest of each document read back from them."""
    path = new_scratch(spark, "pipeline-tokens")
    write_tokens(docs, path, TOKENIZER)
    return token_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

# Trained models, iterated components and compressed files are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
