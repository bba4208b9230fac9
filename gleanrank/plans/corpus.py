"""Job: from domain records to a numbered document corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleanrank.functions.web import extract_number
from gleanrank.operators.numbering import batch_of, number_rows
from gleanrank.operators.records import record_fields
from gleanrank.session import Scratch, materialize
from gleanrank.sinks.tables import write_corpus
from gleanrank.sources.tables import read_corpus


def record_order(records: DataFrame) -> list[Column]:
    """Archive order where it is known, else extract files by number and name; then place in the file."""
    if "wet_pos" in records.columns:
        files = [F.col("wet_pos"), F.col("file")]
    else:
        files = [extract_number(F.col("file")).asc_nulls_last(), F.col("file")]
    return [*files, F.col("block"), F.col("pos")]


def number_documents(records: DataFrame, batch_size: int = 200, partitions: int | None = None,
                     scope: Scratch | None = None) -> DataFrame:
    """(id, url, title, text, batch): ids 1, 2, ... in record order, batch = a group of ids.

    A record's place follows how a scan happens to be split, and two scans may be split differently. So the records are
    read once and stored with a key of their own, and numbers and bodies meet on that key; a record without a
    number stops the job. The stored records are in `scope`, if it is given, otherwise they stay.
    """
    keep = scope.keep if scope else materialize
    names = [n for n in ("wet_pos", "file", "block", "pos") if n in records.columns]
    stored = keep(records.select(*names, "uri", "body").withColumn("_key", F.monotonically_increasing_id()), "records")
    # Only places are sorted; bodies move once, to the number of their key.
    numbers = number_rows(stored.select(*names, "_key"), record_order(stored), name="id", partitions=partitions, keep=keep)
    numbered = record_fields(stored.select("_key", "uri", "body")).join(numbers.select("_key", "id"), "_key", "left")
    lost = F.raise_error(F.lit("a stored record has no number")).cast("bigint")
    return numbered.withColumn("id", F.coalesce("id", lost)).select(
        "id", "url", "title", "text", batch_of(F.col("id"), batch_size).alias("batch")
    )


def build_corpus(records: DataFrame, out: str | None = None, batch_size: int = 200,
                 format: str = "json", batch_folders: bool = False,
                 partitions: int | None = None) -> DataFrame:
    """Turn records into documents and, given `out`, write them as a corpus and return that, read back.

    `batch_folders` writes a folder for each batch of ids: for small corpora, as each holds a file or more.
    """
    if out is None:
        return number_documents(records, batch_size, partitions)
    spark = records.sparkSession
    with Scratch(spark, "corpus") as scope:
        docs = number_documents(records, batch_size, partitions, scope)
        write_corpus(docs if batch_folders else docs.drop("batch"), out, format)
    return read_corpus(spark, out, format).withColumn("batch", batch_of(F.col("id"), batch_size))
