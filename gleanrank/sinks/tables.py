"""Writers. Each one refuses an existing output unless it is meant to append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, functions as F

from gleanrank import schemas
from gleanrank.functions.web import VERSION_LINE
from gleanrank.operators.captures import with_host_key
from gleanrank.operators.numbering import number_rows

# About 30 MB of sorted postings, and 450 MB of memory for the task that sorts them.
ROWS_PER_FILE = 5_000_000


def write_rejects(rejects: DataFrame, path: str, run: str | None = None) -> None:
    """Append the captures whose status is not 200; those of a named `run` replace what it wrote before."""
    writer, path = _of_run(rejects, path, run)
    writer.parquet(path)


def _of_run(df: DataFrame, path: str, run: str | None) -> tuple[DataFrameWriter, str]:
    """The writer that adds rows to `path`, or replaces those of a named run, and where it writes to."""
    return (df.write.mode("append"), path) if run is None else (df.write.mode("overwrite"), f"{path}/run={run}")


def write_extracts(records: DataFrame, path: str, format: str = "parquet", run: str | None = None) -> None:
    """Append domain records.

    Parquet keeps each record's place in its archive and its batch as columns. `text` writes the records out in
    full, in the form that `read_extracts` and other archive tools read: below one folder per batch, whose
    number and whose files' names keep the order.

    With `run`, the records are those of a run of that name, in a folder of its own: writing it again replaces it and
    leaves other runs alone. Without it, each call adds its records. A folder takes records of either kind.
    """
    if format == "text":
        whole = F.concat(
            F.lit(VERSION_LINE + "\n"), "header", F.lit("\n\n"), "body", F.lit("\n")
        )
        order = ["batch", *(n for n in ("wet_pos",) if n in records.columns), "file", "block", "pos"]
        ordered = records.repartitionByRange(*order).sortWithinPartitions(*order)
        writer, path = _of_run(ordered.select("batch", whole.alias("value")), path, run)
        writer.partitionBy("batch").text(path)
    else:
        writer, path = _of_run(records, path, run)
        writer.format(format).save(path)


def write_capture_index(captures: DataFrame, path: str) -> None:
    """Captures sorted by crawl and host, so that those of a domain are a range of rows; refuses an existing path.

    Hosts that hold most captures spread over files, as the URL is part of the order.
    """
    order = ["crawl", "host_key", "url"]
    keyed = with_host_key(captures)
    if "pos" not in keyed.columns:
        keyed = number_rows(keyed, ["crawl", "url", "filename"], name="pos", start=0)
    ordered = keyed.select(*schemas.names(schemas.CAPTURE_INDEX)).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("errorifexists").parquet(path)


def write_corpus(docs: DataFrame, path: str, format: str = "json") -> None:
    """Write documents, below one folder per batch where they have a batch label."""
    if format == "json":
        docs = docs.withColumn("id", F.col("id").cast("string"))
    columns = ["id", "url", "title", "text"]
    if "batch" in docs.columns:
        writer = docs.select(*columns, "batch").write.partitionBy("batch")
    else:
        writer = docs.select(*columns).write
    writer.mode("errorifexists").format(format).save(path)


def write_sorted(df: DataFrame, path: str, order: list[str | Column], rows: int) -> None:
    """Write `rows` rows as parquet files that follow each other in the given order.

    The number of files grows with the rows. The whole order key decides the file, so a key that holds
    most rows spreads over many files if a further column tells its rows apart.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    files = max(min(slots, rows // 10_000 + 1), -(-rows // ROWS_PER_FILE))
    placed = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    placed.write.mode("errorifexists").parquet(path)


def write_df(df: DataFrame, index: str, rows: int) -> None:
    """Document frequencies, sorted by term."""
    write_sorted(df.select("term", "df"), f"{index}/df", ["term"], rows)


def write_postings(postings: DataFrame, index: str, rows: int) -> None:
    """Postings sorted by term, then document: a query reads the row groups of its terms only."""
    write_sorted(postings.select("doc_id", "term", "tf", "doc_len"), f"{index}/postings", ["term", "doc_id"], rows)


def write_lengths(lengths: DataFrame, index: str, rows: int) -> None:
    write_sorted(lengths.select("doc_id", "doc_len"), f"{index}/docs", ["doc_id"], rows)


def write_titles(docs: DataFrame, index: str, rows: int) -> None:
    """Title and url of each document, one row per id, sorted by id: a search reads those of its hits."""
    one = docs.groupBy("doc_id").agg(F.min(F.struct("title", "url")).alias("_doc"))
    write_sorted(one.select("doc_id", "_doc.title", "_doc.url"), f"{index}/titles", ["doc_id"], rows)


def write_stats(stats: DataFrame, index: str) -> None:
    stats.write.mode("errorifexists").parquet(f"{index}/stats")


def write_ranking(scores: DataFrame, path: str) -> None:
    """All scored documents, best first over the files in name order."""
    scores.select("score", "doc_id").orderBy(F.desc("score"), "doc_id").write.mode(
        "errorifexists"
    ).parquet(path)
