"""Crawl inputs derived from the `pages` table: captures, archive records and archive files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleanrank.functions.arithmetic import whole_div
from gleanrank.session import new_scratch, spread

DOMAIN = "example.net"
CRAWLS = ("2022-33", "2022-40")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return scan.select(*columns) if columns else scan


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose texts are about to be processed: spread over all slots."""
    return spread(table(spark, sf_dir, name, *columns))


def page_url() -> Column:
    """The page's url; every fifth one also names another domain in its query string."""
    return F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("?ref=" + DOMAIN))).otherwise(F.col("url"))


def archive_path(kind: str) -> Column:
    """Path of a page's archive, `kind` being warc (raw) or wet (extracted text); ten pages share one.

    Two segments have archives of the same names; one name holds a space, and one archive is not compressed.
    """
    archive = whole_div(F.col("page_id"), 10)
    name = F.when(archive == 4, "part 2").otherwise(F.concat(F.lit("part-"), whole_div(archive, 2).cast("string")))
    ending = F.when(archive == 6, ".warc").otherwise(".warc.gz" if kind == "warc" else ".warc.wet.gz")
    return F.concat(
        F.lit("crawl-data/main/segments/"), (archive % 2).cast("string"), F.lit(f"/{kind}/"), name, ending
    )


def captures(pages: DataFrame) -> DataFrame:
    """(pos, crawl, url, status, filename): ten pages share an archive."""
    return pages.select(
        F.col("page_id").alias("pos"),
        F.when(F.col("page_id") % 2 == 0, CRAWLS[1]).otherwise(CRAWLS[0]).alias("crawl"),
        page_url().alias("url"),
        F.when(F.col("page_id") % 7 == 0, "404").otherwise("200").alias("status"),
        archive_path("warc").alias("filename"),
    )


def page_title() -> Column:
    return F.regexp_extract("html", "<title>([^<]*)</title>", 1)


def record_text(newline: str = "\n") -> Column:
    """A page as an archive record without its version line; every fifth one lacks the language header."""
    body = F.concat(page_title(), F.lit("\n"), "html")
    language = F.when(
        F.col("page_id") % 5 != 0, F.lit("WARC-Identified-Content-Language: eng\n")
    ).otherwise("")
    text = F.concat(
        F.lit("WARC-Type: conversion\nWARC-Target-URI: "), page_url(),
        F.lit("\nWARC-Date: 2022-10-01T00:00:00Z\nWARC-Record-ID: <urn:uuid:"), F.col("page_id").cast("string"),
        F.lit(">\nWARC-Refers-To: <urn:uuid:"), F.col("page_id").cast("string"),
        F.lit(">\nWARC-Block-Digest: sha1:"), F.sha1(F.encode(body, "utf-8")), F.lit("\n"), language,
        F.lit("Content-Type: text/plain\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\n\n"), body, F.lit("\n\n"),
    )
    return text if newline == "\n" else F.replace(text, F.lit("\n"), F.lit(newline))


def records(pages: DataFrame) -> DataFrame:
    """(page_id, value): the raw record of each page."""
    return pages.select("page_id", record_text().alias("value"))


def record_lines(pages: DataFrame) -> DataFrame:
    """(file, pos, line): the lines of four extract files, the first one holding a third of the pages."""
    whole = F.concat(F.lit("WARC/1.0\n"), record_text())
    return pages.select(
        F.when(F.col("page_id") % 3 == 0, "extract-0")
        .otherwise(F.concat(F.lit("extract-"), (F.col("page_id") % 4).cast("string"))).alias("file"),
        "page_id",
        F.posexplode(F.split(whole, "\n")).alias("i", "line"),
    ).select("file", (F.shiftleft("page_id", 32) + F.col("i")).alias("pos"), "line")


def write_archives(pages: DataFrame) -> str:
    """Write the pages as archive files below a scratch folder, and return that folder.

    Every second archive has LF, every third one is of version 1.1, and all begin with a record about themselves.
    """
    root = new_scratch(pages.sparkSession, "archives")
    archive = whole_div(F.col("page_id"), 10)
    version = F.when(archive % 3 == 0, "WARC/1.1").otherwise("WARC/1.0")
    crlf, lf = (F.concat(version, F.lit(end), record_text(end)) for end in ("\r\n", "\n"))
    about = F.concat(version, F.lit("\nWARC-Type: warcinfo\nContent-Length: 11\n\nformat: wet\n\n"))
    rows = pages.select(
        archive_path("wet").alias("path"), "page_id", about.alias("about"), F.when(archive % 2 == 0, crlf).otherwise(lf).alias("value"),
    )

    def write(table):
        import gzip

        import pyarrow as pa
        from pyarrow import fs

        path = table.column("path")[0].as_py()
        rows = table.sort_by("page_id").to_pydict()
        data = "".join([rows["about"][0], *rows["value"]]).encode()
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
        with store.open_output_stream(f"{base}/{path}", compression=None) as out:
            out.write(gzip.compress(data) if path.endswith(".gz") else data)
        return pa.table({"path": [path]})

    rows.groupBy("path").applyInArrow(write, "path string").count()
    return root
