"""Job: from a crawl index and its archives to the records of one domain."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank import schemas
from gleanrank.functions.web import plain_path
from gleanrank.operators.captures import index_captures, rejected_captures, wet_locations
from gleanrank.operators.numbering import batch_of, number_rows
from gleanrank.operators.records import filter_domain
from gleanrank.session import Scratch, materialize
from gleanrank.sinks.tables import write_extracts, write_rejects
from gleanrank.sources.records import read_wet


def domain_records(spark: SparkSession, captures: DataFrame, archives: str, word: str,
                   strict: bool = False, batch_size: int = 50, scope: Scratch | None = None) -> DataFrame:
    """Records of a domain out of the archives that hold the given captures.

    Each archive is read once, however many captures point to it. The archive paths go to the driver,
    as the file reader takes paths; they are as many as the files it then has to list. An archive's
    batch is that of its first capture. Archives are told apart by their whole path, so `archives` has to be
    absolute; a file that was read and is not among the locations stops the job. Scratch tables are in `scope`, if it is
    given, otherwise they stay.
    """
    wets = (scope.keep if scope else materialize)(wet_locations(captures, archives), "wet-locations")
    paths = [row["wet"] for row in wets.select("wet").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], schemas.EXTRACTS)
    batches = wets.select(
        plain_path(F.col("wet")).alias("path"), "wet_pos",
        batch_of(F.col("wet_pos"), batch_size, start=0).alias("batch"),
    )
    found = filter_domain(read_wet(spark, paths, word, strict, scope=scope), word, strict)
    lost = F.raise_error(F.concat(F.lit("read, but not among the located archives: "), "file"))
    return (
        found.withColumn("path", plain_path(F.col("file"), encoded=True))
        .join(batches, "path", "left")
        .withColumn("wet_pos", F.when(F.col("wet_pos").isNull(), lost.cast("bigint")).otherwise(F.col("wet_pos")))
        .select("file", "block", "pos", "uri", "header", "body", "wet_pos", "batch")
    )


def extract_domain(spark: SparkSession, captures: DataFrame, archives: str, domain: str,
                   out: str, crawls: Sequence[str] | None = None, rejects: str | None = None,
                   word: str | None = None, strict: bool = False, only_ok: bool = False,
                   batch_size: int = 50, format: str = "parquet", run: str | None = None) -> None:
    """Look a domain up in the index and store its records in `out`, beside those of other runs.

    Captures with another status than 200 go to `rejects`, and are still extracted unless `only_ok`. The
    record filter looks for `word` (the domain if not given) anywhere in a record's URI; `strict` asks
    for the host.

    The job's records replace those of an earlier run of the same name, so that it can be repeated; unless `run` names
    it, its name follows from what it looks for.
    """
    hits = index_captures(captures, domain, crawls)
    if run is None:
        asked = [domain, sorted(crawls) if crawls is not None else None, word or domain, strict, only_ok]
        run = hashlib.sha256(json.dumps(asked).encode()).hexdigest()[:16]
    with Scratch(spark, "extract") as scope:
        if "pos" not in hits.columns:
            hits = number_rows(hits, ["crawl", "url", "filename"], name="pos", start=0, keep=scope.keep)
        if rejects:
            write_rejects(rejected_captures(hits), rejects, run)
        if only_ok:
            hits = hits.filter(F.col("status") == "200")
        records = domain_records(spark, hits, archives, word or domain, strict, batch_size, scope)
        write_extracts(records, out, format, run)
