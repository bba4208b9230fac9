"""Readers of archive records: extracted-text archives, and domain extracts cut out of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from gleanrank import schemas
from gleanrank.functions.web import VERSION_TOKEN, starts_record
from gleanrank.operators.records import may_mention, parse_records, rejoin_pieces
from gleanrank.session import Scratch, materialize


def _pieces(reader: DataFrameReader, paths: str | Sequence[str], word: str | None, strict: bool) -> DataFrame:
    # A version token at the start of a line stands in archives of any version and either newline.
    separated = reader.option("lineSep", "\n" + VERSION_TOKEN)
    raw = separated.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
        starts_record(F.col("value")).alias("starts"),
    )
    # The URI is part of the raw text: a plain search of it spares most records the parsing.
    return raw if word is None else raw.filter(~F.col("starts") | may_mention(F.col("value"), word, strict))


def _read_records(reader: DataFrameReader, paths: str | Sequence[str], word: str | None, strict: bool,
                  rejoin: bool, scope: Scratch | None = None) -> DataFrame:
    pieces = _pieces(reader, paths, word, strict)
    if not rejoin:
        return parse_records(pieces.filter("starts").drop("starts"))
    if word is not None:
        # A domain's records are few: they are stored, and put together from there.
        pieces = scope.keep(pieces, "pieces") if scope else materialize(pieces, "pieces")
        cut = not pieces.filter("not starts").isEmpty()
    else:
        files = pieces.groupBy("file").agg(F.count_if("starts").alias("records"), F.count_if(~F.col("starts")).alias("others"))
        told = files.agg(F.min(F.when(F.col("records") == 0, F.col("file"))).alias("empty"), F.max("others").alias("others")).first()
        if told["empty"] is not None:
            raise ValueError(f"no archive record in {told['empty']}")
        cut = bool(told["others"])
    return parse_records(rejoin_pieces(pieces) if cut else pieces.filter("starts").drop("starts"))


def read_wet(spark: SparkSession, paths: str | Sequence[str], word: str | None = None,
             strict: bool = False, rejoin: bool = True, scope: Scratch | None = None) -> DataFrame:
    """Records of extracted-text archives, plain or gzip: (file, block, pos, uri, header, body).

    Archives may be of any version, and their lines end in LF or CRLF, also differently from file to file. With `word`,
    records whose raw text does not hold it (in any case under `strict`) are left out before they are parsed.

    The separator cannot tell a line of a text that begins with the version token from the start of a record. With
    `rejoin` such a record is put together again: a pass over the archives looks for false cuts and for files without a
    record, which raise an error; with `word`, the word's records are stored instead (in `scope`, if given), and read
    from there. Without it, the rest of such a record is lost. In an uncompressed archive that is read in splits, so is a false cut
    that is the first of its split.

    `pos` rises with the place of a record inside its block, `block` with the place of the block inside
    its file. Both follow how the scan is split at the moment, so no two scans may be joined on them. A gzip archive
    is one block, read by one task.
    """
    return _read_records(spark.read, paths, word, strict, rejoin, scope)


def read_extracts(spark: SparkSession, folder: str, rejoin: bool = True) -> DataFrame:
    """Records of all `.txt` extract files below a folder, in the columns of `read_wet`."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    return _read_records(reader, folder, None, False, rejoin)


def read_extract_table(spark: SparkSession, path: str) -> DataFrame:
    """Records written by `write_extracts` as parquet, with batch and archive position, of all its runs."""
    return spark.read.schema(schemas.EXTRACTS).parquet(path).select(*schemas.names(schemas.EXTRACTS))
