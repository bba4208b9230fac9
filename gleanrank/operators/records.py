"""Archive records: parsing, cutting line sequences, domain filter, document fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleanrank.functions.arithmetic import whole_div
from gleanrank.functions.web import (
    BLANK_LINE, URI_HEADER, VERSION, VERSION_TOKEN, has_uri, in_domain, mentions, target_uri, text_of, title_of,
    unify_newlines,
)


def parse_records(raw: DataFrame, value: str = "value") -> DataFrame:
    """Replace the raw record text by uri, header and body; rows without a target URI are dropped.

    Headers end at the first blank line, so a missing or extra header moves nothing. The blank lines
    that close a record are not part of its body.
    """
    # Whether there is a URI is told from the raw text, so that the records that are left out are not parsed, and the
    # filter does not repeat the parsing. Only the first blank line is looked for: the rest of the text is copied, and
    # rewritten once.
    halves = F.split(F.col(value), BLANK_LINE, 2)
    header = F.regexp_replace(unify_newlines(F.get("_halves", F.lit(0))), rf"^(?:{VERSION}[^\n]*\n|\n)?", "")
    body = unify_newlines(F.coalesce(F.get("_halves", F.lit(1)), F.lit("")))
    kept = [name for name in raw.columns if name != value]
    return (
        raw.filter(has_uri(F.col(value))).withColumn("_halves", halves)
        .select(*kept, header.alias("header"), F.regexp_replace(body, r"\n+$", "").alias("body"))
        .select(*kept, target_uri(F.col("header")).alias("uri"), "header", "body")
    )


def rejoin_pieces(pieces: DataFrame) -> DataFrame:
    """(file, block, pos, value) of whole records, from pieces (file, block, pos, value, starts) of archives.

    Archives are cut at each line that begins with the version token; a piece that does not start a record is a part
    of the one before it. Such pieces are few, so they are gathered, in runs of consecutive places, and joined to
    the record at the place before the run. A run behind no record is what precedes an archive's first one, and goes.
    `pieces` is read twice: places must not change in between, so it should be a stored table.
    """
    order = Window.partitionBy("file", "block").orderBy("pos")
    runs = pieces.filter(~F.col("starts")).withColumn("_run", F.col("pos") - F.row_number().over(order))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda piece: piece["value"])
    cut = "\n" + VERSION_TOKEN
    tails = runs.groupBy("file", "block", "_run").agg(
        (F.min("pos") - 1).alias("pos"), F.concat(F.lit(cut), F.array_join(in_order, cut)).alias("_tail")
    ).drop("_run")
    heads = pieces.filter("starts").drop("starts")
    return heads.join(tails, ["file", "block", "pos"], "left").withColumn(
        "value", F.concat("value", F.coalesce("_tail", F.lit("")))
    ).drop("_tail")


def segment_lines(lines: DataFrame, chunk: int = 1_000_000, word: str | None = None,
                  strict: bool = False) -> DataFrame:
    """Cut (file, pos, line) rows into records: adds `rec`, the position where the line's record starts.

    A record starts two lines above its target-URI line and ends where the next one starts, or with the
    file. Lines before the first record are dropped, and with `word` those of records of other domains
    (see `filter_domain`), before any record is put together. A file is worked on in chunks of `chunk`
    positions, so no task holds a whole file; what a chunk has to know about the ones before it is one start.
    """
    is_uri = F.col("line").startswith(URI_HEADER)
    start = F.greatest(F.col("pos") - 2, F.lit(0))
    nothing = F.lit(None).cast("string")
    own = F.struct(F.col("pos").alias("pos"), F.lit(1).alias("kind"), F.col("line").alias("line"), nothing.alias("uri"))
    mark = F.struct(start.alias("pos"), F.lit(0).alias("kind"), nothing.alias("line"), F.col("line").alias("uri"))
    # A URI line also puts a mark at its record's first line, where the window below meets it. The lines are dealt out
    # once, and both the window and the summaries of chunks read that exchange.
    marked = lines.select(
        "file", F.inline(F.when(is_uri, F.array(mark, own)).otherwise(F.array(own)))
    ).withColumn("_chunk", whole_div(F.col("pos"), chunk)).filter("file is not null and _chunk is not null")
    marked = marked.repartition("file", "_chunk")

    before = Window.partitionBy("file").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.when(F.col("kind") == 0, F.struct("pos", "uri"))).alias("_last")
    # Counting characters keeps all columns in the summaries' side, without which the exchange would be made anew.
    chunks = marked.groupBy("file", "_chunk").agg(latest, F.sum(F.coalesce(F.length("line"), F.lit(0))).alias("_size"))
    carried = chunks.filter("_size >= 0").select("file", "_chunk", F.max("_last").over(before).alias("_carried"))
    inside = (
        Window.partitionBy("file", "_chunk").orderBy("pos", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        marked.withColumn("_start", F.max(F.when(F.col("kind") == 0, F.struct("pos", "uri"))).over(inside))
        .filter(F.col("kind") == 1)
        .join(carried, ["file", "_chunk"])
        .withColumn("_rec", F.coalesce("_start", "_carried"))
        .filter(F.col("_rec").isNotNull())
    )
    if word is not None:
        placed = placed.filter(domain_test(target_uri(F.col("_rec.uri")), word, strict))
    return placed.select("file", F.col("_rec.pos").alias("rec"), "pos", "line")


def assemble_records(segments: DataFrame) -> DataFrame:
    """Join the lines of each record in order and parse it: (file, pos, uri, header, body)."""
    in_order = F.array_sort(F.collect_list(F.struct("pos", "line")))
    raw = segments.groupBy("file", F.col("rec").alias("pos")).agg(
        F.array_join(F.transform(in_order, lambda row: row["line"]), "\n").alias("value")
    )
    return parse_records(raw)


def filter_domain(records: DataFrame, word: str, strict: bool = False) -> DataFrame:
    """Records whose target URI mentions the word; `strict` asks for the domain or a subdomain."""
    return records.filter(domain_test(F.col("uri"), word, strict))


def may_mention(text: Column, word: str, strict: bool = False) -> Column:
    """False only for raw records that `filter_domain` would drop: their text does not hold the word."""
    return F.lower(text).contains(word.lower()) if strict else text.contains(word)


def domain_test(uri: Column, word: str, strict: bool = False) -> Column:
    return in_domain(uri, word) if strict else mentions(uri, word)


def record_fields(records: DataFrame) -> DataFrame:
    """Add url, title and text, in place of uri, header and body."""
    kept = [name for name in records.columns if name not in ("uri", "header", "body")]
    return records.select(
        *kept,
        F.trim("uri").alias("url"),
        title_of(F.col("body")).alias("title"),
        text_of(F.col("body")).alias("text"),
    )
