"""Removal of repeated passages by sliding spans of sentences (method 9).

Every run of several consecutive sentences is hashed, and equal hashes meet in one aggregation over all documents.
The first occurrence, by document id and place, stays; sentences covered by any later one are removed.

A run starts at a sentence and goes on until it has `SENTENCES` sentences, however short, or `LONG_WORDS` words in
two; likewise backwards from each sentence. So a repeated passage is covered from its first whole sentence to its
last, whatever the length of its sentences. In scripts without spaces two signs count as a word. Sentences of more than `CUT_ABOVE` words
are cut behind words that a hash picks, at the same words wherever they occur.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gleanrank.llm.words import batches, bound_batches, mix
from gleanrank.session import materialize

SENTENCES, LONG_WORDS = 3, 30
CUT_ABOVE, CUT_EVERY = 40, 12
_BOUNDARY = re.compile(r"(?<=[.!?。！？…])\s+|\n\s*|(?<=[。！？])")
_TOKEN = re.compile(r"\S+")
#: Signs of Thai, Lao, Burmese, Khmer, Chinese and Japanese.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_LAST = (1 << 63) - 1  # stands for a null id in the order of occurrences


def sentences_of(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text; what lies between two is white space."""
    if not text:
        return []
    found, at = [], 0
    for edge in [*(m.span() for m in _BOUNDARY.finditer(text)), (len(text), len(text))]:
        if text[at : edge[0]].strip():
            found += _pieces(text, at, edge[0])
        at = edge[1]
    return found


def _pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    if text.count(" ", start, end) < CUT_ABOVE:
        return [(start, end)]
    tokens = list(_TOKEN.finditer(text, start, end))
    if len(tokens) <= CUT_ABOVE:
        return [(start, end)]
    found, first = [], start
    for one, after in zip(tokens, tokens[1:]):
        if zlib.crc32(one.group().lower().encode("utf-8", "surrogatepass")) % CUT_EVERY == 0:
            found.append((first, one.end()))
            first = after.start()
    return [*found, (first, end)]


def runs_of(counts: list[int]) -> list[tuple[int, int]]:
    """(first, last) sentence of the runs to hash, for the number of words of each sentence."""
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    n, runs = len(counts), []
    if n == 0:
        return runs
    i = np.arange(n)
    # Forwards: last sentence such that the run holds enough; n stands for none. A run has two sentences at least.
    last = np.minimum(i + SENTENCES - 1, np.maximum(i + 1, np.searchsorted(total, total[:-1] + LONG_WORDS) - 1))
    # Backwards: first sentence such that the run up to i holds enough.
    first = np.maximum(i - SENTENCES + 1, np.minimum(i - 1, np.searchsorted(total, total[1:] - LONG_WORDS, "right") - 1))
    return sorted({*zip(i[last < n].tolist(), last[last < n].tolist()), *zip(first[first >= 0].tolist(), i[first >= 0].tolist())})


def _length(sentence: str, words: list[str]) -> int:
    """Words of a sentence, or half its signs of scripts without spaces if those are more."""
    return len(words) if sentence.isascii() else max(len(words), len(_UNSPACED.findall(sentence)) // 2)


def span_hashes(sentences: list[str]) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """The runs of a document, a 64-bit hash of each and an independent 32-bit one."""
    plain = [s.lower().split() for s in sentences]
    runs = runs_of([_length(s, w) for s, w in zip(sentences, plain)])
    # The halves of 128-bit hashes of the sentences, each summed up by itself.
    digests = b"".join(xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in plain)
    halves = np.frombuffer(digests, "<u8").astype(np.uint64).reshape(-1, 2)
    first, last = (np.array(x, np.int64) for x in (zip(*runs) if runs else ((), ())))
    total = np.zeros((len(runs), 2), np.uint64)
    for step in range(int((last - first).max()) + 1 if runs else 0):
        at = first + step
        there = mix(halves[np.minimum(at, len(halves) - 1)] + mix(np.uint64([step + 1])))
        total += np.where((at <= last)[:, None], there, np.uint64(0))
    key, check = mix(total).T
    return runs, key, (check >> np.uint64(33)).astype(np.int32)


def _span_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source):
        parts: list[list] = [[], [], [], [], [], []]
        for doc, tie, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            runs, key, check = span_hashes([text[a:b] for a, b in sentences_of(text)])
            if runs:
                first, last = (np.array(x, np.int32) for x in zip(*runs))
                row = np.full(len(runs), doc, np.int64), np.full(len(runs), tie, np.int32)
                for part, value in zip(parts, (key.view(np.int64), check, *row, first, last)):
                    part.append(value)
        kinds = (np.int64, np.int32, np.int64, np.int32, np.int32, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.empty(0, k), *p])) for p, k in zip(parts, kinds)],
            ["key", "check", "doc", "tie", "start", "stop"],
        )


def _without(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, sentences, removed, removed_words, text) for batches of (row, text, ranges)."""
    for batch in batches(source):
        columns: list[list] = [[], [], [], []]
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            spans = sentences_of(text)
            gone = np.zeros(len(spans), bool)
            for r in ranges or ():
                gone[r["start"] : r["stop"] + 1] = True
            kept, words = text, 0
            if gone.any():
                ends = [b for b, _ in spans[1:]] + [len(text)]
                kept = (text[: spans[0][0]] + "".join(text[a:e] for (a, _), e, g in zip(spans, ends, gone) if not g)).strip()
                words = sum(len(text[a:b].split()) for (a, b), g in zip(spans, gone) if g)
            for column, value in zip(columns, (len(spans), np.flatnonzero(gone).tolist(), words, kept)):
                column.append(value)
        kinds = (pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["doc", "n_sentences", "removed", "removed_words", "text"],
        )


def remove_repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_sentences, removed, removed_words, first_docs, text) for every row of `docs`.

    `removed` lists the numbers of the removed sentences, from 0; `first_docs` the ids of the documents in
    which the removed passages stay, null ids left out; `text` is what is left, unchanged where nothing is removed.

    Defined cases: null and empty texts have no sentences, and the text stays as it is. Documents too short for
    a run are never changed. Of equal runs that overlap within a document, what the first of them covers
    stays. Rows that share id and text are occurrences of one document: runs at the same place of it do not
    repeat each other. Rows that share an id only are documents of their own, in the order of a hash of the
    text; null ids come last in the order. Other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("doc"),
        F.coalesce(F.hash(F.col(text).cast("string")), F.lit(0)).alias("tie"), F.col(text).cast("string").alias("text"),
    )
    spans = source.mapInArrow(_span_rows, "key long, check int, doc long, tie int, start int, stop int")
    place = F.struct("doc", "tie", "start", "stop")
    # Stored, so that the join below deals out both its sides and adaptive execution can split frequent runs.
    firsts = materialize(
        spans.groupBy("key", "check").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("struct(first.doc, first.tie, first.start) <> struct(last.doc, last.tie, last.start)")
        .select("key", "check", "first"),
        "span-firsts",
    )
    later = spans.join(firsts, ["key", "check"]).filter(
        "doc <> first.doc or tie <> first.tie or start <> first.start"
    )
    same = (F.col("doc") == F.col("first.doc")) & (F.col("tie") == F.col("first.tie"))
    begin = F.when(same, F.greatest(F.col("start"), F.col("first.stop") + 1)).otherwise(F.col("start"))
    ranges = materialize(later.withColumn("start", begin).filter("start <= stop").groupBy("doc", "tie").agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges"),
        F.collect_set(F.when(F.col("first.doc") != _LAST, F.col("first.doc"))).alias("first_docs"),
    ), "span-ranges")
    joined = source.join(ranges, ["doc", "tie"], "left")
    packed = joined.select(F.struct("doc", "first_docs").alias("row"), "text", "ranges")
    kept = packed.mapInArrow(
        _without,
        "doc struct<doc: long, first_docs: array<long>>, n_sentences int, removed array<int>, removed_words long, text string",
    )
    return kept.select(
        F.nullif(F.col("doc.doc"), F.lit(_LAST)).alias("doc_id"), "n_sentences", "removed", "removed_words",
        F.array_sort(F.coalesce("doc.first_docs", F.array().cast("array<long>"))).alias("first_docs"), "text",
    )
