"""Token ids of documents in a binary format with one shared compression dictionary (method 6).

A token folder holds two Parquet tables, so that any store Spark can write to will do, and a task that is run
again leaves no half-written file:

* `dictionary`: one row, (hash, dictionary): a zstandard dictionary trained on serialized id arrays, and its
  SHA-256 in hexadecimal.
* `blocks`: one row for each block of documents, in ascending order of their ids: (part, block, documents,
  first_id, last_id, image). The image is the binary format proper, all numbers little-endian:

      magic "TOKZ" | version u32 | SHA-256 of the dictionary, 32 bytes | n u32
      document ids, n x i64 (the least i64 for a null)
      frame ends, n x u64, counted from the first frame: the offset index
      token counts, n x u32
      n zstandard frames, one for each document: its ids as u32

A short document is read by its block's row (first_id and last_id prune the others), two numbers of the offset
index, and one frame. Long documents simply have a long frame.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from gleanrank.llm.words import bound_batches, least_by_hash, worker_state
from gleanrank.session import materialize

MAGIC, VERSION = b"TOKZ", 1
NULL_ID = -(1 << 63)
BLOCK_DOCUMENTS, BLOCK_BYTES = 512, 8 << 20
_HEAD = "<4sI32sI"
#: Texts are cut at single spaces and newlines, which byte-level pre-tokenization cuts at as well. Not so
#: inside longer runs of white space, also those that begin with the newline: a text with one of these is cut before a
#: space and a visible sign only.
_RUN = re.compile(r"\s[ \n](?:\s|\Z)|\n[^\S \n](?:\s|\Z)")
_CUT = re.compile(r"(?= \S)")
#: White space other than space and newline: the ASCII ones, and all.
_OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_OTHER_SPACE = re.compile(r"[^\S \n]")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_TRIPLES = tuple(p + c for p in _PAIRS for c in " \n")
#: Of a line: letters and the ASCII signs behind them, which are two pieces, or anything else.
_LINE_SHAPE = regex.compile(r"^(?:( ?\p{L}+)([!-/:-@\[-`{-~]*)|(.*))$", regex.MULTILINE)
#: Fixed rule of byte-level vocabularies: visible Latin-1 characters stand for their bytes, the other bytes, in order,
#: for the code points from 256.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_SPACE = chr(_SYMBOLS[ord(" ")])
#: The symbol of a byte that UTF-8 does not have stands between runs of symbols that are merged in one call, so many at a time.
_SEPARATOR, _TOGETHER = chr(0xFF), 100
#: Cached pieces of a worker process; the rest is encoded each time.
_CACHE = 900_000


class Encoder:
    """Ids of whole texts, with a cache of the ids of words.

    A tokenizer with byte-level pre-tokenization (no normalizer, no added prefix space) encodes a text piece by
    piece, so equal pieces have equal ids and can be remembered. Any other tokenizer, and any text that
    mentions an added token, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        import json

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        pre = told.get("pre_tokenizer") or {}
        self.by_piece = (
            told.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not told.get("truncation") and not told.get("padding")
        )
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        self.model, self.separator = self.tokenizer.model, None
        model, vocab = told["model"], self.tokenizer.get_vocab()
        rules = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if self.by_piece and model.get("type") == "BPE" and not any(model.get(r) for r in rules):
            if [v for v in vocab if _SEPARATOR in v] == [_SEPARATOR]:
                self.separator = vocab[_SEPARATOR]
        self.known: dict[str, bytes] = {}
        self.seen: set[int] = set()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _pieces(self, text: str) -> list[str]:
        if "\0" in text or _odd_spaces(text):
            return [p for p in _CUT.split(text) if p]
        # Between a newline and a space lies an empty piece, which has no ids.
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian u32 ids of each text."""
        plain = [self.by_piece and not any(a in t for a in self.added) for t in texts]
        pieces = [self._pieces(t) if p else None for t, p in zip(texts, plain)]
        known = self.known
        fresh = list(set().union(*filter(None, pieces)).difference(known))
        known.update(zip(fresh, self._of_pieces(fresh)))
        whole = iter(self._whole([t for t, p in zip(texts, plain) if not p]) if not all(plain) else ())
        arrays = [b"".join(map(known.__getitem__, ws)) if ws is not None else next(whole) for ws in pieces]
        self._forget(fresh)
        return arrays

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece: of words and the signs behind them by the merges alone, of others by the whole tokenizer."""
        if self.separator is None:
            return self._whole(pieces) if pieces else []
        lines = [p for p in pieces if "\n" not in p]
        shapes = dict(zip(lines, _LINE_SHAPE.findall("\n".join(lines))))
        parts = {part for word, signs, _ in shapes.values() for part in (word, signs)}.difference(self.known, [""])
        ids = {"": b""}
        for group, symbols in (
            ([p for p in parts if p.isascii()], lambda joined: joined.replace(" ", _SPACE).replace("\n", _SEPARATOR)),
            ([p for p in parts if not p.isascii()], _symbols),
        ):
            for at in range(0, len(group), _TOGETHER):
                some = group[at : at + _TOGETHER]
                ids.update(zip(some, self._merged(symbols("\n".join(some)), len(some))))
        odd = [p for p in pieces if p not in shapes or shapes[p][2]]
        ids_of = dict(zip(odd, self._whole(odd))) if odd else {}
        known = self.known
        for p, (word, signs, other) in shapes.items():
            if not other:
                ids_of[p] = (ids[word] if word in ids else known[word]) + (ids[signs] if signs in ids else known[signs])
        return [ids_of[p] for p in pieces]

    def _merged(self, symbols: str, n: int) -> list[bytes]:
        """Ids of `n` runs of symbols between separators, which no merge goes across."""
        ids = np.array([t.id for t in self.model.tokenize(symbols)], "<u4")
        data, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.separator)).tolist()
        if len(cuts) != n - 1:
            raise ValueError("a run of symbols holds the separator")
        return [data[start:end] for start, end in zip([0, *(c + 4 for c in cuts)], [*cuts, len(data)])]

    def _forget(self, fresh: list[str]) -> None:
        """Of the pieces just met keep words as long as there is room, and others if they are met in a second batch."""
        known, seen = self.known, self.seen
        if len(known) - len(fresh) >= _CACHE:
            for p in fresh:
                del known[p]
            return
        for p in fresh:
            if not p[1:].isalpha():
                h = hash(p)
                if h not in seen:
                    seen.add(h)
                    del known[p]
        if len(seen) > 4 * _CACHE:
            seen.clear()


def _symbols(joined: str) -> str:
    """Byte-level symbols of lines, with separators for newlines."""
    lines = joined.encode("utf-8", "surrogatepass").decode("latin-1").split("\n")
    return _SEPARATOR.join(lines).translate(_SYMBOLS)


def _odd_spaces(text: str) -> bool:
    """Whether `_RUN` finds something; texts with none but lone spaces and newlines, or pairs, are told without it."""
    if any(c in text for c in _OTHER_SPACES) if text.isascii() else _OTHER_SPACE.search(text):
        return _RUN.search(text) is not None
    return any(r in text for r in _TRIPLES) or text.endswith(_PAIRS)


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process: made once and kept while no other operator's tasks come."""
    return worker_state(f"encoder {path}", lambda: Encoder(path))


def _slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """(doc_id, ids): the ids of every whole text and `end_id`, as little-endian u32 bytes."""
    end = np.array([end_id], "<u4").tobytes()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        for batch in source:
            for part in _slices(batch, 1000, 8 << 20):
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i + end for i in ids], pa.binary())], ["doc_id", "ids"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def train_dictionary(docs: DataFrame, tokenizer_path: str, size: int = 64 << 10, sample_rows: int = 2000,
                     sample_chars: int = 8192) -> bytes:
    """A zstandard dictionary from the ids of the first `sample_chars` characters of at most `sample_rows`
    documents, those of least hash of the id. With too few or too uniform samples it holds their content as it is;
    without rows it is empty."""
    pieces = docs.select("doc_id", F.substring("text", 1, sample_chars).alias("text"))
    least = least_by_hash(pieces, F.xxhash64("doc_id"), sample_rows, docs.count())
    samples = [bytes(r.ids) for r in encode_documents(least, tokenizer_path).select("ids").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def _image(ids: list[int | None], arrays: list[bytes], dictionary_hash: bytes, compress) -> bytes:
    frames = [compress(a) for a in arrays]
    ends = np.cumsum([len(f) for f in frames], dtype="<u8")
    return b"".join([
        struct.pack(_HEAD, MAGIC, VERSION, dictionary_hash, len(ids)),
        np.array([NULL_ID if i is None else i for i in ids], "<i8").tobytes(), ends.tobytes(),
        np.array([len(a) // 4 for a in arrays], "<u4").tobytes(), *frames,
    ])


def read_image(image: bytes, dictionary: bytes, only: int | None = None) -> Iterator[tuple[int | None, bytes]]:
    """(document id, ids as u32 bytes) of a block image, or of its documents with the id `only`."""
    magic, version, digest, n = struct.unpack_from(_HEAD, image)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token block of this version")
    if digest != hashlib.sha256(dictionary).digest():
        raise ValueError("the block was written with another dictionary")
    at = struct.calcsize(_HEAD)
    ids = np.frombuffer(image, "<i8", n, at)
    ends = np.frombuffer(image, "<u8", n, at + 8 * n)
    counts = np.frombuffer(image, "<u4", n, at + 16 * n)
    first = at + 20 * n
    shared = _dictionary(dictionary)
    read = zstandard.ZstdDecompressor(**({"dict_data": shared} if shared else {})).decompress
    for i in range(n) if only is None else np.flatnonzero(ids == only).tolist():
        start = int(ends[i - 1]) if i else 0
        data = read(image[first + start : first + int(ends[i])])
        if len(data) != 4 * int(counts[i]):
            raise ValueError("a frame does not hold as many ids as its index says")
        yield (None if ids[i] == NULL_ID else int(ids[i])), data


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, level: int = 3,
                 partitions: int | None = None) -> None:
    """Encode every document of `docs` and write a token folder at `path`, in ascending doc_id order.

    Rows are range-partitioned on the id and the text, so that neither a repeated id nor a null one gathers in
    one task; nulls come first. Null and empty texts have the end id alone.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(source, tokenizer_path)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), dictionary)], "hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    end = np.array([end_id], "<u4").tobytes()
    # Texts are shorter than their ids, so these are what is dealt out and sorted.
    order = [F.col("doc_id").asc_nulls_first(), F.crc32("text"), F.length("text")]
    ranged = source.repartitionByRange(partitions, *order) if partitions else source.repartitionByRange(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shared = worker_encoder(tokenizer_path), _dictionary(dictionary)
        compress = zstandard.ZstdCompressor(level=level, **({"dict_data": shared} if shared else {})).compress
        block = 0
        for batch in batches:
            for rows in _slices(batch, BLOCK_DOCUMENTS, BLOCK_BYTES):
                ids = rows.column(1).to_pylist()
                arrays = [a + end for a in encoder.encode([t or "" for t in rows.column(2).to_pylist()])]
                real = [i for i in ids if i is not None]
                yield pa.RecordBatch.from_pylist([{
                    "part": rows.column(0)[0].as_py(), "block": block, "documents": len(ids),
                    "first_id": min(real, default=None), "last_id": max(real, default=None),
                    "image": _image(ids, arrays, digest, compress),
                }], schema=_BLOCKS)
                block += 1

    (
        ranged.sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(run, "part int, block int, documents int, first_id long, last_id long, image binary")
        .write.option("compression", "none").parquet(f"{path}/blocks")
    )


_BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("documents", pa.int32()), ("first_id", pa.int64()),
    ("last_id", pa.int64()), ("image", pa.binary()),
])


def _shared_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, place, doc_id, ids) of a token folder; `ids` as little-endian u32 bytes.

    Sorted by part, block and place the documents are in file order.
    """
    dictionary = _shared_dictionary(spark, path)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part, block, image in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids, arrays = zip(*read_image(image, dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), pa.array([block] * len(ids), pa.int32()),
                     pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()), pa.array(arrays, pa.binary())],
                    ["part", "block", "place", "doc_id", "ids"],
                )

    return spark.read.parquet(f"{path}/blocks").select("part", "block", "image").mapInArrow(
        run, "part int, block int, place int, doc_id long, ids binary"
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id: one block row is read, and one frame of it decoded."""
    dictionary = _shared_dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks").filter(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    ).orderBy("part", "block").select("image").collect()
    return [np.frombuffer(data, "<u4") for (image,) in blocks for _, data in read_image(bytes(image), dictionary, doc_id)]


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a token folder, read from its frames.

    `start` counts the ids of all documents before it in file order: sums over documents of a block, over
    blocks of a part, and over parts; the last has one row for each part.
    """
    rows = materialize(
        read_tokens(spark, path).select(
            "part", "block", "place", "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        ),
        "token-digests",
    )
    before = lambda n, *by: F.coalesce(F.sum(n).over(
        (Window.partitionBy(*by[:-1]) if by[1:] else Window).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    ), F.lit(0))
    blocks = rows.groupBy("part", "block").agg(F.sum("n_tokens").alias("n"))
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    offsets = blocks.withColumn("in_part", before("n", "part", "block")).join(
        F.broadcast(parts.withColumn("of_part", before("n", "part")).select("part", "of_part")), "part"
    ).select("part", "block", (F.col("in_part") + F.col("of_part")).alias("offset"))
    placed = rows.withColumn("in_block", before("n_tokens", "part", "block", "place"))
    return placed.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("offset") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"
    )
