"""Set-similarity join of word shingles by parity sketches (method 7).

A document's sketch has m cells. Each of its distinct shingles falls into one cell and is XORed into it, so
an element that only one of two documents holds changes one cell: the number of cells that differ (the
Hamming distance over cells) never exceeds the symmetric difference. Two sets of sizes a <= b with Jaccard
similarity J differ in at most (1 - J)(a + b) / (1 + J) elements; if a sketch has more filled cells than that,
one of them must be equal in both. These cells are the join keys:

* Size bands. m is a power of two of about half the set size; a set whose partners may fall into the band
  below is sketched for that band as well. The smaller set's band decides.
* Cells of one element say little, as passages that many documents share produce them. If the cells of two or
  more elements outnumber the largest possible difference, they alone are keys; otherwise cells of one element
  are keys too, and where even these are too few, the elements themselves.
* If at least t keys must agree, the t - 1 keys of highest hash can be left out on both sides (prefix filter).

No true pair is lost at any of these steps. Equal sets are one class, found by a 128-bit digest, and only
its representative is compared. A second sketch, of two to four bits an element, rejects most candidates: its
Hamming distance, too, is at most the symmetric difference. What passes is verified by exact intersection.

The pairs of a key are never written out. First, one document of each key, its leader, is compared with all
others, links join components, and leaders are dropped. Large groups of copies are one component after that,
and members of one component need no comparison. What is still open in a key is compared sketch against sketch
inside the key, in blocks of bounded size, and only pairs that pass leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from gleanrank.llm.graph import components
from gleanrank.llm.words import ascii_words, batches, bound_batches, mix, shingle_set, worker_state
from gleanrank.session import materialize

# Cells per element lie between this and twice this.
CELLS = 0.4


def cells_for(size: int) -> int:
    """Cells of the sketch of a set of this size: a power of two, 8 at least."""
    return 1 << max(3, int(np.ceil(np.log2(CELLS * max(size, 1)))))


def _keys_in_band(elements: np.ndarray, cells: int, differ: int) -> list[np.ndarray]:
    """Keys of a set in the band of `cells`, if a partner differs in at most `differ` elements."""
    cell = (elements >> np.uint64(20)) & np.uint64(cells - 1)
    order = np.argsort(cell, kind="stable")
    cell, sorted_elements = cell[order], elements[order]
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    parity = np.bitwise_xor.reduceat(sorted_elements, starts)
    counts = np.diff(np.r_[starts, len(cell)])
    keys = mix(parity + mix(cell[starts] + np.uint64(cells << 32)))
    several = keys[counts > 1]
    agree = len(several) - differ
    if agree >= 1:
        several.sort()
        return [several[: len(several) - agree + 1]]
    if len(keys) > differ:
        return [keys]
    return [keys, mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5))]


def sketch_keys(elements: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of a set (sorted distinct hashes): any other set with Jaccard similarity of at least
    `percent` / 100 shares one of them."""
    size = len(elements)
    largest = size * 100 // percent
    # A partner of size s differs in at most (100 - percent)(size + s) / (100 + percent) elements.
    differ = (100 - percent) * (size + largest) // (100 + percent)
    if differ < 1:
        return np.empty(0, np.uint64)
    own, below = cells_for(size), cells_for(-(-size * percent // 100))
    found = _keys_in_band(elements, own, differ)
    if below != own:
        found += _keys_in_band(elements, below, (100 - percent) * 2 * size // (100 + percent))
    return np.concatenate(found)


def _digest(elements: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set, as signed integers."""
    high = int(mix(np.array([mix(elements).sum(dtype=np.uint64) + np.uint64(len(elements))])).view(np.int64)[0])
    low = int(mix(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
    return high, low


def _set_rows(shingle: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for batch in batches(source):
            sets = [shingle_set(ascii_words(text), shingle) for text in batch.column(1).to_pylist()]
            digests = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]),
                 pa.array(digests[:, 1]), pa.array([bit_sketch(s) for s in sets], pa.binary())],
                ["id", "n", "high", "low", "sketch"],
            )
    return run


def _key_rows(shingle: int, percent: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        seen: set[int] = set()  # classes of this task, so that copies emit their keys once
        for batch in batches(source):
            keys, classes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for text in batch.column(0).to_pylist():
                elements = shingle_set(ascii_words(text), shingle)
                if len(elements) == 0:
                    continue
                high = _digest(elements)[0]
                if high in seen:
                    continue
                seen.add(high)
                found = sketch_keys(elements, percent)
                keys.append(found)
                classes.append(np.full(len(found), high, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(classes))], ["key", "high"]
            )
    return run


def _verify(shingle: int, percent: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for batch in batches(source):
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for left, right, left_text, right_text in zip(*columns):
                if left_text not in known:
                    # Pairs come grouped by their left document; one set at a time is kept.
                    known = {left_text: shingle_set(ascii_words(left_text), shingle)}
                one, other = known[left_text], shingle_set(ascii_words(right_text), shingle)
                common = len(np.intersect1d(one, other, assume_unique=True))
                if common and 100 * common >= percent * (len(one) + len(other) - common):
                    a.append(left)
                    b.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those (a, b) of `pairs` whose texts are similar enough. `texts`: (node, text)."""
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a"
    )
    return joined.select("a", "b", "left", "right").mapInArrow(_verify(shingle, percent), "a long, b long")


def _open_rows(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(key, node, c) of the keys whose nodes are in more than one component."""
    if comps is not None:
        rows = rows.select("key", "node").join(comps, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("c")
        )
    one_key = Window.partitionBy("key")
    return (
        rows.withColumn("_lo", F.min("c").over(one_key)).withColumn("_hi", F.max("c").over(one_key))
        .filter("_lo <> _hi").select("key", "node", "c")
    )


def bits_for(size: int) -> int:
    """Bits of the comparison sketch of a set of this size: a power of two, at least two for each element."""
    return 1 << max(7, int(np.ceil(np.log2(2 * max(size, 1)))))


def bit_sketch(elements: np.ndarray) -> bytes:
    """Bit i is the parity of the elements whose hash ends in i."""
    bits = bits_for(len(elements))
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch with fewer bits: parities of halves add up."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0) if len(sketch) > words else sketch


def _may_be_similar(sizes: np.ndarray, sketches: np.ndarray, size: int, sketch: np.ndarray, percent: int) -> np.ndarray:
    """Which sets the distance of sketches (rows of one width) does not rule out."""
    distance = np.bitwise_count(sketches ^ sketch).sum(axis=1, dtype=np.int64)
    small, large = np.minimum(sizes, size), np.maximum(sizes, size)
    return (distance * (100 + percent) <= (100 - percent) * (sizes + size)) & (100 * small >= percent * large)


def _pair_filter(percent: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            keep = []
            for n, m, s, t in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                words = min(len(s), len(t))
                keep.append(bool(_may_be_similar(np.array([n]), _fold(s, words)[None], m, _fold(t, words), percent)[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _group_pairs(percent: int):
    """Pairs of different components that the sketches do not rule out, for rows sorted by group:
    (group, first, second, node, c, n, sketch); a row with `first` is compared with rows with `second`."""
    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        words = min(len(r[6]) for r in rows) // 8
        table = np.stack([_fold(np.frombuffer(r[6], np.uint64), words) for r in rows])
        first, second = (np.array([r[i] for r in rows], bool) for i in (1, 2))
        node, c, n = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5))
        for i in np.flatnonzero(first):
            ok = second & (c != c[i]) & ((node > node[i]) | ~first | ~second[i])
            at = np.flatnonzero(ok)
            for j in at[_may_be_similar(n[at], table[at], n[i], table[i], percent)]:
                yield min(node[i], node[j]), max(node[i], node[j])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: list[tuple[int, int]] = []

        def batch_of(part: list[tuple[int, int]]) -> pa.RecordBatch:
            part = list(dict.fromkeys(part))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(p[i]) for p in part], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        for batch in source:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    found += pairs(held)
                    held = []
                    if len(found) >= 10_000:
                        yield batch_of(found)
                        found = []
                held.append(row)
        if held:
            found += pairs(held)
        yield batch_of(found)

    return run


#: Rows of a key that are compared at once.
BLOCK = 2000


def _pairs_within(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of one key of `rows` (key, node, c) and different components that sketches let pass."""
    counts = rows.groupBy("key").agg(F.count("*").alias("k")).select(
        "key", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(counts, "key").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    lower, upper = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select(
        F.xxhash64("key", lower, upper).alias("group"), (F.col("own") == lower).alias("first"),
        (F.col("own") == upper).alias("second"), "node", "c",
    ).join(sketches, "node")
    grouped = dealt.select("group", "first", "second", "node", "c", "n", "sketch").repartition("group").sortWithinPartitions("group")
    return grouped.mapInArrow(_group_pairs(percent), "a long, b long").distinct()


def similar_sets(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5,
                 percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Link documents whose shingle sets have a Jaccard similarity of at least `percent` / 100.

    Returns (rows, links). rows: id, n_shingles, component_id for every row of `docs`, repeated rows and null
    ids included; component_id is the least id reachable by links. links: pairs (a, b) of ids of class
    representatives, enough of them to connect every component.

    Defined cases: a null or empty text has no shingles and links with nothing. A row whose id is null is
    linked with nothing and its component_id is null. Rows that share an id are one document. Other columns
    of `docs` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sets = materialize(
        source.mapInArrow(_set_rows(shingle), "id long, n long, high long, low long, sketch binary"), "shingle-sets"
    )
    # One representative for each set; `high` alone stands for it among the candidates.
    reps = sets.filter("n > 0 and id is not null").groupBy("high", "low").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    keys = source.filter("id is not null").select("text").mapInArrow(_key_rows(shingle, percent), "key long, high long")
    one_key = Window.partitionBy("key")
    shared = materialize(
        keys.withColumn("_lo", F.min("high").over(one_key)).withColumn("_hi", F.max("high").over(one_key))
        .filter("_lo <> _hi").select("key", "high").distinct(),
        "sketch-keys",
    )
    sketches = materialize(
        shared.select("high").distinct().join(reps, "high").select("high", "node", "n", "sketch"), "sketches"
    )
    rows = materialize(
        _open_rows(shared.join(sketches, "high").select("key", "node", F.col("node").alias("c")), None), "open-keys"
    )
    sketches = sketches.select("node", "n", "sketch")
    side = lambda to, n, sketch: sketches.select(F.col("node").alias(to), F.col("n").alias(n), F.col("sketch").alias(sketch))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "pairs")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        texts = materialize(source.join(ids, "id").select(F.col("id").alias("node"), "text"), "candidate-texts")
        return materialize(_verified(pairs, texts, shingle, percent), "links")

    # The leader of each key against the others. It need not find all links, only make large groups one component.
    leads = rows.groupBy("key").agg(F.min(F.struct("node", "c")).alias("lead"))
    led = rows.join(leads, "key").filter("node <> lead.node")
    pairs = led.select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(side("a", "n", "s"), "a").join(side("b", "m", "t"), "b")
    links = verified(pairs.select("a", "b", "n", "m", "s", "t").mapInArrow(_pair_filter(percent), "a long, b long"))
    comps = components(links)
    # Every leader has met all others of its key; what is open is among the rest.
    rows = materialize(_open_rows(led.select("key", "node"), comps), "open-keys")
    if not rows.isEmpty():
        found = verified(_pairs_within(rows, sketches, percent))
        if not found.isEmpty():
            links = links.union(found)
            comps = components(links)
    of_set = reps.join(comps, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component"))
    placed = sets.filter("n > 0 and id is not null").select("id", "n", "high", "low").join(of_set, ["high", "low"])
    result = placed.select("id", "n", "component").union(
        sets.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    )
    return result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    ), links
