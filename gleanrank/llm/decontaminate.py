"""Benchmark passages in documents by latent semantic retrieval (method 4).

Benchmark items are cut into passages of at most `PASSAGE` words. TF-IDF passages (the words of the passages, their
document frequencies counted over all documents) are reduced by a distributed randomised SVD: each product of
the passage matrix with a thin matrix is a Spark job over passage rows, whose partial sums meet by blocks of words;
the driver only factorises thin matrices. Each document is read as windows of two steps of `PASSAGE` words, so any
passage lies within one window. Windows are folded into the latent space, and a cosine search over all passages
proposes those of which a window may hold half the weight. What a rank too small for its block may lose of nearly
verbatim passages is completed by exact counts of a passage's rarest words: no passage that is kept in order escapes them.

Proposals are verified on the words of stretches of at most twice the passage's length:

* kept: at least `subsequence` of the passage's words stand there in order. They must be telling: either a run of `run`
  words (or the whole passage) stands there word by word, or the words shared carry `kept_information`, the sum of
  log(documents / documents with the word).
* paraphrased: at least `paraphrase` of the words in order and of the passage's information, which is `information` at least;
  the stretch's own cosine with the passage reaches `cosine`; and the passage's answer stands in the same stretch.

So a passage of common words alone counts if it is there word by word, and not because its words are everywhere.

Passages are taken in blocks of `block_passages`, of whatever items. The words, the reduced matrix and the passages of one block
are what a task holds, and the driver at a time; they travel as a broadcast, whose size the block bounds.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gleanrank.llm.words import batches, bound_batches, worker_state

PASSAGE = 48
RANK, OVERSAMPLE = 128, 16
_WORD = re.compile(r"\w+")
_BLOCKS = 16  # of words, in the sums of partial products


@dataclass(frozen=True)
class Rules:
    """When a stretch that resembles a passage counts as a leak. Shares are of the passage's words."""

    subsequence: float = 0.75  # kept in order: a leak, if the words are telling
    run: int = 8  # words in a row that are telling
    kept_information: float = 12.0  # of the shared words, in nats, that is telling
    paraphrase: float = 0.5  # kept in order, and of the information, with the answer
    information: float = 20.0  # of the shared words of a paraphrase, in nats
    cosine: float = 0.4  # of a paraphrase's stretch with the passage
    answer: float = 0.75  # of the answer's words, in order
    shortest: int = 6  # passages of fewer words must be there word by word


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def common_subsequence(one: list, other: list) -> int:
    """Length of the longest common subsequence, a machine word of `one` at a time."""
    places: dict = {}
    for i, w in enumerate(one):
        places[w] = places.get(w, 0) | (1 << i)
    full = (1 << len(one)) - 1
    row = full
    for w in other:
        hit = places.get(w)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return len(one) - row.bit_count()


@dataclass
class Index:
    """The passages of one block, in the latent space."""

    places: dict[str, int]  # words of the passages
    idf: np.ndarray
    information: np.ndarray  # log(documents / documents with the word)
    basis: np.ndarray  # words x rank, times idf
    latent: np.ndarray  # passages x rank, for passages of length 1
    gate: np.ndarray  # of the product of a window and a passage, from which the pair is proposed
    items: list[int | None]
    passages: list[list[str]]
    answers: list[list[str]]
    counts: list[Counter]  # of the words of each passage
    rules: Rules
    first: np.ndarray  # of each word, where its row in the next two begins
    holders: np.ndarray  # passages among whose rarest words it is
    times: np.ndarray  # how often
    wanted: np.ndarray  # how many of its rarest words a passage must find in a window

    def leaks(self, text: str | None) -> list[tuple[int, int | None, float, float, bool]]:
        """(first word of the window, item, cosine, share of the passage, answer found), the best for each item."""
        words = words_of(text)
        if not words or not self.passages:
            return []
        place = np.array(list(map(self.places.get, words, repeat(-1))), np.int64)
        known = np.flatnonzero(place >= 0)
        if len(known) == 0:
            return []
        steps = -(-len(words) // PASSAGE)
        step = known // PASSAGE
        place = place[known]
        best: dict = {}
        last, window, held = -1, [], set()
        for w, p in self._candidates(step, place, steps):
            if w != last:
                last, window = w, words[w * PASSAGE : (w + 2) * PASSAGE]
                held = set(window)
            found = self._verify(window, p) if self._may_leak(held, p) else None
            if found:
                share, cosine, answer = found
                item, row = self.items[p], (w * PASSAGE, self.items[p], cosine, share, answer)
                if item not in best or (row[3], row[2]) > (best[item][3], best[item][2]):
                    best[item] = row
        return list(best.values())

    def _candidates(self, step: np.ndarray, place: np.ndarray, steps: int) -> Iterator[tuple[int, int]]:
        """(window, passage) of the pairs that the cosine search proposes, and of those that share enough rare words."""
        windows = max(1, steps - 1)
        # A bounded number of windows at once, also of products and counters.
        stride = max(1, min(512, (1 << 22) // len(self.passages)))
        for start in range(0, windows, stride):
            n = min(stride, windows - start)
            at = slice(*np.searchsorted(step, [start, start + n + 1]))
            own, words = step[at] - start, place[at]
            if len(own) == 0:
                continue
            held, first = np.unique(own, return_index=True)
            sums = np.zeros((n + 1, self.basis.shape[1]), np.float32)
            sums[held] = np.add.reduceat(self.basis[words], first, axis=0)
            proposed = (sums[:-1] + sums[1:]) @ self.latent.T >= self.gate
            proposed |= self._counted(own, words, n)
            yield from ((start + w, p) for w, p in np.argwhere(proposed).tolist())

    def _counted(self, step: np.ndarray, place: np.ndarray, windows: int) -> np.ndarray:
        """windows x passages: whether the window holds enough of the passage's rarest words, counted exactly."""
        words = len(self.idf)
        # Each word stands in the window that starts at its step and in the one before.
        at, of = np.concatenate([step, step - 1]), np.concatenate([place, place])
        ok = (at >= 0) & (at < windows)
        key, count = np.unique(at[ok] * words + of[ok], return_counts=True)
        window, word = key // words, key % words
        many = self.first[word + 1] - self.first[word]
        entry = np.arange(many.sum()) + np.repeat(self.first[word] - np.r_[0, np.cumsum(many)[:-1]], many)
        pair = np.repeat(window, many) * len(self.passages) + self.holders[entry]
        held = np.bincount(pair, np.minimum(np.repeat(count, many), self.times[entry]), minlength=windows * len(self.passages))
        return held.reshape(windows, -1) >= self.wanted

    def _cosine(self, part: list[str], p: int) -> float:
        """Of a stretch with a passage, in the latent space; words that no passage has weigh as much as the others' mean."""
        counts = Counter(self.places.get(w, -1) for w in part)
        strange = counts.pop(-1, 0)
        if not counts:
            return 0.0
        at, n = np.array(list(counts)), np.array(list(counts.values()))
        length = np.sqrt(((n * self.idf[at]) ** 2).sum() + strange * self.idf.mean() ** 2)
        reach = np.sqrt((self.latent[p] ** 2).sum())
        return float((n @ self.basis[at]) @ self.latent[p] / max(length * reach, 1e-9))

    def _told(self, words: dict[str, int]) -> float:
        return sum(n * self.information[self.places[w]] for w, n in words.items() if w in self.places)

    def _may_leak(self, held: set[str], p: int) -> bool:
        """False only if `_verify` finds nothing, from the words alone that the window holds."""
        whole, rules = self.counts[p], self.rules
        shared = {w: whole[w] for w in whole.keys() & held}
        kept, n = sum(shared.values()), len(self.passages[p])
        if n < rules.shortest or kept < rules.paraphrase * n:
            return n < rules.shortest and kept == n
        return kept >= rules.subsequence * n or self._told(shared) >= max(rules.information, rules.paraphrase * self._told(whole))

    def _verify(self, window: list[str], p: int) -> tuple[float, float, bool] | None:
        """(share, cosine, answer found) of the best stretch of a window that leaks the passage."""
        passage, answer, rules = self.passages[p], self.answers[p], self.rules
        if len(passage) < rules.shortest:
            text, sought = " ".join(["", *window, ""]), " ".join(["", *passage, ""])
            return (1.0, self._cosine(passage, p), True) if sought in text else None
        least = rules.paraphrase * len(passage)
        if common_subsequence(passage, window) < least:
            return None
        width = 2 * len(passage)
        if width >= len(window):
            parts = [window]
        else:
            # Steps of half a passage, and the end.
            starts = [*range(0, len(window) - width, max(1, len(passage) // 2)), len(window) - width]
            parts = [window[i : i + width] for i in starts]
        whole, found = self.counts[p], []
        for part in parts:
            kept = common_subsequence(passage, part)
            if kept < least:
                continue
            share, shared = kept / len(passage), self._told(whole & Counter(part))
            has_answer = bool(answer) and common_subsequence(answer, part) >= rules.answer * len(answer)
            if share >= rules.subsequence:
                telling = shared >= rules.kept_information or _has_run(passage, part, min(len(passage), rules.run))
            else:
                telling = has_answer and shared >= max(rules.information, rules.paraphrase * self._told(whole))
                telling = telling and self._cosine(part, p) >= rules.cosine
            if telling:
                found.append((share, self._cosine(part, p), has_answer))
        return max(found, default=None)


def _has_run(passage: list[str], part: list[str], length: int) -> bool:
    """Whether `length` words of the passage stand in the part in a row."""
    text = " ".join(["", *part, ""])
    return any(" ".join(["", *passage[i : i + length], ""]) in text for i in range(len(passage) - length + 1))


def _cut(words: list[str]) -> list[list[str]]:
    """Passages of at most PASSAGE words; a last piece of less than half is part of the piece before it, shifted."""
    if len(words) <= PASSAGE:
        return [words]
    return [words[i : i + PASSAGE] for i in range(0, len(words) - PASSAGE, PASSAGE)] + [words[-PASSAGE:]]


def _document_frequencies(docs: DataFrame, places: dict[str, int]) -> tuple[np.ndarray, int]:
    vocabulary = set(places)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(len(places), np.int64), 0
        for batch in batches(source):
            for text in batch.column(0).to_pylist():
                rows += 1
                held = list(map(places.get, vocabulary.intersection(words_of(text))))
                counts[held] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[rows, counts[at]])], ["place", "n"])

    sums = docs.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(places) + 1, np.int64)
    n[sums.place.to_numpy()] = sums.n.to_numpy()  # place -1, the last one, counts the documents
    return n[:-1], int(n[-1])


def _summed(rows: DataFrame, product, height: int, width: int) -> np.ndarray:
    """The sum over all tasks of `product(batches of (words, values))`, a matrix, by blocks of its rows."""
    edges = np.linspace(0, height, _BLOCKS + 1).astype(int)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in source:
            for places, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                product(total, np.array(places, np.int64), np.array(values))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_BLOCKS), pa.int32()),
             pa.array([total[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())], ["part", "data"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(d) for d in table.column("data").to_pylist()], axis=0)
        return pa.table({"part": table.column("part").slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("places", "vals").mapInArrow(run, "part int, data binary").groupBy("part").applyInArrow(
        add, "part int, data binary"
    )
    found = {r.part: np.frombuffer(bytes(r.data)) for r in parts.collect()}
    return np.concatenate([found[i] for i in range(_BLOCKS)]).reshape(height, width)


def latent_basis(rows: DataFrame, height: int, count: int, rank: int = RANK, seed: int = 4) -> np.ndarray:
    """Leading right singular vectors (height x rank) of the sparse matrix in `rows` (places, vals), `count` rows.

    Randomised: the range of A'A times a random matrix, then the eigenvectors of A restricted to it.
    """
    width = min(rank + OVERSAMPLE, count, height)
    start = np.random.default_rng(seed).standard_normal((height, width))

    def onto(total, places, values):
        total[places] += np.outer(values, values @ start[places])

    q = np.linalg.qr(_summed(rows, onto, height, width))[0]

    def inner(total, places, values):
        row = values @ q[places]
        total += np.outer(row, row)

    values, vectors = np.linalg.eigh(_summed(rows, inner, width, width))
    best = np.argsort(values)[::-1][: min(rank, width)]
    return q @ vectors[:, best]


def _rarest(passages: list[list[str]], places: dict[str, int], idf: np.ndarray, rules: Rules) -> tuple[np.ndarray, ...]:
    """`first`, `holders`, `times` and `wanted` of an index.

    A passage of n words of which at least m stand in a window has, among any n - m + k of its words, k that do. The
    n - m + k rarest are held, with k of about m / 2, so that common words are in few rows.
    """
    entries, wanted = [], []
    for p, passage in enumerate(passages):
        n = len(passage)
        m = n if n < rules.shortest else min(n, max(1, int(np.ceil(rules.subsequence * n - 1e-9))))
        k = (m + 1) // 2
        rare = sorted((places[w] for w in passage), key=lambda w: (-idf[w], w))[: n - m + k]
        entries += [(w, p, c) for w, c in Counter(rare).items()]
        wanted.append(k)
    word, holders, times = np.array(sorted(entries), np.int64).T
    return np.searchsorted(word, np.arange(len(idf) + 1)), holders, times, np.array(wanted)


def passages_of(items: Iterator[tuple]) -> Iterator[tuple[int | None, list[str], list[str]]]:
    """(item_id, passage, answer) for items (item_id, text, answer or None), those without words left out."""
    for item, text, answer in items:
        words, told = words_of(text), words_of(answer)
        for passage in _cut(words) if words else ():
            # Without an answer column the end of the passage stands for it.
            yield item, passage, told or passage[-max(4, len(passage) // 4) :]


def build_index(spark: SparkSession, docs: DataFrame, block: list[tuple], rules: Rules = Rules(), rank: int = RANK) -> Index:
    """An index of (item_id, passage, answer) rows, one at least; document frequencies from `docs` (one text column)."""
    ids, passages, answers = (list(x) for x in zip(*block))
    places = {w: i for i, w in enumerate(sorted({w for p in passages for w in p}))}
    n, total = _document_frequencies(docs, places)
    information = np.log((1 + total) / (1 + n))
    idf = information + 1
    rows, lengths, told = [], [], []
    for passage in passages:
        at, count = np.unique([places[w] for w in passage], return_counts=True)
        value = count * idf[at]
        lengths.append(np.linalg.norm(value))
        told.append((count * information[at]).sum())
        rows.append((at.tolist(), (value / lengths[-1]).tolist()))
    table = spark.createDataFrame(rows, "places array<long>, vals array<double>")
    basis = latent_basis(table, len(places), len(rows), rank)
    latent = np.stack([np.array(v) @ basis[np.array(p)] for p, v in rows])
    # Half the passage's weight, as far as the latent space sees it. Where the passage cannot tell enough for a
    # paraphrase, only the counts propose it.
    gate = rules.paraphrase * np.array(lengths) * (latent**2).sum(axis=1)
    gate[np.array(told) < rules.information] = np.inf
    return Index(
        places, idf, information, (basis * idf[:, None]).astype(np.float32), latent.astype(np.float32), gate.astype(np.float32),
        ids, passages, answers, [Counter(p) for p in passages], rules, *_rarest(passages, places, idf, rules),
    )


LEAK = "array<struct<start: long, item_id: long, cosine: double, share: double, answer: boolean>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_passages: int = 2500,
               rules: Rules = Rules(), rank: int = RANK) -> DataFrame:
    """(row, leaks): every row of `docs`, all its columns in the struct `row`, with the items it leaks."""
    spark = docs.sparkSession
    bound_batches(spark)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer.alias("answer")).distinct()
    texts = docs.select(F.col(text).cast("string").alias("text"))
    result = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.array().cast(LEAK).alias("leaks")
    )

    def searched(rows: DataFrame, block: list[tuple]) -> DataFrame:
        # The broadcast keeps the index outside of the driver's Python memory.
        index = spark.sparkContext.broadcast(cloudpickle.dumps(build_index(spark, texts, block, rules, rank)))
        schema = T.StructType([*rows.schema.fields, T.StructField("found", rows.schema["leaks"].dataType)])
        names = ("start", "item_id", "cosine", "share", "answer")

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            worker_state()
            own = pickle.loads(index.value)
            for batch in batches(source):
                found = [[dict(zip(names, l)) for l in own.leaks(t)] for t in batch.column(2).to_pylist()]
                kind = pa.list_(pa.struct([
                    ("start", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()),
                    ("answer", pa.bool_()),
                ]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found, kind)], ["row", "leaks", "found"]
                )

        told = rows.select("row", "leaks", F.col("row").getField(text).cast("string").alias("text"))
        # An item whose passages are in several blocks is told once.
        strange = F.filter("found", lambda l: ~F.exists("leaks", lambda k: k["item_id"].eqNullSafe(l["item_id"])))
        return told.mapInArrow(run, schema).select("row", F.concat("leaks", strange).alias("leaks"))

    # In a fixed order, so that blocks hold the same passages in every run.
    passages = passages_of(map(tuple, items.orderBy("item_id", "text", "answer").toLocalIterator()))
    while block := list(islice(passages, block_passages)):
        result = searched(result, block)
    return result


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, start, cosine, share, answer): one row for each document row and item it leaks.

    `start` is the first word of the window, `share` how much of the passage stands there in order.

    Defined cases: null and empty texts leak nothing; items without words are not sought; rows with a null
    doc_id or item_id are searched like others; repeated document rows give a row each, repeated items one;
    an empty table on either side gives an empty result. Other columns are ignored.
    """
    return with_leaks(docs, benchmark, text, **options).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.explode("leaks").alias("leak")
    ).select("doc_id", "leak.item_id", "leak.start", "leak.cosine", "leak.share", "leak.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that leak no item, with all columns."""
    return with_leaks(docs, benchmark, **options).filter(F.size("leaks") == 0).select("row.*")
