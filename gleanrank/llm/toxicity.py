"""Toxicity scores from class-conditional Kneser-Ney models (method 3).

Two models of the spelling of words, one of toxic and one of ordinary texts, are compared on each document.
Rude expressions are rare and inflected, so the models run over the characters of each word, with contexts of
up to `ORDER` - 1 characters and its start and end as symbols:

    P_c(x | h) = max(n_c(h x) - D, 0) / n_c(h) + back_c(h) P_c(x | h without its first character)

n_c counts occurrences in the class at the longest context. Below it n counts, as Kneser and Ney do, the different
characters in front of the sequence (occurrences, if the sequence holds the start of the word). Down to contexts of `SHARED` characters they are counted in the class,
below that over the whole corpus, and shared by both classes: what neither class has seen often enough speaks for
neither. The last level is a character's share of all different pairs of characters.

A document's evidence is the difference of the two log-likelihoods of its words, normalised by their number. A
logistic regression, on labelled rows that the counts have not seen, turns the mean difference, and the mean and
sum of what exceeds one unit a word (a few rude words in a long text), into a probability.

Bounds. The class counts come from at most `max_class_rows` labelled rows of each class, the calibration from at
most `max_fit_rows` of each: those of least hash of the id. The model keeps every sequence of those rows, however
rare, so its size is bounded by the rows and their length; it goes to the driver as Arrow columns (24 bytes for a sequence) and
is sent to every task. The shared counts cover every document. Of them, those in a context that no sampled row holds
cannot tell the classes apart, as both back off alike there, and stay out.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gleanrank.llm.words import batches, bound_batches, least_by_hash, mix, worker_state
from gleanrank.session import materialize

DISCOUNT = 0.75
THRESHOLD = 0.7
ORDER, SHARED = 6, 3
_CLASS, _CORPUS, _BOTH = range(SHARED + 1, ORDER + 1), range(2, SHARED + 1), ["toxic", "ordinary"]
#: Probability of a character that the corpus does not have.
UNSEEN = 1e-7
#: Words a worker process remembers the difference of, and the longest of them.
_CACHE, _CACHED_LENGTH = 200_000, 64
#: Different words that are counted before their sequences are, and whose sequences are counted at once.
_FLUSH, _AT_ONCE = 200_000, 40_000
_WORD = re.compile(r"\w+")
_PLACE = mix(np.arange(1, 2 * ORDER + 3, dtype=np.uint64) << np.uint64(40)) | np.uint64(1)


def in_training(doc_id) -> F.Column:
    """Rows that labels may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 != 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each after its start symbols (1) and before its end (2), and the places to predict."""
    start = "\x01" * (ORDER - 1)
    text = start + ("\x02" + start).join(words) + "\x02" if words else ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return codes, np.flatnonzero(codes != 1)


def _sequence(codes: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Hash of the characters from `first` to `last` places before each place of `at`."""
    total = np.full(len(at), (last - first + 1) << 32, np.uint64)
    for back in range(first, last + 1):
        total += mix(codes[at - back] + _PLACE[back - first])  # the hash does not depend on what is predicted
    return mix(total)


def _grams(codes: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each place's sequence of `order` characters, and of the context before it."""
    context = _sequence(codes, at, 1, order - 1)
    return mix(context + mix(codes[at] + np.uint64(order << 32))), context


@dataclass
class Level:
    """Sequences of one length and their contexts, by sorted hash. Class levels have a column for each class; the values
    end in a row for what is not held."""

    order: int
    grams: np.ndarray
    kept: np.ndarray  # max(n - D, 0)
    contexts: np.ndarray
    total: np.ndarray  # n of the context's sequences
    back: np.ndarray  # the weight left for the level below

    def probability(self, gram: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
        at = _places(self.contexts, context)
        total = self.total[at]
        own = self.kept[_places(self.grams, gram)] / np.maximum(total, 1) + self.back[at] * below
        return np.where(total > 0, own, below)


@dataclass
class Model:
    """Levels from pairs of characters up; those up to SHARED are the corpus's, the others the classes'."""

    levels: list[Level]
    single: np.ndarray  # characters by code point, and their share, that of unknown ones at the end
    single_p: np.ndarray
    weights: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def of_words(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods of each word in the two classes (toxic, ordinary)."""
        codes, at = _symbols(words)
        p = self.single_p[_places(self.single, codes[at])]
        for level in self.levels:
            if level.kept.ndim > p.ndim:
                p = np.stack([p, p], axis=1)
            p = level.probability(*_grams(codes, at, level.order), p)
        owner = (np.cumsum(codes == 2) - (codes == 2))[at]
        return np.stack([np.bincount(owner, np.log(p[:, i]), minlength=len(words)) for i in (0, 1)], axis=1)

    def _differences(self, words: list[str]) -> np.ndarray:
        both = self.of_words(words)
        return both[:, 0] - both[:, 1]

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Features of each text for the logistic regression."""
        every = [words_of(t) for t in texts]
        known = worker_state(f"toxicity {self.name}")
        distinct = set().union(*every)
        now = {w: known[w] for w in distinct if w in known}
        new = list(distinct.difference(now))
        for start in range(0, len(new), 5_000):
            part = new[start : start + 5_000]
            now.update(zip(part, self._differences(part).tolist()))
        if len(known) < _CACHE:
            known.update((w, now[w]) for w in new if len(w) <= _CACHED_LENGTH)
        n = np.array([len(w) for w in every], np.int64)
        value = np.fromiter(map(now.__getitem__, chain.from_iterable(every)), float, int(n.sum()))
        owner = np.repeat(np.arange(len(texts)), n)
        of_text = lambda v: np.bincount(owner, v, minlength=len(texts)) if len(v) else np.zeros(len(texts))
        length, excess = np.maximum(n, 1), of_text(np.maximum(value - 1, 0))
        mean = of_text(np.clip(value, -1, 8)) / length
        return np.stack([np.ones(len(texts)), mean, np.sqrt(excess / length), np.log1p(excess)], axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.weights, -500, 500)))


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where the keys stand in a sorted table; the place behind its end for those that do not."""
    if len(table) == 0:
        return np.zeros(len(keys), np.int64)
    order = np.argsort(keys)  # sorted keys are looked up several times as fast
    found = np.searchsorted(table, keys[order])
    found[table[np.minimum(found, len(table) - 1)] != keys[order]] = len(table)
    at = np.empty_like(found)
    at[order] = found
    return at


def _ended(values: np.ndarray, end: float = 0) -> np.ndarray:
    """Values of a sorted table, with `end` behind them for keys that it does not hold."""
    return np.concatenate([values, np.full((1, *values.shape[1:]), end, values.dtype)])


def _word_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, ordinary) occurrences in each batch of (toxic, text)."""
    for batch in batches(source):
        counts = (Counter(), Counter())
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[0 if toxic == 1 else 1].update(words_of(text))
        words = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
            ["word", "toxic", "ordinary"],
        )


def _suffixes(codes: np.ndarray, at: np.ndarray, orders: range) -> list[np.ndarray]:
    """Sequence and context of each place, and whether the word's start is among them, from the longest order down."""
    return [x for order in reversed(orders) for x in (*_grams(codes, at, order), (codes[at - order + 1] == 1).astype(np.uint64))]


def _columns(orders: range) -> list[str]:
    return [f"{kind}{order}" for order in reversed(orders) for kind in ("gram", "context", "start")]


def _class_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of ORDER characters in the words of each batch of (word, toxic, ordinary), with their occurrences in
    either class, and their suffixes down to the shortest of the class levels."""
    for batch in batches(source):
        codes, at = _symbols(batch.column(0).to_pylist())
        word = (np.cumsum(codes == 2) - (codes == 2))[at]
        found = _suffixes(codes, at, _CLASS)
        _, first, place = np.unique(found[0], return_index=True, return_inverse=True)
        n = [np.bincount(place, batch.column(i).to_numpy()[word], minlength=len(first)).astype(np.int64) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*[f[first].view(np.int64) for f in found], *n)], [*_columns(_CLASS), *_BOTH])


def _corpus_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of SHARED + 1 characters in all words, with their suffixes, the character they end in, and their occurrences."""
    def parts(words: Counter) -> Iterator[list[tuple[str, int]]]:
        told = list(words.items())
        return (told[i : i + _AT_ONCE] for i in range(0, max(1, len(told)), _AT_ONCE))

    def out(words: list[tuple[str, int]]) -> pa.RecordBatch:
        codes, at = _symbols([w for w, _ in words])
        times = np.array([n for _, n in words], np.int64)
        found = [_grams(codes, at, SHARED + 1)[0], *_suffixes(codes, at, _CORPUS)] if len(at) else [codes] * (1 + 3 * len(_CORPUS))
        _, first, place = np.unique(found[0], return_index=True, return_inverse=True)
        n = np.bincount(place, times[(np.cumsum(codes == 2) - (codes == 2))[at]], minlength=len(first))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(f[first].view(np.int64)) for f in found), pa.array(codes[at][first].astype(np.int64)), pa.array(n.astype(np.int64))],
            ["longer", *_columns(_CORPUS), "last", "n"],
        )

    words: Counter = Counter()
    for batch in batches(source):
        for text in batch.column(0).to_pylist():
            words.update(words_of(text))
            if len(words) > _FLUSH:
                yield from map(out, parts(words))
                words = Counter()
    yield from map(out, parts(words))


def _longs(columns: list[str]) -> str:
    return ", ".join(f"{c} long" for c in columns)


def _labelled(labels: DataFrame, rows: int, fitting: bool) -> DataFrame:
    """(id, toxic) of at most `rows` rows of each class; one in five ids is kept for the calibration."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic in (0, 1)").filter(in_training("id"))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .withColumn("_at", F.xxhash64("id"))
    )
    fifth = F.pmod("_at", F.lit(5)) == 0
    part = known.filter(fifth if fitting else ~fifth)
    counts = dict(part.groupBy("toxic").count().collect())
    drawn = [
        least_by_hash(part.filter(F.col("toxic") == toxic), F.xxhash64("_at"), rows, counts.get(toxic, 0))
        for toxic in (1, 0)
    ]
    return drawn[0].union(drawn[1]).select("id", "toxic")


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    weights = np.zeros(x.shape[1])
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x = x / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + 0.01 * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights / scale


def _level(rows: DataFrame, order: int, counts: list[str]) -> Level:
    """The level of a table of (gram, context, counts). It goes to the driver as Arrow columns."""
    table = rows.select(F.col(f"gram{order}"), F.col(f"context{order}"), *counts).toArrow()
    gram, of = (table.column(i).to_numpy().view(np.uint64) for i in (0, 1))
    n = np.stack([table.column(c).to_numpy() for c in counts], axis=1).astype(np.float32)
    kept = np.maximum(n - np.float32(DISCOUNT), 0)
    sort = np.argsort(gram)
    contexts, place = np.unique(of, return_inverse=True)
    total, used = (
        np.stack([np.bincount(place, x[:, i], minlength=len(contexts)) for i in range(n.shape[1])], axis=1) for x in (n, kept)
    )
    back = (1 - used / np.maximum(total, 1)).astype(np.float32)
    if len(counts) == 1:
        kept, total, back = kept[:, 0], total[:, 0], back[:, 0]
    return Level(order, gram[sort], _ended(kept[sort]), contexts, _ended(total.astype(np.float32)), _ended(back, 1))


def _continued(rows: DataFrame, orders: range, order: int, counts: list[str], extra: list[str]) -> DataFrame:
    """The counts of sequences of `order` characters, from the rows of one more: the different characters in front, or
    occurrences where the sequence holds the start of a word, in front of which there is only that."""
    keys = [c for c in _columns(orders) if int(c[-1]) <= order] + extra
    each = lambda c: F.when(F.col(f"start{order}") == 1, F.col(c)).otherwise((F.col(c) > 0).cast("long"))
    return rows.groupBy(*keys).agg(*[F.sum(each(c)).alias(c) for c in counts])


def language_levels(words: DataFrame, texts: DataFrame) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """The levels from `words` (word, toxic, ordinary) of the labelled sample and `texts`, one column with the corpus, and
    characters with their share."""
    class_rows = words.mapInArrow(_class_rows, _longs([*_columns(_CLASS), *_BOTH]))
    longest = materialize(class_rows.groupBy(*_columns(_CLASS)).agg(*[F.sum(c).alias(c) for c in _BOTH]), "toxic-sequences")
    levels, rows = [_level(longest, ORDER, _BOTH)], longest
    for order in reversed(_CLASS[:-1]):
        rows = _continued(rows, _CLASS, order, _BOTH, [])
        levels.append(_level(rows, order, _BOTH))

    keys = ["longer", *_columns(_CORPUS), "last"]
    schema = _longs([*keys, "n"])
    corpus = texts.mapInArrow(_corpus_rows, schema).groupBy(*keys).agg(F.sum("n").alias("n"))
    rows = materialize(corpus, "corpus-sequences")
    sampled = materialize(words.select("word").mapInArrow(_corpus_rows, schema).select(*[c for c in _columns(_CORPUS) if "context" in c]).distinct(), "toxic-contexts")
    for order in reversed(_CORPUS):
        rows = _continued(rows, _CORPUS, order, ["n"], ["last"])
        # Where no sampled word has the context, both classes back off alike.
        held = sampled.select(f"context{order}").distinct()
        levels.append(_level(rows.join(held, f"context{order}", "left_semi"), order, ["n"]))
    singles = rows.groupBy("last").agg(F.count("*").alias("n")).orderBy("last").toArrow()
    n = singles.column("n").to_numpy().astype(float)
    return levels[::-1], singles.column("last").to_numpy().view(np.uint64), _ended(n / max(n.sum(), 1), UNSEEN)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", max_class_rows: int = 25_000,
          max_fit_rows: int = 10_000) -> Model:
    """Learn a model from `docs` and the `toxic` marks of `labels`, both keyed by doc_id."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # At most 2 * max_class_rows ids: bounded, so it may be sent to every task.
    sample = source.join(F.broadcast(_labelled(labels, max_class_rows, False)), "id").select("toxic", "text")
    words = materialize(
        sample.mapInArrow(_word_rows, "word string, toxic long, ordinary long").groupBy("word").agg(
            F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
        ),
        "toxic-words",
    )
    model = Model(*language_levels(words, source.select("text")), np.array([0.0, 1, 0, 0]))

    def evidence_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            found = model.evidence(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist(), pa.list_(pa.float64()))], ["toxic", "x"])

    fitting = source.join(F.broadcast(_labelled(labels, max_fit_rows, True)), "id").select("toxic", "text")
    fit = fitting.mapInArrow(evidence_rows, "toxic int, x array<double>").toArrow()
    y = fit.column("toxic").to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        model.weights = _fit(np.array(fit.column("x").to_pylist()), y)
    else:
        # Nothing to tell the classes apart by: every text gets the share of toxic rows, 0 without rows.
        share = min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6)
        model.weights = np.array([np.log(share / (1 - share)), 0, 0, 0])
    return model


def with_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, toxic_score): every row of `docs`, all its columns in the struct `row`, with its score."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).cast("string"))
    schema = T.StructType([packed.schema["row"], T.StructField("toxic_score", T.DoubleType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            scores = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row", "toxic_score"])

    return packed.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    Defined cases: null and empty texts have no words and get the score of a text without evidence; a null
    doc_id is not held out and scored all the same; repeated rows are scored alike; without labels of
    both classes every text gets the same score, below the threshold unless the labels say toxic only.
    Labels that are null, or other than 0 and 1, are not learnt from; of several labels of one id the toxic
    one counts. Other columns are ignored.
    """
    scored = with_scores(docs, train(docs, labels, text, **bounds), text)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(~in_training("row.doc_id"), F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The rows of `docs` whose score is below the threshold, with all columns."""
    scored = with_scores(docs, train(docs, labels, **bounds))
    return scored.filter(F.col("toxic_score") < THRESHOLD).select("row.*")
