"""Words and their spelling variants, by sorted permuterm rotations (method 11).

A word of n characters and an end mark has n + 1 rotations. Deleting the character at one place, or replacing it by
any other, leaves the rotation that begins behind it unchanged but for its last character:

    color$   rotated to begin behind the "o" at place 1:   lor$c|o     prefix  lor$c
    colr$ .. every word that differs from it at that place alone has a rotation with the same prefix, and the word
             without that character has the prefix itself as a rotation:       lor$c  of  "clor"

So all rotations are sorted, each word's whole rotations and their prefixes without the edited character, and one scan over
equal keys finds the neighbours: rows with the same prefix differ by a replacement, rows whose whole rotation equals
a prefix by an insertion or deletion. A key and the edited character tell the word, so a key has at most one row for
each character of the alphabet, however frequent the words are; nothing is capped. A replacement is found at one place
only; a deletion from a run of equal characters counts at the last place of the run only, so that each pair of words is
met once. A scan does not write pairs: within a key, sorted by frequency, it gives each word the number of its
neighbours there and the most frequent one, and both add up by word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gleanrank.llm.words import batches, bound_batches
from gleanrank.session import materialize

#: Fixed alphabet of the runs that words are read from: Latin letters, U+00D7 and U+00F7 included. Only A-Z lose their case.
ALPHABET = "a-zÀ-ÿ"
#: Marks the end of a word in its rotations. Sorts before every other character.
END = "\x00"
WHOLE, REPLACED, DELETED = 0, 1, 2
_FLUSH = 200_000


def _lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2,
                typo_every: int | None = None) -> DataFrame:
    """(word, n): the words of at least `shortest` characters and `least` occurrences in all texts.

    A word is a maximal run of the letters of ALPHABET, A-Z lower-cased. `typo_every` plants mistakes, for tests of what
    follows: where it divides h, the crc32 of `<id>:<run>`, the run's character at h modulo its length is left
    out. A null id counts as an empty one there.
    """
    bound_batches(docs.sparkSession)
    # A run that is too short cannot make a word, with or without a mistake.
    run = re.compile(f"[{ALPHABET}]{{{max(1, shortest)},}}")

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in batches(source):
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = run.findall(_lowered(value or ""))
                if typo_every is None:
                    words.update(runs)
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter(runs).items():
                    h = zlib.crc32(w.encode(), start)
                    if h % typo_every == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < shortest:
                            continue
                    words[w] += n
                if len(words) > _FLUSH:
                    yield out()
                    words.clear()
        yield out()

    read = docs.select(F.col(id).cast("string"), F.col(text).cast("string"))
    return read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(key, word, n, kind): whole rotations of each word, and rotations without the edited character.

    `kind` is WHOLE, REPLACED (a prefix that stands for replacements only), or DELETED (for both).
    """
    size = F.length("word")
    # A rotation by i is the part of `turned` that begins behind i characters.
    told = words.filter(~F.contains("word", F.lit(END))).withColumn("turned", F.concat("word", F.lit(END), "word"))
    turn = lambda i, length: F.substring("turned", i + 1, length)
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(turn(i, size + 1).alias("key"), F.lit(WHOLE).alias("kind")))
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    without = F.transform(places, lambda i: F.struct(
        turn(i + 1, size).alias("key"), F.when(letter(i) == letter(i + 1), REPLACED).otherwise(DELETED).alias("kind")
    ))
    return told.select("word", "n", F.inline(F.concat(whole, without))).select("key", "word", "n", "kind")


_FOUND = pa.schema([("word", pa.string()), ("near", pa.int64()), ("n", pa.int64()), ("form", pa.string())])


def _scanned(table: pa.Table) -> pa.RecordBatch:
    """(word, near, n, form) of whole keys, sorted by key, then by frequency and word."""
    key = table.column("key").combine_chunks()
    fresh = np.ones(len(key), bool)
    if len(key):
        fresh[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))  # those that are not alone
    if len(rows) == 0:
        return pa.RecordBatch.from_pylist([], _FOUND)
    none = len(key)
    kind, starts = table.column("kind").to_numpy()[rows], np.flatnonzero(fresh[rows])
    group, place = np.cumsum(fresh[rows]) - 1, np.arange(len(rows))
    first = lambda held: np.minimum.reduceat(np.where(held, place, none), starts)[group]
    total = lambda held: np.add.reduceat(held.astype(np.int64), starts)[group]
    prefix, deleted = kind != WHOLE, kind == DELETED
    ahead, whole = first(prefix), first(~prefix)
    # Of equal prefixes the first in order, and for that one the second; a deletion meets the whole rotation too.
    best = np.where(place == ahead, first(prefix & (place != ahead)), ahead)
    best = np.where(deleted, np.minimum(best, whole), best)
    near = total(prefix) - 1 + (deleted & (whole < none))
    best, near = np.where(prefix, best, first(deleted)), np.where(prefix, near, total(deleted))
    found = np.flatnonzero(near > 0)
    word, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(rows[found])), pa.array(near[found], pa.int64()), pa.array(n[rows[best[found]]], pa.int64()),
         word.take(pa.array(rows[best[found]]))], schema=_FOUND,
    )


def _scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans batches of sorted (key, word, n, kind); the last key of a batch waits for the next one."""
    held = None
    for batch in source:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = table.column("key")[-1] if len(table) else None
        at = pc.index(table.column("key"), last).as_py() if last is not None else 0
        held = table.slice(at)
        yield _scanned(table.slice(0, at))
    if held is not None and len(held):
        yield _scanned(held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) for the words of `words` (word, n) with a word one edit away.

    `n_near` counts the words that differ by one inserted, deleted or replaced character; `form` is the most
    frequent of them, the first in code-point order of several.
    """
    # Every key is whole in one partition, and sorted there.
    keyed = rotations(words).repartition("key").sortWithinPartitions("key", F.desc("n"), "word")
    found = keyed.mapInArrow(_scan, "word string, near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): each word of `forms` (word, form) with the end of its chain of forms.

    Chains may not run in circles. A round doubles the steps taken, and is written before the next; with forms that are
    ten times as frequent as their words, chains have some ten steps and need four rounds.
    """
    spread = lambda f: materialize(f, "spelling-roots")
    now = spread(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = spread(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `words` (word, n).

    `form` is the most frequent word one edit away if it occurs at least `times` times as often, `root` where the
    forms lead, the word itself without one.

    Defined cases: an empty table gives an empty result; words must be distinct and not null, as those of `word_counts` are;
    a word that holds U+0000 has no neighbours; a word may be empty, and is then near to those of one character. Other
    columns are ignored.
    """
    if times < 2:
        raise ValueError("forms lead to an end only if they are more frequent than their words")
    words = materialize(words.select("word", "n"), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    told = words.join(near, "word", "left").withColumn("known", F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False)))
    told = materialize(told.select(
        "word", F.when(F.col("known"), F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("known"), F.col("form_n")).alias("form_n"),
    ), "spelling-forms")
    ends = roots(told.filter("form is not null"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
