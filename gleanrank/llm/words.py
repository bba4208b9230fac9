"""Words and shingle hashes of whole texts, for the operators that work in Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Odd multipliers, one for each place in a shingle, from the golden-ratio sequence.
_PLACE = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64) | 1 for i in range(64)], dtype=np.uint64)


def ascii_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text with A-Z lower-cased; none for a null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each of `x` (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(words: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    run = min(size, len(words))
    total = np.full(len(words) - run + 1, run, np.uint64)
    for i in range(run):
        total += mix(hashes[i : len(words) - run + 1 + i] + _PLACE[i]) * _PLACE[i + 1]
    return np.unique(mix(total))


def bound_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send at most so many rows at once to Python workers: whole texts are large, and the default is 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def worker_state(name: str = "", make: Callable[[], object] = dict):
    """What a Python worker process keeps from task to task under `name`, made when it is asked for first.

    Workers serve one stage after another, so only what was asked for last is kept: a chain of operators holds one
    operator's words at a time. Without a name nothing is kept any longer.
    """
    kept = sys.modules.setdefault("gleanrank_worker_state", types.ModuleType("gleanrank_worker_state")).__dict__
    if kept.get("name") != name:
        kept["value"] = None
        kept["name"], kept["value"] = name, make()
    return kept["value"]


def least_by_hash(rows: DataFrame, hashed: Column, wanted: int, count: int) -> DataFrame:
    """The `wanted` rows of `rows`, of which there are `count`, whose hash is least in its low 40 bits.

    Rows well above the expected bound go before the sort, so about twice as many as wanted ever meet, however
    many partitions there are; on few rows all are kept.
    """
    low = F.pmod(hashed, F.lit(1 << 40))
    most = (1 << 40) if count <= 4 * wanted else int((1 << 40) * (2 * wanted + 100) / count)
    return rows.withColumn("_low", low).filter(F.col("_low") < most).orderBy("_low", *rows.columns).limit(wanted).drop("_low")


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-empty batches of at most 4,096 rows and, but for single rows, about 16 MB."""
    for batch in source:
        step = max(1, min(4096, int(batch.num_rows * (16 << 20) / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
