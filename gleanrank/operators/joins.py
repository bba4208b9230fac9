"""Equi-joins for keys whose number of rows is known and very uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# With at most this many hot keys, each on at least MIN_ROWS_PER_SLICE rows, the hot keys of 100 TB of
# text add up to no more than 100 MB.
MAX_HOT_KEYS = 100_000
MIN_ROWS_PER_SLICE = 1_000_000


def join_frequent(rows: DataFrame, keys: DataFrame, key: str, count: str, max_hot_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Inner join of `rows` to `keys`, where `keys[count]` says how many rows carry each key.

    The most frequent keys, at most `max_hot_keys`, are broadcast, so that the rows that carry them do not move; few
    words make most of a text. Only rows of other keys are shuffled, none of which is on many rows. The
    limit is a power of two, from a table of how many keys have a count of each order of magnitude. `rows` and
    `keys` are read twice, so they should be stored tables.
    """
    sizes = keys.groupBy((F.length(F.bin(count)) - 1).alias("power")).agg(F.count("*").alias("keys")).collect()
    limit, hot_keys = 1 << 62, 0
    for row in sorted(sizes, reverse=True):
        hot_keys += row["keys"]
        if hot_keys > max_hot_keys:
            break
        limit = 1 << row["power"]
    is_hot = F.col(count) >= limit
    hot = keys.filter(is_hot)
    moved = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keys.filter(~is_hot), key)
    return rows.join(F.broadcast(hot), key).unionByName(moved)


def join_counted(rows: DataFrame, keys: DataFrame, key: str, count: str, spread_by: str,
                 max_hot_keys: int = MAX_HOT_KEYS,
                 min_rows_per_slice: int = MIN_ROWS_PER_SLICE) -> DataFrame:
    """Inner join of `rows` to `keys`, where `keys[count]` bounds how many rows carry each key.

    A key with more rows than a slice holds is hot: its rows are dealt over several slices by a hash of
    `spread_by`, and its single row on the other side is repeated once per slice. A slice holds at least
    sum(count) / max_hot_keys rows, so at most `max_hot_keys` keys can be hot: that bounds the one
    broadcast made here, and the repeated rows, at any data size. Whether `keys` itself is small enough
    to broadcast is left to the planner, which knows its size at run time. `keys` is read three times, so
    it should be a stored table.
    """
    total = keys.agg(F.sum(count).alias("_total"))
    limit = F.greatest(F.lit(float(min_rows_per_slice)), F.col("_total") / F.lit(max_hot_keys))
    hot = (
        keys.select(key, count)
        .crossJoin(F.broadcast(total))
        .filter(F.col(count) > limit)
        .select(key, F.ceil(F.col(count) / limit).cast("int").alias("_slices"))
    )
    last = F.coalesce("_slices", F.lit(1)) - 1
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread_by), F.coalesce("_slices", F.lit(1))).cast("int")
    ).drop("_slices")
    repeated = keys.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), last))
    ).drop("_slices")
    return dealt.join(repeated, [key, "_slice"]).drop("_slice")
