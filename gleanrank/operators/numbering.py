"""Dense row numbers over a global order, without sending the rows through one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleanrank.functions.arithmetic import whole_div
from gleanrank.session import materialize

# monotonically_increasing_id keeps the row's place inside its partition in the low 33 bits.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[str | Column], name: str = "id", start: int = 1,
                partitions: int | None = None,
                keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Add `name` = start, start+1, ... in the given order, with no gap.

    Rows are range-partitioned on the whole order key, so a file, score or source that holds most of
    the rows still spreads over many tasks. Each row's partition and place are stored once; the only
    thing summed up in order is one row count per partition. `partitions` defaults to the session's
    number of shuffle partitions; `keep` stores the places.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = keep(placed, "numbered")
    part = F.shiftright("_slot", _PLACE_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    place = F.col("_slot").bitwiseAND((1 << _PLACE_BITS) - 1)
    # One row per shuffle partition: small whatever the number of rows.
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + place + F.lit(start)).alias(name))
    )


def batch_of(number: Column, size: int, start: int = 1) -> Column:
    """Label of the fixed-size group that a row number falls in."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    return whole_div(number - F.lit(start), size)
