"""Integer arithmetic on Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_div(number: Column, size: int) -> Column:
    """Integer quotient of a non-negative number; exact for every bigint, as no double is involved."""
    return F.call_function("div", number.cast("bigint"), F.lit(size).cast("bigint"))
