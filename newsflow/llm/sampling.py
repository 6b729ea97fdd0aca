"""Bounded samples by hash that send the driver little more than they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(*cols: str | Column) -> Column:
    """A number in [0, 1) that the columns choose."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / float(1 << 53)


def ceiling(wanted: int, total: int) -> float:
    """A share below which at least ``wanted`` of ``total`` rows lie, but for a chance of less than one in a million."""
    return 1.0 if total <= wanted else (wanted + 6 * wanted**0.5 + 40) / total


def least(rows: DataFrame, wanted: int, total: int, *cols: str) -> DataFrame:
    """The ``wanted`` rows of the least share of ``cols``. A filter by share comes first, so of all partitions together about ``wanted`` rows are sorted."""
    return rows.where(share(*cols) <= ceiling(wanted, total)).orderBy(share(*cols), *cols).limit(wanted)


def level(sizes: list[int], wanted: int) -> float:
    """The number of rows to take of each group, or all where it has fewer, so that there are ``wanted`` in all."""
    for i, n in enumerate(sorted(sizes)):
        each = wanted / (len(sizes) - i)
        if n > each:
            return each
        wanted -= n
    return float(max(sizes, default=0))
