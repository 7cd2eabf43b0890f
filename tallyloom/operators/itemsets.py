"""Itemset algebra: ascending arrays of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def size(items: str) -> Column:
    return F.size(items)


def without_item(items: str, item: Column | int) -> Column:
    """The set less an item."""
    return F.array_remove(items, item)


def without_set(items: str, other: str | Column) -> Column:
    """The set less all items of another."""
    return F.array_except(items, other)


def compared(a: str | Column, b: str | Column) -> Column:
    """-1, 0 or 1: the order of two sets of one size, by their first items that differ."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def levels(itemsets: DataFrame) -> DataFrame:
    """(level, items, support): sets by their size."""
    return itemsets.select(F.size("items").alias("level"), "items", "support")
