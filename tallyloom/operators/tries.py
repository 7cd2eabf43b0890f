"""Weighted baskets and their prefix table: a trie as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_table(weighted: DataFrame) -> DataFrame:
    """(path, depth, count): the weight of all patterns that start with the path. weighted: (items, weight)."""
    rows = weighted.where(F.size("items") > 0)
    prefixes = F.transform(F.sequence(F.lit(1), F.size("items")), lambda d: F.slice("items", F.lit(1), d))
    counts = rows.select(F.explode(prefixes).alias("path"), "weight").groupBy("path").agg(F.sum("weight").alias("count"))
    return counts.select("path", F.size("path").alias("depth"), "count")


def residuals(prefixes: DataFrame) -> DataFrame:
    """(items, weight): count less the counts of the children, where that isn't 0: the patterns that were added."""
    parent = F.expr("slice(path, 1, depth - 1)").alias("path")
    children = prefixes.where("depth > 1").select(parent, F.col("count").alias("c"))
    below = children.groupBy("path").agg(F.sum("c").alias("below"))
    weight = (F.col("count") - F.coalesce("below", F.lit(0))).alias("weight")
    return prefixes.join(below, "path", "left").select(F.col("path").alias("items"), weight).where("weight <> 0")


def merge(*weighted: DataFrame) -> DataFrame:
    """Patterns of all tries of a group, with summed weights."""
    out = weighted[0].select("items", "weight")
    for more in weighted[1:]:
        out = out.unionByName(more.select("items", "weight"))
    return out.groupBy("items").agg(F.sum("weight").alias("weight"))


def compressed(weighted: DataFrame) -> DataFrame:
    """Patterns by ascending items, equal ones as one."""
    rows = weighted.select(F.array_sort("items").alias("items"), "weight")
    return rows.groupBy("items").agg(F.sum("weight").alias("weight"))


def weighted_baskets(baskets: DataFrame) -> DataFrame:
    """(items, weight) of (txn_id, items)."""
    return baskets.groupBy("items").agg(F.count("*").alias("weight"))


def f_list(weighted: DataFrame) -> DataFrame:
    """(item, weight): summed weights of the patterns that hold the item."""
    rows = weighted.select(F.explode("items").alias("item"), "weight")
    return rows.groupBy("item").agg(F.sum("weight").alias("weight"))


def children(prefixes: DataFrame, path: list[int]) -> DataFrame:
    """(item, count) of a path's children."""
    below = prefixes.where(F.col("depth") == len(path) + 1)
    if path:
        below = below.where(F.slice("path", 1, len(path)) == F.array(*map(F.lit, path)).cast("array<int>"))
    return below.select(F.element_at("path", -1).alias("item"), "count")


def conditional_base(weighted: DataFrame, item: int) -> DataFrame:
    """(items, weight): what stands before the item in patterns that hold it; empty prefixes are left out."""
    at = F.array_position("items", F.lit(item))
    before = F.slice("items", F.lit(1), (at - 1).cast("int")).alias("items")
    return weighted.where(at > 1).select(before, "weight").groupBy("items").agg(F.sum("weight").alias("weight"))


def nodes(prefixes: DataFrame) -> DataFrame:
    """(path, item, depth, count, children): every node with its item and its children's items, ascending.

    ``size(children)`` is the number of children, ``get(children, i)`` the one at an index (none beyond the last),
    ``array_contains`` finds one by its item. A tree is empty if it has no nodes.
    """
    parent = F.expr("slice(path, 1, depth - 1)").alias("path")
    below = prefixes.where("depth > 1").select(parent, F.element_at("path", -1).alias("x"))
    below = below.groupBy("path").agg(F.array_sort(F.collect_list("x")).alias("children"))
    out = prefixes.join(below, "path", "left")
    none = F.slice("path", 1, 0)
    children = F.coalesce("children", none).alias("children")
    return out.select("path", F.element_at("path", -1).alias("item"), "depth", "count", children)
