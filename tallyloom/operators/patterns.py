"""Patterns by item: fan-out, the best K, merge, flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def per_item(itemsets: DataFrame) -> DataFrame:
    """(item, items, support): a row for each item of each set."""
    return itemsets.select(F.explode("items").alias("item"), "items", "support")


def top_k(patterns: DataFrame, k: int = 50) -> DataFrame:
    """(item, rank, items, support): by falling support, then length, then items; equal patterns count once.

    Spark cuts each task's groups to k rows before it shuffles them.
    """
    order = Window.partitionBy("item").orderBy(F.desc("support"), F.desc(F.size("items")), F.desc("items"))
    rows = patterns.select("item", "items", "support").distinct().withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= k).select("item", "rank", "items", "support")


def merge_top_k(a: DataFrame, b: DataFrame, k: int = 50) -> DataFrame:
    """The best k of two ranked tables."""
    columns = ["item", "items", "support"]
    return top_k(a.select(*columns).unionByName(b.select(*columns)), k)


def collected(ranked: DataFrame) -> DataFrame:
    """(item, patterns): array of (items, support) by rank."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "items", "support")))
    unranked = lambda x: F.struct(x["items"].alias("items"), x["support"].alias("support"))
    return ranked.groupBy("item").agg(listed.alias("p")).select("item", F.transform("p", unranked).alias("patterns"))


def flatten(lists: DataFrame) -> DataFrame:
    """(item, items, support) of the arrays."""
    return lists.select("item", F.inline("patterns"))
