"""Baskets: assembly, counts, support order, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import written


def assemble(pairs: DataFrame, distinct: bool = True) -> DataFrame:
    """(txn_id, items): sorted distinct items, or with distinct=False the sorted bag.

    Duplicates go before baskets are collected, so that a basket holds an item once.
    """
    rows = pairs.dropDuplicates(["txn_id", "item"]) if distinct else pairs
    return rows.groupBy("txn_id").agg(F.array_sort(F.collect_list("item")).alias("items"))


def transactions(pairs: DataFrame) -> DataFrame:
    """One row: n, the number of distinct transactions."""
    return pairs.agg(F.countDistinct("txn_id").alias("n"))


def item_counts(pairs: DataFrame) -> DataFrame:
    """(item, line_count, support): lines, and distinct transactions, of each item."""
    lines = pairs.groupBy("item", "txn_id").agg(F.count("*").alias("lines"))
    return lines.groupBy("item").agg(F.sum("lines").alias("line_count"), F.count("*").alias("support"))


def least_support(n: Column, min_support: float) -> Column:
    """The absolute bound: the ceiling of n times the relative support, in double arithmetic; inclusive."""
    return F.ceil(n.cast("double") * F.lit(float(min_support)))


def frequent_items(pairs: DataFrame, min_support: float, by: str = "support") -> DataFrame:
    """(item, support) with at least the least support, by distinct transactions or by ``line_count``."""
    counts = item_counts(pairs).select("item", F.col(by).alias("support"))
    enough = F.col("support") >= least_support(F.col("n"), min_support)
    return counts.crossJoin(F.broadcast(transactions(pairs))).where(enough).select("item", "support")


def ordered_baskets(pairs: DataFrame, min_support: float) -> DataFrame:
    """(txn_id, items): ``ordered`` by the frequent items of the same pairs, which are read and reduced to distinct rows once."""
    rows = written(pairs.select("txn_id", "item").distinct(), "pairs")
    counts = rows.groupBy("item").agg(F.count("*").alias("support"))
    n = F.broadcast(transactions(rows))  # one row
    frequent = counts.crossJoin(n).where(F.col("support") >= least_support(F.col("n"), min_support))
    return ordered(rows, frequent.select("item", "support"), distinct=True)


def ordered(pairs: DataFrame, frequent: DataFrame, distinct: bool = False) -> DataFrame:
    """(txn_id, items): frequent items, by falling support, ties by item; baskets without any stay, empty.

    The frequent side is hash-joined by item; Spark broadcasts it only if its size allows. distinct: ``pairs`` are.
    """
    rows = (pairs if distinct else pairs.dropDuplicates(["txn_id", "item"])).join(frequent, "item", "left")
    entry = F.when(F.col("support").isNotNull(), F.struct((-F.col("support")).alias("s"), F.col("item").alias("item")))
    items = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["item"])
    return rows.groupBy("txn_id").agg(items.alias("items"))


def group_of(item: Column, groups: int) -> Column:
    """The remainder, which keeps the item's sign."""
    return item % F.lit(groups)


def group_prefixes(baskets: DataFrame, groups: int) -> DataFrame:
    """(txn_id, group_id, items): for each group the prefix of the ordered basket up to the group's last item; weight 1.

    All within the row: no shuffle.
    """
    groups_of = F.array_distinct(F.transform("items", lambda x: group_of(x, groups)))
    place = lambda g: F.transform("items", lambda x, i: F.when(group_of(x, groups) == g, i + 1).otherwise(0))
    last = F.map_from_entries(F.transform(groups_of, lambda g: F.struct(g.alias("g"), F.array_max(place(g)).alias("p"))))
    rows = baskets.select("txn_id", "items", F.explode(last).alias("group_id", "p"))
    weight = F.lit(1).cast("long").alias("weight")
    return rows.select("txn_id", "group_id", F.slice("items", F.lit(1), F.col("p")).alias("items"), weight)
