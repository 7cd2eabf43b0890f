"""Frequent itemsets with exact supports."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import discard, written
from .baskets import group_of
from .tries import weighted_baskets


def least_count(n: int, min_support: float) -> int:
    """The absolute bound: the ceiling of n times the relative support, in double arithmetic; 1 at least."""
    return max(1, math.ceil(float(n) * float(min_support)))


def frequent_itemsets(
    baskets: DataFrame, min_support: float, strategy: str = "fpgrowth", num_groups: int | None = None
) -> DataFrame:
    """(items, support): sets in at least ceil(n * min_support) of the n baskets; items ascend. A table, mined once.

    All strategies give the same sets, of any size. fpgrowth: parallel FP-growth in ``num_groups`` shards. weighted:
    equal baskets once, then sets grow by one item a level; cheap where few different baskets exist. auto: weighted
    if fewer than one in 20 baskets differ. No baskets, or a bound above their number: no sets.
    """
    if strategy == "auto":
        n, distinct = baskets.count(), baskets.select("items").distinct().count()
        strategy = "weighted" if 20 * distinct < n else "fpgrowth"
    if strategy == "weighted":
        return level_wise(weighted_baskets(baskets), min_support)
    n = baskets.count()
    least = least_count(n, min_support)
    if least > n:
        return _no_sets(baskets)
    # half below the bound: no rounding inside can move it
    shards = {"numPartitions": num_groups} if num_groups else {}
    rows = baskets.select(F.array_distinct("items").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=1.0, **shards).fit(rows)
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("support"))
    return written(found, "itemsets")


def _no_sets(baskets: DataFrame) -> DataFrame:
    return baskets.select("items", F.lit(0).cast("long").alias("support")).where(F.lit(False))


def level_wise(weighted: DataFrame, min_support: float) -> DataFrame:
    """As above from (items, weight)."""
    total = weighted.agg(F.sum("weight")).first()[0] or 0
    least = least_count(total, min_support)
    if least > total:
        return _no_sets(weighted)
    rest = F.array_sort(F.array_distinct("items"))
    start = weighted.select(F.slice(rest, 1, 0).alias("items"), rest.alias("rest"), "weight")
    return grown(start, least, forward=True)


def grown(start: DataFrame, least: int, forward: bool) -> DataFrame:
    """(items, support) of all sets that extend the given ones and have the least support. A table.

    start: (items, rest, weight): a set, and what may be added to it, in one order. A level adds one item of ``rest`` and
    keeps what stands after it (forward) or before it. Rows of one set and rest are merged, items that are too rare beside
    a set leave its rests, so rows shrink with the levels. A level is a table: no lineage grows, and there are as many levels as the
    largest set has items. Tables go once they are read.
    """
    level = start.groupBy("items", "rest").agg(F.sum("weight").alias("weight"))
    found, before, known = None, None, []
    while True:
        level = written(level, "projected")
        if before is not None:
            discard(before)
        before = level
        ends = level.select("items", F.explode("rest").alias("x"), "weight")
        ends = ends.groupBy("items", "x").agg(F.sum("weight").alias("support")).where(F.col("support") >= least)
        ends = written(ends, "extensions")
        known.append(ends)
        if not ends.head(1):
            out = written(found if found is not None else ends.select("items", "support"), "itemsets")
            discard(level, *known)
            return out
        longer = F.array_sort(F.concat("items", F.array("x")))
        sets = ends.select(longer.alias("items"), "support")
        found = sets if found is None else found.unionByName(sets)
        own = ends.groupBy("items").agg(F.collect_set("x").alias("alive"))
        rows = level.join(own, "items").select("items", F.array_intersect("rest", "alive").alias("rest"), "weight")
        rows = rows.select("items", "rest", "weight", F.posexplode("rest").alias("at", "x"))
        after = F.slice("rest", F.col("at") + 2, F.size("rest")) if forward else F.slice("rest", F.lit(1), F.col("at"))
        rows = rows.select(F.concat("items", F.array("x")).alias("items"), after.alias("rest"), "weight")
        level = rows.where(F.size("rest") > 0).groupBy("items", "rest").agg(F.sum("weight").alias("weight"))


def mined_by_group(prefixes: DataFrame, least: int, groups: int) -> DataFrame:
    """(group_id, items, support) from group-dependent baskets (group_id, items, weight), merged within each group.

    A set belongs to the group of the item that stands last of it in the baskets' order, and is mined there: together,
    groups give every frequent set once.
    """
    tries = prefixes.groupBy("group_id", "items").agg(F.sum("weight").alias("weight"))
    rows = tries.select("group_id", "items", "weight", F.posexplode("items").alias("at", "x"))
    rows = rows.where(group_of(F.col("x"), groups) == F.col("group_id"))
    rows = rows.select(F.array("x").alias("items"), F.slice("items", F.lit(1), F.col("at")).alias("rest"), "weight")
    rows = written(rows.groupBy("items", "rest").agg(F.sum("weight").alias("weight")), "group-tries")
    single = rows.groupBy("items").agg(F.sum("weight").alias("support")).where(F.col("support") >= least)
    single = written(single, "group-items")
    longer = grown(rows.join(single.select("items"), "items", "left_semi").where(F.size("rest") > 0), least, forward=False)
    # the order of the baskets is lost in a set: its group is that of the item that is rarest, the greater one of equals
    rank = single.select(F.col("items")[0].alias("x"), F.struct(-F.col("support"), F.col("items")[0]).alias("rank"))
    both = single.unionByName(longer).select("items", "support", F.explode("items").alias("x")).join(rank, "x")
    last = both.groupBy("items", "support").agg(F.max(F.struct("rank", "x")).alias("last"))
    return last.select(group_of(F.col("last.x"), groups).alias("group_id"), "items", "support")


#: Items whose combinations one step enumerates.
CHUNK = 12


def subsets(rows: DataFrame, items: str) -> DataFrame:
    """``rows`` with ``taken``: a row for every subset of the positions of an array, ascending from 0, the empty one too.

    ``CHUNK`` positions a step, so arrays of any length work; the number of rows is theirs by nature.
    """
    most = rows.agg(F.max(F.size(items))).first()[0] or 0
    out = rows.withColumn("taken", F.array().cast("array<int>"))
    for first in range(0, most, CHUNK):
        width = F.greatest(F.least(F.size(items) - first, F.lit(CHUNK)), F.lit(0))
        out = out.withColumn("m", F.explode(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), width) - 1)))
        bit = lambda i: F.col("m").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) > 0
        own = F.filter(F.sequence(F.lit(0), F.lit(CHUNK - 1)), bit)
        out = out.withColumn("taken", F.concat("taken", F.transform(own, lambda i: i + first)))
    return out.drop("m")


def path_combinations(paths: DataFrame, least: int = 0) -> DataFrame:
    """(items, support) of all non-empty combinations on single paths: (items, counts) from the top down, counts falling.

    A combination's support is its deepest item's count; those under ``least`` are left out, and the path's items
    under it before anything is combined. Paths of any length.
    """
    deep = F.size(F.filter("counts", lambda c: c >= least))
    rows = paths.select(F.slice("items", F.lit(1), deep).alias("items"), F.slice("counts", F.lit(1), deep).alias("counts"))
    rows = subsets(rows, "items").where(F.size("taken") > 0)
    chosen = F.transform("taken", lambda i: F.get("items", i))
    return rows.select(chosen.alias("items"), F.get("counts", F.array_max("taken")).alias("support"))


def described(itemsets: DataFrame) -> DataFrame:
    """A line for each set: "1 2 3 #SUP: n"."""
    return itemsets.select(
        F.concat(F.array_join("items", " "), F.lit(" #SUP: "), F.col("support").cast("string")).alias("value")
    )


def statistics(baskets: DataFrame, itemsets: DataFrame) -> DataFrame:
    """One row: baskets, itemsets, the largest set's size, and the greatest support; 0 where there is none."""
    n = baskets.agg(F.count("*").alias("n_baskets"))
    found = itemsets.agg(
        F.count("*").alias("n_itemsets"),
        F.coalesce(F.max(F.size("items")), F.lit(0)).cast("long").alias("largest_size"),
        F.coalesce(F.max("support"), F.lit(0)).alias("greatest_support"),
    )
    return n.crossJoin(found)  # one row each
