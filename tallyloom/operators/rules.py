"""Association rules with consequents of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import written
from .mining import CHUNK, subsets


def supports(wanted: DataFrame, itemsets: DataFrame) -> DataFrame:
    """``wanted`` (items, ...) with the support of its items, by an equi-join; unknown sets get null."""
    return wanted.join(itemsets.select("items", "support"), "items", "left")


def candidates(itemsets: DataFrame) -> DataFrame:
    """Sets one longer: pairs that share all items but the last, joined on that prefix."""
    head = F.expr("slice(items, 1, size(items) - 1)").alias("head")
    rows = itemsets.select(head, F.element_at("items", -1).alias("last"))
    other = rows.select("head", F.col("last").alias("next"))
    longer = F.concat("head", F.array("last", "next")).alias("items")
    return rows.join(other, "head").where("last < next").select(longer)


def splits(itemsets: DataFrame) -> DataFrame:
    """(items, support, antecedent, consequent): all ways to part each set of 2 items or more."""
    rows = subsets(itemsets.where(F.size("items") >= 2).select("items", "support"), "items")
    rows = rows.where((F.size("taken") > 0) & (F.size("taken") < F.size("items")))
    consequent = F.transform("taken", lambda i: F.get("items", i))
    out = rows.select("items", "support", consequent.alias("consequent"))
    return out.select("items", "support", F.array_except("items", "consequent").alias("antecedent"), "consequent")


def measured(parts: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``parts`` (items, support, antecedent, consequent) as rules; supports are looked up in ``known`` by equi-joins."""
    of = lambda name, alias: known.select(F.col("items").alias(name), F.col("support").alias(alias))
    out = parts.join(of("antecedent", "coverage"), "antecedent").join(of("consequent", "own"), "consequent")
    total, both = F.lit(float(n)), F.col("support")
    lift = (both / total) / ((F.col("coverage") / total) * (F.col("own") / total))
    return out.select(
        "items",
        "antecedent",
        "consequent",
        "coverage",
        both.alias("transaction_count"),
        (both / F.col("coverage")).alias("confidence"),
        lift.alias("lift"),
        (both / total).alias("relative_support"),
    )


def association_rules(
    itemsets: DataFrame,
    n: int,
    min_confidence: float = 0.05,
    min_lift: float = 0.0,
    source: DataFrame | None = None,
    lift_pruning: bool = False,
) -> DataFrame:
    """(antecedent, consequent, coverage, transaction_count, confidence, lift, relative_support).

    source: sets to part (default: all itemsets), of any size; supports come from ``itemsets``. lift_pruning: a longer
    consequent counts only if the two that it is joined from (without its last, and without its last but one) did.

    Sets of up to ``CHUNK`` items are parted in one step. Consequents of larger ones, and of all with lift_pruning, grow by one item
    a level from those that are confident enough: what grows from others never is, so both ways give the same rules.
    """
    known = itemsets.select("items", "support")
    sets = (source if source is not None else itemsets).where(F.size("items") >= 2).select("items", "support")
    enough = (F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)
    if lift_pruning:
        return _grown(sets, known, n, enough).drop("items")
    small, large = sets.where(F.size("items") <= CHUNK), sets.where(F.size("items") > CHUNK)
    out = measured(splits(small), known, n).where(enough)
    if large.head(1):
        out = out.unionByName(_grown(large, known, n, F.col("confidence") >= min_confidence).where(enough))
    return out.drop("items")


def _grown(sets: DataFrame, known: DataFrame, n: int, alive: Column) -> DataFrame:
    """Rules that are ``alive`` and whose consequents grew from two that are. A level is a table."""
    parts = sets.select("items", "support", F.explode("items").alias("y"))
    parts = parts.select("items", "support", F.array_remove("items", F.col("y")).alias("antecedent"), F.array("y").alias("consequent"))
    found = None
    while True:
        level = written(measured(parts, known, n).where(alive), "rules")
        if not level.head(1):
            return found if found is not None else level
        found = level if found is None else found.unionByName(level)
        head = F.expr("slice(consequent, 1, size(consequent) - 1)").alias("head")
        rows = level.where(F.size("antecedent") > 1)
        rows = rows.select("items", F.col("transaction_count").alias("support"), head, F.element_at("consequent", -1).alias("last"))
        other = rows.select("items", "head", F.col("last").alias("next"))
        longer = rows.join(other, ["items", "head"]).where("last < next")
        longer = longer.select("items", "support", F.concat("head", F.array("last", "next")).alias("consequent"))
        antecedent = F.array_except("items", "consequent").alias("antecedent")
        parts = longer.select("items", "support", antecedent, "consequent")


def about_item(rules: DataFrame, item: int) -> DataFrame:
    """Rules whose antecedent holds the item."""
    return rules.where(F.array_contains("antecedent", item))


def whole() -> Column:
    """All items of a rule, in order."""
    return F.array_sort(F.concat("antecedent", "consequent"))


def order_keys() -> list[Column]:
    """Falling lift, then the order of generation: smaller sets first, then by items, consequents alike."""
    return [F.desc("lift"), F.size(whole()), whole(), F.size("consequent"), F.col("consequent")]


def ranked(rules: DataFrame) -> DataFrame:
    """``rules`` with ``rank``, from 1, in the order of ``order_keys``.

    Ranges of the order are sorted and numbered each for itself; what meets in one task is a row for each range.
    """
    rows = rules.repartitionByRange(*order_keys()).sortWithinPartitions(*order_keys())
    # the range's number, and 33 bits of the row's place in it
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("range", F.shiftright("at", 33))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("range").agg(F.count("*").alias("n"))
    starts = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    out = rows.join(F.broadcast(starts), "range")  # as many rows as a shuffle has tasks
    return out.withColumn("rank", F.col("start") + place + 1).drop("range", "at", "start")


def collected(rules: DataFrame, name: str) -> DataFrame:
    """One row: a name and its rules, in the order of ``order_keys``. A value for the driver, as long as the rules are."""
    keys = [-F.col("lift"), F.size(whole()), whole(), F.size("consequent"), F.col("consequent")]
    row = F.struct(*(k.alias(f"key {i}") for i, k in enumerate(keys)), *rules.columns)
    inner = lambda x: F.struct(*(x[c].alias(c) for c in rules.columns))
    listed = rules.agg(F.array_sort(F.collect_list(row)).alias("r"))
    return listed.select(F.lit(name).alias("name"), F.transform("r", inner).alias("rules"))
