"""Rules as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def formatted(rules: DataFrame, names: DataFrame) -> DataFrame:
    """``rules`` with ``text``: "A,2 => B,4 (support: 40, confidence: 0.35, lift: 4.13)".

    Items without a name stand as numbers. Names are joined by item, so their number doesn't matter.
    """
    keyed = rules.withColumn("_k", F.struct("antecedent", "consequent"))
    sides = keyed.select("_k").distinct()
    side = lambda number, name: F.struct(F.lit(number).alias("side"), F.col(f"_k.{name}").alias("s"))
    both = sides.select("_k", F.explode(F.array(side(0, "antecedent"), side(1, "consequent"))).alias("e"))
    parts = both.select("_k", "e.side", F.posexplode("e.s").alias("pos", "item"))
    named = parts.join(names, "item", "left").withColumn("name", F.coalesce("name", F.col("item").cast("string")))

    def text(number: int) -> Column:
        placed = F.collect_list(F.when(F.col("side") == number, F.struct("pos", "name")))
        return F.array_join(F.transform(F.array_sort(placed), lambda x: x["name"]), ",")

    sides = named.groupBy("_k").agg(text(0).alias("_a"), text(1).alias("_c"))
    shape = "%s => %s (support: %d, confidence: %.2f, lift: %.2f)"
    line = F.format_string(shape, "_a", "_c", "transaction_count", "confidence", "lift")
    return keyed.join(sides, "_k").withColumn("text", line).drop("_k", "_a", "_c")


def blocks(items: DataFrame, rules: DataFrame) -> DataFrame:
    """(item, value): "Item <id>\\n" and a line for each rule of the item, by falling lift; items without rules too.

    rules: (item, antecedent, consequent, lift, text).
    """
    whole: Column = F.array_sort(F.concat("antecedent", "consequent"))
    key = F.struct(
        (-F.col("lift")).alias("l"),
        F.size(whole).alias("n"),
        whole.alias("w"),
        F.size("consequent").alias("m"),
        F.col("consequent").alias("c"),
        "text",
    )
    ended = F.transform(F.array_sort(F.collect_list(key)), lambda x: F.concat(x["text"], F.lit("\n")))
    lines = rules.groupBy("item").agg(F.array_join(ended, "").alias("lines"))
    head = F.concat(F.lit("Item "), F.col("item").cast("string"), F.lit("\n"))
    value = F.concat(head, F.coalesce("lines", F.lit(""))).alias("value")
    return items.select("item").distinct().join(lines, "item", "left").select("item", value)
