"""Purchase lines and tables as (txn, item, name) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of all files that match, in a column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def _item(line: Column, permissive: bool) -> Column:
    """The number between the last "(" and the next ")"."""
    digits = F.regexp_replace(F.regexp_replace(line, r".*\(", ""), r"\).*", "")
    return digits.try_cast("int") if permissive else digits.cast("int")


def parse_pairs(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """(txn_id, item): the text before the first comma and the number in the last brackets.

    A malformed number raises; with ``permissive`` it is null and the row is left out.
    """
    out = lines.select(F.split("line", ",")[0].alias("txn_id"), _item(F.col("line"), permissive).alias("item"))
    return out.where("item IS NOT NULL") if permissive else out


def parse_swapped(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """(item, txn_id)."""
    return parse_pairs(lines, permissive).select("item", "txn_id")


def parse_names(lines: DataFrame, permissive: bool = False) -> DataFrame:
    """(item, name): without the first match of digits and comma, and without what follows the first "("."""
    name = F.regexp_replace(F.regexp_replace("line", r"^(.*?)\d*,", "$1"), r"\(.*", "")
    out = lines.select(_item(F.col("line"), permissive).alias("item"), name.alias("name"))
    return out.where("item IS NOT NULL") if permissive else out


def names_of(pairs: DataFrame, strict: bool = False) -> DataFrame:
    """One name for each item: the least; with ``strict`` an item with two names raises."""
    out = pairs.dropDuplicates(["item", "name"]).groupBy("item").agg(F.min("name").alias("name"), F.count("*").alias("_n"))
    if strict:
        out = out.withColumn("name", F.when(F.col("_n") == 1, F.col("name")).otherwise(F.raise_error(F.concat(F.lit("several names for item "), F.col("item").cast("string")))))
    return out.select("item", "name")


def from_table(df: DataFrame, txn: str, item: str, name: str | None = None) -> DataFrame:
    """(txn_id, item[, name]) from any table."""
    return df.select(F.col(txn).alias("txn_id"), F.col(item).alias("item"), *([F.col(name).alias("name")] if name else []))
