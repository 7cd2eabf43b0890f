"""Key-value records, text reports and tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import files, remove

RECORD = "row_key string, family string, qualifier string, value binary, ts timestamp"


@dataclass(frozen=True)
class KeyValueTable:
    """Where a key-value table is, and the column that supports go to."""

    path: str
    family: str = "f"
    qualifier: str = "support"


def key_values(itemsets: DataFrame, family: str, qualifier: str) -> DataFrame:
    """(row_key, family, qualifier, value, ts): key "[1, 2, 3]" of the ascending items, value 8 big-endian bytes."""
    key = F.concat(F.lit("["), F.array_join(F.array_sort("items"), ", "), F.lit("]"))
    value = F.unhex(F.lpad(F.hex("support"), 16, "0"))
    return itemsets.select(
        key.alias("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        value.alias("value"),
        F.current_timestamp().alias("ts"),
    )


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The table's whole versions, oldest first."""
    found = [int(n[1:]) for n in files(spark, path) if n[0] == "v" and n[1:].isdigit()]
    return sorted(n for n in found if "_SUCCESS" in files(spark, f"{path}/v{n}"))


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a keyed table; no rows if there is none."""
    known = _versions(spark, path)
    if not known:
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(f"{path}/v{known[-1]}")


def write_key_values(records: DataFrame, path: str) -> None:
    """Merge records into a keyed Parquet table by (row_key, family, qualifier): the latest by ``ts`` stays, and of equal times
    what is written now, the greatest value of it.

    A whole new version is written beside the old one, which goes after that: a failed write leaves the table as it was.
    """
    spark = records.sparkSession
    known = _versions(spark, path)
    held = read_key_values(spark, path).withColumn("own", F.lit(0))
    both = held.unionByName(records.select(*held.columns[:-1]).withColumn("own", F.lit(1)))
    last = F.max(F.struct("ts", "own", "value")).alias("last")
    merged = both.groupBy("row_key", "family", "qualifier").agg(last)
    merged = merged.select("row_key", "family", "qualifier", "last.value", "last.ts")
    merged.write.mode("overwrite").parquet(f"{path}/v{known[-1] + 1 if known else 0}")
    for n in known:
        remove(spark, f"{path}/v{n}")


def save_supports(itemsets: DataFrame, table: KeyValueTable) -> None:
    """Supports of itemsets merged into a key-value table."""
    write_key_values(key_values(itemsets, table.family, table.qualifier), table.path)


def read_supports(spark: SparkSession, path: str) -> DataFrame:
    """(items, support) back from the keyed table."""
    inner = F.expr("substring(row_key, 2, length(row_key) - 2)")
    items = F.transform(F.split(inner, ", "), lambda x: x.cast("int"))
    support = F.conv(F.hex("value"), 16, 10).cast("long")
    return read_key_values(spark, path).select(items.alias("items"), support.alias("support"))


def write_text(report: DataFrame, path: str, column: str = "value") -> None:
    """Sharded text."""
    report.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_rules(rules: DataFrame, path: str, kind: str = "parquet") -> None:
    """Any of Spark's file formats that hold arrays."""
    rules.write.mode("overwrite").format(kind).save(path)


def append_rules(held: DataFrame | None, more: DataFrame) -> DataFrame:
    """An in-memory rule sink: rows in order of writing, by a column ``batch``."""
    batch = 0 if held is None else held.agg(F.max("batch")).first()[0] + 1
    more = more.withColumn("batch", F.lit(batch))
    return more if held is None else held.unionByName(more)
