"""The whole job: purchase lines in; a key-value table of supports and a report of rules per item out."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import report
from ..operators import baskets, mining, patterns, rules
from ..sources import lines as L
from ..sources import sinks
from ..sources.storage import written


@dataclass(frozen=True)
class Options:
    """What is mined and reported. groups: shards of the mining; permissive: malformed lines are left out, else they raise."""

    min_support: float = 0.1
    min_confidence: float = 0.05
    min_lift: float = 0.0
    top_k: int = 50
    groups: int = 1
    permissive: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.min_support <= 1 or not 0 <= self.min_confidence <= 1:
            raise ValueError("support and confidence are shares from 0 to 1")
        if self.min_lift < 0 or self.top_k < 1 or self.groups < 1:
            raise ValueError("lift is 0 or more, top_k and groups are 1 or more")


def rule_report(itemsets: DataFrame, n: int, names: DataFrame, options: Options) -> DataFrame:
    """(item, value): for each item the rules of its own best patterns whose antecedent holds it. itemsets: a table."""
    top = written(patterns.top_k(patterns.per_item(itemsets), options.top_k), "top-patterns")
    source = top.select("items", "support").distinct()
    found = rules.association_rules(itemsets, n, options.min_confidence, options.min_lift, source)
    whole = found.withColumn("items", rules.whole())
    mine = whole.join(top.select("item", "items"), "items").where("array_contains(antecedent, item)")
    columns = ["item", "antecedent", "consequent", "transaction_count", "confidence", "lift"]
    return report.blocks(top, report.formatted(mine.select(*columns), names))


def run(spark: SparkSession, lines: str, table: sinks.KeyValueTable | None, report_path: str | None, options: Options) -> DataFrame:
    """Read lines, mine, merge supports into ``table``, write the report; return the report. No lines: no items."""
    rows = L.read_lines(spark, lines)
    pairs = written(L.parse_pairs(rows, options.permissive).distinct(), "pairs")
    names = L.names_of(L.parse_names(rows, options.permissive))
    whole = baskets.assemble(pairs)
    found = mining.frequent_itemsets(whole, options.min_support, num_groups=options.groups)
    if table is not None:
        sinks.save_supports(found, table)
    out = rule_report(found, baskets.transactions(pairs).first()["n"], names, options)
    if report_path is not None:
        sinks.write_text(out.orderBy("item"), report_path)
    return out


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tallyloom", description=__doc__)
    out.add_argument("--input", required=True, help="files of lines: transaction,name(item)")
    out.add_argument("--kv", help="folder of the key-value table; merged by key")
    out.add_argument("--family", default="f", help="the table's column family")
    out.add_argument("--qualifier", default="support", help="the table's column")
    out.add_argument("--report", help="folder of the report; replaced")
    known = Options()
    for name, kind in (("min_support", float), ("min_confidence", float), ("min_lift", float), ("top_k", int), ("groups", int)):
        out.add_argument(f"--{name.replace('_', '-')}", type=kind, default=getattr(known, name))
    out.add_argument("--permissive", action="store_true", help="leave out malformed lines")
    return out


def main(arguments: list[str] | None = None) -> None:
    """Run the job from a command line; the session's master and other settings are spark-submit's."""
    own = parser().parse_args(arguments)
    names = ("min_support", "min_confidence", "min_lift", "top_k", "groups", "permissive")
    options = Options(**{n: getattr(own, n) for n in names})
    spark = SparkSession.builder.appName("tallyloom").getOrCreate()
    table = sinks.KeyValueTable(own.kv, own.family, own.qualifier) if own.kv else None
    out = run(spark, own.input, table, own.report, options)
    if own.report is None:
        for row in out.orderBy("item").toLocalIterator():
            print(row["value"], end="")
