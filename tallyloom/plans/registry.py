"""The registry of queries, one or more for each operator, and the DuckDB SQL of each.

Transactions are orders; items are part types (6, numbered by name) or brands (25). Arrays are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import report
from ..operators import baskets as B
from ..operators import itemsets as I
from ..operators import mining as M
from ..operators import patterns as P
from ..operators import rules as R
from ..operators import tries as T
from ..sources import lines as L
from ..sources import sinks as S
from ..sources.storage import folder as _folder
from ..sources.storage import written
from . import job

SUPPORT, CONFIDENCE, TOP_K, GROUPS = 0.02, 0.05, 5, 3


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _numbered(spark: SparkSession, sf: str, column: str) -> DataFrame:
    """(v, item): the column's few values, numbered by name."""
    return _table(spark, sf, "part").select(F.col(column).alias("v")).distinct().withColumn("item", F.row_number().over(Window.orderBy("v")))


def pairs(spark: SparkSession, sf: str, column: str = "p_type") -> DataFrame:
    """(txn_id, item) of every line; transactions are numbers, as in the table."""
    part = _table(spark, sf, "part").select("p_partkey", F.col(column).alias("v")).join(_numbered(spark, sf, column), "v")
    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("txn_id"), "item")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part").select("p_partkey", "p_name")
    rows = _table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    number = lambda c: F.col(c).cast("string")
    line = F.concat(number("l_orderkey"), F.lit(","), "p_name", F.lit("("), number("p_partkey"), F.lit(")"))
    return rows.select(line.alias("line"))


def _type_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose items are part types."""
    rows = pairs(spark, sf).join(F.broadcast(_numbered(spark, sf, "p_type")), "item")  # six rows
    return rows.select(F.format_string("%d,%s(%d)", "txn_id", "v", "item").alias("line"))


def _txn() -> F.col:
    return F.col("txn_id").cast("string").alias("txn_id")


def _text(*columns: str) -> list:
    return [F.array_join(c, ",").alias(c) for c in columns]


def q01_scan_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "lines")
    S.write_text(_lines(spark, sf), path, "line")
    return L.read_lines(spark, path).agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def q02_parse_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_pairs(_lines(spark, sf))


def q02b_parse_swapped(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_swapped(_lines(spark, sf)).groupBy("item").agg(F.count("*").alias("n"), F.max("txn_id").alias("last_txn"))


def q03_names(spark: SparkSession, sf: str) -> DataFrame:
    return L.names_of(L.parse_names(_lines(spark, sf)))


def q04_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return B.assemble(pairs(spark, sf), distinct=False).select(_txn(), *_text("items"))


def q04b_distinct_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return B.assemble(pairs(spark, sf)).select(_txn(), *_text("items"))


def q05_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return B.transactions(pairs(spark, sf))


def q05b_item_counts(spark: SparkSession, sf: str) -> DataFrame:
    return B.item_counts(L.from_table(_table(spark, sf, "lineitem"), "l_orderkey", "l_partkey"))


def q06_frequent_items(spark: SparkSession, sf: str) -> DataFrame:
    return B.frequent_items(pairs(spark, sf, "p_brand"), 0.1).orderBy(F.desc("support"), "item")


def _ordered(spark: SparkSession, sf: str, support: float = 0.0) -> DataFrame:
    return B.ordered_baskets(pairs(spark, sf), support)


def q07_ordered_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(spark, sf, 0.4).select(_txn(), *_text("items"))


def q08_group_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return B.group_prefixes(_ordered(spark, sf), GROUPS).select(_txn(), "group_id", *_text("items"), "weight")


def q08b_mined_by_group(spark: SparkSession, sf: str) -> DataFrame:
    baskets = written(_ordered(spark, sf), "ordered-baskets")
    least = M.least_count(baskets.count(), SUPPORT)
    found = M.mined_by_group(B.group_prefixes(baskets, GROUPS), least, GROUPS)
    return found.select("group_id", *_text("items"), "support")


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    return T.weighted_baskets(_ordered(spark, sf))


def q09_prefix_table(spark: SparkSession, sf: str) -> DataFrame:
    return T.prefix_table(_weighted(spark, sf)).select(*_text("path"), F.col("depth").cast("long").alias("depth"), "count")


def q09b_residuals(spark: SparkSession, sf: str) -> DataFrame:
    return T.residuals(T.prefix_table(_weighted(spark, sf))).select(*_text("items"), "weight")


def q09c_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = T.nodes(T.prefix_table(_weighted(spark, sf)))
    second, n = F.get("children", F.lit(1)).alias("second_child"), F.size("children").cast("long").alias("n_children")
    has = F.array_contains("children", 3).alias("has_child_3")
    return nodes.select(*_text("path"), "item", "count", n, second, has)


def q10_compressed(spark: SparkSession, sf: str) -> DataFrame:
    weighted = written(_weighted(spark, sf), "weighted")
    return T.compressed(T.merge(weighted, weighted)).select(*_text("items"), "weight")


def q11_f_list(spark: SparkSession, sf: str) -> DataFrame:
    return T.f_list(_weighted(spark, sf))


def itemsets(spark: SparkSession, sf: str, support: float = SUPPORT, column: str = "p_type", strategy: str = "fpgrowth") -> DataFrame:
    return M.frequent_itemsets(B.assemble(pairs(spark, sf, column)), support, strategy)


def q12_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets(spark, sf).select(*_text("items"), "support")


def q12b_weighted_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets(spark, sf, strategy="weighted").select(*_text("items"), "support")


def q12c_brand_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets(spark, sf, 0.01, "p_brand").select(*_text("items"), "support")


def q12d_described(spark: SparkSession, sf: str) -> DataFrame:
    return M.described(itemsets(spark, sf))


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """(txn_id, items): baskets of the first four part types, each four times under numbers of its own: up to 16 items."""
    copies = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.col("item") + 10 * k)
    few = pairs(spark, sf).where("item <= 4").distinct()
    return B.assemble(few.select("txn_id", F.explode(copies).alias("item")))


def q12e_wide_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return M.frequent_itemsets(_wide(spark, sf), SUPPORT, "weighted").select(*_text("items"), "support")


def q12f_statistics(spark: SparkSession, sf: str) -> DataFrame:
    baskets = B.assemble(pairs(spark, sf))
    return M.statistics(baskets, M.frequent_itemsets(baskets, SUPPORT))


def q13_conditional_base(spark: SparkSession, sf: str) -> DataFrame:
    return T.conditional_base(_weighted(spark, sf), 1).select(*_text("items"), "weight")


def q13b_conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    return T.f_list(T.conditional_base(_weighted(spark, sf), 1))


def _path(spark: SparkSession, sf: str, column: str = "p_type") -> DataFrame:
    ranked = B.item_counts(pairs(spark, sf, column)).select("item", "support")
    entry = F.struct((-F.col("support")).alias("s"), "item")
    path = ranked.agg(F.array_sort(F.collect_list(entry)).alias("p"))
    return path.select(F.transform("p", lambda x: x["item"]).alias("items"), F.transform("p", lambda x: -x["s"]).alias("counts"))


def q14_path_combinations(spark: SparkSession, sf: str) -> DataFrame:
    return M.path_combinations(_path(spark, sf)).select(*_text("items"), "support")


def q14b_long_path(spark: SparkSession, sf: str) -> DataFrame:
    """A path of 40 items, of which twelve are frequent enough."""
    ids = F.sequence(F.lit(1), F.lit(40))
    path = _path(spark, sf).select(ids.alias("items"), F.transform(ids, lambda i: 52 - i).cast("array<long>").alias("counts"))
    return M.path_combinations(path, 40).select(*_text("items"), "support")


def q15_key_values(spark: SparkSession, sf: str) -> DataFrame:
    return S.key_values(itemsets(spark, sf), "f", "q").select("row_key", "family", "qualifier", F.hex("value").alias("value"))


def q15b_key_value_table(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "kv")
    S.save_supports(itemsets(spark, sf), S.KeyValueTable(path))
    return S.read_supports(spark, path).select(*_text("items"), "support")


def q15c_second_write(spark: SparkSession, sf: str) -> DataFrame:
    """Sets of at most two items are written first, with other supports; then those of two items or more."""
    table, found = S.KeyValueTable(_folder(spark, "kv")), itemsets(spark, sf)
    few = found.where(F.size("items") <= 2).select("items", (F.col("support") + 1000).alias("support"))
    S.save_supports(few, table)
    S.save_supports(found.where(F.size("items") >= 2), table)
    return S.read_supports(spark, table.path).select(*_text("items"), "support")


def q16_patterns_per_item(spark: SparkSession, sf: str) -> DataFrame:
    return P.per_item(itemsets(spark, sf)).select("item", *_text("items"), "support")


def _top(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_k(P.per_item(itemsets(spark, sf)), TOP_K)


def q17_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return _top(spark, sf).select("item", "rank", *_text("items"), "support")


def q17b_merge_top_k(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.per_item(itemsets(spark, sf))
    a, b = P.top_k(rows.where(F.size("items") % 2 == 0), TOP_K), P.top_k(rows.where(F.size("items") % 2 == 1), TOP_K)
    return P.merge_top_k(a, b, TOP_K).select("item", "rank", *_text("items"), "support")


def q17c_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return P.flatten(P.collected(_top(spark, sf))).select("item", *_text("items"), "support")


def q18_supports(spark: SparkSession, sf: str) -> DataFrame:
    known = itemsets(spark, sf)
    wanted = R.splits(known).select(F.col("antecedent").alias("items")).distinct()
    return R.supports(wanted, known).select(*_text("items"), "support")


def q18b_itemset_algebra(spark: SparkSession, sf: str) -> DataFrame:
    found = itemsets(spark, sf)
    backwards = F.reverse("items")
    return found.select(
        *_text("items"),
        I.size("items").cast("long").alias("n_items"),
        F.array_join(I.without_item("items", F.get("items", F.lit(0))), ",").alias("without_first"),
        F.array_join(I.without_set("items", F.slice("items", F.lit(2), F.size("items"))), ",").alias("first"),
        I.compared("items", backwards).alias("compared"),
    )


def q18c_levels(spark: SparkSession, sf: str) -> DataFrame:
    found = I.levels(itemsets(spark, sf)).groupBy(F.col("level").cast("long").alias("level"))
    return found.agg(F.count("*").alias("n"), F.min("support").alias("least"), F.max("support").alias("most"))


def q19_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return R.candidates(itemsets(spark, sf)).select(*_text("items"))


def rules(spark: SparkSession, sf: str, **options) -> DataFrame:
    n = pairs(spark, sf).select("txn_id").distinct().count()
    return R.association_rules(itemsets(spark, sf), n, CONFIDENCE, **options)


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*_text("antecedent", "consequent"), *(c for c in df.columns if c not in ("antecedent", "consequent")))


def q20_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(rules(spark, sf))


def q20b_lift_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(rules(spark, sf, min_lift=1.0))


def q20c_lift_pruning(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(rules(spark, sf, min_lift=0.9, lift_pruning=True))


def q20d_rules_of_wide_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of a set of 16 items, counted by the sizes of their sides."""
    baskets = _wide(spark, sf)
    known = M.frequent_itemsets(baskets, SUPPORT, "weighted")
    found = R.association_rules(known, baskets.count(), 0.99, source=known.where(F.size("items") == 16))
    sides = [F.size(c).cast("long").alias(f"n_{c}") for c in ("antecedent", "consequent")]
    return found.groupBy(*sides).agg(F.count("*").alias("n"), F.max("coverage").alias("most"), F.min("confidence").alias("least"))


def q21_rules_about_item(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(R.about_item(rules(spark, sf), 2))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    # one item is left unnamed, so that its number shows
    return _numbered(spark, sf, "p_type").where("item <> 4").select("item", F.col("v").alias("name"))


def q22_formatted_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = report.formatted(rules(spark, sf), _names(spark, sf))
    return R.ranked(found).select(F.col("rank").cast("int").alias("rank"), "text")


def q22b_rules_collection(spark: SparkSession, sf: str) -> DataFrame:
    held = R.collected(rules(spark, sf), "types").select("name", F.posexplode("rules").alias("at", "r"))
    return _shown(held.select("name", F.col("at").cast("long").alias("place"), "r.antecedent", "r.consequent", "r.lift"))


def q23_report(spark: SparkSession, sf: str) -> DataFrame:
    n = pairs(spark, sf).select("txn_id").distinct().count()
    options = job.Options(SUPPORT, CONFIDENCE, top_k=TOP_K)
    return job.rule_report(itemsets(spark, sf), n, _names(spark, sf), options)


def q24_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "rules")
    S.write_rules(rules(spark, sf), path, "json")
    return _shown(spark.read.schema("antecedent array<int>, consequent array<int>, coverage long, transaction_count long, confidence double, lift double, relative_support double").json(path))


def q25_job(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in, the report's text out, with the supports of the key-value table that the job has written."""
    lines, kv, text = (_folder(spark, name) for name in ("lines", "kv", "report"))
    S.write_text(_type_lines(spark, sf), lines, "line")
    job.run(spark, lines, S.KeyValueTable(kv), text, job.Options(SUPPORT, CONFIDENCE, top_k=TOP_K, groups=GROUPS))
    supports = S.read_supports(spark, kv).select(F.format_string("%s: %d", F.array_join("items", ","), "support").alias("line"))
    report_lines = spark.read.text(text).select(F.col("value").alias("line")).where("line <> ''")
    return report_lines.unionByName(supports).groupBy("line").agg(F.count("*").alias("n"))


def _all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "q" and name[1:3].isdigit()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(sorted(_all().items()))


def _sql(column: str = "p_type", support: float = SUPPORT, size: int = 6) -> str:
    """Common tables: pairs, b (baskets), n, cnt, o (ordered baskets), w (weighted), fi (frequent itemsets), sp (splits), ru (rules)."""
    return f"""WITH RECURSIVE ids AS (SELECT v, CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS item FROM (SELECT DISTINCT {column} AS v FROM part)),
pairs AS (SELECT CAST(l_orderkey AS VARCHAR) AS txn_id, item FROM lineitem JOIN part ON l_partkey = p_partkey JOIN ids ON v = {column}),
b AS (SELECT txn_id, list_sort(list(DISTINCT item)) AS items FROM pairs GROUP BY 1),
n AS (SELECT count(*) AS n FROM b),
cnt AS (SELECT item, count(DISTINCT txn_id) AS support FROM pairs GROUP BY 1),
o AS (SELECT txn_id, list(item ORDER BY support DESC, item) AS items FROM (SELECT DISTINCT txn_id, item FROM pairs) JOIN cnt USING (item) GROUP BY 1),
w AS (SELECT items, count(*) AS weight FROM o GROUP BY 1),
su(basket, s, c) AS (SELECT items, []::INTEGER[], count(*) FROM b GROUP BY 1 UNION ALL SELECT basket, list_append(s, x), c FROM (SELECT basket, s, c, unnest(basket) AS x FROM su WHERE len(s) < {size}) WHERE len(s) = 0 OR x > s[len(s)]),
fi AS (SELECT s AS items, CAST(sum(c) AS BIGINT) AS support FROM su WHERE len(s) > 0 GROUP BY 1 HAVING sum(c) >= ceil((SELECT n FROM n) * {support}::DOUBLE)),
sp AS (SELECT f.items, f.support, a.items AS antecedent, list_sort(list_filter(f.items, lambda x: NOT list_contains(a.items, x))) AS consequent, a.support AS coverage FROM fi f JOIN fi a ON len(a.items) < len(f.items) AND list_has_all(f.items, a.items)),
ru AS (SELECT sp.items, antecedent, consequent, coverage, sp.support AS transaction_count, CAST(sp.support AS DOUBLE) / coverage AS confidence, (CAST(sp.support AS DOUBLE) / n) / ((CAST(coverage AS DOUBLE) / n) * (CAST(c.support AS DOUBLE) / n)) AS lift, CAST(sp.support AS DOUBLE) / n AS relative_support FROM sp JOIN fi c ON c.items = sp.consequent, n WHERE CAST(sp.support AS DOUBLE) / coverage >= {CONFIDENCE}::DOUBLE),
tk AS (SELECT * FROM (SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY support DESC, len(items) DESC, items DESC) AS INTEGER) AS rank, items, support FROM (SELECT unnest(items) AS item, items, support FROM fi)) WHERE rank <= {TOP_K}),
nm AS (SELECT item, CASE WHEN item = 4 THEN CAST(item AS VARCHAR) ELSE v END AS name FROM ids),
nl AS (SELECT list(name ORDER BY item) AS names FROM nm),
ft AS (SELECT ru.*, array_to_string(list_transform(antecedent, lambda x: names[x]), ',') || ' => ' || array_to_string(list_transform(consequent, lambda x: names[x]), ',') || ' (support: ' || transaction_count || ', confidence: ' || CAST(CAST(round(CAST(confidence AS DECIMAL(18, 9)), 2) AS DECIMAL(18, 2)) AS VARCHAR) || ', lift: ' || CAST(CAST(round(CAST(lift AS DECIMAL(18, 9)), 2) AS DECIMAL(18, 2)) AS VARCHAR) || ')' AS text FROM ru, nl)
"""


def _j(c: str, name: str = "") -> str:
    return f"array_to_string({c}, ',') AS {name or c}"


_LINES = "WITH l AS (SELECT l_orderkey || ',' || p_name || '(' || p_partkey || ')' AS line, CAST(l_orderkey AS VARCHAR) AS txn_id, CAST(p_partkey AS INTEGER) AS item, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) "
_RULE = f"{_j('antecedent')}, {_j('consequent')}, coverage, transaction_count, confidence, lift, relative_support"
_PREFIX = "p AS (SELECT items[1:d] AS path, CAST(sum(weight) AS BIGINT) AS count FROM (SELECT items, weight, unnest(range(1, len(items) + 1)) AS d FROM w) GROUP BY 1)"
_BASE = "cb AS (SELECT items[1:list_position(items, 1) - 1] AS items, CAST(sum(weight) AS BIGINT) AS weight FROM w WHERE list_position(items, 1) > 1 GROUP BY 1)"


#: w16: subsets of the copies of four items, as four masks; wf: their items and the support of the items they copy.
_WIDE = """, w16 AS (SELECT [a.m, b.m, c.m, d.m] AS ms FROM range(16) a(m), range(16) b(m), range(16) c(m), range(16) d(m)),
wf AS (SELECT list_filter(list_transform(range(0, 16), lambda i: CASE WHEN (ms[i % 4 + 1]::INT >> (i // 4)::INT) & 1 = 1
  THEN i % 4 + 1 + 10 * (i // 4) END), lambda x: x IS NOT NULL) AS items, fi.support FROM w16 JOIN fi ON fi.items =
  list_filter([CASE WHEN ms[1] > 0 THEN 1 END, CASE WHEN ms[2] > 0 THEN 2 END, CASE WHEN ms[3] > 0 THEN 3 END,
  CASE WHEN ms[4] > 0 THEN 4 END], lambda x: x IS NOT NULL)) """
_WIDE_RULES = """SELECT len(items) AS n_antecedent, 16 - len(items) AS n_consequent, count(*) AS n, max(support) AS most,
  min(CAST(s AS DOUBLE) / support) AS least FROM wf, (SELECT support AS s FROM wf WHERE len(items) = 16)
  WHERE len(items) < 16 AND CAST(s AS DOUBLE) / support >= 0.99 GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    s = _sql()
    fi = f"{s} SELECT {_j('items')}, support FROM fi"
    top = f"{s} SELECT item, rank, {_j('items')}, support FROM tk"
    return {
        "q01_scan_lines": _LINES + "SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM l",
        "q02_parse_pairs": _LINES + "SELECT txn_id, item FROM l",
        "q02b_parse_swapped": _LINES + "SELECT item, count(*) AS n, max(txn_id) AS last_txn FROM l GROUP BY 1",
        "q03_names": _LINES + "SELECT item, min(p_name) AS name FROM l GROUP BY 1",
        "q04_baskets": s + "SELECT txn_id, array_to_string(list_sort(list(item)), ',') AS items FROM pairs GROUP BY 1",
        "q04b_distinct_baskets": s + f"SELECT txn_id, {_j('items')} FROM b",
        "q05_transactions": s + "SELECT n FROM n",
        "q05b_item_counts": "SELECT l_partkey AS item, count(*) AS line_count, count(DISTINCT l_orderkey) AS support FROM lineitem GROUP BY 1",
        "q06_frequent_items": _sql("p_brand", size=1) + "SELECT item, support FROM cnt, n WHERE support >= ceil(n * 0.1::DOUBLE)",
        "q07_ordered_baskets": s + "SELECT txn_id, coalesce(string_agg(CAST(item AS VARCHAR), ',' ORDER BY support DESC, item) FILTER (support >= ceil((SELECT n FROM n) * 0.4::DOUBLE)), '') AS items FROM (SELECT DISTINCT txn_id, item FROM pairs) JOIN cnt USING (item) GROUP BY 1",
        "q08_group_prefixes": s + f", g AS (SELECT txn_id, items, unnest(range(1, len(items) + 1)) AS i FROM o), h AS (SELECT txn_id, items, items[i] % {GROUPS} AS group_id, max(i) AS p FROM g GROUP BY 1, 2, 3) SELECT txn_id, group_id, array_to_string(items[1:p], ',') AS items, CAST(1 AS BIGINT) AS weight FROM h",
        "q09_prefix_table": s + f", {_PREFIX} SELECT {_j('path')}, len(path) AS depth, count FROM p",
        "q08b_mined_by_group": s + f"SELECT list_extract(list(x.item ORDER BY x.support, x.item DESC), 1) % {GROUPS} AS group_id, {_j('fi.items', 'items')}, fi.support FROM fi JOIN cnt x ON list_contains(fi.items, x.item) GROUP BY fi.items, fi.support",
        "q09c_nodes": s + f", {_PREFIX}, ch AS (SELECT path[1:len(path) - 1] AS path, list_sort(list(path[len(path)])) AS children FROM p WHERE len(path) > 1 GROUP BY 1) SELECT {_j('p.path', 'path')}, p.path[len(p.path)] AS item, count, coalesce(len(children), 0) AS n_children, children[2] AS second_child, coalesce(list_contains(children, 3), false) AS has_child_3 FROM p LEFT JOIN ch ON ch.path = p.path",
        "q09b_residuals": s + f"SELECT {_j('items')}, weight FROM w",
        "q10_compressed": s + f"SELECT {_j('items')}, 2 * count(*) AS weight FROM b GROUP BY items",
        "q11_f_list": s + "SELECT item, support AS weight FROM cnt",
        "q12_frequent_itemsets": fi,
        "q12b_weighted_itemsets": fi,
        "q12c_brand_itemsets": _sql("p_brand", 0.01, 3) + f"SELECT {_j('items')}, support FROM fi",
        "q12d_described": s + "SELECT array_to_string(items, ' ') || ' #SUP: ' || support AS value FROM fi",
        "q12e_wide_itemsets": s + _WIDE + f"SELECT {_j('items')}, support FROM wf",
        "q12f_statistics": s + "SELECT (SELECT n FROM n) AS n_baskets, count(*) AS n_itemsets, max(len(items)) AS largest_size, max(support) AS greatest_support FROM fi",
        "q13_conditional_base": s + f", {_BASE} SELECT {_j('items')}, weight FROM cb",
        "q13b_conditional_counts": s + f", {_BASE} SELECT item, CAST(sum(weight) AS BIGINT) AS weight FROM (SELECT unnest(items) AS item, weight FROM cb) GROUP BY 1",
        "q14_path_combinations": s + ", r AS (SELECT item, support, row_number() OVER (ORDER BY support DESC, item) - 1 AS k FROM cnt), m AS (SELECT unnest(range(1, (1 << (SELECT count(*) FROM r)::INT))) AS m) SELECT string_agg(CAST(item AS VARCHAR), ',' ORDER BY k) AS items, min(support) AS support FROM m JOIN r ON (m.m >> r.k::INT) & 1 = 1 GROUP BY m.m",
        "q14b_long_path": "WITH m AS (SELECT unnest(range(1, 4096)) AS m), r AS (SELECT unnest(range(1, 13)) AS item) SELECT string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items, CAST(52 - max(item) AS BIGINT) AS support FROM m JOIN r ON (m.m >> (item - 1)::INT) & 1 = 1 GROUP BY m.m",
        "q15_key_values": s + "SELECT '[' || array_to_string(items, ', ') || ']' AS row_key, 'f' AS family, 'q' AS qualifier, lpad(upper(format('{:x}', support)), 16, '0') AS value FROM fi",
        "q15b_key_value_table": fi,
        "q15c_second_write": s + f"SELECT {_j('items')}, CASE WHEN len(items) = 1 THEN support + 1000 ELSE support END AS support FROM fi",
        "q16_patterns_per_item": s + f"SELECT item, {_j('items')}, support FROM (SELECT unnest(items) AS item, items, support FROM fi)",
        "q17_top_k": top,
        "q17b_merge_top_k": top,
        "q17c_flatten": s + f"SELECT item, {_j('items')}, support FROM tk",
        "q18_supports": s + f"SELECT {_j('items')}, support FROM fi WHERE items IN (SELECT antecedent FROM sp)",
        "q18b_itemset_algebra": s + f"SELECT {_j('items')}, len(items) AS n_items, array_to_string(items[2:], ',') AS without_first, CAST(items[1] AS VARCHAR) AS first, CASE WHEN len(items) = 1 THEN 0 ELSE -1 END AS compared FROM fi",
        "q18c_levels": s + "SELECT len(items) AS level, count(*) AS n, min(support) AS least, max(support) AS most FROM fi GROUP BY 1",
        "q19_candidates": s + "SELECT array_to_string(list_append(a.items, b.items[len(b.items)]), ',') AS items FROM fi a JOIN fi b ON len(a.items) = len(b.items) AND a.items[1:len(a.items) - 1] = b.items[1:len(b.items) - 1] AND a.items[len(a.items)] < b.items[len(b.items)]",
        "q20_association_rules": s + f"SELECT {_RULE} FROM ru",
        "q20b_lift_filter": s + f"SELECT {_RULE} FROM ru WHERE lift >= 1.0",
        "q20c_lift_pruning": s + f", lp(items, consequent) AS (SELECT items, consequent FROM ru WHERE lift >= 0.9::DOUBLE AND len(consequent) = 1 UNION SELECT r.items, r.consequent FROM ru r JOIN lp x ON x.items = r.items AND x.consequent = r.consequent[1:len(r.consequent) - 1] JOIN lp y ON y.items = r.items AND y.consequent = list_append(r.consequent[1:len(r.consequent) - 2], r.consequent[len(r.consequent)]) WHERE r.lift >= 0.9::DOUBLE) SELECT {_RULE} FROM ru JOIN lp USING (items, consequent)",
        "q20d_rules_of_wide_sets": s + _WIDE + _WIDE_RULES,
        "q21_rules_about_item": s + f"SELECT {_RULE} FROM ru WHERE list_contains(antecedent, 2)",
        "q22_formatted_rules": s + "SELECT CAST(row_number() OVER (ORDER BY lift DESC, len(items), items, len(consequent), consequent) AS INTEGER) AS rank, text FROM ft",
        "q23_report": s + ", x AS (SELECT tk.item, string_agg(text || chr(10), '' ORDER BY lift DESC, len(ft.items), ft.items, len(consequent), consequent) AS lines FROM tk JOIN ft ON ft.items = tk.items AND list_contains(antecedent, tk.item) GROUP BY 1) SELECT item, 'Item ' || item || chr(10) || coalesce(lines, '') AS value FROM (SELECT DISTINCT item FROM tk) LEFT JOIN x USING (item)",
        "q22b_rules_collection": s + f"SELECT 'types' AS name, row_number() OVER (ORDER BY lift DESC, len(items), items, len(consequent), consequent) - 1 AS place, {_j('antecedent')}, {_j('consequent')}, lift FROM ru",
        "q25_job": s.replace("CASE WHEN item = 4 THEN CAST(item AS VARCHAR) ELSE v END", "v") + f", ls AS (SELECT 'Item ' || item AS line FROM (SELECT DISTINCT item FROM tk) UNION ALL SELECT text FROM tk JOIN ft ON ft.items = tk.items AND list_contains(antecedent, tk.item) UNION ALL SELECT array_to_string(items, ',') || ': ' || support FROM fi) SELECT line, count(*) AS n FROM ls GROUP BY 1",
        "q24_round_trip": s + f"SELECT {_RULE} FROM ru",
    }
