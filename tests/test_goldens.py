"""Fixed examples: parsing, shards, best patterns, encodings, rules, reports."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.functions import report
from tallyloom.operators import baskets, itemsets as algebra, mining, patterns, rules, tries
from tallyloom.plans import job
from tallyloom.sources import lines, sinks

SETS = [([1], 3), ([2], 4), ([3], 4), ([5], 4), ([1, 2], 2), ([1, 3], 3), ([1, 5], 2), ([2, 3], 3), ([2, 5], 4), ([3, 5], 3), ([1, 2, 3], 2), ([1, 2, 5], 2), ([1, 3, 5], 2), ([2, 3, 5], 3), ([1, 2, 3, 5], 2)]


@pytest.fixture(scope="module")
def itemsets(spark):
    return spark.createDataFrame(SETS, "items array<int>, support long")


def test_fifty_rules_in_order(itemsets):
    found = rules.association_rules(itemsets, 5, 0.0).orderBy(F.size(F.concat("antecedent", "consequent")), F.array_sort(F.concat("antecedent", "consequent")), F.size("consequent"), "consequent").collect()
    assert len(found) == 50
    assert [(r.antecedent, r.consequent, r.coverage, r.transaction_count, r.confidence, r.lift) for r in found[:5]] == [([2], [1], 4, 2, 0.5, 0.8333333333333334), ([1], [2], 3, 2, 0.6666666666666666, 0.8333333333333334), ([3], [1], 4, 3, 0.75, 1.25), ([1], [3], 3, 3, 1.0, 1.25), ([5], [1], 4, 2, 0.5, 0.8333333333333334)]
    by = {(tuple(r.antecedent), tuple(r.consequent)): r for r in found}
    assert all(0 < r.confidence <= 1 and by[b, a].lift == pytest.approx(r.lift) for (a, b), r in by.items())


@pytest.mark.parametrize("strategy", ["fpgrowth", "weighted", "auto"])
def test_mining(spark, strategy):
    rows = [(1, [1, 3, 4]), (2, [2, 3, 5]), (3, [1, 2, 3, 5]), (4, [2, 5]), (5, [1, 2, 3, 5])]
    got = mining.frequent_itemsets(spark.createDataFrame(rows, "txn_id int, items array<int>"), 0.4, strategy).collect()
    assert sorted((r["items"], r.support) for r in got) == sorted(SETS)
    none = spark.createDataFrame([], "txn_id int, items array<int>")
    assert mining.frequent_itemsets(none, 0.4, strategy).collect() == []


def test_parsing(spark):
    rows = ["1002102233,Apfel(2074)", "1002102233,Apfel, Birne & Co(2074)", "A12,Apfel(7)", "5,Foo (bar)(9)"]
    df = spark.createDataFrame([(r,) for r in rows], "line string")
    assert [tuple(r) for r in lines.parse_pairs(df).collect()] == [("1002102233", 2074), ("1002102233", 2074), ("A12", 7), ("5", 9)]
    assert [r.name for r in lines.parse_names(df).collect()] == ["Apfel", "Apfel, Birne & Co", "AApfel", "Foo "]
    bad = spark.createDataFrame([("1,x(y)",), ("2,z(3)",)], "line string")
    assert [tuple(r) for r in lines.parse_pairs(bad, permissive=True).collect()] == [("2", 3)]
    with pytest.raises(PySparkException):
        lines.parse_pairs(bad).collect()
    with pytest.raises(PySparkException):
        lines.names_of(lines.parse_names(df), strict=True).collect()
    assert {r["item"]: r["name"] for r in lines.names_of(lines.parse_names(df)).collect()}[2074] == "Apfel"


def test_group_prefixes(spark):
    got = baskets.group_prefixes(spark.createDataFrame([("t", [1, 3, 2, 4])], "txn_id string, items array<int>"), 3)
    assert {(r.group_id, tuple(r["items"])) for r in got.collect()} == {(1, (1, 3, 2, 4)), (2, (1, 3, 2)), (0, (1, 3))}


def test_patterns(spark):
    df = spark.createDataFrame([([1, 3, 2, 4], 100)], "items array<int>, support long")
    assert sorted(r["item"] for r in patterns.per_item(df).collect()) == [1, 2, 3, 4]
    rows = [(42, [1, 2, 3, 42], 100), (42, [3, 4, 42], 10), (42, [5, 42], 200), (42, [5, 42], 200), (7, [7, 8], 5), (7, [7, 9], 5), (7, [6, 7, 8], 5)]
    top = patterns.top_k(spark.createDataFrame(rows, "item int, items array<int>, support long"), 2).orderBy("item", "rank").collect()
    assert [(r["item"], r["items"]) for r in top] == [(7, [6, 7, 8]), (7, [7, 9]), (42, [5, 42]), (42, [1, 2, 3, 42])]
    lists = spark.createDataFrame([(42, [([1, 2], 100), ([1], 300), ([2], 500)])], "item int, patterns array<struct<items: array<int>, support: long>>")
    assert patterns.flatten(lists).count() == 3


def test_key_values(spark, tmp_path):
    df = spark.createDataFrame([([1, 2, 3], 100), ([3, 1, 2], 100)], "items array<int>, support long")
    got = sinks.key_values(df, "my-family", "my-qualifier")
    assert [(r.row_key, r.value.hex(), r.family, r.qualifier) for r in got.collect()] == [("[1, 2, 3]", "0000000000000064", "my-family", "my-qualifier")] * 2
    kv = str(tmp_path / "kv")
    assert sinks.read_supports(spark, kv).collect() == []
    sinks.write_key_values(got, kv)
    assert [tuple(r) for r in sinks.read_supports(spark, kv).collect()] == [([1, 2, 3], 100)]
    sinks.save_supports(spark.createDataFrame([([1], 1), ([2], 2)], "items array<int>, support long"), sinks.KeyValueTable(kv, "my-family", "my-qualifier"))
    sinks.save_supports(spark.createDataFrame([([2], 5)], "items array<int>, support long"), sinks.KeyValueTable(kv, "my-family", "my-qualifier"))
    assert sorted(tuple(r) for r in sinks.read_supports(spark, kv).collect()) == [([1], 1), ([1, 2, 3], 100), ([2], 5)]
    # a write that failed has left no whole version
    (tmp_path / "kv" / "v99").mkdir()
    assert sinks.read_supports(spark, kv).count() == 3


def test_formatted_rule_and_block(spark):
    names = spark.createDataFrame([(1, "Apfel"), (3, "Birne")], "item int, name string")
    rule = spark.createDataFrame([(1, [1, 2], [3, 4], 30, 40, 0.35123541915812, 4.129128401)], "item int, antecedent array<int>, consequent array<int>, coverage long, transaction_count long, confidence double, lift double")
    text = "Apfel,2 => Birne,4 (support: 40, confidence: 0.35, lift: 4.13)"
    shown = report.formatted(rule, names)
    assert shown.first()["text"] == text
    blocks = report.blocks(spark.createDataFrame([(1,), (9,)], "item int"), shown)
    assert {r["item"]: r.value for r in blocks.collect()} == {1: f"Item 1\n{text}\n", 9: "Item 9\n"}


def test_rule_sink_keeps_order(spark):
    a, b = (spark.createDataFrame([r], "antecedent array<int>, consequent array<int>") for r in (([1, 2], [3, 4]), ([5, 6], [7, 8])))
    held = sinks.append_rules(None, a)
    assert held.count() == 1
    assert [r.antecedent for r in sinks.append_rules(held, b).orderBy("batch").collect()] == [[1, 2], [5, 6]]


def test_trie(spark):
    weighted = spark.createDataFrame([([1, 2, 3], 2), ([1, 2], 1), ([4], 5), ([2, 1], 3)], "items array<int>, weight long")
    prefixes = tries.prefix_table(weighted)
    assert {tuple(r.path): r["count"] for r in prefixes.collect()} == {(1,): 3, (1, 2): 3, (1, 2, 3): 2, (4,): 5, (2,): 3, (2, 1): 3}
    assert {(tuple(r["items"]), r.weight) for r in tries.residuals(prefixes).collect()} == {((1, 2, 3), 2), ((1, 2), 1), ((4,), 5), ((2, 1), 3)}
    assert {(tuple(r["items"]), r.weight) for r in tries.compressed(weighted).collect()} == {((1, 2, 3), 2), ((1, 2), 4), ((4,), 5)}
    assert {(r["item"], r["count"]) for r in tries.children(prefixes, [1]).collect()} == {(2, 3)}
    assert {(r["item"], r["count"]) for r in tries.children(prefixes, []).collect()} == {(1, 3), (2, 3), (4, 5)}


STRATEGIES = ["fpgrowth", "weighted", "auto"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_a_basket_of_17_items_and_bounds_beyond_the_baskets(spark, strategy):
    wide = spark.createDataFrame([(1, list(range(17))), (2, [3, 5])], "txn_id int, items array<int>")
    got = mining.frequent_itemsets(wide, 0.5, strategy)
    assert got.count() == 2**17 - 1 and got.agg(F.max(F.size("items"))).first()[0] == 17
    assert sorted((r["items"], r.support) for r in got.where("support = 2").collect()) == [([3], 2), ([3, 5], 2), ([5], 2)]
    assert mining.frequent_itemsets(wide, 1.5, strategy).collect() == []
    assert mining.frequent_itemsets(wide.where("false"), 0.5, strategy).collect() == []


def test_rules_of_a_set_of_13_items_grow_as_they_are_enumerated(spark, monkeypatch):
    sets = mining.frequent_itemsets(spark.createDataFrame([(1, list(range(6))), (2, [0, 1]), (3, [2, 5, 4])], "txn_id int, items array<int>"), 0.3, "weighted")
    key = lambda df: sorted(map(str, df.collect()))
    whole = key(rules.association_rules(sets, 3, 0.6))
    monkeypatch.setattr(rules, "CHUNK", 2)
    assert key(rules.association_rules(sets, 3, 0.6)) == whole and len(whole) > 100


def test_paths_of_any_length(spark):
    path = spark.createDataFrame([(list(range(40)), [50 - i for i in range(40)])], "items array<int>, counts array<long>")
    got = {tuple(r["items"]): r.support for r in mining.path_combinations(path, 37).collect()}
    assert len(got) == 2**14 - 1 and got[0, 13] == 37 and all(s == 50 - k[-1] for k, s in got.items())
    assert mining.path_combinations(path.where("false")).collect() == []


def test_rules_collection_is_in_rule_order(spark):
    rows = [([2], [3], 1.5), ([1, 2], [3], 1.5), ([2], [1], 1.5), ([4], [5], 2.0)]
    df = spark.createDataFrame(rows, "antecedent array<int>, consequent array<int>, lift double")
    got = rules.collected(df, "n").first()
    assert got["name"] == "n" and [tuple(r)[:2] for r in got["rules"]] == [([4], [5]), ([2], [1]), ([2], [3]), ([1, 2], [3])]
    assert [tuple(r)[:2] for r in df.orderBy(*rules.order_keys()).collect()] == [tuple(r)[:2] for r in got["rules"]]


def test_ranks_of_rules_over_several_ranges(spark):
    rows = [([i % 7], [100 + i], float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "antecedent array<int>, consequent array<int>, lift double")
    wanted = [r.consequent for r in df.orderBy(*rules.order_keys()).collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = rules.ranked(df).orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.rank for r in got] == list(range(1, 201)) and [r.consequent for r in got] == wanted
    assert got[0].asDict().keys() == {"antecedent", "consequent", "lift", "rank"}
    assert rules.ranked(df.where("false")).collect() == []


def test_itemset_algebra(spark):
    row = spark.createDataFrame([([1, 2, 3], [2, 3], [1, 2, 4])], "a array<int>, b array<int>, c array<int>")
    got = row.select(algebra.size("a"), algebra.without_item("a", 2), algebra.without_set("a", "b"), algebra.compared("a", "c"), algebra.compared("a", "a"))
    assert tuple(got.first()) == (3, [1, 3], [1], -1, 0)


def test_negative_items_have_groups_of_their_sign(spark):
    got = baskets.group_prefixes(spark.createDataFrame([("t", [-4, 3, 5])], "txn_id string, items array<int>"), 3)
    assert {(r.group_id, tuple(r["items"])) for r in got.collect()} == {(-1, (-4,)), (0, (-4, 3)), (2, (-4, 3, 5))}


def test_the_job_from_a_command_line(spark, tmp_path, capsys):
    (tmp_path / "lines.txt").write_text("".join(f"{t},{n}({i})\n" for t in range(4) for n, i in (("Apfel", 1), ("Birne", 2))) + "9,Apfel(1)\nbad(\n")
    arguments = ["--input", str(tmp_path / "lines.txt"), "--kv", str(tmp_path / "kv"), "--min-support", "0.5", "--permissive"]
    job.main([*arguments, "--report", str(tmp_path / "report")])
    assert sorted(tuple(r) for r in sinks.read_supports(spark, str(tmp_path / "kv")).collect()) == [([1], 5), ([1, 2], 4), ([2], 4)]
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "report")).collect())
    assert "Apfel => Birne (support: 4, confidence: 0.80, lift: 1.00)" in text and "Item 2" in text
    job.main(arguments)
    assert "Birne => Apfel" in capsys.readouterr().out
    with pytest.raises(ValueError):
        job.Options(min_support=2.0)
    with pytest.raises(SystemExit):
        job.main([])
