"""The n-gram join and tool-call linking: SQL, brute force, awkward rows; the pipeline end to end."""

import json
import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import language_id, ngram_join, quality_rules
from tallyloom.llm.ngram_join import OP7_SQL, Order, Tree, linked, near_duplicates, op7_ngram_jaccard_join
from tallyloom.llm.tool_calls import OP9_SQL, SCHEMAS, levels, link, op9_tool_call_linking

from .test_learnt import base_spans, check_pieces, counts, features, random_spans, slow_prediction


def brute(rows):
    sets = []
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((doc, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets)


def planted(n: int = 260):
    """Copies, near copies at and around the threshold, chains, shared passages, short and empty texts."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.randint(6, 90))] for _ in range(20)]
    texts = [None, "", "  \n", "one", "One", "a b c d", "A b  c\nd", "a b c d e"]
    while len(texts) < n:
        kind, base = rng.random(), rng.choice(bases)
        if kind < 0.15:
            w = list(base)
        elif kind < 0.7:
            w = list(base)
            for _ in range(rng.randint(1, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                bases.append(w)
        elif kind < 0.9:
            w = passage + [word() for _ in range(rng.randint(2, 60))]
        else:
            w = [word() for _ in range(rng.randint(1, 40))]
        texts.append(" ".join(w))
    return list(enumerate(texts, 1000))


@pytest.mark.parametrize(("block", "hot"), [(512, 1 << 18), (6, 40)])
def test_planted_links(spark, monkeypatch, block, hot):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("clash")).repartition(5)
    assert sorted(map(tuple, near_duplicates(df).collect())) == brute(rows)


def test_blocks_meet_down_a_tree(spark, monkeypatch):
    """A neighbourhood of many blocks, at the block size of production and in a tree of several levels."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    # chains of near copies: links of a chain are neighbours, its ends are not alike
    texts = []
    for chain in range(4):
        w = [word() for _ in range(60)]
        for _ in range(800):
            w = list(w)
            w[rng.randrange(60)] = word()
            texts.append(" ".join(w))
    rows = list(enumerate(texts, 1))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen = []
    plain = ngram_join.meeting_blocks
    monkeypatch.setattr(ngram_join, "meeting_blocks", lambda nodes, parts, *a: plain(nodes, seen.append(nodes.count()) or parts, *a))
    got = sorted(map(tuple, near_duplicates(df).collect()))
    assert got == brute_fast(rows)
    assert seen and seen[0] >= 4
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "BLOCK_FANOUT", 2)
    small = spark.createDataFrame(rows[:700], "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, near_duplicates(small).collect())) == brute_fast(rows[:700])
    assert seen[-1] >= 20


def moved(spark):
    """Bytes that each stage so far has written to shuffle files."""
    gateway = spark.sparkContext._gateway
    none = gateway.new_array(gateway.jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (stages.apply(i) for i in range(stages.size()))}


def test_disk_follows_the_text(spark, monkeypatch):
    """Texts that all share much with others, in one neighbourhood of many blocks: no table and no exchange is larger
    than the text. Sets of hashes, or blocks copied for each pair, would be."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = []
    for chain in range(12):
        w = [word() for _ in range(400)]
        for _ in range(60):
            w = list(w)
            for _ in range(3):
                w[rng.randrange(400)] = word()
            texts.append(" ".join(w))
    rows = list(enumerate(texts, 1))
    rng.shuffle(rows)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    tables, plain = {}, ngram_join.written

    def weighed(df, name):
        out = plain(df, name)
        files = [f for f in Path(out._folder.removeprefix("file:")).rglob("*.parquet")]
        tables[name] = max(tables.get(name, 0), sum(f.stat().st_size for f in files))
        return out

    monkeypatch.setattr(ngram_join, "written", weighed)
    size, before = sum(map(len, texts)), moved(spark)
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()))
    assert got == brute_fast(rows)
    assert "ngram-meetings" in tables and max(tables.values()) < size
    # rows of exchanges have keys besides
    assert max(n for k, n in moved(spark).items() if k not in before) < 1.3 * size


def test_members_of_blocks_wait_until_the_rows_are_gone(spark, monkeypatch):
    """While the rows of a large neighbourhood and their exchange take disk, its blocks are compressed texts."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = []
    for chain in range(3):
        w = [word() for _ in range(200)]
        for _ in range(40):
            w = list(w)
            for _ in range(2):
                w[rng.randrange(200)] = word()
            texts.append(" ".join(w))
    rows = list(enumerate(texts, 1))
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    blocks, plain = {}, ngram_join.discard

    def looked(*tables):
        for t in tables:
            folder = Path(t._folder.removeprefix("file:"))
            if folder.name.startswith("ngram-labelled"):
                blocks.update({f.name: f.stat().st_size for d in folder.parent.glob("ngram-blocks-*") for f in d.iterdir()})
        plain(*tables)

    monkeypatch.setattr(ngram_join, "discard", looked)
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert got == brute_fast(rows)
    assert len(blocks) >= 15 and all(f.endswith(".texts") for f in blocks)
    assert sum(blocks.values()) < sum(map(len, texts))


def brute_fast(rows):
    """As ``brute``, over pairs that share a shingle."""
    sets, holders = {}, {}
    for doc, text in rows:
        w = text.split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for x in sets[doc]:
            holders.setdefault(x, []).append(doc)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for o in {o for x in s for o in holders[x] if o < d}:
            if 100 * len(s & sets[o]) >= 75 * len(s | sets[o]):
                x, y = sorted((find(d), find(o)))
                root[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def test_planted_near_copies_are_caught(spark):
    """Recall of copies by their similarity: all at 0.75 or more, none below."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(5))
    rows, at_least, below = [], set(), set()
    for k in range(200):
        w = [word() for _ in range(100)]
        v = list(w)
        for i in rng.sample(range(100), k % 8):
            v[i] = word()
        a, b = (({tuple(x[i : i + 5]) for i in range(96)}) for x in (w, v))
        (at_least if 100 * len(a & b) >= 75 * len(a | b) else below).add(2 * k + 1)
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(at_least) > 50 and len(below) > 50
    assert all(got[d] == d - 1 for d in at_least) and all(got[d] == d for d in below)


def test_several_buckets_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_PARTS", 3)
    rows = planted(120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, near_duplicates(df, parts=16).collect())) == brute(rows)


def test_an_id_of_another_name(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "a b")], "n_shingles long, text string")
    got = near_duplicates(rows, id_col="n_shingles").collect()
    assert sorted((r.n_shingles_input, r.n_shingles, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1)]


def test_op7_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, op7_ngram_jaccard_join(spark, sf).collect())) == sorted(con.execute(OP7_SQL).fetchall())


def test_join_of_odd_rows(docs, none):
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count() and near_duplicates(none).collect() == []
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert all(r.component_id <= r.doc_id for r in rows if r.doc_id is not None)


def test_tree_loses_nothing():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 62, rng.integers(1, 80)).astype("u8")) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[: max(1, len(s) * 9 // 10)], rng.integers(0, 1 << 62, 2).astype("u8")])) for s in sets]
    tree = Tree(sets, 16)
    for i, s in enumerate(sets):
        found = set(tree.search(tree.points[i], len(s), 75, 100).tolist())
        assert {j for j, t in enumerate(sets) if linked(s, t, 75, 100)} <= found


def test_frequent_members_come_last():
    hot = np.array([9, 3, 5], "u8")  # from rare to frequent
    assert Order(hot.tobytes()).first(np.array([1, 3, 5, 7, 9], "u8"), 1, 100).tolist() == [1, 7, 9, 3, 5]


def test_op9_equals_its_sql(spark, sf):
    got = op9_tool_call_linking(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cols = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(f"SELECT {cols} FROM ({OP9_SQL})").fetchall(), key=str)


def test_links_levels_and_faults(spark):
    args = lambda **x: json.dumps({"turn": 0, "text": "é\n\"", "chars": 2} | x)
    calls = spark.createDataFrame(
        [(1, "a", 0, "ask", args()), (1, "b", 2, "ask", args(chars=0)), (1, "c", 4, "ask", args(more=1)), (1, "x", 5, "ask", '{"turn": "no"}'), (1, "y", 6, "nobody", args()), (1, "a", 7, "ask", args()), (1, None, 8, "ask", None), (1, "p", 9, "ask", "[1]"), (1, "q", 9, "ask", args())],
        "conv_id long, call_id string, seq long, name string, arguments string",
    ).withColumn("status", F.lit("clash"))
    results = spark.createDataFrame([(1, "a", 1, "r1"), (1, "a", 3, "r2"), (1, "zz", 4, None), (1, None, 5, "r")], "conv_id long, call_id string, seq long, content string")
    needs = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("p", "q"), ("q", "p"), ("a", "nowhere")], "call_id string, needed string")
    got = {(r.kind, r.call_id, r.seq): r for r in link(calls, results, needs, SCHEMAS).collect()}
    assert len(got) == 13
    state = lambda *k: (got[k].status, got[k].level, got[k].faults)
    assert state("call", "a", 0) == ("answered", 0, "") and state("call", "a", 7)[0] == "repeated"
    assert state("call", "b", 2) == ("unanswered", 1, "chars: minimum") and state("call", "c", 4) == ("unanswered", 2, "additional properties")
    assert state("call", "x", 5)[2] == "chars: missing; text: missing; turn: type; turn: minimum" and state("call", "y", 6)[2] == "unknown tool"
    assert state("call", "p", 9) == ("unanswered", None, "not an object") and state("call", None, 8)[2] == "not an object"
    assert state("result", "a", 1)[:2] == ("linked", 0) and state("result", "a", 3)[0] == "repeated" and state("result", "zz", 4)[0] == "orphan" and state("result", None, 5)[0] == "orphan"
    assert got["call", "a", 0].message == '{"arguments":{"chars":2,"text":"é\\n\\"","turn":0},"id":"a","name":"ask","type":"tool_call"}'
    assert link(calls.where("false"), results.where("false"), needs.where("false"), SCHEMAS).collect() == []


def test_equal_and_hot_calls(spark):
    """Of equal rows one is the first; a call id that most rows hold, and rows without id."""
    calls = [(1, "a", 0, "ask", "{}")] * 2 + [(1, None, 0, "ask", "{}")] * 3 + [(2, "hot", i, "ask", "{}") for i in range(3000)]
    results = [(1, "a", 1, "r")] * 2 + [(2, "hot", 9, "r"), (2, "hot", 8, "r"), (3, None, 1, "r")]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, seq long, name string, arguments string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string")
    needs = spark.createDataFrame([("hot", "a")] * 3, "call_id string, needed string")
    got = [(x.kind, x.call_id, x.seq, x.status, x.level) for x in link(c, r, needs, SCHEMAS).collect()]
    assert len(got) == len(calls) + len(results)
    of = lambda kind, id: sorted(x[2:4] for x in got if x[:2] == (kind, id))
    assert of("call", "a") == [(0, "answered"), (0, "repeated")] and of("result", "a") == [(1, "linked"), (1, "repeated")]
    assert of("call", None) == [(0, "unanswered")] * 3 and of("result", None) == [(1, "orphan")]
    assert of("call", "hot")[:2] == [(0, "answered"), (1, "repeated")] and of("result", "hot") == [(8, "linked"), (9, "repeated")]
    assert {x[4] for x in got if x[1] == "hot"} == {1}


def test_levels_against_brute_force(spark):
    rng = np.random.default_rng(9)
    edges = {(i, i - 1) for i in range(1, 40)}  # a chain
    edges |= {(int(i), int(rng.integers(0, i))) for i in range(40, 120) for _ in range(rng.integers(0, 4))}
    edges |= {(130, 131), (131, 132), (132, 130), (133, 130), (134, 133), (134, 5), (135, 134), (136, 136), (137, 200)}
    nodes = range(138)
    of = {i: {b for a, b in edges if a == i and b in nodes} for i in nodes}
    want: dict[int, int] = {}
    while more := {i: 1 + max((want[b] for b in of[i]), default=-1) for i in nodes if i not in want and of[i] <= want.keys()}:
        want |= more
    calls = spark.createDataFrame([(str(i),) for i in [*nodes, 3, 3]] + [(None,)], "call_id string")
    needs = spark.createDataFrame([(str(a), str(b)) for a, b in [*sorted(edges), (1, 0)]] + [(None, "1"), ("1", None)], "call_id string, needed string")
    got = levels(calls, needs).collect()
    assert len(got) == len(nodes) and {int(r.call_id): r.level for r in got} == {i: want.get(i) for i in nodes}
    assert {want.get(i) for i in (130, 134, 135, 136)} == {None} and want[39] == 39


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline(spark, sf, tmp_path):
    """Every stage against plain Python over what the stage before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before, after = docs.collect(), out.collect()
        if name == "packing":
            check_pieces(after, before)
            break
        assert out.columns == COLUMNS, name
        ids = [r.doc_id for r in after]
        if name == "language_id":
            net = language_id.fit(docs.where(~language_id.held_out()))
            sample = [r for r in before if len(r.text or "") < 400]
            for r in sample:
                known = any(map(str.isalpha, r.text or "")) and slow_prediction(net, r.text)[1] >= corpus_pipeline.MIN_SCORE
                assert known == (r.doc_id in ids)
            assert len(sample) > 20
        if name == "quality_rules":
            rules = quality_rules.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            assert sorted(ids) == sorted(r.doc_id for r in before if good(r.text, rules))
        if name == "near_duplicates":
            assert sorted(ids) == sorted(d for d, _, c in brute([(r.doc_id, r.text) for r in before]) if d == c)
        if name == "secret_scan":
            masked = {r.doc_id: masked_text(r.text) for r in before}
            assert {r.doc_id: r.text for r in after} == masked and any("[SECRET]" in t for t in masked.values())
            assert all(r.n_chars == len(r.text) for r in after)
        docs = out
    final = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, final.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in after)


def good(text, rules):
    holds = {"<=": lambda a, b: a <= b, ">": lambda a, b: a > b}
    n, _, _, _, repeat = counts(text)
    own = features(text)
    bad = any(all(holds[op](own[f], c) for f, op, c in rule.conditions) for rule in rules)
    return n >= 50 and 100 * repeat <= 50 * n and not bad


def masked_text(text):
    out, at = [], 0
    for a, _, b in sorted(base_spans(text) + random_spans(text)):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def test_stages_on_odd_rows(spark, sf):
    """Empty tables, null ids and texts, repeated rows, and more columns."""
    text = " ".join(f"word{i} of the and that" for i in range(30))
    near = text.replace("word3 ", "other ")
    rows = [(None, text, "en"), (None, text, "en"), (7, text, "en"), (8, near, "en"), (8, near, "en"), (9, None, None), (10, "", "en")]
    rows += [(20 + i, " ".join(f"und{j}{i} der die das nicht" for j in range(20)), "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("row_id", F.lit("clash")).withColumn("score", F.lit("clash"))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in stages.items():
        assert stage(spark, docs.where("false").select(*COLUMNS), sf).collect() == [], name
    kept = stages["near_duplicates"](spark, docs, sf).collect()
    # one of the group, which has no id and so the least key; rows without words stay
    assert [r.doc_id for r in kept if (r.text or "").startswith("word")] == [None]
    assert {9, 10} <= {r.doc_id for r in kept} and len(kept) == 8
    once = stages["near_duplicates"](spark, docs.where("doc_id IS NOT NULL"), sf).collect()
    assert sorted(r.doc_id for r in once) == [7, 9, 10, 20, 21, 22, 23, 24]
    good_ones = [r.doc_id for r in stages["language_id"](spark, docs, sf).collect()]
    assert good_ones.count(None) == 2 and not {9, 10} & set(good_ones)
    assert stages["secret_scan"](spark, docs, sf).count() == len(rows)
    assert {r.doc_id for r in stages["packing"](spark, docs, sf).collect()} == {r[0] for r in rows}
    assert len(stages["quality_rules"](spark, docs, sf).collect()) <= len(rows)
