"""Quality rules learnt from labelled statistics: an ordered decision list of threshold conjunctions.

Statistics of every text are Spark expressions. Those of a bounded sample of labelled rows are counted in
cells of quantile bins, and the list is learnt from the counts: sequential covering grows a conjunction by
information gain on half of the sample, prunes it on the other half, keeps it if it is precise there,
removes what it covers, and goes on. The list becomes one conditional expression; no Python runs
on executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shielded, table

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ["symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "word_length", "exclaim_per_word", "words_per_line"]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(inner: DataFrame, text: str) -> DataFrame:
    """A shielded table with a struct ``q``: the five counts of the base and the features. Null texts have no words.

    Rows of 3-word windows are compared by 64-bit hashes within their text. Work grows as n log n with a text's length.
    """
    out = inner.withColumn("t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    out = out.withColumn("w", F.regexp_extract_all("t", F.lit(f"[^{SPACE}]+"), F.lit(0)))
    out = out.withColumn("l", F.filter(F.split("t", "\n"), lambda line: line.rlike(f"[^{SPACE}]")))
    window = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    hashed = F.transform(F.sequence(F.lit(0), F.size("w") - 3), window)
    out = out.withColumn("h", F.when(F.size("w") >= 3, hashed).otherwise(F.array().cast("array<bigint>")))
    # equal windows stand side by side once sorted
    numbered = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), numbered).otherwise(none))
    after = lambda x, j: x["h"] == F.get("s", j + 1)["h"]
    before = lambda x, j: (x["h"] == F.get("s", F.greatest(j - 1, F.lit(0)))["h"]) & (j > 0)
    beside = F.filter("s", lambda x, j: after(x, j) | before(x, j))
    out = out.withColumn("p", F.sort_array(F.transform(beside, lambda x: x["i"])))
    steps = F.transform("p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("p", j + 1) - p, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    size = lambda c: F.size(c).cast("long")
    dropped = lambda symbols: F.length("t") - F.length(F.translate("t", symbols, ""))
    counts = {
        "n_words": size("w"),
        "word_chars": F.length(F.regexp_replace("t", f"[{SPACE}]+", "")).cast("long"),
        "n_symbols": dropped(SYMBOLS).cast("long"),
        "n_dup_lines": size("l") - size(F.array_distinct("l")),
        "n_repeat_words": covered.cast("long"),
    }
    more = {"lines": size("l"), "upper": dropped(UPPER), "exclaim": dropped("!")}
    out = out.withColumn("c", F.struct(*(v.alias(k) for k, v in (counts | more).items())))
    c, per = F.col("c"), lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    features = {
        "symbols_per_word": per(c["n_symbols"], c["n_words"]),
        "dup_line_share": per(c["n_dup_lines"], c["lines"]),
        "repeat_share": per(c["n_repeat_words"], c["n_words"]),
        "upper_share": per(c["upper"], c["word_chars"]),
        "word_length": per(c["word_chars"], c["n_words"]),
        "exclaim_per_word": per(c["exclaim"], c["n_words"]),
        "words_per_line": per(c["n_words"], c["lines"]),
    }
    both = [*(c[k].alias(k) for k in counts), *(v.cast("double").alias(k) for k, v in features.items())]
    return out.withColumn("q", F.struct(*both))


def with_statistics(docs: DataFrame, text_col: str = "text", stats_as: str = "statistics") -> DataFrame:
    """``docs`` with a struct of the five counts and the features of every whole text; null texts count as empty.

    A column of ``docs`` named like the output is kept with ``_input`` behind its name. No rows: no rows.
    """
    inner, names, back = shielded(docs, [stats_as])
    return statistics(inner, names[text_col]).select(*back, F.col("q").alias(stats_as))


@dataclass(frozen=True)
class Rule:
    """All of (feature, "<=" or ">", threshold) hold: reject. precision and covered: on the pruning half."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float
    covered: int


def learn(cells: list[tuple[tuple[int, ...], int, int, int]], names: list[str], cuts: list[list[float]], min_precision: float = 0.8, min_covered: int = 3, max_conditions: int = 4) -> list[Rule]:
    """Sequential covering over counted cells (bins, half, bad rows, good rows).

    A bin b of feature f means that b of the ascending cuts[f] lie below the value. Deterministic: ties go to the
    earlier feature, direction and cut.
    """
    tests = [(f, op, k) for f in range(len(names)) for op in ("<=", ">") for k in range(len(cuts[f]))]
    holds = lambda bins, t: (bins[t[0]] <= t[2]) == (t[1] == "<=")
    left, rules = list(cells), []
    while True:
        grow, check = [c for c in left if c[1] == 0], [c for c in left if c[1] == 1]
        rule: list[tuple[int, str, int]] = []
        inside = grow
        bad, good = sum(c[2] for c in inside), sum(c[3] for c in inside)
        if not bad:
            return rules
        while good and len(rule) < max_conditions:
            best = None
            for t in tests:
                p = n = 0
                for c in inside:
                    if holds(c[0], t):
                        p += c[2]
                        n += c[3]
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, t)
            if best is None or best[0] <= 0:
                break
            rule.append(best[1])
            inside = [c for c in inside if holds(c[0], best[1])]
            bad, good = sum(c[2] for c in inside), sum(c[3] for c in inside)

        def worth(conditions: list, rows: list = check) -> tuple[float, int]:
            hit = [c for c in rows if all(holds(c[0], t) for t in conditions)]
            p, n = sum(c[2] for c in hit), sum(c[3] for c in hit)
            return (p + 1) / (p + n + 2), p + n

        while len(rule) > 1:
            shorter = [[t for t in rule if t != x] for x in rule]
            best = max(shorter, key=lambda r: worth(r)[0])
            if worth(best)[0] < worth(rule)[0]:
                break
            rule = best
        if not rule or worth(rule)[1] < min_covered or worth(rule)[0] < min_precision:
            return rules
        value, covered = worth(rule)
        rules.append(Rule(tuple((names[f], op, cuts[f][k]) for f, op, k in rule), value, covered))
        left = [c for c in left if not all(holds(c[0], t) for t in rule)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20_000, bins: int = 12) -> list[Rule]:
    """Rules against label 0, from the ``max_rows`` labelled ids that are least by a hash (a bound, so they are broadcast).

    The driver gets counts of cells, at most one for each sample row. Null ids and labels are left out. An
    id with several labels counts as its least; one with several texts counts each. No rows with both labels: no rules.
    """
    usable = F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
    known = labels.where(usable).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"), F.xxhash64(id_col).alias("_r"))
    # hashes below a bound that lets a fifth more than the sample through
    share = min(1.0, 1.2 * max_rows / max(1, known.count()))
    low = known.where(F.col("_r") <= min(2**63 - 1, int(-(2**63) + share * 2.0**64)))
    sample = low.groupBy("_id", "_r").agg(F.min("_y").alias("_y")).orderBy("_r", "_id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    half = F.pmod(F.shiftright("_r", 7), F.lit(2)).cast("int").alias("_half")
    found = with_statistics(rows, "_text", "_q").select("_y", half, *(F.col(f"_q.{f}").alias(f) for f in FEATURES)).persist()
    try:
        marks = [k / bins for k in range(1, bins)]
        # quantiles of each class: thresholds lie where either is dense
        got = found.groupBy("_y").agg(*(F.percentile_approx(f, marks, 1000).alias(f) for f in FEATURES)).collect()
        if {r["_y"] for r in got} != {0, 1}:
            return []
        cuts = [sorted({v for r in got for v in r[f]}) for f in FEATURES]
        bin_of = lambda f, cut: sum((F.col(f) > c).cast("int") for c in cut)
        binned = found.select("_y", "_half", *(bin_of(f, cut).alias(f) for f, cut in zip(FEATURES, cuts, strict=True)))
        cells = binned.groupBy("_half", *FEATURES).agg(F.sum(1 - F.col("_y")).alias("bad"), F.sum("_y").alias("good")).collect()
    finally:
        found.unpersist()
    data = sorted((tuple(r[f] for f in FEATURES), r["_half"], r["bad"], r["good"]) for r in cells)
    return learn(data, FEATURES, cuts)


def verdict(rules: list[Rule], stats: Column) -> tuple[Column, Column]:
    """The number of the first rule that holds (from 1, else 0), and whether the text is kept."""
    number = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        hit = F.lit(True)
        for f, op, c in rule.conditions:
            hit = hit & (stats[f] <= F.lit(c) if op == "<=" else stats[f] > F.lit(c))
        number = F.when(hit, F.lit(k)).otherwise(number)
    number = F.coalesce(number, F.lit(0))
    return number, number == 0


def judge(
    docs: DataFrame,
    rules: list[Rule],
    text_col: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    report_as: str = "quality_report",
) -> DataFrame:
    """``docs`` with a struct: counts, base_failed, rule, kept, from every whole text.

    Null texts count as empty. Rows are kept as they are: repeated ones get equal reports. A column of ``docs`` named
    like the output is kept with ``_input`` behind its name; no other is touched. No rows: no rows.
    """
    inner, names, back = shielded(docs, [report_as])
    out = statistics(inner, names[text_col])
    q = F.col("q")
    failed = (q["n_words"] < min_words) | (100 * q["n_repeat_words"] > max_repeat_percent * q["n_words"])
    rule, kept = verdict(rules, q)
    # not deterministic for the optimizer: a filter on the report then stays above it, else statistics would be computed for it again
    kept = kept & (F.monotonically_increasing_id() >= 0)
    report = [*(q[c].alias(c) for c in COUNTS), failed.alias("base_failed"), rule.alias("rule"), (~failed & kept).alias("kept")]
    return out.select(*back, F.struct(*report).alias(report_as))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` judged by rules learnt from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs.select("doc_id", "text"), rules).select("doc_id", "quality_report.*")
