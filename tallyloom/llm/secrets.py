"""Secret scans: fixed patterns, and a battery of randomness tests over tokens in code alphabets.

A token's alphabet is inferred from its characters. Three tests ask whether it may be a uniform random string of that
alphabet: chi-squared over symbols, runs above and below the middle symbol, and serial correlation.
Fisher's method combines them. Within a text, a step-up procedure with weights by length rejects
randomness at a set false-discovery rate, so that longer tokens, on which the tests have more power,
need less evidence; tokens that aren't rejected are reported as ``random``. All of it is Spark expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shielded, table

#: Fixed by the contract, in order of kind. Least lengths: of group 2, of the match, of the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
MIN_TOKEN, FALSE_DISCOVERY = 20, 0.05
TOKEN = r"[A-Za-z0-9+/_-]{%d,}"
SPANS = "array<struct<start:int,kind:int,end:int>>"
ORDER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"


def none() -> Column:
    return F.array().cast(SPANS)


#: Longer arrays are gone through in blocks of about the root of their size, as an array is copied at each step.
SHORT = 64


def with_running(df: DataFrame, name: str, items: str, value: str, join: Callable[[Column, Column], Column]) -> DataFrame:
    """``df`` with an array of integers: for each of ``items``, ``join`` over the ``value`` of those before it, from 0.

    join: an associative function of two integers. Each step copies the results so far, so a long array is cut
    into blocks: n to the power of 1.5 instead of 2. What is used more than once is a column of its own, and so evaluated once.
    """
    empty = F.array().cast("array<int>")

    def before(part: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        step = lambda acc, x: F.struct(
            join(acc["at"], x[value]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        )
        return F.aggregate(part, begin, step)

    width = F.when(F.size(items) <= SHORT, SHORT).otherwise(F.ceil(F.sqrt(F.size(items)))).cast("int")
    firsts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), width)
    out = df.withColumn(f"{name}1", F.transform(firsts, lambda i: before(F.slice(items, i, width))))
    # where each block starts, from the blocks before it
    fold = lambda b: F.aggregate(F.slice(f"{name}1", F.lit(1), b), F.lit(0), lambda acc, x: join(acc, x["at"]))
    out = out.withColumn(f"{name}2", F.transform(f"{name}1", lambda _, b: fold(b)))
    shifted = F.zip_with(f"{name}1", f"{name}2", lambda d, s: F.transform(d["out"], lambda x: join(s, x)))
    return out.withColumn(name, F.flatten(shifted))


FOUND = "array<struct<start:int,kind:int,end:int,match:string>>"


def with_located(df: DataFrame, name: str, text: str, pattern: str, kind: int, only: Column) -> DataFrame:
    """``df`` with structs (start, kind, end, match) of leftmost non-overlapping matches, in code points; none unless ``only``.

    Pieces between matches and the matches themselves alternate, so that lengths add up to positions.
    """
    none = F.array().cast("array<struct<g:int,n:int,step:int,match:string>>")
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    pair = lambda g, m: F.struct(
        F.length(g).alias("g"), F.length(m).alias("n"), (F.length(g) + F.length(m)).alias("step"), m.alias("match")
    )
    steps = F.filter(F.zip_with(F.split(text, pattern), found, pair), lambda s: s["match"].isNotNull())
    out = df.withColumn(f"{name}s", F.when(only, steps).otherwise(none))
    out = with_running(out, f"{name}b", f"{name}s", "step", lambda a, b: a + b)
    span = lambda s, b: F.struct(
        (b + s["g"]).alias("start"), F.lit(kind).alias("kind"), (b + s["g"] + s["n"]).alias("end"), s["match"].alias("match")
    )
    return out.withColumn(name, F.zip_with(f"{name}s", f"{name}b", span).cast(FOUND))


def tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution: Abramowitz and Stegun 26.2.17, to 7.5e-8."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    p = F.exp(-a * a / 2) * 0.3989422804014327 * series
    return F.when(z >= 0, p).otherwise(1 - p)


def alphabet(match: Column) -> tuple[Column, Column, Column]:
    """Name, size and symbols of the smallest code alphabet that holds the token; null for words and numbers.

    A code mixes digits with letters, or upper case with lower within.
    """
    digit, upper, lower = (match.rlike(x) for x in ("[0-9]", "[A-Z]", "[a-z]"))
    mixed = digit & (upper | lower) | upper & match.rlike("[a-z].*[A-Z]") & lower
    kinds = [
        ("hex", match.rlike("^[0-9a-f]+$") | match.rlike("^[0-9A-F]+$"), 16, None),
        ("base32", match.rlike("^[A-Z2-7]+$"), 32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
        ("base36", match.rlike("^[0-9A-Z]+$") | match.rlike("^[0-9a-z]+$"), 36, None),
        ("base62", match.rlike("^[0-9A-Za-z]+$"), 62, ORDER[:62]),
        ("base64", match.rlike("^[0-9A-Za-z+/]+$"), 64, ORDER[:64]),
        ("base64url", match.rlike("^[0-9A-Za-z_-]+$"), 64, ORDER[:62] + "-_"),
    ]
    name = size = symbols = F.lit(None)
    folded = F.when(upper, F.lit(ORDER[:36])).otherwise(F.lit(ORDER[:10] + ORDER[36:62]))
    for n, test, k, s in reversed(kinds):
        test = test & mixed
        name = F.when(test, F.lit(n)).otherwise(name)
        size = F.when(test, F.lit(float(k))).otherwise(size)
        symbols = F.when(test, F.lit(s) if s else folded).otherwise(symbols)
    return name, size, symbols


def typed(token: Column) -> Column:
    """The token with its alphabet's name, size and symbols."""
    name, size, symbols = alphabet(token["match"])
    return F.struct(token["start"].alias("start"), token["end"].alias("end"), token["match"].alias("match"), name.alias("name"), size.alias("k"), symbols.alias("symbols"))


def placed(t: Column) -> Column:
    """The token with ``x``: the place of each character in its alphabet."""
    x = F.transform(F.filter(F.split(t["match"], ""), lambda c: c != ""), lambda c: F.instr(t["symbols"], c).cast("double") - 1)
    return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["k"].alias("k"), x.alias("x"))


def summed(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def counted(t: Column) -> Column:
    """Sums over the token's places: what the three tests need."""
    x, n = t["x"], F.size(t["x"]).cast("double")
    squares = summed(F.transform(F.array_distinct(x), lambda v: F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), 2)))
    middle = (t["k"] - 1) / 2
    above = F.size(F.filter(x, lambda v: v > middle)).cast("double")
    turns = F.size(F.filter(F.sequence(F.lit(1), F.size(x) - 1), lambda i: (F.get(x, i) > middle) != (F.get(x, i - 1) > middle))).cast("double")
    lagged = summed(F.transform(x, lambda v, i: v * F.get(x, (i + 1) % F.size(x))))
    return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["k"].alias("k"), n.alias("n"), squares.alias("squares"), above.alias("above"), (turns + 1).alias("runs"), lagged.alias("lagged"), summed(x).alias("sum"), summed(F.transform(x, lambda v: v * v)).alias("sum2"))


def tested(s: Column) -> Column:
    """The token's p-value of randomness, by Fisher's method over the three tests."""
    n, df = s["n"], s["k"] - 1
    chi = s["squares"] * s["k"] / n - n
    spread = 2 / (9 * df)
    p1 = tail((F.pow(chi / df, 1 / 3) - (1 - spread)) / F.sqrt(spread))
    a, b = s["above"], n - s["above"]
    mean = 2 * a * b / n + 1
    variance = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    p2 = F.when(variance > 0, 2 * tail(F.abs((s["runs"] - mean) / F.sqrt(F.when(variance > 0, variance))))).otherwise(F.lit(0.0))
    whole = n * s["sum2"] - s["sum"] * s["sum"]
    corr = (n * s["lagged"] - s["sum"] * s["sum"]) / F.when(whole > 0, whole)
    sd = F.sqrt(n * n / ((n - 1) * (n - 1) * (n - 2)))
    p3 = F.when(whole > 0, 2 * tail(F.abs((corr + 1 / (n - 1)) / sd))).otherwise(F.lit(0.0))
    least = F.lit(1e-300)
    half = -(F.log(F.greatest(p1, least)) + F.log(F.greatest(p2, least)) + F.log(F.greatest(p3, least)))
    # upper tail of chi-squared with 6 degrees of freedom
    p = F.exp(-half) * (1 + half + half * half / 2)
    return F.struct(p.alias("p"), s["start"].alias("start"), s["end"].alias("end"), n.alias("n"))


def scanned(inner: DataFrame, text: str, min_token: int, false_discovery: float) -> DataFrame:
    """A shielded table with ``base`` and ``spans``."""
    out = inner.withColumn("t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    low = F.lower("t")
    # plain searches spare most texts the patterns
    worded = low.contains("pass") | low.contains("secret") | low.contains("token") | low.contains("api")
    out = with_located(out, "a", "t", ASSIGN, 0, worded)
    out = with_located(out, "k", "t", ACCESS, 1, F.col("t").contains("AKIA"))
    # a run of 16 or more is found as it is among all runs
    out = with_located(out, "x", "t", "[0-9a-f]{16,}", 2, F.col("t").rlike("[0-9a-f]{16}"))
    out = with_located(out, "r", "t", TOKEN % min_token, 3, F.col("t").rlike(f"(?=[A-Za-z0-9+/_-]{{{min_token}}})"))
    secret = F.filter("a", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12)
    access = F.filter("k", lambda s: s["end"] - s["start"] >= 18)
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    out = out.withColumn("base", F.sort_array(F.transform(F.concat(secret, access, "x"), plain)))
    # a token meets blocks of base spans, and the spans of those blocks alone that it may overlap
    width = F.greatest(F.ceil(F.sqrt(F.size("base"))).cast("int"), F.lit(1))
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size("base"), F.lit(1)), width), lambda i: F.slice("base", i, width))
    block = lambda p: F.struct(
        F.array_min(p["start"]).alias("start"), F.array_max(p["end"]).alias("end"), p.alias("spans")
    )
    out = out.withColumn("blocks", F.transform(parts, block))
    meets = lambda s, b: (b["start"] < s["end"]) & (b["end"] > s["start"])
    taken = lambda s: F.exists("blocks", lambda b: meets(s, b) & F.exists(b["spans"], lambda x: meets(s, x)))
    free = F.filter("r", lambda s: ~F.coalesce(taken(s), F.lit(False)))
    out = out.withColumn("m", F.transform(F.filter(F.transform(free, typed), lambda t: t["name"].isNotNull()), placed))
    out = out.withColumn("p", F.sort_array(F.transform(F.transform("m", counted), tested)))
    # step-up: the largest rank whose weighted p-value is within rate * rank / count; weights are lengths over their mean
    out = out.withColumn("mean", summed(F.transform("p", lambda t: t["n"])) / F.size("p"))
    mean = F.col("mean")
    weighted = lambda t: F.struct((t["p"] * mean / t["n"]).alias("v"), t["start"].alias("start"), t["end"].alias("end"))
    out = out.withColumn("v", F.sort_array(F.transform("p", weighted)))
    rank = lambda t, i: F.when(t["v"] <= F.lit(false_discovery) * (i + 1) / F.size("v"), i + 1).otherwise(0)
    out = out.withColumn("n", F.coalesce(F.array_max(F.transform("v", rank)), F.lit(0)))
    left = F.filter("v", lambda t, i: i >= F.col("n"))
    random = F.transform(left, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    # not deterministic for the optimizer: a filter on the spans then stays above them, else the battery would run for it again
    more = F.when((F.size("v") > 0) & (F.monotonically_increasing_id() >= 0), random).otherwise(none())
    return out.withColumn("spans", F.sort_array(F.concat("base", more)))


def with_spans(
    docs: DataFrame,
    text_col: str = "text",
    min_token: int = MIN_TOKEN,
    false_discovery: float = FALSE_DISCOVERY,
    base_as: str = "secret_base",
    spans_as: str = "secret_spans",
) -> DataFrame:
    """``docs`` with arrays of (start, kind, end), ordered, of every whole text: the base's, and all; kind counts KINDS from 0.

    Null texts are empty. Random tokens that overlap a base span aren't added. Rows are kept as they are: repeated ones
    get equal spans. A column of ``docs`` named like an output is kept with ``_input`` behind its name; no
    other is touched. No rows: no rows. Work on a text grows with its matches to the power of 1.5.
    """
    inner, names, back = shielded(docs, [base_as, spans_as])
    out = scanned(inner, names[text_col], min_token, false_discovery)
    return out.select(*back, F.col("base").alias(base_as), F.col("spans").alias(spans_as))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(kinds, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redacted(
    docs: DataFrame,
    text_col: str = "text",
    mark: str = "[SECRET]",
    min_token: int = MIN_TOKEN,
    false_discovery: float = FALSE_DISCOVERY,
) -> DataFrame:
    """``docs`` whose spans are replaced by ``mark``, overlapping ones by one; other texts, null too, stay as they are.

    All columns stay, whatever their names; a text that isn't a string becomes one. No rows: no rows.
    """
    inner, names, back = shielded(docs, [])
    out = scanned(inner, names[text_col], min_token, false_discovery)
    # a span is cut out from where those before it end; one that starts before that is part of their cut
    out = with_running(out, "before", "spans", "end", F.greatest)
    piece = lambda s, b: F.concat(F.col("t").substr(b + 1, s["start"] - b), F.lit(mark))
    apart = lambda s, b: F.when(s["start"] >= b, piece(s, b)).otherwise(F.lit(""))
    out = out.withColumn("cut", F.array_join(F.zip_with("spans", "before", apart), ""))
    last = F.array_max(F.transform("spans", lambda s: s["end"]))
    clean = F.concat("cut", F.col("t").substr(last + 1, F.length("t")))
    text = F.when(F.size("spans") > 0, clean).otherwise(F.col(names[text_col]).cast("string"))
    return out.select(*(text.alias(c) if c == text_col else b for c, b in zip(docs.columns, back, strict=True)))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` scanned; the digest columns of the contract."""
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("secret_base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(listed("secret_base").cast("binary"), 256).alias("base_sha256"), listed("secret_spans").alias("spans"))
