"""Chat formatting: tool calls linked with their results, ordered, validated and written as canonical JSON.

Everything is Spark expressions and hash joins on call ids, which are unique, so that no
conversation gathers in a task. Order is topological: pointer doubling along chains of calls with one need, and Kahn's
rounds over the calls with several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_by_hot_key, table, written

#: JSON type names and how Spark names such a variant's type.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY", "null": "VOID"}


def canonical(json: Column) -> Column:
    """The same value with keys in order and no white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def faults(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments, as an array of texts in the order of the schema; empty if nothing.

    A schema: {"properties": {key: {"type", "minimum", "maximum", "minLength", "maxLength", "enum"}}, "required":
    [key], "additionalProperties": bool}. An unknown tool and text that isn't a JSON object are faults.
    """
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    out = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        checks = []
        for key, rule in schema.get("properties", {}).items():
            path = f"$['{key}']"
            at = F.try_variant_get(value, path, "variant")
            there = at.isNotNull()
            if key in schema.get("required", []):
                checks.append(F.when(~there, F.lit(f"{key}: missing")))
            bad = lambda test, what, there=there, key=key: F.when(there & ~F.coalesce(test, F.lit(False)), F.lit(f"{key}: {what}"))
            if "type" in rule:
                checks.append(bad(F.schema_of_variant(at).rlike(f"^({TYPES[rule['type']]})"), "type"))
            number, text = F.try_variant_get(value, path, "double"), F.try_variant_get(value, path, "string")
            if "minimum" in rule:
                checks.append(bad(number >= rule["minimum"], "minimum"))
            if "maximum" in rule:
                checks.append(bad(number <= rule["maximum"], "maximum"))
            if "minLength" in rule:
                checks.append(bad(F.length(text) >= rule["minLength"], "minLength"))
            if "maxLength" in rule:
                checks.append(bad(F.length(text) <= rule["maxLength"], "maxLength"))
            if "enum" in rule:
                checks.append(bad(text.isin(rule["enum"]), "enum"))
        if schema.get("additionalProperties", True) is False:
            keys = F.json_object_keys(arguments)
            extra = F.array_except(keys, F.array(*map(F.lit, schema.get("properties", {}))))
            checks.append(F.when(F.size(extra) > 0, F.lit("additional properties")))
        found = F.filter(F.array(*checks).cast("array<string>"), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        out = F.when(name == tool, found).otherwise(out)
    return F.when(kind.startswith("OBJECT"), out).otherwise(F.array(F.lit("not an object")))


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(call_id, level): 0 for calls without needs, else one more than the highest of its needs; null on and behind cycles.

    needs: (call_id, needed). Needs of or for ids that aren't among the calls are left out; repeated ones count once.

    Calls with one need form chains: pointer doubling finds where each chain starts, in as many rounds as the length
    of the longest has bits. Kahn's rounds then go over the calls with several needs alone.
    """
    ids = written(calls.select("call_id").where("call_id IS NOT NULL").distinct(), "calls-ids")
    edges = written(needs.select("call_id", "needed").distinct().join(ids, "call_id", "left_semi").join(ids.select(F.col("call_id").alias("needed")), "needed", "left_semi"), "calls-needs")
    degree = written(edges.groupBy("call_id").agg(F.count("*").alias("left"), F.min("needed").alias("at")), "calls-degree")
    roots = ids.join(degree, "call_id", "left_anti").select("call_id", F.lit(0).cast("long").alias("level"))
    single = degree.where("left = 1").select("call_id", "at")
    # done: the call that is pointed at has no need or several
    chained = single.select(F.col("call_id").alias("at"), F.lit(True).alias("more"))
    links = written(single.join(chained, "at", "left").select("call_id", "at", F.lit(1).cast("long").alias("steps"), F.col("more").isNull().alias("done")), "calls-links")
    # a pointer that is open after this many rounds runs in a cycle
    for _ in range(links.count().bit_length()):
        if not links.where("NOT done").head(1):
            break
        ahead = links.select(F.col("call_id").alias("at"), F.col("at").alias("to"), F.col("steps").alias("further"), F.col("done").alias("ends"))
        moved = links.where("NOT done").join(ahead, "at").select("call_id", F.col("to").alias("at"), (F.col("steps") + F.col("further")).alias("steps"), F.col("ends").alias("done"))
        links = written(links.where("done").unionByName(moved), "calls-links")
    waiting = written(degree.where("left > 1").select("call_id", "left", F.lit(0).cast("long").alias("best")), "calls-waiting")
    # a need on or behind a cycle stays counted and is never placed
    starts = links.select(F.col("call_id").alias("needed"), F.when(F.col("done"), F.col("at")).alias("start"), "steps", F.lit(True).alias("chain"))
    joins = edges.join(waiting, "call_id", "left_semi").join(starts, "needed", "left")
    joins = written(joins.select("call_id", F.when(F.col("chain"), F.col("start")).otherwise(F.col("needed")).alias("start"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")), "calls-joins")
    now, placed = roots, roots
    while waiting.head(1) and now.head(1):
        done = joins.join(now.select(F.col("call_id").alias("start"), "level"), "start").groupBy("call_id").agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("steps")).alias("high"))
        step = written(waiting.join(done, "call_id", "left").select("call_id", (F.col("left") - F.coalesce("met", F.lit(0))).alias("left"), F.greatest("best", "high").alias("best")), "calls-step")
        now, waiting = step.where("left = 0").select("call_id", F.col("best").alias("level")), step.where("left > 0")
        placed = placed.unionByName(now)
    behind = links.where("done").join(placed.select(F.col("call_id").alias("at"), "level"), "at").select("call_id", (F.col("level") + F.col("steps")).alias("level"))
    return ids.join(placed.unionByName(behind), "call_id", "left").select("call_id", F.col("level").cast("int").alias("level"))


def link(calls: DataFrame, results: DataFrame, needs: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row for each call and each result.

    calls: (conv_id, call_id, seq, name, arguments); results: (conv_id, call_id, seq, content); needs: (call_id,
    needed). Other columns are ignored.

    kind (call or result), status (call: answered, unanswered or repeated; result: linked, orphan or repeated), level
    (a result's: its call's), valid, faults, message (canonical JSON). Of several calls with one id the first by (conv_id, seq,
    name, arguments) counts, of several results the first by (conv_id, seq, content); others are repeated, and of equal rows
    all but one. Null ids link with nothing. Null arguments are not an object. Empty tables give no rows.

    Equal rows are folded and counted before they are joined, and unfolded last. An id that many different rows hold meets its
    call and result by a bounded broadcast.
    """
    key = ["conv_id", "call_id", "seq", "name", "arguments", "content"]
    absent = F.lit(None).cast("string")
    own = calls.select("conv_id", "call_id", "seq", "name", "arguments", absent.alias("content"), F.lit(True).alias("is_call"))
    back = results.select("conv_id", "call_id", "seq", absent.alias("name"), absent.alias("arguments"), "content", F.lit(False).alias("is_call"))
    rows = written(own.unionByName(back).groupBy(*key, "is_call").agg(F.count("*").alias("copies")), "calls-rows")
    least = F.struct("conv_id", "seq", "name", "arguments", "content")
    # the first call and the first result of each id, and the call's level: a row for each id
    first = lambda call: F.min(F.when(F.col("is_call") == F.lit(call), least))
    known = rows.where("call_id IS NOT NULL").groupBy("call_id").agg(first(True).alias("call"), first(False).alias("result"))
    order = levels(rows.where("is_call").select("call_id"), needs)
    about = written(known.join(order, "call_id", "left"), "calls-about")
    out = join_by_hot_key(rows, about, "call_id")
    called, answered = F.col("call").isNotNull(), F.col("result").isNotNull()
    mine = F.when(F.col("is_call"), least == F.col("call")).otherwise(least == F.col("result"))
    mine = F.col("call_id").isNull() | mine
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    shown = out.withColumn("copy", F.explode(copies)).withColumn("first", mine & ((F.col("copy") == 1) | F.col("call_id").isNull()))
    wrong = faults(F.col("name"), F.col("arguments"), schemas)
    arguments = F.coalesce(canonical(F.col("arguments")), _quoted("arguments"))
    call_json = _object(type=F.lit('"tool_call"'), id=_quoted("call_id"), name=_quoted("name"), arguments=arguments)
    result_json = _object(type=F.lit('"tool_result"'), id=_quoted("call_id"), content=_quoted("content"))
    call_status = F.when(~F.col("first"), "repeated").when(answered, "answered").otherwise("unanswered")
    result_status = F.when(~called, "orphan").when(~F.col("first"), "repeated").otherwise("linked")
    is_call = F.col("is_call")
    shown = shown.withColumn("wrong", F.when(is_call, wrong).otherwise(F.array().cast("array<string>")))
    return shown.select(
        "conv_id",
        "call_id",
        "seq",
        F.when(is_call, "call").otherwise("result").alias("kind"),
        F.when(is_call, call_status).otherwise(result_status).alias("status"),
        F.when(is_call | called, F.col("level")).alias("level"),
        F.when(is_call, F.size("wrong") == 0).otherwise(called).alias("valid"),
        F.array_join("wrong", "; ").alias("faults"),
        F.when(is_call, call_json).otherwise(result_json).alias("message"),
    )


def _object(**values: Column) -> Column:
    """A canonical JSON object of JSON values."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in values.items()]
    return canonical(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))


def _quoted(name: str) -> Column:
    """A column's text as a JSON string; null as null."""
    return F.coalesce(F.get(F.regexp_extract_all(F.to_json(F.struct(F.col(name).cast("string").alias("x"))), F.lit(r"(?s)^\{\"x\":(.*)\}$"), F.lit(1)), F.lit(0)), F.lit("null"))


#: Tools of the query below: a user's turn asks, a system's turn instructs.
SCHEMAS = {
    "ask": {"properties": {"chars": {"type": "integer", "minimum": 1}, "text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}, "required": ["chars", "text", "turn"], "additionalProperties": False},
    "instruct": {"properties": {"chars": {"type": "integer", "minimum": 1}, "text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0, "maximum": 0}}, "required": ["chars", "text", "turn"], "additionalProperties": False},
}


def op9_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``, which have no tool calls of their own, read as such.

    A user's or system's turn is a call with id conv:turn of the tool ``ask`` or ``instruct``, and needs the call two turns
    (for the first after a system's turn: one turn) before; an assistant's turn is the result of the call one turn before.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    name = lambda shift: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - shift).cast("string"))
    asked = turns.where("role <> 'assistant'")
    args = F.to_json(F.struct("text", F.col("turn"), F.length("text").alias("chars")))
    calls = asked.select("conv_id", name(0).alias("call_id"), F.col("turn").alias("seq"), F.when(F.col("role") == "system", "instruct").otherwise("ask").alias("name"), args.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", name(1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    needs = asked.select(name(0).alias("call_id"), name(2).alias("needed")).unionByName(asked.where("turn = 1").select(name(0).alias("call_id"), name(1).alias("needed")))
    out = link(calls, results, needs, SCHEMAS)
    return out.select("conv_id", "call_id", F.col("seq").alias("turn"), "kind", "status", F.col("level").cast("long").alias("level"), "valid", "faults", F.sha2(F.col("message").cast("binary"), 256).alias("message_sha256"))


OP9_SQL = """
WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, turn, role, text, conv_id || ':' || turn AS call_id FROM t WHERE role <> 'assistant'),
r AS (SELECT conv_id, turn, text, conv_id || ':' || (turn - 1) AS call_id FROM t WHERE role = 'assistant'),
n AS (SELECT a.call_id, b.call_id AS needed FROM c a JOIN c b ON a.conv_id = b.conv_id AND (b.turn = a.turn - 2 OR a.turn = 1 AND b.turn = 0)),
l(call_id, level) AS (SELECT call_id, 0 FROM c UNION ALL SELECT n.call_id, l.level + 1 FROM l JOIN n ON n.needed = l.call_id),
h AS (SELECT call_id, CAST(max(level) AS BIGINT) AS level FROM l GROUP BY 1),
f AS (SELECT *, CASE WHEN length(text) < 1 THEN ['chars: minimum', 'text: minLength'] ELSE [] END || CASE WHEN role = 'system' AND turn > 0 THEN ['turn: maximum'] ELSE [] END AS bad FROM c)
SELECT f.conv_id, f.call_id, f.turn, 'call' AS kind, CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status, h.level, len(bad) = 0 AS valid, array_to_string(bad, '; ') AS faults,
  sha256('{"arguments":{"chars":' || length(f.text) || ',"text":' || to_json(f.text) || ',"turn":' || f.turn || '},"id":"' || f.call_id || '","name":"' || CASE WHEN f.role = 'system' THEN 'instruct' ELSE 'ask' END || '","type":"tool_call"}') AS message_sha256
FROM f JOIN h ON h.call_id = f.call_id LEFT JOIN r ON r.call_id = f.call_id
UNION ALL
SELECT r.conv_id, r.call_id, r.turn, 'result', CASE WHEN h.call_id IS NULL THEN 'orphan' ELSE 'linked' END, h.level, h.call_id IS NOT NULL, '',
  sha256('{"content":' || to_json(r.text) || ',"id":"' || r.call_id || '","type":"tool_result"}')
FROM r LEFT JOIN h ON h.call_id = r.call_id
"""
