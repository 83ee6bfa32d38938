"""Tool-call linking and canonical formatting, in DataFrame functions only.

Calls and results are hash-joined by conversation and call identifier. Calls are put in topological order: a
call's generation is its distance from the start of its chain of parent calls, found by pointer
doubling, so the rounds grow with the logarithm of the longest chain. Arguments are parsed as JSON values and
validated against the tool's parameter schemas. Each linked call becomes one canonical JSON text: keys sorted, no
blanks. One row per call, never a whole conversation in one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch, word_count

LINKED, NO_RESULT, NO_CALL = "linked", "no result", "no call"
# fixed values: JSON schema types, and how Spark names the kinds of JSON values they take
TYPES = {
    "string": "^STRING$",
    "integer": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*$",
    "object": "^OBJECT.*$",
    "null": "^VOID$",
}
SCHEMA_COLUMNS = "name string, param string, type string, required boolean, minimum double, maximum double"


def generations(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, call_id, generation`` of the distinct calls ``(conv_id, call_id, parent_id)``.

    A call without parent, or whose parent is no call of its conversation, has generation 0; others one more
    than their parent. Calls on or behind a cycle of parents have null.
    """
    ids = calls.select("conv_id", F.col("call_id").alias("parent_id"))
    known = calls.join(ids, ["conv_id", "parent_id"], "left_semi")
    first = calls.select("conv_id", "call_id").join(known.select("conv_id", "call_id", F.col("parent_id").alias("up")),
                                                    ["conv_id", "call_id"], "left")
    state = scratch.table(first.withColumn("far", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint")))
    left, total = 1, state.count()
    reach = 1
    while left and reach <= 2 * total:
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"))
        watch = Observation()
        step = (state.join(above, ["conv_id", "up"], "left")
                .select("conv_id", "call_id", F.col("up2").alias("up"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"))
                .observe(watch, F.count("up").alias("open")))
        fresh = scratch.table(step)
        scratch.drop(state)
        state, left, reach = fresh, watch.get["open"], reach * 2
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("far")).alias("generation"))


def argument_errors(arguments: Column, params: Column) -> Column:
    """Sorted errors of an arguments value (variant, null if no JSON) against
    ``params`` (array of struct of ``SCHEMA_COLUMNS`` but name; null for an unknown tool)."""
    is_object = F.schema_of_variant(arguments).startswith("OBJECT")
    fields = F.when(is_object, arguments.cast("map<string,variant>"))
    empty = F.array().cast("array<string>")

    def kind(p):
        return F.schema_of_variant(F.element_at(fields, p["param"]))

    def fits(p):
        ok = F.lit(False)
        for name, pattern in TYPES.items():
            ok = ok | ((p["type"] == name) & kind(p).rlike(pattern))
        return ok

    def number(p):
        numeric = kind(p).rlike(TYPES["number"])
        return F.when(numeric, F.element_at(fields, p["param"]).cast("double"))

    def there(p):
        return F.map_contains_key(fields, p["param"])

    missing = F.transform(F.filter(params, lambda p: p["required"] & ~there(p)), lambda p: F.concat(F.lit("missing "), p["param"]))
    unknown = F.transform(F.filter(F.map_keys(fields), lambda k: ~F.exists(params, lambda p: p["param"] == k)),
                          lambda k: F.concat(F.lit("unknown "), k))
    wrong = F.transform(F.filter(params, lambda p: there(p) & ~F.coalesce(fits(p), F.lit(False))),
                        lambda p: F.concat(F.lit("not "), p["type"], F.lit(" "), p["param"]))
    outside = F.transform(F.filter(params, lambda p: there(p) & F.coalesce((number(p) < p["minimum"]) | (number(p) > p["maximum"]), F.lit(False))),
                          lambda p: F.concat(F.lit("out of range "), p["param"]))
    found = F.array_sort(F.concat(missing, unknown, wrong, outside))
    return (F.when(params.isNull(), F.array(F.lit("unknown tool")))
            .when(arguments.isNull(), F.array(F.lit("arguments are not JSON")))
            .when(~is_object, F.array(F.lit("arguments are no object")))
            .otherwise(F.coalesce(found, empty)))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without call.

    ``calls``: ``conv_id, call_id, parent_id, turn, name, arguments`` (JSON text); ``results``: ``conv_id, call_id, turn,
    content``; ``schemas``: ``SCHEMA_COLUMNS``. Other columns are not read, whatever their names. Result: ``conv_id, call_id,
    generation, turn, name, status, result_turn, valid, errors`` (comma between) and ``json``. In each conversation
    ``generation, turn, call_id`` is a topological order: a call comes after the call it refers to.

    Calls that repeat an identifier are one call, the one first by turn and text; so are results (the first by turn and
    text answers). A null identifier links nothing; such calls and results stay, unlinked, each row for itself. Null or
    malformed arguments and tools without schema are errors, not failures. Null contents are JSON null. Calls in a
    cycle of parents have a null generation and the error ``cycle``. Empty tables give no rows.
    """
    scratch = Scratch(calls.sparkSession, "tools")
    names = ["conv_id", "call_id", "parent_id", "turn", "name", "arguments"]
    calls = calls.select(*names)
    results = results.select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content")
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one_call = (calls.where(whole).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("c"))
                .select("conv_id", "call_id", "c.*"))
    one_call = scratch.table(one_call)
    one_result = (results.where(whole).groupBy("conv_id", "call_id").agg(F.min(F.struct("result_turn", "content")).alias("r"))
                  .select("conv_id", "call_id", "r.*", F.lit(True).alias("has_result")))
    order = scratch.table(generations(one_call.select("conv_id", "call_id", "parent_id"), scratch))
    called = one_call.join(order, ["conv_id", "call_id"]).withColumn("has_call", F.lit(True)).drop("parent_id")
    loose = (calls.where(~whole).drop("parent_id").withColumn("generation", F.lit(0).cast("bigint")).withColumn("has_call", F.lit(True)))
    linked = (called.join(one_result, ["conv_id", "call_id"], "full_outer")
              .unionByName(loose, allowMissingColumns=True)
              .unionByName(results.where(~whole).withColumn("has_result", F.lit(True)), allowMissingColumns=True))
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("param", "type", "required", "minimum", "maximum"))).alias("params"))
    rows = linked.join(tools, "name", "left").withColumn("args", F.try_parse_json("arguments"))
    errors = F.when(F.col("has_call").isNull(), F.array().cast("array<string>")).otherwise(
        F.concat(argument_errors(F.col("args"), F.col("params")),
                 F.when(F.col("generation").isNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>"))))
    status = (F.when(F.col("has_call").isNull(), NO_CALL).when(F.col("has_result").isNull(), NO_RESULT).otherwise(LINKED))
    told = rows.withColumn("errs", errors).withColumn("status", status)
    # fields in order of their names; an arguments value writes its own keys sorted
    record = F.struct(F.col("args").alias("arguments"), "call_id", "name", F.col("content").alias("result"), "status")
    return told.select("conv_id", "call_id", "generation", "turn", "name", "status", "result_turn",
                       (F.size("errs") == 0).alias("valid"), F.array_join("errs", ",").alias("errors"),
                       F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))


# parameters of the tools that the conversations' user turns are read as calls of
CONVERSATION_SCHEMAS = [
    ("lookup", "key", "string", True, None, None),
    ("search", "query", "string", True, None, None),
    ("search", "limit", "integer", True, 1.0, 40.0),
    ("summarize", "text", "string", True, None, None),
    ("summarize", "words", "integer", True, 1.0, 200.0),
    ("summarize", "style", "string", False, None, None),
]
SHORT, LONG = 80, 400


def conversation_calls(turns: DataFrame) -> DataFrame:
    """User turns as calls: the tool by the text's length, the text in the arguments, the conversation's
    call two turns before as parent."""
    size, text = F.length("text"), F.coalesce("text", F.lit(""))
    words = word_count(F.col("text"))
    name = F.when(size < SHORT, "lookup").when(size < LONG, "search").otherwise("summarize")
    arguments = (F.when(size < SHORT, F.to_json(F.struct(text.alias("key"))))
                 .when(size < LONG, F.to_json(F.struct(text.alias("query"), words.alias("limit"))))
                 .otherwise(F.to_json(F.struct(words.alias("words"), text.alias("text")))))
    return turns.where("role = 'user'").select(
        "conv_id", F.concat_ws("-", "conv_id", "turn").alias("call_id"),
        F.concat_ws("-", F.col("conv_id"), F.col("turn") - 2).alias("parent_id"), "turn", name.alias("name"), arguments.alias("arguments"))


def conversation_results(turns: DataFrame) -> DataFrame:
    """Assistant turns as results of the call one turn before."""
    return turns.where("role = 'assistant'").select(
        "conv_id", F.concat_ws("-", F.col("conv_id"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))


def conversation_schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONVERSATION_SCHEMAS, SCHEMA_COLUMNS)


# the same over ``conversations``, whose calls and results are unique: a chain of parents ends where a turn two
# before is no user turn
CONVERSATION_SQL = f"""
WITH RECURSIVE u AS (
  SELECT conv_id, turn, text, length(text) AS size,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM conversations WHERE role = 'user'),
g AS (
  SELECT conv_id, turn, 0::BIGINT AS generation FROM u WHERE NOT EXISTS (
    SELECT 1 FROM u p WHERE p.conv_id = u.conv_id AND p.turn = u.turn - 2)
  UNION ALL
  SELECT u.conv_id, u.turn, g.generation + 1 FROM g JOIN u ON u.conv_id = g.conv_id AND u.turn = g.turn + 2),
c AS (
  SELECT u.conv_id, u.conv_id || '-' || u.turn AS call_id, g.generation, u.turn,
         CASE WHEN size < {SHORT} THEN 'lookup' WHEN size < {LONG} THEN 'search' ELSE 'summarize' END AS name,
         CASE WHEN size < {SHORT} THEN '{{"key":' || to_json(text) || '}}'
              WHEN size < {LONG} THEN '{{"limit":' || words || ',"query":' || to_json(text) || '}}'
              ELSE '{{"text":' || to_json(text) || ',"words":' || words || '}}' END AS args,
         CASE WHEN size < {SHORT} THEN ''
              WHEN size < {LONG} THEN CASE WHEN words BETWEEN 1 AND 40 THEN '' ELSE 'out of range limit' END
              ELSE CASE WHEN words BETWEEN 1 AND 200 THEN '' ELSE 'out of range words' END END AS errors
  FROM u JOIN g USING (conv_id, turn)),
r AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn AS result_turn, text FROM conversations WHERE role = 'assistant')
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, generation, turn, name,
       CASE WHEN c.call_id IS NULL THEN '{NO_CALL}' WHEN r.call_id IS NULL THEN '{NO_RESULT}' ELSE '{LINKED}' END AS status,
       result_turn, coalesce(errors, '') = '' AS valid, coalesce(errors, '') AS errors,
       '{{"arguments":' || coalesce(args, 'null') || ',"call_id":' || to_json(coalesce(c.call_id, r.call_id)) ||
       ',"name":' || coalesce(to_json(name), 'null') || ',"result":' || coalesce(to_json(r.text), 'null') || ',"status":"' ||
       CASE WHEN c.call_id IS NULL THEN '{NO_CALL}' WHEN r.call_id IS NULL THEN '{NO_RESULT}' ELSE '{LINKED}' END || '"}}' AS json
FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id"""
