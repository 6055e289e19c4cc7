"""Tool calls in conversations: link calls and results, order them, validate, serialise.

Everything here is DataFrame and SQL functions. A message of role ``assistant`` whose text is a
JSON object with an array ``tool_calls`` makes calls, each with ``id``, ``name`` and ``arguments``
(an object, or a string that holds one). A message of role ``tool`` whose text is a JSON object
with a string ``tool_call_id`` is a result. All others are plain messages. An argument value
``"$result:ID"`` says that the call needs the result of call ID of its conversation.

``link`` gives one row per call, result and plain message:

* ``status`` of a call: ``linked``, ``unanswered``, or ``duplicate`` (its id was used before in the
  conversation); of a result: ``linked``, ``orphan`` (no such call), or ``duplicate`` (an earlier
  result answers the call); of a message: ``plain``.
* ``level``: the topological order. A call that needs nothing has 0, another one more than the
  greatest level of the calls it needs; a result has its call's level, and a plain message 0. It is
  null where the order doesn't exist: for cycles, needed calls that are missing or unanswered, and
  whatever follows those. Rows sort by level, then calls before results, then turn.
* ``errors``: what the arguments break in the tool's schema, sorted; for an unknown tool
  ``unknown tool``, for arguments that aren't an object ``not an object``. Of JSON Schema these rules
  are known, for the arguments themselves and not for what is nested in them: ``type`` (a name or
  several), ``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``minLength``,
  ``maxLength``, ``minItems``, ``maxItems``, ``enum``, ``required`` and ``additionalProperties`` (true
  or false). Any other rule, nested ones included, gives ``unsupported rule NAME`` for each argument
  that it is meant for, so nothing passes unchecked; an argument's first broken rule is given alone.
* ``canonical``: JSON with sorted keys and no blanks.

Joins are by conversation and id; no group is gathered into one row or task. Levels are found in
rounds, each written to the shared folder.

Results in odd cases: a null conversation id is a conversation of its own; a null turn sorts last;
text that is null, empty or not such JSON is a plain message; repeated rows make duplicates. Empty
tables give no rows; an empty table of tools makes every tool unknown. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import materialize, release

RULES = "STRUCT<type: STRING, minimum: DOUBLE, maximum: DOUBLE, exclusiveMinimum: DOUBLE, exclusiveMaximum: DOUBLE, minLength: BIGINT, maxLength: BIGINT, minItems: BIGINT, maxItems: BIGINT, enum: ARRAY<STRING>>"
SCHEMA = f"STRUCT<properties: MAP<STRING, {RULES}>, required: ARRAY<STRING>, additionalProperties: BOOLEAN>"
#: The same text with all its names, to find rules that aren't known.
NAMES = "STRUCT<properties: MAP<STRING, MAP<STRING, STRING>>>"
KNOWN = ("type", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "minItems", "maxItems", "enum")
#: Names that describe and don't restrict.
REMARKS = ("title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$comment", "$schema", "$id")
_LAST = 2**62


def _object(text: Column) -> Column:
    parsed = F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def _parsed(messages: DataFrame) -> DataFrame:
    text, role = F.col("text"), F.col("role")
    mark = (role == "assistant") & text.contains('"tool_calls"') | (role == "tool") & text.contains('"tool_call_id"')
    return messages.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("\x00")).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_LAST)).alias("at"),
        _object(F.when(mark, text)).alias("body"),
    )


def parse_calls(messages: DataFrame) -> DataFrame:
    """One row per call: id, name, canonical arguments, and the ids of the calls it needs."""
    rows = _parsed(messages).where(F.col("role") == "assistant")
    items = F.try_variant_get("body", "$.tool_calls", "array<variant>")
    found = rows.select("conv_id", "turn", "conv", "at", F.posexplode(items).alias("pos", "call"))
    raw = F.try_variant_get("call", "$.arguments", "variant")
    as_text = F.try_variant_get("call", "$.arguments", "string")
    kind = F.schema_of_variant(raw)
    args = F.when(kind == "STRING", F.try_parse_json(as_text)).otherwise(raw)
    return found.select(
        "conv_id", "turn", "conv", "at", "pos",
        F.try_variant_get("call", "$.id", "string").alias("call_id"),
        F.try_variant_get("call", "$.name", "string").alias("name"),
        args.alias("args"),
    ).withColumn("arguments", F.to_json("args")).withColumn("needs", F.array_distinct(F.coalesce(F.regexp_extract_all("arguments", F.lit('"\\$result:([^"\\\\]+)"'), F.lit(1)), F.array().cast("array<string>"))))


def parse_results(messages: DataFrame) -> DataFrame:
    rows = _parsed(messages).where(F.col("role") == "tool")
    return rows.select(
        "conv_id", "turn", "conv", "at",
        F.try_variant_get("body", "$.tool_call_id", "string").alias("call_id"),
        F.to_json(F.try_variant_get("body", "$.content", "variant")).alias("content"),
    ).where(F.col("call_id").isNotNull())


def plain_messages(messages: DataFrame) -> DataFrame:
    rows = _parsed(messages)
    calls = F.when(F.col("role") == "assistant", F.size(F.try_variant_get("body", "$.tool_calls", "array<variant>")) > 0)
    result = F.when(F.col("role") == "tool", F.try_variant_get("body", "$.tool_call_id", "string").isNotNull())
    return rows.where(~F.coalesce(calls, result, F.lit(False)))


def validate(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """``calls`` with ``errors``. tools: name, schema (JSON Schema of an object, as text)."""
    none = F.array().cast("array<string>")
    one = tools.groupBy("name").agg(F.min("schema").alias("text"))
    names = F.from_json("text", NAMES)["properties"]
    foreign = lambda found, *known: F.array_sort(F.array_except(F.coalesce(F.map_keys(found), none), F.array(*[F.lit(k) for k in (*known, *REMARKS)])))
    top = foreign(F.from_json("text", "MAP<STRING, STRING>"), "type", "properties", "required", "additionalProperties")
    schema = F.from_json("text", SCHEMA)
    loose = F.when(schema["additionalProperties"].isNull() & F.get_json_object("text", "$.additionalProperties").isNotNull(), F.array(F.lit("additionalProperties"))).otherwise(none)
    known = one.select(
        F.col("name").alias("tool"),
        schema.alias("schema"),
        F.transform(F.concat(top, loose), lambda r: F.concat(F.lit("unsupported rule "), r)).alias("unchecked"),
        F.transform_values(F.coalesce(names, F.create_map().cast("map<string,map<string,string>>")), lambda _, rules: foreign(rules, *KNOWN)).alias("foreign"),
    )
    kind = F.schema_of_variant("args")
    given = F.when(kind.startswith("OBJECT"), F.try_variant_get("args", "$", "map<string,variant>"))
    properties = F.coalesce(F.col("schema.properties"), F.create_map().cast(f"map<string,{RULES}>"))
    missing = F.transform(F.array_except(F.coalesce("schema.required", none), F.map_keys("given")), lambda p: F.concat(p, F.lit(": missing")))

    def broken(entry: Column) -> Column:
        """The first rule that an argument breaks, or that isn't known, or null."""
        value, rule, unknown = entry["value"], F.element_at(properties, entry["key"]), F.element_at("foreign", entry["key"])
        t = F.schema_of_variant(value)
        number = F.try_variant_get(value, "$", "double")
        text = F.try_variant_get(value, "$", "string")
        items = F.size(F.try_variant_get(value, "$", "array<variant>"))
        whole = (t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$")
        numeric = whole | t.startswith("DECIMAL") | (t == "DOUBLE") | (t == "FLOAT")
        kinds = F.when(rule["type"].startswith("["), F.from_json(rule["type"], "array<string>")).otherwise(F.array(rule["type"]))
        tests = {"integer": whole, "number": numeric, "string": t == "STRING", "boolean": t == "BOOLEAN", "array": t.startswith("ARRAY"), "object": t.startswith("OBJECT"), "null": t == "VOID"}
        fits = F.lit(False)
        for name, test in tests.items():
            fits |= F.array_contains(kinds, name) & test
        fits = rule["type"].isNull() | F.coalesce(fits, F.lit(False)) | ~F.arrays_overlap(kinds, F.array(*[F.lit(name) for name in tests]))
        say = lambda what: F.concat(entry["key"], F.lit(f": {what}"))
        return (
            F.when(rule.isNull() & (F.col("schema.additionalProperties") == False), say("unexpected"))  # noqa: E712
            .when(~fits, say("wrong type"))
            .when(numeric & ((number < rule["minimum"]) | (number <= rule["exclusiveMinimum"])), say("too small"))
            .when(numeric & ((number > rule["maximum"]) | (number >= rule["exclusiveMaximum"])), say("too large"))
            .when((t == "STRING") & (F.length(text) < rule["minLength"]), say("too short"))
            .when((t == "STRING") & (F.length(text) > rule["maxLength"]), say("too long"))
            .when(t.startswith("ARRAY") & (items < rule["minItems"]), say("too few"))
            .when(t.startswith("ARRAY") & (items > rule["maxItems"]), say("too many"))
            .when((F.size(rule["enum"]) > 0) & ~F.array_contains(rule["enum"], F.coalesce(text, F.lit(""))), say("not allowed"))
            .when(F.size(unknown) > 0, F.concat(say("unsupported rule "), F.array_join(unknown, ", ")))
        )

    checked = F.array_sort(F.concat(missing, "unchecked", F.filter(F.transform(F.map_entries("given"), broken), lambda x: x.isNotNull())))
    errors = F.when(F.col("tool").isNull(), F.array(F.lit("unknown tool"))).when(F.col("given").isNull(), F.array(F.lit("not an object"))).otherwise(checked)
    return calls.join(known, calls["name"] == known["tool"], "left").withColumn("given", given).withColumn("errors", errors).drop("tool", "schema", "unchecked", "foreign", "given")


def levels(calls: DataFrame, answered: DataFrame) -> DataFrame:
    """(conv, call_id, level) of the calls whose order exists. answered: (conv, call_id) with a result.

    Calls that need one other form chains; each learns where its chain ends, and how far off that
    is, by pointer jumping, so a chain of n calls takes log(n) rounds. Chains end at calls that
    need nothing, at calls that need several, whose levels then take one round per layer of such
    calls, or nowhere.
    """
    needs = calls.select("conv", "call_id", F.explode("needs").alias("need")).join(answered.select("conv", F.col("call_id").alias("need"), F.lit(1).alias("has")), ["conv", "need"], "left")
    possible = needs.groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("wanted"), F.count("has").alias("met"), F.min("need").alias("need"))
    kinds = calls.select("conv", "call_id").join(possible, ["conv", "call_id"], "left")
    kind = F.when(F.col("wanted").isNull(), "first").when(F.col("met") < F.col("wanted"), "dead").when(F.col("wanted") == 1, "one").otherwise("many")
    start = kinds.withColumn("kind", kind).select(
        "conv", "call_id", "kind",
        F.when(F.col("kind") == "one", F.col("need")).otherwise(F.col("call_id")).alias("end"),
        F.when(F.col("kind") == "one", 1).otherwise(0).alias("off"),
        (F.col("kind") != "one").alias("closed"),
    )
    reach = materialize(start, "tool-chains")
    open_before = -1
    while (still := reach.where("not closed").count()) not in (0, open_before):  # what no round closes runs in a circle
        open_before = still
        ahead = reach.select("conv", F.col("call_id").alias("end"), F.col("end").alias("next"), F.col("off").alias("more"), F.col("closed").alias("ends"))
        jumped = reach.where("not closed").join(ahead, ["conv", "end"]).select("conv", "call_id", "kind", F.col("next").alias("end"), (F.col("off") + F.col("more")).alias("off"), F.col("ends").alias("closed"))
        last, reach = reach, materialize(reach.where("closed").unionByName(jumped), "tool-chains")
        release(last)
    ends = reach.where("closed").join(reach.select("conv", F.col("call_id").alias("end"), F.col("kind").alias("end_kind")), ["conv", "end"])
    ends = ends.select("conv", "call_id", "kind", "end", "off", "end_kind")
    many = ends.where("kind = 'many'").select("conv", "call_id")
    placed = calls.select("conv", "call_id").limit(0).withColumn("level", F.lit(0))
    if not many.isEmpty():
        targets = ends.select("conv", F.col("call_id").alias("need"), "end", "off", "end_kind")
        edges = materialize(needs.select("conv", "call_id", "need").join(many, ["conv", "call_id"]).join(targets, ["conv", "need"], "left").select("conv", "call_id", "end", "off", "end_kind"), "tool-joins")
        placed = materialize(placed, "tool-levels")
        while True:
            known = edges.join(placed.select("conv", F.col("call_id").alias("end"), "level"), ["conv", "end"], "left")
            need_level = F.when(F.col("end_kind") == "first", F.col("off")).when(F.col("end_kind") == "many", F.col("level") + F.col("off"))
            ready = known.groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("all"), F.count(need_level).alias("have"), (F.max(need_level) + 1).alias("level")).where("have = all").select("conv", "call_id", "level")
            now = materialize(ready, "tool-levels")
            if now.count() == placed.count():
                break
            last, placed = placed, now
            release(last)
    base = placed.select("conv", F.col("call_id").alias("end"), F.col("level").alias("base"))
    level = F.when(F.col("end_kind") == "first", F.col("off")).when(F.col("end_kind") == "many", F.col("base") + F.col("off"))
    return ends.join(base, ["conv", "end"], "left").select("conv", "call_id", level.alias("level")).where("level IS NOT NULL")


def link(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """See the module's description."""
    calls = validate(parse_calls(messages), tools)
    results = parse_results(messages)
    key = ["conv", "call_id"]
    first_call = calls.where(F.col("call_id").isNotNull()).groupBy(*key).agg(F.min(F.struct("at", "pos")).alias("first"))
    first_result = results.groupBy(*key).agg(F.min("at").alias("answer_at"), F.count(F.lit(1)).alias("answers"))
    answered = first_call.join(first_result, key).select(*key)
    unique = calls.join(first_call, key).where((F.col("at") == F.col("first.at")) & (F.col("pos") == F.col("first.pos"))).dropDuplicates(key)
    order = levels(unique, answered)

    made = calls.join(first_call, key, "left").join(first_result, key, "left").join(order, key, "left")
    own = (F.col("at") == F.col("first.at")) & (F.col("pos") == F.col("first.pos"))
    call_status = F.when(F.col("call_id").isNull() | F.col("answer_at").isNull() & own, "unanswered").when(own, "linked").otherwise("duplicate")
    options = {"ignoreNullFields": "false"}
    call_rows = made.select(
        "conv_id", "turn", "pos", F.lit("call").alias("kind"), "call_id", call_status.alias("status"),
        F.when(own | F.col("call_id").isNull() & (F.size("needs") == 0), F.coalesce("level", F.when(F.col("call_id").isNull(), 0))).alias("level"), "errors",
        F.to_json(F.struct("args", F.col("call_id").alias("id"), "name", F.lit("call").alias("type")).alias("x"), options).alias("canonical"),
    )
    got = results.join(first_call, key, "left").join(first_result, key, "left").join(order, key, "left")
    answers = F.when(F.col("first").isNull(), "orphan").when(F.col("at") == F.col("answer_at"), "linked").otherwise("duplicate")
    result_rows = got.select(
        "conv_id", "turn", F.lit(0).alias("pos"), F.lit("result").alias("kind"), "call_id", answers.alias("status"),
        F.when(answers == "linked", F.col("level")).alias("level"), F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.try_parse_json("content").alias("content"), F.col("call_id").alias("id"), F.lit("result").alias("type")), options).alias("canonical"),
    )
    message_rows = plain_messages(messages).select(
        "conv_id", "turn", F.lit(0).alias("pos"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit("plain").alias("status"),
        F.lit(0).alias("level"), F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("text").alias("content"), "role", F.lit("message").alias("type")), options).alias("canonical"),
    )
    return call_rows.unionByName(result_rows).unionByName(message_rows)
