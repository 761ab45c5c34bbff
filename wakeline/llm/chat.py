"""Chat formatting with tool-call linking, in DataFrame operations only.

Assistant messages may carry tool calls and tool messages carry results, both as JSON text. Calls and results are
hash-joined by (conversation, identifier). A call whose arguments name another call's
identifier (``{"$ref": "id"}``) depends on it. Levels: chains of calls that need one other each are shortened by pointer
jumping, in as many rounds as the logarithm of their length; calls that need several are peeled off, a round for each of them
that lies on the longest way. Arguments are checked against schema rows, and each message
is written as canonical JSON (sorted keys, no blanks). The order of a conversation's messages is the pair
(level, turn), as columns: no conversation is ever gathered into one group, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import materialize

# A call names its tool and arguments itself or in a nested object ``function``.
CALLS = ("struct<tool_calls:array<struct<id:string,name:string,arguments:string,"
         "function:struct<name:string,arguments:string>>>,content:string>")
# Of a call: different messages may share a conversation and turn, or lack them.
KEY = ["conv_id", "turn", "message", "place"]
RESULT = "struct<tool_call_id:string,content:string>"
TYPES = ("string", "integer", "number", "boolean", "object", "array")


def canonical(json: Column) -> Column:
    """Canonical JSON of a JSON text: keys sorted, no blanks. Null if it is not valid JSON."""
    return F.to_json(F.try_parse_json(json))


def _type_of(value: Column) -> Column:
    """JSON type of a value's JSON text."""
    return (F.when(value.rlike(r'^"'), "string").when(value.rlike(r"^-?[0-9]+$"), "integer")
            .when(value.rlike(r"^-?[0-9]"), "number").when(value.isin("true", "false"), "boolean")
            .when(value.startswith("{"), "object").when(value.startswith("["), "array").otherwise("null"))


def _same(a: str, b: str, columns: list[str]) -> list[Column]:
    """Equal in all columns of the aliases ``a`` and ``b``; nulls are equal."""
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns]


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, message, place, call_id, name, arguments) of every tool call in assistant messages.

    ``message`` is a hash of the message's text, so ``KEY`` is a call's own.

    A text that is not an object with tool_calls has none. A call without an id cannot be linked and is kept with
    a null call_id. If an id is called twice in a conversation, the first call (by turn, place,
    message) owns it.
    """
    parsed = messages.filter("role = 'assistant'").select(
        "conv_id", "turn", F.sha1("text").alias("message"),
        F.posexplode(F.from_json("text", CALLS)["tool_calls"]).alias("place", "call"))
    either = lambda f: F.coalesce(f"call.{f}", f"call.function.{f}").alias(f)
    return parsed.select(*KEY, F.col("call.id").alias("call_id"), either("name"), either("arguments")).distinct()


def results_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, message, call_id, json) of every tool message; ``json`` is its canonical form.

    Content that is JSON stays JSON; a text that cannot be read as one JSON value keeps its content as a string.
    """
    parsed = messages.filter("role = 'tool'").select("conv_id", "turn", F.sha1("text").alias("message"), F.from_json("text", RESULT).alias("r"),
                                                     F.try_variant_get(F.try_parse_json("text"), "$.content", "variant").alias("v"))
    as_text = F.to_json(F.struct(F.col("r.content").alias("content"), F.lit("tool").alias("role"), F.col("r.tool_call_id").alias("tool_call_id")),
                        {"ignoreNullFields": "false"})
    as_json = F.to_json(F.struct(F.col("v").alias("content"), F.lit("tool").alias("role"), F.col("r.tool_call_id").alias("tool_call_id")),
                        {"ignoreNullFields": "false"})
    return parsed.select("conv_id", "turn", "message", F.col("r.tool_call_id").alias("call_id"),
                         F.when(F.col("v").isNull(), as_text).otherwise(as_json).alias("json")).distinct()


def _answers(results: DataFrame, owners: DataFrame) -> DataFrame:
    """(conv_id, call_id, answer_turn, answer): the result that answers a call, the first (by turn, then text) that does not come before it."""
    own = owners.select("conv_id", "call_id", F.col("turn").alias("_asked"))
    fit = results.filter("conv_id is not null and call_id is not null").join(own, ["conv_id", "call_id"]).filter(
        ~F.coalesce(F.col("turn") < F.col("_asked"), F.lit(False)))
    return fit.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "message")).alias("_a")).select(
        "conv_id", "call_id", F.col("_a.turn").alias("answer_turn"), F.col("_a.message").alias("answer"))


def _owners(calls: DataFrame) -> DataFrame:
    """The call that owns each id: first by turn, then by place, then by message."""
    named = calls.filter("conv_id is not null and call_id is not null")
    order = F.struct("turn", "place", "message")
    return named.groupBy("conv_id", "call_id").agg(F.min(order).alias("_o")).select(
        "conv_id", "call_id", "_o.turn", "_o.place", "_o.message")


def references(calls: DataFrame, by: list[str] = ("conv_id", "call_id")) -> DataFrame:
    """(conv_id, call_id, needs): ids named by ``$ref`` anywhere in a call's arguments; with other columns of the call in ``by``."""
    found = F.regexp_extract_all("arguments", F.lit(r'"\$ref"\s*:\s*"([^"\\]+)"'), 1)
    return (calls.filter("conv_id is not null and call_id is not null")
            .select(*by, F.explode(found).alias("needs")).distinct())


def _jumped(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, top, dist) of the calls that need one other: the first call up their chain that does not need exactly
    one, and the way to it. Calls whose chain is a cycle, or runs into one, keep a top within it."""
    counted = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("needs").alias("top"))
    jumps = materialize(counted.filter("n = 1").select("conv_id", "call_id", "top", F.lit(1).cast("long").alias("dist")))
    # A chain has no more calls than there are, so what is open after that many doublings is cyclic.
    for _ in range(jumps.count().bit_length()):
        ahead = jumps.select("conv_id", F.col("call_id").alias("top"), F.col("top").alias("_top"), F.col("dist").alias("_dist"))
        jumps = materialize(jumps.join(ahead, ["conv_id", "top"], "left").select(
            "conv_id", "call_id", F.coalesce("_top", "top").alias("top"),
            (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"), F.col("_top").isNotNull().alias("open")))
        if jumps.filter("open").isEmpty():
            break
        jumps = jumps.drop("open")
    return jumps.select("conv_id", "call_id", "top", "dist")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 for calls that need no other, else one more than the highest they need.

    References to unknown ids are ignored here (``argument_errors`` names them). Calls on a cycle, or that need one, get a null
    level.
    """
    owners = materialize(_owners(calls).select("conv_id", "call_id"))
    known = owners.withColumnRenamed("call_id", "needs")
    edges = materialize(references(calls).join(known, ["conv_id", "needs"], "left_semi"))
    jumps = materialize(_jumped(edges))
    done = materialize(owners.join(edges, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0).cast("long")))
    # What calls with several needs wait for: the ends of the chains they need, each so many steps away.
    chain = jumps.select("conv_id", F.col("call_id").alias("needs"), "top", "dist")
    waits = (edges.join(jumps, ["conv_id", "call_id"], "left_anti").join(chain, ["conv_id", "needs"], "left")
             .select("conv_id", "call_id", F.coalesce("top", "needs").alias("top"),
                     (F.lit(1) + F.coalesce("dist", F.lit(0))).alias("dist"), F.lit(None).cast("long").alias("level")))
    waits, newest = materialize(waits), done
    while not waits.isEmpty():
        ends = newest.select("conv_id", F.col("call_id").alias("top"), F.col("level").alias("_level"))
        waits = materialize(waits.join(ends, ["conv_id", "top"], "left").select(
            "conv_id", "call_id", "top", "dist", F.coalesce("level", F.col("_level") + F.col("dist")).alias("level")))
        newest = materialize(waits.groupBy("conv_id", "call_id").agg(F.max("level").alias("level"), F.count("*").alias("n"),
                                                                     F.count("level").alias("k"))
                             .filter("n = k").select("conv_id", "call_id", "level"))
        if newest.isEmpty():
            break
        done = done.unionByName(newest)
        waits = waits.join(newest.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
    ends = done.select("conv_id", F.col("call_id").alias("top"), "level")
    chained = jumps.join(ends, ["conv_id", "top"]).select("conv_id", "call_id", (F.col("level") + F.col("dist")).alias("level"))
    return owners.join(done.unionByName(chained), ["conv_id", "call_id"], "left").withColumn("level", F.col("level").cast("int"))


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, message, place, errors): why a call's arguments do not fit its tool's schema.

    ``schemas`` has rows (name, param, type, required). Errors: ``unknown tool``, ``not an object``,
    ``missing <param>``, ``unknown <param>``, ``type <param>``, and ``reference <id>`` where no call of the conversation has that id; sorted,
    empty if the call is valid. A ``$ref`` object fits any type. Calls without a conversation or an id have no checked references.
    """
    # from_json to a map keeps nested values as JSON text; strings lose their quotes, so they are marked.
    arguments = canonical(F.col("arguments"))
    value = lambda k: F.to_json(F.try_variant_get(F.try_parse_json("arguments"), F.lit("$"), "map<string,variant>")[k])
    rows = calls.select(*KEY, "name", "arguments", arguments.alias("_json"))
    rows = rows.withColumn("_object", F.col("_json").startswith("{"))
    keys = F.when(F.col("_object"), F.json_object_keys("_json"))
    given = (rows.filter("_object").select(*KEY, "name", F.col("arguments"), F.explode(keys).alias("param"))
             .withColumn("_value", value(F.col("param"))).drop("arguments"))
    tool = schemas.select("name", F.lit(True).alias("_tool")).distinct()
    wrong_tool = rows.join(tool, "name", "left_anti").select(*KEY, F.lit("unknown tool").alias("error"))
    known = rows.join(tool, "name", "left_semi")
    no_object = known.filter(~F.coalesce("_object", F.lit(False))).select(*KEY, F.lit("not an object").alias("error"))
    need = known.filter("_object").select(*KEY, "name").join(schemas.filter("required").select("name", "param"), "name")
    missing = (need.alias("n").join(given.alias("g"), _same("n", "g", KEY + ["param"]), "left_anti")
               .select(*KEY, F.concat(F.lit("missing "), "param").alias("error")))
    typed = given.join(tool, "name", "left_semi").join(schemas.select("name", "param", "type"), ["name", "param"], "left")
    kind = _type_of(F.col("_value"))
    fits = ((kind == F.col("type")) | ((F.col("type") == "number") & (kind == "integer"))
            | F.col("_value").rlike(r'^\{"\$ref":"[^"]*"\}$'))
    wrong = typed.withColumn("error", F.when(F.col("type").isNull(), F.concat(F.lit("unknown "), "param"))
                             .when(~F.coalesce(fits, F.lit(False)), F.concat(F.lit("type "), "param")))
    ids = _owners(calls).select("conv_id", F.col("call_id").alias("needs"))
    dangling = (references(calls, KEY).join(ids, ["conv_id", "needs"], "left_anti")
                .select(*KEY, F.concat(F.lit("reference "), "needs").alias("error")))
    errors = wrong_tool.unionByName(no_object).unionByName(missing).unionByName(dangling).unionByName(
        wrong.filter("error is not null").select(*KEY, "error"))
    # A call has at most its own and its schema's parameters, so this list is bounded by them.
    listed = errors.groupBy(*KEY).agg(F.sort_array(F.collect_set("error")).alias("errors"))
    return (rows.select(*KEY).alias("r").join(listed.alias("l"), _same("r", "l", KEY), "left")
            .select(*[f"r.{c}" for c in KEY], F.coalesce("l.errors", F.array().cast("array<string>")).alias("errors")))


def formatted(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per message, and one per tool call: conv_id, turn, place, kind, call_id, level, linked, valid,
    errors, arguments, json.

    * kind ``call``: linked if a result answers it; level orders it after the calls it needs (null on a cycle). ``arguments`` is
      the text as it came; in the JSON, arguments that cannot be read as JSON (or that repeat a key) stand as that text;
    * kind ``result``: linked if it is the first result, not before the call, of a call in the conversation; level is that call's. Further results for
      one call, and those before it, are not linked;
    * kind ``message``: any other row, and the content of an assistant message that has calls and a content too. Canonical JSON of
      role and text; level and linked are null.
    * Order a conversation by turn, or its calls by (level, turn, place).
    * Exact repeats of a row are one message. Null conv_id links with nothing. Null or empty text: null in the
      JSON, or "". A null turn is before nothing. Columns other than conv_id, turn, role and text are ignored; empty tables give empty results.
    """
    rows = messages.select("conv_id", "turn", "role", "text").distinct()
    calls = materialize(calls_of(rows))
    results = materialize(results_of(rows))
    owners = _owners(calls)
    level = materialize(levels(calls))
    checked = argument_errors(calls, schemas)
    answers = materialize(_answers(results, owners))
    # place is unique within a message, and the messages are distinct, so these are one-to-one.
    c = (calls.alias("c").join(checked.alias("k"), _same("c", "k", KEY))
         .select("c.*", "k.errors").join(answers.select("conv_id", "call_id", F.lit(True).alias("_r")), ["conv_id", "call_id"], "left")
         .join(level, ["conv_id", "call_id"], "left")
         .alias("c").join(owners.withColumn("_own", F.lit(True)).alias("o"), _same("c", "o", ["call_id", *KEY]), "left")
         .select("c.*", "o._own"))
    linked = F.coalesce(F.col("_r") & F.col("_own"), F.lit(False))
    given = F.coalesce(F.try_parse_json("arguments"), F.try_parse_json(F.to_json(F.array("arguments"))).cast("array<variant>")[0])
    call_json = F.to_json(F.struct(given.alias("arguments"), F.col("call_id").alias("id"), F.col("name")))
    call_rows = c.select("conv_id", "turn", "place", F.lit("call").alias("kind"), "call_id", "level", linked.alias("linked"),
                         (F.size("errors") == 0).alias("valid"), "errors", "arguments", call_json.alias("json"))
    no_errors, no_text = F.array().cast("array<string>").alias("errors"), F.lit(None).cast("string").alias("arguments")
    is_answer = F.coalesce(F.col("turn").eqNullSafe(F.col("answer_turn")) & (F.col("message") == F.col("answer")), F.lit(False))
    result_rows = (results.join(answers, ["conv_id", "call_id"], "left").join(level, ["conv_id", "call_id"], "left")
                   .select("conv_id", "turn", F.lit(0).alias("place"), F.lit("result").alias("kind"), "call_id", "level",
                           is_answer.alias("linked"), F.lit(None).cast("boolean").alias("valid"), no_errors, no_text, "json"))
    parsed = F.from_json("text", CALLS)
    with_calls = F.coalesce((F.col("role") == "assistant") & (F.size(parsed["tool_calls"]) > 0), F.lit(False))
    plain = rows.filter(~F.coalesce(F.col("role") == "tool", F.lit(False))).select(
        "conv_id", "turn", "role", F.when(with_calls, parsed["content"]).otherwise(F.col("text")).alias("content"), with_calls.alias("_calls"))
    plain_rows = plain.filter("not _calls or content is not null").select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("boolean").alias("linked"),
        F.lit(None).cast("boolean").alias("valid"), no_errors, no_text,
        F.to_json(F.struct("content", "role"), {"ignoreNullFields": "false"}).alias("json"))
    return call_rows.unionByName(result_rows).unionByName(plain_rows)
