"""Chat formatting: tool-call linking with built-in DataFrame functions only (operator 2, native).

Method: calls and results are joined on their identifier; calls are ordered
topologically by rounds (a call gets its level once every call it depends on
has one); arguments are validated against declared schemas; every call with
its result is serialised as canonical JSON (sorted keys, no white space,
shortest escapes).

Calls and results are combined per identifier before they meet, so repeated
identifiers cannot multiply rows, and no step gathers a conversation in one
task: the order is the column ``topo_level`` (then turn, then identifier).

Defined cases: a null identifier gives no row; of calls that share an identifier the
smallest (name, arguments) one counts, ``n_copies`` tells how many there were and, where they
differ, ``variants`` in the message has each distinct (name, arguments) once; ``result`` in the message is
the text of the result or, where an identifier has several distinct ones, the sorted array of them
(``n_results`` counts all); a result whose identifier has no call is a row of its own with
status ``no_call``, no name, level or errors, and conv_id and turn of the (first) result where
the results have them; a dependency on an unknown call or on the call itself
is listed in ``errors`` and does not delay the order; calls on a cycle, and those
that depend on one, have a null level and status ``cyclic``; a null or ill-typed
argument is an error, as is a name without a schema; empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import Scratch

# The two-character escapes of JSON.
SHORT_ESCAPES = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def json_string(c: Column) -> Column:
    """A text as a canonical JSON string literal (null → ``null``)."""
    table = dict(SHORT_ESCAPES)
    table.update({chr(i): f"\\u{i:04x}" for i in range(32) if chr(i) not in table})
    escaped = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), table.items(), c)
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("null"))


def json_number(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def json_object(fields: dict[str, Column]) -> Column:
    """Object with keys in code-point order; the values are JSON texts already."""
    parts = [F.concat(F.lit(f'"{k}":'), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


# ------------------------------------------------------------------ schemas
def validate(arguments: Column, name: Column, schemas: dict) -> Column:
    """Errors (array of texts) of a ``map<string,string>`` of arguments.

    ``schemas``: tool → {"required": [...], "properties": {argument: {"type": "string" | "integer",
    "minLength": n, "minimum": n}}}.  An argument that the schema does not name is an error too.
    """
    checks = F.array(F.concat(F.lit("no schema for "), F.coalesce(name, F.lit("null"))))
    for tool, schema in sorted(schemas.items()):
        found = []
        for arg, spec in sorted(schema["properties"].items()):
            value = F.try_element_at(arguments, F.lit(arg))
            if arg in schema.get("required", ()):
                found.append(F.when(value.isNull(), F.lit(f"{arg}: missing")))
            if spec["type"] == "integer":
                number = value.try_cast("bigint")
                found.append(F.when(value.isNotNull() & (number.isNull() | ~value.rlike(r"^-?\d+$")),
                                    F.lit(f"{arg}: not an integer")))
                if "minimum" in spec:
                    found.append(F.when(number < spec["minimum"], F.lit(f"{arg}: under {spec['minimum']}")))
            elif "minLength" in spec:
                found.append(F.when(F.length(value) < spec["minLength"],
                                    F.lit(f"{arg}: shorter than {spec['minLength']}")))
        known = F.array(*[F.lit(a) for a in sorted(schema["properties"])])
        extra = F.array_sort(F.array_except(F.map_keys(arguments), known))
        named = F.transform(extra, lambda a: F.concat(a, F.lit(": unknown argument")))
        checks = F.when(name == tool, F.concat(F.array_compact(F.array(*found)), named)).otherwise(checks)
    return checks


# ------------------------------------------------------------------ order
def topological_levels(calls: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """calls(call_id), edges(call_id, needs; distinct, both ends known) → call_id, topo_level.

    One round per level: the calls whose last missing dependency was placed in
    the round before are placed in this one.  Calls on or behind a cycle stay out.
    """
    waits = scratch.cut(edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("left")))
    placed = [scratch.cut(calls.join(waits, "call_id", "left_anti").select("call_id", F.lit(0).alias("topo_level")))]
    while waits.limit(1).count():
        done = (edges.join(placed[-1].select(F.col("call_id").alias("needs")), "needs")
                .groupBy("call_id").agg(F.count(F.lit(1)).alias("met")))
        state = scratch.cut(waits.join(done, "call_id", "left")
                            .withColumn("left", F.col("left") - F.coalesce("met", F.lit(0))).drop("met"))
        now = state.where("left = 0").select("call_id", F.lit(len(placed)).alias("topo_level"))
        if not now.limit(1).count():
            break
        placed.append(now)
        waits = state.where("left > 0")
    return reduce(DataFrame.unionByName, placed)


# ------------------------------------------------------------------ linking
def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """Link, order, validate and serialise tool calls.

    calls: call_id, name, arguments (map<string,string>), depends_on (array<string>), plus optional
    conv_id and turn carried through; results: call_id, content, plus optional conv_id and turn.  Integers are serialised as numbers
    where the schema types them so and the value is one.
    """
    scratch = Scratch(calls.sparkSession, "tool-calls")
    # A map has no order: its sorted entries stand in for it when copies are compared.
    entries = F.array_sort(F.map_entries(F.coalesce("arguments", F.create_map().cast("map<string,string>"))))
    pick = F.min(F.struct("name", entries.alias("entries"), "conv_id", "turn",
                          F.array_sort(F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>"))))
                          .alias("depends_on")))
    one = (calls.where("call_id is not null").groupBy("call_id")
           .agg(pick.alias("c"), F.count(F.lit(1)).alias("n_copies"),
                F.array_sort(F.collect_set(F.struct(F.col("name"), entries.alias("entries")))).alias("variants"))
           .select("call_id", "c.*", "n_copies", "variants")
           .withColumn("arguments", F.map_from_entries("entries")).drop("entries"))
    one = scratch.cut(one)
    # Partial aggregates keep the distinct texts only; a null is one of them.
    place = F.struct(*[(F.col(c) if c in results.columns else F.lit(None)).cast(calls.schema[c].dataType).alias(c)
                       for c in ("conv_id", "turn")])
    answers = scratch.cut(results.where("call_id is not null").groupBy("call_id")
                          .agg(F.array_sort(F.collect_set(json_string(F.col("content")))).alias("texts"),
                               F.count(F.lit(1)).alias("n_results"), F.min(place).alias("place")))
    content = F.when(F.size("texts") > 1, F.concat(F.lit("["), F.array_join("texts", ","), F.lit("]"))).otherwise(
        F.coalesce(F.try_element_at("texts", F.lit(1)), F.lit("null")))

    asked = one.select("call_id", F.explode("depends_on").alias("needs"))
    known = one.select(F.col("call_id").alias("needs"), F.lit(True).alias("known"))
    asked = scratch.cut(asked.join(known, "needs", "left")
                        .withColumn("bad", F.col("known").isNull() | (F.col("needs") == F.col("call_id"))))
    edges = asked.where(~F.col("bad")).select("call_id", "needs")
    dangling = (asked.where("bad").groupBy("call_id")
                .agg(F.array_sort(F.collect_list(F.concat(F.lit("depends_on: unknown "), "needs"))).alias("dangling")))
    levels = topological_levels(one.select("call_id"), edges, scratch)

    df = (one.join(answers, "call_id", "left").join(levels, "call_id", "left").join(dangling, "call_id", "left"))
    errors = F.concat(validate(F.col("arguments"), F.col("name"), schemas),
                      F.coalesce("dangling", F.array().cast("array<string>")))
    df = df.withColumn("errors", F.array_join(errors, "; "))
    status = (F.when(F.col("topo_level").isNull(), F.lit("cyclic"))
              .when(F.col("errors") != "", F.lit("invalid"))
              .when(F.col("n_results").isNull(), F.lit("no_result")).otherwise(F.lit("ok")))
    integers = sorted({f"{t}.{a}" for t, s in schemas.items() for a, p in s["properties"].items()
                       if p["type"] == "integer"})

    def value(name, e):
        number = F.concat(name, F.lit("."), e["key"]).isin(integers) & e["value"].rlike(r"^(0|-?[1-9]\d*)$")
        return F.when(number, e["value"]).otherwise(json_string(e["value"]))

    def args(name, entries):
        return F.concat(F.lit("{"), F.array_join(F.transform(
            entries, lambda e: F.concat(json_string(e["key"]), F.lit(":"), value(name, e))), ","), F.lit("}"))

    variants = F.array_join(F.transform("variants", lambda v: json_object(
        {"arguments": args(v["name"], v["entries"]), "name": json_string(v["name"])})), ",")
    fields = {
        "arguments": args(F.col("name"), F.array_sort(F.map_entries("arguments"))), "id": json_string(F.col("call_id")), "name": json_string(F.col("name")),
        "needs": F.concat(F.lit("["), F.array_join(F.transform("depends_on", json_string), ","), F.lit("]")),
        "result": F.coalesce(content, F.lit("null")), "status": json_string(F.col("status"))}
    several = fields | {"variants": F.concat(F.lit("["), variants, F.lit("]"))}
    message = F.when(F.size("variants") > 1, json_object(several)).otherwise(json_object(fields))
    linked = (df.withColumn("status", status)
              .select("conv_id", "turn", "call_id", "name", "topo_level", "n_copies",
                      F.coalesce("n_results", F.lit(0)).alias("n_results"), "status", "errors",
                      message.alias("message")))
    alone = json_object({"arguments": F.lit("null"), "id": json_string(F.col("call_id")), "name": F.lit("null"),
                         "needs": F.lit("[]"), "result": content, "status": F.lit('"no_call"')})
    orphans = answers.join(one.select("call_id"), "call_id", "left_anti").select(
        "place.conv_id", "place.turn", "call_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("int").alias("topo_level"), F.lit(0).cast("bigint").alias("n_copies"), "n_results",
        F.lit("no_call").alias("status"), F.lit("").alias("errors"), alone.alias("message"))
    return linked.unionByName(orphans)


# ------------------------------------------------------------------ conversations
# Production schemas of the conversation query.
CHAT_SCHEMAS = {
    "ask": {"required": ["conversation", "prompt", "turn"], "properties": {
        "conversation": {"type": "integer", "minimum": 0}, "turn": {"type": "integer", "minimum": 0},
        "prompt": {"type": "string", "minLength": 1}}},
    "configure": {"required": ["conversation", "instructions", "turn"], "properties": {
        "conversation": {"type": "integer", "minimum": 0}, "turn": {"type": "integer", "minimum": 0},
        "instructions": {"type": "string", "minLength": 1}}},
}


def conversation_calls(conv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as tool calls and results.

    A user turn is a call of ``ask`` and a system turn one of ``configure``; its identifier is
    ``conv_id/turn`` and it depends on the conversation's opening turn.  An assistant turn is the
    result of the turn before it.  A turn of any other role is a call of that role's name, which has no schema.
    """
    ident = lambda t: F.concat_ws("/", F.col("conv_id").cast("string"), t.cast("string"))
    text, turn, conv_id = F.col("text"), F.col("turn"), F.col("conv_id")
    keyed = conv.select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    what = F.when(F.col("role") == "user", F.lit("prompt")).otherwise(F.lit("instructions"))
    args = F.map_from_arrays(F.array(F.lit("conversation"), what, F.lit("turn")),
                             F.array(conv_id.cast("string"), text, turn.cast("string")))
    calls = keyed.where("role is distinct from 'assistant'").select(
        "conv_id", "turn", ident(turn).alias("call_id"),
        F.when(F.col("role") == "user", F.lit("ask")).when(F.col("role") == "system", F.lit("configure"))
        .otherwise(F.col("role")).alias("name"),
        args.alias("arguments"),
        F.when(turn > 0, F.array(ident(F.lit(0)))).otherwise(F.array().cast("array<string>")).alias("depends_on"))
    results = keyed.where("role = 'assistant'").select("conv_id", "turn", ident(turn - 1).alias("call_id"),
                                                       text.alias("content"))
    return calls, results


def format_chats(conv: DataFrame, schemas: dict | None = None) -> DataFrame:
    return link_tool_calls(*conversation_calls(conv), schemas or CHAT_SCHEMAS)
