"""Chat formatting by tool-call linking, in DataFrame functions only.

Messages become items: a call (a tool call in an assistant's JSON message, or a user's request), a result (a tool
message, or the assistant's reply, which answers the message before it) or context (system messages and the
rest). Calls and results meet in a hash join by conversation and identifier. Arguments are checked against the
tool's schema, a JSON Schema with the keywords type, enum, const, minimum, maximum, exclusiveMinimum, exclusiveMaximum,
minLength, maxLength, pattern, properties, required, additionalProperties (a boolean), items, minItems and maxItems, at any
depth, and notBlank (a text with something but blanks); every reference {"$ref": id} in them must name a call of the conversation. Items are ordered so that
each call stands after the calls it refers to: by time, and where a reference runs against time the call is moved
behind what it needs. Everything is serialised as canonical JSON (keys sorted at every depth, no blanks).

Messages understood:
  assistant  {"tool_calls": [{"id": .., "name": .., "arguments": {..}}, ..]} (also {"function": {"name", "arguments"}})
  tool       {"tool_call_id": .., "content": ..}
  user       any other text: call c<turn> of the tool `reply` with {"prompt": text, "after": {"$ref": c<turn-2>}}
  assistant  any other text: result of c<turn-1>

Defined cases: a null text is an empty one, a null role is context, a null turn counts as -1, null conversation ids
are one conversation; later calls or results with an identifier that is taken are `duplicate` and link to nothing;
results without a call are `orphan`, calls without a result `unanswered`, a result before its call `early`;
arguments that are not JSON are an error; calls that are on a cycle of references or refer to one, over however many
calls, are `cyclic` and keep their place; repeated rows are duplicates of each other by place (equal places share one status); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.llm.common import load, materialize

#: tool -> the schema of its arguments
SCHEMAS = {
    "reply": {
        "type": "object", "required": ["prompt"], "additionalProperties": False,
        "properties": {"prompt": {"type": "string", "notBlank": True}, "after": {"type": "object"}},
    }
}
MAX_ROUNDS = 24  # a name that tests set; rounds go on until none settles a call
BLOCK_TURNS = 1024  # positions are counted in blocks of so many turns, so that no task holds a conversation
_STEP = 1 << 20  # places between two turns

_CALLS = "array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>"


def references(arguments: Column) -> Column:
    """The strings under "$ref" anywhere in JSON text, read from its canonical form, so that escapes make no difference."""
    canonical = F.to_json(F.try_parse_json(F.when(arguments.contains("ref"), arguments)))
    found = F.regexp_extract_all(F.coalesce(canonical, F.lit("")), F.lit(r'"\$ref":("(?:[^"\\]|\\.)+")'), F.lit(1))
    return F.when(F.size(found) == 0, F.array().cast("array<string>")).otherwise(F.from_json(F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")), "array<string>"))


def items_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, idx, kind, call_id, name, arguments, content, refs), a row per call, result or context."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long"))
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    src = messages.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(-(2**63))).alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    is_object = F.col("text").startswith("{")
    listed = F.when((F.col("role") == "assistant") & is_object, F.from_json(F.get_json_object("text", "$.tool_calls"), _CALLS))
    answered = F.when((F.col("role") == "tool") & is_object, F.get_json_object("text", "$.tool_call_id"))
    src = src.withColumn("listed", listed).withColumn("answered", answered)
    none = F.lit(None).cast("string")

    def item(kind: str, call_id: Column, name: Column, arguments: Column, content: Column, refs: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), call_id.alias("call_id"), name.alias("name"), arguments.alias("arguments"),
            content.alias("content"), refs.alias("refs"),
        )

    no_refs = F.array().cast("array<string>")
    calls = F.transform(
        "listed",
        lambda c: item(
            "call", c["id"], F.coalesce(c["name"], c["function"]["name"]), F.coalesce(c["arguments"], c["function"]["arguments"]), none,
            references(F.coalesce(c["arguments"], c["function"]["arguments"])),
        ),
    )
    before = F.when(F.col("turn") >= 2, F.concat(F.lit("c"), (F.col("turn") - 2).cast("string")))
    arguments = F.to_json(F.struct(F.when(before.isNotNull(), F.struct(before.alias("$ref"))).alias("after"), F.col("text").alias("prompt")))
    asked = item("call", F.concat(F.lit("c"), F.col("turn").cast("string")), F.lit("reply"), arguments, none, F.when(before.isNotNull(), F.array(before)).otherwise(no_refs))
    replied = item("result", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")), none, none, F.col("text"), no_refs)
    returned = item("result", F.col("answered"), none, none, F.coalesce(F.get_json_object("text", "$.content"), F.lit("")), no_refs)
    context = item("context", none, none, none, F.col("text"), no_refs)
    found = (
        F.when(F.size("listed") > 0, calls)
        .when(F.col("answered").isNotNull(), F.array(returned))
        .when(F.col("role") == "user", F.array(asked))
        .when(F.col("role") == "assistant", F.array(replied))
        .otherwise(F.array(context))
    )
    return src.select("conv_id", "turn", F.posexplode(found).alias("idx", "item")).select("conv_id", "turn", "idx", "item.*")


_KINDS = {
    "string": lambda v, got: got == "STRING", "boolean": lambda v, got: got == "BOOLEAN", "null": lambda v, got: got == "VOID",
    "object": lambda v, got: got.startswith("OBJECT"), "array": lambda v, got: got.startswith("ARRAY"), "number": lambda v, got: _is_number(got),
    "integer": lambda v, got: _is_number(got) & (F.try_variant_get(v, "$", "double") == F.floor(F.try_variant_get(v, "$", "double"))),
}
_LIMITS = {
    "minimum": (lambda x, y: x < y, "under"), "maximum": (lambda x, y: x > y, "over"),
    "exclusiveMinimum": (lambda x, y: x <= y, "not over"), "exclusiveMaximum": (lambda x, y: x >= y, "not under"),
}


def _is_number(got: Column) -> Column:
    return got.startswith("DECIMAL") | got.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _violations(v: Column, schema: dict, path: str) -> list[Column]:
    """Texts (null: none) of what is wrong with a variant that is there; path: its name in them."""
    here = path or "arguments"
    unknown = set(schema) - {"type", "enum", "const", "notBlank", "minLength", "maxLength", "pattern", "properties", "required", "additionalProperties", "items", "minItems", "maxItems", *_LIMITS}
    if unknown - {"description", "title", "default"}:
        raise ValueError(f"unknown schema keywords {sorted(unknown)}")
    got, found = F.schema_of_variant(v), []

    def say(wrong: Column, text: str) -> None:
        found.append(F.when(wrong, F.lit(f"{here} is {text}")))

    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        fits = F.lit(False)
        for kind in kinds:
            fits = fits | _KINDS[kind](v, got)
        say(~fits, "not " + " or ".join(kinds))
    for key in ("enum", "const"):
        if key in schema:
            allowed = schema[key] if key == "enum" else [schema[key]]
            say(~F.to_json(v).isin(*[_canonical(x) for x in allowed]), "not one of " + " ".join(_canonical(x) for x in allowed))
    number = F.when(_is_number(got), F.try_variant_get(v, "$", "double"))
    for key, (wrong, text) in _LIMITS.items():
        if key in schema:
            say(wrong(number, F.lit(float(schema[key]))), f"{text} {schema[key]}")
    string = F.when(got == "STRING", F.try_variant_get(v, "$", "string"))
    if schema.get("notBlank"):
        say(F.trim(string) == "", "blank")
    if "minLength" in schema:
        say(F.length(string) < schema["minLength"], f"shorter than {schema['minLength']}")
    if "maxLength" in schema:
        say(F.length(string) > schema["maxLength"], f"longer than {schema['maxLength']}")
    if "pattern" in schema:
        say(~string.rlike(schema["pattern"]), f"not like {schema['pattern']}")
    inside = lambda name: f"{path}.{name}" if path else name
    is_object = got.startswith("OBJECT")
    properties = schema.get("properties", {})
    for name in dict.fromkeys([*properties, *schema.get("required", [])]):
        quote = next((q for q in "'\"" if q not in name), None)
        if quote is None or "\\" in name:
            raise ValueError(f"a field named {name}")
        child = F.try_variant_get(F.when(is_object, v), f"$[{quote}{name}{quote}]", "variant")
        if name in schema.get("required", []):
            found.append(F.when(is_object & (child.isNull() | (F.schema_of_variant(child) == "VOID")), F.lit(f"{inside(name)} is missing")))
        if properties.get(name):
            there = child.isNotNull()
            if "null" not in properties[name].get("type", ""):
                there &= F.schema_of_variant(child) != "VOID"  # a null is a field that is not there
            found += [F.when(there, x) for x in _violations(child, properties[name], inside(name))]
    if schema.get("additionalProperties") is False:
        extra = F.array_except(F.json_object_keys(F.when(is_object, F.to_json(v))), F.array(*[F.lit(f) for f in properties]).cast("array<string>"))
        extra = F.array_join(F.transform(F.array_sort(extra), lambda x: F.concat(F.lit(f"{path}." if path else ""), x)), " ")
        found.append(F.when(F.length(extra) > 0, F.concat(F.lit("unknown field "), extra)))
    elements = F.when(got.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
    if "minItems" in schema:
        say(F.size(elements) < schema["minItems"], f"of fewer than {schema['minItems']} items")
    if "maxItems" in schema:
        say(F.size(elements) > schema["maxItems"], f"of more than {schema['maxItems']} items")
    if schema.get("items"):
        texts = F.transform(elements, lambda x: F.concat_ws("; ", *_violations(x, schema["items"], f"{path}[]")))
        found.append(F.nullif(F.array_join(F.array_distinct(F.filter(texts, lambda x: x != "")), "; "), F.lit("")))
    return found


def schema_errors(name: Column, parsed: Column, schemas: dict) -> Column:
    """Text of all violations, empty if there are none."""
    found = [F.when(parsed.isNull(), F.lit("arguments are not JSON"))]
    found.append(F.when(~F.coalesce(name, F.lit("")).isin(*schemas), F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null")))))
    for tool, schema in schemas.items():
        mine = (name == tool) & parsed.isNotNull()
        found += [F.when(mine, x) for x in _violations(parsed, schema, "")]
    return F.concat_ws("; ", *found)


def _settle(edges: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """edges: conv_id, call_id, place, dep_id, dep_place of resolved references. Places of calls that had to move
    behind a later dependency, and the calls that no order can satisfy. Without references against time (the rule)
    nothing runs but the test for them."""
    late = edges.filter(F.col("place") <= F.col("dep_place"))
    if late.isEmpty():
        return None, None
    touched = late.select("conv_id").distinct()
    mine = edges.join(touched, "conv_id", "left_semi")
    key = ["conv_id", "call_id"]
    # a row per call and open dependency (null: none): the call stands at `at` or behind, and `hop` behind dep_id
    start = mine.groupBy(*key).agg(F.max("place").alias("own"))
    callers = start.select("conv_id", F.col("call_id").alias("dep_id"), F.lit(True).alias("moves"))
    open_dep = F.when(F.col("moves"), F.col("dep_id"))
    at = F.greatest("own", F.when(F.col("moves").isNull(), F.col("dep_place") + 1))
    rows = mine.join(start, key).join(callers, ["conv_id", "dep_id"], "left")
    rows = rows.select(*key, at.alias("at"), open_dep.alias("dep_id"), F.lit(1).cast("long").alias("hop")).distinct()
    rows = materialize(rows, "chat-edges")
    waiting = F.col("dep_id").isNotNull()
    longest = before = rows.filter(waiting).select(*key).distinct().count()
    while before:
        # a settled dependency is folded into `at`; one that waits for a single call is replaced by that call, so chains
        # halve each round; a hop longer than all calls together goes around a cycle and is left as it is
        state = rows.groupBy(*key).agg(F.max("at").alias("d_at"), F.count_distinct("dep_id").alias("n"), F.max("dep_id").alias("next"), F.max("hop").alias("d_hop"))
        state = state.withColumnRenamed("call_id", "dep_id")
        jump = (F.col("n") == 1) & (F.col("hop") + F.col("d_hop") <= longest)
        known = (F.col("n") == 0) | jump
        rows = rows.join(state, ["conv_id", "dep_id"], "left").select(
            *key,
            F.when(known, F.greatest("at", F.col("d_at") + F.col("hop"))).otherwise(F.col("at")).alias("at"),
            F.when(F.col("n") == 0, None).when(jump, F.col("next")).otherwise(F.col("dep_id")).alias("dep_id"),
            F.when(F.col("n") == 0, 0).when(jump, F.col("hop") + F.col("d_hop")).otherwise(F.col("hop")).cast("long").alias("hop"),
        )
        rows = rows.groupBy(*key, "dep_id").agg(F.max("at").alias("at"), F.max("hop").alias("hop")).select(*key, "at", "dep_id", "hop")
        rows = materialize(rows, "chat-edges")
        left = rows.filter(waiting).select(*key).distinct().count()
        if left == before:
            break
        before = left
    ends = rows.groupBy(*key).agg(F.max("at").alias("moved_to"), F.count("dep_id").alias("n"))
    places = ends.filter("n = 0").select(*key, "moved_to")
    cyclic = ends.filter("n > 0").select(*key, F.lit(True).alias("is_cyclic"))
    return places, cyclic


def link_tool_calls(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """A row per item: conv_id, turn, idx, kind, call_id, peer_turn, status, errors, place, position (from 0, in
    topological order within the conversation) and canonical (JSON; a call's holds its result)."""
    schemas = SCHEMAS if schemas is None else schemas
    items = items_of(messages)
    at = F.struct("turn", "idx")
    key = ["conv_id", "call_id"]
    place = F.col("turn") * _STEP + F.col("idx")
    named = items.filter(F.col("call_id").isNotNull() & F.col("kind").isin("call", "result"))
    ends = named.groupBy(*key).agg(
        F.min(F.when(F.col("kind") == "call", at)).alias("call_at"), F.min(F.when(F.col("kind") == "result", F.struct("turn", "idx", "content"))).alias("result_at")
    )
    calls = ends.filter("call_at is not null")
    edges = items.filter((F.col("kind") == "call") & F.col("call_id").isNotNull()).select("conv_id", "call_id", place.alias("place"), F.explode(F.array_distinct("refs")).alias("dep_id"))
    known = calls.select("conv_id", F.col("call_id").alias("dep_id"), (F.col("call_at.turn") * _STEP + F.col("call_at.idx")).alias("dep_place"))
    edges = materialize(edges.join(known, ["conv_id", "dep_id"], "left").select("conv_id", "call_id", "place", "dep_id", "dep_place"), "chat-refs")
    dangling = edges.filter("dep_place is null").groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set("dep_id")), " ").alias("dangling"))
    places, cyclic = _settle(edges.filter("dep_place is not null"))
    ends = ends.join(dangling, key, "left")
    ends = ends.join(places, key, "left") if places is not None else ends.withColumn("moved_to", F.lit(None).cast("long"))
    ends = ends.join(cyclic, key, "left") if cyclic is not None else ends.withColumn("is_cyclic", F.lit(None).cast("boolean"))
    # items without an identifier meet nothing; a salt keeps them from meeting in one task
    zero = F.pmod(F.xxhash64("call_id"), F.lit(1).cast("long"))
    salted = items.withColumn("salt", F.when(F.col("call_id").isNull(), F.xxhash64("turn", "idx", "content")).otherwise(zero))
    rows = salted.join(ends.withColumn("salt", zero), [*key, "salt"], "left").drop("salt").withColumn("place", place)

    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    result_at = F.struct(F.col("result_at.turn").alias("turn"), F.col("result_at.idx").alias("idx"))
    first = F.when(is_call, F.col("call_at") == at).when(is_result, result_at == at)
    linked = F.col("call_at").isNotNull() & F.col("result_at").isNotNull() & F.col("call_id").isNotNull()
    status = (
        F.when(F.col("kind") == "context", "context")
        .when(F.col("call_id").isNull(), "unnamed")
        .when(~first, "duplicate")
        .when(is_call & F.coalesce(F.col("is_cyclic"), F.lit(False)), "cyclic")
        .when(linked & (F.col("result_at.turn") < F.col("call_at.turn")), "early")
        .when(linked, "linked")
        .when(is_call, "unanswered")
        .otherwise("orphan")
    )
    rows = rows.withColumn("status", status).withColumn("parsed", F.try_parse_json("arguments"))
    answered = F.col("status") == "linked"
    rows = rows.withColumn("peer_turn", F.when(answered, F.when(is_call, F.col("result_at.turn")).otherwise(F.col("call_at.turn"))))
    errors = F.when(
        is_call,
        F.concat_ws("; ", F.nullif(schema_errors(F.col("name"), F.col("parsed"), schemas), F.lit("")), F.when(F.col("dangling").isNotNull(), F.concat(F.lit("no call "), F.col("dangling")))),
    ).otherwise("")
    rows = rows.withColumn("errors", errors)
    # a result stands behind its call, wherever that moved
    own = F.when(is_result & answered & F.col("moved_to").isNotNull(), F.greatest("place", F.col("moved_to") + 1)).otherwise(F.coalesce(F.when(is_call, F.col("moved_to")), F.col("place")))
    rows = rows.withColumn("place", own)
    canonical = (
        F.when(
            is_call,
            F.to_json(F.struct(F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), F.lit("call").alias("kind"), "name", F.when(answered, F.col("result_at.content")).alias("result"))),
        )
        .when(is_result, F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("kind"))))
        .otherwise(F.to_json(F.struct("content", F.lit("context").alias("kind"))))
    )
    rows = rows.withColumn("block", F.floor(F.col("place") / (_STEP * BLOCK_TURNS)).cast("long")).withColumn("canonical", canonical)
    per_block = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    per_block = per_block.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_block = W.partitionBy("conv_id", "block").orderBy("place", "turn", "idx", "kind", "canonical")
    rows = rows.withColumn("nth", F.row_number().over(in_block) - 1).join(per_block, ["conv_id", "block"])
    return rows.select(
        F.nullif("conv_id", F.lit(-(2**63))).alias("conv_id"), F.nullif("turn", F.lit(-1)).alias("turn"), F.col("idx").cast("int").alias("idx"), "kind", "call_id",
        "peer_turn", "status", "errors", (F.col("base") + F.col("nth")).cast("long").alias("position"), "canonical",
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(load(spark, sf_dir, "conversations"))


SQL = r"""
    with m as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    ), i as (
        select *, case role when 'user' then 'call' when 'assistant' then 'result' else 'context' end as kind,
               case role when 'user' then 'c' || turn when 'assistant' then 'c' || (turn - 1) end as call_id
        from m
    ), l as (
        select i.*, p.turn as peer_turn, p.text as peer_text,
               case when i.kind = 'call' and i.turn >= 2 and not exists
                    (select 1 from i d where d.kind = 'call' and d.conv_id = i.conv_id and d.turn = i.turn - 2)
                    then 'no call c' || (i.turn - 2) end as dangling
        from i left join i p on i.conv_id = p.conv_id and i.call_id = p.call_id and i.kind <> p.kind
    )
    select conv_id, turn, cast(0 as integer) as idx, kind, call_id, peer_turn,
           case when kind = 'context' then 'context' when peer_turn is not null then 'linked'
                when kind = 'call' then 'unanswered' else 'orphan' end as status,
           concat_ws('; ', case when kind = 'call' and trim(text) = '' then 'prompt is blank' end, dangling) as errors,
           row_number() over (partition by conv_id order by turn) - 1 as position,
           case kind
             when 'call' then '{"arguments":{'
               || case when turn >= 2 then '"after":{"$ref":"c' || (turn - 2) || '"},' else '' end
               || '"prompt":' || cast(to_json(text) as varchar) || '},"id":"' || call_id || '","kind":"call","name":"reply"'
               || case when peer_turn is not null then ',"result":' || cast(to_json(peer_text) as varchar) else '' end || '}'
             when 'result' then '{"content":' || cast(to_json(text) as varchar) || ',"id":"' || call_id || '","kind":"result"}'
             else '{"content":' || cast(to_json(text) as varchar) || ',"kind":"context"}' end as canonical
    from l
"""
