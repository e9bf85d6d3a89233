"""Chat formatting with linked tool calls.

Calls and results are joined by the call's identifier. A call may wait for others (its parents);
calls are put in topological order by depth, the longest way from a call that waits for none. Calls with one parent look past the
ancestor they have seen in every round, up to one that has none or several, so a chain of n calls takes log2(n) joins, and only those
still on the way take part; calls with several parents follow when all of theirs are known. Arguments are JSON:
they are validated against the schemas of their tools, and every message is written as canonical JSON
(keys sorted at every level, no spaces) on a row of its own, so no conversation has to fit in one task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, join_same

#: Tools of the production query: name -> JSON schema of its arguments.
TOOLS = {
    "lookup": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "note": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1}},
        "required": ["text"],
        "additionalProperties": False,
    },
}


def json_string(text: Column) -> Column:
    """A JSON string; null is null."""
    whole = F.to_json(F.struct(text.alias("a")))  # {"a":...}
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """calls (call_id, ...) with result, result_turn and `status`: linked, no-result, or repeated-id.

    A call whose id another call has is repeated-id and takes no result; of several results with an id the one of the least turn counts. A
    null id links with nothing.
    """
    first = results.where("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("_r"))
    ids = calls.where("call_id is not null").groupBy("call_id").agg(F.count("*").alias("_n"))
    both = calls.join(ids, "call_id", "left").join(first, "call_id", "left")
    ok = F.coalesce(F.col("_n") == 1, F.lit(False))
    return both.select(
        *calls.columns,
        F.when(ok, F.col("_r.content")).alias("result"),
        F.when(ok, F.col("_r.turn")).alias("result_turn"),
        F.when(F.col("call_id").isNull(), "no-result").when(~ok, "repeated-id").when(F.col("_r").isNull(), "no-result").otherwise("linked").alias("status"),
    )


def depths(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """call_id and depth (0 without a known parent) of (call_id, parents) rows; null for calls on or behind a cycle.

    Rows that repeat an id wait for the parents of all.
    """
    ids = scratch.table(calls.where("call_id is not null").groupBy("call_id").agg(F.flatten(F.collect_set(F.coalesce("parents", F.array().cast("array<string>")))).alias("parents")), "ids")
    edges = ids.select("call_id", F.explode(F.array_distinct("parents")).alias("up")).join(ids.select(F.col("call_id").alias("up")), "up")
    known = scratch.table(edges.groupBy("call_id").agg(F.count("*").alias("n"), F.min("up").alias("up")), "known")
    edges = scratch.table(edges.join(known.where("n > 1").select("call_id"), "call_id", "left_semi"), "edges")
    single = known.where("n = 1").select("call_id", "up")
    # One parent: (up, dist, done), done where `up` is no such call itself.
    step = scratch.table(single.join(single.select(F.col("call_id").alias("up"), F.lit(False).alias("_end")), "up", "left").select("call_id", "up", F.lit(1).cast("long").alias("dist"), F.coalesce("_end", F.lit(True)).alias("done")), "step0")
    reached, rounds, n = step.where("done"), step.count().bit_length() + 1, 0
    while n < rounds and not step.where("not done").isEmpty():
        n += 1
        far = step.select(F.col("call_id").alias("up"), F.col("up").alias("_up"), F.col("dist").alias("_dist"), F.col("done").alias("_done"))
        moved = step.where("not done").join(far, "up").select("call_id", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_done").alias("done"))
        step = scratch.table(moved.unionByName(step.where("done")), f"step{n}")
        reached = step.where("done")
        scratch.drop(f"step{n - 1}")
    # Several parents: each is so far from a call that has none or several.
    # A round meets only what the one before has settled; what is settled is written once, as a part of `found`.
    ready = scratch.table(ids.select("call_id").join(known.select("call_id"), "call_id", "left_anti").select("call_id", F.lit(0).cast("long").alias("depth")), "found/n=0")
    ways = edges.join(reached.select(F.col("call_id").alias("up"), F.col("up").alias("_up"), "dist"), "up", "left")
    ways = ways.select("call_id", F.coalesce("_up", "up").alias("up"), (F.coalesce("dist", F.lit(0)) + 1).alias("dist"), F.lit(None).cast("long").alias("depth"))
    ways, n = scratch.table(ways, "ways0"), 0
    while not ways.isEmpty() and not ready.isEmpty():  # what is left at the end waits for itself
        n += 1
        new = ways.join(ready.select(F.col("call_id").alias("up"), F.col("depth").alias("_depth")), "up", "left")
        new = scratch.table(new.select("call_id", "up", "dist", F.coalesce("depth", F.col("_depth") + F.col("dist")).alias("depth")), f"met{n}")
        ready = new.groupBy("call_id").agg(F.max("depth").alias("depth"), F.count_if(F.col("depth").isNull()).alias("_wait")).where("_wait = 0").drop("_wait")
        ready = scratch.table(ready, f"found/n={n}")
        ways = scratch.table(new.join(ready.select("call_id"), "call_id", "left_anti"), f"ways{n}")
        scratch.drop(f"ways{n - 1}", f"met{n}")
    found = scratch.read("found", "call_id string, depth long")
    ends = reached.join(found.withColumnRenamed("call_id", "up"), "up").select("call_id", (F.col("depth") + F.col("dist")).alias("depth"))
    return ids.select("call_id").join(found.unionByName(ends), "call_id", "left")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def faults(value: Column, schema: dict, path: str) -> list[Column]:
    """What is wrong with a variant, as columns of text or null: `missing:path`, `bad:path`, and unknown-argument. `value` is there (it may be JSON's null).

    Of JSON schema: type, enum, minimum, maximum, minLength, maxLength, items, minItems, maxItems, properties, required, additionalProperties.
    """
    kind, wrong = schema.get("type"), F.lit(False)
    own = _kind(value)
    if kind == "string":
        text = F.try_variant_get(value, "$", "string")
        wrong = own != "STRING"
        wrong = wrong | (F.length(text) < schema["minLength"]) if "minLength" in schema else wrong
        wrong = wrong | (F.length(text) > schema["maxLength"]) if "maxLength" in schema else wrong
    elif kind in ("integer", "number"):
        number = F.try_variant_get(value, "$", "double")
        wrong = ~own.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        wrong = wrong | (number != F.floor(number)) if kind == "integer" else wrong
        wrong = wrong | (number < float(schema["minimum"])) if "minimum" in schema else wrong
        wrong = wrong | (number > float(schema["maximum"])) if "maximum" in schema else wrong
    elif kind == "boolean":
        wrong = own != "BOOLEAN"
    elif kind == "null":
        wrong = own != "VOID"
    elif kind == "array":
        items = F.try_variant_get(value, "$", "array<variant>")
        wrong = ~own.startswith("ARRAY")
        wrong = wrong | (F.size(items) < schema["minItems"]) if "minItems" in schema else wrong
        wrong = wrong | (F.size(items) > schema["maxItems"]) if "maxItems" in schema else wrong
        if "items" in schema:
            wrong = wrong | F.exists(items, lambda x: F.concat_ws("", *faults(x, schema["items"], "x")) != "")
    elif kind == "object":
        wrong = ~own.startswith("OBJECT")
    if "enum" in schema:
        wrong = wrong | ~F.to_json(value).isin([json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for x in schema["enum"]])
    out = [F.when(F.coalesce(wrong, F.lit(True)), F.lit(f"bad:{path}" if path else "bad-arguments"))]
    if kind == "object":
        for name in sorted(schema.get("properties", {})):
            inner = F.try_variant_get(value, "$['" + name + "']", "variant")
            at = f"{path}.{name}" if path else name
            if name in schema.get("required", []):
                out.append(F.when(own.startswith("OBJECT") & inner.isNull(), F.lit(f"missing:{at}")))
            out += [F.when(inner.isNotNull(), x) for x in faults(inner, schema["properties"][name], at)]
        if schema.get("additionalProperties") is False:
            keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
            out.append(F.when(F.size(F.array_except(keys, F.array(*[F.lit(x) for x in schema.get("properties", {})]).cast("array<string>"))) > 0, F.lit("unknown-argument")))
    return out


def problems(tool: Column, args: Column, tools: dict | None = None) -> Column:
    """What is wrong with a call's arguments (a variant, null where the text was no JSON), comma-joined, empty if nothing."""
    tools = TOOLS if tools is None else tools
    found = F.when(tool.isNull() | ~tool.isin(list(tools)), F.lit("unknown-tool")).when(args.isNull(), F.lit("bad-json"))
    for name in sorted(tools):
        found = found.when(tool == name, F.concat_ws(",", *faults(args, tools[name], "")))
    return found.otherwise("")


def format_calls(calls: DataFrame, results: DataFrame, scratch: Scratch, tools: dict | None = None) -> DataFrame:
    """Calls (conv_id, turn, call_id, parents, tool, args) linked, ordered, validated and serialised. parents: ids; args: JSON.

    Arguments that are no JSON are written as a JSON string; null ones as {}. An empty frame gives an empty result.

    `position` is the place in the conversation's topological order (depth, turn, call_id), from 1;
    calls on a cycle come last. Ranks are counted inside (conversation, depth) with totals of the depths before.
    """
    ready = join_same(link(calls, results), depths(calls, scratch), ["call_id"], "left")
    ready = ready.withColumn("_args", F.try_parse_json(F.coalesce("args", F.lit("{}"))))  # its keys are sorted
    ready = ready.withColumn("problems", problems(F.col("tool"), F.col("_args"), tools)).withColumn("arguments", F.coalesce(F.to_json("_args"), json_string(F.col("args"))))
    body = F.concat(
        F.lit('{"arguments":'), F.col("arguments"), F.lit(',"id":'), json_string(F.col("call_id")), F.lit(',"name":'), json_string(F.col("tool")),
        F.lit(',"result":'), json_string(F.col("result")), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"),
    )
    ready = scratch.table(ready.select("conv_id", "turn", "call_id", "tool", "status", "problems", "result_turn", F.coalesce("depth", F.lit(1 << 40)).alias("_d"), "depth", body.alias("json")), "ready")
    # A conversation may hold a large part of all calls: ranks are counted in blocks of turns and summed.
    block = F.floor(F.coalesce("turn", F.lit(-1)) / 4096).alias("_block")
    ready = ready.withColumn("_block", block)
    totals = ready.groupBy("conv_id", "_d", "_block").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("conv_id").orderBy("_d", "_block")
    totals = totals.withColumn("_before", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).drop("_n")
    inside = Window.partitionBy("conv_id", "_d", "_block").orderBy("turn", "call_id", "json")
    ranked = join_same(ready.withColumn("_row", F.row_number().over(inside)), totals, ["conv_id", "_d", "_block"])
    return ranked.select("conv_id", "turn", "call_id", "tool", "status", "problems", "result_turn", "depth", (F.col("_before") + F.col("_row")).cast("long").alias("position"), "json")


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the conversations table has them: every user turn asks a tool, and the assistant's next turn answers it.

    A call's id is conversation:turn; it waits for the call at half its turn. Long requests go to `lookup`, short ones to `note`.
    """
    t = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    ident = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    half = F.floor(F.col("turn") / 4) * 2
    tool = F.when(F.length("text") >= 80, "lookup").otherwise("note")
    args = F.when(
        F.length("text") >= 80,
        F.to_json(F.struct(F.col("text").alias("query"), F.floor(F.length("text") / 80).alias("limit"))),
    ).otherwise(F.to_json(F.struct("text")))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    calls = t.where("role = 'user'").select(
        "conv_id", "turn", F.when(known, ident).alias("call_id"),
        F.when(known & (F.col("turn") >= 2), F.array(F.concat_ws(":", F.col("conv_id").cast("string"), half.cast("string")))).alias("parents"), tool.alias("tool"), args.alias("args"),
    )
    results = t.where("role = 'assistant'").select(F.when(known, F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def parents_of(calls: DataFrame) -> DataFrame:
    """calls whose one parent is the call at half their place in the conversation's own sequence of calls; the first one has none.

    Calls of one turn share a place. Places are counted in blocks of turns and summed, so no conversation has to fit in one task.
    """
    block = F.floor(F.col("turn") / 1024).alias("_block")
    turns = calls.where("call_id is not null").select("conv_id", "turn", "call_id", block).distinct()
    totals = turns.groupBy("conv_id", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select("conv_id", "_block", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn")
    placed = turns.withColumn("_row", F.row_number().over(inside)).join(totals, ["conv_id", "_block"]).select("conv_id", "call_id", (F.col("_before") + F.col("_row") - 1).alias("_place"))
    ups = placed.select("conv_id", F.array("call_id").alias("parents"), F.col("_place").alias("_half"))
    links = placed.where("_place > 0").withColumn("_half", F.floor(F.col("_place") / 2)).join(ups, ["conv_id", "_half"]).select("call_id", "parents")
    return calls.drop("parents").join(links, "call_id", "left").select(*calls.columns)


def format_messages(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Every row of conversations: user turns as format_calls has them, all others as messages, with `role`.

    A message's JSON has its content, role and turn, and as `id` the call it answers: the one before it that took it as
    its result, else null. `status` of a message is answer or message; it has no tool, problems, depth or position. A null role is kept as null.
    """
    calls, results = calls_of(turns)
    calls = scratch.table(parents_of(calls), "calls")
    asked = format_calls(calls, results, scratch).withColumn("role", F.lit("user"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    t = turns.where("role <> 'user' or role is null").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("_call", F.when(known & (F.col("role") == "assistant"), F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))))
    # link() takes the least of several results of one turn, and none for an id that repeats.
    firsts = t.where("_call is not null").groupBy("_call").agg(F.min("text").alias("text"), F.lit(True).alias("_taken"))
    ids = calls.where("call_id is not null").groupBy(F.col("call_id").alias("_call")).agg(F.count("*").alias("_n")).where("_n = 1").select("_call")
    t = t.join(firsts.join(ids, "_call"), ["_call", "text"], "left").withColumn("_id", F.when(F.col("_taken"), F.col("_call")))
    body = F.concat(
        F.lit('{"content":'), json_string(F.col("text")), F.lit(',"id":'), json_string(F.col("_id")), F.lit(',"role":'), json_string(F.col("role")),
        F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"),
    )
    said = t.select("conv_id", "turn", "role", F.col("_id").alias("call_id"), F.when(F.col("_id").isNotNull(), "answer").otherwise("message").alias("status"), body.alias("json"))
    return asked.unionByName(said, allowMissingColumns=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every row of conversations, of whatever role, as a call or a message; a call's parent is found by its place among the conversation's calls."""
    return format_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Scratch(spark, "chat"))


ORACLE = """
with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations),
c as (select conv_id, turn, concat(conv_id, ':', turn) as call_id, text, case when length(text) >= 80 then 'lookup' else 'note' end as tool from t where role = 'user'),
ids as (select call_id, count(*) as n from c group by 1),
place as (select call_id, row_number() over (partition by conv_id order by turn) - 1 as spot from (select distinct conv_id, turn, call_id from c)),
depth as (select call_id, case when spot = 0 then 0 else length(bin(spot)) end::bigint as depth from place),
a as (select *, case when role = 'assistant' then concat(conv_id, ':', turn - 1) end as call_id from t where role <> 'user' or role is null),
first as (select call_id, min(text) as result, min(turn) as rt from a where call_id is not null group by 1),
j as (select c.*, i.n, f.rt, f.result, d.depth from c join ids i using (call_id) join depth d using (call_id) left join first f using (call_id)),
asked as (select conv_id, turn, call_id, tool,
  case when n > 1 then 'repeated-id' when rt is null then 'no-result' else 'linked' end as status,
  case when tool = 'note' and length(text) < 1 then 'bad:text' else '' end as problems,
  case when n = 1 then rt end as result_turn, depth,
  concat('{"arguments":', case when tool = 'lookup' then concat('{"limit":', length(text) // 80, ',"query":', to_json(text), '}') else concat('{"text":', to_json(text), '}') end,
   ',"id":', to_json(call_id), ',"name":', to_json(tool), ',"result":', coalesce(to_json(case when n = 1 then result end)::varchar, 'null'), ',"turn":', turn, '}') as json,
  'user' as role from j),
said as (select a.conv_id, a.turn, a.role, a.text, case when i.n = 1 and f.result = a.text then a.call_id end as id
  from a left join first f using (call_id) left join ids i on i.call_id = a.call_id)
select conv_id, turn, call_id, tool, status, problems, result_turn, depth,
  row_number() over (partition by conv_id order by depth, turn, call_id, json) as position, json, role from asked
union all
select conv_id, turn, id, null, case when id is not null then 'answer' else 'message' end, null, null, null, null,
  concat('{"content":', to_json(text), ',"id":', coalesce(to_json(id)::varchar, 'null'), ',"role":', coalesce(to_json(role)::varchar, 'null'), ',"turn":', turn, '}'), role
from said
"""
