"""Operator 8: chat formatting with linked tool calls, with DataFrame functions only.

Messages (conv_id, turn, role, text) are taken apart into events: the message
itself, the calls in an assistant's ``<tool_call>{"id", "name", "arguments"}
</tool_call>`` blocks, and the results of role ``tool``
(``{"tool_call_id", "content"}``).  Calls and results are hash-joined by
conversation and identifier; a call whose arguments name another call
(``{"$ref": id}``) comes after it and its result; arguments are checked
against schemas; every event is written as canonical JSON (sorted keys, no
white space).  A conversation is its rows in ``seq`` order, so that no
conversation has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

BLOCK = r"(?s)<tool_call>(.*?)</tool_call>"
RUN_TURNS = 64  # turns that are ranked together
MESSAGE, CALL, RESULT = 0, 1, 2
CYCLE = 1 << 20
#: JSON types by the name that schema_of_variant gives their values.
KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY"}

Schema = dict[str, dict[str, tuple[str, bool]]]


def _problems(schemas: Schema) -> Column:
    """The problems of a call with ``name``, ``args`` (variant) and ``args_json``, in a fixed order."""
    chosen = F.array(F.lit("unknown tool"))
    for tool, parameters in schemas.items():
        names = sorted(parameters)
        found = []
        for name in names:
            kind, required = parameters[name]
            at = f"$['{name}']"
            absent = F.expr(f"coalesce(not array_contains(keys, '{name}'), true)")
            shape = F.expr(f'''schema_of_variant(try_variant_get(args, "{at}", 'variant'))''')
            reference = F.expr(f'''try_variant_get(args, "{at}['$ref']", 'string') is not null''')
            wrong = ~absent & ~reference & ~F.coalesce(shape.rlike(KINDS[kind]), F.lit(False))
            found.append(F.when(absent, F.lit(f"missing {name}") if required else F.lit(None)).when(wrong, F.lit(f"{name} is not {kind}")))
        extra = F.transform(F.array_sort(F.array_except("keys", F.array(*map(F.lit, names)))), lambda k: F.concat(F.lit("unexpected "), k))
        chosen = F.when(F.col("name") == tool, F.concat(F.array_compact(F.array(*found)), F.coalesce(extra, F.array()))).otherwise(chosen)
    return F.when(F.col("args").isNull(), F.array(F.lit("malformed"))).otherwise(chosen)


def _calls(messages: DataFrame, schemas: Schema) -> DataFrame:
    blocks = messages.where(F.col("role") == "assistant").select("conv_id", "turn", F.explode(F.regexp_extract_all("text", F.lit(BLOCK), F.lit(1))).alias("raw"))
    parsed = blocks.withColumn("v", F.try_parse_json("raw")).selectExpr(
        "conv_id", "turn", "raw", "try_variant_get(v, '$.id', 'string') as call_id", "try_variant_get(v, '$.name', 'string') as name", "try_variant_get(v, '$.arguments', 'variant') as args")
    shaped = parsed.withColumn("args_json", F.expr("to_json(args)")).withColumn("args", F.expr("case when schema_of_variant(args) like 'OBJECT%' then args end"))
    keyed = shaped.withColumn("keys", F.expr("case when args is not null then json_object_keys(args_json) end"))
    checked = keyed.withColumn("problems", _problems(schemas)).drop("args", "keys")
    # an escaped quote cannot end the text, and within a JSON text no bare quote begins one
    quoted = F.regexp_extract_all("args_json", F.lit(r'\{"\$ref":("(?:[^"\\]|\\.)+")\}'), F.lit(1))
    plain = F.transform(quoted, lambda x: F.try_variant_get(F.try_parse_json(x), "$", "string"))
    return checked.withColumn("refs", F.array_distinct(F.coalesce(plain, F.array())))


def _same_call(id_column: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col(id_column) == F.col("k_id"))


def _in_cycles(edges: DataFrame, waiting: DataFrame) -> DataFrame:
    """Those of the ``waiting`` calls that stay when calls to which none of the rest refers are peeled off."""
    left = waiting.count()
    while True:
        inner = edges.join(waiting.select("k_conv", "k_id"), _same_call("call_id"), "left_semi")
        named = inner.select(F.col("conv_id").alias("o_conv"), F.col("ref").alias("o_id")).distinct()
        waiting = stored(waiting.join(named, F.col("k_conv").eqNullSafe(F.col("o_conv")) & (F.col("k_id") == F.col("o_id")), "left_semi"), "chat-cycles")
        before, left = left, waiting.count()
        if left == before:
            return waiting


def call_levels(calls: DataFrame) -> DataFrame:
    """k_conv, k_id, level, key of all calls with an id: the length of the
    longest chain of references below a call, and the last turn in that chain.

    Each round places the calls whose references are all placed.  When a round
    places none, the calls that lie in a cycle, or between two, are placed at
    level CYCLE; calls that merely refer to them follow in later rounds."""
    known = calls.where("call_id is not null").groupBy(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_id")).agg(F.min("turn").alias("turn"))
    edges = calls.where("call_id is not null").select("conv_id", "call_id", F.explode("refs").alias("ref")).distinct()
    edges = edges.join(known.select("k_conv", "k_id"), _same_call("ref"), "left_semi")
    edges = stored(edges, "chat-references")
    owners = edges.select(F.col("conv_id").alias("o_conv"), F.col("call_id").alias("o_id")).distinct()
    is_owner = F.col("k_conv").eqNullSafe(F.col("o_conv")) & (F.col("k_id") == F.col("o_id"))
    placed = stored(known.join(owners, is_owner, "left_anti").select("k_conv", "k_id", F.lit(0).alias("level"), F.col("turn").alias("key")), "chat-levels")
    waiting = stored(known.join(owners, is_owner, "left_semi"), "chat-waiting")
    while waiting.take(1):
        open_edges = edges.join(waiting.select("k_conv", "k_id"), _same_call("call_id"), "left_semi")
        seen = open_edges.join(placed, _same_call("ref"), "left").groupBy(F.col("conv_id").alias("e_conv"), F.col("call_id").alias("e_id"))
        ready = seen.agg(F.count("*").alias("n"), F.count("level").alias("met"), F.max("level").alias("below"), F.max("key").alias("last")).where("n = met")
        new = waiting.join(ready, F.col("k_conv").eqNullSafe(F.col("e_conv")) & (F.col("k_id") == F.col("e_id")))
        new = stored(new.selectExpr("k_conv", "k_id", "below + 1 as level", "greatest(turn, last) as key"), "chat-levels")
        if not new.take(1):
            new = stored(_in_cycles(edges, waiting).selectExpr("k_conv", "k_id", f"{CYCLE} as level", "turn as key"), "chat-levels")
        done = new.select(F.col("k_conv").alias("o_conv"), F.col("k_id").alias("o_id"))
        placed = placed.unionByName(new)
        waiting = stored(waiting.join(done, is_owner, "left_anti"), "chat-waiting")
    return placed


def _numbered(events: DataFrame) -> DataFrame:
    """Adds seq, the place in the conversation from 0.

    Runs of RUN_TURNS turns are ranked by themselves and start behind the
    counts of the runs before, so a conversation of any length is split."""
    dealt = events.withColumn("run", F.expr(f"key div {RUN_TURNS}"))
    counts = dealt.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    starts = counts.selectExpr("conv_id as r_conv", "run as r_run", "coalesce(sum(n) over (partition by conv_id order by run rows between unbounded preceding and 1 preceding), 0) as start")
    same = F.col("conv_id").eqNullSafe(F.col("r_conv")) & F.col("run").eqNullSafe(F.col("r_run"))
    joined = dealt.join(starts, same)
    order = "partition by conv_id, run order by key nulls first, level, kind, call_id nulls first, json"
    return joined.withColumn("seq", F.expr(f"start + row_number() over ({order}) - 1")).drop("run", "r_conv", "r_run", "start")


def format_chat(messages: DataFrame, schemas: Schema) -> DataFrame:
    """One row per event: conv_id, seq, turn, kind, call_id, linked, problems, json.

    ``kind`` is message, call or result.  ``linked`` says that a call has a
    result or a result its call (null for messages); ``problems`` lists what is
    wrong with a call (malformed, unknown tool, parameters, repeated id,
    unknown reference, cycle), in a fixed order.  Null roles and texts are JSON
    nulls; an empty text is a message.  A null conv_id is a conversation of its
    own, a null turn comes first.  Ties of turn are ordered by the JSON; rows
    repeated whole are events each.  Blocks that are not JSON objects are
    malformed calls; a tool message that is no JSON object is an unlinked
    result with its text as content.  Columns of ``messages`` beyond the four
    are not read; an empty table gives an empty result."""
    said = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    calls = stored(_calls(said, schemas), "chat-calls")
    levels = stored(call_levels(calls), "chat-all-levels")
    tool = said.where(F.col("role") == "tool").withColumn("v", F.try_parse_json("text"))
    results = tool.selectExpr("conv_id", "turn", "try_variant_get(v, '$.tool_call_id', 'string') as call_id", "coalesce(try_variant_get(v, '$.content', 'string'), text) as content")
    answered = results.where("call_id is not null").groupBy(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_id")).agg(F.count("*").alias("answers"))
    repeated = calls.where("call_id is not null").groupBy(F.col("conv_id").alias("c_conv"), F.col("call_id").alias("c_id")).agg(F.count("*").alias("times"))
    missing = calls.select("conv_id", "call_id", "raw", "turn", F.explode("refs").alias("ref"))
    missing = missing.join(levels.select("k_conv", "k_id"), _same_call("ref"), "left_anti").select(F.col("conv_id").alias("m_conv"), F.col("turn").alias("m_turn"), F.col("raw").alias("m_raw")).distinct()

    linked = calls.join(answered, _same_call("call_id"), "left").drop("k_conv", "k_id")
    linked = linked.join(repeated, F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("call_id") == F.col("c_id")), "left")
    linked = linked.join(missing, F.col("conv_id").eqNullSafe(F.col("m_conv")) & F.col("turn").eqNullSafe(F.col("m_turn")) & (F.col("raw") == F.col("m_raw")), "left")
    linked = linked.join(levels, _same_call("call_id"), "left")
    more = F.array_compact(F.array(
        F.when(F.col("times") > 1, "repeated id"), F.when(F.col("m_raw").isNotNull(), "unknown reference"), F.when(F.col("level") == CYCLE, "cycle")))
    call_json = F.expr("""concat('{"arguments":', coalesce(args_json, 'null'), ',"id":', coalesce(substring(to_json(array(call_id)), 2, length(to_json(array(call_id))) - 2), 'null'), ',"name":', coalesce(substring(to_json(array(name)), 2, length(to_json(array(name))) - 2), 'null'), ',"role":"assistant"}')""")
    call_events = linked.select(
        "conv_id", "turn", F.coalesce("key", "turn").alias("key"), F.coalesce("level", F.lit(0)).alias("level"), F.lit(CALL).alias("kind"), "call_id",
        F.col("answers").isNotNull().alias("linked"), F.concat("problems", more).alias("problems"), call_json.alias("json"))
    no_problems = F.array().cast("array<string>")
    met = results.join(levels, _same_call("call_id"), "left")
    result_events = met.select(
        "conv_id", "turn", F.greatest("turn", "key").alias("key"), F.coalesce("level", F.lit(0)).alias("level"), F.lit(RESULT).alias("kind"), "call_id",
        F.col("level").isNotNull().alias("linked"), no_problems.alias("problems"),
        F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id")), {"ignoreNullFields": "false"}).alias("json"))
    plain = said.where(~F.coalesce(F.col("role") == "tool", F.lit(False)))
    bare = F.when(F.col("role") == "assistant", F.regexp_replace("text", BLOCK, "")).otherwise(F.col("text"))
    only_calls = (F.col("role") == "assistant") & F.col("text").contains("<tool_call>") & (F.trim(bare) == "")
    message_events = plain.where(~F.coalesce(only_calls, F.lit(False))).select(
        "conv_id", "turn", F.col("turn").alias("key"), F.lit(-1).alias("level"), F.lit(MESSAGE).alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("boolean").alias("linked"), no_problems.alias("problems"),
        F.to_json(F.struct(bare.alias("content"), "role"), {"ignoreNullFields": "false"}).alias("json"))
    events = message_events.unionByName(call_events).unionByName(result_events)
    names = F.element_at(F.array(F.lit("message"), F.lit("call"), F.lit("result")), F.col("kind") + 1)
    return _numbered(events).select("conv_id", "seq", "turn", names.alias("kind"), "call_id", "linked", "problems", "json")


#: The tools of the derived conversations: parameter -> (type, required).
TOOLS: Schema = {
    "retrieve": {"query": ("string", True), "words": ("integer", True)},
    "answer": {"source": ("string", True), "style": ("string", False)},
    "configure": {"prompt": ("string", True), "mode": ("string", True)},
}


def with_tools(conversations: DataFrame) -> DataFrame:
    """Conversations as an agent's log: every user turn calls ``retrieve`` and
    then ``answer`` with its result, which is the next assistant turn; a system
    turn calls ``configure`` without its mode.  Texts go in whole."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    words = "cast(regexp_count(coalesce(text, ''), '[^ \\\\n]+') as int)"
    block = "concat('<tool_call>', {}, '</tool_call>')"
    ask = block.format(f"to_json(named_struct('id', concat('r', turn), 'name', 'retrieve', 'arguments', named_struct('words', {words}, 'query', coalesce(text, ''))))")
    then = block.format("""concat('{"name": "answer", "id": "a', turn, '", "arguments": {"source": {"$ref": "r', turn, '"}}}')""")
    setup = block.format("to_json(named_struct('name', 'configure', 'id', concat('s', turn), 'arguments', named_struct('prompt', coalesce(text, ''))))")
    users, systems, answers = (rows.where(F.col("role") == r) for r in ("user", "system", "assistant"))
    made = [
        users.selectExpr("conv_id", "turn", "'assistant' as role", f"concat({then}, {ask}) as text"),
        users.selectExpr("conv_id", "turn", "'tool' as role", f"to_json(named_struct('tool_call_id', concat('r', turn), 'content', concat({words}, ' words'))) as text"),
        systems.selectExpr("conv_id", "turn", "'assistant' as role", f"{setup} as text"),
        answers.selectExpr("conv_id", "turn", "'tool' as role", "to_json(named_struct('tool_call_id', concat('a', turn - 1), 'content', coalesce(text, ''))) as text"),
    ]
    for part in made:
        rows = rows.unionByName(part)
    return rows
