"""Chat formatting: linking, order, schemas and canonical JSON."""

import json
import re

from pyspark.sql import functions as F

from courtline.llm.chat_format import TOOLS, format_chat, with_tools

MESSAGES = "conv_id long, turn long, role string, text string"


def call(**fields):
    return f"<tool_call>{json.dumps(fields)}</tool_call>"


def events(spark, rows):
    return format_chat(spark.createDataFrame(rows, MESSAGES), TOOLS).orderBy("conv_id", "seq").collect()


def test_links_order_and_json(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "well " + call(id="b", name="answer", arguments={"source": {"$ref": "a"}}) + call(id="a", name="retrieve", arguments={"words": 2, "query": 'é"\n'})),
        (1, 2, "tool", '{"content": {"z": 1, "a": [1, 2.50]}, "tool_call_id": "b"}'),
        (1, 1, "tool", '{"tool_call_id": "a", "content": "found"}'),
        (2, 9, "tool", '{"tool_call_id": "x", "content": "nobody asked"}'),
    ]
    got = events(spark, rows)
    assert [(r.conv_id, r.seq, r.kind, r.call_id, r.linked) for r in got] == [
        (1, 0, "message", None, None), (1, 1, "message", None, None), (1, 2, "call", "a", True), (1, 3, "result", "a", True),
        (1, 4, "call", "b", True), (1, 5, "result", "b", True), (2, 0, "result", "x", False)]
    assert all(r.problems == [] for r in got)
    assert got[2].json == '{"arguments":{"query":"é\\"\\n","words":2},"id":"a","name":"retrieve","role":"assistant"}'
    assert json.loads(got[5].json)["content"] == '{"a":[1,2.5],"z":1}'
    assert got[1].json == '{"content":"well ","role":"assistant"}'
    for r in got:
        assert list(json.loads(r.json)) == sorted(json.loads(r.json))


def test_problems_are_named(spark):
    rows = [
        (1, 0, "assistant", call(id="p", name="retrieve", arguments={"words": "two", "more": 1})),
        (1, 1, "assistant", call(id="q", name="nothing", arguments={})),
        (1, 2, "assistant", "<tool_call>{not json</tool_call><tool_call>[1]</tool_call>"),
        (1, 3, "assistant", call(id="c1", name="answer", arguments={"source": {"$ref": "c2"}})),
        (1, 3, "assistant", call(id="c2", name="answer", arguments={"source": {"$ref": "c1"}})),
        (1, 4, "assistant", call(id="d", name="answer", arguments={"source": {"$ref": "gone"}})),
        (1, 5, "assistant", call(id="e", name="answer", arguments={"source": "s"}) * 2),
    ]
    found = {}
    for r in events(spark, rows):
        found.setdefault(r.call_id, []).append(list(r.problems))
    assert found["p"] == [["missing query", "words is not integer", "unexpected more"]]
    assert found["q"] == [["unknown tool"]] and found[None] == [["malformed"], ["malformed"]]
    assert found["c1"] == found["c2"] == [["cycle"]]
    assert found["d"] == [["unknown reference"]] and found["e"] == [["repeated id"], ["repeated id"]]


def test_only_calls_within_a_cycle_are_named_so(spark):
    refers = {"a": "b", "b": "a", "c": "a", "d": "c", "self": "self"}
    rows = [(1, 9 - n, "assistant", call(id=k, name="answer", arguments={"source": {"$ref": v}})) for n, (k, v) in enumerate(refers.items())]
    got = {r.call_id: r for r in events(spark, rows) if r.kind == "call"}
    assert {k for k, r in got.items() if "cycle" in r.problems} == {"a", "b", "self"}
    assert all(list(got[k].problems) == [] for k in "cd")
    assert got["a"].seq < got["c"].seq < got["d"].seq


def test_references_with_quotes_and_backslashes(spark):
    odd = 'p"q\\r'
    rows = [
        (1, 0, "assistant", call(id="user", name="answer", arguments={"source": {"$ref": odd}})),
        (1, 1, "assistant", call(id=odd, name="answer", arguments={"source": "s"})),
        (1, 2, "assistant", call(id="lost", name="answer", arguments={"source": {"$ref": 'x"y'}})),
        (1, 3, "assistant", call(id="told", name="answer", arguments={"source": 'a {"$ref":"gone"} within a text'})),
    ]
    got = {r.call_id: r for r in events(spark, rows) if r.kind == "call"}
    assert got[odd].seq < got["user"].seq and list(got["user"].problems) == []
    assert list(got["lost"].problems) == ["unknown reference"] and list(got["told"].problems) == []


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [(None, None, None, None), (None, 0, "user", ""), (3, 1, "user", long), (3, 1, "user", long), (3, None, "tool", "oops"), (3, 2, "assistant", None)]
    df = spark.createDataFrame(rows, MESSAGES).withColumn("kind", F.lit("clash"))
    got = format_chat(df, TOOLS).orderBy("conv_id", "seq").collect()
    assert [(r.conv_id, r.seq, r.turn, r.kind) for r in got] == [
        (None, 0, None, "message"), (None, 1, 0, "message"), (3, 0, None, "result"), (3, 1, 1, "message"), (3, 2, 1, "message"), (3, 3, 2, "message")]
    assert got[0].json == '{"content":null,"role":null}' and json.loads(got[3].json)["content"] == long
    assert format_chat(df.where("false"), TOOLS).count() == 0


def test_a_hot_conversation_is_numbered_gaplessly(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(700)] + [(c, 0, "user", "same first turn") for c in range(2, 200)]
    got = events(spark, rows)
    assert [r.seq for r in got if r.conv_id == 1] == list(range(700))
    assert [r.turn for r in got if r.conv_id == 1] == list(range(700))


def test_conversations_as_agent_logs(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = format_chat(with_tools(table), TOOLS).collect()
    said = table.collect()
    answered = {(r.conv_id, r.turn) for r in said if r.role == "assistant"}
    calls = {(r.conv_id, r.call_id): r for r in rows if r.kind == "call"}
    for r in said:
        if r.role == "user":
            first, second = calls[r.conv_id, f"r{r.turn}"], calls[r.conv_id, f"a{r.turn}"]
            assert first.linked and json.loads(first.json)["arguments"]["query"] == r.text
            assert second.linked == ((r.conv_id, r.turn + 1) in answered) and first.seq < second.seq
        if r.role == "system":
            assert list(calls[r.conv_id, f"s{r.turn}"].problems) == ["missing mode"]
    assert sum(r.kind == "message" for r in rows) == len(said)


def test_no_python_in_the_plan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = format_chat(with_tools(table), TOOLS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
