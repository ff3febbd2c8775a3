"""Text, scores and conversations, case by case."""

import json

import pytest
from pyspark.sql import functions as F

from convolake.functions import conversation as conv
from convolake.functions import scoring, text
from convolake.operators import generation


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k long, x {kind}")
    return [r[0] for r in df.orderBy("k").select(column).collect()]


def check(spark, column, cases, kind="string"):
    assert apply(spark, column, [a for a, _ in cases], kind) == [b for _, b in cases]


def test_types(spark):
    check(spark, text.normalize_type("x"), [("str", "string"), (" INT ", "integer"), ("float", "number"), ("Double", "number"), ("bool", "boolean"), ("list", "array"), ("dict", "object"), ("thing", "unknown"), ("", "unknown"), (None, "unknown")])
    check(spark, text.parse_type("x"), [("It is a String.", "string"), ("a point", "integer"), ("maybe float", "number"), ("boolean", "boolean"), ("list", "array"), ("dict", "object"), ("?", "unknown"), (None, "unknown")])


def test_truncate(spark):
    long = "word " * 200
    out = apply(spark, text.truncate("x", 50), [None, "", "short", "x" * 50, long, "y" * 80])
    assert out[:4] == ["", "", "short", "x" * 50]
    assert out[4] == "word " * 8 + "word..." and len(out[4]) <= 50
    assert out[5] == "y" * 47 + "..."
    check(spark, text.truncate("x", 2), [("abcdef", "..")])
    check(spark, text.truncate("x", 10, " [cut]"), [("abcdef ghijkl", "abcd [cut]")])


def test_ids(spark):
    cases = [("My API Tool", "my_api_tool"), ("api@v2.0", "api_v2_0"), ("tool(beta)", "tool_beta"), ("api--tool", "api-tool"), ("_api_tool_", "api_tool"), ("my-api_tool", "my-api_tool"), ("a" * 200, "a" * 128), (" ", None), ("@#$%", None), (None, None)]
    check(spark, text.sanitize_id("x"), cases)
    check(spark, text.sanitize_id("x", "-"), [("a b@@c", "a-b-c")])
    check(spark, text.sanitize_id("x", lower=False), [("Ab C", "Ab_C")])
    with pytest.raises(Exception, match="no usable id"):
        apply(spark, text.sanitize_id("x", strict=True), ["@"])
    check(spark, text.endpoint_id(F.lit("t"), "x"), [("getUser", "t_getuser"), ("@@", "t_" + __import__("hashlib").md5(b"@@").hexdigest()[:12])])
    check(spark, text.domain_node_id("x"), [("Real-Time X", "domain_real_time_x")])
    check(spark, text.normalize_method("x"), [("post ", "POST"), ("", "GET"), (None, "GET")])
    check(spark, text.tool_id(tool_name="x", stem=F.lit("my file"), raw=F.lit("{}")), [("A b", "a_b"), (None, "my_file"), ("?", None)])


def test_domains(spark):
    check(spark, text.infer_domain(category="x"), [("Weather Services", "weather"), ("weathers", "general"), ("searchProducts", "search"), ("STOCK news", "finance"), ("", "general"), (None, "general")])
    check(spark, text.infer_domain(category=F.lit("misc"), path="x", name=F.lit("hotelSearch")), [("/v1/stocks/price", "finance"), ("/x", "search")])
    words = [w for ws in text.DOMAIN_KEYWORDS.values() for w in ws.split()]
    assert all(w == w.lower() for w in words)


def test_json_in_answers(spark):
    fence = '```json\n{"a": 1}\n```'
    check(spark, text.extract_json("x"), [('{"a": 1}', '{"a": 1}'), (fence, '{"a": 1}'), ("so [1, 2] it is", "[1, 2]"), ("nothing", None), ("{bad", None), (None, None)])
    check(spark, text.parse_response_schema("x"), [(fence, '{"a": 1}'), ('text {"b": {}} text', '{"b": {}}'), ("none", None)])


def test_small_texts(spark):
    check(spark, text.clean_user_message("x"), [(' "User: hi" ', "hi"), ("Message: User: x", "User: x"), ("User: Message: x", "x"), ("'it's'", "it's"), ('"', "")])
    check(spark, text.pattern_hash("x"), [(["b", "a"], __import__("hashlib").md5(b"a,b").hexdigest()[:16]), (["a", "b"], __import__("hashlib").md5(b"a,b").hexdigest()[:16])], "array<string>")
    check(spark, text.embedding_text("x", F.lit("d"), F.lit(""), F.lit("GET"), F.lit("/p")), [("n", "n: d. Method: GET. Path: /p."), (None, "Method: GET. Path: /p.")])
    check(spark, text.cache_key(F.lit("ns"), F.lit("op"), "x"), [("t", "ns:op:t")])


def test_scores(spark):
    check(spark, scoring.score_name("x"), [("getUserProfile", 1.0), ("getData", 0.0), ("get_data", 0.0), ("testApi", 0.0), ("abc", 0.0), ("getWeather", 1.0), ("", 0.0), (None, 0.0)])
    check(spark, scoring.score_path("x"), [("/api/users", 1.0), ("https://x", 1.0), ("www.x", 1.0), ("api/v1", 1.0), ("users", 0.0), (" ", 0.0), (None, 0.0)])
    check(spark, scoring.score_description("x"), [("long enough text", 1.0), ("short", 0.0), ("description", 0.0), (None, 0.0), ("          ", 0.0)])
    check(spark, scoring.score_types("x"), [(["string", "unknown"], 0.5), ([], 1.0), (None, 1.0), (["unknown"], 0.0)], "array<string>")
    full = scoring.endpoint_score(F.lit("a good description"), F.array(F.lit("string")), F.lit("{}"), F.lit("getWeather"), F.lit("/x"))
    assert spark.range(1).select(full).first()[0] == pytest.approx(1.0)


def test_tools(spark):
    tools = spark.createDataFrame([("t", "weather tool", "tells the weather"), ("u", "get", None)], "id string, name string, description string")
    p = [("city", "string", "where", True, None, None), ("n", "unknown", "", False, '"3"', ["1"])]
    e = spark.createDataFrame([("t", "gives it", p)], f"tool_id string, description string, parameters {__import__('convolake.sources.specs', fromlist=['x']).PARAMETER.join(['array<', '>'])}")
    got = dict(scoring.inference_completeness(tools, e).collect())
    assert got["t"] == pytest.approx(0.2 + 0.3 + 0.125 + 0.125) and got["u"] == 0
    assert sorted(r["id"] for r in scoring.incomplete_tools(tools, e).collect()) == ["t", "u"]
    scored = {r["id"]: r for r in scoring.score_tools(tools, e.select("tool_id", F.lit(0.8).alias("score"))).collect()}
    assert scored["t"]["score_raw"] == pytest.approx(0.9) and scored["u"]["score_raw"] == 0
    assert scored["t"]["breakdown"]["endpoints_completeness"]["weighted"] == 0.4
    schema = json.loads(e.select(conv.input_schema("parameters")).first()[0])
    assert schema["properties"]["n"]["type"] == "string" and schema["required"] == ["city"] and "enum" not in schema["properties"]["city"]


CALL = {"id": "c1", "function": {"name": "f", "arguments": "{}"}}


def messages(*rows):
    return [{"role": r, "content": c, "tool_calls": calls, "tool_call_id": i} for r, c, calls, i in rows]


def test_conversations(spark):
    m = messages(("system", "be nice", None, None), ("user", "hi", None, None), ("assistant", "", [CALL, {**CALL, "id": "c2"}], None), ("tool", "x" * 300, None, "c1"), ("assistant", "done", None, None))
    df = spark.createDataFrame([("a", m, None, {"k": "v"}, {}), ("b", [], None, {}, {})], conv.CONVERSATION)
    row = df.select(
        conv.history_text("messages"), conv.judge_transcript("messages"), conv.pending_call("messages")["id"], conv.values_text("grounding", "generated_ids"),
        F.transform("messages", conv.content_blocks), conv.entity_id(F.lit("user"), "conversation_id"),
    ).collect()
    assert row[0][0] == "System: be nice\nUser: hi\nAssistant: done"
    assert row[0][1].split("\n") == ["User: hi", "Assistant [Tool Call]: f({})", "Assistant [Tool Call]: f({})", "Tool Response: " + "x" * 200 + "...", "Assistant: done"]
    assert row[0][2] == "c2" and row[1][2] is None and row[1][1] == "No messages"
    assert row[0][3] == "Available values:\n  - k: v" and row[1][3] == ""
    assert [b["type"] for b in row[0][4][2]] == ["tool_use", "tool_use"] and row[0][4][3][0]["type"] == "tool_result"
    assert row[0][5].startswith("user_") and row[0][5] != row[1][5]


def test_calls_and_answers(spark):
    m = messages(("assistant", None, [CALL, {**CALL, "id": "c2"}], None), ("tool", "r1", None, "c1"))
    df = spark.createDataFrame([("a", m, [], {}, {}), ("b", [], None, {}, {})], conv.CONVERSATION)
    assert sorted((r["call_id"], r["answer"]) for r in conv.answered_calls(df).collect()) == [("c1", "r1"), ("c2", None)]
    assert [r[0] for r in df.select(F.size(conv.append_message("messages", "user", F.lit("x")))).collect()] == [3, 1]
    assert [r[0] for r in df.select(conv.is_complete("tool_outputs", 0)).collect()] == [True, True]


def test_values(spark):
    data = {"id": 7, "user": {"id": 3, "name": "Ann", "email": "a@b.c", "total": 5, "price": "x"}, "orders": [{"order_id": 9}, {"order_id": 10}], "state": "ok", "confirmation": None}
    assert conv.extract_values(data) == {"id": "7", "user_id": "3", "user_name": "Ann", "email": "a@b.c", "user_total": "5", "order_id": "9", "state": "ok"}
    assert conv.grounding_values({"weather": {"temperature": 3, "x": 1}, "list": [1], "user_id": None}) == {"weather_temperature": "3"}
    got = apply(spark, conv.extracted_values("x"), [json.dumps(data), "{bad", None])
    assert got[0]["user_id"] == "3" and got[1] == {} and got[2] == {}
    assert json.loads(apply(spark, conv.mock_result(F.lit("f"), "x"), ["call_123456789"])[0])["id"] == "f_23456789"


def test_feedback(spark):
    df = spark.createDataFrame([(5, 9, 9, 3, "why")], "a long, b long, c long, d long, r string")
    out = df.select(conv.low_score_feedback({"tool_correctness": "a", "argument_grounding": "b", "task_completion": "c", "naturalness": "d"}, "r")).first()[0]
    assert "Tool Correctness (5/10)" in out and "Naturalness (3/10)" in out and "Grounding" not in out and out.endswith("Reasons given: why")


def test_output_of_contexts(spark):
    schema = "conversation_id string, messages array<struct<role:string,content:string,tool_calls:array<string>,tool_call_id:string,timestamp:timestamp>>, tool_outputs array<struct<endpoint_id:string,arguments:string,result:string,call_id:string,timestamp:timestamp,success:boolean>>, scenario_description string, tool_chain array<string>, target_steps int, seed long, start_time timestamp"
    row = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS a, timestamp'2024-01-02 03:04:05.25' AS b").first()
    df = spark.createDataFrame([("c", [("user", "hi", None, None, row["a"])], [("e", "{}", "{}", "1", row["b"], True)], "s", ["e"], 1, 7, None)], schema)
    got = conv.output_of(df).first().asDict(recursive=True)
    assert got["messages"][0]["timestamp"] == "2024-01-02T03:04:05" and got["tool_outputs"][0]["timestamp"] == "2024-01-02T03:04:05.250000" and got["tool_outputs"][0]["success"]
    assert got["metadata"] == {"scenario_description": "s", "tool_chain": ["e"], "target_steps": 1, "seed": 7, "start_time": None}


def test_planner_endpoints_and_goals(spark):
    chains = spark.createDataFrame([(1, ["a", "gone", "b"])], "conv long, chain array<string>")
    nodes = spark.createDataFrame([("a", "A", None, '[{"name": "q", "required": true}]'), ("b", None, "text", "not JSON")], "id string, name string, description string, parameters_json string")
    assert sorted((r["at"], r["id"]) for r in conv.planner_endpoints(chains, nodes).collect()) == [(0, "a"), (2, "b")]
    data = spark.createDataFrame([(1, [("a", None, "t", "d"), ("gone", "G", "t", None), ("b", None, None, None)])], "conv long, chain array<struct<endpoint_id:string,name:string,tool_id:string,domain:string>>")
    got = sorted((r["at"], r["name"], r["description"], r["domain"], [p["name"] for p in r["parameters"]]) for r in conv.planner_chain_data(data, nodes).collect())
    assert got == [(0, "A", "", "d", ["q"]), (1, "G", "", "", []), (2, "b", "text", "", [])]
    assert [conv.user_goal(*x) for x in (({"user_goal": "g"}, "d"), ({}, "d"), ({"description": "e"},), ({},))] == ["g", "d", "e", "Complete the task"]
    assert conv.available_tools({}) == [] and conv.available_tools({"available_tools": [{"name": "t"}]}) == [{"name": "t"}]


def test_repair_text_and_plan():
    class Plain:
        def complete(self, prompt):
            return "{}"

    text_ = conv.repair_text([{"role": "user", "content": "hi", "tool_calls": None, "tool_call_id": None}, {"role": "tool", "content": "x", "tool_calls": None, "tool_call_id": "1"}], [{"endpoint_id": "e", "arguments": "{}", "result": "r", "call_id": "1", "success": True}], {"user_goal": "g"})
    assert json.loads(text_) == {"messages": [{"role": "user", "content": "hi"}, {"role": "tool", "content": "x", "tool_call_id": "1"}], "tool_outputs": [{"endpoint_id": "e", "arguments": "{}", "result": "r", "call_id": "1"}], "scenario": {"user_goal": "g"}}
    talk = generation.Talk("c", ["e"])
    generation.plan(Plain(), talk)
    assert talk.goal == "Complete the task"
