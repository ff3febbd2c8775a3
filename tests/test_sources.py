"""Specifications, interchange, cache, settings, generation and streams."""

import json

import pytest
from pyspark.sql import functions as F

from convolake.functions import conversation
from convolake.functions.conversation import CONVERSATION
from convolake.operators import generation, graph
from convolake.sources import cache, config, interchange, specs
from convolake.streaming import tracker

LISTED = {
    "tool_name": "City Weather", "category_name": "Weather", "tool_description": "d" * 600, "host": "h",
    "api_list": [
        {"api_name": "getForecast", "url": "/v1/f", "method": "post", "api_description": "tells", "required_parameters": [{"name": "city", "type": "STRING", "default": "x"}, {"type": "int"}],
         "optional_parameters": [{"param_name": "days", "param_type": "int", "enum": [1, "a"], "required": "true"}], "parameters": {"z": {"type": "list"}, "bad": 3}},
        {"name": "getForecast"}, {"url": "/nameless"}, {"name": "@@", "parameters": [{"parameter_name": "u", "parameter_type": "float", "parameter_description": "of u", "required": False}]},
    ],
}
NAMED = {"id": 17, "name": "Shop", "category": "", "endpoints": [{"endpoint_name": "buy", "path": "", "url": "/cart", "parameters": {"q": {"type": "bool", "required": True, "default": None}}}]}
APIS = {"tool_name": "t3", "apis": [{"api_name": "x", "name": "y", "api_description": "a", "description": "b"}]}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Smart_Home").mkdir()
    for name, doc in (("a.json", LISTED), ("Smart_Home/b.json", NAMED), ("Smart_Home/c.json", APIS), ("Smart_Home/d.json", {"description": "empty"}), ("e.json", {**APIS, "tool_name": "T3"}), ("list.json", [1])):
        (tmp_path / name).write_text(json.dumps(doc))
    (tmp_path / "bad.json").write_text("{nope")
    (tmp_path / "other.txt").write_text("{}")
    return tmp_path


def test_specs(spark, folder):
    tools = specs.parse_tools(specs.scan(spark, f"file://{folder}"))
    t = {r["id"]: r for r in tools.collect()}
    assert set(t) == {"city_weather", "17", "t3", "d"}
    assert (t["city_weather"]["category"], t["17"]["category"], t["17"]["name"], t["d"]["name"]) == ("Weather", "Smart Home", "Shop", "d")
    assert len(t["city_weather"]["description"]) == 500 and t["city_weather"]["api_host"] == "h" and t["t3"]["path"].endswith("c.json")
    e = {r["id"]: r for r in specs.parse_endpoints(tools).collect()}
    assert len(e) == 4
    f = e["city_weather_getforecast"]
    assert (f["method"], f["path"], f["description"], f["domain"]) == ("POST", "/v1/f", "tells", "weather")
    assert [tuple(p) for p in f["parameters"]] == [("city", "string", "", True, '"x"', None), ("days", "integer", "", True, None, ["1", '"a"']), ("z", "array", "", False, None, None)]
    assert e["17_buy"]["path"] == "/cart" and e["17_buy"]["parameters"][0]["default"] is None and e["17_buy"]["domain"] == "shopping"
    assert e["t3_x"]["description"] == "a"
    assert specs.scan(spark, f"file://{folder}", limit=2).count() == 2 and specs.scan(spark, f"file://{folder}", recursive=False).count() == 4
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        specs.parse_tools(specs.scan(spark, f"file://{folder}", "bad.json"), skip_malformed=False).collect()


def test_jsonl(spark, tmp_path):
    rows = [("a", [{"role": "user", "content": "hé", "tool_calls": None, "tool_call_id": None}], [{"endpoint_id": "e", "arguments": "{}", "result": "{}", "call_id": "c", "success": True}], True, 1, 8), ("b", [], None, False, 2, None)]
    df = spark.createDataFrame(rows, "conversation_id string, messages array<struct<role:string,content:string,tool_calls:array<string>,tool_call_id:string>>, tool_outputs array<struct<endpoint_id:string,arguments:string,result:string,call_id:string,success:boolean>>, success boolean, attempts long, tool_correctness long")
    df = df.withColumns({k: F.col("tool_correctness") for k in ("argument_grounding", "task_completion", "naturalness")} | {"repaired": F.lit(False), "error": F.lit(None).cast("string")})
    assert interchange.write_jsonl(df, f"file://{tmp_path}/one") == 1 and interchange.write_jsonl(df, f"file://{tmp_path}/two", failed=True) == 2
    doc = json.loads(interchange.serialize(df.where("success")).first()[0])
    assert doc["metadata"] == {"tools_used": ["e"], "num_turns": 1, "num_tool_calls": 1, "attempts": 1, "repaired": False, "success": True} and doc["judge_scores"]["average"] == 8
    assert interchange.read_jsonl(spark, f"file://{tmp_path}/one").first()["messages"][0]["content"] == "hé"
    (tmp_path / "bad.jsonl").write_text('{"conversation_id": "x"}\n\n{oops\n')
    assert interchange.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", strict=False).count() == 1
    with pytest.raises(Exception):
        interchange.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl").collect()


def test_graph_files(spark, tmp_path):
    nodes = spark.createDataFrame([("a<", "Tool", "n & m", None, None, None, None, None, None, 0.5, 3)], graph.NODES)
    edges = spark.createDataFrame([("a<", "b", "X", None, 0.25)], graph.EDGES)
    interchange.save_graph(nodes, edges, f"file://{tmp_path}/g")
    interchange.write_graph_json(nodes, edges, f"{tmp_path}/g.json.gz", compressed=True)
    interchange.write_graph_json(nodes, edges, f"{tmp_path}/l.json", links="links")
    interchange.write_graphml(nodes, edges, f"{tmp_path}/g.graphml")
    for n, e in (interchange.load_graph(spark, f"file://{tmp_path}/g"), interchange.read_graph_json(spark, f"file://{tmp_path}/g.json.gz"), interchange.read_graph_json(spark, f"file://{tmp_path}/l.json", "links"), interchange.read_graphml(spark, f"file://{tmp_path}/g.graphml")):
        assert n.collect() == nodes.collect() and e.collect() == edges.collect()
    assert interchange.load_graph(spark, f"file://{tmp_path}/none")[0].count() == 0


def test_embeddings(spark, tmp_path):
    texts = spark.createDataFrame([("a", "x y"), ("b", "z"), ("c", None)], "id string, text string")
    made = interchange.embed(texts, spark.createDataFrame([("b", [1.0])], "id string, embedding array<float>"), interchange.hashing_embedder(8))
    got = dict(made.collect())
    assert got["b"] == [1.0] and len(got["a"]) == 8 and len(got) == 3
    path = f"file://{tmp_path}/e"
    interchange.save_embeddings(made.where("id = 'a'"), path, 8)
    assert interchange.load_embeddings(spark, path).count() == 1
    with pytest.raises(Exception, match="vector of size"):
        interchange.save_embeddings(made, path, 8)


def test_cache(spark):
    r = spark.createDataFrame([("p", "m", None), ("p", "m", ""), ("p", "n", None), ("p", "m", None)], "prompt string, model string, system string")
    keyed = r.withColumn("prompt_hash", cache.request_hash("prompt", "model", "system"))
    keys = [x["prompt_hash"] for x in keyed.collect()]
    assert len(set(keys)) == 3 and keys[0] == keys[3] and all(len(k) == 32 for k in keys)
    entries = keyed.limit(1).select("prompt_hash", F.lit("c").alias("content"), "model", F.current_timestamp().alias("created_at"), F.lit(0).cast("long").alias("hit_count"), F.current_timestamp().alias("last_accessed"))
    s = cache.stats(keyed, entries).first()
    assert (s["hits"], s["misses"], s["entries"]) == (2, 2, 1)
    assert cache.touched(entries, keyed, F.current_timestamp()).first()["hit_count"] == 2
    assert cache.misses(keyed, entries).count() == 2 and cache.invalidate(entries, keyed).count() == 0 and cache.latest(entries.union(entries)).count() == 1
    assert cache.recent(entries, 0).count() == 0 and len(cache.by_shard(entries).first()["shard"]) == 2


def test_defaults_of_variables_end_at_the_first_brace(monkeypatch):
    monkeypatch.setenv("HERE", "v")
    given = ["${HERE}", "a${GONE:-d}b", "${GONE:-${HERE}}", "${HERE:-${GONE}}", "${", "${}", "x${HERE", "${GONE:x}${HERE}", "${GONE:-}"]
    assert config.expand(given) == ["v", "adb", "${HERE}", "v}", "${", "${}", "x${HERE", "${GONE:x}v", ""]


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("CONVOLAKE_T", "0.5")
    (tmp_path / "c.yaml").write_text("similarity: {threshold: '${CONVOLAKE_T}', fast: '${NO_SUCH:-true}'}\n")
    c = config.load(tmp_path / "c.yaml")
    assert c["similarity"] == {"threshold": "0.5", "top_k": 0, "fast": True} and c["sampling"]["min_steps"] == 2
    with pytest.raises(ValueError):
        config.expand({"a": ["${NO_SUCH_NAME}"]})
    c = config.override(c, similarity__threshold=2, sampling__min_steps=None)
    assert config.warnings(c) == ["similarity: the threshold is outside 0 to 1"]
    config.save(c, tmp_path / "d.json")
    assert config.load(tmp_path / "d.json") == c


def test_generation(spark):
    chains = spark.createDataFrame([("a", [["e1", "e2"], ["e2", "e1"]]), ("b", [["e3"]]), ("c", [["e1", "e2", "e3"]])], "conv string, attempts array<array<string>>")
    made = generation.generate(chains, generation.FakeModel(least=1))
    one, two = sorted(made.collect()), sorted(made.collect())
    assert one == two and len(one) == 3
    good = generation.generate(chains, generation.FakeModel(least=8)).collect()
    assert all(r["success"] and r["attempts"] == 1 and not r["repaired"] for r in good)
    assert sorted(len(r["tool_outputs"]) for r in good) == [1, 2, 3]
    for r in good:
        calls = [c["id"] for m in r["messages"] for c in m["tool_calls"] or []]
        assert calls == [m["tool_call_id"] for m in r["messages"] if m["role"] == "tool"]
    none = generation.generate(chains, generation.FakeModel(fail_every=1)).collect()
    assert not any(r["success"] for r in none) and none[0]["error"] == "no answer"
    assert generation.extract(generation.FakeModel(fail_every=1), {"order_id": 7}) == {"order_id": "7"}
    seen = []
    steered = generation.generate_steered(lambda done: seen.append(0 if done is None else done.count()) or chains, generation.FakeModel(), 2)
    assert steered.count() == 6 and seen == [0, 3]


class Fixed:
    def __init__(self, answer):
        self.answer = answer

    def complete(self, prompt):
        return self.answer


def test_model_calls():
    assert generation.complete_structured(Fixed('so: {"a": 1}'), "p", {"a": int}) == {"a": 1}
    for answer in ('{"a": "x"}', "{}", "none"):
        with pytest.raises(generation.ModelError):
            generation.complete_structured(Fixed(answer), "p", {"a": int})
    assert generation.chat(Fixed("hi"), [{"role": "user", "content": "hello"}]) == "hi"
    tools = [{"name": "f"}]
    text, calls = generation.complete_with_tools(Fixed('{"name": "f", "arguments": {"x": 1}}'), "p", tools)
    assert text == "" and calls[0]["function"] == {"name": "f", "arguments": '{"x": 1}'}
    assert generation.complete_with_tools(Fixed('{"name": "g"}'), "p", tools) == ('{"name": "g"}', [])
    assert generation.complete_with_tools(Fixed("text"), "p", tools) == ("text", [])


def test_inference(spark):
    e = spark.createDataFrame([("e1", "GET", "/x", "a", "", None, [("p", "unknown")]), ("e2", "GET", "/y", "b", "said", "{}", [("q", "string")])], "id string, method string, path string, name string, description string, response_schema string, parameters array<struct<name:string,type:string>>")
    found = generation.infer_fields(e, generation.FakeModel())
    rows = {(r["endpoint_id"], r["field"]): r for r in found.collect()}
    assert set(rows) == {("e1", "description"), ("e1", "response_schema"), ("e1", "type")} and rows["e1", "type"]["parameter"] == "p"
    known = found.select("key", "value")
    again = generation.infer_fields(e, generation.FakeModel(fail_every=1), known)
    assert again.where("cached").count() == 3 and again.count() == 3
    done = {r["id"]: r for r in generation.apply_inferred(e, found).collect()}
    assert done["e1"]["response_schema"] == '{"type": "object"}' and done["e1"]["description"] and done["e2"]["description"] == "said" and done["e2"]["inferred_fields"] is None
    assert {r["field"]: r["n"] for r in generation.inference_stats(found).collect()} == {"description": 1, "response_schema": 1, "type": 1}


def test_streams(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("event_id"), (F.timestamp_seconds(F.col("id") * 600)).alias("ts"), (F.col("id") % 3).alias("user_id"), F.concat(F.lit("t"), (F.col("id") % 4).cast("string")).alias("event_type"), F.lit(1.5).alias("value"))
    path = f"file://{tmp_path}/events"
    rows.repartition(4).write.parquet(path)
    counts = {r["event_type"]: (r["n"], r["total"]) for r in tracker.run_once(tracker.tool_counts(tracker.read_events(spark, path, files=2)), "complete").collect()}
    assert counts == {f"t{k}": (50, 75.0) for k in range(4)}
    windows = tracker.run_once(tracker.windowed_counts(tracker.read_events(spark, path), "6 hours", "1 minute"))
    batch = rows.groupBy(F.window("ts", "6 hours")["start"].alias("start"), "event_type").agg(F.count("*").alias("n"))
    closed = {tuple(r) for r in windows.collect()}
    assert closed and closed < {tuple(r) for r in batch.collect()}
    ended = tracker.run_to_end(tracker.read_events(spark, path, files=1), lambda e: tracker.windowed_counts(e, "6 hours", "3 days"))
    assert sorted(tuple(r) for r in ended.collect()) == sorted(tuple(r) for r in batch.collect())
    first = tracker.run_once(tracker.new_patterns(tracker.read_events(spark, path), "30 days"))
    assert first.count() == 12
    s = tracker.run_once(tracker.sessions(tracker.read_events(spark, path), "20 minutes", "1 minute"))
    assert s.count() > 100 and s.agg(F.max("n")).first()[0] == 1
    ended = tracker.run_to_end(tracker.read_events(spark, path), lambda e: tracker.sessions(e, "1 hour", "1 minute"))
    assert sorted(tuple(r) for r in ended.select("user_id", "n").collect()) == [(0, 67), (1, 67), (2, 66)]


def test_truth_of_required(spark, tmp_path):
    values = [True, False, 1, 0, None, "True", "no", "", [], [0]]
    doc = {"name": "t", "api_list": [{"name": "e", "required_parameters": [{"name": f"p{k}", "required": v} for k, v in enumerate(values)] + [{"name": "given"}], "parameters": {"q": {"param_type": "int", "parameter_type": "bool", "parameter_description": "x"}, "r": {"required": 1}}}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    e = specs.parse_endpoints(specs.parse_tools(specs.scan(spark, f"file://{tmp_path}"))).first()
    got = {p["name"]: p for p in e["parameters"]}
    assert [got[f"p{k}"]["required"] for k in range(len(values))] == [True, False, True, False, False, True, False, False, False, True]
    assert got["given"]["required"] and got["r"]["required"] and got["q"]["type"] == "boolean" and got["q"]["description"] == ""


def test_embedding_cache(spark, tmp_path):
    path = f"file://{tmp_path}/vectors"
    interchange.save_embeddings(spark.createDataFrame([("a", [1.0, 2.0])], "id string, embedding array<float>"), path, 2)
    assert interchange.load_embeddings(spark, path, 2).count() == 1
    with pytest.raises(Exception, match="3 is due"):
        interchange.load_embeddings(spark, path, 3).collect()
    interchange.clear_embeddings(spark, path)
    assert interchange.load_embeddings(spark, path).count() == 0


def test_repairs_and_errors():
    talk = generation.Talk("c", ["e"])
    talk.say("user", "hi")
    talk.say("assistant", "well")
    low = dict.fromkeys(generation.DIMENSIONS, 3)

    class Says:
        def __init__(self, *answers):
            self.answers = list(answers)

        def complete(self, prompt):
            answer = self.answers.pop(0)
            if isinstance(answer, Exception):
                raise answer
            return answer

    better = json.dumps({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "better"}]})
    out = generation.repair(Says(better), talk, low, 6)
    assert out.id != talk.id and [m["content"] for m in out.messages] == ["hi", "better"] and talk.messages[1]["content"] == "well"
    assert generation.repair(Says(better), talk, dict.fromkeys(generation.DIMENSIONS, 6), 6) is talk
    for bad in ("no", "{}", json.dumps({"messages": []}), json.dumps({"messages": [{"role": "assistant", "content": "x"}]}), better.replace('"assistant"', '"robot"'), generation.ServiceError("down", 400)):
        assert generation.repair(Says(bad), talk, low, 6) is talk
    # Transient errors are tried again, others aren't.
    assert generation.complete(Says(generation.RateLimited("slow", 0.001), generation.Unreachable("gone"), "ok"), "p") == "ok"
    assert generation.complete(Says(generation.ServiceError("busy", 503), "ok"), "p") == "ok"
    for error in (generation.ServiceError("no such", 404), generation.InvalidAnswer("odd")):
        with pytest.raises(type(error)):
            generation.complete(Says(error, "ok"), "p")
    with pytest.raises(generation.InvalidAnswer):
        generation.complete_json(Says("none"), "p")


def test_tool_of_schema():
    from pyspark.sql.types import ArrayType, DecimalType, IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("city", StringType(), False), StructField("days", ArrayType(IntegerType())), StructField("price", DecimalType(9, 2))])
    assert conversation.tool_of_schema("f", "does", schema) == {
        "name": "f", "description": "does",
        "input_schema": {"type": "object", "properties": {"city": {"type": "string"}, "days": {"type": "array", "items": {"type": "integer"}}, "price": {"type": "number"}}, "required": ["city"]},
    }


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from convolake import storage

    empty = SimpleNamespace(get=lambda *_: None)
    session = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: empty, master=master, applicationId="a"), conf=empty)
    with pytest.raises(ValueError, match="checkpoint"):
        storage.shared_dir(session("spark://host:7077"))
    assert storage.shared_dir(session("local[2]")).startswith("file:/")


def test_graph_documents_are_read_in_parts(spark, tmp_path):
    said = ["plain", 'a "b" <c> & d', "two\nlines", "tab\there", ",comma", "] {\"id\": 1}"]
    nodes = spark.createDataFrame([(f"n{k}\n{said[k % 6]}", "Endpoint", said[k % 6]) for k in range(300)], "id string, type string, name string")
    nodes = graph._shape(nodes, graph.NODES)
    edges = graph._shape(nodes.select(F.col("id").alias("src"), F.concat("id", F.lit("x")).alias("dst"), F.lit("IN_DOMAIN").alias("type"), F.lit(0.5).alias("weight")), graph.EDGES)
    interchange.write_graph_json(nodes, edges, f"{tmp_path}/g.json", links="links")
    interchange.write_graphml(nodes, edges, f"{tmp_path}/g.graphml")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        for n, e in (interchange.read_graph_json(spark, f"file://{tmp_path}/g.json", links="links", lined=True), interchange.read_graphml(spark, f"file://{tmp_path}/g.graphml", lined=True)):
            assert n.rdd.getNumPartitions() > 1 and e.rdd.getNumPartitions() > 1
            assert sorted(map(str, n.collect())) == sorted(map(str, nodes.collect()))
            assert sorted(map(str, e.collect())) == sorted(map(str, edges.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_specifications_by_lines(spark, tmp_path):
    """One file, a tool a line: ids, categories by folder and nameless tools as of a file each; and the query writes few files."""
    (tmp_path / "my_films").mkdir()
    docs = [{"id": "a", "name": "A", "api_list": [{"name": "x"}]}, {"tool_name": "B b", "endpoints": [{"name": "y", "parameters": {"p": {"type": "int"}}}]}, {"apis": []}, {"apis": [{"name": "\r\n"}]}, [1]]
    (tmp_path / "my_films" / "all.json").write_text("\n".join(json.dumps(d) for d in docs) + "\nno json\n")
    tools = specs.parse_tools(specs.scan_lines(spark, f"file://{tmp_path}")).collect()
    assert len(tools) == 4 and {t["category"] for t in tools} == {"my films"} and {"A", "B b"} < {t["name"] for t in tools} and len({t["id"] for t in tools}) == 4
    assert {e["name"] for e in specs.parse_endpoints(specs.parse_tools(specs.scan_lines(spark, f"file://{tmp_path}"))).collect()} == {"x", "y", "\r\n"}
    from convolake import catalog_records

    held = catalog_records._spec_files(spark, "/root/testdata/sf0.001")
    assert held.count() > len(held.inputFiles())
