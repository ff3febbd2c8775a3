"""Operators against plain loops over the same rows."""

import math
import random
from collections import Counter, deque
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from convolake import catalog
from convolake.functions.conversation import CONVERSATION
from convolake.operators import diversity, graph, metrics, quality, sampling, similarity, validation
from convolake.plans import patterns


def test_entropy(spark):
    of = lambda counts, **o: metrics.entropy_of(spark.createDataFrame([(str(k), n) for k, n in enumerate(counts)], "k string, n long"), **o).first()
    assert of([50, 30, 20])["entropy"] == pytest.approx(1.0296530, abs=1e-6)
    assert of([90, 5, 5], base=2)["entropy"] == pytest.approx(0.5689956, abs=1e-6)
    assert of([4, 4])["entropy_norm"] == pytest.approx(1) and of([7])["entropy"] == 0 and of([0, 3])["n_items"] == 1


def test_pairs_and_gini(spark):
    pairs = spark.createDataFrame([("a", "b", 2), ("b", "c", 0)], "a string, b string, n long")
    row = metrics.pair_ratio(pairs).first()
    assert (row["n_pairs"], row["n_items"]) == (1, 3) and row["pair_ratio"] == pytest.approx(1 / 3)
    assert metrics.pair_ratio(pairs, F.lit(1)).first()["pair_ratio"] == 0
    g = lambda xs: metrics.gini(spark.createDataFrame([(x,) for x in xs], "n long")).first()[0]
    assert g([5, 5, 5]) == pytest.approx(0) and g([0, 0, 9]) == pytest.approx(2 / 3) and g([1, 2, 3, 4]) == pytest.approx(0.25)


def test_diversity(spark):
    rng = random.Random(2)
    registry = [(f"e{k}", f"t{k % 5}", f"d{k % 3}") for k in range(12)]
    chains = [(c, rng.choice(registry)[0] if rng.random() < 0.9 else "unknown") for c in range(30) for _ in range(rng.randint(1, 5))]
    r = spark.createDataFrame(registry, "endpoint string, tool string, domain string")
    called = diversity.calls(spark.createDataFrame(chains, "conv long, endpoint string"), r)
    tool = {e: t for e, t, _ in registry}
    sets = {}
    for c, e in chains:
        if e in tool:
            sets.setdefault(c, set()).add(tool[e])
    want = Counter(p for s in sets.values() for p in combinations(sorted(s), 2))
    assert {(x["a"], x["b"]): x["n"] for x in diversity.tool_pairs(called).collect()} == want
    n = Counter(tool[e] for _, e in chains if e in tool)
    got = dict(diversity.weights(called, r).collect())
    assert got["e0"] == pytest.approx(max(n.values()) / (n["t0"] + 1)) and len(got) == 12
    none = called.limit(0)
    assert {w for _, w in diversity.weights(none, r).collect()} == {1.0}
    assert diversity.suggest(none, r).first()["domain"] == "d0"
    m = diversity.diversity_metrics(called).first()
    assert m["n_patterns"] == len({tuple(sorted(s)) for s in sets.values()}) and m["tool_entropy"] == pytest.approx(-sum(x / n.total() * math.log(x / n.total()) for x in n.values()))


def test_quality(spark):
    rows = [("a", True, 1, False, 8, 8, 8, 8, ["t.x", "t.y", "u"]), ("b", True, 2, True, 5, 5, 5, 5, ["t.x"]), ("c", True, 3, False, None, None, None, None, []), ("d", False, 4, False, 9, 9, 9, 9, [])]
    df = spark.createDataFrame(rows, "conversation_id string, success boolean, attempts long, repaired boolean, tool_correctness long, argument_grounding long, task_completion long, naturalness long, endpoint_ids array<string>")
    s = quality.aggregate_scores(df).first()
    assert (s["total_conversations"], s["successful_conversations"], s["total_attempts"], s["mean_attempts"]) == (4, 2, 10, 2.5)
    assert (s["mean_overall"], s["pass_rate"], s["repair_rate"], s["multi_step_rate"], s["multi_tool_rate"]) == (6.5, 0.5, 0.5, 0.5, 0.5)
    empty = quality.aggregate_scores(df.limit(0)).first()
    assert empty["total_attempts"] == 0 and empty["pass_rate"] == 0 and quality.pass_rate(df.limit(0)).first()[0] == 0
    assert "Pass Rate:           50.0%" in quality.report(quality.aggregate_scores(df)).first()[0]
    assert [r[0] for r in df.where(quality.needs_repair()).select("conversation_id").collect()] == ["b"]


def test_validation(spark):
    call = {"id": "1", "function": {"name": "f", "arguments": "{}"}}
    ok = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None, "tool_calls": [call]}, {"role": "tool", "content": "x", "tool_call_id": "1"}]
    bad = [{"role": "robot", "content": "x"}, {"role": "user", "content": " "}, {"role": "assistant", "content": "", "tool_calls": [{"id": "2", "function": {"name": "", "arguments": "{"}}]}, {"role": "tool", "content": None}]
    output = {"endpoint_id": "", "arguments": "[1]", "result": "{}", "call_id": None, "success": True}
    fill = lambda ms: [{"tool_calls": None, "tool_call_id": None, **m} for m in ms]
    rows = [("a", fill(ok), None, None, None), (" ", fill(bad), [output], None, None), (None, [], [], None, None), ("d", None, None, None, None)]
    df = spark.createDataFrame(rows, CONVERSATION)
    got = [r["errors"] for r in validation.validate_structure(df).collect()]
    assert got[0] == []
    assert got[1] == [
        "conversation id is empty", "messages[0]: invalid role 'robot'", "messages[1]: user message needs content", "messages[2].tool_calls[0]: name must not be empty", "messages[2].tool_calls[0]: arguments are not JSON",
        "messages[3]: tool message needs content", "messages[3]: tool message needs a call id", "tool_outputs[0]: endpoint id must not be empty", "tool_outputs[0]: arguments must be an object", "tool_outputs[0]: call id must not be empty",
    ]
    assert got[2] == ["conversation id is missing", "messages are empty"] and got[3] == ["messages are missing"]
    assert [r["is_valid"] for r in validation.validate_read(df).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(validation.roles_repairable()).collect()] == [True, False, False, False]


def nodes_edges(spark):
    endpoints = [(f"e{k}", f"t{k % 4}", f"name {k}", ("x", "y", None)[k % 3], k / 10) for k in range(10)]
    e = spark.createDataFrame(endpoints, "id string, tool_id string, name string, domain string, completeness_score double")
    t = spark.createDataFrame([(f"t{k}", f"tool {k}", "c") for k in range(5)], "id string, name string, category string")
    return graph.build_nodes(t, e), graph.build_edges(e), e, t


def test_domain_candidates_are_neighbor_candidates(spark):
    """Every endpoint's candidates against the ones by pairs; one tool holds most of a domain."""
    rows = [(f"e{k}", ("t0" if k % 5 < 3 else None if k % 10 == 9 else f"t{k % 7}"), ("x", "y", "x", None, "x", "")[k % 6], (k % 11) / 10) for k in range(90)] + [("lone", "t1", "z", 0.9)]
    e = spark.createDataFrame(rows, "id string, tool_id string, domain string, completeness_score double").coalesce(1)
    weights = spark.createDataFrame([(f"e{k}", 0.5 + (k * 37 % 11) / 4) for k in range(0, 90, 2)], "endpoint string, weight double").coalesce(1)
    c = sampling.Constraints(min_completeness=0.3, excluded_tools=("t5",))
    for w, most in ((None, 3), (weights, 4), (None, 100)):
        found = sampling.domain_candidates(e, c, w, most, seed=5).collect()
        pairs = sampling.neighbor_candidates(e.select(F.array("id").alias("path")), graph.empty(spark)[1], e, c, w, most, seed=5, by_domain=True).collect()
        assert {(r["start"], r["rank"]): (r["id"], r["tool_id"], r["w"]) for r in found} == {(r["path"][0], r["rank"]): (r["id"], r["tool_id"], r["w"]) for r in pairs}
        assert len(found) == len(pairs) and len({r["start"] for r in found}) > 50


def test_neighbor_rank_covers_all_endpoints(spark, tmp_path):
    """One row for each endpoint that has a candidate, not for one tool's only."""
    part = spark.range(1, 61).selectExpr("id AS p_partkey", "'n' AS p_name", "'c' AS p_type", "concat('Brand#', id % 3) AS p_brand")
    part.write.parquet(str(tmp_path / "part.parquet"))
    assert catalog.QUERIES["neighbor_rank"](spark, str(tmp_path)).select("start").distinct().count() == 60


def test_shortest_path_of_any_length(spark):
    """A chain of 70 steps, with a shortcut and a part that isn't connected."""
    links = [(f"n{k:02}", f"n{k + 1:02}", "X") for k in range(72)] + [("n00", "n02", "X"), ("far", "away", "X")]
    edges = spark.createDataFrame(links, "src string, dst string, type string").coalesce(1)
    path = graph.shortest_path(edges, "n00", "n71")
    assert path == ["n00"] + [f"n{k:02}" for k in range(2, 72)]
    assert graph.shortest_path(edges, "n00", "n05", most=3) is None and len(graph.shortest_path(edges, "n00", "n05", most=4)) == 5
    assert graph.shortest_path(edges, "n00", "far") is None


def test_graph(spark):
    nodes, edges, e, t = nodes_edges(spark)
    assert nodes.count() == 5 + 10 + 2 and edges.count() == 10 + 7
    assert graph.same_domain_edges(e).count() == 6 + 3
    near = {}
    for a, b, _ in edges.select("src", "dst", "type").collect():
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def depths(start):
        found, todo = {start: 0}, deque([start])
        while todo:
            x = todo.popleft()
            for y in near.get(x, ()):
                if y not in found:
                    found[y] = found[x] + 1
                    todo.append(y)
        return found

    want = {n: d for n, d in depths("e0").items() if d <= 3}
    starts = spark.createDataFrame([("e0",)], "id string")
    assert {r["node"]: r["depth"] for r in graph.bfs(edges, starts, 3).collect()} == want
    ends = {r["node"] for r in graph.reachable_endpoints(edges, nodes, starts, 2).collect()}
    assert ends == {n for n, d in depths("e0").items() if 0 < d <= 2 and n.startswith("e")}
    path = graph.shortest_path(edges, "e0", "e1")
    assert path[0] == "e0" and path[-1] == "e1" and len(path) == depths("e0")["e1"] + 1 and all(b in near[a] for a, b in zip(path, path[1:]))
    assert graph.shortest_path(edges, "e0", "t4") is None and graph.shortest_path(edges, "zz", "zz") == ["zz"]
    kept, inner = graph.subgraph(nodes, graph.upsert_edges(edges, graph.same_domain_edges(e)), ["x"])
    assert kept.count() == 4 and inner.count() == 6
    walks = {r["walk"]: r["path"] for r in graph.random_walks(edges, spark.createDataFrame([("a", "e0"), ("b", "t4")], "walk string, id string"), 4).collect()}
    assert walks["b"] == ["t4"] and len(walks["a"]) == 5 and all(y in near[x] for x, y in zip(walks["a"], walks["a"][1:]))
    assert graph.add_nodes(nodes, nodes).count() == nodes.count() and graph.upsert_edges(edges, edges).count() == edges.count()
    assert graph.density(*graph.empty(spark)).first()["density"] == 0
    assert graph.by_category(e, t, "c").count() == 10 and graph.complete_enough(e, 0.5).count() == 5


def test_greedy_top_k(spark):
    rng = random.Random(7)
    for k in (1, 2, 4):
        pairs = [(a, b, rng.choice([0.5, 0.6, 0.7, 0.8])) for a, b in combinations(range(12), 2) if rng.random() < 0.6]
        used, want = Counter(), set()
        for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
            if used[a] < k or used[b] < k:
                want.add((a, b))
                used[a] += 1
                used[b] += 1
        got = similarity.greedy_top_k(spark.createDataFrame(pairs, "a long, b long, score double"), k).collect()
        assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)


def test_cosine(spark):
    rng = random.Random(1)
    rows = [(f"v{k:02d}", [rng.gauss(0, 1) for _ in range(6)] if k else [0.0] * 6, str(k % 2)) for k in range(40)]
    df = spark.createDataFrame(rows, "id string, embedding array<float>, domain string")
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = {(a[0], b[0]) for a, b in combinations(rows[1:], 2) if dot(a[1], b[1]) / math.sqrt(dot(a[1], a[1]) * dot(b[1], b[1])) >= 0.4}
    for size in (7, 2048):
        pairs = similarity.cosine_pairs(df, 0.4, size)
        assert {(r["a"], r["b"]) for r in pairs.collect()} == want
    assert similarity.semantic_edges(df, 0.4).count() == sum(int(a[1:]) % 2 != int(b[1:]) % 2 for a, b in want)
    assert df.alias("a").crossJoin(df.alias("b")).where("a.id = 'v00'").select(similarity.cosine("a.embedding", "b.embedding").alias("c")).where("c <> 0").count() == 0


def test_chains(spark):
    c = sampling.Constraints(min_steps=2, max_steps=3, required_domains=("x",), excluded_tools=("t9",), min_completeness=0.5, require_multi_tool=True)
    chains = [[("a", "t1", "x", 0.9), ("b", "t2", "y", 0.8)], [("a", "t1", "y", None)], [], [("a", "t9", "x", 0.4)] * 4]
    df = spark.createDataFrame(list(enumerate(chains)), f"k long, chain array<{sampling.STEP}>")
    assert [r[0] for r in df.orderBy("k").select(F.size(sampling.chain_errors("chain", c))).collect()] == [0, 4, 3, 10]
    for wrong in ({"min_steps": 3, "max_steps": 2}, {"min_completeness": 2}, {"pattern": "odd"}, {"required_tools": ("a",), "excluded_tools": ("a",)}):
        with pytest.raises(ValueError):
            sampling.Constraints(**wrong)


def test_depth_first_search(spark):
    rng = random.Random(11)
    n = 14
    rows = [(f"e{k:02d}", f"t{k % 4}", "xy"[k % 2], rng.randint(2, 10) / 10) for k in range(n)]
    pairs = [(a, b) for a, b in combinations(range(n), 2) if rng.random() < 0.35]
    e = spark.createDataFrame(rows, "id string, tool_id string, domain string, completeness_score double")
    edges = spark.createDataFrame([(rows[a][0], rows[b][0], graph.SAME_DOMAIN, 1.0, None) for a, b in pairs], graph.EDGES)
    c = sampling.Constraints(min_steps=2, max_steps=4, required_domains=("y",), min_completeness=0.4, require_multi_tool=True)
    starts = [r["id"] for r in sampling.start_candidates(e, c, most=3).orderBy("rank").collect()]
    data = {r[0]: r for r in rows}
    for lowest in (False, True):
        visits, found, stack = 0, [], []
        for s in starts:
            stack = [[s]]
            while stack and visits < 60:
                path = stack.pop()
                visits += 1
                chain = [data[x] for x in path]
                if len(path) >= 2 and any(x[2] == "y" for x in chain) and len({x[1] for x in chain}) > 1:
                    found.append((visits, path))
                if len(path) < 4:
                    near = _ranked(path, pairs, rows, spark)
                    stack += near if lowest else near[::-1]
        got = [(r["visit"], r["path"]) for r in sampling.sample_chains(e, edges, c, attempts=60, starts=3, fan=3, lowest_first=lowest).orderBy("visit").collect()]
        assert got == found


def test_domain_neighbours_need_no_edges(spark):
    rows = [(f"e{k:02d}", f"t{k % 5}", ("x", "y", None)[k % 3], (k % 7 + 3) / 10) for k in range(30)]
    e = spark.createDataFrame(rows, "id string, tool_id string, domain string, completeness_score double")
    c = sampling.Constraints(min_steps=3, max_steps=4, min_completeness=0.4)
    made = sampling.sample_chains(e, graph.same_domain_edges(e), c, starts=3, fan=3)
    found = sampling.sample_chains(e, graph.empty(spark)[1], c, starts=3, fan=3, by_domain=True)
    assert sorted(made.collect()) == sorted(found.collect()) and made.count() > 5


_CACHE = {}


def _ranked(path, pairs, rows, spark):
    """The best three neighbours of a path's end, best first, each as a longer path."""
    names = [r[0] for r in rows]
    last = names.index(path[-1])
    near = {names[b if a == last else a] for a, b in pairs if last in (a, b)} - set(path)
    kept = [r for r in rows if r[0] in near and r[3] >= 0.4]
    tools = Counter(r[1] for r in kept)
    if not _CACHE:
        df = spark.createDataFrame([(x,) for x in names], "id string").select("id", F.md5(F.concat_ws("|", "id", F.lit("0"))).alias("h"))
        _CACHE.update(dict(df.collect()))
    order = sorted(kept, key=lambda r: (-1 / (tools[r[1]] + 1), _CACHE[r[0]], r[0]))[:3]
    return [[*path, r[0]] for r in order]


def test_plans(spark):
    df = spark.createDataFrame([(1, list("abcd")), (2, list("ab")), (3, [])], "k long, chain array<string>")
    plan = lambda name: {k: [(r["endpoint_id"], r["depends_on"], r["is_parallel"]) for r in p] for k, p in df.select("k", patterns.plan("chain", name)).collect()}
    assert plan("parallel")[1] == [("a", [], True), ("b", [], True), ("c", ["a", "b"], False), ("d", ["c"], False)]
    assert plan("sequential")[1] == plan("branching")[1] == [("a", [], False), ("b", ["a"], False), ("c", ["b"], False), ("d", ["c"], False)]
    assert [s[0] for s in plan("iterative")[1]] == ["a", "b", "b", "d"] and plan("iterative")[2] == plan("sequential")[2] and plan("parallel")[3] == []
    one = spark.createDataFrame([({"p": ["x"], "q": ["y", "z"]},)], "b map<string,array<string>>")
    ids = lambda s: [r["endpoint_id"] for r in one.select(patterns.branching(F.lit("s"), "b", F.lit("m"), s)).first()[0]]
    assert ids(None) == ["s", "x", "m"] and ids("q") == ["s", "y", "z", "m"] and ids("nope") == ["s", "m"]
    assert [r["endpoint_id"] for r in one.select(patterns.iterative(F.lit("s"), F.lit("l"), 0, F.lit("e"))).first()[0]] == ["s", "e"]


def test_generation_summary_is_whole(spark):
    schema = "success boolean, repaired boolean, messages array<string>, endpoint_ids array<string>, tool_outputs array<struct<domain:string>>, tool_correctness int, argument_grounding int, task_completion int, naturalness int"
    rows = [(True, True, ["a", "b"], ["t1/x", "t1/y", "t2/x"], [("d",), ("d",), ("e",)], 8, 8, 8, 8), (True, False, ["a"] * 4, ["t2", "t3"], [(None,), ("d",)], 6, 6, 6, 6), (False, False, ["a"] * 9, ["t9/x"], [("f",)], 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, schema)
    s = quality.generation_summary(df, top=2).first()
    assert (s["n"], s["succeeded"], s["failed"], s["repaired"], s["avg_turns"], s["avg_calls"], s["avg_score"]) == (3, 2, 1, 1, 3.0, 2.5, 7.0)
    assert (s["n_tools"], s["n_domains"], [tuple(t) for t in s["top_tools"]]) == (3, 2, [("t1", 2), ("t2", 2)])
    none = quality.generation_summary(df.limit(0)).first()
    assert (none["n"], none["n_tools"], none["top_tools"]) == (0, 0, [])


def test_upserts_keep_what_newer_nodes_do_not_say(spark):
    old = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "id string, name string, completeness_score double")
    new = spark.createDataFrame([("b", "z"), ("c", "w")], "id string, name string")
    assert sorted(tuple(r) for r in graph.upsert_nodes(old, new).collect()) == [("a", "x", 1.0), ("b", "z", 2.0), ("c", "w", None)]


def test_walks_over_a_hub_are_even(spark):
    edges = spark.createDataFrame([("hub", f"n{k}", "X") for k in range(300)], "src string, dst string, type string")
    walks = graph.random_walks(edges, spark.range(3000).select(F.col("id").alias("walk"), F.lit("hub").alias("id")), 2).collect()
    assert all(r["path"][0] == r["path"][2] == "hub" for r in walks)
    met = {}
    for r in walks:
        met[r["path"][1]] = met.get(r["path"][1], 0) + 1
    assert len(met) == 300 and max(met.values()) < 30
