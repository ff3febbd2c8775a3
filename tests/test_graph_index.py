"""The adjacency index and paths of many pairs against plain searches."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from convolake.operators import graph


def edges_of(spark, pairs):
    return spark.createDataFrame([(a, b, "X", None, None) for a, b in pairs], graph.EDGES)


def plainly(pairs, start, goal):
    """The smallest of the shortest paths: distances from the goal, then down from the start."""
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    far, queue = {goal: 0}, deque([goal])
    while queue:
        x = queue.popleft()
        for y in near.get(x, ()):
            if y not in far:
                far[y] = far[x] + 1
                queue.append(y)
    if start == goal:
        return [start]
    if start not in far:
        return None
    path = [start]
    while path[-1] != goal:
        path.append(min(y for y in near[path[-1]] if far.get(y, -1) == far[path[-1]] - 1))
    return path


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_of_many_pairs(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"n{rng.randrange(80):02}", f"n{rng.randrange(80):02}") for _ in range(90)] + [(f"x{k:02}", f"x{k + 1:02}") for k in range(12)]
    asked = [(f"n{rng.randrange(80):02}", f"n{rng.randrange(80):02}") for _ in range(60)] + [("x00", "x12"), ("x00", "n01"), ("n01", "gone"), ("gone", "gone"), ("n05", "n05"), ("x00", "x12"), (None, "n01")]
    got = {(r["start"], r["goal"]): (r["length"], list(r["path"])) for r in graph.shortest_paths(edges_of(spark, pairs), spark.createDataFrame(asked, "start string, goal string")).collect()}
    want = {(a, b): (len(p) - 1, p) for a, b in asked if a is not None and (p := plainly(pairs, a, b)) is not None}
    assert got == want
    assert got["x00", "x12"][0] == 12 and ("x00", "n01") not in got


def test_pairs_that_share_hubs_meet_without_growing_them(spark, monkeypatch):
    pairs = [(f"e{k:03}", x) for k in range(200) for x in (f"t{k % 4}", f"d{k % 5}")] + [("t0", "far"), ("far", "farther"), ("y0", "y1")]
    asked = [(f"e{k:03}", f"e{(k * 7 + 3) % 200:03}") for k in range(40)] + [("e001", "farther"), ("farther", "e002"), ("t0", "d1"), ("e001", "y1")]
    met, between = [], graph._between
    monkeypatch.setattr(graph, "_between", lambda *x: met.append(between(*x)) or met[-1])
    want = {(a, b): p for a, b in asked if (p := plainly(pairs, a, b)) is not None}
    got = {(r["start"], r["goal"]): list(r["path"]) for r in graph.shortest_paths(edges_of(spark, pairs), spark.createDataFrame(asked, "start string, goal string")).collect()}
    assert got == want
    assert sum(m.count() for m in met if m is not None) >= 30


def test_paths_up_to_a_length_and_of_nothing(spark):
    edges = edges_of(spark, [(f"x{k}", f"x{k + 1}") for k in range(6)])
    asked = spark.createDataFrame([("x0", "x6"), ("x0", "x3")], "start string, goal string")
    assert [(r["start"], r["goal"]) for r in graph.shortest_paths(edges, asked, most=3).collect()] == [("x0", "x3")]
    assert graph.shortest_paths(edges, asked.limit(0)).count() == 0
    assert graph.shortest_paths(edges.limit(0), asked).count() == 0


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


@pytest.mark.parametrize("most", [100_000, 20])
def test_rounds_do_not_send_edges(spark, no_broadcast, most):
    rng = random.Random(4)
    pairs = [("hub", f"n{k}") for k in range(100)] + [(f"n{rng.randrange(100)}", f"n{rng.randrange(100)}") for _ in range(150)]
    edges = edges_of(spark, pairs)
    index = graph.Adjacency(edges, most=most)
    assert index.keys == (["node"] if most > 200 else ["node", "slot"])
    front = spark.createDataFrame([("n1", "n1"), ("n2", "hub")], "start string, node string")
    step = index.step(front)
    plan = step._jdf.queryExecution().executedPlan().toString()
    branch = plan.split("FileScan parquet", 2)
    assert "Bucketed: true" in plan
    # The scan of the edges has no exchange above it within its side of the join; only the front is dealt out.
    scan = [line for line in plan.splitlines() if "adjacency" in line and "FileScan" in line]
    lines = plan.splitlines()
    at = lines.index(scan[0])
    depth = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        here = len(line) - len(line.lstrip(" :+-*"))
        if "Join" in line:
            break
        if here < depth:
            above.append(line)
            depth = here
    assert branch and not any("Exchange" in line for line in above)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    assert sorted(map(tuple, step.select("start", "node", "other").collect())) == sorted((s, x, y) for s, x in (("n1", "n1"), ("n2", "hub")) for y in near[x])
    # The index serves several searches, and goes when it is dropped.
    depths = {(r["start"], r["node"]): r["depth"] for r in graph.bfs(edges, front.select(F.col("start").alias("id")), 2, index=index).collect()}
    assert depths["n1", "hub"] == 1 and depths["n1", "n1"] == 0 and max(depths.values()) == 2
    assert graph.shortest_paths(edges, spark.createDataFrame([("n1", "n99")], "start string, goal string"), index=index).first()["length"] == 2 - ("n99" in near["n1"])
    index.drop()
    assert not spark.catalog.tableExists(index.near.stored_table)


def test_walks_do_not_send_edges(spark, no_broadcast):
    edges = edges_of(spark, [(f"n{k}", f"n{(k * 7 + 1) % 50}") for k in range(50)])
    starts = spark.createDataFrame([(f"w{k}", f"n{k}") for k in range(20)], "walk string, id string")
    walks = graph.random_walks(edges, starts, 3)
    plan = walks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("numbered") >= 3 and "Bucketed: true" in plan
    assert all(len(r["path"]) == 4 for r in walks.collect())


def test_subgraph_makes_only_its_domains_pairs(spark, monkeypatch):
    endpoints = spark.createDataFrame([(f"e{k:02}", f"t{k % 3}", f"n{k}", f"d{k % 4}") for k in range(40)], "id string, tool_id string, name string, domain string")
    tools = endpoints.select(F.col("tool_id").alias("id"), F.col("tool_id").alias("name")).distinct()
    nodes, edges = graph.build_nodes(tools, endpoints), graph.build_edges(endpoints)
    rows = lambda t: sorted((r["src"], r["dst"], r["type"]) for r in t.collect())
    want = rows(graph.subgraph(nodes, edges.unionByName(graph.same_domain_edges(endpoints)), ["d1", "d2"])[1])
    made, plain = [], graph.same_domain_edges
    monkeypatch.setattr(graph, "same_domain_edges", lambda e: made.append(e.count()) or plain(e))
    assert rows(graph.domain_subgraph(nodes, edges, endpoints, ["d1", "d2"])[1]) == want and len(want) == 90
    assert made == [20]


def test_same_domain_edges_in_chunks(spark, tmp_path):
    rows = lambda df: sorted(map(tuple, df.collect()))
    # Pairs of chunks and groups, ids that repeat, and domains of one: as the plain join.
    few = spark.createDataFrame([(f"e{k % 70}", f"d{k % 3 * (k % 7 > 0)}") for k in range(90)] + [("x", None), ("y", ""), ("z", "one")], "id string, domain string")
    few.createOrReplaceTempView("few")
    want = rows(spark.sql("SELECT a.id AS src, b.id AS dst FROM few a JOIN few b ON a.domain = b.domain AND a.id < b.id WHERE a.domain <> ''"))
    for chunk, most in ((504, 16), (4, 2), (1, 1)):
        assert rows(graph.same_domain_edges(few, chunk, most).select("src", "dst")) == want and want
    # Edges come in runs that files store in little: 4.5 million took more than a byte each.
    large = spark.range(3000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"), F.lit("a").alias("domain"))
    graph.same_domain_edges(large).select("src", "dst", "weight").write.parquet(str(tmp_path / "edges"))
    assert spark.read.parquet(str(tmp_path / "edges")).count() == 3000 * 2999 // 2
    assert sum(f.stat().st_size for f in (tmp_path / "edges").glob("*.parquet")) < 0.7 * 3000 * 2999 / 2


def test_edges_are_made_apart_from_their_join(spark):
    """A stage holds what a row makes of itself: one that joined, too, held all edges of a chunk with its group, up to 4 million."""
    import re

    e = spark.range(3000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"), F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("domain"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = graph.same_domain_edges(e)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    joined, made = re.findall(r"\*\((\d+)\) SortMergeJoin", plan), re.findall(r"\*\((\d+)\) Generate explode\((?:dst|src)_ids", plan)
    assert len(joined) == 1 and len(made) == 2 and joined[0] not in made


def test_endpoints_without_an_id_have_no_edges(spark):
    rows = spark.createDataFrame([(None, "a"), ("e1", "b"), (None, "b"), ("e2", "b"), ("e0", "b"), ("e3", "c")], "id string, domain string")
    for chunk in (504, 1):
        assert sorted(map(tuple, graph.same_domain_edges(rows, chunk).select("src", "dst").collect())) == [("e0", "e1"), ("e0", "e2"), ("e1", "e2")]
