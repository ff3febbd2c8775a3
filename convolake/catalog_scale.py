"""Registered queries of what keeps state, indexes and bounds: trackers, steering, pruned joins, vector and graph indexes."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .catalog import _E, _G, _PAIR_SQL, _REQUESTS, Tables, _graph, _requests, _rounded, query
from .functions import conversation
from .operators import graph, pruning, sampling, tracked
from .sources import cache, interchange, vector_index
from .storage import new_path, stored
from .streaming import steering, tracker

_STATE = """
l AS (SELECT l_orderkey AS conv, CAST(l_suppkey AS VARCHAR) AS tool, p_brand AS domain FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {where}),
u AS (SELECT DISTINCT conv, tool FROM l), h AS (SELECT conv, substr(md5(string_agg(tool, ',' ORDER BY tool)), 1, 16) AS pattern FROM u GROUP BY 1),
state AS (
  SELECT 'tool' AS kind, tool AS a, '' AS b, count(*) AS n FROM l GROUP BY 2 UNION ALL SELECT 'domain', domain, '', count(*) FROM l GROUP BY 2
  UNION ALL SELECT 'pair', x.tool, y.tool, count(*) FROM u x JOIN u y ON x.conv = y.conv AND x.tool < y.tool GROUP BY 2, 3
  UNION ALL SELECT 'pattern', pattern, '', count(*) FROM h GROUP BY 2 UNION ALL SELECT 'conversation', '', '', count(*) FROM h
)"""


# -- trackers --


@query(
    "stream_tracker",
    f"""WITH {_STATE.format(where="true")} SELECT kind, a, b, n, CASE kind WHEN 'tool' THEN round(max(n) OVER (PARTITION BY kind) / (n + 1), 6) END AS weight FROM state""",
)
def _(spark, d):
    # Lines come in an order that has nothing to do with their orders: each micro-batch has some lines of most orders.
    t = Tables(spark, d)
    called = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").cast("string").alias("conv"), F.col("l_suppkey").alias("tool"), F.col("p_brand").alias("domain"), F.col("l_shipdate").cast("timestamp").alias("ts"), "l_partkey", "l_linenumber")
    dealt = stored(called.repartition(4, F.xxhash64("l_partkey", "l_linenumber")).drop("l_partkey", "l_linenumber"), "calls")
    state = tracked.StateTable(spark, new_path(spark, "tracker"), every=2)
    tracker.track(tracker.read_events(spark, dealt.stored_path, files=2), state, datetime.timedelta(days=1), late="36500 days")
    found = state.before(_versions(spark, state))
    most = found.where("kind = 'tool'").agg(F.max("n").alias("most"))  # one row
    return _rounded(found.crossJoin(most).withColumn("weight", F.when(F.col("kind") == "tool", F.col("most") / (F.col("n") + 1))), "weight").drop("most")


def _versions(spark, state: tracked.StateTable) -> int:
    """How many versions a state has."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state.path}/parts")
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))


@query("tracked_merge", f"WITH {_STATE.format(where='l_orderkey % 10 <> 0')} SELECT kind, a, b, n FROM state")
def _(spark, d):
    called = Tables(spark, d).called()
    part = lambda where: stored(tracked.contributions(tracked.finished(called.where(where))), "state")
    # Two halves are added, then a tenth of all conversations is taken back.
    return tracked.merged(part("conv % 2 = 0"), part("conv % 2 = 1"), tracked.retracted(part("conv % 10 = 0")))


@query("tracked_metrics", f"""WITH {_STATE.format(where="true")}, p AS (SELECT kind, n / sum(n) OVER (PARTITION BY kind) AS p FROM state)
    SELECT round(-sum(p * ln(p)) FILTER (kind = 'tool'), 6) AS tool_entropy, round(-sum(p * ln(p)) FILTER (kind = 'domain'), 6) AS domain_entropy, count(*) FILTER (kind = 'tool') AS n_tools, count(*) FILTER (kind = 'domain') AS n_domains,
    count(*) FILTER (kind = 'pair') AS n_pairs, count(*) FILTER (kind = 'pattern') AS n_patterns, (SELECT n FROM state WHERE kind = 'conversation') AS n_conversations,
    round(count(*) FILTER (kind = 'pair') / (count(*) FILTER (kind = 'tool') * (count(*) FILTER (kind = 'tool') - 1) / 2), 6) AS pair_ratio FROM p""")  # fmt: skip
def _(spark, d):
    state = stored(tracked.contributions(tracked.finished(Tables(spark, d).called())), "state")
    return _rounded(tracked.diversity_metrics(state), "tool_entropy", "domain_entropy", "pair_ratio")


# -- steering --

_BATCHES, _STEPS = 4, 3


def _steered_sql() -> str:
    """Four batches of suppliers; each ranks all endpoints by the tools that the batches before it used."""
    out = [
        """e AS (SELECT 'e' || p_partkey AS id, 't' || p_partkey % 100 AS tool FROM part), k AS (SELECT *, count(*) OVER (PARTITION BY tool) AS same FROM e WHERE CAST(substr(id, 2) AS BIGINT) % 11 >= 5),
        q AS (SELECT 's' || s_suppkey AS conv, s_suppkey % 4 AS batch FROM supplier), m AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY conv) - 1 AS number FROM q),
        s AS (SELECT *, unnest([1, 2, 3]) AS step FROM m), c0 AS (SELECT NULL AS tool, 0 AS n WHERE false)"""
    ]
    for b in range(_BATCHES):
        out.append(f"""w{b} AS (SELECT k.*, coalesce((SELECT max(n) FROM c{b}) / (coalesce(n, 0) + 1), 1) / (same + 1) AS w FROM k LEFT JOIN c{b} USING (tool)),
        r{b} AS (SELECT *, row_number() OVER (ORDER BY w DESC, md5(id || '|{b}'), id) - 1 AS rank FROM w{b}),
        f{b} AS (SELECT batch, conv, step, id AS endpoint, tool, w FROM s JOIN r{b} ON rank = (number * 3 + step - 1) % (SELECT count(*) FROM k) WHERE batch = {b}),
        c{b + 1} AS (SELECT tool, count(*) AS n FROM ({" UNION ALL ".join(f"SELECT tool FROM f{x}" for x in range(b + 1))}) GROUP BY 1)""")
    return f"WITH {', '.join(out)} SELECT CAST(batch AS INTEGER) AS batch, conv, CAST(step AS INTEGER) AS step, endpoint, tool, round(w, 6) AS w FROM ({' UNION ALL '.join(f'SELECT * FROM f{b}' for b in range(_BATCHES))})"


@query("steered_chains", _steered_sql())
def _(spark, d):
    t = Tables(spark, d)
    requests = t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("conv"), (F.col("s_suppkey") % _BATCHES).alias("batch"))
    path = new_path(spark, "requests")
    for b in range(_BATCHES):  # a file a batch, in turn
        requests.where(F.col("batch") == b).select("conv").coalesce(1).write.mode("append").parquet(path)
    e = stored(t.endpoints(), "endpoints")
    registry = e.select(F.col("id").alias("endpoint"), F.col("tool_id").alias("tool"), "domain")
    sampler = lambda batch, weights, k: steering.next_chains(batch, e, sampling.Constraints(min_completeness=0.45), weights, _STEPS, k)
    state = tracked.StateTable(spark, new_path(spark, "steering"), every=2)
    stream = spark.readStream.schema("conv string").option("maxFilesPerTrigger", 1).parquet(path)
    return _rounded(steering.steer(stream, registry, sampler, state, new_path(spark, "steered"), new_path(spark, "steering-marks")), "w")


# -- vectors --


@query("cosine_pairs_pruned", f"WITH {_PAIR_SQL} SELECT a, b, round(score, 6) AS score FROM p")
def _(spark, d):
    return _rounded(pruning.pruned_pairs(Tables(spark, d).vectors(), 0.3, rows=256)[0], "score")


@query(
    "index_topk",
    """WITH u AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), v AS (SELECT *, sqrt(list_dot_product(x, x)) + 1e-10 AS norm FROM u),
    s AS (SELECT a.id AS q, b.id, list_dot_product(a.x, b.x) / (a.norm * b.norm) AS score FROM v a JOIN v b ON a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, id) AS rank FROM s)
    SELECT q, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def _(spark, d):
    v = Tables(spark, d).vectors()
    path = new_path(spark, "vector-index")
    vector_index.build(v, path)
    return _rounded(vector_index.Index(spark, path).search(v, 5), "score")


# -- graphs --


@query(
    "shortest_paths",
    f"""WITH RECURSIVE {_G}, u AS (SELECT src AS node, dst AS other FROM g UNION SELECT dst, src FROM g),
    q AS (SELECT 'e' || p_partkey AS start, 'e' || p_partkey - 37 AS goal FROM part WHERE p_partkey % 100 = 0),
    w(start, goal, node, d) AS (SELECT start, goal, goal, 0 FROM q UNION SELECT w.start, goal, other, d + 1 FROM w JOIN u USING (node) WHERE d < 8),
    f AS (SELECT start, goal, node, min(d) AS togo FROM w GROUP BY 1, 2, 3),
    p(start, goal, node, togo, length, path) AS (
      SELECT start, goal, node, togo, togo, node FROM f WHERE node = start
      UNION ALL SELECT start, goal, other, togo - 1, length, path || '>' || other FROM (SELECT p.start, p.goal, p.togo, p.length, p.path, min(u.other) AS other FROM p JOIN u ON u.node = p.node JOIN f ON f.start = p.start AND f.goal = p.goal AND f.node = u.other AND f.togo = p.togo - 1 GROUP BY 1, 2, 3, 4, 5))
    SELECT start, goal, CAST(length AS INTEGER) AS length, path FROM p WHERE togo = 0""",
)
def _(spark, d):
    t = Tables(spark, d)
    key = F.col("p_partkey")
    pairs = t.part.where(key % 100 == 0).select(F.concat(F.lit("e"), key.cast("string")).alias("start"), F.concat(F.lit("e"), (key - 37).cast("string")).alias("goal"))
    return graph.shortest_paths(_graph(t)[1], pairs).withColumn("path", F.array_join("path", ">"))


# -- the cache --


@query("uncached_requests_filtered", f"WITH {_REQUESTS} SELECT event_id FROM r ANTI JOIN e USING (k)")
def _(spark, d):
    return cache.misses_filtered(*_requests(Tables(spark, d))).select("event_id")


# -- edges, embeddings and endpoints that are kept or looked up --


@query(
    "upsert_edges",
    f"""WITH {_E}, n AS (SELECT *, CAST(substr(id, 2) AS BIGINT) AS k FROM e) SELECT tool_id AS src, id AS dst, 'HAS_ENDPOINT' AS type, CASE WHEN k % 4 = 0 THEN CAST(0.5 AS DOUBLE) END AS weight FROM n
    UNION ALL SELECT id, tool_id, 'BACK', CAST(0.25 AS DOUBLE) FROM n WHERE k % 4 = 1""",
)
def _(spark, d):
    e = Tables(spark, d).endpoints()
    k = F.col("id").substr(2, 20).cast("long") % 4
    none = lambda kind: F.lit(None).cast(kind)
    old = e.select(F.col("tool_id").alias("src"), F.col("id").alias("dst"), F.lit("HAS_ENDPOINT").alias("type"), none("double").alias("weight"), none("double").alias("score"))
    newer = e.where(k == 0).select(F.col("tool_id").alias("src"), F.col("id").alias("dst"), F.lit("HAS_ENDPOINT").alias("type"), F.lit(0.5).alias("weight"), none("double").alias("score"))
    back = e.where(k == 1).select(F.col("id").alias("src"), F.col("tool_id").alias("dst"), F.lit("BACK").alias("type"), F.lit(0.25).alias("weight"), none("double").alias("score"))
    return graph.upsert_edges(old, newer.unionByName(back)).drop("score")


@query(
    "cached_embeddings",
    """WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS id, unnest(embedding) AS x, label FROM embeddings) SELECT id, label % 2 = 0 AS was_cached, CAST(count(*) AS INTEGER) AS size, round(sum(CAST(x AS DOUBLE)), 4) AS total FROM v GROUP BY ALL""",
)
def _(spark, d):
    # Half of the vectors are in the cache; what is missing is found, made and added, and all is loaded again.
    e = Tables(spark, d).embeddings.select(F.col("vec_id").cast("string").alias("id"), "embedding", "label")
    path = new_path(spark, "embedding-cache")
    interchange.clear_embeddings(spark, path)
    interchange.save_embeddings(e.where("label % 2 = 0"), path, 64)
    before = interchange.load_embeddings(spark, path, 64)
    missing = interchange.missing_embeddings(e, before)
    again = new_path(spark, "embedding-cache")
    interchange.save_embeddings(before, again, 64)
    interchange.save_embeddings(missing, again, 64)
    found = interchange.load_embeddings(spark, again, 64).join(before.select("id", F.lit(True).alias("was_cached")), "id", "left")
    return found.select("id", F.coalesce("was_cached", F.lit(False)).alias("was_cached"), F.size("embedding").alias("size"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(
    "planner_endpoints",
    f"""WITH {_E}, s AS (SELECT l_orderkey AS conv, 'e' || l_partkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS place FROM lineitem)
    SELECT conv, CAST(place AS INTEGER) AS "at", id, name, tool_id, domain FROM s JOIN e USING (id) WHERE domain <> 'Brand#12'""",
)
def _(spark, d):
    t = Tables(spark, d)
    chains = t.chains().select("conv", F.transform("chain", lambda x: F.concat(F.lit("e"), x)).alias("chain"))
    known = t.endpoints().where("domain <> 'Brand#12'")  # the others are dropped, as ids that nobody knows
    return conversation.planner_endpoints(chains, known).select("conv", "at", "id", "name", "tool_id", "domain")
