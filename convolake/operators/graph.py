"""A property graph of tools, endpoints and domains as two tables.

nodes(id, type, name, tool_id, category, domain, method, path, description, completeness_score, parameter_count) and
edges(src, dst, type, weight, score); (src, dst, type) is unique. Edges are directed; searches use both directions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import domain_node_id
from ..storage import bucketed, drop_bucketed, drop_stored, stored

TOOL, ENDPOINT, DOMAIN = "Tool", "Endpoint", "Domain"
HAS_ENDPOINT, IN_DOMAIN, SAME_DOMAIN, SIMILAR = "HAS_ENDPOINT", "IN_DOMAIN", "SAME_DOMAIN", "SEMANTICALLY_SIMILAR"
NODES = (
    "id string, type string, name string, tool_id string, category string, domain string, method string, path string,"
    " description string, completeness_score double, parameter_count long"
)
EDGES = "src string, dst string, type string, weight double, score double"


def _shape(df: DataFrame, schema: str) -> DataFrame:
    """The schema's columns, null where df has none."""
    pairs = [p.split() for p in schema.split(",")]
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in pairs])


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row a key, the first in this order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def build_nodes(tools: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Nodes of tools(id, name, category, …), endpoints(id, tool_id, name, domain, …) and the endpoints' domains."""
    named = endpoints.where("domain is not null and domain <> ''").select("domain").distinct()
    parts = [
        _shape(tools.withColumn("type", F.lit(TOOL)), NODES),
        _shape(endpoints.withColumn("type", F.lit(ENDPOINT)), NODES),
        _shape(named.select(domain_node_id("domain").alias("id"), F.lit(DOMAIN).alias("type"), F.col("domain").alias("name"), "domain"), NODES),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def build_edges(endpoints: DataFrame) -> DataFrame:
    """HAS_ENDPOINT from tools and IN_DOMAIN to domains."""
    own = endpoints.where("tool_id is not null").select(F.col("tool_id").alias("src"), F.col("id").alias("dst"), F.lit(HAS_ENDPOINT).alias("type"))
    domain = endpoints.where("domain is not null and domain <> ''").select(F.col("id").alias("src"), domain_node_id("domain").alias("dst"), F.lit(IN_DOMAIN).alias("type"))
    return _shape(own.unionByName(domain), EDGES)


def same_domain_edges(endpoints: DataFrame, chunk: int = 504, most: int = 16, slice_: int = 36) -> DataFrame:
    """An edge between any two endpoints of a domain, from the smaller id. All these pairs are the result.

    A domain's ids are cut in their order into chunks of up to `chunk`; a domain of over `most` chunks deals them in turn to groups.
    Each two groups are a key of the join. Its rows are slices of a chunk with chunks, of which edges are made where they are
    needed: src stays for a chunk, dst goes through the same chunk again and again. So files hold runs and repetitions, which
    they store in a small part of the edges' bytes (504 ids are what Parquet packs at a time), and no task is given a large domain.
    """
    e = endpoints.where("id is not null and domain is not null and domain <> ''").select("id", "domain")
    # Numbers in a sorted partition follow each other, and partitions share no chunk.
    numbered = e.repartitionByRange("domain", "id").sortWithinPartitions("domain", "id").withColumn("chunk", F.floor(F.monotonically_increasing_id() / chunk))
    ids = F.sort_array(F.collect_list("id"))
    chunks = stored(numbered.groupBy("domain", "chunk").agg(ids.alias("ids"), F.min("id").alias("first"), F.max("id").alias("last")), "chunks")
    groups = chunks.groupBy("domain").agg(F.ceil(F.count("*") / most).cast("int").alias("groups"))
    # More partitions than keys, so a file's dictionaries hold the ids of few groups.
    keys = groups.agg(F.sum(F.col("groups").cast("long") ** 2)).first()[0]  # one row
    dealt = chunks.join(groups, "domain").withColumn("own", F.pmod("chunk", "groups").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    parts = min(max(1, 2 * int(keys or 0)), 4096)
    side = lambda ids, a, b, *more: dealt.select("domain", F.col("own").alias(a), F.col("other").alias(b), ids, *more).repartition(parts, "domain", "a", "b")
    many = side(F.col("ids").alias("dst_ids"), "b", "a", "first", "last")
    slices = F.transform(F.sequence(F.lit(0), F.size("ids") - 1, F.lit(slice_)), lambda k: F.slice("ids", k + 1, slice_))
    each = side(slices.alias("slices"), "a", "b").select("domain", "a", "b", F.explode("slices").alias("src_ids"))
    # The chunks are streamed, each with every slice in turn. A stage holds what one row that comes in makes of itself until
    # it is done; so it ends here, or the join would hold a group's edges, and not those of a slice.
    met = many.join(each.hint("merge"), ["domain", "a", "b"]).select("first", "last", "dst_ids", "src_ids").coalesce(parts)
    made = met.select("first", "last", "dst_ids", F.explode("src_ids").alias("src")).where("src < last").select("src", "first", F.explode("dst_ids").alias("dst"))
    return _shape(made.where("src < first or src < dst").select("src", "dst", F.lit(SAME_DOMAIN).alias("type"), F.lit(1.0).alias("weight")), EDGES)


def add_nodes(nodes: DataFrame, more: DataFrame) -> DataFrame:
    """G1, incremental: new ids are added, known ones stay."""
    return nodes.unionByName(more.join(nodes.select("id"), "id", "left_anti"))


def upsert_nodes(nodes: DataFrame, more: DataFrame) -> DataFrame:
    """G1: new ids are added; known ones take the attributes that the newer node has (not null), and keep the others."""
    old, new = nodes.alias("old"), more.alias("new")
    both = old.join(new, F.col("old.id") == F.col("new.id"), "full")
    return both.select(*[F.coalesce(F.col(f"new.{c}") if c in more.columns else F.lit(None), F.col(f"old.{c}")).alias(c) for c in nodes.columns])


def upsert_edges(edges: DataFrame, more: DataFrame) -> DataFrame:
    """Of equal (src, dst, type) the newer edge."""
    both = edges.withColumn("_age", F.lit(1)).unionByName(more.withColumn("_age", F.lit(0)))
    return first_by(both, ["src", "dst", "type"], "_age", F.desc_nulls_last("weight"), F.desc_nulls_last("score")).drop("_age")


def build_stats(before: DataFrame, more: DataFrame) -> DataFrame:
    """By type, how many of the new nodes (or edges) are added and how many are there already."""
    keys = ["id"] if "id" in more.columns else ["src", "dst", "type"]
    there = before.select(*keys, F.lit(True).alias("_there"))
    return more.join(there, keys, "left").groupBy("type").agg(F.count_if(F.col("_there").isNull()).alias("added"), F.count_if(F.col("_there").isNotNull()).alias("skipped"))


def weight_of_edge():
    """F8: its weight, else its score."""
    return F.coalesce("weight", "score")


def both_ways(edges: DataFrame, types: list[str] | None = None) -> DataFrame:
    """(node, other, type): each edge from both ends."""
    e = edges.where(F.col("type").isin(types)) if types else edges
    return e.select(F.col("src").alias("node"), F.col("dst").alias("other"), "type").unionByName(e.select(F.col("dst").alias("node"), F.col("src").alias("other"), "type"))


def neighbors(edges: DataFrame, types: list[str] | None = None) -> DataFrame:
    """G8 of all nodes: distinct (node, other)."""
    return both_ways(edges, types).select("node", "other").distinct()


class Adjacency:
    """The distinct neighbours of all nodes as a bucketed, sorted table, so that rounds of searches don't send edges again.

    Nodes of over `most` edges have several slots, by a hash of the neighbour, and are joined slot by slot; where there are
    such hubs, (node, slot) is what buckets go by.
    """

    def __init__(self, edges: DataFrame, types: list[str] | None = None, most: int = 100_000, buckets: int | None = None):
        both = both_ways(edges, types).select("node", "other")
        degrees = both.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > most)
        self.hubs = stored(degrees.select("node", F.ceil(F.col("n") / most).cast("int").alias("slots")), "hubs")
        self.keys = ["node"] if self.hubs.isEmpty() else ["node", "slot"]
        if len(self.keys) > 1:
            both = both.join(self.hubs, "node", "left").select("node", F.pmod(F.xxhash64("other"), F.coalesce("slots", F.lit(1))).cast("int").alias("slot"), "other")
        self.near = bucketed(both.distinct(), self.keys, buckets, "adjacency")

    def step(self, front: DataFrame) -> DataFrame:
        """front(…, node) with each neighbour (other) of its nodes."""
        if len(self.keys) > 1:
            front = front.join(self.hubs, "node", "left").withColumn("slot", F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1))).drop("slots")
        return front.join(self.near, self.keys).drop("slot")

    def drop(self) -> None:
        drop_bucketed(self.near)
        drop_stored(self.hubs)


def bfs(edges: DataFrame, starts: DataFrame, depth: int, types: list[str] | None = None, index: Adjacency | None = None) -> DataFrame:
    """(start, node, depth): the least number of steps, up to depth, from each start (column id); starts included.

    Each round follows only nodes that are new to their start, so hubs are crossed once. Without an index one is made, and
    dropped at the end.
    """
    near = index or Adjacency(edges, types)
    seen = starts.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0).alias("depth")).distinct()
    front = seen
    for k in range(1, depth + 1):
        step = near.step(front.select("start", "node")).select("start", F.col("other").alias("node")).distinct()
        front = stored(step.join(seen.select("start", "node"), ["start", "node"], "left_anti").withColumn("depth", F.lit(k)), "front")
        seen = seen.unionByName(front)
    if index is None:
        near.drop()
    return seen


def reachable_endpoints(edges: DataFrame, nodes: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """G9 as searches use it: endpoints only, without the start."""
    ends = nodes.where(F.col("type") == ENDPOINT).select(F.col("id").alias("node"))
    return bfs(edges, starts, depth).where("depth > 0").join(ends, "node", "left_semi")


_PAIR = ["start", "goal"]


def shortest_paths(edges: DataFrame, pairs: DataFrame, most: int | None = None, types: list[str] | None = None, index: Adjacency | None = None) -> DataFrame:
    """G10 of a table of pairs (start, goal): (start, goal, length, path), the smallest of the shortest paths, node by node; no row without one.

    Two fronts, from the starts and from the goals, grow towards each other, for all pairs at once; each round sends the
    smaller front to the adjacency index. A front's nodes carry the smallest way that leads to them (from the start, or on
    to the goal): ways of one length that end alike compare by where they came from, so the smallest way to a node extends
    the smallest way to one before it. Where fronts meet, the smallest of the joined ways is the path. Pairs that have met,
    or whose front is dry on one side, are not followed any further. A start that is its goal is its own path.

    Where growing both fronts would make more rows than there are edges (hubs), fronts are first asked for neighbours in
    common (_between()): many pairs share a hub, so this is done for its edges once, and not for each pair.
    """
    pairs = stored(pairs.select(*_PAIR).distinct().where("start is not null and goal is not null"), "pairs")
    near = index or Adjacency(edges, types)
    apart = pairs.where("start <> goal")
    sides = [[stored(apart.select(*_PAIR, F.col(end).alias("node"), F.array(end).alias("way")), "front")] for end in _PAIR]
    ended = [pairs.where("start = goal").select(*_PAIR, F.array("start").alias("path"))]
    alive, n_alive, sizes, steps = None, apart.count(), [1, 1], 0
    degrees = stored(near.near.groupBy("node").agg(F.count("*").alias("degree")), "degrees")
    n_near = degrees.agg(F.sum("degree")).first()[0] or 0
    while all(sizes) and (most is None or steps < most):
        if most is None or steps + 2 <= most:
            fronts = [side[-1].select(*_PAIR, "node", "way") for side in sides]
            fronts = fronts if alive is None else [f.join(alive, _PAIR, "left_semi") for f in fronts]
            met = _between(near, degrees, n_near, *fronts)
            if met is not None:
                ended.append(met)
                alive = stored(fronts[0].select(*_PAIR).distinct().join(met, _PAIR, "left_anti"), "alive")
                n_alive = alive.count()
                if not n_alive:
                    break
        k, steps = 0 if sizes[0] <= sizes[1] else 1, steps + 1
        front = sides[k][-1].select(*_PAIR, "node", "way")
        grown = near.step(front if alive is None else front.join(alive, _PAIR, "left_semi"))
        new = grown.groupBy(*_PAIR, F.col("other").alias("node")).agg(F.min("way").alias("way"))
        # Neighbours of a level are in it, the one before, or the next.
        held = sides[k][-1].select(*_PAIR, "node")
        held = held if len(sides[k]) == 1 else held.unionByName(sides[k][-2].select(*_PAIR, "node"))
        new = new.join(held, [*_PAIR, "node"], "left_anti").withColumn("way", F.array_prepend("way", F.col("node")) if k else F.array_append("way", F.col("node")))
        # A path of this length has a node in the newest levels of both sides; a shorter one would have been met before.
        other = sides[1 - k][-1].select(*_PAIR, "node", F.col("way").alias("rest"))
        joint = lambda a, b: F.concat(a, F.slice(b, 2, F.size(b)))
        path = joint(F.col("rest"), F.col("way")) if k else joint(F.col("way"), F.col("rest"))
        new = stored(new.join(other, [*_PAIR, "node"], "left").select(*_PAIR, "node", "way", F.when(F.col("rest").isNotNull(), path).alias("path")), "front")
        sides[k] = [sides[k][-1], new]
        sizes[k], met, left = new.agg(F.count("*"), F.count("path"), F.count_distinct(*_PAIR)).first()
        if left < n_alive or met:
            alive, n_alive = new.select(*_PAIR).distinct(), left
        if met:
            ended.append(new.where("path is not null").groupBy(*_PAIR).agg(F.min("path").alias("path")))
            alive = alive.join(ended[-1], _PAIR, "left_anti")
            alive = stored(alive, "alive")
            sizes[k], n_alive = new.join(alive, _PAIR, "left_semi").count(), alive.count()
    drop_stored(degrees)
    if index is None:
        near.drop()
    out = ended[0]
    for part in ended[1:]:
        out = out.unionByName(part)
    return out.select(*_PAIR, (F.size("path") - 1).alias("length"), "path")


def _between(near: Adjacency, degrees: DataFrame, n_near: int, start: DataFrame, goal: DataFrame) -> DataFrame | None:
    """(start, goal, path): the smallest shortest paths of pairs whose fronts are one or two steps apart; None where growing the fronts costs less.

    Fronts have (start, goal, node, way). Between two nodes only the smallest of their common neighbours counts.
    """
    grown = start.select("node").unionByName(goal.select("node")).join(degrees, "node").agg(F.sum("degree")).first()[0] or 0
    if grown <= n_near:
        return None
    ends = start.select(*_PAIR, F.col("node").alias("u"), "way").join(goal.select(*_PAIR, F.col("node").alias("v"), F.col("way").alias("rest")), _PAIR)
    mine, theirs = (f.select(F.col("node").alias(name)).distinct() for f, name in ((start, "u"), (goal, "v")))
    out = near.near.select(F.col("node").alias("u"), F.col("other").alias("w")).join(mine, "u")
    back = near.near.select(F.col("node").alias("w"), F.col("other").alias("v")).join(theirs, "v")
    met = lambda side: side.groupBy("w").agg(F.count("*").alias("n"))
    ways = met(out).join(met(back).withColumnRenamed("n", "m"), "w").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    if ways > grown or start.groupBy(*_PAIR).count().join(goal.groupBy(*_PAIR).agg(F.count("*").alias("m")), _PAIR).agg(F.sum(F.col("count") * F.col("m"))).first()[0] > grown:
        return None
    first = lambda found, path: found.groupBy(*_PAIR).agg(F.min(path).alias("path"))
    one = stored(first(ends.join(near.near.select(F.col("node").alias("u"), F.col("other").alias("v")), ["u", "v"]), F.concat("way", "rest")), "met")
    apart = ends.join(one, _PAIR, "left_anti")
    between = out.join(back, "w").groupBy("u", "v").agg(F.min("w").alias("w"))
    two = stored(first(apart.join(between, ["u", "v"]), F.concat("way", F.array("w"), "rest")), "met")
    return one.unionByName(two)


def shortest_path(edges: DataFrame, start: str, goal: str, most: int | None = None) -> list[str] | None:
    """G10 of one pair; None without a path (of `most` steps, if given)."""
    if start == goal:
        return [start]
    found = shortest_paths(edges, edges.sparkSession.createDataFrame([(start, goal)], "start string, goal string"), most).first()
    return None if found is None else list(found["path"])


def subgraph(nodes: DataFrame, edges: DataFrame, domains: list[str]) -> tuple[DataFrame, DataFrame]:
    """The endpoints of these domains, and the edges among them."""
    kept = nodes.where((F.col("type") == ENDPOINT) & F.col("domain").isin(domains))
    ids = kept.select("id")
    inner = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return kept, inner.select(edges.columns)


def domain_subgraph(nodes: DataFrame, edges: DataFrame, endpoints: DataFrame, domains: list[str]) -> tuple[DataFrame, DataFrame]:
    """G11 of a graph with its same-domain edges: those of these domains alone are made, and their ends are known to be kept."""
    kept, inner = subgraph(nodes, edges, domains)
    return kept, inner.unionByName(same_domain_edges(endpoints.where(F.col("domain").isin(domains))))


def _number(*parts, digits: int = 8):
    """A number from a hash of these values that any engine can make: the first hexadecimal digits of an MD5 sum."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits), 16, 10).cast("long")


def random_walks(edges: DataFrame, starts: DataFrame, steps: int, seed: int = 0, types: list[str] | None = None) -> DataFrame:
    """(walk, path): walks of up to `steps` steps over neighbours picked evenly by a hash; they end where there are none.

    starts: (walk, id). A node's neighbours are numbered in the order of their hashes, and a step takes the number that
    the hash of (walk, step, seed) gives, so a walk meets one row of its node and one neighbour, however many there are.
    Neighbours are numbered in 256 slots of the hash, so that those of a hub are sorted in as many tasks.
    """
    near = neighbors(edges, types).withColumn("hash", F.md5("other")).withColumn("slot", F.substring("hash", 1, 2))
    nth = F.row_number().over(Window.partitionBy("node", "slot").orderBy("hash", "other")) - 1
    # Bucketed by what each step asks for, so that steps don't send edges again.
    numbered = bucketed(near.withColumn("nth", nth.cast("long")).select("node", "slot", "nth", "other"), ["node", "slot", "nth"], name="numbered")
    sizes = numbered.groupBy("node", "slot").agg(F.count("*").alias("n"))
    # A node's slots, at most 256: how many neighbours each has, in order.
    slots = bucketed(sizes.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("slot", "n"))).alias("slots"), F.sum("n").alias("degree")), ["node"], name="slots")
    walks = starts.select("walk", F.array("id").alias("path"), F.col("id").alias("node"))
    for k in range(1, steps + 1):
        picked = walks.where("node is not null").join(slots, "node").withColumn("k", _number(F.col("walk").cast("string"), F.lit(str(k)), F.lit(str(seed))) % F.col("degree"))
        # The slot in which this number falls, and the number within it.
        found = F.aggregate("slots", F.struct(F.lit(None).cast("string").alias("slot"), F.col("k").alias("left")), lambda s, x: F.when(s["slot"].isNotNull(), s).when(s["left"] < x["n"], F.struct(x["slot"].alias("slot"), s["left"].alias("left"))).otherwise(F.struct(F.lit(None).cast("string").alias("slot"), (s["left"] - x["n"]).alias("left"))))
        step = picked.select("walk", "node", found.alias("f")).select("walk", "node", F.col("f.slot").alias("slot"), F.col("f.left").alias("nth"))
        step = step.join(numbered, ["node", "slot", "nth"]).select("walk", F.col("other").alias("next"))
        walks = walks.join(step, "walk", "left").select("walk", F.when(F.col("next").isNotNull(), F.array_append("path", F.col("next"))).otherwise(F.col("path")).alias("path"), F.col("next").alias("node"))
    return walks.select("walk", "path")


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, type, n) of nodes and edges, and their totals (type null)."""
    one = lambda df, kind: df.groupBy("type").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    counted = one(nodes, "node").unionByName(one(edges, "edge"))
    return counted.unionByName(counted.groupBy("kind").agg(F.sum("n").alias("n")).select("kind", F.lit(None).cast("string").alias("type"), "n"))


def density(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """E / (N (N - 1)), 0 for fewer than two nodes."""
    n = nodes.agg(F.count("*").alias("n")).crossJoin(edges.agg(F.count("*").alias("e")))  # two single rows
    return n.select(F.col("n").alias("n_nodes"), F.col("e").alias("n_edges"), F.when(F.col("n") > 1, F.col("e") / (F.col("n").cast("double") * (F.col("n") - 1))).otherwise(0.0).alias("density"))


def domain_stats(endpoints: DataFrame) -> DataFrame:
    """A13."""
    return endpoints.where("domain is not null and domain <> ''").groupBy("domain").agg(F.count("*").alias("n"))


def by_category(endpoints: DataFrame, tools: DataFrame, category: str) -> DataFrame:
    """F3 and J1."""
    return endpoints.join(tools.where(F.col("category") == category).select(F.col("id").alias("tool_id"), "category"), "tool_id")


def complete_enough(endpoints: DataFrame, least: float) -> DataFrame:
    """unknown scores don't count."""
    return endpoints.where(F.col("completeness_score") >= least)


def by_ids(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """the nodes (tools, endpoints) of these ids (column id)."""
    return nodes.join(ids.select("id").distinct(), "id", "left_semi")


def by_domain(endpoints: DataFrame, domain: str) -> DataFrame:
    """F2."""
    return endpoints.where(F.col("domain") == domain)


def of_type(rows: DataFrame, kind: str) -> DataFrame:
    """F8: nodes or edges of a type."""
    return rows.where(F.col("type") == kind)


def existing(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """F8: pairs(src, dst, type) with whether there is such an edge."""
    there = edges.select("src", "dst", "type").distinct().withColumn("there", F.lit(True))
    return pairs.join(there, ["src", "dst", "type"], "left").withColumn("there", F.coalesce("there", F.lit(False)))


def empty(spark) -> tuple[DataFrame, DataFrame]:
    """G13."""
    return spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)
