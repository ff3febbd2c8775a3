"""Tool chains: constraints, candidates and a depth-first search written as joins and one sort."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored
from .graph import SAME_DOMAIN, SIMILAR, both_ways

STEP = "struct<endpoint_id:string,tool_id:string,domain:string,completeness_score:double>"
PATTERNS = ("sequential", "parallel", "branching", "iterative", "random")


@dataclass(frozen=True)
class Constraints:
    """What a chain must be."""

    min_steps: int = 2
    max_steps: int = 5
    required_domains: tuple[str, ...] = field(default=())
    excluded_domains: tuple[str, ...] = field(default=())
    required_tools: tuple[str, ...] = field(default=())
    excluded_tools: tuple[str, ...] = field(default=())
    pattern: str = "sequential"
    min_completeness: float = 0.0
    require_multi_tool: bool = False

    def __post_init__(self):
        if not 1 <= self.min_steps <= self.max_steps:
            raise ValueError("steps must be 1 at least, and min_steps not above max_steps")
        if not 0 <= self.min_completeness <= 1:
            raise ValueError("min_completeness must be between 0 and 1")
        if self.pattern not in PATTERNS:
            raise ValueError(f"pattern must be one of {PATTERNS}")
        for kind in ("domains", "tools"):
            if both := set(getattr(self, f"required_{kind}")) & set(getattr(self, f"excluded_{kind}")):
                raise ValueError(f"{kind} both required and excluded: {sorted(both)}")


def _shuffled(id_: str, seed: int) -> Column:
    """The order of equal weights: an MD5 sum of the id, which any engine can make."""
    return F.md5(F.concat_ws("|", F.col(id_).cast("string"), F.lit(str(seed))))


def chain_errors(chain, c: Constraints) -> Column:
    """What a chain (an array of STEP) breaks, in the order of the constraints; an empty array if nothing."""
    chain = F.col(chain) if isinstance(chain, str) else chain
    n = F.size(chain)
    named = lambda all_: F.array_distinct(F.filter(all_, lambda x: F.coalesce(x, F.lit("")) != ""))
    domains, tools = named(F.transform(chain, lambda s: s["domain"])), named(F.transform(chain, lambda s: s["tool_id"]))
    name = lambda s: F.coalesce(s["endpoint_id"], F.lit("unknown"))
    each = lambda test, text: F.transform(F.filter(chain, lambda s: F.coalesce(test(s), F.lit(False))), text)
    score = lambda s: F.coalesce(s["completeness_score"], F.lit(0.0))
    missing = lambda kind, all_, there: [F.when(~F.array_contains(there, x), f"required {kind} '{x}' is missing") for x in all_]
    steps = [F.when(n < c.min_steps, F.format_string(f"%d steps are fewer than {c.min_steps}", n)), F.when(n > c.max_steps, F.format_string(f"%d steps are more than {c.max_steps}", n))]
    some = F.when(F.size(tools) < 2, F.format_string("%d tools where two are required", F.size(tools))) if c.require_multi_tool else F.lit(None).cast("string")
    row = lambda checks: F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return F.concat(
        row(steps), row(missing("domain", c.required_domains, domains)), each(lambda s: s["domain"].isin(*c.excluded_domains), lambda s: F.concat(name(s), F.lit(" is of excluded domain "), s["domain"])),
        row(missing("tool", c.required_tools, tools)), each(lambda s: s["tool_id"].isin(*c.excluded_tools), lambda s: F.concat(name(s), F.lit(" is of excluded tool "), s["tool_id"])),
        each(lambda s: score(s) < c.min_completeness, lambda s: F.concat(name(s), F.lit(" is complete to "), score(s).cast("string"))), row([some]),
    )


def is_valid(chain, c: Constraints) -> Column:
    return F.size(chain_errors(chain, c)) == 0


def allowed(endpoints: DataFrame, c: Constraints) -> DataFrame:
    """Endpoints that any chain under these constraints may hold."""
    out = endpoints.where(F.coalesce("completeness_score", F.lit(0.0)) >= c.min_completeness)
    for column, names in (("domain", c.excluded_domains), ("tool_id", c.excluded_tools)):
        if names:
            out = out.where(~F.coalesce(F.col(column).isin(*names), F.lit(False)))
    return out


def ranked(candidates: DataFrame, group: list[str], weights: DataFrame | None, seed: int) -> DataFrame:
    """candidates(…, id, tool_id) of each group by weight: outer weight over the number of the tool's candidates, plus one.

    Equal weights are ordered by a hash of the id.
    """
    outer = F.lit(1.0)
    if weights is not None:
        candidates = candidates.join(weights.select(F.col("endpoint").alias("id"), "weight"), "id", "left")
        outer = F.coalesce("weight", F.lit(1.0))
    same = F.count("*").over(Window.partitionBy(*group, "tool_id"))
    w = candidates.withColumn("w", outer / (same + 1))
    return w.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("w"), _shuffled("id", seed), "id")) - 1)


def start_candidates(endpoints: DataFrame, c: Constraints, weights: DataFrame | None = None, most: int = 10, seed: int = 0) -> DataFrame:
    """(id, tool_id, w, rank) of the first `most`.

    Starts compete with each other, all of them, so their tools are counted first and the sort keeps `most` rows a task.
    """
    all_ = allowed(endpoints, c).select("id", "tool_id")
    same = all_.groupBy("tool_id").agg(F.count("*").alias("same"))
    scored = all_.join(same, all_["tool_id"].eqNullSafe(same["tool_id"])).drop(same["tool_id"])
    outer = F.lit(1.0)
    if weights is not None:
        scored = scored.join(weights.select(F.col("endpoint").alias("id"), "weight"), "id", "left")
        outer = F.coalesce("weight", F.lit(1.0))
    first = scored.select("id", "tool_id", (outer / (F.col("same") + 1)).alias("w")).orderBy(F.desc("w"), _shuffled("id", seed), "id").limit(most)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("w"), _shuffled("id", seed), "id")) - 1)


def neighbor_candidates(paths: DataFrame, edges: DataFrame, endpoints: DataFrame, c: Constraints, weights: DataFrame | None = None, most: int = 10, seed: int = 0, by_domain: bool = False) -> DataFrame:
    """C4: paths(path, …) with each allowed, unvisited neighbour (id, tool_id, w, rank) of their last endpoint, the first `most`.

    by_domain takes the neighbours in one domain from the endpoints themselves, so same-domain edges need not be made.
    """
    # The paths' ends are few in a search (starts times fan to the depth); Spark sends them to the edges where they are.
    paths = paths.withColumn("node", F.element_at("path", -1))
    ends = paths.select("node").distinct()
    near = both_ways(edges, [SIMILAR] if by_domain else [SAME_DOMAIN, SIMILAR]).select("node", "other").join(ends, "node")
    if by_domain:
        named = endpoints.where("domain is not null and domain <> ''").select("id", "domain")
        own = named.withColumnRenamed("id", "node").join(ends, "node")
        near = near.unionByName(named.withColumnRenamed("id", "other").join(own, "domain").where("node <> other").select("node", "other"))
    near = near.distinct()
    kept = allowed(endpoints, c).select(F.col("id").alias("other"), "tool_id")
    grown = paths.join(near, "node").where(~F.array_contains("path", F.col("other"))).join(kept, "other")
    return ranked(grown.withColumnRenamed("other", "id").drop("node"), ["path"], weights, seed).where(F.col("rank") < most)


def domain_candidates(endpoints: DataFrame, c: Constraints, weights: DataFrame | None = None, most: int = 10, seed: int = 0) -> DataFrame:
    """C4 of all endpoints at once, by domain: what neighbor_candidates() gives with by_domain and no edges for the path of
    each endpoint alone, as (start, id, tool_id, w, rank).

    A start changes the weights of its own tool's candidates only, and not their order. So the first `most` are among the
    first of its tool in the domain (one more, as the start itself goes) and the first of the domain when no tool holds
    more than that many of these; pairs are not made.
    """
    named = endpoints.where("domain is not null and domain <> ''")
    all_ = allowed(named, c).select("domain", F.col("id").alias("cid"), F.col("tool_id").alias("tool"))
    outer = F.lit(1.0)
    if weights is not None:
        all_ = all_.join(weights.select(F.col("endpoint").alias("cid"), "weight"), "cid", "left")
        outer = F.coalesce("weight", F.lit(1.0))
    all_ = all_.withColumn("outer", outer).withColumn("hash", _shuffled("cid", seed))
    same = all_.groupBy("domain", "tool").agg(F.count("*").alias("same"))
    # Of each tool in a domain, its first; of each domain, the first of these.
    own = all_.withColumn("nth", F.row_number().over(Window.partitionBy("domain", "tool").orderBy(F.desc("outer"), "hash", "cid"))).where(F.col("nth") <= most + 1).drop("nth")
    own = own.groupBy("domain", "tool").agg(F.collect_list(F.struct("cid", "tool", "outer", "hash")).alias("own"))
    own = own.join(same, (own["domain"] == same["domain"]) & own["tool"].eqNullSafe(same["tool"])).select(own["domain"], own["tool"], "own", "same")
    each = own.select("domain", "same", F.inline("own"))
    first = each.withColumn("nth", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc(F.col("outer") / (F.col("same") + 1)), "hash", "cid"))).where(F.col("nth") <= 2 * most + 1)
    first = first.groupBy(F.col("domain").alias("of")).agg(F.collect_list(F.struct("cid", "tool", "outer", "hash", "same")).alias("first"))

    starts = named.select(F.col("id").alias("start"), "domain", "tool_id").join(first, F.col("domain") == F.col("of"))
    starts = starts.join(own.withColumnRenamed("domain", "in"), (F.col("domain") == F.col("in")) & F.col("tool_id").eqNullSafe(F.col("tool")), "left")
    starts = starts.join(all_.select(F.col("cid").alias("known")).distinct(), F.col("start") == F.col("known"), "left")
    one = lambda x, same: F.struct((-x["outer"] / (same + 1)).alias("w"), x["hash"].alias("hash"), x["cid"].alias("id"), x["tool"].alias("tool_id"))
    others = F.transform(F.filter("first", lambda x: ~x["tool"].eqNullSafe(F.col("tool_id"))), lambda x: one(x, x["same"]))
    mine = F.transform(F.filter(F.coalesce("own", F.array().cast(own.schema["own"].dataType)), lambda x: x["cid"] != F.col("start")), lambda x: one(x, F.col("same") - F.col("known").isNotNull().cast("int")))
    best = F.slice(F.array_sort(F.concat(others, mine)), 1, most)
    return starts.select("start", F.posexplode(best).alias("rank", "x")).select("start", "x.id", "x.tool_id", (-F.col("x.w")).alias("w"), "rank")


def sample_chains(endpoints: DataFrame, edges: DataFrame, c: Constraints, weights: DataFrame | None = None, attempts: int = 100, starts: int = 10, fan: int = 10, seed: int = 0, lowest_first: bool = False, by_domain: bool = False) -> DataFrame:
    """(path, chain, visit): the chains that a depth-first search meets in its first `attempts` states and that are
    valid, in the order of the search; the first is the search's result.

    Paths grow by one join a step and carry the rank of each choice. A depth-first search visits them in the order of
    these arrays, shorter ones before their extensions. Fan and starts are limits of the search itself, so paths are
    bounded by them and max_steps. lowest_first takes the worst kept neighbour first.
    """
    way = (lambda r: F.lit(fan - 1) - r) if lowest_first else (lambda r: r)
    paths = start_candidates(endpoints, c, weights, starts, seed).select(F.array("id").alias("path"), F.array(F.col("rank").cast("int")).alias("ranks"))
    all_ = paths
    for _ in range(1, c.max_steps):
        grown = neighbor_candidates(paths, edges, endpoints, c, weights, fan, seed, by_domain)
        paths = stored(grown.select(F.array_append("path", F.col("id")).alias("path"), F.array_append("ranks", way(F.col("rank")).cast("int")).alias("ranks")), "paths")
        all_ = all_.unionByName(paths)
    visited = all_.orderBy("ranks").limit(attempts)
    order = visited.withColumn("visit", F.row_number().over(Window.orderBy("ranks")))  # `attempts` rows
    return chain_data(order.where(F.size("path") >= c.min_steps), endpoints).where(is_valid("chain", c))


def chain_data(paths: DataFrame, endpoints: DataFrame) -> DataFrame:
    """paths(path, visit) with the data of their endpoints, in order, as an array of STEP."""
    steps = paths.select("visit", "path", F.posexplode("path").alias("at", "id")).join(endpoints.select("id", "tool_id", "domain", "completeness_score"), "id")
    one = F.struct("at", F.struct(F.col("id").alias("endpoint_id"), "tool_id", "domain", "completeness_score").alias("s"))
    return steps.groupBy("visit", "path").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("chain"))
