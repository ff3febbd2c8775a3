"""What a set of conversations has used so far, and what it should use next.

Chains are rows (conv, endpoint); a registry (endpoint, tool, domain) says what endpoints are. Calls of endpoints that
are not registered count nowhere but in their conversation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics


def calls(chains: DataFrame, registry: DataFrame) -> DataFrame:
    """(conv, endpoint, tool, domain) of registered calls. The join is left to Spark: it broadcasts small registries."""
    return chains.select("conv", "endpoint").join(registry.select("endpoint", "tool", "domain"), "endpoint")


def dealt(called: DataFrame, rows: int = 500_000) -> DataFrame:
    """called(conv, ...), dealt by conversation to parts of about so many calls: a part's pairs are added up in memory, so a part must not grow with the table."""
    if called.isStreaming:
        return called
    parts = max(called.sparkSession.sparkContext.defaultParallelism, math.ceil(called.count() / rows))
    return called.repartition(parts, "conv")


def tool_sets(called: DataFrame) -> DataFrame:
    """(conv, tools): the distinct tools of each conversation, sorted as strings."""
    return called.select("conv", F.col("tool").cast("string").alias("tool")).groupBy("conv").agg(F.array_sort(F.collect_set("tool")).alias("tools"))


def tool_pairs(called: DataFrame) -> DataFrame:
    """(a, b, n) for pairs of distinct tools in how many conversations, a before b as strings.

    Pairs come from each conversation's own tool set, so nothing is joined: a conversation's pairs are made where it is,
    and added up before they are sent.
    """
    sets = tool_sets(dealt(called.select("conv", "tool")))
    pairs = F.flatten(F.transform("tools", lambda a, i: F.transform(F.slice("tools", i + 2, F.size("tools")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def pattern_hashes(called: DataFrame) -> DataFrame:
    """P34 by conversation."""
    return tool_sets(called).select("conv", F.substring(F.md5(F.array_join("tools", ",")), 1, 16).alias("pattern"))


def diversity_metrics(called: DataFrame) -> DataFrame:
    """One row of entropies, numbers of tools, domains, pairs, patterns and conversations, and the pair ratio."""
    # Both entropies come from one count of calls, and pairs and patterns from one set of tools, so calls are read twice.
    both = called.groupBy("tool", "domain").agg(F.count("*").alias("n"))

    def entropy(key: str) -> DataFrame:
        # Calls without a key are counted as none: a filter would reach the scan, and the two counts would differ.
        n = F.sum(F.when(F.col(key).isNotNull(), F.col("n")).otherwise(0))
        return metrics.entropy_of(both.groupBy(key).agg(n.alias("n"))).select(F.col("entropy").alias(f"{key}_entropy"), F.col("n_items").alias(f"n_{key}s"))

    tool, domain = entropy("tool"), entropy("domain")
    pairs = tool_pairs(called).agg(F.count("*").alias("n_pairs"))
    patterns = pattern_hashes(called).agg(F.count("*").alias("n_conversations"), F.count_distinct("pattern").alias("n_patterns"))
    ratio = F.col("n_pairs") / F.when(F.col("n_tools") > 1, metrics.possible_pairs("n_tools")).otherwise(1)
    # Single rows: their product is one row.
    return tool.crossJoin(domain).crossJoin(pairs).crossJoin(patterns).withColumn("pair_ratio", ratio)


def weights(called: DataFrame, registry: DataFrame) -> DataFrame:
    """A10: (endpoint, weight) for all registered endpoints: the largest tool count over its own tool's, plus one; 1 without data."""
    n = metrics.counts(called, "tool")
    most = n.agg(F.max("n").alias("most"))  # one row
    return registry.join(n, "tool", "left").crossJoin(F.broadcast(most)).select("endpoint", F.coalesce(F.col("most") / (F.coalesce("n", F.lit(0)) + 1), F.lit(1.0)).alias("weight"))


def suggest(called: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: the least used domain (by name, among equals), and whether chains should use several tools."""
    n = metrics.counts(called, "domain")
    known = registry.select("domain").where("domain is not null").distinct().join(n, "domain", "left").select("domain", F.coalesce("n", F.lit(0)).alias("n"))
    least = known.agg(F.min(F.struct("n", "domain")).alias("m")).select(F.col("m.domain").alias("domain"), F.col("m.n").alias("n"))
    held = diversity_metrics(called).select(((F.col("n_conversations") > 5) & (F.col("pair_ratio") < 0.3)).alias("require_multi_tool"))
    return least.crossJoin(held)


def top_tools(called: DataFrame, k: int = 5) -> DataFrame:
    """W8."""
    return metrics.counts(called, "tool").orderBy(F.desc("n"), "tool").limit(k)
