"""What conversations have used, as counts that add up: parts are merged, and taken back, without reading conversations again.

A state is (kind, a, b, n): calls of a tool or domain (a), conversations with a pair of tools (a before b) or with a
pattern (a: the hash of their tools), and conversations. b is empty but for pairs. Counts of disjoint sets of conversations
add up to those of their union; a set that goes is added with its sign turned. Entries that come to nothing are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import metrics
from .diversity import dealt

STATE = "kind string, a string, b string, n long"
CALLS = "array<struct<tool:string,domain:string,n:bigint>>"


def finished(called: DataFrame) -> DataFrame:
    """(conv, calls): of each conversation of called(conv, tool, domain), how often it calls what."""
    each = dealt(called.select("conv", "tool", "domain")).groupBy("conv", F.col("tool").cast("string").alias("tool"), F.col("domain").cast("string").alias("domain")).agg(F.count("*").alias("n"))
    return each.groupBy("conv").agg(F.collect_list(F.struct("tool", "domain", "n")).alias("calls"))


def _entry(kind: str, a: Column, n: Column, b: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), a.alias("a"), (F.lit("") if b is None else b).alias("b"), n.cast("long").alias("n"))


def contributions(ended: DataFrame) -> DataFrame:
    """The state of finished(conv, calls) alone, read once: entries are made in each conversation and added up before they are sent."""
    one = F.lit(1)
    calls = F.col("calls")
    rows = ended.withColumn("tools", F.array_sort(F.array_distinct(F.filter(F.transform(calls, lambda c: c["tool"]), lambda t: t.isNotNull()))))
    pairs = F.flatten(F.transform("tools", lambda a, i: F.transform(F.slice("tools", i + 2, F.size("tools")), lambda b: _entry("pair", a, one, b))))
    entries = F.concat(
        F.transform(F.filter(calls, lambda c: c["tool"].isNotNull()), lambda c: _entry("tool", c["tool"], c["n"])), F.transform(F.filter(calls, lambda c: c["domain"].isNotNull()), lambda c: _entry("domain", c["domain"], c["n"])),
        pairs, F.array(_entry("pattern", F.substring(F.md5(F.array_join("tools", ",")), 1, 16), one), _entry("conversation", F.lit(""), one)),
    )
    return merged(rows.select(F.inline(entries)))


def merged(*parts: DataFrame) -> DataFrame:
    """The sum of states."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).where("n <> 0")


def retracted(part: DataFrame) -> DataFrame:
    """What takes a part back when merged with a state that holds it."""
    return part.withColumn("n", -F.col("n"))


def weights(state: DataFrame, registry: DataFrame) -> DataFrame:
    """A10 of a state: (endpoint, weight) for all of registry(endpoint, tool): the largest tool count over its own tool's, plus one; 1 without data."""
    n = state.where("kind = 'tool'").select(F.col("a").alias("tool"), "n")
    most = n.agg(F.max("n").alias("most"))  # one row
    named = registry.select("endpoint", F.col("tool").cast("string").alias("tool")).join(n, "tool", "left").crossJoin(most)
    return named.select("endpoint", F.coalesce(F.col("most") / (F.coalesce("n", F.lit(0)) + 1), F.lit(1.0)).alias("weight"))


def diversity_metrics(state: DataFrame) -> DataFrame:
    """A8 of a state: what diversity.diversity_metrics() gives for the conversations themselves."""
    entropy = lambda kind: metrics.entropy_of(state.where(F.col("kind") == kind).select("n")).select(F.col("entropy").alias(f"{kind}_entropy"), F.col("n_items").alias(f"n_{kind}s"))
    counted = lambda kind: F.count_if(F.col("kind") == kind).alias(f"n_{kind}s")
    rest = state.agg(counted("pair"), counted("pattern"), F.coalesce(F.sum(F.when(F.col("kind") == "conversation", F.col("n"))), F.lit(0)).alias("n_conversations"))
    row = entropy("tool").crossJoin(entropy("domain")).crossJoin(rest)  # single rows
    return row.withColumn("pair_ratio", F.col("n_pairs") / F.when(F.col("n_tools") > 1, metrics.possible_pairs("n_tools")).otherwise(1))


class StateTable:
    """A state by versions, in a folder that all executors share: version k is what versions up to k add.

    Versions are numbered from 0 without gaps and written in turn, as micro-batches are. A version that is written again
    replaces itself, and reads only what was before it, so a replay changes nothing. Every `every` versions their sum is
    written, too, so reading a state reads one sum and fewer than `every` parts.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 10):
        self.spark, self.path, self.every = spark, path, every

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/{path}")

    def before(self, version: int) -> DataFrame:
        """The sum of all versions before this one."""
        summed = version // self.every * self.every
        parts = [self._read(f"sums/{summed - 1}")] if summed else []
        parts += [self._read(f"parts/{k}") for k in range(summed, version)]
        return merged(*parts) if parts else self.spark.createDataFrame([], STATE)

    def commit(self, version: int, part: DataFrame) -> None:
        part.select("kind", "a", "b", "n").write.mode("overwrite").parquet(f"{self.path}/parts/{version}")
        if (version + 1) % self.every == 0:
            merged(self.before(version), self._read(f"parts/{version}")).write.mode("overwrite").parquet(f"{self.path}/sums/{version}")
