"""Answers of language models as a table keyed by a hash of the request."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTRY = "prompt_hash string, content string, model string, created_at timestamp, hit_count long, last_accessed timestamp"


def request_hash(prompt, model, system=None, temperature=None, tools=None, messages=None) -> Column:
    """One name for a request; each field counts, and a missing one differs from an empty one."""
    fields = {"prompt": prompt, "model": model, "system": system, "temperature": temperature, "tools": tools, "messages": messages}
    parts = [(F.col(x) if isinstance(x, str) else x if x is not None else F.lit(None)).cast("string").alias(k) for k, x in fields.items()]
    return F.md5(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))


def lookup(requests: DataFrame, entries: DataFrame, key: str = "prompt_hash") -> DataFrame:
    """Requests with the cached content, or null."""
    return requests.join(entries.select(key, "content"), key, "left")


def misses(requests: DataFrame, entries: DataFrame, key: str = "prompt_hash") -> DataFrame:
    """J5."""
    return requests.join(entries.select(key), key, "left_anti")


#: Bits set by each key, and bits a key: about 1.2 % of other keys seem to be there.
HASHES, BITS = 4, 10


def _place(key: str, bits: int) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(F.lit(1), key), F.lit(bits))


def bloom(keys: DataFrame, words: int, key: str = "prompt_hash") -> DataFrame:
    """(word, bits): a Bloom filter of keys, as its words of 64 bits that aren't empty; made in parts that are joined before they are sent."""
    first, step = _place(key, 64 * words)
    at = F.explode(F.array(*[(first + k * step) % (64 * words) for k in range(HASHES)])).alias("at")
    return keys.where(F.col(key).isNotNull()).select(at).select(F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def blooms_merged(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of filters of one size."""
    both = filters[0]
    for other in filters[1:]:
        both = both.unionByName(other)
    return both.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_words(keys: int) -> int:
    """Words of a filter for so many keys."""
    return max(1, -(-keys * BITS // 64))


def maybe_there(filter_: DataFrame, words: int, key: str = "prompt_hash") -> Column:
    """Whether a key may be in the filter; false is certain. The filter's bits go to all tasks: 8 bytes a word."""
    held = filter_.toArrow()
    bits = np.zeros(words, np.uint64)
    bits[held.column("word").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)

    def probe(first: pd.Series, step: pd.Series) -> pd.Series:
        there = np.ones(len(first), bool)
        for k in range(HASHES):
            at = (first.to_numpy() + k * step.to_numpy()) % (64 * words)
            there &= (bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(there)

    return F.pandas_udf(probe, "boolean")(*_place(key, 64 * words))


def misses_filtered(requests: DataFrame, entries: DataFrame, key: str = "prompt_hash", most: int = 64_000_000) -> DataFrame:
    """J5 with most requests settled where they are: those that a Bloom filter of the entries rules out are not sent to the anti join.

    The filter's size follows from the number of entries; where it would take over `most` bytes, all requests are joined.
    """
    words = bloom_words(entries.count())
    if 8 * words > most:
        return misses(requests, entries, key)
    maybe = maybe_there(bloom(entries, words, key), words, key)
    marked = requests.withColumn("_maybe", maybe)
    return marked.where(~F.col("_maybe")).drop("_maybe").unionByName(misses(marked.where("_maybe").drop("_maybe"), entries, key))


def touched(entries: DataFrame, requests: DataFrame, now: Column) -> DataFrame:
    """Entries with hits and last access after these requests."""
    hits = requests.groupBy("prompt_hash").agg(F.count("*").alias("hits"))
    return entries.join(hits, "prompt_hash", "left").withColumn("hit_count", F.col("hit_count") + F.coalesce("hits", F.lit(0))).withColumn("last_accessed", F.when(F.col("hits") > 0, now).otherwise(F.col("last_accessed"))).drop("hits")


def recent(entries: DataFrame, keep: int) -> DataFrame:
    """The most recently used `keep` entries. A sort with a limit keeps that many rows a task."""
    return entries.orderBy(F.desc("last_accessed"), "prompt_hash").limit(keep)


def latest(entries: DataFrame) -> DataFrame:
    """Of entries with one key, the newest."""
    return entries.withColumn("_nth", F.row_number().over(Window.partitionBy("prompt_hash").orderBy(F.desc("created_at")))).where("_nth = 1").drop("_nth")


def invalidate(entries: DataFrame, keys: DataFrame) -> DataFrame:
    return entries.join(keys.select("prompt_hash"), "prompt_hash", "left_anti")


def stats(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Hits, misses and the hit rate of requests, and the number of entries."""
    found = requests.join(entries.select("prompt_hash", F.lit(1).alias("there")).distinct(), "prompt_hash", "left")
    return found.agg(F.count("there").alias("hits"), F.count_if(F.col("there").isNull()).alias("misses"), F.coalesce(F.avg(F.when(F.col("there").isNotNull(), 1.0).otherwise(0.0)), F.lit(0.0)).alias("hit_rate")).crossJoin(entries.agg(F.count("*").alias("entries")))


def by_shard(entries: DataFrame) -> DataFrame:
    """Entries with the folder they belong to, for partitionBy("shard")."""
    return entries.withColumn("shard", F.substring("prompt_hash", 1, 2))


# -- two tiers: the entries used last, and all of them on disk --


def save(entries: DataFrame, path: str) -> None:
    """The disk tier, in one folder for each first two digits of the key."""
    by_shard(entries).write.mode("append").partitionBy("shard").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The disk tier's latest entries; those without a key or content, or with a wrong key for their folder, are left out."""
    read = spark.read.schema(f"{ENTRY}, shard string").parquet(path)
    fine = F.col("prompt_hash").isNotNull() & F.col("content").isNotNull() & (F.substring("prompt_hash", 1, 2) == F.col("shard"))
    return latest(read.where(fine).drop("shard"))


def tiered(requests: DataFrame, memory: DataFrame, disk: DataFrame, key: str = "prompt_hash") -> DataFrame:
    """Requests with content and the tier that has it (memory, then disk; null: neither)."""
    named = lambda tier, name: tier.select(key, F.col("content").alias(name))
    found = requests.join(named(memory, "_memory"), key, "left").join(named(disk, "_disk"), key, "left")
    tier = F.when(F.col("_memory").isNotNull(), "memory").when(F.col("_disk").isNotNull(), "disk")
    return found.withColumns({"content": F.coalesce("_memory", "_disk"), "tier": tier}).drop("_memory", "_disk")


def remembered(requests: DataFrame, memory: DataFrame, disk: DataFrame, now: Column, keep: int = 1000) -> DataFrame:
    """The memory tier after these requests: its hits count, entries found on disk come in as they are, and the `keep` used last stay."""
    asked = requests.select("prompt_hash").distinct()
    fetched = disk.join(asked, "prompt_hash", "left_semi").join(memory.select("prompt_hash"), "prompt_hash", "left_anti")
    return recent(touched(memory, requests, now).unionByName(fetched.withColumn("last_accessed", now)), keep)
