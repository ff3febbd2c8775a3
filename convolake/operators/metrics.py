"""Entropy, coverage and balance of counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n), rows without a key left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def entropy_of(counted: DataFrame, n: str = "n", by: list[str] = [], base: float | None = None) -> DataFrame:  # noqa: B006
    """A1: (by…, entropy, entropy_norm, n_items) of positive counts; natural logarithms, or of `base`.

    From sum(n), sum(n ln n) and the number of items, which add up, so counts meet in no window and no single task:
    H = ln N - sum(n ln n) / N. One item or none has no entropy.
    """
    x = F.col(n).cast("double")
    sums = counted.where(F.col(n) > 0).groupBy(*by).agg(F.sum(x).alias("total"), F.sum(x * F.log(x)).alias("spread"), F.count("*").alias("k"))
    h = F.when(F.col("k") > 1, F.greatest(F.log("total") - F.col("spread") / F.col("total"), F.lit(0.0))).otherwise(0.0)
    unit = math.log(base) if base else 1.0
    return sums.select(*by, (h / unit).alias("entropy"), F.when(F.col("k") > 1, h / F.log(F.col("k").cast("double"))).otherwise(0.0).alias("entropy_norm"), F.col("k").alias("n_items"))


def entropy(df: DataFrame, key: str, by: list[str] = [], base: float | None = None) -> DataFrame:  # noqa: B006
    """A1 of a column."""
    return entropy_of(df.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count("*").alias("n")), by=by, base=base)


def max_entropy(k) -> Column:
    """A2."""
    k = F.col(k) if isinstance(k, str) else k
    return F.when(k > 1, F.log(k.cast("double"))).otherwise(0.0)


def possible_pairs(k) -> Column:
    """A4."""
    k = F.col(k) if isinstance(k, str) else k
    return F.when(k > 1, (k * (k - 1) / 2).cast("long")).otherwise(F.lit(0).cast("long"))


def pair_ratio(pairs: DataFrame, items: Column | None = None, a: str = "a", b: str = "b", n: str = "n") -> DataFrame:
    """A3: (n_pairs, n_items, pair_ratio) of counted pairs; items are those of all pairs, unless their number is given."""
    seen = pairs.select(F.explode(F.array(a, b)).alias("item")).distinct().agg(F.count("*").alias("n_items"))
    found = pairs.agg(F.count_if(F.col(n) > 0).alias("n_pairs")).crossJoin(seen)  # two single rows
    k = F.col("n_items") if items is None else items
    return found.select("n_pairs", k.cast("long").alias("n_items"), F.when(k > 1, F.col("n_pairs") / possible_pairs(k)).otherwise(0.0).alias("pair_ratio"))


def gini(counted: DataFrame, n: str = "n") -> DataFrame:
    """The Gini index of counts (0 for none). Ranks come from the counts of equal counts, which are few."""
    levels = counted.groupBy(F.col(n).cast("double").alias("x")).agg(F.count("*").cast("double").alias("m"))
    w = Window.orderBy("x")
    before = F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranked = levels.select("x", "m", (F.col("m") * before + F.col("m") * (F.col("m") + 1) / 2).alias("ranks"))
    sums = ranked.agg(F.sum(F.col("x") * F.col("ranks")).alias("r"), F.sum(F.col("x") * F.col("m")).alias("t"), F.sum("m").alias("k"))
    return sums.select(F.coalesce(F.when(F.col("t") > 0, 2 * F.col("r") / (F.col("k") * F.col("t")) - (F.col("k") + 1) / F.col("k")), F.lit(0.0)).alias("gini"))


def quality_histogram(df: DataFrame, score: str) -> DataFrame:
    """Rows a bin of a score between 0 and 1."""
    x = F.col(score)
    name = F.when(x >= 0.9, "excellent").when(x >= 0.8, "good").when(x >= 0.7, "fair").when(x >= 0.6, "weak").otherwise("poor")
    return df.where(x.isNotNull()).groupBy(name.alias("bin")).agg(F.count("*").alias("n"))
