"""Shared plumbing: text batches and distributed components; stored tables come from the library's storage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_stored, stored

__all__ = ["Forest", "components", "drop_stored", "local_roots", "pieces", "slices", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about `most` bytes of text each (one row at least), and their texts as bytes, null as empty."""
    for part in pieces(batch, column, most):
        yield part, [x or b"" for x in part.column(column).cast(pa.large_binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each (one row at least)."""
    texts = batch.column(column).cast(pa.large_binary())
    sizes = np.cumsum(np.array([0 if n is None else n for n in pc.binary_length(texts).to_pylist()], np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, nodes 0..n-1 joined by a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


class Forest:
    """Gathers links between local nodes and keeps a spanning forest of them, in bounded memory."""

    def __init__(self, n: int, most: int = 2_000_000):
        self.n, self.most, self.a, self.b, self.held = n, most, [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > self.most:
            self.links()

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        root = local_roots(self.n, np.concatenate(self.a or [np.empty(0, int)]), np.concatenate(self.b or [np.empty(0, int)]))
        node = np.flatnonzero(root != np.arange(self.n))
        self.a, self.b, self.held = [node], [root[node]], 0
        return node, root[node]


#: What tells whether a round of components() changed anything.
_MARK = ("count(*)", "sum(cast(xxhash64(v, m) as decimal(38, 0)))")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b) that isn't its component's smallest; root is that smallest node.

    Alternating large-star and small-star rounds; each leaves at most as many edges as before, and hubs only meet in
    joins whose other side has one row a key (so AQE can split them). The number of rounds grows with the logarithm of
    the longest chain.
    """
    state = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges")
    mark, now = None, tuple(state.selectExpr(*_MARK).first())
    while now != mark and now[0]:
        both = state.select(F.col("v").alias("u"), F.col("m").alias("w")).union(state.select(F.col("m"), F.col("v")))
        least = both.groupBy("u").agg(F.min("w").alias("w0")).select("u", F.least("u", "w0").alias("m"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), "m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("mm"))
        small = large.join(low, "v").where("m <> mm").select(F.col("m").alias("v"), F.col("mm").alias("m")).union(low.select("v", F.col("mm").alias("m"))).distinct()
        before, state = state, stored(small, "edges")
        drop_stored(before)
        mark, now = now, tuple(state.selectExpr(*_MARK).first())
    return state.select(F.col("v").alias("node"), F.col("m").alias("root"))
