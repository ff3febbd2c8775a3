"""Exact cosine pairs without comparing everything: blocks of vectors that the triangle bound keeps apart never meet."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from . import cells
from .similarity import TINY, block_pairs, blocks_a_group, component

#: Angles to pivots are cut into so many bins.
BINS = 1024


def _units(batch: pa.RecordBatch) -> np.ndarray:
    x = np.asarray(batch.column("v").flatten(), np.float64).reshape(batch.num_rows, -1)
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + TINY)


class Blocks:
    """Blocks of vectors: bins of angle around a pivot; how near each may come to each pivot; and which of them must meet.

    Two vectors are no nearer in angle than the difference of their angles to any pivot. So two blocks can't hold a pair
    within `reach` if their intervals of angles to some pivot are further apart than that.
    """

    def __init__(self, counts: list, low: np.ndarray, high: np.ndarray, rows: int):
        """counts: (cell, bin, n), sorted; low and high: the least and largest angle of (cell, bin) to each pivot."""
        self.of: dict[tuple[int, int], tuple[int, int]] = {}
        self.low, self.high, held = [], [], None
        for at, (cell, bin_, n) in enumerate(counts):
            parts = math.ceil(n / rows)
            if held is not None and held[0] == cell and parts == 1 and held[1] + n <= rows:
                block = len(self.low) - 1
                self.low[block], self.high[block] = np.minimum(self.low[block], low[at]), np.maximum(self.high[block], high[at])
                held = cell, held[1] + n
            else:
                block = len(self.low)
                self.low += [low[at]] * parts
                self.high += [high[at]] * parts
                held = (cell, n) if parts == 1 else None
            self.of[cell, bin_] = block, parts

    def meeting(self, reach: float) -> list[np.ndarray]:
        """For each block the blocks it must meet, itself included."""
        low, high = np.array(self.low), np.array(self.high)
        return [np.flatnonzero((np.maximum(low - high[k], low[k] - high).max(1) <= reach)) for k in range(len(low))]


def pruned_pairs(vectors: DataFrame, threshold: float, rows: int = 2048, pivots: int = 64, most: int = 1024) -> tuple[DataFrame, int, int]:
    """The pairs of cosine_pairs(), and how many pairs of blocks were compared, of how many there are.

    Up to `pivots` directions are fitted on a bounded sample. A vector is dealt to its nearest pivot and, there, by its
    angle to it; neighbouring bins of angles are one block of up to `rows` vectors, and a fuller bin is cut by a hash of
    the id. Only vectors of blocks that must meet are sent, once for each group of neighbouring blocks. Blocks grow with the table
    beyond `most` of them (plus two for each pivot), so what the driver knows, a row of angles a block, stays bounded.

    Vectors have one size. Null vectors pair with nothing, as do zero vectors; the threshold is above 0.
    """
    if not threshold > 0:
        raise ValueError("the threshold must be above 0")
    number = component(vectors)
    own = stored(vectors.where("embedding is not null").select("id", F.col("embedding").cast(f"array<{number}>").alias("v")).where(cells.usable(F.col("v"))), "vectors")
    total = own.count()
    kind = vectors.schema["id"].dataType.simpleString()
    if not total:
        return own.sparkSession.createDataFrame([], f"a {kind}, b {kind}, score double"), 0, 0
    rows = max(rows, math.ceil(total / most))
    size = own.select(F.size("v")).first()[0]
    drawn = cells.sample(own, total, size)
    drawn = drawn / (np.linalg.norm(drawn, axis=1, keepdims=True) + TINY)
    pivot = cells.fit(drawn, min(pivots, max(1, math.ceil(math.sqrt(total / rows) * 4))))
    pivot = pivot / (np.linalg.norm(pivot, axis=1, keepdims=True) + TINY)

    def angles(x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ pivot.T, -1, 1))

    def dealt(batches):
        for batch in batches:
            if batch.num_rows:
                angle = angles(_units(batch))
                cell = angle.argmin(1)
                bin_ = np.minimum((angle[np.arange(len(cell)), cell] / math.pi * BINS).astype(np.int32), BINS - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(bin_)], ["id", "v", "cell", "bin"])

    placed = stored(own.mapInArrow(dealt, f"id {kind}, v array<{number}>, cell int, bin int"), "placed")

    def spans(batches):
        # A bin's own interval in this batch; bins are few, so these rows add up before they are sent.
        for batch in batches:
            if batch.num_rows:
                angle = angles(_units(batch))
                key = np.asarray(batch.column("cell")).astype(np.int64) * BINS + np.asarray(batch.column("bin"))
                keys, of, n = np.unique(key, return_inverse=True, return_counts=True)
                low, high = np.full((len(keys), len(pivot)), np.inf), np.full((len(keys), len(pivot)), -np.inf)
                np.minimum.at(low, of, angle)
                np.maximum.at(high, of, angle)
                grid = np.tile(np.arange(len(pivot), dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, len(pivot))), pa.array(grid), pa.array(np.repeat(n, len(pivot))), pa.array(low.ravel()), pa.array(high.ravel())], ["key", "pivot", "n", "low", "high"])

    # At most BINS rows a pivot, each with an interval for each pivot: a bounded table, whatever the vectors are.
    found = placed.mapInArrow(spans, "key long, pivot int, n long, low double, high double").groupBy("key", "pivot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow().sort_by([("key", "ascending"), ("pivot", "ascending")])
    key, n = (found.column(c).to_numpy()[:: len(pivot)] for c in ("key", "n"))
    low, high = (found.column(c).to_numpy().reshape(-1, len(pivot)) for c in ("low", "high"))
    blocks = Blocks([(int(k) // BINS, int(k) % BINS, int(c)) for k, c in zip(key, n)], low, high, rows)
    # A little slack for rounding: comparing more is always right.
    meeting = blocks.meeting(math.acos(min(1.0, threshold)) + 1e-7)

    # Neighbouring blocks are sent together; a vector goes to each group in which a block meets its own.
    meets = np.zeros((len(meeting), len(meeting)), bool)
    for k, m in enumerate(meeting):
        meets[k, m] = True
    per = blocks_a_group(len(meeting), rows, size)
    groups = [np.unique(m // per) for m in meeting]

    def sent(batches):
        for batch in batches:
            ids = np.arange(batch.num_rows)
            at = [blocks.of[c, b] for c, b in zip(batch.column("cell").to_pylist(), batch.column("bin").to_pylist())]
            block = np.array([first + int(h) % parts for (first, parts), h in zip(at, batch.column("hash").to_pylist())], np.int32)
            others = [groups[b] for b in block]
            again = np.repeat(ids, [len(o) for o in others])
            other = np.concatenate(others).astype(np.int32) if others else np.empty(0, np.int32)
            block = block[again]
            own_ = block // per
            for k in range(0, len(again), 4096):
                pick = slice(k, k + 4096)
                part = batch.take(pa.array(again[pick]))
                numbers = [block, own_, np.minimum(own_, other), np.maximum(own_, other)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.nulls(part.num_rows, pa.string()), *(pa.array(x[pick].astype(np.int32)) for x in numbers)], ["id", "v", "domain", "block", "own", "i", "j"])

    rows_ = placed.withColumn("hash", F.pmod(F.xxhash64("id"), F.lit(2**31))).mapInArrow(sent, f"id {kind}, v array<{number}>, domain string, block int, own int, i int, j int")
    compared = sum(int((m >= k).sum()) for k, m in enumerate(meeting))
    return block_pairs(rows_, threshold, kind, meets).select("a", "b", "score"), compared, len(meeting) * (len(meeting) + 1) // 2
