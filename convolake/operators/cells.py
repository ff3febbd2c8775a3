"""Cells of vectors around centres: a bounded sample fits them, then every vector is dealt to its nearest one."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def sample(vectors: DataFrame, total: int, size: int, rows: int = 16_384, most: int = 16_000_000) -> np.ndarray:
    """About `rows` different vectors (column v, of `size` components; `most` bytes at most), drawn by a hash of what they hold.

    Ordered by that hash: the same table gives the same sample, whatever its partitions are.
    """
    rows = max(1, min(rows, most // (8 * size)))
    every = max(1, total // rows)
    drawn = vectors.where(F.size("v") == size).select(F.xxhash64("v").alias("h"), "v").where(F.pmod("h", F.lit(every)) == 0)
    drawn = drawn.groupBy("h").agg(F.first("v").alias("v")).orderBy("h").limit(rows)
    held = drawn.select("v").toArrow().column("v").combine_chunks()
    return np.asarray(held.flatten(), np.float64).reshape(-1, size)


def nearest(x: np.ndarray, centres: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centre (the first of several) and its distance."""
    cell, far = np.empty(len(x), np.int64), np.empty(len(x))
    length = (centres**2).sum(1)
    for at in range(0, len(x), step):
        part = x[at : at + step]
        cell[at : at + step] = k = (length - 2 * part @ centres.T).argmin(1)
        far[at : at + step] = np.sqrt(((part - centres[k]) ** 2).sum(1))
    return cell, far


def fit(x: np.ndarray, cells: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centres of k-means over x, at most `cells`; centres that lose all vectors move to those farthest from theirs."""
    cells = max(1, min(cells, len(x)))
    centres = x[np.random.default_rng(seed).choice(len(x), cells, replace=False)].copy()
    for _ in range(rounds):
        cell, far = nearest(x, centres)
        count = np.bincount(cell, minlength=cells)
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        full = count > 0
        centres[full] = total[full] / count[full, None]
        centres[~full] = x[np.argsort(-far, kind="stable")[: int((~full).sum())]]
    return centres
