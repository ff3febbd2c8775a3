"""Near-duplicate embeddings by Euclidean p-stable hashing, with exact cosine checks.

Equal vectors are one class. Normalised vectors are projected on normal directions, shifted, and cut into cells of one
width; the cells of `k` projections name a bucket, in each of `tables` tables. k grows with the logarithm of the number
of classes, so that unrelated vectors share a bucket with about `bucket` others, and the number of tables keeps the
chance to miss a pair at the threshold below `miss` (far below that for closer pairs).

Vectors are not sent to their buckets: a row of a bucket is a class's number and a sketch, 64 coordinates in four bits
each. These are the vector turned at random, or a random projection of a larger one, so sketches tell distances and not
only angles: a common direction of all vectors, or of many, doesn't make unrelated ones alike. Pairs in a bucket whose
sketches are no further apart than those of pairs at the threshold (by four deviations) are candidates; of these a
spanning forest leaves the task. What candidates connect is then brought together, and all pairs in there are checked
exactly. Where that is more than `most` classes they are dealt to blocks of that many, and each pair of blocks is a group
of its own: the same pairs are checked, a vector is sent once for each block.

No pairs are sent. What leaves a task are link counts of classes and a spanning forest of the links. Buckets of over
`wide` rows are cut into blocks in the same way.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of different sizes
never link. Rows that repeat are vectors of their own (copies). Rows without an id keep their row; a component's id is
its smallest non-null id. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Coordinates of a sketch, four bits each.
SKETCH = 64
ROW = "bucket long, cid long, n long, vec binary"


def same_cell(distance: float, width: float) -> float:
    """The chance that points this far apart share a cell of a projection."""
    x = width / distance
    return math.erf(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


class Hashing:
    def __init__(self, rows: int, threshold: float, miss: float = 1e-3, bucket: int = 256, width: float = 2.5, seed: int = 6):
        near, far = same_cell(math.sqrt(2 - 2 * threshold), width), same_cell(math.sqrt(2), width)
        self.k = max(4, math.ceil(math.log(max(rows, bucket) / bucket) / -math.log(far)))
        self.tables = math.ceil(math.log(miss) / math.log1p(-(near**self.k)))
        self.width, self.seed = width, seed

    def signatures(self, unit: np.ndarray) -> np.ndarray:
        """64-bit names of each row's buckets, one a table."""
        d = unit.shape[1]
        rng = np.random.default_rng([self.seed, d])
        turn, shift = rng.normal(size=(d, self.tables * self.k)), rng.uniform(0, self.width, self.tables * self.k)
        mix = rng.integers(1 << 62, size=(self.tables, self.k), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        cells = np.floor((unit @ turn + shift) / self.width).astype(np.int64).astype(np.uint64).reshape(len(unit), self.tables, self.k)
        x = (cells * mix).sum(2, dtype=np.uint64) + mix[:, 0] * np.uint64(d)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)  # Fixed value: an odd multiplier near the golden ratio of 2 ** 64.
        return x ^ (x >> np.uint64(29))


class Sketching:
    """Coordinates of turned (or projected) vectors, in four bits: near pairs are near in them.

    A coordinate of a unit vector deviates by 1 / sqrt(SKETCH), so steps cover four deviations each way; what lies
    beyond is clipped, which only brings sketches nearer. Squared distances of projections deviate by sqrt(2 / SKETCH) of
    themselves where vectors have more coordinates than sketches, and by little else; rounding adds a twelfth of a squared
    step for each coordinate of each of both.
    """

    def __init__(self, threshold: float, seed: int = 9, deviations: float = 4.0):
        self.threshold, self.seed, self.deviations = threshold, seed, deviations
        self.step = 8 / math.sqrt(SKETCH) / 15

    def most(self, d: int) -> float:
        """The largest squared distance of candidates' sketches, in squared steps, for vectors of d coordinates."""
        apart, rounding = (2 - 2 * self.threshold) / self.step**2, SKETCH / 6
        # Rounding of a coordinate difference: its square deviates, and so does its product with the difference.
        noise = math.sqrt(SKETCH * 7 / 180 + 4 * apart / 6) + (apart * math.sqrt(2 / SKETCH) if d > SKETCH else 0)
        return apart + rounding + self.deviations * noise

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """Four 64-bit numbers for each vector."""
        d = unit.shape[1]
        turn = np.random.default_rng([self.seed, d]).normal(size=(max(d, SKETCH), SKETCH))
        # Directions at right angles keep distances; of larger vectors a part is kept, scaled to the whole.
        turn = np.linalg.qr(turn)[0][:d] * math.sqrt(max(d, SKETCH) / SKETCH)
        cells = np.clip(np.rint(unit @ turn / self.step + 7.5), 0, 15).astype(np.uint8)
        return (cells[:, ::2] | cells[:, 1::2] << 4).view(np.uint64)

    @staticmethod
    def coordinates(sketches: np.ndarray) -> np.ndarray:
        """In steps, as numbers."""
        pairs = np.ascontiguousarray(sketches).view(np.uint8).reshape(len(sketches), -1)
        return np.stack([pairs & 15, pairs >> 4], 2).reshape(len(sketches), -1).astype(np.float32)


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors of length one. Scaled by the largest component first: its square neither overflows nor vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Block:
    """Rows of some groups; finds the pairs that are near and keeps a forest of them."""

    def __init__(self, rows: int):
        self.forest = common.Forest(rows)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def near_all(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.forest.add(i, j)

    def small(self, start: np.ndarray, size: np.ndarray) -> None:
        """All pairs within groups of a few rows, by how far apart they stand."""
        of = np.repeat(np.arange(len(start)), size)
        at = np.concatenate([np.arange(a, a + s) for a, s in zip(start, size)]) if len(start) else np.empty(0, int)
        for apart in range(1, int(size.max(initial=0))):
            k = np.flatnonzero(of[apart:] == of[:-apart])
            for part in np.array_split(k, len(k) // 50_000 + 1):
                i, j = at[part], at[part + apart]
                hit = self.near(i, j)
                if hit.any():
                    self.add(i[hit], j[hit])

    def large(self, left: np.ndarray, right: np.ndarray, same: bool, step: int = 512) -> None:
        """All pairs of two sides, or (same) all pairs within one."""
        for a in range(0, len(left), step):
            for b in range(a if same else 0, len(right), step):
                x, y = left[a : a + step], right[b : b + step]
                i, j = np.nonzero(self.near_all(x, y))
                if same and a == b:
                    i, j = i[i < j], j[i < j]
                for part in range(0, len(i), 100_000):
                    self.add(x[i[part : part + 100_000]], y[j[part : part + 100_000]])

    def groups(self, keys: np.ndarray, own: np.ndarray, few: int = 128) -> None:
        """All pairs of each group; keys (group, i, j) are sorted, and rows of blocks i and j meet where these differ."""
        edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        count = np.diff(np.append(edge, len(keys)))
        little = (count <= few) & (keys[edge, 1] == keys[edge, 2])
        self.small(edge[little], count[little])
        for a, s in zip(edge[~little], count[~little]):
            at = np.arange(a, a + s)
            if keys[a, 1] == keys[a, 2]:
                self.large(at, at, True)
            else:
                self.large(at[own[at] == keys[a, 1]], at[own[at] == keys[a, 2]], False)


class Sketches(Block):
    def __init__(self, at: np.ndarray, most: np.ndarray):
        super().__init__(len(at))
        self.at, self.most, self.length = at, most, (at**2).sum(1)

    def near(self, i, j):
        return ((self.at[i] - self.at[j]) ** 2).sum(1) <= self.most[i]

    def near_all(self, i, j):
        # Whole numbers below 2^24, so sums of products are exact.
        return self.length[i][:, None] + self.length[j] - 2 * self.at[i] @ self.at[j].T <= self.most[i][:, None]


class Vectors(Block):
    """Checks cosines, and counts links of classes of n rows each."""

    def __init__(self, n: np.ndarray, unit: np.ndarray, threshold: float):
        super().__init__(len(n))
        self.n, self.unit, self.threshold = n, unit, threshold
        self.links = np.zeros(len(n), np.int64)

    def near(self, i, j):
        return np.einsum("nd,nd->n", self.unit[i], self.unit[j]) >= self.threshold

    def near_all(self, i, j):
        return self.unit[i] @ self.unit[j].T >= self.threshold

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.links, i, self.n[j])
        np.add.at(self.links, j, self.n[i])
        self.forest.add(i, j)


def _keys(rows: pa.Table) -> np.ndarray:
    return np.stack([rows[c].to_numpy() for c in ("bucket", "i", "j")], 1)


def _candidates(sketching: Sketching):
    """Forest links (a, b) of the rows of whole groups whose sketches are near; buckets' names differ by vectors' sizes."""

    def check(rows: pa.Table) -> pa.RecordBatch | None:
        at = Sketching.coordinates(np.stack([rows[c].to_numpy().view(np.uint64) for c in ("s0", "s1", "s2", "s3")], 1))
        sizes, of = np.unique(rows["d"].to_numpy(), return_inverse=True)
        block = Sketches(at, np.array([sketching.most(int(d)) for d in sizes], np.float32)[of])
        block.groups(_keys(rows), rows["own"].to_numpy())
        a, b = block.forest.links()
        cid = rows["cid"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(cid[a]), pa.array(cid[b])], ["a", "b"]) if len(a) else None

    return check


def _check(threshold: float, kind: str):
    """Link counts (a: class, b: null) and forest links (a, b) of whole groups."""

    def check(rows: pa.Table) -> pa.RecordBatch | None:
        vec = np.asarray(pc.binary_length(rows["vec"].combine_chunks().cast(pa.large_binary())))
        out = []
        for size in np.unique(vec):
            part = rows.filter(pa.array(vec == size))
            x = np.frombuffer(b"".join(part["vec"].to_pylist()), kind).reshape(part.num_rows, -1).astype(np.float64)
            block = Vectors(part["n"].to_numpy(), _units(x), threshold)
            block.groups(_keys(part), part["own"].to_numpy())
            hit, cid = np.flatnonzero(block.links), part["cid"].to_numpy()
            a, b = block.forest.links()
            out.append((np.concatenate([cid[hit], cid[a]]), np.concatenate([block.links[hit], cid[b]]), np.repeat([True, False], [len(hit), len(a)])))
        a, b, counted = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(counted), pa.array(a), pa.array(b)], ["counted", "a", "b"]) if len(a) else None

    return check


def _by_group(check, rows: int = 16_384):
    """Calls check with whole groups, about `rows` rows at a time; rows come sorted by group."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        waiting = 0

        def whole(final: bool):
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            cut = table.num_rows
            if not final:
                same = (_keys(table) == _keys(table.slice(cut - 1))).all(1)
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if cut < table.num_rows:
                    held.extend(table.slice(cut).to_batches())
            return check(table.slice(0, cut)) if cut else None

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                waiting += batch.num_rows
            if waiting >= rows:
                if (out := whole(False)) is not None:
                    yield out
                waiting = 0
        if held and (out := whole(True)) is not None:
            yield out

    return run


def _of_size(batches, step: int = 512):
    """Parts of batches whose vectors (column v) are of one size, and their vectors."""
    for batch in batches:
        sizes = np.asarray(pc.list_value_length(batch.column("v")))
        for size in np.unique(sizes):
            of_size = batch.filter(pa.array(sizes == size))
            for at in range(0, of_size.num_rows, step):
                part = of_size.slice(at, step)
                yield part, np.asarray(part.column("v").flatten(), np.float64).reshape(part.num_rows, -1)


def _grouped(rows: DataFrame, check, schema: str) -> DataFrame:
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_by_group(check), schema)


def _blocks(rows: DataFrame, hot: DataFrame, most: int) -> DataFrame:
    """rows with own, i and j: buckets of over `most` rows are cut into parts, each row goes to each pair with its own."""
    if hot.isEmpty():
        return rows.select("*", F.lit(0).alias("own"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    rows = rows.join(hot, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("cid"), "parts").cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other", "parts")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, miss: float = 1e-3, most: int = 4096, wide: int = 16_384, bucket: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component) for each row of vectors."""
    # Vectors of floats travel as such; they are compared in doubles.
    element = "float" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    kind = "<f4" if element == "float" else "<f8"
    read = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    marked = read.withColumn("fine", fine)
    keyed = common.stored(marked.select("id", "fine", F.when(F.col("fine"), F.struct(F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"))).alias("key")), "vectors")
    grouped = marked.where("fine").groupBy(F.struct(F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")).alias("key")).agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("least"))
    classes = common.stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    hashing, sketching = Hashing(classes.count(), threshold, miss, bucket), Sketching(threshold)

    def buckets(sig: np.ndarray) -> np.ndarray:
        return (sig + np.arange(hashing.tables, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).ravel().view(np.int64)  # Fixed value: an odd step.

    def names(batches):
        for _, x in _of_size(batches):
            yield pa.RecordBatch.from_arrays([pa.array(buckets(hashing.signatures(_units(x))))], ["bucket"])

    def sketched(batches):
        for part, x in _of_size(batches):
            unit = _units(x)
            short, again = sketching(unit).view(np.int64), np.repeat(np.arange(len(x)), hashing.tables)
            columns = [buckets(hashing.signatures(unit)), np.asarray(part.column("cid"))[again], np.full(len(again), x.shape[1], np.int32), *(short[again, k] for k in range(4))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "cid", "d", "s0", "s1", "s2", "s3"])

    def together(batches):
        for part, x in _of_size(batches):
            yield pa.RecordBatch.from_arrays([part.column("root"), part.column("cid"), part.column("n"), pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())], ["bucket", "cid", "n", "vec"])

    # Which buckets are large is read from all buckets' counts; Spark broadcasts the few only if they are small.
    cut = lambda counts, rows: common.stored(counts.where(F.col("rows") > rows).select("bucket", F.ceil(F.col("rows") / rows).cast("int").alias("parts")), "parts")
    hot = cut(classes.select("v").mapInArrow(names, "bucket long").groupBy("bucket").agg(F.count("*").alias("rows")), wide)
    met = _blocks(classes.select("v", "cid").mapInArrow(sketched, "bucket long, cid long, d int, s0 long, s1 long, s2 long, s3 long"), hot, wide)
    near = common.components(_grouped(met, _candidates(sketching), "a long, b long"))
    large = cut(near.groupBy(F.col("root").alias("bucket")).agg((F.count("*") + 1).alias("rows")), most)
    members = near.select(F.col("node").alias("cid"), "root").union(near.select("root", "root").distinct())
    rows = classes.select("v", "n", "cid").join(members, "cid").mapInArrow(together, ROW)
    found = common.stored(_grouped(_blocks(rows, large, most), _check(threshold, kind), "counted boolean, a long, b long"), "vector-links")
    counts = found.where("counted").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    # What was brought together whole is linked whole, too: a forest's links lead to one class of each component.
    links = found.where("not counted").select("a", "b")
    roots = (links.toDF("node", "root") if large.isEmpty() else common.components(links)).withColumnRenamed("node", "cid")
    joined = classes.select("key", "cid", "n", "least").join(counts, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    result = joined.join(least, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component")
    alone = keyed.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return keyed.where("fine").join(result, "key").select("id", "n_links", "component").unionByName(alone)


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
