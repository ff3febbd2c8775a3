"""An inverted file of vectors: cells around fitted centres, written once, searched by cosine as often as needed.

A folder holds `centres` (cell, centre, radius, first, parts, rows) and `vectors` (part, id, v), written in order of part. Centres are fitted by
k-means on a bounded sample of unit vectors; every vector is dealt to its nearest centre. A cell of over `rows` vectors has
several parts, chosen by a hash of the id, so no task holds more than about that many.

A search sends a question to the cells that are nearest to it (`probes` of them), or, without `probes`, to every cell
that may hold something as near as the k-th it has found in its own: bounds from the cells' radii and from the planes
halfway between centres leave no answer out, so the result is exact. All that a cell holds is compared exactly.

Parts that follow each other form groups (16, or more so that one holds about 32,768 vectors), and a question is sent once to each
group in which it asks parts, with their names. So where bounds exclude nothing, what is sent doesn't grow with the cells.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators import cells
from ..operators.similarity import TINY
from ..storage import stored


#: To so many tasks a group's questions are dealt.
_SHARES = 4


def _units(batch: pa.RecordBatch, column: str = "v") -> np.ndarray:
    x = np.asarray(batch.column(column).flatten(), np.float64).reshape(batch.num_rows, -1)
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + TINY)


def _floats(df: DataFrame, column: str) -> str:
    """Floats are kept and sent as floats, all else as doubles."""
    return "array<float>" if df.schema[column].dataType.simpleString() == "array<float>" else "array<double>"


def build(vectors: DataFrame, path: str, cell_rows: int | None = None, rows: int = 65_536) -> None:
    """Writes the index of vectors(id, embedding). About sqrt(n) cells, unless cell_rows says how many vectors one should hold.

    Vectors have one size; null, zero and non-finite ones are left out, as nothing is similar to them.
    """
    spark, kind, floats = vectors.sparkSession, vectors.schema["id"].dataType.simpleString(), _floats(vectors, "embedding")
    own = stored(vectors.select("id", F.col("embedding").cast(floats).alias("v")).where(cells.usable(F.col("v"))), "vectors")
    total = own.count()
    size = own.select(F.size("v")).first()[0] if total else 1
    wanted = max(1, round(total / cell_rows) if cell_rows else min(4096, math.isqrt(total)))
    drawn = cells.sample(own, total, size) if total else np.ones((1, 1))
    centre = cells.fit(drawn / (np.linalg.norm(drawn, axis=1, keepdims=True) + TINY), wanted)

    def dealt(batches):
        for batch in batches:
            if batch.num_rows:
                cell, far = cells.nearest(_units(batch), centre)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], ["id", "v", "cell", "far"])

    placed = stored(own.mapInArrow(dealt, f"id {kind}, v {floats}, cell int, far double"), "placed")
    held = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    listed, first = [], 0
    for k, c in enumerate(centre):
        n, far = held.get(k, (0, 0.0))
        parts = math.ceil(n / rows)
        listed.append((k, c.tolist(), far, first, parts, n))
        first += parts
    centres = spark.createDataFrame(listed, "cell int, centre array<double>, radius double, first int, parts int, rows long").coalesce(1)
    centres.write.mode("overwrite").parquet(f"{path}/centres")
    # The cells' numbers: a row a cell, as many as centres.
    numbered = placed.join(centres.select("cell", "first", "parts"), "cell").select((F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("part"), "id", "v")
    # Files hold ranges of parts in order, so a search for some parts skips files and row groups by their statistics.
    numbered.repartitionByRange("part").sortWithinPartitions("part").write.mode("overwrite").parquet(f"{path}/vectors")


class Layout:
    """The cells of an index: a centre, a radius (less than 0: nothing is in it) and the parts of each; groups of parts."""

    def __init__(self, held: list, groups: int = 16, rows: int = 32_768):
        self.centre = np.array([r["centre"] for r in held])
        self.radius = np.array([r["radius"] if r["parts"] else -np.inf for r in held])
        #: By part: its cell, and its group; by group: its first part, and the end.
        self.cell = np.repeat(np.arange(len(held)), [r["parts"] for r in held])
        sizes = np.array([r["rows"] / r["parts"] for r in held for _ in range(r["parts"])])
        total = max(1, sum(r["rows"] for r in held))
        wanted = max(groups, math.ceil(total / rows))
        self.group = np.unique(((np.cumsum(sizes) - sizes / 2) * wanted / total).astype(np.int64), return_inverse=True)[1]
        self.edges = np.flatnonzero(np.diff(self.group, prepend=-1, append=self.group[-1:] + 1)).tolist()

    def _distances(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q**2).sum(1)[:, None] - 2 * q @ self.centre.T + (self.centre**2).sum(1), 0))

    def near(self, q: np.ndarray, probes: int) -> np.ndarray:
        """Which cells are the first `probes` of those that hold anything."""
        far = np.where(self.radius >= 0, self._distances(q), np.inf)
        marked = np.zeros(far.shape, bool)
        np.put_along_axis(marked, np.argsort(far, 1, kind="stable")[:, :probes], True, 1)
        return marked

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """No vector of a cell is nearer than this (a little less, for rounding)."""
        to = self._distances(q)
        home = to.argmin(1)
        between = np.sqrt(((self.centre[home][:, None] - self.centre[None]) ** 2).sum(2))
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > 0, (to**2 - to[np.arange(len(q)), home][:, None] ** 2) / (2 * between), 0)
        return np.maximum(np.maximum(to - self.radius, plane), 0) - 1e-6

    def _marked(self, batches, pick):
        """Pieces of questions(id, v, within), and which parts each asks: those of the cells that pick(units, within) marks."""
        for batch in batches if len(self.cell) else ():
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                yield piece, (pick(_units(piece), np.asarray(piece.column("within"))) & (self.radius >= 0)[None])[:, self.cell]

    def asked(self, pick):
        """The parts that a task's questions ask."""

        def run(batches):
            found = np.zeros(len(self.cell), bool)
            for _, marked in self._marked(batches, pick):
                found |= marked.any(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found), pa.int32())], ["part"])

        return run

    def sent(self, pick):
        """Rows (grp, asks, id, v) of questions: once to each group in which they ask something; asks has a bit for each of its parts."""

        def run(batches):
            for piece, marked in self._marked(batches, pick):
                for g, (a, b) in enumerate(zip(self.edges[:-1], self.edges[1:])):
                    row = np.flatnonzero(marked[:, a:b].any(1))
                    if len(row):
                        rows, bits = piece.take(pa.array(row)), np.packbits(marked[row, a:b], axis=1)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), g), pa.int32()), pa.array([x.tobytes() for x in bits], pa.binary()), rows.column("id"), rows.column("v")], ["grp", "asks", "id", "v"])

        return run

    def grouped(self, batches):
        """Rows (grp, part, id, v) of vectors(part, id, v)."""
        for batch in batches:
            grp = self.group[np.asarray(batch.column("part"))] if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grp, pa.int32()), *(batch.column(c) for c in ("part", "id", "v"))], ["grp", "part", "id", "v"])


class _Group:
    """What a task holds of a group's vectors, in order of part."""

    def __init__(self, held: list[pa.RecordBatch], first: int, end: int):
        part = np.concatenate([np.asarray(h.column("part")) for h in held])
        order = np.argsort(part, kind="stable")
        self.ids = pa.concat_arrays([h.column("id") for h in held]).take(pa.array(order))
        self.x = np.concatenate([_units(h) for h in held])[order]
        self.count = np.bincount(part - first, minlength=end - first)
        self.starts = np.cumsum(self.count) - self.count
        self.place = {i: n for n, i in enumerate(self.ids.to_pylist())}
        self.rank = np.argsort(np.asarray(pc.sort_indices(self.ids)))

    def best(self, asked: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Question's row, vector's place and score of the k best that each question finds in the parts it asks; ties to the smaller id."""
        bits = np.frombuffer(b"".join(asked.column("asks").to_pylist()), np.uint8).reshape(asked.num_rows, -1)
        bits = np.unpackbits(bits, axis=1, count=len(self.count)).astype(bool)
        parts = np.flatnonzero(bits.any(0) & (self.count > 0))
        if not len(parts):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        column = np.concatenate([np.arange(self.starts[p], self.starts[p] + self.count[p]) for p in parts])
        q = _units(asked)
        score = q @ self.x[column].T
        if not bits[:, parts].all():
            score[~np.repeat(bits[:, parts], self.count[parts], axis=1)] = -np.inf
        at = np.full(len(self.x), -1)
        at[column] = np.arange(len(column))
        for r, i in enumerate(asked.column("id").to_pylist()):
            if i in self.place and at[self.place[i]] >= 0:
                score[r, at[self.place[i]]] = -np.inf
        m = len(column) - min(k, len(column))
        row, near = np.nonzero((score >= np.partition(score, m, axis=1)[:, m, None] - 1e-12) & (score > -np.inf))
        near = column[near]
        # Products of matrices may differ in the last bit between equal vectors; these don't.
        exact = np.concatenate([(q[row[a : a + 50_000]] * self.x[near[a : a + 50_000]]).sum(1) for a in range(0, len(row), 50_000)] or [np.empty(0)])
        order = np.lexsort((self.rank[near], -exact, row))
        row, near, exact = row[order], near[order], exact[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[first], near[first], exact[first]


class Index:
    """A written index; its layout, one row a cell, is known to the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.layout = Layout(spark.read.parquet(f"{path}/centres").orderBy("cell").collect())
        self.vectors = spark.read.parquet(f"{path}/vectors")
        self.kind = self.vectors.schema["id"].dataType.simpleString()

    def _answers(self, questions: DataFrame, pick, k: int) -> DataFrame:
        """(q, id, score): the k most similar of each part that a question is sent to."""
        layout = self.layout
        floats = "array<float>" if _floats(self.vectors, "v") == _floats(questions, "v") == "array<float>" else "array<double>"
        questions = questions.withColumn("v", F.col("v").cast(floats))
        # Only the parts that are asked are read: their files and row groups hold ranges of parts.
        wanted = sorted(r["part"] for r in questions.mapInArrow(layout.asked(pick), "part int").distinct().collect())
        vectors = self.vectors.where(F.col("part").isin(wanted)) if 2 * len(wanted) < len(layout.cell) else self.vectors
        # A group's questions are dealt to some tasks, each of which is sent the group.
        share = F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))).alias("share")
        held = vectors.select("part", "id", F.col("v").cast(floats).alias("v")).mapInArrow(layout.grouped, f"grp int, part int, id {self.kind}, v {floats}")
        asked = questions.mapInArrow(layout.sent(pick), f"grp int, asks binary, id {self.kind}, v {floats}")
        rows = held.select("grp", share, F.lit(None).cast("binary").alias("asks"), "part", "id", "v").unionByName(
            asked.select("grp", F.pmod(F.xxhash64("id"), F.lit(_SHARES)).cast("int").alias("share"), "asks", F.lit(None).cast("int").alias("part"), "id", "v")
        )
        names = pa.schema([("q", _arrow(self.vectors, "id")), ("id", _arrow(self.vectors, "id")), ("score", pa.float64())])

        def run(batches):
            key, held, group = None, [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.stack([np.asarray(batch.column("grp")), np.asarray(batch.column("share")), np.asarray(batch.column("asks").is_valid().cast(pa.int8()))], 1)
                edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
                for a, b in zip(edges, edges[1:]):
                    piece = batch.slice(a, b - a)
                    if (*keys[a, :2],) != key:
                        key, held, group = (*keys[a, :2],), [], None
                    if not keys[a, 2]:
                        held.append(piece)
                        continue
                    if group is None and held:
                        group, held = _Group(held, layout.edges[key[0]], layout.edges[key[0] + 1]), []
                    # About four million scores at a time.
                    step = max(16, min(256, 4_000_000 // len(group.x))) if group else piece.num_rows
                    for at in range(0, piece.num_rows if group else 0, step):
                        own = piece.slice(at, step)
                        row, near, score = group.best(own, k)
                        yield pa.RecordBatch.from_arrays([own.column("id").take(pa.array(row)), group.ids.take(pa.array(near)), pa.array(score)], schema=names)

        # Nulls come first: a group's vectors, then its questions, those that ask the same parts beside each other.
        return rows.repartition("grp", "share").sortWithinPartitions("grp", "share", "asks").mapInArrow(run, f"q {self.kind}, id {self.kind}, score double")

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None) -> DataFrame:
        """(q, id, score, rank): the k vectors most similar to each of queries(id, embedding), the question's own id aside; ties to the smaller id."""
        asked = queries.select("id", F.col("embedding").cast(_floats(queries, "embedding")).alias("v")).where(cells.usable(F.col("v")))
        asked = stored(asked.withColumn("within", F.lit(math.inf)), "questions")
        first = lambda rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
        layout = self.layout
        if probes is not None:
            return first(self._answers(asked, lambda q, _: layout.near(q, probes), k))
        others = lambda q, within: ~layout.near(q, 1) & (layout.bounds(q) <= within[:, None])
        own = stored(first(self._answers(asked, lambda q, _: layout.near(q, 1), k)).drop("rank"), "answers")
        # Of unit vectors, cosine s is distance sqrt(2 - 2 s).
        reach = own.groupBy("q").agg(F.when(F.count("*") >= k, F.sqrt(F.greatest(2 - 2 * F.min("score"), F.lit(0.0)))).otherwise(math.inf).alias("far"))
        again = asked.join(reach, asked["id"] == reach["q"], "left").select("id", "v", F.coalesce("far", F.lit(math.inf)).alias("within"))
        return first(own.unionByName(self._answers(again, others, k)))


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)
