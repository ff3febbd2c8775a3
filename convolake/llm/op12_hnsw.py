"""Approximate nearest neighbours: a navigable small-world graph with levels for each shard, and merged results.

Equal vectors are one class, with the k + 1 rows of it that come first; a class can't hold more of a query's answer. A
shard is a cell of classes around a centre (k-means over a bounded sample; every class is dealt to its nearest centre);
a cell with many more classes than a shard should hold is cut by a hash. Shards hold about 8 sqrt(n) classes, so their
number grows as sqrt(n) / 8.

A shard's graph is stored as flat arrays: a row a node with its vector, the 2M neighbours of level 0, and M for each
level above. Nodes stand in the order of a hash; the first n / M^l are on level l, which is a random draw. Levels are
built from the top, nodes are inserted in batches: each batch descends the levels above, walks its level with a list of
the best `build` nodes, and is linked both ways to neighbours that are nearer to it than to each other (free places go
to the nearest others). Walks of many queries go in step, so that a step is a few array operations.

A query first walks its own cell's shards. The k + 1 distances found there bound what it still needs: it is sent on to
the cells which could hold something nearer, by both the cell's radius around its centre and the plane halfway between
centres. These bounds are safe, so no recall is lost by them; only a graph's own walk can miss a neighbour. With vectors
that have no clusters at all nothing can be excluded and a query goes to every cell, so work then grows as n^1.5.
Shards that are asked by very many queries are read by several tasks, a slice of the queries each.

Vectors that are null, empty, zero, or hold null or non-finite components take no part. Vectors of different sizes are
never compared. Rows that repeat are rows of their own: a query's candidates are all rows but itself. Rows without an id
are candidates, after others at the same distance. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators import cells
from . import common

M = 16


def level_sizes(n: int, m: int = M) -> list[int]:
    """How many nodes are on each level, from level 0."""
    sizes = [n]
    while sizes[-1] // m > 1:
        sizes.append(sizes[-1] // m)
    return sizes


class Graph:
    """The links of some vectors, by level: row k has the neighbours of node k, -1 where there are fewer."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray] | None = None, build: int = 64, m: int = M):
        self.x, self.m, self.build, self.links = x, m, build, links or []
        #: Rows that go in step: their distances and marks stay within some tens of MB.
        self.step = max(8, min(256, 2**21 // (128 * x.shape[1]), 2**24 // max(len(x), 1)))
        if links is None:
            sizes = level_sizes(len(x), m)
            upper: list[np.ndarray] = []
            for level in range(len(sizes) - 1, -1, -1):
                upper.insert(0, self._level(sizes[level], sizes[level + 1] if level + 1 < len(sizes) else 0, 2 * m if level == 0 else m, upper))
            self.links = upper

    def _far(self, nodes: np.ndarray, q: np.ndarray) -> np.ndarray:
        apart = self.x[nodes] - q
        return np.einsum("...d,...d->...", apart, apart)

    def walk(self, links: np.ndarray, q: np.ndarray, start: np.ndarray, best: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """For each q the `best` nearest nodes that a walk from start meets, and their squared distances, nearest first."""
        b, n = len(q), len(links)
        seen = np.zeros(b * n, np.int32)
        ids, far, fresh = np.full((b, best), -1), np.full((b, best), np.inf), np.zeros((b, best), bool)
        rows, nodes = np.repeat(np.arange(b), start.shape[1]), start.ravel()
        while True:
            at = rows * n + nodes
            new = (nodes >= 0) & (seen[at] == 0)
            rows, nodes, at = rows[new], nodes[new], at[new]
            mark = np.arange(1, len(at) + 1, dtype=np.int32)
            seen[at] = mark
            once = seen[at] == mark
            rows, nodes = rows[once], nodes[once]
            d = self._far(nodes, q[rows])
            closer = d < far[rows, -1]
            rows, nodes, d = rows[closer], nodes[closer], d[closer]
            if len(rows):
                hit, first, of = np.unique(rows, return_index=True, return_inverse=True)
                place = np.arange(len(rows)) - first[of]
                more, who = np.full((len(hit), int(place.max()) + 1), np.inf), np.full((len(hit), int(place.max()) + 1), -1)
                more[of, place], who[of, place] = d, nodes
                both = np.concatenate([far[hit], more], 1)
                order = np.argsort(both, 1, kind="stable")[:, :best]
                far[hit] = np.take_along_axis(both, order, 1)
                ids[hit] = np.take_along_axis(np.concatenate([ids[hit], who], 1), order, 1)
                fresh[hit] = np.take_along_axis(np.concatenate([fresh[hit], who >= 0], 1), order, 1)
            next_ = fresh & (np.cumsum(fresh, 1) <= wide)
            if not next_.any():
                return ids, far
            fresh &= ~next_
            r, c = np.nonzero(next_)
            found = links[ids[r, c]]
            rows, nodes = np.repeat(r, found.shape[1]), found.ravel()

    def _choose(self, ids: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
        """Of nodes sorted by distance those nearer than to any that was chosen before, then the nearest others; at most `most`."""
        x = self.x[ids]
        length = np.einsum("bcd,bcd->bc", x, x)
        pair = length[:, :, None] + length[:, None, :] - 2 * x @ x.transpose(0, 2, 1)
        valid, taken, count = far < np.inf, np.zeros(ids.shape, bool), np.zeros(len(ids), int)
        for c in range(ids.shape[1]):
            fine = valid[:, c] & (count < most) & ~(taken & (pair[:, c] < far[:, c, None])).any(1)
            taken[:, c] = fine
            count += fine
        order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), 1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)

    def _nearest_of(self, center: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """ids (-1: none) by distance from their row's centre, the `most` nearest."""
        far = np.where(ids >= 0, self._far(ids, center[:, None]), np.inf)
        order = np.argsort(far, 1, kind="stable")[:, :most]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)

    def _level(self, n: int, above: int, degree: int, upper: list[np.ndarray]) -> np.ndarray:
        links, count = np.full((n, degree + degree // 2), -1, np.int32), np.zeros(n, int)

        def prune(nodes: np.ndarray, more: np.ndarray | None = None) -> None:
            for at in range(0, len(nodes), self.step):
                part = nodes[at : at + self.step]
                held = links[part] if more is None else np.concatenate([links[part], more[at : at + self.step]], 1)
                chosen = self._choose(*self._nearest_of(self.x[part], held, 2 * degree), degree)
                links[part] = -1
                links[part, : chosen.shape[1]] = chosen
                count[part] = (chosen >= 0).sum(1)

        at = min(n, degree + 1)
        everyone = np.tile(np.arange(at), (at, 1))
        for row in range(at):
            links[row, : at - 1] = np.delete(everyone[row], row)
        count[:at] = at - 1
        while at < n:
            end = min(n, at + min(self.step, at), above if at < above else n)
            new = np.arange(at, end)
            q = self.x[new]
            start = self.descend(q, upper) if at >= above and upper else np.zeros((len(new), 1), int)
            ids, far = self.walk(links[:at], q, start, self.build)
            among = np.where(np.eye(len(new), dtype=bool), -1, new[None])
            ids, far = (np.concatenate(x, 1) for x in zip((ids, far), self._nearest_of(q, among, self.m)))
            order = np.argsort(far, 1, kind="stable")[:, : self.build]
            chosen = self._choose(np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1), degree // 2)
            links[new, : chosen.shape[1]] = chosen
            count[new] = (chosen >= 0).sum(1)
            src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            known = (links[dst] == src[:, None]).any(1)
            order = np.argsort(dst[~known], kind="stable")
            src, dst = src[~known][order], dst[~known][order]
            whom, first, of = np.unique(dst, return_index=True, return_inverse=True)
            place = count[dst] + np.arange(len(dst)) - first[of]
            fits = place < links.shape[1]
            links[dst[fits], place[fits]] = src[fits]
            np.add.at(count, dst[fits], 1)
            if not fits.all():
                over, first, of = np.unique(dst[~fits], return_index=True, return_inverse=True)
                column = np.arange(len(of)) - first[of]
                more = np.full((len(over), int(column.max()) + 1), -1)
                more[of, column] = src[~fits]
                prune(over, more)
            at = end
        prune(np.flatnonzero(count > degree))
        return links[:, :degree].copy()

    def descend(self, q: np.ndarray, upper: list[np.ndarray]) -> np.ndarray:
        start = np.zeros((len(q), 1), int)
        for links in reversed(upper):
            start = self.walk(links, q, start, 2)[0]
        return start

    def search(self, q: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of the `best` nearest that are found, -1 and infinity where there are fewer."""
        out = [self.walk(self.links[0], p := q[at : at + self.step], self.descend(p, self.links[1:]), best)[0] for at in range(0, len(q), self.step)]
        ids = np.concatenate(out)
        return ids, np.where(ids >= 0, np.sqrt(self._far(ids, q[:, None])), np.inf)

    def stored(self) -> tuple[list[bytes], list[bytes]]:
        """The neighbours of each node on level 0, and on the levels above that it is on."""
        return [r.tobytes() for r in self.links[0]], [b"".join(links[k].tobytes() for links in self.links[1:] if k < len(links)) for k in range(len(self.links[0]))]

    @classmethod
    def loaded(cls, x: np.ndarray, flat: list[bytes], upper: list[bytes], m: int = M) -> Graph:
        sizes = level_sizes(len(x), m)
        links = [np.frombuffer(b"".join(flat), np.int32).reshape(len(x), -1)]
        links += [np.frombuffer(b"".join(u[4 * m * (level - 1) : 4 * m * level] for u in upper[:n]), np.int32).reshape(n, m) for level, n in enumerate(sizes) if level]
        return cls(x, links, m=m)


def shard_size(n: int, size: int) -> int:
    """About 8 sqrt(n) classes, 1,024 at least and 64 MB of vectors at most."""
    return max(16, min(max(1024, math.ceil(8 * math.sqrt(n))), 64_000_000 // (8 * size)))


class Routing:
    """Centres by vector size, and which shards a cell has; small enough for the driver: sqrt(n) / 8 cells."""

    def __init__(self, centres: dict[int, np.ndarray], seed: int = 12):
        self.centres, self.seed = centres, seed
        self.first: dict[tuple[int, int], tuple[int, int]] = {}
        self.radius = {size: np.full(len(c), -np.inf) for size, c in centres.items()}
        self.shards = 0

    def add(self, size: int, cell: int, count: int, radius: float) -> None:
        parts = max(1, math.ceil(count / (2 * shard_size(count, size))))
        self.first[size, cell] = self.shards, parts
        self.radius[size][cell] = radius
        self.shards += parts

    def bounds(self, q: np.ndarray, home: np.ndarray) -> np.ndarray:
        """No vector of a cell is nearer to q than this; infinite for cells without any."""
        c = self.centres[q.shape[1]]
        to = np.sqrt(((q[:, None] - c[None]) ** 2).sum(2))
        between = np.sqrt(((c[home][:, None] - c[None]) ** 2).sum(2))
        own = to[np.arange(len(q)), home][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > 0, (to**2 - own**2) / (2 * between), 0)
        # A little slack for rounding: excluding less is always right.
        return np.maximum(np.maximum(to - self.radius[q.shape[1]], plane), 0) * (1 - 1e-9) - 1e-12


def _by_size(batch: pa.RecordBatch, step: int = 2048):
    """Parts of a batch whose vectors (column v) are of one size, and their vectors."""
    sizes = np.array([len(v) for v in batch.column("v")])
    for size in np.unique(sizes):
        of_size = batch.filter(pa.array(sizes == size))
        for at in range(0, of_size.num_rows, step):
            part = of_size.slice(at, step)
            yield part, np.asarray(part.column("v").flatten(), np.float64).reshape(part.num_rows, -1)


def _grouped(batches, key: str):
    """Rows of one key at a time (as tables of many small batches); rows come sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.asarray(batch.column(key))
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if held and held[-1].column(key)[0] != part.column(key)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def build(classes: DataFrame, shards: int, id_type: str) -> DataFrame:
    """The index: a row a node of (shard, node, cid, least, vec, links, upper), by the columns shard, cid, least, h, g and v."""

    def run(batches):
        for table in _grouped(batches, "shard"):
            x = np.asarray(table.column("v").combine_chunks().flatten(), np.float64).reshape(table.num_rows, -1)
            flat, upper = Graph(x).stored()
            node, shard = pa.array(np.arange(len(x), dtype=np.int64)), table.column("shard").combine_chunks()
            whole = pa.Table.from_arrays([shard, node, table.column("cid").combine_chunks(), table.column("least").combine_chunks(), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(flat, pa.binary()), pa.array(upper, pa.binary())], ["shard", "node", "cid", "least", "vec", "links", "upper"])
            yield from whole.to_batches(max_chunksize=2048)

    dealt = classes.select("shard", "h", "g", "cid", "least", "v").repartition(max(1, shards), "shard").sortWithinPartitions("shard", "h", "g")
    return dealt.mapInArrow(run, f"shard int, node long, cid long, least {id_type}, vec binary, links binary, upper binary")


def _answers(k: int, best: int, id_type: pa.DataType):
    """The k nearest (q, cid, least, score) of each question; a shard's nodes come before its questions."""

    def answer(graph: Graph, cid: np.ndarray, least: list, rank: np.ndarray, asked: pa.RecordBatch) -> pa.RecordBatch:
        q = _vectors(asked.column("vec"))
        ids, far = graph.search(q, min(best, len(cid)))
        order = np.lexsort((np.where(ids >= 0, rank[ids], len(cid)), far))[:, :k]
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        row, column = np.nonzero(ids >= 0)
        node = ids[row, column]
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(asked.column("cid"))[row]), pa.array(cid[node]), pa.array([least[i] for i in node], id_type), pa.array(far[row, column])], ["q", "cid", "least", "score"])

    def run(batches):
        nodes: list[pa.RecordBatch] = []
        graph, key = None, None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("shard", "slice", "asks")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)] if len(keys) else [0]
            for a, b in zip(edges, edges[1:]):
                part, own = batch.slice(a, b - a), tuple(keys[a, :2])
                if own != key:
                    nodes, graph, key = [], None, own
                if not keys[a, 2]:
                    nodes.append(part)
                    continue
                if graph is None:
                    table = pa.Table.from_batches(nodes)
                    cid, least = table.column("cid").to_numpy(), table.column("least").to_pylist()
                    rank = np.empty(len(cid), np.int64)
                    rank[sorted(range(len(cid)), key=lambda i: (least[i] is None, least[i] if least[i] is not None else 0, i))] = np.arange(len(cid))
                    graph = Graph.loaded(_vectors(table.column("vec")), table.column("links").to_pylist(), table.column("upper").to_pylist())
                    nodes = []
                for at in range(0, part.num_rows, 2048):
                    yield answer(graph, cid, least, rank, part.slice(at, 2048))

    return run


def search(index: DataFrame, asked: DataFrame, counts: dict[int, int], k: int, best: int, id_col_type, most: int = 20_000) -> DataFrame:
    """(q, cid, least, score): the k nearest classes that each question (shard, cid, vec) finds in its shard.

    Of shards that get more than `most` questions (counts), each slice of the questions reads the nodes anew.
    """
    name = id_col_type.simpleString()
    many = {s: math.ceil(n / most) for s, n in counts.items() if n > most}
    slices = lambda c: F.coalesce(F.create_map(*[F.lit(x) for pair in many.items() for x in pair])[c], F.lit(1)) if many else F.lit(1)
    used = index.where(F.col("shard").isin(sorted(counts))) if len(counts) < 1000 else index
    nodes = used.select("shard", F.explode(F.sequence(F.lit(0), slices(F.col("shard")) - 1)).alias("slice"), F.lit(0).alias("asks"), "node", "cid", "least", "vec", "links", "upper")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("least", name), ("links", "binary"), ("upper", "binary"))]
    asks = asked.select("shard", F.pmod(F.xxhash64("cid"), slices(F.col("shard"))).cast("int").alias("slice"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("node"), "cid", none[0], "vec", *none[1:])
    rows = nodes.unionByName(asks).repartition(max(1, len(counts)), "shard", "slice").sortWithinPartitions("shard", "slice", "asks", "node")
    return rows.mapInArrow(_answers(k, best, to_arrow_type(id_col_type)), f"q long, cid long, least {name}, score double")


def _first(rows: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group; the planner drops what can't be among them before rows are sent."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, k: int = 10, every: int = 100, best: int = 128, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score) of each row whose id is divisible by `every`: its k nearest other rows that are found."""
    kind = vectors.schema[id_col].dataType
    read = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(cells.usable(F.col("v")))
    # -0.0 and 0.0 are one value.
    read = read.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = common.stored(read.select("id", F.monotonically_increasing_id().alias("row"), F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"), "v"), "vector-rows")
    sizes = {r["size"]: r["n"] for r in rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    centres = {}
    for size, n in sorted(sizes.items()):
        wanted = math.ceil(n / shard_size(n, size))
        x = cells.sample(rows, n, size) if wanted > 1 else None
        centres[size] = cells.fit(x, wanted) if x is not None and len(x) else np.zeros((1, size))
    routing = Routing(centres)

    def assigned(batches):
        for batch in batches:
            for part, x in _by_size(batch):
                cell, far = cells.nearest(x, centres[x.shape[1]])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(far)], [*part.schema.names, "cell", "far"])

    one = Window.partitionBy("h", "g").orderBy(F.col("id").asc_nulls_last(), "row")
    members = rows.withColumn("place", F.row_number().over(one)).where(F.col("place") <= k + 1)
    classes = members.groupBy("h", "g").agg(F.first("v").alias("v"), F.array_sort(F.collect_list(F.struct("place", "id", "row"))).alias("members"))
    classes = classes.select("h", "g", F.monotonically_increasing_id().alias("cid"), F.col("members")[0]["id"].alias("least"), "members", "v")
    member = f"array<struct<place:int,id:{kind.simpleString()},row:bigint>>"
    classes = common.stored(classes.mapInArrow(assigned, f"h long, g long, cid long, least {kind.simpleString()}, members {member}, v array<double>, cell int, far double"), "vector-classes")
    for r in classes.groupBy(F.size("v").alias("size"), "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).orderBy("size", "cell").collect():
        routing.add(r["size"], r["cell"], r["n"], r["far"])
    spark = vectors.sparkSession
    placed = spark.createDataFrame([(s, c, *at) for (s, c), at in routing.first.items()], "size int, cell int, first int, parts int")
    sharded = classes.join(placed, (F.size("v") == F.col("size")) & (classes.cell == placed.cell)).withColumn("shard", (F.col("first") + F.pmod("g", "parts")).cast("int"))
    index = common.stored(build(sharded, routing.shards, kind.simpleString()), "graph-index")

    asking = rows.where(F.col("id") % every == 0).select("id", "row", "h", "g")
    questions = classes.join(asking.select("h", "g").distinct(), ["h", "g"]).select("cid", "v", "cell", F.lit(float("inf")).alias("within"))

    def sent(home: bool, with_vectors: bool):
        """Which shards a question goes to: its own cell's, or the others that may hold something near enough."""

        def run(batches):
            for batch in batches:
                for part, q in _by_size(batch, 256):
                    own, within = np.asarray(part.column("cell")).astype(int), np.asarray(part.column("within"))
                    c = len(centres[q.shape[1]])
                    is_home = np.arange(c)[None] == own[:, None]
                    row, cell = np.nonzero(is_home if home else ~is_home & (routing.bounds(q, own) <= within[:, None]))
                    there = [routing.first.get((q.shape[1], int(x)), (0, 0)) for x in cell]
                    shard = np.array([s for first, parts in there for s in range(first, first + parts)], np.int32)
                    row = np.repeat(row, [parts for _, parts in there])
                    columns = [pa.array(shard)]
                    if with_vectors:
                        packed = [v.tobytes() for v in q]
                        columns += [pa.array(np.asarray(part.column("cid"))[row]), pa.array([packed[r] for r in row], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "cid", "vec"][: len(columns)])

        return run

    def ask(questions: DataFrame, home: bool) -> DataFrame:
        narrow = questions.select("cid", "v", "cell", "within")
        counts = {r["shard"]: r["n"] for r in narrow.mapInArrow(sent(home, False), "shard int").groupBy("shard").agg(F.count("*").alias("n")).collect()}
        return search(index, narrow.mapInArrow(sent(home, True), "shard int, cid long, vec binary"), counts, k + 1, best, kind)

    near = [F.col("score"), F.col("least").asc_nulls_last(), F.col("cid")]
    at_home = common.stored(_first(ask(questions, True), "q", near, k + 1).drop("rank"), "home-answers")
    reach = at_home.groupBy("q").agg(F.when(F.count("*") > k, F.max("score")).otherwise(F.lit(float("inf"))).alias("found"))
    questions = common.stored(questions.join(reach, F.col("cid") == F.col("q")).select("cid", "v", "cell", F.col("found").alias("within")), "questions")
    both = _first(at_home.unionByName(ask(questions, False)), "q", near, k + 1)
    listed = both.select("q", "cid", "score").join(classes.select("cid", "members"), "cid").select("q", "score", F.explode("members").alias("m")).select("q", "score", "m.id", "m.row")
    listed = _first(listed, "q", [F.col("score"), F.col("id").asc_nulls_last(), F.col("row")], k + 1)
    lists = listed.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id", "row"))).alias("found"))
    lists = lists.join(classes.select(F.col("cid").alias("q"), "h", "g"), "q")
    others = F.slice(F.filter("found", lambda x: x["row"] != F.col("own")), 1, k)
    own = asking.select(F.col("id").alias("query_id"), F.col("row").alias("own"), "h", "g").join(lists, ["h", "g"])
    return own.select("query_id", F.posexplode(others).alias("at", "f")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias("id"), F.col("f.score").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(common.table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
