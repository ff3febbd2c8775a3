"""SimHash near-duplicates found with vantage-point trees over Hamming distance.

Words are runs of non-white-space after lower-casing A-Z; shingles are three words (fewer words: all of them; none:
fingerprint zero). A bit of the fingerprint is set if it is set in over half of the shingles' XXH64 (seed 42).
Fingerprints at most `radius` bits apart link; a component is what links connect.

Plan: fingerprints are counted down to distinct ones; a vantage-point tree over a bounded sample deals them to shards
(a fingerprint lives in one shard and also visits those that its ball of `radius` overlaps by the triangle bounds); in
each shard a second tree finds the exact pairs. A shard sends a spanning forest of its links, never its pairs. Shards
with too many residents are split into blocks that all its visitors see.

Null and empty texts have fingerprint zero and link with each other. Rows that repeat give repeated rows. Null ids keep
their row; a component's id is its smallest non-null id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
#: For each byte value, its eight bits as eight counters of one byte.
LANES = np.array([sum((v >> i & 1) << 8 * i for i in range(8)) for v in range(256)], np.uint64)


def _hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    whole, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= 3:
        return [h(whole, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-3].tolist()]
    return [h(whole[a:b], SEED) for a, b in zip(starts, (ends[2:] - 1).tolist())]


def _bit_counts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """How many hashes of each run (from firsts[i] on, none empty) have each of the 64 bits."""
    # Counters of one byte hold runs of up to 255, so longer runs are summed in parts.
    ends = np.append(firsts[1:], len(hashes))
    cuts = np.concatenate([np.arange(a, b, 255) for a, b in zip(firsts, ends)])
    of = np.repeat(np.arange(len(firsts)), -(-(ends - firsts) // 255))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.zeros((len(firsts), 64), np.int64)
    run = np.searchsorted(of, np.arange(len(firsts)))
    for k in range(8):
        lanes = np.add.reduceat(LANES[octets[:, k]], cuts)
        part = lanes.view(np.uint8).reshape(-1, 8)
        counts[:, 8 * k : 8 * k + 8] = np.add.reduceat(part, run, axis=0, dtype=np.int64)
    return counts


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts in UTF-8."""
    each = [_hashes(t) for t in texts]
    sizes = np.array([len(x) for x in each], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.array([y for x in each for y in x], "<u8")
        firsts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        bits = _bit_counts(flat, firsts) * 2 > sizes[full, None]
        out[full] = (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return out


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp holds the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints(texts).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


# -- vantage-point trees --


def _split(points: np.ndarray, vantage: np.uint64, radius: int) -> tuple[float, int] | None:
    """(cost, cut): distances up to the cut go inside. The cost is how much visits grow for each bit of splitting."""
    met = np.bincount(np.bitwise_count(points ^ vantage), minlength=65)
    inside, n = np.cumsum(met)[:-1], len(points)
    # Points within the radius of the cut visit both sides.
    both = np.append(np.cumsum(met), [n] * radius)[radius : radius + 64] - np.append([0] * radius, np.cumsum(met))[:64]
    usable = np.flatnonzero((inside >= 0.3 * n) & (inside <= 0.7 * n))
    if not len(usable):
        usable = np.flatnonzero((inside > 0) & (inside < n))
    if not len(usable):
        return None
    p = inside[usable] / n
    cost = np.log2(1 + both[usable] / n) / -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
    k = int(cost.argmin())
    return float(cost[k]), int(usable[k])


def build_tree(sample: np.ndarray, leaves: int, radius: int = 2, seed: int = 1, tries: int = 12) -> list:
    """Nested [vantage point, cut, inside, outside], leaves numbered from 0 on; of some vantage points and of cuts near the median, that which fewest points cross."""
    rng, made = np.random.default_rng(seed), [0]

    def grow(points: np.ndarray, want: int):
        if want > 1 and len(points) >= 2:
            each = [(split, int(v)) for v in points[rng.integers(len(points), size=tries)] if (split := _split(points, v, radius))]
            if each:
                (_, cut), vantage = min(each)
                near = np.bitwise_count(points ^ np.uint64(vantage)) <= cut
                return [vantage, cut, grow(points[near], want // 2), grow(points[~near], want - want // 2)]
        made[0] += 1
        return made[0] - 1

    tree = grow(np.unique(sample), leaves)
    return [tree, made[0]]


def route(tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of a point, leaf, whether it lives there) for each leaf that a point's ball overlaps."""
    found = []

    def go(node, at: np.ndarray, home: np.ndarray):
        if not len(at):
            return
        if isinstance(node, int):
            found.append((at, np.full(len(at), node), home))
            return
        vantage, cut, inside, outside = node
        d = np.bitwise_count(points[at] ^ np.uint64(vantage)).astype(int)
        near, far = d - radius <= cut, d + radius > cut
        go(inside, at[near], (home & (d <= cut))[near])
        go(outside, at[far], (home & (d > cut))[far])

    go(tree, np.arange(len(points)), np.ones(len(points), bool))
    none = [(np.empty(0, int), np.empty(0, int), np.empty(0, bool))]
    return tuple(np.concatenate(x) for x in zip(*(found or none)))


def search_tree(residents: np.ndarray, visitors: np.ndarray, radius: int, found, leaf: int = 64, block: int = 1 << 20) -> None:
    """Calls found(i, j) with arrays of resident and visitor indices for all pairs within radius (also of equal ones)."""
    rng = np.random.default_rng(2)
    stack = [(np.arange(len(residents)), np.arange(len(visitors)))]
    while stack:
        own, ask = stack.pop()
        if not len(own) or not len(ask):
            continue
        if len(own) > leaf and len(own) * len(ask) > block >> 6:
            vantage = residents[own[rng.integers(len(own))]]
            d, e = np.bitwise_count(residents[own] ^ vantage).astype(int), np.bitwise_count(visitors[ask] ^ vantage).astype(int)
            cut = int(np.median(d))
            cut = cut if (d > cut).any() else cut - 1
            near, far = e - radius <= cut, e + radius > cut
            # A split that nearly all visitors cross saves nothing.
            if (d <= cut).any() and near.sum() * (d <= cut).sum() + far.sum() * (d > cut).sum() < 0.95 * len(own) * len(ask):
                stack += [(own[d <= cut], ask[near]), (own[d > cut], ask[far])]
                continue
        step = max(1, block // len(ask))
        for k in range(0, len(own), step):
            i, j = np.nonzero(np.bitwise_count(residents[own[k : k + step], None] ^ visitors[None, ask]) <= radius)
            if len(i):
                found(own[k + i], ask[j])


def _linked(own: np.ndarray, ask: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between a shard's residents and its visitors, as pairs of fingerprints."""
    nodes = np.unique(np.concatenate([own, ask]))
    forest, x, y = common.Forest(len(nodes)), np.searchsorted(nodes, own), np.searchsorted(nodes, ask)

    def found(i, j):
        keep = x[i] != y[j]
        forest.add(x[i][keep], y[j][keep])

    search_tree(own, ask, radius, found)
    a, b = forest.links()
    return nodes[a], nodes[b]


def fingerprint_components(fps: DataFrame, radius: int = 2, shard_rows: int = 32_768, sample_rows: int = 262_144) -> DataFrame:
    """(fp, root) for distinct fingerprints (column fp) that aren't the smallest (signed) of their component."""
    spark, n = fps.sparkSession, fps.count()
    shards = min(max(1, -(-n // shard_rows)), sample_rows // 16)
    # About sample_rows of them, picked by a hash, so that tasks send the driver no more than that in all.
    drawn = fps.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(max(1, -(-n // sample_rows)))) == 0).select("fp")
    sample = drawn.toArrow()["fp"].to_numpy() if shards > 1 else np.empty(0, np.int64)
    tree, _ = build_tree(sample.view(np.uint64), shards, radius)

    def deal(batches):
        for batch in batches:
            fp = np.asarray(batch.column(0)).astype(np.int64)
            at, leaf, home = route(tree, fp.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(home), pa.array(fp[at])], ["leaf", "home", "fp"])

    # Shards with many residents or visitors are split into blocks: each pair of blocks is a task of its own.
    dealt = common.stored(fps.select("fp").mapInArrow(deal, "leaf int, home boolean, fp long"), "dealt")
    sizes = dealt.groupBy("leaf").agg(F.count_if("home").alias("own"), F.count("*").alias("ask"))
    wide = common.stored(sizes.select("leaf", *[F.greatest(F.lit(1), F.ceil(F.col(k) / F.lit(2 * shard_rows)).cast("int")).alias(f"{k}_parts") for k in ("own", "ask")]).where("own_parts > 1 or ask_parts > 1"), "wide-leaves")
    if wide.isEmpty():
        cut = dealt.withColumns({"own_parts": F.lit(1), "ask_parts": F.lit(1)})
    else:
        cut = dealt.join(wide, "leaf", "left").withColumns({f"{k}_parts": F.coalesce(f"{k}_parts", F.lit(1)) for k in ("own", "ask")})

    def block(kind: str):
        return F.pmod(F.xxhash64("fp"), F.col(f"{kind}_parts")).cast("int")

    def every(kind: str):
        return F.explode(F.sequence(F.lit(0), F.col(f"{kind}_parts") - 1))

    own = cut.where("home").select("leaf", block("own").alias("i"), every("ask").alias("j"), "home", "fp")
    ask = cut.select("leaf", every("own").alias("i"), block("ask").alias("j"), F.lit(False).alias("home"), "fp")

    def one(part: pa.Table) -> pa.Table:
        fp, home = part.column("fp").to_numpy(), part.column("home").to_numpy()
        a, b = _linked(fp[home].view(np.uint64), fp[~home].view(np.uint64), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    links = own.unionByName(ask).groupBy("leaf", "i", "j").applyInArrow(one, "a long, b long")
    return common.components(links).select(F.col("node").alias("fp"), "root")


def _grouped(docs: DataFrame, id_col: str, text_col: str, radius: int, **sizes) -> DataFrame:
    """(id, fp, root, component) for each row of docs; components whose smallest id is the same differ in root."""
    marked = common.stored(with_fingerprints(docs, id_col, text_col), "simhash")
    classes = common.stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    found = fingerprint_components(classes, radius, **sizes)
    rooted = classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return marked.join(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component"), "fp").select("id", "fp", "root", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, **sizes) -> DataFrame:
    """(id, fp, component) for each row of docs; see the module's text."""
    return _grouped(docs, id_col, text_col, radius, **sizes).select("id", "fp", "component")


def query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(common.table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 2) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest id stays.

    Where an id stands for texts in several components, each is judged by its own text; of rows with this id in one
    component one stays. Rows without an id can't be told apart and all stay.
    """
    groups = _grouped(docs.select("doc_id", "text"), "doc_id", "text", radius).where("id is not null")
    # Of an id's rows in one component those with the least fingerprint can stay; all this is narrow rows.
    each = common.stored(groups.groupBy("id", "root").agg(F.min("fp").alias("fp"), F.min("component").alias("component"), F.count("*").alias("rows")), "kept")
    by_id = each.groupBy("id").agg(F.sum("rows").alias("rows"), F.max(F.col("id") == F.col("component")).alias("stays"))
    key, row, fp = (_free(docs, x) for x in ("key", "row", "fp"))
    once = by_id.where("rows = 1 and stays").select(F.col("id").alias(key))
    kept = docs.join(once, F.col("doc_id") == F.col(key), "left_semi").unionByName(docs.where("doc_id is null"))
    many = common.stored(by_id.where("rows > 1").select(F.col("id").alias(key)), "repeated")
    if many.isEmpty():
        return kept

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints([(t or "").encode() for t in texts]).view(np.int64))

    # Rows of one id and fingerprint are brought down to one before they are sent.
    again = docs.join(many, F.col("doc_id") == F.col(key), "left_semi").withColumn(fp, fingerprint("text"))
    first = again.groupBy(F.col("doc_id").alias(key), fp).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64("text")).alias(row))
    stay = each.where("id = component").select("id", F.col("fp").alias("least"))
    return kept.unionByName(first.join(stay, (F.col(key) == F.col("id")) & (F.col(fp) == F.col("least")), "left_semi").select(f"{row}.*"))


def _free(df: DataFrame, name: str) -> str:
    """A name that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
