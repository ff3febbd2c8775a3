"""Benchmark decontamination: an FM-index per training shard, searched backwards for every benchmark window.

Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z. A window is 10 consecutive words of
an item (an item of fewer words is one window; one of none has none). A word of a document inside an occurrence of a
window is hit.

A shard is what one task holds of the documents, in parts of bounded size. Its alphabet is the benchmark's vocabulary:
a word outside of it can be in no occurrence and becomes a separator, and so do runs of vocabulary words shorter than
the shortest window. Nothing that could match is left out. The index is a Burrows-Wheeler transform in a wavelet tree of
bit ranks; suffix positions are sampled in text order. All windows are searched at once, located, and their spans merged.
At most `PIECE` words are indexed at once; a longer text is cut into pieces that overlap by a window less a word.

The benchmark is dealt to the tasks in groups of at most `group_bytes` (an item above alone). A part of the documents is
searched for one group after the other, and a task holds one group at a time; work grows with the number of groups, what
is held does not. Null texts have no words. Null item ids hit words but are not counted as items. Rows that repeat give
repeated rows; empty tables give empty or clean results; only the named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 10
#: Words that are indexed at once, and bytes of a text that are split at once.
PIECE, SPLIT = 2_000_000, 4_000_000
#: Upper case to lower case, and all other ASCII but digits and lower case to a space.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def word_ids(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words (0: unknown), and the number of words of each text."""
    parts, counts = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = at + SPLIT
            while end < len(text) and _KEEP[text[end]] != 32:
                end += 1
            found = words(text[at:end])
            parts.append(np.fromiter((vocabulary.get(x, 0) for x in found), np.int32, len(found)))
            counts[k] += len(found)
            at = end
    return np.concatenate(parts), counts


class Patterns:
    """The windows of a group of items: vocabulary, distinct windows as word ids from 1 on, and whose they are."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = sorted({i for i, _ in items if i is not None}, key=str)
        place = {i: k for k, i in enumerate(self.ids)}
        rows, owner = [np.zeros((0, WIDTH), np.int32)], [np.zeros(0, np.int64)]
        for item, text in items:
            w = np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)], np.int32)
            if len(w):
                short = np.concatenate([w, np.zeros(max(0, WIDTH - len(w)), np.int32)])
                rows.append(np.lib.stride_tricks.sliding_window_view(short, WIDTH))
                owner.append(np.full(len(rows[-1]), place.get(item, -1)))
        all_, owner = np.concatenate(rows), np.concatenate(owner)
        # Equal windows stand side by side once sorted, two ids as one number.
        keys = (all_[:, 0::2].astype(np.int64) << 32) | all_[:, 1::2]
        order = np.lexsort(keys.T[::-1])
        fresh = np.ones(len(order), bool)
        fresh[1:] = (keys[order][1:] != keys[order][:-1]).any(1)
        self.windows = all_[order[fresh]].astype(np.int64)
        self.lengths = (self.windows > 0).sum(1)
        pairs = np.unique(np.stack([np.cumsum(fresh) - 1, owner[order]], 1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        #: The items of window k are owners[ends[k - 1] : ends[k]].
        self.owners, self.ends = pairs[:, 1], np.cumsum(np.bincount(pairs[:, 0], minlength=len(self.windows)))

    def items(self, doc: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Distinct (document, item) of these documents and the windows that they hold."""
        met = np.unique(np.stack([doc, window], 1), axis=0)
        starts = np.concatenate([[0], self.ends])[met[:, 1]]
        many = self.ends[met[:, 1]] - starts
        of = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.unique(np.stack([np.repeat(met[:, 0], many), self.owners[of]], 1), axis=0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the sorted length; suffixes already told apart are not sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    head = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    length = 1
    while True:
        tied = np.flatnonzero(np.concatenate([~head[1:], [False]]) | ~head)
        if not len(tied):
            return order
        at = order[tied]
        after = at + length
        key = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        again = np.lexsort((key, start[tied]))
        order[tied] = at[again]
        key, group = key[again], start[tied]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        head[tied] = new
        start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[order] = start
        length *= 2


class Wavelet:
    """Ranks of symbols in a sequence: one bit vector a level, zeros before ones from level to level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for k in range(bits - 1, -1, -1):
            bit = (symbols >> k) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            self.levels.append((k, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol is before position at."""
        low = np.zeros_like(at)
        for k, ones, zeros in self.levels:
            bit = (symbol >> k) & 1
            o, p = ones[at], ones[low]
            at, low = np.where(bit, zeros + o, at - o), np.where(bit, zeros + p, low - p)
        return at - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions at, and their ranks there."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for k, ones, zeros in self.levels:
            bit = ones[at + 1] - ones[at]
            symbol |= bit.astype(np.int64) << k
            o, p = ones[at], ones[low]
            at, low = np.where(bit, zeros + o, at - o), np.where(bit, zeros + p, low - p)
        return symbol, at - low


class FMIndex:
    """Full-text index of word ids below `alphabet`. Inside, ids are one higher, and a single 0 ends the text."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = 8):
        text, alphabet = np.append(text + 1, 0), alphabet + 1
        order = suffix_array(text)
        last = text[order - 1]
        self.n, self.sample = len(text), sample
        self.tree = Wavelet(last, max(1, int(alphabet - 1).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.kept = order % sample == 0
        self.kept_before = np.concatenate([[0], np.cumsum(self.kept)])
        self.positions = order[self.kept]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index ranges of the suffixes that start with each pattern (a row, its length in lengths)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            on = np.flatnonzero((k < lengths) & (low < high))
            symbol = patterns[on, k] + 1
            low[on] = self.first[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.first[symbol] + self.tree.rank(symbol, high[on])
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of index places, walking back to sampled ones."""
        out, steps, open_ = np.empty(len(at), np.int64), np.zeros(len(at), np.int64), np.arange(len(at))
        at = at.copy()
        while len(open_):
            hit = self.kept[at[open_]]
            done = open_[hit]
            out[done] = self.positions[self.kept_before[at[done]]] + steps[done]
            open_ = open_[~hit]
            symbol, rank = self.tree.access(at[open_])
            at[open_] = self.first[symbol] + rank
            steps[open_] += 1
        return out


def search(ids: np.ndarray, doc: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ids, length, window) of each occurrence. ids: word ids of all documents of a shard; doc: whose."""
    none = (np.empty(0, np.int64),) * 3
    if not len(ids) or not len(patterns.lengths):
        return none
    # Runs of vocabulary words within one document, as long as the shortest window at least.
    edge = np.concatenate([[True], (doc[1:] != doc[:-1]) | ((ids[1:] == 0) != (ids[:-1] == 0))])
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(ids))
    long = (ids[starts] > 0) & (ends - starts >= patterns.lengths.min())
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return none
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, place = np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes) + within, np.repeat(starts, sizes) + within
    text = np.zeros(int(sizes.sum() + len(sizes)), np.int64)
    text[at] = ids[place]
    back = np.zeros(len(text), np.int64)
    back[at] = place
    places, windows = [], []
    for k in range(0, len(text), PIECE):
        index = FMIndex(text[k : k + PIECE + WIDTH - 1], len(patterns.vocabulary) + 1)
        low, high = index.ranges(patterns.windows, patterns.lengths)
        many = high - low
        windows.append(np.repeat(np.arange(len(many)), many))
        places.append(back[k + index.locate(np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum()))])
    window = np.concatenate(windows)
    return np.concatenate(places), patterns.lengths[window], window


def _grouped(benchmark: DataFrame, group_bytes: int) -> list:
    """The benchmark's rows in broadcasts of bounded size; the driver holds one group at a time."""
    spark, groups, held, size = benchmark.sparkSession, [], [], 0
    for item, text in benchmark.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        if held and size + len(text or b"") > group_bytes:
            groups, held, size = [*groups, spark.sparkContext.broadcast(held)], [], 0
        held.append((item, bytes(text or b"")))
        size += len(held[-1][1])
    return [*groups, spark.sparkContext.broadcast(held)]


def _shard(texts: list[bytes], groups: list, ready: Patterns | None) -> tuple[np.ndarray, list, list, list]:
    """For each text of a shard: its words, the starts and ends of its hit spans, and the items found."""
    hit, counts, items = None, None, [set() for _ in texts]
    for group in groups:
        patterns = ready or Patterns(group.value)
        if ready is None:
            # The worker drops the group that it has read, or all of them would stay in its memory.
            vars(group).pop("_value", None)
        ids, counts = word_ids(texts, patterns.vocabulary)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
        hit = np.zeros(len(ids) + 1, np.int32) if hit is None else hit
        at, length, window = search(ids, doc, patterns)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + length, -1)
        for d, i in patterns.items(doc[at], window).tolist():
            items[d].add(str(patterns.ids[i]))
    first = np.cumsum(counts) - counts
    on = np.cumsum(hit)[:-1] > 0
    fresh = np.zeros(len(on) + 1, bool)  # the first word of a document, and the end
    fresh[first[counts > 0]] = fresh[-1] = True
    before, after = np.concatenate([[False], on])[:-1], np.append(on, False)[1:]
    begins, ends = [[] for _ in texts], [[] for _ in texts]
    for k in np.flatnonzero(on & (~before | fresh[:-1])).tolist():
        begins[doc[k]].append(k - int(first[doc[k]]))
    for k in np.flatnonzero(on & (~after | fresh[1:])).tolist():
        ends[doc[k]].append(k + 1 - int(first[doc[k]]))
    return counts, begins, ends, [sorted(x) for x in items]


def _over_shards(docs: DataFrame, benchmark: DataFrame, finish, schema, group_bytes: int, text_col: str = "text") -> DataFrame:
    groups = _grouped(benchmark, group_bytes)

    def run(batches):
        ready = Patterns(groups[0].value) if len(groups) == 1 else None
        for batch in batches:
            for part, texts in common.slices(batch, text_col, 32_000_000):
                yield finish(part, texts, *_shard(texts, groups, ready))

    return docs.mapInArrow(run, schema)


def spans(docs: DataFrame, benchmark: DataFrame, group_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, starts, ends, items) for each row: the merged hit spans in words, and the items found, as strings."""

    def finish(part, texts, counts, begins, ends, items):
        place = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts), pa.array(begins, place), pa.array(ends, place), pa.array(items, pa.list_(pa.string()))], ["id", "n_words", "starts", "ends", "items"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, starts array<long>, ends array<long>, items array<string>"
    return _over_shards(read, benchmark, finish, schema, group_bytes)


def cut_words(text: bytes, begins: list[int], ends: list[int]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_KEEP))]
    out, at = [], 0
    for a, b in zip(begins, ends):
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, group_bytes: int = 4 << 20) -> DataFrame:
    """Pipeline stage: takes hit spans out of the texts (and sets n_chars, where there is one); other rows stay as they are.

    A text that is hit from end to end stays, as what is left of it: an empty text.
    """

    def finish(part, texts, counts, begins, ends, items):
        hit = [k for k, x in enumerate(begins) if x]
        if hit:
            now = part.column("text").to_pylist()
            for k in hit:
                now[k] = cut_words(texts[k], begins[k], ends[k]).decode()
            part = part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), pa.array(now, part.schema.field("text").type))
        return part

    out = _over_shards(docs, benchmark, finish, docs.schema, group_bytes)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark, sf_dir: str) -> DataFrame:
    found = spans(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
