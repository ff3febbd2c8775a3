"""SentencePiece encoding and decoding by suffix-array matching.

For a byte-pair model without text normalisation: spaces become U+2581, one is put in front, and pieces hold that mark at
their start only, so a text falls into segments (marks, then other characters) that are encoded apart. The distinct
segments of a batch that were not met before are concatenated and indexed by a suffix array; a binary search for every
piece gives the range of its occurrences. These are the edges of a graph over character positions; sorted by segment,
score and position they are relaxed: in each round every segment takes its best edge that joins two present symbols,
until none is left. That is what merging by score does, so ids equal those of the sentencepiece library. Segments longer
than `LONG` characters are relaxed with a heap over the same edges. Characters that are no piece become byte pieces.

Decoding joins pieces and bytes, turns marks into spaces and takes the first one off (U+2581 in a text so becomes a
space, as in the library). Null and empty texts have no ids and decode to an empty text. Rows that repeat give repeated
rows; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK, LONG, SPAN = "▁", 64, 16
#: Characters of distinct segments that are indexed at once. An index takes about a hundred bytes for each, and one segment
#: longer than this (a text without spaces is one) is indexed alone: about 450 bytes for each of its characters.
PART = 600_000
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """A model's pieces as arrays, made on the driver and sent to tasks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.texts = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(MARK in self.texts[i].lstrip(MARK) for i in plain) or max(len(self.texts[i]) for i in plain) > SPAN or model.encode("ﬁ x") != model.encode(model.decode(model.encode("ﬁ x"))):
            raise ValueError("the model has pieces of another form")
        self.byte = np.zeros(256, np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.byte[int(self.texts[i][1:-1], 16)] = i
        self.decoded = [bytes([int(t[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i) else t.replace(MARK, " ").encode() for i, t in enumerate(self.texts)]
        self.ids = np.array(plain, np.int64)
        self.lengths = np.array([len(self.texts[i]) for i in plain], np.int64)
        self.scores = np.array([model.get_score(i) for i in plain], np.float64)
        #: Places of the scores, best first; equal scores share one.
        self.merit = np.unique(-self.scores, return_inverse=True)[1].astype(np.int64)
        # Code points of pieces get small numbers from 1 on; all others share the largest.
        points = sorted({ord(c) for i in plain for c in self.texts[i]})
        self.other = len(points) + 1
        self.number = np.full(0x110000, self.other, np.uint16)
        self.number[points] = np.arange(1, self.other)
        rows = np.zeros((2, len(plain), SPAN), np.uint16)
        rows[1] = 0xFFFF
        for k, i in enumerate(plain):
            rows[:, k, : len(self.texts[i])] = self.number[[ord(c) for c in self.texts[i]]]
        self.low, self.high = self.packed(rows[0]), self.packed(rows[1])

    @staticmethod
    def packed(rows: np.ndarray) -> np.ndarray:
        """Rows of SPAN numbers as four keys that compare alike."""
        four = rows.reshape(len(rows), SPAN // 4, 4).astype(np.uint64)
        return (four << np.array([48, 32, 16, 0], np.uint64)).sum(2, dtype=np.uint64)


def suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first SPAN numbers, and each position's first four numbers as one key."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(SPAN, np.uint16)]).astype(np.uint64)
    key = (padded[:n] << np.uint64(48)) | (padded[1 : n + 1] << np.uint64(32)) | (padded[2 : n + 2] << np.uint64(16)) | padded[3 : n + 3]
    rank, by = key, key
    for reach in (4, 8, 16):
        order = np.argsort(by)
        if reach == 16:
            return order, key
        new = np.concatenate([[1], (by[order][1:] != by[order][:-1]).astype(np.uint64)])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        ahead = np.concatenate([rank[reach:], np.zeros(min(reach, n), np.uint64)])
        by = (rank << np.uint64(32)) | ahead


def ranges(order: np.ndarray, key: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """For each wanted row of keys the first place in order whose suffix is not below it (after: is above it)."""
    n = len(order)
    keys = np.concatenate([key, np.zeros(SPAN, np.uint64)])
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), n, np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        at = order[middle]
        below, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for k in range(SPAN // 4):
            have, want = keys[at + 4 * k], wanted[open_, k]
            below |= same & (have < want)
            same &= have == want
        below |= same & after
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def encode_segments(segments: list[str], pieces: Pieces) -> list[bytes]:
    """Ids of each segment, as little-endian 32-bit numbers."""
    points = np.frombuffer("\0".join([*segments, ""]).encode("utf-32-le"), "<u4")
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = pieces.number[points]
    text[starts + sizes] = 0
    order, key = suffixes(text)
    low, high = ranges(order, key, pieces.low, False), ranges(order, key, pieces.high, True)
    many = high - low
    piece = np.repeat(np.arange(len(many)), many)
    at = order[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]
    length = pieces.lengths[piece]
    symbol, going = np.full(len(text), -1, np.int64), np.zeros(len(segments), bool)
    symbol[at[length == 1]] = pieces.ids[piece[length == 1]]
    more = length > 1
    at, piece, length = at[more], piece[more], length[more]
    segment = np.repeat(np.arange(len(sizes)), sizes + 1)[at]
    present, after = np.ones(len(text) + 1, bool), np.arange(1, len(text) + 2)  # a symbol begins here; where it ends
    long = sizes[segment] > LONG
    if long.any():
        order = np.argsort(segment[long], kind="stable")
        l_at, l_length, l_piece, l_segment = (x[long][order] for x in (at, length, piece, segment))
        for k in np.unique(l_segment):
            a, b = np.searchsorted(l_segment, [k, k + 1])
            _relax_long(l_at[a:b], l_length[a:b], l_piece[a:b], int(starts[k]), int(sizes[k]), present, symbol, pieces)
        at, piece, length, segment = (x[~long] for x in (at, piece, length, segment))
    # By segment, score and position: sorted as one number.
    order = np.argsort((segment << 31) | (pieces.merit[piece] << 8) | (at - starts[segment]))
    at, piece, segment = at[order], piece[order], segment[order]
    end = at + length[order]
    while len(at):
        middle = after[at]
        open_ = present[at] & present[end] & (middle < end)
        ready = np.flatnonzero(open_ & (after[middle] == end))
        if not len(ready):
            break
        # The first ready edge of a segment is its best one; segments without one are done.
        of = segment[ready]
        best = ready[np.concatenate([[True], of[1:] != of[:-1]])]
        present[middle[best]] = False
        after[at[best]] = end[best]
        symbol[at[best]] = pieces.ids[piece[best]]
        going[:] = False
        going[segment[best]] = True
        open_[best] = False
        open_ &= going[segment]
        at, end, piece, segment = at[open_], end[open_], piece[open_], segment[open_]
    out = []
    begins = np.flatnonzero(present[:-1])
    ids = symbol[begins]
    before = np.cumsum(present) - 1
    first, last = before[starts].tolist(), before[starts + sizes].tolist()
    flat = ids.astype("<u4").tobytes()
    bare = np.concatenate([[0], np.cumsum(ids < 0)])  # separators have no id either, but stand between segments
    bare = (bare[last] - bare[first]).tolist()
    for a, b, unknown in zip(first, last, bare):
        if not unknown:
            out.append(flat[4 * a : 4 * b])
        else:
            spread: list[int] = []
            for j in range(a, b):
                spread += [int(ids[j])] if ids[j] >= 0 else pieces.byte[list(chr(points[begins[j]]).encode())].tolist()
            out.append(np.array(spread, "<u4").tobytes())
    return out


def _relax_long(at, length, piece, start: int, size: int, present, symbol, pieces: Pieces) -> None:
    """Relaxes one segment's edges by a heap of the merges of neighbours."""
    edge = {(a - start, n): p for a, n, p in zip(at.tolist(), length.tolist(), piece.tolist())}
    end, before, heap = list(range(1, size + 1)), list(range(-1, size - 1)), []

    def offer(a: int) -> None:
        if a >= 0 and end[a] < size and (p := edge.get((a, end[end[a]] - a))) is not None:
            heapq.heappush(heap, (-pieces.scores[p], a, end[a], end[end[a]], p))

    gone = bytearray(size + 1)
    for a in range(size):
        offer(a)
    while heap:
        _, a, b, c, p = heapq.heappop(heap)
        if gone[a] or gone[b] or end[a] != b or end[b] != c:
            continue
        gone[b], end[a] = 1, c
        if c < size:
            before[c] = a
        present[start + b] = False
        symbol[start + a] = pieces.ids[p]
        offer(before[a])
        offer(a)


class Encoder:
    def __init__(self, pieces: Pieces, most: int = 200_000):
        self.pieces, self.most, self.known = pieces, most, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [SEGMENT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        fresh = list({s for x in split for s in x if s not in self.known})
        # Bounded parts: a batch of texts holds at most its own characters, and an index of them a few times as much.
        at = 0
        while at < len(fresh):
            end, size = at, 0
            while end < len(fresh) and (end == at or size + len(fresh[end]) < PART):
                size += len(fresh[end]) + 1
                end += 1
            self.known.update(zip(fresh[at:end], encode_segments(fresh[at:end], self.pieces)))
            at = end
        known = self.known
        return [b"".join([known[s] for s in x]) for x in split]


def decode(ids: bytes, pieces: Pieces) -> str:
    table = pieces.decoded
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")[1:]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, model: str | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_crc32, decoded_sha256, round_trip) for each row, and the ids, if asked for."""
    sent = docs.sparkSession.sparkContext.broadcast(Pieces(model or default_model()))

    def run(batches):
        encoder = Encoder(sent.value)
        for batch in batches:
            for part, texts in common.slices(batch, "text", 3_000_000):
                texts = [t.decode() for t in texts]
                ids = encoder(texts)
                back = [decode(i, encoder.pieces) for i in ids]
                columns = {
                    "id": part.column("id"), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()), "ids_crc32": pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    "decoded_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()), "round_trip": pa.array([b == t for b, t in zip(back, texts)], pa.bool_()),
                }
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                    ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return encoded(common.table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
