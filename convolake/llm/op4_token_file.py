"""Token ids in files of range-coded blocks, modelled by adaptive context mixing.

Texts are tokenised, an end id is appended to each, and the ids of all documents follow each other in ascending id
order. They are cut into blocks of `BLOCK` ids, each coded on its own: models start afresh, and a block has its size
and the CRC-32 of its ids and bytes. In a block the id after the last two ids (order 2) and after the last id (order 1)
is predicted; each prediction is weighted by how often its order, at its confidence, was right so far in the block; what
weight is left goes to order 0, the counts of all ids of the block so far. Weights and counts are renewed at fixed
places. So one mixed distribution drives a carry-less range coder. That an id is new to order 0 is coded there, too; which
id it is stands in a stream of its own, by magnitudes' shares in the part with even bits below. Blocks of a part are coded
in step, one id of each at a time, so parts hold many texts: what numpy does for a step costs little more for more blocks.

A file is a Parquet table of parts: shard and part number, ids of the shard before the part, and one blob (see Part).
Shards are ranges of document ids. Ids must be below 65,536.

Null and empty texts hold the end id alone. Rows that repeat give repeated rows, in any order among them; rows without
an id come first. Other columns are not read; an empty table gives an empty file and result. A damaged block raises
ValueError.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLOCK, END = 2048, 2
#: Ids of a part; the last texts may exceed it by their own.
PART = 6_500_000
_SLOTS = BLOCK  # of each context table
#: Order 0 and the weights are renewed at these places of a block.
RENEWED = (16, 32, 64, 128, 256, 512, 768, 1024, 1536)
#: How often orders 2 and 1 are right at each confidence before much is known, and for how many trials that counts.
START, MET = ((0, 0.25, 0.67, 0.85), (0, 0.12, 0.37, 0.64)), 16
#: The share of a span's new ids that is expected of the next one.
LATER = 0.75
_MAGIC, _HEAD = b"CXM3", struct.Struct("<4sIIII")


# -- range coder in step: 64-bit low and range, 16-bit words, no carries --

_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_4, _16, _32, _48 = (np.uint64(k) for k in (4, 16, 32, 48))


class _Coder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)

    def narrow(self, n: int, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        """Narrows the first n lanes to size units from start units on."""
        start = start * unit
        self.low[:n] += start
        self.skip(n, start)
        np.multiply(size, unit, out=self.range[:n])

    def settle(self, n: int) -> None:
        """Shifts words out; afterwards every range has 32 bits at least. A word that is settled may wait for the next call."""
        low, range_ = self.low[:n], self.range[:n]
        while True:
            out = (low ^ (low + range_)) < _TOP
            small = np.flatnonzero(range_ < _BOTTOM)
            if len(small):
                # A range too small to go on ends at the next border of words.
                stuck = small[~out[small]]
                range_[stuck] = (np.uint64(0) - low[stuck]) & (_BOTTOM - np.uint64(1))
                out[stuck] = True
            by = out.astype(np.uint64) << _4
            self.shift(n, out, by)
            low <<= by
            range_ <<= by
            if not len(small) or not (range_[small] < _BOTTOM).any():
                return


class _Encoder(_Coder):
    def __init__(self, lanes: int):
        super().__init__(lanes)
        self.words, self.out = [], []

    def skip(self, n: int, start: np.ndarray) -> None:
        pass

    def shift(self, n: int, out: np.ndarray, by: np.ndarray) -> None:
        words, mask = np.zeros(len(self.low), np.uint16), np.zeros(len(self.low), bool)
        words[:n], mask[:n] = self.low[:n] >> _48, out
        self.words.append(words)
        self.out.append(mask)

    def finish(self) -> list[np.ndarray]:
        """Each lane's words; zeros may follow them."""
        for last in (self.low + (_BOTTOM - np.uint64(1))) >> _48, ((self.low + (_BOTTOM - np.uint64(1))) >> _32) & np.uint64(0xFFFF):
            self.words.append(last.astype(np.uint16))
            self.out.append(np.ones(len(self.low), bool))
        mask = np.ascontiguousarray(np.array(self.out).T)
        words = np.ascontiguousarray(np.array(self.words).T)[mask].astype("<u2")
        return np.split(words, np.cumsum(mask.sum(1))[:-1])


class _Decoder(_Coder):
    def __init__(self, streams: list[np.ndarray]):
        super().__init__(len(streams))
        # Four words are read ahead, of which two are written.
        gap = np.zeros(4, "<u2")
        self.words = np.concatenate([x for s in streams for x in (s, gap)] or [gap])
        sizes = np.array([len(s) + 4 for s in streams], np.int64)
        self.at = np.cumsum(sizes) - sizes
        #: The code less low.
        self.code = np.zeros(len(streams), np.uint64)
        for _ in range(4):
            self.code = (self.code << _16) | self.words[self.at]
            self.at += 1

    def skip(self, n: int, start: np.ndarray) -> None:
        self.code[:n] -= start

    def shift(self, n: int, out: np.ndarray, by: np.ndarray) -> None:
        code, at = self.code[:n], self.at[:n]
        code <<= by
        code |= self.words.take(at, mode="clip") * out
        at += out


# -- new ids of blocks: by magnitude, even bits below --

_IDS = np.arange(1 << 16)
#: Of each id the bits below its six highest, and its bin; of each bin its bits and its first id.
_BELOW = np.maximum(np.frexp(_IDS.astype(np.float32))[1] - 6, 0).astype(np.uint64)
_BIN = (_IDS >> _BELOW.astype(int)) + 32 * _BELOW.astype(int)
_BINS = int(_BIN[-1]) + 1
_FIRST = np.searchsorted(_BIN, np.arange(_BINS)).astype(np.uint64)
_MAGNITUDES = 15


def _magnitudes(ids: np.ndarray) -> np.ndarray:
    """Shares of the bins, of 2 ** _MAGNITUDES in all."""
    met = np.bincount(_BIN[ids], minlength=_BINS)
    share = (met > 0) + met * ((1 << _MAGNITUDES) - np.count_nonzero(met)) // max(1, met.sum())
    share[met.argmax()] += (1 << _MAGNITUDES) - share.sum()
    return share.astype("<u2")


def _new_steps(sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Lanes by falling number of new ids, and how many lanes have a first, second, ... one."""
    return np.argsort(-sizes, kind="stable"), (len(sizes) - np.cumsum(np.bincount(sizes))[:-1]).tolist()


def _encode_new(ids: np.ndarray, sizes: np.ndarray, shares: np.ndarray) -> list[np.ndarray]:
    order, steps = _new_steps(sizes)
    first = (np.cumsum(sizes) - sizes)[order]
    share = shares.astype(np.uint64)
    start, coder = np.cumsum(share) - share, _Encoder(len(sizes))
    for t, n in enumerate(steps):
        x = ids[first[:n] + t]
        kind, bits = _BIN[x], _BELOW[x]
        coder.narrow(n, start[kind], share[kind], coder.range[:n] >> np.uint64(_MAGNITUDES))
        coder.narrow(n, x.astype(np.uint64) - _FIRST[kind], np.uint64(1), coder.range[:n] >> bits)
        coder.settle(n)
    out: list = [None] * len(sizes)
    for k, words in zip(order.tolist(), coder.finish()):
        out[k] = words
    return out


def _decode_new(streams: list[np.ndarray], sizes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    order, steps = _new_steps(sizes)
    first = (np.cumsum(sizes) - sizes)[order]
    share = shares.astype(np.uint64)
    start, coder = np.cumsum(share) - share, _Decoder([streams[k] for k in order.tolist()])
    kinds, most = np.repeat(np.arange(_BINS), shares), np.uint64((1 << _MAGNITUDES) - 1)
    below, ids = _BELOW[_FIRST.astype(int)], np.zeros(int(sizes.sum()), np.uint16)
    for t, n in enumerate(steps):
        unit = coder.range[:n] >> np.uint64(_MAGNITUDES)
        kind = kinds[np.minimum(coder.code[:n] // unit, most).astype(np.int64)]
        coder.narrow(n, start[kind], share[kind], unit)
        bits = below[kind]
        unit = coder.range[:n] >> bits
        low = np.minimum(coder.code[:n] // unit, (np.uint64(1) << bits) - np.uint64(1))
        coder.narrow(n, low, np.uint64(1), unit)
        coder.settle(n)
        ids[first[:n] + t] = _FIRST[kind] + low
    return ids


# -- what all blocks know of their past --

_NONE = 4 << 16


class _Models:
    def __init__(self, lanes: int):
        self.slot, self.mix_at = np.arange(lanes, dtype=np.int64) * 2 * _SLOTS, np.arange(lanes, dtype=np.int64) * 32
        #: By slot the predictions of order 1 and order 2 in turn: id times 4 and confidence, of which 0 is none. Both slots
        #: of a place are among the same 16 entries, so that memory is waited for once.
        self.table = np.full(lanes * 2 * _SLOTS, _NONE, np.int32)
        self.one, self.older, self.two = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32), np.ones(lanes, np.int64)
        #: By order and confidence: how often it was right, and how often it was met; each begins as if met some times.
        self.right = np.array([START], np.float32).repeat(lanes, 0) * MET
        self.met = np.full((lanes, 2, 4), MET, np.float32)
        self.renew(np.full(lanes, 1.0))

    def renew(self, new: np.ndarray) -> None:
        """Weights from now on. new: the chance that an id which orders 1 and 2 miss is new, by lane."""
        rate = np.clip(self.right / self.met * 65536, 256, 65000).astype(np.int64)
        rate[:, :, 0] = 0
        two = np.broadcast_to(rate[:, 0, :, None], (len(new), 4, 4))
        one = (65536 - two) * rate[:, 1, None, :] >> 16
        rest = 65536 - two - one
        fresh = two + one + np.clip((rest * new[:, None, None]).astype(np.int64), 1, rest - 1)
        # By whether orders 1 and 2 agree, and their confidences: where order 2 ends, order 1, and new ids.
        differ = two | (two + one) << 20 | fresh << 40
        self.mix = np.stack([differ, (two + one) | (two + one) << 20 | fresh << 40], 1).astype(np.uint64).ravel()

    def predict(self, n: int) -> None:
        one = self.one[:n].astype(np.int64) + self.slot[:n]
        self.at = [(one & -16) + self.two[:n], one]
        self.entry = [self.table.take(a, mode="clip") for a in self.at]
        self.sure = [(e & 3).astype(np.int8) for e in self.entry]
        self.guess = [e >> 2 for e in self.entry]
        same = (self.guess[0] == self.guess[1]).view(np.int8)
        mix = self.mix.take(self.mix_at[:n] + ((same << 4) | (self.sure[0] << 2) | self.sure[1]), mode="clip")
        self.end2, self.end1, self.fresh = mix & _LOW20, (mix >> _20) & _LOW20, mix >> _40

    def learn(self, n: int, ids: np.ndarray, seen: np.ndarray) -> None:
        """seen: a row for what each order's confidence was and whether it was right."""
        now = (ids << 2) | 1
        for k in range(2):
            entry, sure = self.entry[k], self.sure[k]
            hit = self.guess[k] == ids
            right = hit.view(np.int8)
            move = right + right - 1 - (right & (sure == 3).view(np.int8))
            move = entry + move
            np.copyto(move, now, where=~(hit | (sure > 1)))
            self.table[self.at[k]] = move
            np.add(sure + sure, right, out=seen[k, :n])
        one = ids.view(np.uint32) * _HASH
        self.two[:n] = self.older[:n] | 1
        np.bitwise_and(one >> _SHIFT, _EVEN, out=self.one[:n])
        np.bitwise_and(one >> _LOWER, 14, out=self.older[:n])

    def count(self, seen: np.ndarray, n: int) -> None:
        """Adds what was seen by the first n lanes: (places, 2, lanes)."""
        for sure in (1, 2, 3):
            right = np.add.reduce(seen[:, :, :n] == 2 * sure + 1, 0, dtype=np.uint16).T
            self.right[:n, :, sure] += right
            self.met[:n, :, sure] += right + np.add.reduce(seen[:, :, :n] == 2 * sure, 0, dtype=np.uint16).T


#: An odd multiplier for the contexts' hash, and what leaves of it an even entry, and three other bits for the older id.
_HASH, _SHIFT, _LOWER, _EVEN = np.uint32(2654435761), np.uint32(31 - (_SLOTS - 1).bit_length()), np.uint32(17), np.uint32(2 * _SLOTS - 2)
_LOW20, _20, _40 = np.uint64((1 << 20) - 1), np.uint64(20), np.uint64(40)


def _spans(sizes: np.ndarray) -> list[tuple[int, int]]:
    """The parts of a block between which order 0 is renewed, as far as blocks reach."""
    most = int(sizes.max(initial=0))
    edges = [0, *(x for x in RENEWED if x < most), most]
    return list(zip(edges[:-1], edges[1:])) if most else []


def _chance(fresh: np.ndarray, missed: np.ndarray) -> np.ndarray:
    """How likely an id that orders 1 and 2 miss is new, from the last span's: a little less, as order 0 now knows more."""
    return np.clip(LATER * (fresh + 0.5) / (missed + 1.0), 0.001, 0.999)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """What blocks share, and the payload of each block of BLOCK ids (the last may be shorter)."""
    lanes = -(-len(ids) // BLOCK)
    if not lanes:
        return []
    rows = np.zeros((lanes, BLOCK), np.int32)
    rows.ravel()[: len(ids)] = ids
    sizes = np.minimum(BLOCK, len(ids) - np.arange(lanes) * BLOCK)
    # The distinct ids of each block are numbered, those of a block after those of the block before.
    key = np.sort((rows << 12) | np.arange(BLOCK, dtype=np.int32), axis=1)
    first = np.ones(rows.shape, bool)
    np.not_equal(key[:, 1:] >> 12, key[:, :-1] >> 12, out=first[:, 1:])
    number = np.empty(rows.size, np.int32)
    number[((key & 4095) + (np.arange(lanes, dtype=np.int32) * BLOCK)[:, None]).ravel()] = np.cumsum(first, dtype=np.int32) - 1
    width, met = int(first.sum()), first.sum(1)
    del key, first
    number, past = np.ascontiguousarray(number.reshape(rows.shape).T), np.ascontiguousarray(rows.T)
    coder, models = _Encoder(lanes), _Models(lanes)
    counts, table = np.zeros(width, np.uint32), np.zeros(width, np.uint32)
    new = np.zeros((BLOCK, lanes), bool)
    for k, (a, b) in enumerate(_spans(sizes)):
        on = lanes if a < sizes[-1] else lanes - 1
        if k:
            counts += np.bincount(number[before:a, :on].ravel(), minlength=width).astype(np.uint32)
            # All blocks have had as many ids, but one that has ended.
            starts = np.cumsum(counts, dtype=np.uint32) - counts - np.repeat(np.arange(lanes, dtype=np.uint32) * np.uint32(a), met)
            table = (starts << np.uint32(16)) | counts
            models.count(seen, on)
            models.renew(_chance(np.add.reduce(new[before:a], 0, dtype=np.int32), np.add.reduce(missed, 0, dtype=np.int32)))
        seen, missed, before, unit = np.zeros((b - a, 2, lanes), np.int8), np.zeros((b - a, lanes), bool), a, np.uint64(max(a, 1))
        for t in range(a, b):
            n = lanes if t < sizes[-1] else lanes - 1
            x = past[t, :n]
            models.predict(n)
            own = table.take(number[t, :n], mode="clip").astype(np.uint64)
            share, start = own & np.uint64(0xFFFF), own >> _16
            hit2, hit1 = models.guess[0] == x, models.guess[1] == x
            miss = ~(hit2 | hit1)
            unmet = share == 0
            np.logical_and(unmet, miss, out=new[t, :n])
            missed[t - a, :n] = miss
            end2, end1, fresh = models.end2 * unit, models.end1 * unit, models.fresh * unit
            rest = np.uint64(65536) - models.fresh
            low, part = fresh + rest * start, rest * share
            for case, begin, size in ((unmet, end1, fresh - end1), (hit1, end2, end1 - end2), (hit2, 0, end2)):
                np.copyto(low, begin, where=case)
                np.copyto(part, size, where=case)
            coder.narrow(n, low, part, (coder.range[:n] >> _16) // unit)
            coder.settle(n)
            models.learn(n, x, seen[t - a])
    fresh = np.ascontiguousarray(new.T)
    many = fresh.sum(1)
    ids = rows[fresh]
    shares = _magnitudes(ids)
    return [shares.tobytes()] + [np.array([m, len(w)], "<u2").tobytes() + w.tobytes() + x.tobytes() for m, w, x in zip(many.tolist(), _encode_new(ids, many, shares), coder.finish())]


def decode_blocks(payloads: list[bytes], count: int) -> np.ndarray:
    """The ids of all blocks, count in all."""
    if not payloads:
        return np.zeros(0, np.int32)
    shares, *payloads = (np.frombuffer(p, "<u2") for p in payloads)
    lanes = len(payloads)
    rows = np.zeros((lanes, BLOCK), np.int32)
    sizes = np.minimum(BLOCK, count - np.arange(lanes) * BLOCK)
    many = np.array([p[0] for p in payloads], np.int64)
    fresh_ids = np.append(_decode_new([p[2 : 2 + p[1]] for p in payloads], many, shares), np.uint16(0)).astype(np.int32)
    next_ = np.cumsum(many) - many
    coder, models = _Decoder([p[2 + p[1] :] for p in payloads]), _Models(lanes)
    table = np.zeros(lanes, np.uint64)
    for k, (a, b) in enumerate(_spans(sizes)):
        on = lanes if a < sizes[-1] else lanes - 1
        if k:
            key = np.sort(rows[:on, :a], axis=1)
            first = np.ones((on, a), bool)
            np.not_equal(key[:, 1:], key[:, :-1], out=first[:, 1:])
            at = np.flatnonzero(first)
            runs = np.diff(np.append(at, on * a))
            table = np.repeat((key.ravel()[at].astype(np.uint64) << _32) | ((at.astype(np.uint32) % np.uint32(a)).astype(np.uint64) << _16) | runs.astype(np.uint64), runs)
            models.count(seen, on)
            models.renew(_chance(np.add.reduce(new, 0, dtype=np.int32), np.add.reduce(missed, 0, dtype=np.int32)))
        seen, missed, new = np.zeros((b - a, 2, lanes), np.int8), np.zeros((b - a, lanes), bool), np.zeros((b - a, lanes), bool)
        unit, most, base = np.uint64(max(a, 1)), np.uint64((max(a, 1) << 16) - 1), np.arange(lanes) * max(a, 1)
        past = np.zeros((b - a, lanes), np.int32)
        for t in range(a, b):
            n = lanes if t < sizes[-1] else lanes - 1
            models.predict(n)
            end2, end1, fresh = models.end2 * unit, models.end1 * unit, models.fresh * unit
            rest = np.uint64(65536) - models.fresh
            r = (coder.range[:n] >> _16) // unit
            value = np.minimum(coder.code[:n] // r, most)
            hit2, hit1, known = value < end2, value < end1, value >= fresh
            own = table.take(base[:n] + (np.where(known, value - fresh, 0).astype(np.uint32) // rest.astype(np.uint32)), mode="clip")
            unmet = np.logical_not(hit1 | known, out=new[t - a, :n])
            at = next_[:n]
            x = (own >> _32).astype(np.int32)
            for case, ids in ((unmet, fresh_ids.take(at, mode="clip")), (hit1, models.guess[1]), (hit2, models.guess[0])):
                np.copyto(x, ids, where=case)
            at += unmet
            low, part = fresh + rest * ((own >> _16) & np.uint64(0xFFFF)), rest * (own & np.uint64(0xFFFF))
            for case, begin, size in ((unmet, end1, fresh - end1), (hit1, end2, end1 - end2), (hit2, 0, end2)):
                np.copyto(low, begin, where=case)
                np.copyto(part, size, where=case)
            coder.narrow(n, low, part, r)
            coder.settle(n)
            past[t - a, :n] = x
            np.logical_not(hit1, out=missed[t - a, :n])
            models.learn(n, x, seen[t - a])
        rows[:, a:b] = past.T
    return rows.reshape(-1)[:count]


def _sums(payloads: list[bytes], ids: np.ndarray) -> np.ndarray:
    """The CRC-32 of each payload's ids (what blocks share has none) and of itself."""
    flat = ids.astype("<u4").tobytes()
    return np.array([zlib.crc32(p, zlib.crc32(flat[4 * BLOCK * (k - 1) : 4 * BLOCK * k] if k else b"")) for k, p in enumerate(payloads)], "<u4")


class Part:
    """A blob: head, documents' ids, which of them are null, their sizes, payloads' sizes and sums, payloads."""

    @staticmethod
    def write(docs: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
        payloads = encode_blocks(ids)
        sums = _sums(payloads, ids)
        return b"".join(
            [
                _HEAD.pack(_MAGIC, BLOCK, len(docs), len(ids), len(payloads)), np.array([0 if d is None else d for d in docs], "<i8").tobytes(), bytes(d is None for d in docs),
                sizes.astype("<u4").tobytes(), np.array([len(p) for p in payloads], "<u4").tobytes(), sums.tobytes(), *payloads,
            ]
        )

    @staticmethod
    def read(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        magic, block, docs, count, blocks = _HEAD.unpack_from(blob)
        if magic != _MAGIC or block != BLOCK:
            raise ValueError("not a part of a token file")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        names, null, sizes, lengths, sums = take("<i8", docs), take("u1", docs), take("<u4", docs), take("<u4", blocks), take("<u4", blocks)
        ends = at + np.cumsum(lengths, dtype=np.int64)
        payloads = [blob[b - n : b] for b, n in zip(ends.tolist(), lengths.tolist())]
        ids = decode_blocks(payloads, count)
        wrong = np.flatnonzero(_sums(payloads, ids) != sums)
        if len(wrong):
            raise ValueError(f"block {wrong[-1] - 1} of a token file is damaged")
        return [None if z else d for d, z in zip(names.tolist(), null.tolist())], sizes.astype(np.int64), ids


# -- tokenising --


class Tokenising:
    """Ids of texts by the tokenizers library, where each distinct chunk goes there once.

    A chunk is a space and what follows up to the next one; it is tokenised alike wherever it stands, but where white
    space is on both sides of a space. Arrow cuts texts into chunks and numbers the distinct ones, which are split into
    words by the tokenizer's own pattern. Words of letters go to the library many at a time as one text, in its letters
    for bytes, so that it need not look for words again. Texts with runs of white space are split by the pattern whole.
    Texts with characters whose class differs between Unicode versions, with rare white space or added tokens go to the
    library whole.
    """

    # The word pattern of byte-level tokenizers of this family, and blocks of characters, but white space,
    # whose classes have not changed for long.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    STEADY = "\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u0557\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u206f\u2190-\u27ff\u3001-\u30ff\u4e00-\u9fcc\uac00-\ud7a3\uff01-\uffee\U0001f300-\U0001f64f"
    RUNS = ("   ", "  \n", "\n  ", "\n \n")
    #: Some or many of these are one word after letters.
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, model: str, most: int = 600_000):
        import regex
        from tokenizers import Tokenizer

        self.model, self.words, self.most = Tokenizer.from_str(model), regex.compile(self.PATTERN), most
        #: The same merges for words in letters for bytes, which spaces tell apart.
        self.bare = Tokenizer.from_str(json.dumps(json.loads(model) | {"pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}, "added_tokens": []}))
        rare = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
        self.letters = "".join(chr(256 + rare.index(b) if b in rare and b != 0x20 else b) for b in range(256))
        #: Ids of words, and of chunks without their space; words of a space and letters are chunks.
        self.known: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.odd = re.compile(f"[^{self.STEADY}]")
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        tokens = self.model.get_vocab()
        self.begins = np.zeros(max(tokens.values()) + 1, bool)
        self.begins[[i for t, i in tokens.items() if t.startswith("\u0120")]] = True
        self.feed = np.arange(len(self.begins)) == tokens["Ċ"]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, found: dict[str, bytes], words: list[str], spaced: bool) -> None:
        """Learns words of letters, or of a space and letters (given without the space)."""
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            text = codecs.charmap_decode(" ".join(part).encode(), "strict", self.letters)[0]
            text = "Ġ" + text.replace(" ", " Ġ") if spaced else "Ċ " + text.replace(" ", " Ċ ")
            ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
            # A token that begins with a space begins a word; others are told apart by line feeds.
            cuts = np.flatnonzero((self.begins if spaced else self.feed)[ids])
            if len(cuts) != len(part):
                raise ValueError("the tokenizer joins words")
            begins, ends, flat = (2 * (cuts + (not spaced))).tolist(), (2 * np.append(cuts[1:], len(ids))).tolist(), ids.tobytes()
            found.update(zip(part, [flat[a:b] for a, b in zip(begins, ends)]))

    def _learn(self, spaced: list[str], others: list[str]) -> None:
        self._letters(self.chunks, spaced, True)
        self._letters(self.known, [w for w in others if w.isalpha()], False)
        others = [w for w in others if not w.isalpha()]
        for k in range(0, len(others), 20_000):
            self.known.update(zip(others[k : k + 20_000], self._ids(others[k : k + 20_000])))

    def _by_words(self, split: list[list[str]]) -> list[bytes]:
        known, chunks = self.known, self.chunks
        spaced, bare = set(), set()
        for w in {w for x in split for w in x}:
            if w[0] == " " and w[1:].isalpha():
                if w[1:] not in chunks:
                    spaced.add(w[1:])
            elif w not in known:
                bare.add(w)
        self._learn(list(spaced), list(bare))
        return [b"".join([known[w] if w in known else chunks[w[1:]] for w in x]) for x in split]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) with END after each, and how many each has."""
        for cache in (self.known, self.chunks):
            if len(cache) > self.most:
                # What was met first is met most.
                for w in list(cache)[self.most // 2 :]:
                    del cache[w]
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        plain, by_words, every = np.zeros(len(texts), bool), {}, [b""] * len(texts)
        for k, t in enumerate(texts.to_numpy(zero_copy_only=False).tolist()):
            if "\x1c" in t or "\x1d" in t or "\x1e" in t or "\x1f" in t or any(w in t for w in self.added) or not t.isascii() and self.odd.search(t):
                every[k] = self._ids([t])[0]
            elif "\t" in t or "\r" in t or "\x0b" in t or "\x0c" in t or ("  " in t or "\n " in t) and (any(w in t for w in self.RUNS) or t.endswith(("  ", "\n "))):
                by_words[k] = self.words.findall(t)
            else:
                plain[k] = True
        split = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        edges, coded = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        chunks, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        # What stands before a text's first space has no space before it.
        heads, at = edges[:-1], np.flatnonzero(plain)
        by_words.update((k, self.words.findall(chunks[c])) for k, c in zip(at.tolist(), codes[heads].tolist()))
        follow = np.ones(len(codes), bool)
        follow[heads] = False
        used = np.zeros(len(chunks), bool)
        used[codes[follow]] = True
        found = list(map(self.chunks.get, chunks))
        spaced, bare, letters, parsed, others = set(), set(), [], [], []
        for k in [k for k, (x, u) in enumerate(zip(found, used.tolist())) if x is None and u]:
            c = chunks[k]
            if c.isalpha():
                spaced.add(c)
                letters.append(k)
                continue
            line, feed, after = c.partition("\n")
            word, next_ = line.rstrip(self.MARKS), after.rstrip(self.MARKS)
            if word.isalpha() and (not feed or next_.isalpha()):
                parsed.append((k, word, line[len(word) :], feed, next_, after[len(next_) :]))
                spaced.add(word)
                bare.update(parsed[-1][2:])
            else:
                others.append(k)
        self._learn([w for w in spaced if w not in self.chunks], [w for w in bare if w not in self.known])
        of, known = self.chunks, self.known
        for k in letters:
            found[k] = of[chunks[k]]
        for k, word, marks, feed, next_, more in parsed:
            found[k] = of[chunks[k]] = of[word] + known[marks] + known[feed] + known[next_] + known[more]
        for k, ids in zip(others, self._by_words([self.words.findall(" " + chunks[k]) for k in others])):
            found[k] = of[chunks[k]] = ids
        # A chunk that only begins a text isn't wanted after a space.
        found = [b"" if x is None else x for x in found]
        for k, ids in zip(by_words, self._by_words(list(by_words.values()))):
            every[k] = ids
        # Each text is its own first piece, the chunks that follow it, and an end.
        first, last = len(found), len(found) + len(texts)
        pieces = np.zeros(len(texts), np.int64)
        pieces[at] = np.diff(edges) - 1
        ends = np.cumsum(pieces + 2)
        line = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        inner = np.ones(len(line), bool)
        begins = ends - pieces - 2
        line[begins], line[ends - 1] = first + np.arange(len(texts)), last
        inner[begins] = inner[ends - 1] = False
        line[inner] = codes[follow]
        pool = [*found, *every, np.array([END], "<u2").tobytes()]
        sizes = np.fromiter(map(len, pool), np.int64, len(pool)) // 2
        starts, many = np.cumsum(sizes) - sizes, sizes[line]
        after = np.cumsum(many)
        ids = np.frombuffer(b"".join(pool), "<u2")[np.repeat(starts[line] - (after - many), many) + np.arange(many.sum())]
        return ids, np.diff(after[ends - 1], prepend=0)


#: What this worker has learnt of each model, for its next task.
_READY: dict[str, Tokenising] = {}


def ready(model: str) -> Tokenising:
    if model not in _READY:
        _READY.clear()
        _READY[model] = Tokenising(model)
    return _READY[model]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The file's parts as a DataFrame (shard, part, start, n_tokens, blob), written to the shared folder."""
    with open(model or default_model(), encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenising, shard, part, start = ready(sent.value), TaskContext.get().partitionId(), 0, 0
        docs, held = [], []

        def put():
            nonlocal part, start
            ids, sizes = (np.concatenate(x) for x in zip(*held))
            blob = Part.write(docs, sizes, ids)
            row = [pa.array([shard], pa.int64()), pa.array([part], pa.int64()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())]
            part, start = part + 1, start + len(ids)
            docs.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(row, ["shard", "part", "start", "n_tokens", "blob"])

        for batch in batches:
            for piece in common.pieces(batch, "text", 6_000_000):
                held.append(tokenising(piece.column("text")))
                docs += piece.column("id").to_pylist()
                if sum(len(ids) for ids, _ in held) >= PART:
                    yield put()
        if held:
            yield put()

    # Rows of one id, or of none, are told apart by their texts, so that they need not share a range.
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("salt"))
    ordered = read.repartitionByRange("id", "salt").sortWithinPartitions("id", "salt").select("id", "text")
    return common.stored(ordered.mapInArrow(run, "shard long, part long, start long, n_tokens long, blob binary"), "tokens")


def read(file: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) for each document of a file; start counts the ids of all documents before it."""
    before, starts = 0, {}
    for shard, n in sorted(tuple(r) for r in file.groupBy("shard").agg(F.sum("n_tokens")).collect()):  # one row a shard
        starts[shard], before = before, before + n
    sent = file.sparkSession.sparkContext.broadcast(starts)

    def run(batches):
        for batch in batches:
            for shard, start, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "start", "blob"))):
                docs, sizes, ids = Part.read(blob)
                flat, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                first = ends - sizes
                sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(first + (sent.value[shard] + start)), pa.array(sizes), pa.array(sums, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    return file.select("shard", "start", "blob").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def query(spark, sf_dir: str) -> DataFrame:
    return read(write(common.table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
