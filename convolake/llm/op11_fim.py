"""Fill-in-middle transformation on ropes, and its inverse.

A text is cut into units (white space and the word after it, or white space that ends the text). It becomes a rope: a
balanced tree whose leaves hold about LEAF bytes and cache how many units end in them and how many code points they
hold; inner nodes cache the sums. Splitting at two unit ranks walks down by these counts and cuts one leaf each time, so
prefix, middle and suffix are subtrees; they are concatenated anew with the sentinels between them. The inverse builds
the rope of an output, splits it at the code-point ranks of its sentinels and concatenates the subtrees in their first
order. What a text holds that may be taken for a sentinel keeps it plain, so a rearranged output has each sentinel once:
no sentinel can begin or end inside another, so none arises where texts meet.

Ranks come from the id alone, so a row's result doesn't depend on other rows or on partitioning; nothing is shuffled.
A null text counts as empty. A null id counts as an empty one in the hash. Rows that repeat give equal rows. Texts of any
length are taken whole; a task holds a slice of some texts (one at least), their ropes one at a time. Other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LEAF = 4096
#: Bytes that are white space.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data: bytes) -> np.ndarray:
    """Byte offsets where units end: before white space that follows a word, and at the end of the text."""
    if not data:
        return np.empty(0, np.int64)
    white = _WHITE[np.frombuffer(data, np.uint8)]
    return np.append(np.flatnonzero(white[1:] & ~white[:-1]) + 1, len(data))


class Leaf:
    """Some bytes of a text, with the offsets (from `base`) of the units that end in them."""

    __slots__ = ("base", "chars", "data", "ends")

    def __init__(self, data: bytes, ends: np.ndarray, base: int):
        self.data, self.ends, self.base, self.chars = data, ends, base, len(data.decode())

    @property
    def units(self) -> int:
        return len(self.ends)

    def split(self, rank: int, by: str) -> tuple[Leaf | None, Leaf | None]:
        if by == "units":
            at = int(self.ends[rank - 1]) - self.base if rank else 0
        else:
            at = len(self.data.decode()[:rank].encode())
        k = int(np.searchsorted(self.ends, self.base + at, "right"))
        left, right = self.data[:at], self.data[at:]
        return Leaf(left, self.ends[:k], self.base) if left else None, Leaf(right, self.ends[k:], self.base + at) if right else None

    def leaves(self):
        yield self


class Node:
    """Two ropes, one after the other."""

    __slots__ = ("chars", "left", "right", "units")

    def __init__(self, left: Leaf | Node, right: Leaf | Node):
        self.left, self.right = left, right
        self.units, self.chars = left.units + right.units, left.chars + right.chars

    def split(self, rank: int, by: str) -> tuple[Leaf | Node | None, Leaf | Node | None]:
        before = getattr(self.left, by)
        if rank <= before:
            a, b = self.left.split(rank, by)
            return a, joined(b, self.right)
        a, b = self.right.split(rank - before, by)
        return joined(self.left, a), b

    def leaves(self):
        yield from self.left.leaves()
        yield from self.right.leaves()


Rope = Leaf | Node | None


def joined(*ropes: Rope) -> Rope:
    """Ropes one after the other; None is the empty one."""
    out = None
    for rope in ropes:
        out = rope if out is None else out if rope is None else Node(out, rope)
    return out


def rope(text: str) -> Rope:
    """A balanced rope of a text; leaves end between code points."""
    data = text.encode()
    ends = unit_ends(data)
    cuts = list(range(0, len(data), LEAF)) + [len(data)]
    for k in range(1, len(cuts) - 1):
        while data[cuts[k]] & 0xC0 == 0x80:
            cuts[k] -= 1
    place = np.searchsorted(ends, cuts, "right")
    level: list = [Leaf(data[a:b], ends[i:j], a) for a, b, i, j in zip(cuts, cuts[1:], place, place[1:])]
    while len(level) > 1:
        level = [Node(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0] if level else None


def split(whole: Rope, rank: int, by: str = "units") -> tuple[Rope, Rope]:
    """The first `rank` units (or chars), and the rest."""
    return whole.split(rank, by) if whole is not None else (None, None)


def chars(part: Rope) -> int:
    return part.chars if part is not None else 0


def written(whole: Rope) -> str:
    return b"".join(leaf.data for leaf in whole.leaves()).decode() if whole is not None else ""


def rearranged(text: str, h1: int, h2: int, h3: int, h4: int, rate: int = 50, spm: int = 80) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of a text."""
    whole = rope(text)
    n = whole.units if whole is not None else 0
    if not n or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, rest = split(whole, first)
    middle, suffix = split(rest, last - first)
    p, s, m = (rope(x) for x in (PREFIX, SUFFIX, MIDDLE))
    form, parts = ("spm", (s, suffix, p, prefix, m, middle)) if h4 % 100 < spm else ("psm", (p, prefix, s, suffix, m, middle))
    return n, form, chars(prefix), chars(middle), written(joined(*parts))


def original(output: str, form: str) -> str:
    """The text whose output of this form this is."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at, to = output.find(second), output.find(MIDDLE)
    rest, middle = split(rope(output), to, "chars")
    one, two = split(rest, at, "chars")
    (_, one), (_, two), (_, middle) = (split(x, len(s), "chars") for x, s in ((one, first), (two, second), (middle, MIDDLE)))
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return written(joined(prefix, middle, suffix))


def _transformed(rate: int, spm: int):
    def run(batches):
        for batch in batches:
            for part, _ in common.slices(batch, "text"):
                texts = part.column("text").to_pylist()
                ranks = zip(*(part.column(h).to_pylist() for h in ("h1", "h2", "h3", "h4")))
                made = [rearranged(t or "", *h, rate, spm) for t, h in zip(texts, ranks)]
                columns = list(zip(*made)) or [()] * 5
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(c, t) for c, t in zip(columns, types)]], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): `rate` % of the texts are rearranged, `spm` % of these suffix first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    hashed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    return hashed.mapInArrow(_transformed(rate, spm), f"id {hashed.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def _restored(batches):
    for batch in batches:
        for part, _ in common.slices(batch, "output"):
            texts = [original(o, f) for o, f in zip(part.column("output").to_pylist(), part.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "restored"])


def restore(outputs: DataFrame) -> DataFrame:
    """transform()'s rows with `restored`, the text rebuilt from output and form alone."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(_restored, f"{schema}, restored string")


def query(spark, sf_dir: str) -> DataFrame:
    rows = restore(transform(common.table(spark, sf_dir, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
