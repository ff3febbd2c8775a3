"""Conversation structure repair: A* over the lattice of edits.

A conversation's rows in order, and the states of the grammar of role initials `(s?(ua)+)?` (nothing yet, after s, after
u, after a), span a lattice. Its edges are edits: Keep a row (0), Rerole it to user or assistant (3), Delete it (4; blank
and repeated rows must go), Insert a message without text (3); a truncated row that stays adds 3. A* finds the
cheapest way through it. Its heuristic is a suffix sum: each row still ahead costs at least 4 if it must be deleted, and
at least 3 if it is truncated (to charge it is cheaper than to delete it). No edge costs less than it takes from that
sum, so the heuristic is consistent. Open ways are ordered by (cost + heuristic, audit), the audit being the initials of
the edits so far; the first way that reaches the end is the cheapest, and the least in ASCII of these: initials and
state leave no choice between edits, so no two equally dear ways to a state have audits of which one begins the other.
Audits are kept as steps to their parents with jump pointers, so two of them are compared in logarithmic time and none
is copied.

Rows are read in order of turn (nulls first), then role, then a hash of role and text; repeated rows follow each other.
Two passes share the work. The first has no texts: a row is its turn, an initial, three marks and a hash of role and
text, about 40 bytes, and one task finds a conversation's edits. The second carries texts once: rows meet their
conversation's edits in the same order and leave as repaired rows, one after the other, so texts are never gathered. A
conversation is one task's work in each pass, as its result has one audit and one hash over its rows; a task holds some
hundred bytes a row of one conversation in the first pass and its audit in the second, however long its texts are.

Null roles and texts count as one space (a null text is blank, a null role can't be kept), null ids and turns as one
space in the hash that chooses the damage. Rows without an id are one conversation. A role without characters has no
initial: kept, it changes nothing in the role initials. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

WHITE = " \t\n\x0b\f\r"
RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3
#: State after an initial, by state: nothing yet, after s, after u (an assistant is due), after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The one role that may be inserted or given in each state.
_DUE = ("user", "user", "assistant", "user")


class Step:
    """A way through the lattice: its last edit, and the way before it."""

    __slots__ = ("at", "cost", "depth", "edit", "jump", "parent", "rank", "state")

    def __init__(self, parent: Step | None, edit: str, at: int, state: int, cost: int, rank: int):
        self.parent, self.edit, self.at, self.state, self.cost, self.rank = parent, edit, at, state, cost, rank
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            self.depth, far = parent.depth + 1, parent.jump
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth and far.depth else parent

    def __lt__(self, other: Step) -> bool:
        return self.rank < other.rank if self.rank != other.rank else earlier(self, other)


def earlier(a: Step, b: Step) -> bool:
    """Is a's audit less than b's? Both are lifted to one length, then to where they part."""
    x, y = a, b
    while x.depth > y.depth:
        x = x.jump if x.jump.depth >= y.depth else x.parent
    while y.depth > x.depth:
        y = y.jump if y.jump.depth >= x.depth else y.parent
    if x is y:
        return a.depth < b.depth
    while x.parent is not y.parent:
        x, y = (x.jump, y.jump) if x.jump is not y.jump else (x.parent, y.parent)
    return x.edit < y.edit


def cheapest(initials: list[str], gone: list[bool], cut: list[bool]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; gone: rows that must be deleted, cut: truncated ones."""
    n = len(initials)
    ahead = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        ahead[k] = ahead[k + 1] + (DELETE if gone[k] else CUT if cut[k] else 0)
    open_, closed = [Step(None, "", 0, NOTHING, 0, ahead[0])], set()
    while True:
        step = heapq.heappop(open_)
        at, state = step.at, step.state
        if at == n and state in (NOTHING, ASSISTANT):
            break
        if (key := 4 * at + state) in closed:
            continue
        closed.add(key)
        due = _NEXT[state][_DUE[state][0]]
        found = [("I", at, due, INSERT)]
        if at < n:
            found.append(("D", at + 1, state, DELETE))
            if not gone[at]:
                charge = CUT if cut[at] else 0
                found.append(("R", at + 1, due, RENAME + charge))
                kept = _NEXT[state].get(initials[at], None if initials[at] else state)
                if kept is not None:
                    found.append(("K", at + 1, kept, charge))
        for edit, to, then, cost in found:
            if 4 * to + then not in closed:
                heapq.heappush(open_, Step(step, edit, to, then, step.cost + cost, step.cost + cost + ahead[to]))
    letters = []
    cost = step.cost
    while step.parent is not None:
        letters.append(step.edit)
        step = step.parent
    return cost, "".join(reversed(letters))


def damage(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that a hash of id and turn chooses; dropped rows have 0 copies."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(id_col), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    return rows.select(F.col(id_col).alias("conv_id"), "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


_ORDER = ("turn", "role", "h", "g")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h": F.xxhash64("role", "text"), "g": F.xxhash64(F.lit(1), "role", "text")})


def _runs(batches, columns: tuple[str, ...]):
    """(conversation, its rows one after the other) of sorted batches."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    return itertools.groupby(rows(), key=lambda r: r[0])


def _packed(rows, types: pa.Schema, most: int = 4_000_000, weight=lambda r: 64):
    """Batches of about `most` bytes of rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), types)], schema=types)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), types)], schema=types)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _repair(conv, rows) -> tuple:
    initials, gone, cut, turns, seen = [], [], [], set(), set()
    blanks = duplicates = truncated = illegal = 0
    for _, turn, initial, h, g, blank, ends, copies in rows:
        for _ in range(copies):
            if turn is not None:
                turns.add(turn)
            again = (h, g) in seen
            seen.add((h, g))
            blanks += blank
            duplicates += again and not blank
            truncated += not blank and not again and not ends
            illegal += bool(gone) and initials[-1] + initial not in ("su", "ua", "au")
            initials.append(initial)
            gone.append(blank or again)
            cut.append(not ends)
    cost, audit = cheapest(initials, gone, cut)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return conv, gaps, blanks, duplicates, truncated, illegal, cost, audit


def repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of damage()'s rows."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    ends = trimmed.endswith(".") | trimmed.endswith("!") | trimmed.endswith("?")
    light = _hashed(rows).select("conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), "h", "g", (trimmed == "").alias("blank"), ends.alias("ends"), "copies")
    # Roles are short as a rule; only their order is needed, which their hash wouldn't give.
    held = light.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER).drop("role")
    key = rows.schema["conv_id"].dataType
    types = pa.schema([("conv_id", to_arrow_type(key)), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])

    def run(batches):
        found = (_repair(conv, group) for conv, group in _runs(batches, ("conv_id", "turn", "initial", "h", "g", "blank", "ends", "copies")))
        yield from _packed(found, types, weight=lambda r: 64 + len(r[-1]))

    return held.mapInArrow(run, f"conv_id {key.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string")


def _repaired(rows):
    """(conversation, position, role, text) of one conversation; its audit comes first."""
    audit, k, state, place, conv = "", 0, NOTHING, 0, None

    def inserted():
        nonlocal k, state, place
        while k < len(audit) and audit[k] == "I":
            role = _DUE[state]
            yield conv, place, role, ""
            k, place, state = k + 1, place + 1, _NEXT[state][role[0]]

    for conv, role, text, copies, edits in rows:
        if edits is not None:
            audit = edits
            continue
        for _ in range(copies):
            yield from inserted()
            edit = audit[k]
            k += 1
            if edit != "D":
                name = _DUE[state] if edit == "R" else role
                yield conv, place, name, text
                place, state = place + 1, _NEXT[state][name[0]] if name else state
    yield from inserted()


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): damage()'s rows after repairs()'s edits, a conversation's rows one after the other in one partition."""
    texts = _hashed(rows.where("copies > 0")).withColumn("audit", F.lit(None).cast("string"))
    first = edits.where("audit <> ''").select("conv_id", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "copies")], *[F.lit(None).cast("long").alias(c) for c in ("h", "g")], "audit")
    held = texts.unionByName(first).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER).select("conv_id", "role", "text", "copies", "audit")
    key = rows.schema["conv_id"].dataType
    types = pa.schema([("conv_id", to_arrow_type(key)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        found = (row for _, group in _runs(batches, ("conv_id", "role", "text", "copies", "audit")) for row in _repaired(group))
        yield from _packed(found, types, weight=lambda r: 64 + len(r[2]) + len(r[3]))

    return held.mapInArrow(run, f"conv_id {key.simpleString()}, position long, role string, text string")


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, sha256) of `role:text`, newline-joined; repaired()'s rows are read as they come, hashed one after the other."""
    key = messages.schema["conv_id"].dataType
    types = pa.schema([("conv_id", to_arrow_type(key)), ("sha256", pa.string())])

    def one(conv, group) -> tuple:
        sum_, joint = hashlib.sha256(), ""
        for _, role, text in group:
            sum_.update(f"{joint}{role}:{text}".encode())
            joint = "\n"
        return conv, sum_.hexdigest()

    def run(batches):
        yield from _packed((one(conv, group) for conv, group in _runs(batches, ("conv_id", "role", "text"))), types)

    return messages.mapInArrow(run, f"conv_id {key.simpleString()}, sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    rows = damage(common.table(spark, sf_dir, "conversations"))
    edits = common.stored(repairs(rows), "conversation-repairs")
    sums = digests(repaired(rows, edits)).withColumnRenamed("conv_id", "of")
    found = edits.join(sums, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return found.select("conv_id", *_COUNTS, "audit", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
