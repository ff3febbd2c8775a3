"""Personal data by base patterns and a skip-chain conditional random field.

Base spans (email, ip, card, phone) follow fixed patterns and checks, and always stay. The random field labels the
tokens with a digit or an @ sign: a token's own features give its node potential, neighbours in the text share a chain
potential, and tokens of one document with the same key (their digits, or their letters and digits in lower case), how
far apart they may be, share a skip potential. Loopy sum-product messages make labels agree across a document; tokens
in base spans are observed. Tokens that come out as personal data become further spans.

Weights are learnt from base labels on a bounded sample of documents (`sample_docs`, by a hash of the id): logistic
regression for nodes, label agreement for chains and skips. The sample only fits weights; every document is searched.

Texts are taken about a megabyte at a time, a longer one alone. Tokens, edges and messages are flat arrays, the two
matrices of potentials are shared by all edges, and messages are made for some edges at a time, so a long text of
numbers takes about a hundred bytes for each character.

Null texts are empty and have no spans. Spans are in code points, ends exclusive. Rows that repeat give repeated rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

# Fixed patterns; possessive forms match the same and never go back over long runs.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
EDGES = ".,;:!?\"'`*#$%&|<>[]{}()"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        end = DOMAIN.match(text, at + 1) if start < at else None
        if end:
            found.append((start, end.end()))
            done = end.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((*m.span(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((*m.span(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


# -- the random field --

FEATURES = (
    "bias", "at sign", "at sign and dot", "letters", "1-3 digits", "4-6 digits", "7-9 digits", "10-13 digits", "14-19 digits", "20 or more digits",
    "passes the card sum", "starts with plus", "four dotted parts", "parts up to 255", "bracket", "hyphen", "after plus", "in a run of numbers", "hexadecimal",
)


#: Bytes of text that are searched at once, a longer text alone.
SLICE = 1_000_000


def _features(text: str, spans: Iterable[tuple[int, int]]) -> array:
    """Bits of FEATURES for each token."""
    out, plus_end, spans, end = array("q"), -9, iter(spans), None
    now = next(spans, None)
    while now is not None:
        (a, b), after = now, next(spans, None)
        t = text[a:b].strip(EDGES)
        letters = any(c.isalpha() for c in t)
        # Digits between letters (of a hash, say) are no number.
        digits = "" if letters else _digits(t)
        n = len(digits)
        parts = t.split(".")
        quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
        near = (end is not None and a - end <= 2) or (after is not None and after[0] - b <= 2)
        flags = (
            True, "@" in t, "@" in t and "." in t.rpartition("@")[2], letters, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n >= 20,
            14 <= n <= 19 and luhn(digits), text[a] == "+", quad, quad and all(len(p) <= 3 and int(p) <= 255 for p in parts), "(" in text[a:b], "-" in t, a - plus_end <= 2, near,
            len(t) >= 16 and all(c in "0123456789abcdefABCDEF" for c in t[:64]),
        )
        if text[a] == "+" or (a - plus_end <= 2 and n == len([c for c in t if c not in "()-. "])):
            plus_end = b
        out.append(sum(1 << i for i, f in enumerate(flags) if f))
        now, end = after, b
    return out


def _key(token: str) -> str:
    """What repeated or similar tokens share; empty for tokens too short to tell."""
    t = token.strip(EDGES)
    digits = _digits(t)
    if len(digits) >= 7 and not any(c.isalpha() for c in t):
        return digits
    plain = "".join(c for c in t.lower() if c.isalnum())
    return plain if "@" in t or len(plain) >= 7 else ""


class Tokens:
    """The field's nodes and edges for some texts."""

    def __init__(self, texts: list[str], base: list[list[tuple[int, int, int]]]):
        places, sizes, bits, observed, chain, skip = (array("q") for _ in range(6))
        for text, known in zip(texts, base):
            first = len(places) // 2
            for m in TOKEN.finditer(text):
                places.extend(m.span())
            spans = lambda: zip(places[2 * first :: 2], places[2 * first + 1 :: 2])  # noqa: B023, E731
            sizes.append(len(places) // 2 - first)
            bits.extend(_features(text, spans()))
            # heads holds keys that repeat.
            heads, last, i, end = {}, {}, 0, -9
            for k, (a, b) in enumerate(spans(), first):
                while i < len(known) and known[i][1] <= a:
                    i += 1
                # Spans of different kinds may overlap; the first that meets the token labels it.
                label, j = 0, i
                while j < len(known) and known[j][0] < b and not label:
                    label, j = (known[j][2] + 1) * (known[j][1] > a), j + 1
                observed.append(label)
                if a - end <= 2:
                    chain.extend((k - 1, k))
                end = b
                if key := _key(text[a:b]):
                    if key in last:
                        skip.extend((last[key], k))
                        if key in heads:
                            skip.extend((heads[key], k))
                        else:
                            heads[key] = last[key]
                    last[key] = k
        flat = lambda x: np.frombuffer(x, np.int64) if len(x) else np.empty(0, np.int64)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), flat(sizes))
        self.spans, self.bits, self.observed = flat(places).reshape(-1, 2), flat(bits), np.array(flat(observed), np.int8)
        self.chain, self.skip = (flat(x).reshape(-1, 2) for x in (chain, skip))


def _matrix(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)


def fit(counts: list[tuple[str, int, int, int]]) -> dict[str, np.ndarray]:
    """Weights from counts of ('node', bits, label), ('chain', label, label) and ('skip', label, label)."""
    node = [(a, b, n) for kind, a, b, n in counts if kind == "node"]
    weights = np.zeros((len(FEATURES), len(LABELS)))
    weights[0, 0] = 4.0
    if node:
        bits, label, n = (np.array(x) for x in zip(*node))
        x, y, share = _matrix(bits), np.eye(len(LABELS))[label], (n / n.sum())[:, None]
        rate = np.zeros_like(weights)
        for _ in range(600):
            z = x @ weights
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            grad = x.T @ ((p - y) * share) + 1e-4 * weights
            rate += grad**2
            weights -= 0.5 * grad / np.sqrt(rate + 1e-8)
    out = {"node": weights}
    for kind in ("chain", "skip"):
        pair = np.full((len(LABELS), len(LABELS)), 0.2) + 0.8 * np.eye(len(LABELS))
        for k, a, b, n in counts:
            if k == kind:
                pair[a, b] += n
                pair[b, a] += n
        # Pointwise information: how much likelier two labels meet than by chance.
        total = pair.sum()
        out[kind] = np.clip(np.log(pair * total / np.outer(pair.sum(1), pair.sum(0))), -4, 6)
    return out


def _sent(belief: np.ndarray, back: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Messages from nodes of these beliefs, less what came back, in logarithms; potential is no logarithm."""
    out = belief - back
    most = out.max(1, keepdims=True)
    new = np.log(np.exp(out - most) @ potential)
    return new - new.max(1, keepdims=True)


def infer(tokens: Tokens, weights: dict[str, np.ndarray], rounds: int = 12, step: int = 1 << 16) -> np.ndarray:
    """Probabilities of LABELS for each token, by damped loopy sum-product messages, made for `step` edges at a time."""
    kinds, at = np.unique(tokens.bits, return_inverse=True)
    score = (_matrix(kinds) @ weights["node"]).astype(np.float32)[at]
    seen = np.flatnonzero(tokens.observed)
    score[seen] = -30.0
    score[seen, tokens.observed[seen]] = 0.0
    belief = score.copy()
    # For each edge a message there and one back.
    sides = [(e, np.exp(weights[k]).astype(np.float32), np.zeros((2, len(e), len(LABELS)), np.float32)) for k, e in (("chain", tokens.chain), ("skip", tokens.skip)) if len(e)]
    for _ in range(rounds if sides else 0):
        for edges, potential, message in sides:
            for k in range(0, len(edges), step):
                part = slice(k, k + step)
                there = _sent(belief[edges[part, 0]], message[1, part], potential)
                back = _sent(belief[edges[part, 1]], message[0, part], potential.T)
                message[0, part] += 0.5 * (there - message[0, part])
                message[1, part] += 0.5 * (back - message[1, part])
        belief[:] = score
        for edges, _, message in sides:
            for k in range(0, len(edges), step):
                np.add.at(belief, edges[k : k + step, 1], message[0, k : k + step])
                np.add.at(belief, edges[k : k + step, 0], message[1, k : k + step])
    belief -= belief.max(1, keepdims=True)
    np.exp(belief, out=belief)
    belief /= belief.sum(1, keepdims=True)
    return belief


def all_spans(texts: list[str], weights: dict[str, np.ndarray]) -> tuple[list, list]:
    """For each text its base spans, and all spans, as (start, end, kind) by start, then kind."""
    base = [base_spans(t) for t in texts]
    tokens = Tokens(texts, base)
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(tokens.doc):
        p = infer(tokens, weights)
        label = p.argmax(1)
        label[(tokens.observed > 0) | (p.max(1) < 0.5)] = 0
        for k in np.flatnonzero(label).tolist():
            d, (a, b) = int(tokens.doc[k]), tokens.spans[k].tolist()
            t = texts[d][a:b]
            a, b = a + len(t) - len(t.lstrip(EDGES)), b - len(t) + len(t.rstrip(EDGES))
            if a >= b:
                continue
            if more[d] and more[d][-1][2] == label[k] - 1 and a - more[d][-1][1] <= 2:
                more[d][-1] = (more[d][-1][0], b, more[d][-1][2])
            else:
                more[d].append((a, b, int(label[k]) - 1))
    return base, [sorted([*x, *y], key=lambda s: (s[0], s[2])) for x, y in zip(base, more)]


def _strings(texts: list[bytes]) -> list[str]:
    return [t.decode() for t in texts]


def learn(docs: DataFrame, sample_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray]:
    """Weights from about sample_docs documents, chosen by a hash of their ids."""
    every = max(1, docs.count() // sample_docs)

    def count(batches):
        from collections import Counter

        found: Counter = Counter()
        for batch in batches:
            for _, texts in common.slices(batch, "text", SLICE):
                texts = _strings(texts)
                tokens = Tokens(texts, [base_spans(t) for t in texts])
                found.update(("node", int(b), int(y)) for b, y in zip(tokens.bits, tokens.observed))
                for kind, edges in (("chain", tokens.chain), ("skip", tokens.skip)):
                    found.update((kind, int(tokens.observed[a]), int(tokens.observed[b])) for a, b in edges)
        rows = [(*k, n) for k, n in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["kind", "a", "b", "n"])

    sample = docs.where(F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(every)) == 0).select(F.col(text_col).alias("text"))
    counts = sample.mapInArrow(count, "kind string, a long, b long, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    return fit(sorted(tuple(r) for r in counts.collect()))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(id, base, spans) for each row: arrays of struct<start, end, kind>, kind an index of KINDS."""
    weights = learn(docs, id_col=id_col, text_col=text_col) if weights is None else weights

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
        for batch in batches:
            for part, texts in common.slices(batch, "text", SLICE):
                found = all_spans(_strings(texts), weights)
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array([[dict(zip(("start", "end", "kind"), s)) for s in x] for x in side], kind) for side in found)], ["id", "base", "spans"])

    span = "array<struct<start:long,end:long,kind:int>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, base {span}, spans {span}")


def query(spark, sf_dir: str) -> DataFrame:
    found = find(common.table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k: int):
        # Lambdas of one argument: to Spark a second one, even with a default, is the element's position.
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in range(len(KINDS))], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """Pipeline stage: each span (merged where they overlap) is replaced by its kind in angle brackets; n_chars follows."""
    weights = learn(docs)

    def hide(text: str, spans) -> str:
        out, at = [], 0
        for a, b, kind in spans:
            if a >= at:
                out += [text[at:a], f"<{KINDS[kind].upper()}>"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch, "text", SLICE):
                texts = _strings(texts)
                _, spans = all_spans(texts, weights)
                if any(spans):
                    field = part.schema.field("text")
                    now = [None if not ok else hide(t, s) for ok, t, s in zip(part.column("text").is_valid().to_pylist(), texts, spans)]
                    part = part.set_column(part.schema.get_field_index("text"), field, pa.array(now, field.type))
                yield part

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
