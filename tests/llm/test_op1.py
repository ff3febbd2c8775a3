"""Personal data: base spans against the plain patterns, and the field's messages against all labellings."""

import itertools
import os
import random
import re
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from convolake.llm import op1_pii as op1

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    sums = lambda d: sum(d[::-1][::2]) + sum(sum(divmod(2 * x, 10)) for x in d[::-1][1::2])
    found = [(*m.span(), 0) for m in EMAIL.finditer(text)]
    found += [(*m.span(), 1) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(*m.span(), 2) for m in CARD.finditer(text) if 14 <= len(d := digits(m[0])) <= 19 and sums(d) % 10 == 0]
    found += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


CASES = ["", "a@b", "a@b.c", "@x.y a@@b.c.d a@b..c", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "999.1.1.1 001.002.003.0004", "4845168114407329", "4845 1681-1440 7329", "4845  1681", "+1 (017) 555-7713.", "+12", "é+49 30 1234567 ٣٤", "+1+2+3 4567 890123", "٤٨٤٥"]


def test_base_spans_equal_patterns():
    rng = random.Random(1)
    texts = CASES + ["".join(rng.choice(["1", "23", "4845168114407329", ".", "@", "a", " ", "-", "+", "(", ")", "é", "b.c", "255"]) for _ in range(rng.randint(1, 25))) for _ in range(4000)]
    for t in texts:
        assert op1.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" * 100_000, "a@" * 100_000):
        op1.base_spans(t)
        op1.Tokens([t], [[]])


def test_messages_equal_all_labellings_on_trees():
    rng = np.random.default_rng(0)
    weights = {"node": rng.normal(size=(len(op1.FEATURES), 5)), "chain": rng.normal(size=(5, 5)), "skip": rng.normal(size=(5, 5))}
    t = op1.Tokens(["1 2 some words 3 more 1234567"], [[]])
    t.chain, t.skip = np.array([[0, 1]]), np.array([[1, 2], [1, 3]])
    t.observed[3] = 2
    score = op1._matrix(t.bits) @ weights["node"]
    total = np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        if y[3] == 2:
            w = np.exp(sum(score[k, y[k]] for k in range(3)) + weights["chain"][y[0], y[1]] + weights["skip"][y[1], y[2]] + weights["skip"][y[1], y[3]])
            for k in range(4):
                total[k, y[k]] += w
    got = op1.infer(t, weights, rounds=60)
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-6)


def test_repeats_far_away_are_found():
    counts = [("node", 1, 0, 900), ("node", 257, 3, 40), ("node", 257, 0, 60), ("skip", 3, 3, 90), ("skip", 0, 0, 90)]
    weights = op1.fit(counts)
    text = "card 4845168114407329 " + "word " * 300 + "again 4845.1681.1440.7329, not 4845.1681.1440.7320"
    base, spans = op1.all_spans([text, "nothing 12 here"], weights)
    assert [text[a:b] for a, b, k in spans[0]] == ["4845168114407329", "4845.1681.1440.7329"] and spans[0][1][2] == 2 and spans[1] == []
    assert set(base[0]) <= set(spans[0])


def test_query_and_mask(spark):
    rows = [(1, "mail a.b@c.de and 1.2.3.4", 25), (2, None, None), (3, "", 0), (None, "clean", 5), (1, "mail a.b@c.de and 1.2.3.4", 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("spans", F.lit("clash"))
    got = {(r["id"], len(r["base"])): [tuple(s) for s in r["base"]] for r in op1.find(df).collect()}
    assert got == {(1, 2): [(5, 13, 0), (18, 25, 1)], (2, 0): [], (3, 0): [], (None, 0): []}
    assert op1.find(df).count() == 5 and op1.find(df.limit(0)).count() == 0
    masked = op1.mask(df)
    assert masked.columns == df.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()} == {1: ("mail <EMAIL> and <IP>", 21), 2: (None, None), 3: ("", 0), None: ("clean", 5)}


def test_digits_of_hashes_are_no_numbers():
    bits = lambda t: op1._features(t, [(0, len(t))])[0]
    number = 1 << op1.FEATURES.index("14-19 digits") | 1 << op1.FEATURES.index("passes the card sum")
    assert bits("4845168114407329") & number == number
    assert bits("4a845168114407329") & number == 0


def plain_spans(text, weights):
    """All spans of a text by the module's description, token by token."""
    base = brute(text)
    tokens = [m.span() for m in re.finditer(r"\S+", text) if re.search("[0-9@]", m[0])]
    bits = list(op1._features(text, tokens))
    label = [next((k + 1 for a, b, k in base if a < y and b > x), 0) for x, y in tokens]
    score = [[sum(weights["node"][f][c] for f in range(len(op1.FEATURES)) if bits[t] >> f & 1) if not label[t] else (0.0 if c == label[t] else -30.0) for c in range(5)] for t in range(len(tokens))]
    key = [op1._key(text[a:b]) for a, b in tokens]
    edges = [(t - 1, t, "chain") for t in range(1, len(tokens)) if tokens[t][0] - tokens[t - 1][1] <= 2]
    for t in range(len(tokens)):
        same = [u for u in range(t) if key[u] and key[u] == key[t]]
        edges += [(u, t, "skip") for u in sorted({same[0], same[-1]})] if same else []
    message = {(i, j, k, way): [0.0] * 5 for i, j, k in edges for way in (0, 1)}
    belief = [list(x) for x in score]
    for _ in range(12):
        new = {}
        for i, j, k in edges:
            for way, (u, v) in enumerate(((i, j), (j, i))):
                out = [np.log(sum(np.exp(belief[u][a] - message[i, j, k, 1 - way][a] + (weights[k][a][b] if way == 0 else weights[k][b][a])) for a in range(5))) for b in range(5)]
                new[i, j, k, way] = [0.5 * m + 0.5 * (x - max(out)) for m, x in zip(message[i, j, k, way], out)]
        message = new
        belief = [list(x) for x in score]
        for (i, j, _, way), m in message.items():
            v = j if way == 0 else i
            belief[v] = [x + y for x, y in zip(belief[v], m)]
    more = []
    for t, (a, b) in enumerate(tokens):
        p = np.exp(np.array(belief[t]) - max(belief[t]))
        p /= p.sum()
        c = int(p.argmax())
        if label[t] or not c or p[c] < 0.5:
            continue
        inner = text[a:b].strip(op1.EDGES)
        a += text[a:b].index(inner) if inner else b - a
        b = a + len(inner)
        if a < b and more and more[-1][2] == c - 1 and a - more[-1][1] <= 2:
            more[-1] = (more[-1][0], b, c - 1)
        elif a < b:
            more.append((a, b, c - 1))
    return sorted([*base, *more], key=lambda s: (s[0], s[2]))


def test_spans_equal_a_plain_field(spark):
    rng = random.Random(5)
    parts = ["4845168114407329", "4845.1681.1440.7329", "a.b@c.de", "A.B@C.de", "(a.b@c.de)", "1.2.3.4", "1.2.3.4,", "+49 30 1234567", "49301234567", "word", "12", "2024-01-01", "x1y2z3w4", "foo@bar", "555-1234567"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    counts = [("node", 1, 0, 900), ("node", 257, 3, 40), ("node", 257, 0, 60), ("node", 7, 1, 50), ("node", 5, 1, 10), ("node", 5, 0, 20), ("chain", 0, 3, 5), ("chain", 0, 0, 50), ("skip", 3, 3, 90), ("skip", 1, 1, 40), ("skip", 0, 0, 90)]
    weights = op1.fit(counts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: [tuple(s) for s in r["spans"]] for r in op1.find(df, weights=weights).collect()}
    assert got == {k: plain_spans(t, weights) for k, t in enumerate(texts)}
    assert sum(len(got[k]) > len(brute(t)) for k, t in enumerate(texts)) > 20


def test_long_tables_of_numbers_take_bounded_memory():
    run = """
import resource
from convolake.llm import op1_pii as op1
weights = op1.fit([("node", 1, 0, 900), ("chain", 0, 0, 50)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
base, spans = op1.all_spans(["12 7 " * 800_000], weights)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    out = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), check=True)
    assert float(out.stdout.split()[-1]) < 500


def test_query_counts_each_kind(spark, tmp_path):
    rows = [(1, "1.2.3.4"), (2, "+1 234 567 8901 and 5.6.7.8"), (3, "a@b.co c@d.org 4111 1111 1111 1111"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in op1.query(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 1, 0, 0), 2: (0, 1, 0, 1), 3: (2, 0, 1, 0), 4: (0, 0, 0, 0)}
