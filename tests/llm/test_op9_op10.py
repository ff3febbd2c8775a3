"""Decontamination and SimHash groups against plain re-statements of their contracts."""

import hashlib
import random
import re
import types

import numpy as np
import xxhash
from pyspark.sql import functions as F

from convolake.llm import op9_decontaminate as op9
from convolake.llm import op10_simhash as op10

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_hits(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    sizes = {len(x) for x in windows}
    out = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        names = sorted(str(i) for i in found if i is not None)
        out[d] = (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
    return out


def some_docs():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "B7", "x-y"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 10, 11, 30])))) for i in range(25)] + [(99, None), (98, "... !"), (None, "null id words")]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "w1")]
    for d in range(4, 60):
        parts = [rng.choice(items)[1] or "" if rng.random() < 0.4 else " ".join(rng.choices([*vocabulary, "zz"], k=rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(parts).upper() if d % 3 else " ".join(parts)))
    docs += [(60, "w1 " * 5000), (61, items[4][1]), (62, "null id, words")]
    return docs, items


def test_hits_equal_brute_force(spark):
    docs, items = some_docs()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    for group in (1 << 20, 40):
        got = {r["id"]: r for r in op9.spans(d, b, group).collect()}
        want = brute_hits(docs, items)
        assert len(got) == len(docs)
        for k, r in got.items():
            n = sum(b - a for a, b in zip(r["starts"], r["ends"]))
            assert (r["n_words"], n, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), n > 0) == want[k], k


def test_removed_spans_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten"
    d = spark.createDataFrame([(1, f"Keep this. {item.upper()}! And this.", 7), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in op9.remove_spans(d, b).collect()}
    assert got[1]["text"] == "Keep this. ! And this." and got[1]["n_chars"] == 22
    assert got[2]["text"] == "clean" and got[3]["text"] is None
    assert op9.remove_spans(d, b.limit(0)).count() == 3
    assert op9.remove_spans(d.limit(0), b).count() == 0


def test_pieces_and_groups_change_nothing(monkeypatch):
    docs, items = some_docs()
    want, texts = brute_hits(docs, items), [(t or "").encode() for _, t in docs]
    for piece, split, step in ((50, 30, 3), (7, 5, 100), (2_000_000, 4_000_000, 1)):
        monkeypatch.setattr(op9, "PIECE", piece)
        monkeypatch.setattr(op9, "SPLIT", split)
        groups = [types.SimpleNamespace(value=[(i, (t or "").encode()) for i, t in items[k : k + step]], _value=1) for k in range(0, len(items), step)]
        counts, begins, ends, found = op9._shard(texts, groups, None)
        assert not any("_value" in vars(g) for g in groups)
        for (k, _), n, a, b, names in zip(docs, counts, begins, ends, found):
            hits = sum(y - x for x, y in zip(a, b))
            assert (n, hits, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hits > 0) == want[k], k


def test_suffix_array_and_index():
    rng = np.random.default_rng(0)
    for n, a in ((1, 2), (50, 2), (300, 5), (400, 40)):
        text = np.append(rng.integers(0, a, n), 0)
        order = op9.suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = op9.FMIndex(text, a)
        assert index.locate(np.arange(len(text) + 1)).tolist() == [len(text), *order.tolist()]


def brute_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2) if w else 0)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(fps, radius=2):
    root = {k: k for k, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= radius:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k, _ in fps}


def test_fingerprints_and_groups_equal_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(f"t{rng.randint(0, 900)}" for _ in range(rng.choice([1, 2, 3, 40, 400, 900]))) for _ in range(30)]
    docs = [(0, None), (1, ""), (2, " \t")]
    for d in range(3, 200):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            w[rng.randrange(len(w))] = "new"
        docs.append((d, "\n ".join(w).upper() if d % 2 else "  ".join(w)))
    docs.append((200, "a\u00a0b\u2003c É " * 9000))
    want = {d: brute_fingerprint(t) for d, t in docs}
    got = op10.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").withColumn("fp", F.lit(1)), shard_rows=16).collect()
    assert {r["id"]: r["fp"] & (1 << 64) - 1 for r in got} == want
    assert {r["id"]: r["component"] for r in got} == brute_components(list(want.items()))


def test_trees_find_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 200, np.int64)
    near = np.concatenate([base] + [base ^ (np.int64(1) << rng.integers(0, 62, 200)) ^ (np.int64(1) << rng.integers(0, 62, 200)) for _ in range(10)])
    hot = np.int64(12345) ^ (np.int64(1) << rng.integers(0, 62, 900)) ^ (np.int64(1) << rng.integers(0, 62, 900))
    fps = np.unique(np.concatenate([near, hot]))
    want = brute_components([(int(x), int(x) & (1 << 64) - 1) for x in fps])
    for size in (100, 100_000):
        df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
        got = {r["fp"]: r["root"] for r in op10.fingerprint_components(df, shard_rows=size).collect()}
        assert {k: got.get(k, k) for k in want} == want


def test_keep_one(spark):
    docs = [(5, "a b c d", "en"), (3, "A B C D", "de"), (3, "A B C D", "de"), (4, None, None), (1, "", "x"), (None, "a b c d", "en"), (9, "some other words here", "en")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = op10.keep_one(d)
    assert got.columns == d.columns
    assert sorted(got.select("doc_id").collect(), key=str) == sorted([(3,), (1,), (9,), (None,)], key=str)
    assert op10.keep_one(d.limit(0)).count() == 0


def test_keep_one_of_each_component_where_ids_repeat(spark):
    """One id with texts of different components: each component keeps one row, and no other group's copy."""
    texts = [f"{w} one {w} two {w} three {w} four" for w in ("red", "green", "blue", "white", "black", "gray")]
    docs = [(1, texts[0]), (1, texts[1]), (2, texts[1])]  # both components have 1 as their smallest id
    for k in range(2, 6):
        docs += [(10 * k, f"own words of {k} alone"), (10 * k, texts[k]), (9, texts[k]), (10 * k, texts[k])]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want = [(1, texts[0]), (1, texts[1])] + [x for k in range(2, 6) for x in ((10 * k, f"own words of {k} alone"), (9, texts[k]))]
    assert sorted(tuple(r) for r in op10.keep_one(d).collect()) == sorted(want)


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c", 1, 2, 3, 4), (1, "a b c", 1, 2, 3, 5), (2, "a b c", 6, 7, 8, 9), (3, "d", 1, 1, 1, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, key long, row long, FP long, id long")
    got = op10.keep_one(d)
    assert got.columns == d.columns
    assert sorted(tuple(r)[:5] for r in got.collect()) == [(1, "a b c", 1, 2, 3), (3, "d", 1, 1, 1)]
