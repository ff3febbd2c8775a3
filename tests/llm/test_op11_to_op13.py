"""Ropes against slices, graphs against all distances, and repairs against all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from convolake.llm import op11_fim as fim
from convolake.llm import op12_hnsw as hnsw
from convolake.llm import op13_conversations as talk

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def test_ropes_against_slices():
    rng = random.Random(2)
    for t in range(2000):
        text = "".join(rng.choice("ab é日\n \t\x00<PSM>") for _ in range(rng.randint(0, 20_000 if t % 100 == 0 else 30)))
        h = [rng.randrange(2**32) for _ in range(4)]
        n, form, prefix, middle, output = fim.rearranged(text, *h)
        units = UNITS.findall(text)
        assert n == len(units) and fim.original(output, form) == text
        if form != "plain":
            a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
            assert (len(p), len(m)) == (prefix, middle)
            assert output == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
        else:
            assert output == text


def test_rope_counts_and_long_units():
    text = "日" * 50_000 + " \n" * 9000 + "end  "
    whole = fim.rope(text)
    assert (whole.units, whole.chars, fim.written(whole)) == (len(UNITS.findall(text)), len(text), text)
    for rank, by in ((0, "units"), (2, "units"), (3, "units"), (0, "chars"), (49_999, "chars"), (len(text), "chars")):
        left, right = fim.split(whole, rank, by)
        assert fim.written(left) + fim.written(right) == text
        assert (getattr(left, by) if left else 0) == rank
    assert fim.rope("") is None and fim.split(None, 0) == (None, None)


def test_transform_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "has <M> in it " * 9), (None, "one two  three"), (4, "one two  three"), (4, "one two  three"), (5, " \n ")] + [(k, "a b c d e f " * k) for k in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as id", "'y' as output", "'z' as form", "1 as n", "2 as h1")
    got = fim.restore(fim.transform(docs)).collect()
    assert sorted((r["id"] is None, r["id"] or 0, r["restored"]) for r in got) == sorted((i is None, i or 0, t or "") for i, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"} and all(r["form"] == "plain" for r in got if r["id"] in (1, 2, 3))
    assert all((r["prefix_chars"] is None) == (r["form"] == "plain") for r in got)
    assert fim.restore(fim.transform(docs.limit(0))).count() == 0


def nearest(rows, k=10, every=100):
    """All distances: (query's row, place) -> (id, score)."""
    fine = [(i, v, at) for at, (i, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v, at in fine:
        if i is not None and i % every == 0:
            others = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j is None, j or 0) for j, w, b in fine if b != at and len(w) == len(v))
            out.append((i, [(s, None if none else j) for s, none, j in others[:k]]))
    return out


def found(df):
    lists = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append((r["score"], r["id"]))
        assert r["rank"] == len(lists[r["query_id"]])
    return lists


def test_neighbours_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "shard_size", lambda n, size: 100)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 16)) * 4
    x = centre[rng.integers(12, size=2400)] + rng.normal(size=(2400, 16))
    x[::3] = x[3]  # a third are copies
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = found(hnsw.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)))
    want = nearest(rows)
    assert sorted(got) == [i for i, _ in want]
    same = [len({j for _, j in got[i]} & {j for _, j in w}) / 10 for i, w in want]
    assert np.mean(same) >= 0.97
    for i, w in want:
        assert len(got[i]) == 10 and i not in {j for _, j in got[i]}
        for s, j in got[i]:
            assert s == pytest.approx(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), abs=1e-12)
        if i % 3 == 0:
            assert got[i] == [(0.0, 3 * k) for k in range(12) if 3 * k != i][:10]


def test_neighbours_bounds_are_safe():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(800, 6)) + 5 * rng.integers(3, size=(800, 1))
    from convolake.operators import cells

    centres = cells.fit(x, 20)
    cell, far = cells.nearest(x, centres)
    routing = hnsw.Routing({6: centres})
    for c in range(len(centres)):
        if (cell == c).any():
            routing.add(6, c, int((cell == c).sum()), float(far[cell == c].max()))
    bounds = routing.bounds(x[:100], cell[:100])
    true = np.sqrt(((x[:100, None] - x[None]) ** 2).sum(2))
    skipped = 0
    for c in np.unique(cell):
        least = true[:, cell == c].min(1)
        other = cell[:100] != c
        assert (bounds[other, c] <= least[other] + 1e-9).all()
        skipped += (bounds[other, c] > 2).sum()
    assert skipped > 100


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.0, 2.0]), (None, [1.0, 0.0]), (7, None), (200, []), (300, [0.0, 0.0]), (400, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [1.0, 0.0, 3.0]), (500, [1.0, 0.0, 4.0]), (5, [-0.0, 2.0]), (6, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "2 as score", "3 as id", "4 as v", "5 as h")
    got = hnsw.nearest_neighbours(df).collect()
    by = lambda i: sorted((r["score"], r["id"] is None, r["id"] or 0) for r in got if r["query_id"] == i)
    want = {}
    for i, w in nearest([(i, [x + 0.0 if x is not None else x for x in v] if v else v) for i, v in rows]):
        want.setdefault(i, []).extend((s, j is None, j or 0) for s, j in w)
    assert {r["query_id"] for r in got} == set(want)
    for i, w in want.items():
        assert [x[1:] for x in by(i)] == [x[1:] for x in sorted(w)] and [x[0] for x in by(i)] == pytest.approx([x[0] for x in sorted(w)])
    assert hnsw.nearest_neighbours(df.limit(0)).count() == 0


def test_graph_recall_and_storage():
    x = np.random.default_rng(1).normal(size=(1500, 32))
    graph = hnsw.Graph(x)
    ids, _ = graph.search(x[:100], 64)
    true = np.argsort(((x[:100, None] - x[None]) ** 2).sum(2), 1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(true, ids)]) >= 0.95
    again = hnsw.Graph.loaded(x, *graph.stored())
    assert all((a == b).all() for a, b in zip(graph.links, again.links)) and len(again.links) == len(graph.links)


GRAMMAR = re.compile(r"(s?(ua)+)?")


def all_edits(initials, gone, cut):
    """The cheapest of all edits up to the cost of deleting everything."""
    n, out = len(initials), []

    def rec(k, cost, audit, roles):
        if cost > 4 * n:
            return
        if k == n and GRAMMAR.fullmatch(roles):
            out.append((cost, audit))
        for r in "ua":
            rec(k, cost + 3, audit + "I", roles + r)
        if k < n:
            rec(k + 1, cost + 4, audit + "D", roles)
            if not gone[k]:
                charge = 3 if cut[k] else 0
                for r in "ua":
                    rec(k + 1, cost + 3 + charge, audit + "R", roles + r)
                rec(k + 1, cost + charge, audit + "K", roles + initials[k])

    rec(0, 0, "", "")
    return min(out)


def test_cheapest_against_all_edits():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randint(0, 4)
        row = [rng.choice(["u", "u", "a", "s", "t", " ", ""]) for _ in range(n)], [rng.random() < 0.2 for _ in range(n)], [rng.random() < 0.3 for _ in range(n)]
        assert talk.cheapest(*row) == all_edits(*row), row


def test_long_audits_compare():
    rng = random.Random(3)
    row = [rng.choice("uas") for _ in range(30_000)], [rng.random() < 0.1 for _ in range(30_000)], [rng.random() < 0.3 for _ in range(30_000)]
    cost, audit = talk.cheapest(*row)
    # The plain way: the best (cost, audit) of each state, row by row.
    best = {0: (0, "")}
    close = lambda best: min_of([(s, x) for s, x in best.items()] + [(t, (c + 3 * k, a + "I" * k)) for s, (c, a) in best.items() for t, k in {0: ((2, 1), (3, 2)), 1: ((2, 1), (3, 2)), 2: ((3, 1),), 3: ((2, 1),)}[s]])

    def min_of(pairs):
        out = {}
        for s, x in pairs:
            out[s] = min(out.get(s, x), x)
        return out

    few = [r[:400] for r in row]
    for i, gone, cut in zip(*few):
        steps = [(s, (c + 4, a + "D")) for s, (c, a) in close(best).items()]
        if not gone:
            for s, (c, a) in close(best).items():
                steps.append(((2, 2, 3, 2)[s], (c + 3 + 3 * cut, a + "R")))
                kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[s].get(i)
                if kept is not None:
                    steps.append((kept, (c + 3 * cut, a + "K")))
        best = min_of(steps)
    assert talk.cheapest(*few) == min(x for s, x in close(best).items() if s in (0, 3))
    assert len(audit.replace("I", "")) == 30_000 and cost <= 4 * 30_000


def plainly(rows):
    """The contract, one conversation after the other; ties of turn by role (tests have no others)."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        pairs = list(itertools.pairwise(r[1][:1] for r in kept))
        cost, audit = talk.cheapest([r[1][:1] for r in kept], [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        lines, k, roles = [], 0, ""
        for e in audit:
            due = "assistant" if roles[-1:] == "u" else "user"
            if e == "I":
                lines.append(due + ":")
                roles += due[0]
                continue
            if e != "D":
                name = due if e == "R" else kept[k][1]
                lines.append(f"{name}:{kept[k][2]}")
                roles += name[:1]
            k += 1
        assert GRAMMAR.fullmatch(roles)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_repairs_against_the_contract(spark, tmp_path):
    rng = random.Random(9)
    texts = ["Hi.", "What?", "no end", " \n", None, "Yes!  \n", "a.b", "é…", "ok. ", "x "]
    rows = [(rng.choice([None, *range(120)]) if k % 9 else 1000 + k // 2, k if k % 9 else None, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rng.choice(texts)) for k in range(1500)]
    rows += [(500, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}." if k % 7 else "cut") for k in range(3000)]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as h", "2 as audit", "3 as copies", "4 as position").repartition(5).write.parquet(f"{folder}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in talk.query(spark, folder).collect()}
    assert got == plainly(rows)


def test_repaired_rows(spark):
    rows = talk.damage(spark.createDataFrame([(7, 0, "user", "One."), (7, 2, "user", "Two."), (8, 0, "assistant", "A.")], "conv_id long, turn long, role string, text string"))
    edits = talk.repairs(rows)
    got = sorted(talk.repaired(rows, edits).collect())
    assert [r["position"] for r in got if r["conv_id"] == 7] == list(range(len([r for r in got if r["conv_id"] == 7])))
    assert all("".join(r["role"][0] for r in got if r["conv_id"] == c) in ("", "ua", "uaua") for c in (7, 8))
    assert talk.repairs(rows.limit(0)).count() == 0
