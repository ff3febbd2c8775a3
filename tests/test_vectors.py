"""Pruned cosine pairs against all pairs, and the inverted file against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convolake.operators import cells, pruning, similarity
from convolake.sources import vector_index
from convolake.storage import new_path

SCHEMA = "id long, embedding array<double>, domain int"


def clustered(n=1500, d=12, groups=15, spread=0.12, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, d))
    return centre[rng.integers(groups, size=n)] / np.sqrt(d) + spread * rng.normal(size=(n, d)) / np.sqrt(d)


def frame(spark, x, extra=()):
    return spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)] + list(extra), SCHEMA).repartition(5)


def pairs(df):
    return {(r["a"], r["b"]): pytest.approx(r["score"], abs=1e-9) for r in df.collect()}


@pytest.mark.parametrize("kind", ["clusters", "copies", "noise"])
def test_pruned_pairs(spark, kind):
    x = clustered() if kind != "noise" else np.random.default_rng(1).normal(size=(800, 12))
    if kind == "copies":
        x[::3] = x[0] * np.linspace(1, 5, len(x[::3]))[:, None]  # a third point the same way
    rows = frame(spark, x, [(9000, [0.0] * 12, 0), (9001, None, 0)])
    got, compared, blocks = pruning.pruned_pairs(rows, 0.95 if kind != "noise" else 0.7, rows=60)
    assert pairs(got) == pairs(similarity.cosine_pairs(rows, 0.95 if kind != "noise" else 0.7))
    assert blocks >= 100 and compared <= blocks
    if kind == "clusters":
        assert compared < blocks / 3, (compared, blocks)
    print(kind, compared, "of", blocks, "pairs of blocks")


def test_vectors_are_sent_by_groups_of_blocks(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(700, 12)).astype(np.float32)
    rows = spark.createDataFrame([(k, v.tolist(), k % 3) for k, v in enumerate(x)], "id long, embedding array<float>, domain int")
    sent, plain = [], similarity.block_pairs
    monkeypatch.setattr(similarity, "block_pairs", lambda dealt, *a, **k: sent.append((dealt.count(), dict(dealt.dtypes)["v"])) or plain(dealt, *a, **k))
    got = similarity.cosine_pairs(rows, 0.5, rows=7).collect()
    assert sent == [(sent[0][0], "array<float>")] and sent[0][0] <= 16 * 700  # not once for each of the 100 blocks
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(u @ u.T, 1) >= 0.5))}
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)
    few = similarity.cosine_pairs(rows, 0.5, rows=7, first=2)
    assert few.count() < len(got)
    top = lambda p: {(r["a"], r["b"]) for r in similarity.greedy_top_k(p, 2).collect()}
    assert top(few) == top(spark.createDataFrame(got))


def test_pruned_pairs_of_nothing(spark):
    rows = frame(spark, clustered(5))
    assert pruning.pruned_pairs(rows.limit(0), 0.5)[0].count() == 0
    assert pruning.pruned_pairs(spark.createDataFrame([(1, [0.0, 0.0], 0)], SCHEMA), 0.5)[0].count() == 0
    with pytest.raises(ValueError, match="above 0"):
        pruning.pruned_pairs(rows, 0.0)


def test_blocks_keep_their_pairs_together():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivot = x[:6]
    angle = np.arccos(np.clip(x @ pivot.T, -1, 1))
    cell = angle.argmin(1)
    bin_ = (angle[np.arange(400), cell] / np.pi * pruning.BINS).astype(int)
    keys = sorted(set(zip(cell.tolist(), bin_.tolist())))
    inside = [(cell == c) & (bin_ == b) for c, b in keys]
    blocks = pruning.Blocks([(c, b, int(m.sum())) for (c, b), m in zip(keys, inside)], np.array([angle[m].min(0) for m in inside]), np.array([angle[m].max(0) for m in inside]), 20)
    meeting = blocks.meeting(np.arccos(0.9))
    of = np.array([blocks.of[c, b][0] for c, b in zip(cell.tolist(), bin_.tolist())])
    assert np.bincount(of).max() <= 20
    for i, j in zip(*np.nonzero(x @ x.T >= 0.9)):
        assert of[j] in meeting[of[i]]
    assert sum(map(len, meeting)) < len(meeting) ** 2


def brute(x, q, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    score = u[q] @ u.T
    score[np.arange(len(q)), q] = -np.inf
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), score.shape), -np.round(score, 12)))[:, :k]
    return {int(i): o.tolist() for i, o in zip(q, order)}


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["q"], r["rank"])):
        out.setdefault(r["q"], []).append(r["id"])
    return out


def test_index_exact_and_recall(spark):
    x = clustered(3000, spread=0.3)
    rows, path = frame(spark, x, [(9000, [0.0] * 12, 0), (9001, None, 0), (9002, [float("nan")] * 12, 0)]), new_path(spark, "index")
    vector_index.build(rows, path, rows=50)
    index = vector_index.Index(spark, path)  # as a later session would open it
    assert index.vectors.count() == 3000 and max(r["count"] for r in index.vectors.groupBy("part").count().collect()) < 150
    q = np.arange(0, 3000, 100)
    asked, want = rows.where("id % 100 = 0 or id >= 9000"), brute(x, q, 10)
    assert lists(index.search(asked, 10)) == want
    found = lists(index.search(asked, 10, probes=6))
    recall = np.mean([len(set(found[i]) & set(w)) / 10 for i, w in want.items()])
    print("recall with 6 of", len(index.layout.centre), "cells:", recall)
    assert recall >= 0.9


def test_index_small_and_empty(spark):
    path = new_path(spark, "index")
    rows = frame(spark, np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]]))
    vector_index.build(rows, path)
    assert lists(vector_index.Index(spark, path).search(rows, 5)) == {0: [1, 2], 1: [0, 2], 2: [0, 1]}
    vector_index.build(rows.limit(0), path)
    assert vector_index.Index(spark, path).search(rows, 5).count() == 0


def test_cells(spark):
    x = clustered(500)
    df = spark.createDataFrame([(v.tolist(),) for v in x] * 3, "v array<double>")
    a, b = (cells.sample(df.repartition(n), 1500, 12, rows=100) for n in (2, 9))
    assert (a == b).all() and 20 <= len(a) <= 100 and len(np.unique(a, axis=0)) == len(a)
    centre = cells.fit(x, 40)
    cell, far = cells.nearest(x, centre)
    true = np.sqrt(((x[:, None] - centre[None]) ** 2).sum(2))
    assert np.allclose(far, true.min(1)) and len(centre) == 40
    assert len(cells.fit(np.ones((3, 2)), 8)) == 3


def test_index_sends_questions_by_groups(spark):
    # Noise, so bounds exclude nothing, and copies, whose ties go to the smaller id.
    x = np.random.default_rng(5).normal(size=(2000, 12))
    x[1000:1040] = x[7]
    path = new_path(spark, "index")
    vector_index.build(frame(spark, x), path, cell_rows=10)
    index = vector_index.Index(spark, path)
    layout = index.layout
    assert len(layout.cell) > 100 and len(layout.edges) - 1 <= 16 and layout.edges[-1] == len(layout.cell)
    batch = pa.RecordBatch.from_pydict({"id": range(256), "v": x[:256].tolist(), "within": [np.inf] * 256})
    sent = sum(b.num_rows for b in layout.sent(lambda q, _: np.ones((len(q), len(layout.centre)), bool))([batch]))
    assert sent <= 16 * 256  # one row a part before
    q = np.array([0, 7, 1005, 1999, *range(20, 400, 20)])
    asked = frame(spark, x).where(F.col("id").isin(q.tolist()))
    assert lists(index.search(asked, 10)) == brute(x, q, 10)
