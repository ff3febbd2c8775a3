"""Classifiers: held-out accuracy on the driver's documents, parts against plain arithmetic, and odd rows."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from convolake.llm import op3_toxicity as op3
from convolake.llm import op8_quality as op8

DATA = "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def ranked_right(score, label):
    good, bad = score[label == 1], score[label == 0]
    return (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2


def held_out(spark, query, label):
    got = query(spark, DATA).where("held_out").join(spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", label), "doc_id").toPandas()
    return got["score"].to_numpy(), got["predicted"].to_numpy(), got[label].to_numpy()


@needs_data
def test_toxicity_on_held_out_documents(spark):
    score, predicted, label = held_out(spark, op3.query, "toxic")
    assert ranked_right(score, label) > 0.95 and (predicted == label).mean() > 0.95


@needs_data
def test_quality_on_held_out_documents(spark):
    score, predicted, label = held_out(spark, op8.query, "quality")
    assert ranked_right(score, label) > 0.97 and (predicted == label).mean() > 0.97


def small(spark):
    bad = ["you idiot you utter clown " + "x " * k for k in range(30)]
    good = ["what a fine day it is today " + "y " * k for k in range(30)]
    docs = list(enumerate(bad + good)) + [(900, None), (901, ""), (None, "no id"), (5, bad[5]), (902, "der hund " * 30_000)]
    labels = [(k, int(k >= 30), int(k < 30)) for k in range(60)] + [(5, None, None), (None, 1, 1), (777, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "id": F.lit("clash"), "x": F.lit(1)})
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs


def test_odd_rows(spark):
    d, y, docs = small(spark)
    for found in (op3.scored(d, y), op8.scores(d, y)):
        rows = found.collect()
        assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
        by = {}
        for r in rows:
            by.setdefault(r["id"], []).append(r["score"])
        assert len(by[5]) == 2 and by[5][0] == by[5][1] and by[900] == by[901]
    none = y.limit(0)
    assert {r["score"] for r in op3.scored(d, none).collect()} == {0.0}
    assert {r["score"] for r in op8.scores(d, none).collect()} == {0.5}
    assert op3.scored(d.limit(0), y).count() == 0 and op8.scores(d.limit(0), y).count() == 0
    kept = op8.keep_good(d, y)
    assert kept.columns == d.columns and kept.count() <= len(docs)
    assert op8.keep_good(d, none).count() == len(docs) and op8.keep_good(d.limit(0), y).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    d, y, _ = small(spark)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turned = y.withColumn("toxic", F.when(crc % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", F.when(crc % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(op8.scores(d, y).collect(), key=str) == sorted(op8.scores(d, turned).collect(), key=str)
    assert sorted(op3.scored(d, y).collect(), key=str) == sorted(op3.scored(d, turned).collect(), key=str)


def test_pooled_filters_equal_loops():
    net = op3.Network(buckets=64, depth=3, filters=2)
    texts = [b"a b c d e", b"", b"one", b"a b"]
    v = op3.Vocabulary(64)
    flat, starts, ends = op3.layout(texts, v)
    rows = np.array(v.rows)
    x = net.embedding[rows[:, 0]] + net.embedding[rows[:, 1]]
    got = net.pooled(x, flat, starts, ends)
    for d, (a, b) in enumerate(zip(starts, ends)):
        want = []
        for kernel in net.kernels:
            each = [sum(x[flat[i + k]] @ kernel[k] for k in range(len(kernel))) for i in range(a, b)]
            want += list(np.maximum(np.max(each, axis=0), 0))
        assert np.allclose(got[d], want, atol=1e-5)


def test_pooling_of_violators():
    assert np.allclose(op8.pool(np.array([1, 3, 2, 2, 5, 4.0]), np.array([1, 1, 1, 2, 1, 3.0])), [1, 2.25, 2.25, 2.25, 4.25, 4.25])
    m = op8.Model()
    m.calibrate([(10, 4, 0), (20, 4, 4)])
    assert m.levels.tolist() == [0, 1]


def test_kernel_is_close_to_gaussian():
    rng = np.random.default_rng(1)
    f = op8.Features([0] * len(op8.STATISTICS), [1] * len(op8.STATISTICS), cosines=20_000)
    x = rng.normal(size=(6, len(op8.STATISTICS)))
    waves = f(x)[:, 1 + len(op8.STATISTICS) :]
    want = np.exp(-((x[:, None] - x) ** 2).sum(2) / (2 * len(op8.STATISTICS)))
    assert np.allclose(waves @ waves.T, want, atol=0.05)


def test_gradients_equal_differences():
    net = op3.Network(buckets=8, depth=3, filters=2, seed=1)
    for name in ("embedding", "bias", "out"):
        setattr(net, name, getattr(net, name).astype(float))
    net.kernels = [k.astype(float) for k in net.kernels]
    net.base = float(net.base)
    rng = np.random.default_rng(2)
    sizes, y, importance = np.array([4, 1, 6]), np.array([1, 0, 1]), np.array([0.5, 2.0, 1.0])
    buckets = np.concatenate([x for n in sizes for x in (np.stack([rng.integers(1, 9, n), rng.integers(9, 17, n)], 1), np.zeros((2, 2), int))])

    def loss():
        total, at = 0.0, 0
        for n, label, w in zip(sizes, y, importance):
            x = net.embedding[buckets[at : at + n + 2, 0]] + net.embedding[buckets[at : at + n + 2, 1]]
            h = [max(sum(x[i + k] @ kernel[k][:, f] for k in range(len(kernel))) for i in range(n)) for kernel in net.kernels for f in range(net.filters)]
            z = np.maximum(np.array(h) + net.bias, 0) @ net.out + net.base
            total -= w * np.log(1 / (1 + np.exp(-z)) if label else 1 - 1 / (1 + np.exp(-z)))
            at += n + 2
        return total / len(sizes)

    got = op3.gradients(net, buckets, sizes, y, importance)
    unique, grad = got.pop("embedding")
    full = np.zeros_like(net.embedding)
    full[unique] = grad
    for value, want in [(net.embedding, full), (net.out, got["out"]), (net.bias, got["bias"]), *((k, got[f"kernel{w}"]) for w, k in enumerate(net.kernels))]:
        for at in np.ndindex(value.shape):
            if value is net.embedding and at[0] == 0:
                continue
            old, sides = value[at], []
            for step in (1e-6, -1e-6):
                value[at] = old + step
                sides.append(loss())
            value[at] = old
            assert (sides[0] - sides[1]) / 2e-6 == pytest.approx(want[at], abs=1e-6)


def test_thresholds_are_the_best_cuts():
    rng = np.random.default_rng(3)
    counts = [(lang, int(b), int(y), int(n)) for lang in (0, 1, 4) for b, y, n in zip(rng.integers(-50, 50, 60), rng.integers(0, 2, 60), rng.integers(1, 9, 60))] + [(2, 5, 1, 1), (2, 3, 0, 90)]
    net = op3.Network(buckets=4, depth=2, filters=1)
    op3.calibrate(net, counts)

    def f1(rows, cut):
        hit = sum(n for _, b, y, n in rows if y and b * op3.STEP >= cut)
        return 2 * hit / (sum(n for _, b, _, n in rows if b * op3.STEP >= cut) + sum(n for *_, y, n in rows if y))

    for k in range(len(op3.LANGUAGES)):
        rows = [c for c in counts if c[0] == k] if k in (0, 1, 4) else counts  # few of a class: all
        assert f1(rows, net.threshold[k]) == pytest.approx(max(f1(rows, b * op3.STEP) for _, b, _, _ in rows))


def test_toxicity_is_trained_on_a_bounded_sample(spark):
    d, y, _ = small(spark)
    many = d.unionByName(d).unionByName(d.withColumn("doc_id", F.col("doc_id") + 10_000))
    assert op3.learn(many, y)[0].embedding.tolist() == op3.learn(d, y)[0].embedding.tolist()  # copies of a row count once
    assert op3.learn(d, y, words=16) is None  # no document fits


def test_quality_equals_a_plain_fit(spark):
    d, y, docs = small(spark)
    labels = {}
    for k, q, _ in y.collect():
        if k is not None and q is not None and zlib.crc32(str(k).encode()) % 4 != 2:
            labels.setdefault(k, []).append(q)
    x = np.array([op8.statistics((t or "").encode()) for _, t in docs])
    features = op8.Features(x.mean(0), x.std(0))
    train = [(x[k], np.mean(labels[i])) for k, (i, _) in enumerate(docs) if i in labels]
    f, want = features(np.array([t[0] for t in train])), np.array([t[1] for t in train])
    weights = np.linalg.lstsq(np.concatenate([f, np.sqrt(1e-4 * len(f)) * np.eye(f.shape[1])]), np.concatenate([want, np.zeros(f.shape[1])]), rcond=None)[0]
    assert op8.fit(op8.with_statistics(d), y).weights == pytest.approx(weights, abs=1e-6)
    # Calibration: in each bin the mean label; means that fall are merged, whole blocks at a time.
    raw = f @ weights
    blocks = [([(b + 0.5) * 2 / op8.BINS - 0.5] * n, ys) for b in sorted(set(op8.Model.bins(raw).tolist())) for ys in [want[op8.Model.bins(raw) == b].tolist()] for n in [len(ys)]]
    k = 0
    while k + 1 < len(blocks):
        if np.mean(blocks[k][1]) >= np.mean(blocks[k + 1][1]):
            blocks[k : k + 2] = [tuple(p + q for p, q in zip(blocks[k], blocks[k + 1]))]
            k = max(0, k - 1)
        else:
            k += 1
    scores = np.interp(features(x) @ weights, [np.mean(b[0]) for b in blocks], [np.mean(b[1]) for b in blocks])
    got = {(r["id"], round(r["score"], 5)) for r in op8.scores(d, y).collect()}
    assert got == {(i, round(float(s), 5)) for (i, _), s in zip(docs, scores)}
