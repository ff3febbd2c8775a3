"""Cross-entropy differences against dictionaries of counts."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convolake.llm import op2_cross_entropy as op2


def test_equals_plain_counts(spark):
    docs = [(1, "The cat sat on the mat"), (2, "the dog SAT"), (3, None), (4, ""), (5, "Été été zebra " * 400), (6, "the cat"), (None, "the cat"), (6, "the cat")]
    labels = [(1, 1, 0), (2, 0, 0), (6, 1, 0), (6, None, 0), (7, 1, 1), (None, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good = {1, 6}
    split = [(i, (t or "").lower().split()) for i, t in docs]
    loss = []
    for keep in (lambda i: i in good, lambda i: True):
        one, before, two = Counter(), Counter(), Counter()
        for i, w in split:
            if keep(i):
                one.update(w)
                before.update(["^", *w[:-1]] if w else [])
                two.update(zip(["^", *w], w))
        n = sum(one.values())
        back, flat = max(1e-5 * n, 1), max(1e-7 * n, 0.01)
        loss.append(lambda a, b, one=one, before=before, two=two, n=n, back=back, flat=flat: -math.log((two[a, b] + back * (one[b] + flat) / (n + flat * op2.WORDS)) / (before[a] + back)))
    want = sorted(((i, len(w), *(sum(f(a, b) for a, b in zip(["^", *w], w)) / max(1, len(w)) for f in loss)) for i, w in split), key=str)
    got = sorted((tuple(r) for r in op2.scores(d, y).collect()), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[2:4] == pytest.approx(w[2:], rel=1e-6) and g[4] == pytest.approx(w[2] - w[3], abs=1e-6)
    assert got[0][4] < 0


def test_no_targets_and_empty(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    y = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op2.scores(d, y).first()["n_tokens"] == 2
    assert op2.scores(d.limit(0), y).count() == 0


def test_words_of_one_hash_are_told_apart(spark):
    """Words of one crc32 (as buckets had it), with chunks of a few bytes: every n-gram keeps its own counts."""
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    docs = [(k, "plumless tea") for k in range(8)] + [(8, "buckeroo tea"), (9, "plumless buckeroo")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame([(k, 1, 0) for k in range(8)], "doc_id long, quality int, toxic int")
    whole = {r["id"]: tuple(r)[1:] for r in op2.scores(d, y).collect()}
    parted = {r["id"]: tuple(r)[1:] for r in op2.scores(d, y, share=20).collect()}
    assert whole.keys() == parted.keys() and all(parted[k] == pytest.approx(whole[k], rel=1e-9) for k in whole)
    assert whole[0][3] < 0 < whole[8][3]
    first = lambda n, k: -math.log((k + (k + 0.01) / (2 * n + 0.01 * op2.WORDS)) / (n + 1))
    after = lambda n, k: -math.log((k + (k + 0.01) / (2 * n + 0.01 * op2.WORDS)) / (k + 1))
    assert whole[0][1] == pytest.approx((first(8, 8) + after(8, 8)) / 2, rel=1e-6)


def test_messages_grow_with_chunks_not_their_square(spark):
    """Hundreds of chunks of some hundred bytes, on three levels: the scores of one chunk, and few messages a unit."""
    words = [f"w{k % 97} v{k % 13} the" for k in range(2000)]
    docs = [(k, f"{words[k % 2000]} {words[(k * 7) % 2000]}" if k % 50 else None) for k in range(1200)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame([(k, 1, 0) for k in range(0, 1200, 3)], "doc_id long, quality int, toxic int")
    whole = {r["id"]: tuple(r)[1:] for r in op2.scores(d, y).collect()}
    parted = {r["id"]: tuple(r)[1:] for r in op2.scores(d, y, share=150, fan=8).collect()}
    assert whole.keys() == parted.keys() and all(parted[k] == pytest.approx(whole[k], rel=1e-9) for k in whole)
    chunks, base, levels = 150, 6, 3
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("long").alias("chunk")
    good = y.select(F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("long").alias("chunk"), F.col("doc_id").alias("good"))
    answers, totals, sent = op2.exchanged(op2.asked(d.select(dealt, F.col("doc_id").alias("id"), "text"), good, base, levels), base, levels)
    for messages in sent:
        assert messages.count() <= base * base**levels and messages.groupBy("sender").count().agg(F.max("count")).first()[0] <= base
    assert answers.count() == sent[0].count() < chunks * chunks / 4
    tokens = [w for _, t in docs for w in (t or "").split()]
    assert totals == (len(tokens), sum(len((t or "").split()) for k, t in docs if k % 3 == 0), len(set(tokens)))
