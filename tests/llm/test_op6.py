"""Embedding near-duplicates against all pairs."""

import numpy as np

from convolake.llm import op6_embedding as op6


def brute(rows, threshold):
    ok = {k: np.array(v, float) / max(map(abs, v)) for k, v in enumerate(x for _, x in rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(ok)
    for p, i in enumerate(keys):
        for j in keys[:p]:
            if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= threshold:
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((rows[k][0], n[k], rows[find(k)][0]) for k in range(len(rows)))


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    vectors = [b + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3]) for b in base for _ in range(6)]
    hot = rng.normal(size=16)
    vectors += [hot * (k + 1) for k in range(30)] + [hot + rng.normal(size=16) * 0.05 for _ in range(150)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    extra = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [1e200, 2e200], rows[0][1]]
    rows += [(1000 + k, v) for k, v in enumerate(extra)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 0.9)
    for most, wide in ((4096, 16_384), (40, 60)):
        got = sorted(tuple(r) for r in op6.near_duplicates(df, 0.9, most=most, wide=wide, miss=1e-5).collect())
        assert got == want


def test_empty_and_lonely(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in op6.near_duplicates(df).collect()), key=str) == [(1, 0, 1), (None, 0, None)]
    assert op6.near_duplicates(df.limit(0)).count() == 0


def test_recall_with_the_querys_parameters(spark):
    """Pairs just at the threshold are the hardest; all parameters are near_duplicates()' own."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(1500, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = np.repeat([0.9005, 0.92, 0.95], 500)[:, None]
    near = base * cosine + side * np.sqrt(1 - cosine**2)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = set(enumerate(((unit @ unit.T >= 0.9).sum(1) - 1).tolist()))
    got = [(r[0], r[1]) for r in op6.near_duplicates(df, 0.9).collect()]
    assert len(got) == len(rows) and sum(x in want for x in got) >= 0.998 * len(rows)
    by_id = dict(want)
    assert all(n <= by_id[i] for i, n in got)
    assert len({r[0] for r in got if by_id[r[0]] == 0 and r[1]}) == 0


def shared(n, cosine, d=64, pairs=100, seed=4):
    """Vectors that share a direction: any two have about this cosine, but for planted near copies."""
    rng = np.random.default_rng(seed)
    x = np.sqrt(1 - cosine) * rng.normal(size=(n, d)) / np.sqrt(d) + np.sqrt(cosine) * np.eye(1, d)
    x[-pairs:] = x[:pairs] + rng.normal(size=(pairs, d)) * np.sqrt((1 / rng.uniform(0.91, 0.99, size=(pairs, 1)) ** 2 - 1) * (x[:pairs] ** 2).sum(1, keepdims=True) / d)
    return x.astype(np.float32)


def test_a_shared_direction_makes_no_candidates(spark):
    """Links equal all pairs, and hardly a vector but the near ones is sent to be compared."""
    x = shared(4000, 0.6)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    assert 150 <= (links > 0).sum() <= 400
    got = {r[0]: r[1] for r in op6.near_duplicates(df, 0.9, miss=1e-5).collect()}
    assert got == dict(enumerate(links.tolist()))
    sketching = op6.Sketching(0.9)
    at = op6.Sketching.coordinates(sketching(unit))
    near = (at**2).sum(1)[:, None] + (at**2).sum(1) - 2 * at @ at.T
    candidates = near <= sketching.most(64)
    assert candidates[unit @ unit.T >= 0.9].mean() > 0.9999
    assert candidates.sum() - len(x) < 3 * links.sum() + 40


def test_sketches_of_other_sizes():
    rng = np.random.default_rng(2)
    for d in (2, 16, 64, 300):
        a = rng.normal(size=(2000, d))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        side = rng.normal(size=a.shape)
        side -= (side * a).sum(1, keepdims=True) * a
        b = a * 0.9 + side / np.linalg.norm(side, axis=1, keepdims=True) * np.sqrt(1 - 0.81)
        sketching = op6.Sketching(0.9)
        apart = ((op6.Sketching.coordinates(sketching(a)) - op6.Sketching.coordinates(sketching(b))) ** 2).sum(1)
        assert (apart <= sketching.most(d)).mean() > 0.998, d
