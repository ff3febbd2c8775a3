"""Quality classifier: kernel ridge regression on document statistics by random Fourier features, calibrated isotonically.

Statistics of the whole text (sizes, shares of character classes, repetition) are standardised with means and deviations
over all documents (values more than five deviations away count as five), mapped to cosines of random projections (a Gaussian kernel), and fitted to labels by normal equations
that each partition sums on its own. Raw scores of the training rows are counted in fixed bins, made monotone by pooling
adjacent violators, and read by linear interpolation, so a score is the share of good documents at its raw value.

Labels come from rows whose crc32(id as text) mod 4 is not 2; a label that repeats with different values counts as their
mean. Null texts are empty; empty texts have statistics (zeros) and a score too. Without any label all scores are 0.5.
Rows that repeat give repeated rows; null ids keep their row and are never held out; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD = 0.7
BINS = 4096
_CLASS = np.zeros((256, 9))
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".,;:'\"-()", b"!?", b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256)))):
    _CLASS[list(_bytes), _k] = 1

STATISTICS = (
    "log bytes", "log words", "log lines", "upper", "lower", "digits", "spaces", "line ends", "punctuation", "exclamation", "symbols", "non-ASCII", "bytes a word",
    "distinct words", "commonest word", "distinct lines", "bytes a line", "log longest word", "stops a word", "words with a symbol", "one-byte words",
)


def statistics(text: bytes) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / n
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    m, counts = max(1, len(words)), Counter(words)
    sizes = [len(w) for w in counts]
    marked = sum(c for w, c in counts.items() if w[-1] in b"!?#$%&*|<>{}=~^")
    stops = sum(c for w, c in counts.items() if w[-1] in b".!?")
    single = sum(c for w, c in counts.items() if len(w) == 1)
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), *shares, n / m,
        len(counts) / m, max(counts.values(), default=0) / m, len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))), np.log1p(max(sizes, default=0)), stops / m, marked / m, single / m,
    ]


class Features:
    """Standardised statistics, their linear terms and cosines of random projections."""

    def __init__(self, mean: list[float], deviation: list[float], cosines: int = 192, width: float = 1.0, seed: int = 8):
        rng, d = np.random.default_rng(seed), len(STATISTICS)
        self.mean, self.deviation = np.array(mean, float), np.maximum(np.array(deviation, float), 1e-6)
        self.turn, self.shift = rng.normal(size=(d, cosines)) / (width * np.sqrt(d)), rng.uniform(0, 2 * np.pi, cosines)
        self.size = 1 + d + cosines

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -5, 5)
        wave = np.sqrt(2 / len(self.shift)) * np.cos(z @ self.turn + self.shift)
        return np.concatenate([np.ones((len(z), 1)), 0.1 * z, wave], 1)


def pool(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest non-decreasing values, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


class Model:
    """Features, ridge weights, and the calibration's knots."""

    def __init__(self, features: Features | None = None, weights: np.ndarray | None = None):
        self.features, self.weights = features, weights
        self.knots, self.levels = np.array([0.0]), np.array([0.5])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None else self.features(x) @ self.weights

    @staticmethod
    def bins(raw: np.ndarray) -> np.ndarray:
        return np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)

    def calibrate(self, bins: list[tuple[int, float, float]]) -> None:
        """bins: (bin, rows, sum of labels)."""
        if bins:
            at, n, good = (np.array(x, float) for x in zip(*sorted(bins)))
            level = pool(good / n, n)
            # One knot a pooled block, at the mean raw value of its rows.
            edge = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
            middle = (at + 0.5) * 2 / BINS - 0.5
            self.knots = np.add.reduceat(middle * n, edge) / np.add.reduceat(n, edge)
            self.levels = level[edge]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def _array(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(STATISTICS))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))], ["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, x array<double>")


def _remainder(column: str, by: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def fit(stats: DataFrame, labels: DataFrame, ridge: float = 1e-4) -> Model:
    """stats: (id, x) of all documents; labels: (doc_id, quality)."""
    d = len(STATISTICS)
    moments = stats.agg(*[f(F.col("x")[k]) for f in (F.avg, F.stddev_pop) for k in range(d)]).first()
    known = labels.where("quality is not null and doc_id is not null").where(_remainder("doc_id", 4) != 2).groupBy(F.col("doc_id").alias("id")).agg(F.avg("quality").alias("y"))
    train = common.stored(stats.join(known, "id").select("x", "y"), "quality-train")
    if moments[0] is None or train.isEmpty():
        return Model()
    features = Features(moments[:d], moments[d:])

    def sums(batches):
        from pyspark import TaskContext

        a, b, n = np.zeros((features.size, features.size)), np.zeros(features.size), 0
        for batch in batches:
            f = features(_array(batch.column("x")))
            a, b, n = a + f.T @ f, b + f.T @ np.asarray(batch.column("y")), n + len(f)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 32], pa.int32()), pa.array([np.append(a.ravel(), [*b, n]).tobytes()], pa.binary())], ["slot", "sums"])

    def add(batches):
        total = None
        for batch in batches:
            for sums_ in batch.column("sums").to_pylist():
                total = np.frombuffer(sums_) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    # Sums are added one by one where their slot is, so no task holds more than one; the driver gets one row a slot.
    parts = train.mapInArrow(sums, "slot int, sums binary").repartition("slot").mapInArrow(add, "sums binary")
    total = sum(np.frombuffer(r[0]) for r in parts.toLocalIterator())
    size = features.size
    a, b, n = total[: size * size].reshape(size, size), total[size * size : -1], total[-1]
    model = Model(features, np.linalg.solve(a / n + ridge * np.eye(size), b / n))

    def binned(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.bins(model.raw(_array(batch.column("x"))))), batch.column("y")], ["bin", "y"])

    counts = train.mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.count("*"), F.sum("y")).collect()
    model.calibrate([tuple(r) for r in counts])
    common.drop_stored(train)
    return model


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of docs."""
    stats = common.stored(with_statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(_array(batch.column("x"))))], ["id", "score"])

    return stats.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    found = scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    held = F.coalesce(_remainder("id", 4) == 2, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents that score THRESHOLD or more stay, unchanged. Texts are not shuffled.

    Without labels nothing is known of any document, and all stay.
    """
    stats = common.stored(with_statistics(docs), "quality-stats")
    model = fit(stats, labels)
    common.drop_stored(stats)
    if model.weights is None:
        return docs

    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch, "text"):
                yield part.filter(pa.array(model.score(np.array([statistics(t) for t in texts])) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
