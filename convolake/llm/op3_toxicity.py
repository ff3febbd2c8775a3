"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of two hashed ones, of the word and of its first letters. Filters of several widths slide
over the words, each keeps its largest value in the document, and a linear layer turns these into a logit. Thresholds
are set by language (guessed from the text's own function words) on documents kept out of the weights' training, and
the score is the logit beyond its language's threshold, so 0.5 is where a document counts as toxic.

Labels come from rows whose crc32(id as text) mod 5 is not 0; weights are trained on a bounded sample of them (see
learn), thresholds are set on all others. Whole texts are trained on and scored. Null and empty texts get the score of
an empty document. Without labels of both classes every score is 0. Rows that repeat give repeated rows; null ids keep their row and are never held out;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTHS = (1, 2, 3)
#: Upper case to lower case, all other ASCII but letters and digits to spaces.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
# Common function words, by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with as by this be are from at",
    "de": "der die und das den von zu mit sich des auf ist im dem nicht ein eine als",
    "fr": "le les et des est une du dans qui pour pas au sur par avec il ce elle",
    "es": "el los y del las por un con una su para como lo al se más pero sus",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
_OF_WORD = {w.encode(): k for k, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()}


class Vocabulary:
    """Hash buckets of words seen so far; rows are (word bucket, prefix bucket, language or -1). Row 0 pads."""

    def __init__(self, buckets: int):
        self.buckets, self.rows, self.place = buckets, [(0, 0, -1)], {}

    def row(self, word: bytes) -> int:
        at = self.place.get(word)
        if at is None:
            at = self.place[word] = len(self.rows)
            head = word.decode("utf-8", "ignore")[:5].encode()
            self.rows.append((1 + zlib.crc32(word) % self.buckets, 1 + self.buckets + zlib.crc32(b"^" + head) % self.buckets, _OF_WORD.get(word, -1)))
        return at


def words(text: bytes) -> list[bytes]:
    return (text if text.isascii() else text.decode().lower().encode()).translate(_KEEP).split()


def layout(texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all words with two pads after each document (and one before an empty one), and starts and ends."""
    flat, starts, ends = [], [], []
    for text in texts:
        starts.append(len(flat))
        row = vocabulary.row
        flat += [row(w) for w in words(text)] or [0]
        ends.append(len(flat))
        flat += (0, 0)
    return np.array(flat, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def guess(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, language_of_row: np.ndarray) -> np.ndarray:
    """Index of LANGUAGES for each document: most function words, if there are any."""
    of = language_of_row[flat]
    counts = np.stack([np.add.reduceat((of == k).astype(np.int32), starts) for k in range(len(FUNCTION_WORDS))], 1)
    return np.where(counts.max(1) > 0, counts.argmax(1), len(FUNCTION_WORDS))


class Network:
    def __init__(self, buckets: int = 1 << 15, depth: int = 16, filters: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.buckets, self.filters = buckets, filters
        self.embedding = rng.normal(0, 0.1, (1 + 2 * buckets, depth)).astype(np.float32)
        self.embedding[0] = 0
        self.kernels = [rng.normal(0, 0.3, (w, depth, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * filters, np.float32)
        self.out = rng.normal(0, 0.2, len(WIDTHS) * filters).astype(np.float32)
        self.base = np.float32(-1.0)
        self.threshold = np.zeros(len(LANGUAGES))

    def pooled(self, vectors: np.ndarray, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each filter's largest value in each document; vectors: the embedding of each vocabulary row."""
        edges = np.stack([starts, ends], 1).ravel()
        found = []
        for kernel in self.kernels:
            # A filter is linear in the words before pooling, so each distinct word meets it once.
            value = (vectors @ kernel[0])[flat]
            for k in range(1, len(kernel)):
                value[:-k] += (vectors @ kernel[k])[flat[k:]]
            found.append(np.maximum.reduceat(value, edges, axis=0)[::2])
        return np.maximum(np.concatenate(found, 1) + self.bias, 0)

    def logits(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
        vectors = self.embedding[rows[:, 0]] + self.embedding[rows[:, 1]]
        return (self.pooled(vectors, flat, starts, ends) @ self.out + self.base).astype(float)

    def judge(self, texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and indices of LANGUAGES."""
        flat, starts, ends = layout(texts, vocabulary)
        rows = np.array(vocabulary.rows)
        used, flat = np.unique(flat, return_inverse=True)
        rows = rows[used]
        return self.logits(flat, starts, ends, rows), guess(flat, starts, ends, rows[:, 2])


def gradients(network: Network, buckets: np.ndarray, sizes: np.ndarray, y: np.ndarray, importance: np.ndarray) -> dict:
    """Of the mean of log losses, each times its importance. buckets: of all words, two pads after each document; sizes without them.

    The embedding's is given for the buckets that occur, without that of the pads.
    """
    starts = np.cumsum(sizes + 2) - sizes - 2
    ends = starts + sizes
    x = network.embedding[buckets[:, 0]] + network.embedding[buckets[:, 1]]
    edges = np.stack([starts, ends], 1).ravel()
    tops, places = [], []
    for kernel in network.kernels:
        value = x @ kernel[0]
        for k in range(1, len(kernel)):
            value[:-k] += x[k:] @ kernel[k]
        tops.append(np.maximum.reduceat(value, edges, axis=0)[::2])
        places.append(np.stack([a + value[a:b].argmax(0) for a, b in zip(starts, ends)]))
    h = np.concatenate(tops, 1) + network.bias
    active = np.maximum(h, 0)
    z = active @ network.out + network.base
    dz = (1 / (1 + np.exp(-z)) - y) * importance / len(sizes)
    dh = dz[:, None] * network.out * (h > 0)
    out = {"out": active.T @ dz, "bias": dh.sum(0), "base": dz.sum()}
    touched, grads = [], []
    for w, kernel in enumerate(network.kernels):
        g, at_word = dh[:, w * network.filters : (w + 1) * network.filters], places[w]
        out[f"kernel{w}"] = np.stack([np.einsum("nfd,nf->df", x[at_word + k], g) for k in range(len(kernel))]).astype(kernel.dtype)
        for k in range(len(kernel)):
            touched.append((at_word + k).ravel())
            grads.append((g[:, :, None] * kernel[k].T).reshape(-1, kernel.shape[1]))
    word, grad = np.concatenate(touched), np.concatenate(grads)
    unique, inverse = np.unique(np.concatenate([buckets[word, 0], buckets[word, 1]]), return_inverse=True)
    total = np.zeros((len(unique), grad.shape[1]), network.embedding.dtype)
    np.add.at(total, inverse, np.concatenate([grad, grad]))
    total[unique == 0] = 0
    return out | {"embedding": (unique, total)}


def train(fit: list[tuple[np.ndarray, int, float]], network: Network, epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 4) -> None:
    """Adam on the weighted log loss. fit: (word and prefix buckets, label, weight)."""
    rng = np.random.default_rng(seed)
    weight = np.array([d[2] for d in fit])
    balance = [1 / max(1e-9, weight[[d[1] == y for d in fit]].sum()) for y in (0, 1)]
    state: dict[str, list[np.ndarray]] = {}
    step = 0

    def adam(name: str, value: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        m, v = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad * grad
        value[at] -= rate * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.99**step)) + 1e-8)

    for epoch in range(epochs):
        rate = rate * 0.7 if epoch else rate
        for at in np.array_split(rng.permutation(len(fit)), max(1, len(fit) // batch)):
            step += 1
            chosen = [fit[k] for k in at]
            pads = np.zeros((2, 2), np.int64)
            buckets = np.concatenate([x for d in chosen for x in (d[0], pads)])
            # Words are left out at random, so that beginnings of words learn too.
            buckets[rng.random(len(buckets)) < 0.3, 0] = 0
            y = np.array([d[1] for d in chosen])
            importance = np.minimum(np.array([d[2] * balance[d[1]] for d in chosen]) * weight.sum() / 2, 8)
            grads = gradients(network, buckets, np.array([len(d[0]) for d in chosen]), y, importance)
            for w, kernel in enumerate(network.kernels):
                adam(f"kernel{w}", kernel, grads[f"kernel{w}"] + 1e-4 * kernel)
            at_bucket, grad = grads["embedding"]
            adam("embedding", network.embedding, grad + 1e-4 * network.embedding[at_bucket], at_bucket)
            adam("out", network.out, grads["out"] + 1e-3 * network.out)
            adam("bias", network.bias, grads["bias"])
            network.base -= np.float32(rate * grads["base"])


#: Logits are counted in bins of this width, between -LIMIT and LIMIT.
STEP, LIMIT = 1 / 256, 40


def best_cut(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Where F1 is best, of (bin, rows with label 0, rows with label 1): the middle of the gap below the last of the best cuts."""
    order = np.argsort(-bins)
    bins, good, bad = bins[order], good[order], bad[order]
    hit, wrong = np.cumsum(bad), np.cumsum(good)
    f1 = 2 * hit / (hit + wrong + bad.sum())
    k = int(np.flatnonzero(f1 >= f1.max() - 1e-12)[-1])
    # A bin's logits lie in [bin, bin + 1) steps.
    return float((bins[k] + (bins[k + 1] + 1 if k + 1 < len(bins) else bins[k])) / 2 * STEP)


def calibrate(network: Network, counts: list[tuple[int, int, int, int]], least: int = 20) -> None:
    """Each language's threshold, or that of all where it has fewer than `least` rows of a class. counts: (language, bin, label, rows)."""
    table = np.array(counts, np.int64).reshape(-1, 4)

    def cut(on: np.ndarray) -> float | None:
        rows = table[on]
        bins, at = np.unique(rows[:, 1], return_inverse=True)
        good, bad = (np.bincount(at, rows[:, 3] * (rows[:, 2] == y), len(bins)) for y in (0, 1))
        return best_cut(bins.astype(float), good, bad) if good.sum() and bad.sum() and min(good.sum(), bad.sum()) >= (least if not on.all() else 1) else None

    general = cut(np.ones(len(table), bool)) if len(table) else None
    for k in range(len(LANGUAGES)):
        own = cut(table[:, 0] == k) if general is not None else None
        network.threshold[k] = general or 0.0 if own is None else own


def _remainder(column: str, by: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def labelled(labels: DataFrame) -> DataFrame:
    """(id, y): one row for each labelled document that isn't held out; labels that repeat count once (toxic, if any is)."""
    known = labels.where("toxic is not null and doc_id is not null").where(_remainder("doc_id", 5) != 0)
    return known.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__y"))


def _drawn(every: dict[int, int]):
    """Whether a labelled document is in the sample that the weights are trained on."""
    return F.pmod(F.xxhash64("__id", F.lit(5)), F.when(F.col("__y") == 1, F.lit(every[1])).otherwise(F.lit(every[0]))) == 0


def _fold():
    """Quarters of the documents; those of fold 0 don't train weights, and so can set thresholds."""
    return F.pmod(F.crc32(F.concat(F.lit("fold"), F.col("__id").cast("string")).cast("binary")), F.lit(4))


def learn(docs: DataFrame, labels: DataFrame, rows: int = 4000, words: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[Network, dict[int, int]] | None:
    """A network trained on a bounded sample, and how the sample was drawn.

    The sample has up to about `rows` labelled documents of each class, by a hash of the id, and `words` words in all: in
    the order of the hash, documents that would exceed it are left out, as is a document of over a sixteenth of it. An id
    that repeats gives one of its texts.
    """
    known = labelled(labels)
    sizes = {int(r[0]): r[1] for r in known.groupBy("__y").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    every = {y: max(1, -(-n // rows)) for y, n in sizes.items()}
    # At most about 2 * rows ids are sent to all tasks.
    drawn = known.where(_drawn(every)).where(_fold() != 0)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), F.col("id") == F.col("__id"))
    network = Network()
    buckets, most = network.buckets, words // 16

    def encode(batches):
        for batch in batches:
            vocabulary = Vocabulary(buckets)
            for part, texts in common.slices(batch, "text"):
                flat, starts, ends = layout(texts, vocabulary)
                table = np.array(vocabulary.rows)
                ids = [table[flat[a:b], :2].astype("<i4").tobytes() if b - a <= most else None for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.string()), part.column("__y").cast(pa.int32()), pa.array((ends - starts).astype(np.int64)), pa.array(ids, pa.binary())], ["id", "y", "n", "ids"])

    encoded = common.stored(chosen.select("id", "text", "__y").mapInArrow(encode, "id string, y int, n long, ids binary"), "toxicity-sample")
    one = encoded.where("ids is not null").groupBy("id").agg(F.max(F.col("y")).alias("y"), F.min(F.struct("n", "ids")).alias("x"))
    # Sizes alone say which documents fit; then only these are fetched.
    listed = sorted((zlib.crc32(b"sample" + i.encode()), i, n) for i, n in one.select("id", "x.n").collect())
    fits, held = [], 0
    for _, i, n in listed:
        if held + n <= words:
            fits.append(i)
            held += n
    table = one.where(F.col("id").isin(fits)) if len(fits) < len(listed) else one
    found = sorted((i, y, bytes(ids)) for i, y, ids in table.select("id", "y", "x.ids").toLocalIterator())
    common.drop_stored(encoded)
    train_on = [(np.frombuffer(ids, "<i4").reshape(-1, 2).astype(np.int64), y, float(every[y])) for _, y, ids in found]
    if {d[1] for d in train_on} != {0, 1}:
        return None
    train(train_on, network)
    return network, every


def logits(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, z, language) for each row of docs: the logit of its whole text, and an index of LANGUAGES."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        model, vocabulary = sent.value, Vocabulary(sent.value.buckets)
        for batch in batches:
            for part, texts in common.slices(batch, "text"):
                if len(vocabulary.rows) > 300_000:
                    vocabulary = Vocabulary(model.buckets)
                z, language = model.judge(texts, vocabulary)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(z), pa.array(language.astype(np.int32))], ["id", "z", "language"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, z double, language int")


def scored(docs: DataFrame, labels: DataFrame, rows: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of docs.

    Weights come from a bounded sample, thresholds from all labelled documents that trained no weights: each row's logit
    is stored, joined to its label by id, and counted by language and bin.
    """
    made = learn(docs, labels, rows, id_col=id_col, text_col=text_col)
    if made is None:
        return docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"))
    network, every = made
    found = common.stored(logits(docs, network, id_col, text_col), "toxicity-logits")
    free = labelled(labels).where(~_drawn(every) | (_fold() == 0))
    bin_ = F.floor(F.greatest(F.least("z", F.lit(LIMIT)), F.lit(-LIMIT)) / F.lit(STEP)).cast("long")
    counts = found.join(free, F.col("id") == F.col("__id")).groupBy("language", bin_.alias("bin"), F.col("__y").cast("int").alias("y")).agg(F.count("*").alias("n"))
    calibrate(network, [tuple(r) for r in counts.collect()])  # bounded by languages and bins
    cut = F.element_at(F.array(*[F.lit(float(x)) for x in network.threshold]), F.col("language") + 1)
    return found.select("id", (1 / (1 + F.exp(-F.greatest(F.least(F.col("z") - cut, F.lit(40.0)), F.lit(-40.0))))).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = scored(docs, common.table(spark, sf_dir, "labels"))
    held = F.coalesce(_remainder("id", 5) == 0, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
