"""Cross-entropy difference of two matched n-gram models.

The target model counts the documents labelled good, the background model counts all documents. Both are bigram models
over one vocabulary, with the same Dirichlet smoothing: bigrams back off to unigrams, unigrams to the uniform
distribution, with pseudo-counts in proportion to each model's tokens, so that the larger one is not smoothed less. A
document's score is the mean over its tokens of target loss less background loss, in nats; lower is closer to the target.

Words, contexts and pairs are counted by their own bytes: nothing is hashed together, and what is counted grows with the
corpus. Documents are dealt by id to chunks of about SHARE bytes of text. Counts are summed in levels, as in a radix
exchange: a chunk's number and a key's hash are numbers of as many digits in one base, up to FAN; on each level a unit
sends its distinct keys, with their counts, to the units whose number has the key's digit in place of its own, so that
after the last level a unit is named by the hash alone and holds whole sums. Answers go back the same way, to the units
that asked, in the order of what they sent. A unit sends and gets up to FAN messages a level, so messages grow as the
number of chunks times its logarithm; a common key is at most FAN entries in a unit, and no task or driver holds a whole
table.

Words are lower-cased and split at white space; a document's first word follows a start mark. The uniform distribution is
over the distinct words of the corpus, WORDS at least. Null and empty texts have no tokens and score 0. Without any
target document the target model is uniform. Labels that repeat count once (good, if any is). Rows that repeat are
counted and returned as often; null ids keep their row and are no targets; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: The least vocabulary of the uniform distribution, and the bytes of text of a chunk.
WORDS, SHARE = 1 << 18, 10_000_000
#: The most units that a unit sends to on one level.
FAN = 256
STRENGTH, UNIFORM = 1e-5, 1e-7
CODEC = "zstd"


class Dealt:
    """Keys by the digit of their hashes on a level."""

    def __init__(self, hash_: np.ndarray, level: int, base: int):
        self.level, self.base = level, base
        digit = hash_ // base**level % base
        self.order = np.argsort(digit, kind="stable")
        self.ends = np.cumsum(np.bincount(digit, minlength=base))

    def __iter__(self):
        """(digit, keys) of the digits that have keys, and nothing of the others."""
        for d in range(self.base):
            of = self.order[self.ends[d - 1] if d else 0 : self.ends[d]]
            if len(of):
                yield d, of

    def unit(self, own: int, digit: int) -> int:
        """The unit that gets these keys from this one."""
        place = self.base**self.level
        return own + (digit - own // place % self.base) * place


class Keys:
    """The distinct words, contexts and pairs of some texts: the same for the same texts in any order.

    A word's key is the word, a context's ends in a space (alone for a start), and a pair's is both words, a space
    between them; words hold no space.
    """

    def __init__(self, table: pa.Table, base: int):
        seen: dict[bytes, int] = {}
        ids, counts = [], []
        for batch in table.to_batches():
            for _, texts in common.slices(batch, "text"):
                for t in texts:
                    words = (t if t.isascii() else t.decode().lower().encode()).lower().split()
                    counts.append(len(words))
                    ids.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int32))
        self.counts = np.array(counts, np.int64)
        found = list(seen)
        order = sorted(range(len(found)), key=found.__getitem__)
        place = np.empty(len(found), np.int32)
        place[order] = np.arange(1, len(found) + 1, dtype=np.int32)
        names = [b"", *(found[k] for k in order)]  # 0 is the start mark
        self.names, size = pa.array(names, pa.large_binary()), len(names)
        self.word = place[np.concatenate(ids)] if ids else np.empty(0, np.int32)
        del seen, ids, found
        self.before = np.concatenate([np.zeros(1, np.int32), self.word[:-1]]) if len(self.word) else self.word
        self.before[(np.cumsum(self.counts) - self.counts)[self.counts > 0]] = 0
        self.pairs, self.at = np.unique(self.before.astype(np.int64) * size + self.word, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, size)
        self.size = size
        # The hash that says where a key is summed: the words' hashes mixed; words and contexts as pairs with fixed values.
        h = np.fromiter(map(zlib.crc32, names), np.uint64, size)
        with np.errstate(over="ignore"):  # products of hashes are taken modulo 2^64
            mixed = lambda a, b: ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)).astype(np.int64)
            self.hash = np.concatenate([mixed(h, np.full(size, 1, np.uint64)), mixed(h, np.full(size, 2, np.uint64)), mixed(h[self.first], h[self.second])])
        self.dealt = Dealt(self.hash, 0, base)

    def tally(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of all keys over these tokens (a mask)."""
        one = lambda x, n: np.bincount(x[tokens], minlength=n)
        return np.concatenate([one(self.word, self.size), one(self.before, self.size), one(self.at, len(self.pairs))])

    def texts(self, keys: np.ndarray) -> pa.Array:
        names, n = self.names, self.size
        space, rest = pa.scalar(b" ", pa.large_binary()), keys[keys >= 2 * n] - 2 * n
        out = [names.take(pa.array(keys[keys < n]))]
        out.append(pc.binary_join_element_wise(names.take(pa.array(keys[(keys >= n) & (keys < 2 * n)] - n)), pa.scalar(b"", pa.large_binary()), space))
        out.append(pc.binary_join_element_wise(names.take(pa.array(self.first[rest])), names.take(pa.array(self.second[rest])), space))
        return pa.concat_arrays(out)


def _packed(*columns: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(list(columns), [str(k) for k in range(len(columns))])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> list[pa.Array]:
    return pa.ipc.open_stream(data).read_next_batch().columns


def _narrow(counts: np.ndarray) -> pa.Array:
    return pa.array(counts.astype(np.min_scalar_type(int(counts.max(initial=0)))))


SENT = pa.schema([("unit", pa.int64()), ("sender", pa.int64()), ("keys", pa.binary())])
ANSWERED = pa.schema([("unit", pa.int64()), ("sender", pa.int64()), ("sums", pa.binary())])
TOTALS = pa.schema([("n_all", pa.int64()), ("n_good", pa.int64()), ("n_words", pa.int64())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)


def asked(docs: DataFrame, good: DataFrame, base: int, levels: int) -> DataFrame:
    """(unit, sender, keys): each chunk's distinct keys, packed with their counts in all and in good documents, and their hashes if there are more levels."""

    def run(rows: pa.Table, targets: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            keys = Keys(rows, base)
            target = pc.and_(pc.is_in(rows["id"], value_set=targets["good"].combine_chunks()), pc.is_valid(rows["id"])).to_numpy()
            all_, wanted, own = keys.tally(np.ones(len(keys.word), bool)), keys.tally(np.repeat(target, keys.counts)), rows["chunk"][0].as_py()
            keys.word = keys.before = keys.at = None  # texts are packed next
            for digit, of in keys.dealt:
                hashes = [pa.array(keys.hash[of])] if levels > 1 else []
                out.append((keys.dealt.unit(own, digit), own, _packed(keys.texts(of), _narrow(all_[of]), _narrow(wanted[of]), *hashes)))
        return _table(out, SENT)

    return docs.groupBy("chunk").cogroup(good.groupBy("chunk")).applyInArrow(run, _ddl(SENT))


class Merged:
    """What a unit has got: its senders, the places of their keys among its distinct ones, and these keys' sums."""

    def __init__(self, messages: pa.Table):
        rows = sorted(zip(messages["sender"].to_pylist(), messages["keys"].to_pylist()))
        self.own, self.senders = messages["unit"][0].as_py(), [r[0] for r in rows]
        columns = [_unpacked(r[1]) for r in rows]
        coded = pa.concat_arrays([c[0] for c in columns]).dictionary_encode()
        codes, self.names = coded.indices.to_numpy(), coded.dictionary
        self.codes = np.split(codes, np.cumsum([len(c[0]) for c in columns])[:-1])
        # Sums as floats are exact up to 2^53.
        self.sums = [np.bincount(codes, np.concatenate([c[k].to_numpy() for c in columns]), len(self.names)).astype(np.int64) for k in (1, 2)]
        self.hash = None
        if len(columns[0]) > 3:
            self.hash = np.empty(len(self.names), np.int64)
            self.hash[codes] = np.concatenate([c[3].to_numpy() for c in columns])

    def sent(self, level: int, base: int) -> list[tuple]:
        """Messages of the next level."""
        dealt = Dealt(self.hash, level, base)
        return [(dealt.unit(self.own, d), self.own, _packed(self.names.take(pa.array(of)), _narrow(self.sums[0][of]), _narrow(self.sums[1][of]), pa.array(self.hash[of]))) for d, of in dealt]

    def answers(self) -> list[tuple]:
        """To each sender, the sums of its keys in its order."""
        return [(sender, self.own, _packed(_narrow(self.sums[0][of]), _narrow(self.sums[1][of]))) for sender, of in zip(self.senders, self.codes)]

    def totals(self) -> tuple:
        """Tokens in all and in good documents, and distinct words."""
        words = pc.equal(pc.find_substring(self.names, b" "), -1).to_numpy(zero_copy_only=False) & (pc.binary_length(self.names).to_numpy() > 0)
        return int(self.sums[0][words].sum()), int(self.sums[1][words].sum()), int(words.sum())


def _up(level: int, base: int):
    def run(messages: pa.Table) -> pa.Table:
        return _table(Merged(messages).sent(level, base), SENT)

    return run


def _down(level: int, base: int):
    def run(messages: pa.Table, sums: pa.Table) -> pa.Table:
        if not messages.num_rows:
            return _table([], ANSWERED)
        unit = Merged(messages)
        got = dict(zip(sums["sender"].to_pylist(), sums["sums"].to_pylist()))
        dealt = Dealt(unit.hash, level, base)
        for digit, of in dealt:
            for k, x in enumerate(_unpacked(got[dealt.unit(unit.own, digit)])):
                unit.sums[k][of] = x.to_numpy()
        return _table(unit.answers(), ANSWERED)

    return run


def exchanged(first: DataFrame, base: int, levels: int) -> tuple[DataFrame, tuple[int, int, int], list[DataFrame]]:
    """Answers (unit, sender, sums) to what chunks have sent, the totals of all units, and the messages of all levels."""
    sent = [first if levels == 1 else common.stored(first, "keys")]
    for level in range(1, levels):
        sent.append(common.stored(sent[-1].groupBy("unit").applyInArrow(_up(level, base), _ddl(SENT)), "keys"))

    last = pa.schema([*ANSWERED, *TOTALS])

    def whole(messages: pa.Table) -> pa.Table:
        unit = Merged(messages)
        rows = [(*answer, 0, 0, 0) for answer in unit.answers()]
        return _table([(*rows[0][:3], *unit.totals()), *rows[1:]], last)

    answers = common.stored(sent[-1].groupBy("unit").applyInArrow(whole, _ddl(last)), "sums")
    totals = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in TOTALS.names]).first()
    for level in range(levels - 1, 0, -1):
        answers = sent[level - 1].groupBy("unit").cogroup(answers.select(*ANSWERED.names).groupBy("unit")).applyInArrow(_down(level, base), _ddl(ANSWERED))
    return answers.select(*ANSWERED.names), tuple(totals), sent


def losses(keys: Keys, sums: np.ndarray, total: int, words: int) -> np.ndarray:
    """The loss of each distinct pair."""
    back, flat = max(STRENGTH * total, 1.0), max(UNIFORM * total, 0.01)  # in proportion to the model's tokens
    n = keys.size
    single = (sums[:n][keys.second] + flat) / (total + flat * words)
    return -np.log((sums[2 * n :] + back * single) / (sums[n : 2 * n][keys.first] + back))


def scores(docs: DataFrame, labels: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, fan: int = FAN) -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) for each row; losses are means a token."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = max(1, -(-size // share))
    levels = 1
    while fan**levels < chunks:
        levels += 1
    base = next(b for b in range(1, fan + 1) if b**levels >= chunks)
    dealt = lambda key: F.pmod(key, F.lit(chunks)).cast("long").alias("chunk")
    # Rows without an id are dealt by their texts.
    rows = docs.select(dealt(F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias("good")).distinct()
    sums, (all_, wanted, distinct), _ = exchanged(asked(rows, known.select(dealt(F.xxhash64("good")), "good"), base, levels), base, levels)

    def run(rows: pa.Table, sums: pa.Table) -> pa.Table:
        keys, own = Keys(rows, base), rows["chunk"][0].as_py()
        held = np.zeros((2, 2 * keys.size + len(keys.pairs)), np.int64)
        got = dict(zip(sums["sender"].to_pylist(), sums["sums"].to_pylist()))
        for digit, of in keys.dealt:
            for k, x in enumerate(_unpacked(got[keys.dealt.unit(own, digit)])):
                held[k, of] = x.to_numpy()
        of = np.repeat(np.arange(len(keys.counts)), keys.counts)
        mean = [np.bincount(of, losses(keys, held[k], total, max(words, distinct))[keys.at], len(keys.counts)) / np.maximum(keys.counts, 1) for k, total in ((1, wanted), (0, all_))]
        return pa.table([rows["id"], pa.array(keys.counts), *map(pa.array, mean), pa.array(mean[0] - mean[1])], ["id", "n_tokens", "target_loss", "background_loss", "score"])

    def answered(rows: pa.Table, sums: pa.Table) -> pa.Table:
        return run(rows, sums) if rows.num_rows else pa.table({"id": rows["id"], "n_tokens": pa.array([], pa.int64()), **{c: pa.array([], pa.float64()) for c in ("target_loss", "background_loss", "score")}})

    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.groupBy("chunk").cogroup(sums.withColumnRenamed("unit", "chunk").groupBy("chunk"))
    return got.applyInArrow(answered, f"id {kind}, n_tokens long, target_loss double, background_loss double, score double")


def query(spark, sf_dir: str) -> DataFrame:
    return scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
