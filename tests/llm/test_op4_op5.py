"""Token files and SentencePiece ids against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from convolake.llm import op4_token_file as op4
from convolake.llm import op5_sentencepiece as op5

TEXTS = [None, "", "a", " ", "  a \n\n b ", "<|endoftext|> x", "日本語 é ²½ Ⅷ don't 'll", "　x\x00 🎉", "▁x▁▁y", "<s> <0x41>", "ab" * 3000, " " * 300 + "x" + " " * 77, "word " * 20_000]


def some_texts():
    rng = random.Random(1)
    return TEXTS + ["".join(rng.choice(" abcdehtnosi\n▁éß🎉THE.,1   ") for _ in range(rng.randint(0, 300))) for _ in range(150)]


def test_blocks_round_trip_and_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, op4.BLOCK, op4.BLOCK + 1, 5 * op4.BLOCK - 3):
        for ids in (rng.integers(0, 65_536, n), np.zeros(n, int), rng.integers(0, 3, n), np.minimum(rng.geometric(0.001, n), 65_535)):
            ids = ids.astype(np.int32)
            assert (op4.decode_blocks(op4.encode_blocks(ids), n) == ids).all()
    repeated = np.tile(np.arange(7, dtype=np.int32) * 900, 1000)
    assert sum(map(len, op4.encode_blocks(repeated))) < len(repeated) // 4
    blob = bytearray(op4.Part.write([5, None], np.array([3000, 4000]), repeated))
    docs, sizes, ids = op4.Part.read(bytes(blob))
    assert docs == [5, None] and sizes.tolist() == [3000, 4000] and (ids == repeated).all()
    blob[-30] ^= 4
    with pytest.raises(ValueError):
        op4.Part.read(bytes(blob))


def test_token_file(spark):
    texts = some_texts()
    rows = [(7 * k % 1000, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, "twice"), (3, "twice")]
    library, at, want = Tokenizer.from_file(op4.default_model()), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, op4.END], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = [tuple(r) for r in op4.read(op4.write(df)).orderBy("start").collect()]
    assert got == want
    assert op4.read(op4.write(df.limit(0))).count() == 0


def test_words_go_to_the_library_once():
    with open(op4.default_model(), encoding="utf-8") as f:
        tokenising = op4.Tokenising(f.read())
    sent, library = [], tokenising.bare

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sent.extend(w for t in texts for w in t.split(" "))
            return library.encode_batch_fast(texts, **how)

    tokenising.bare = Counting()
    texts = ["x house garden, house. house, garden! Größe\nhouse", None, "y garden house.  house Größe:"]
    ids, sizes = tokenising(pa.array(texts))
    want = [[*tokenising.model.encode(t or "", add_special_tokens=False).ids, op4.END] for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
    assert all(sent.count(w) == 1 for w in ("Ġhouse", "Ġgarden", "ĠGrÃ¶ÃŁe", "house"))


def test_blocks_of_a_task_are_coded_together(spark):
    df = spark.range(4).select(F.col("id").alias("doc_id"), F.expr("repeat('some words ', 300000)").alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        file = op4.write(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert file.count() == 1 and file.first()["n_tokens"] == op4.read(file).agg(F.sum("n_tokens")).first()[0]


def test_damage_beside_the_ids():
    ids = np.arange(3 * op4.BLOCK, dtype=np.int32) % 50_000
    blob = op4.Part.write([1], np.array([len(ids)]), ids)
    for at in (-1, -3, -1000, -6000):
        damaged = bytearray(blob)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            op4.Part.read(bytes(damaged))


def test_pieces_equal_library(spark):
    texts = some_texts()
    model = sentencepiece.SentencePieceProcessor(model_file=op5.default_model())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r["id"]: r for r in op5.encoded(df, with_ids=True).collect()}
    pieces = op5.Pieces(op5.default_model())
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        ids = model.encode(t or "")
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids), k
        assert got[k]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert op5.decode(np.array(ids, "<u4").tobytes(), pieces) == model.decode(ids)
        assert got[k]["round_trip"] == ("▁" not in (t or ""))
    assert op5.encoded(df.limit(0)).count() == 0
