"""The pipeline against its stages, re-stated plainly."""

import zlib

import numpy as np
import sentencepiece

import corpus_pipeline
from convolake.llm import op1_pii as op1
from convolake.llm import op5_sentencepiece as op5
from convolake.llm import op8_quality as op8

from .test_op9_op10 import brute_components, brute_fingerprint, brute_hits

DATA = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r["id"] for r in op8.scores(docs, spark.read.parquet(f"{DATA}/labels.parquet")).where(f"score >= {op8.THRESHOLD}").collect()}
    rows = {d: t for d, t in rows.items() if d in good}
    group = brute_components([(d, brute_fingerprint(t)) for d, t in sorted(rows.items())])
    rows = {d: t for d, t in rows.items() if group[d] == d}
    hits = brute_hits(list(rows.items()), items)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    assert set(got) == set(rows)
    model = sentencepiece.SentencePieceProcessor(model_file=op5.default_model())
    for d, r in got.items():
        text = model.decode(list(r["ids"]))
        assert r["round_trip"] == ("▁" not in rows[d]) and op1.base_spans(text) == []
        assert r["ids"] == model.encode(text) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        if not hits[d][4] and not op1.base_spans(rows[d]) and r["round_trip"]:
            assert text == rows[d]
    assert not any(h[4] for h in brute_hits([(d, model.decode(list(r["ids"]))) for d, r in got.items()], items).values())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
