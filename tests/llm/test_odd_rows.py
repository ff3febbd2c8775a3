"""Every registered operator query, and the pipeline, over tables of odd rows and over empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from convolake.llm import catalog

TEXTS = [None, "", " \n\t ", "a", "x" * 300_000, "word " * 60_000, "Mail a@b.cd, a@b.cd!", "日本 é\u0000 ﬁ <|endoftext|> ▁", "?!#" * 500, "the cat sat on the mat and looked at the other cat for a while", "the cat sat on the mat and looked at the other cat for a while"]
CLASH = ("id", "fp", "x", "score", "spans", "start", "ids", "n_tokens", "hit", "component", "root", "held_out", "predicted", "is_valid", "__good")
TABLES = ("documents", "labels", "benchmark", "embeddings", "pages", "conversations")
#: These return other rows than one for each row that they read; test_op11_to_op13.py holds their odd rows.
OTHER = ("op12_hnsw_neighbours", "op13_conversation_repair")


def tables(spark):
    docs = [(k, t, "en" if k % 2 else None, None if k % 3 else "s", len(t) if t is not None else None) for k, t in enumerate(TEXTS)]
    docs += [docs[3], docs[9], docs[9], (None, "no id", None, None, None), (None, None, None, None, None)]
    labels = [(k, k % 2, (k // 2) % 2) for k in range(len(TEXTS))] + [(3, None, None), (None, 1, 1), (4, 1, 0), (4, 1, 0), (999, 0, 1)]
    bench = [(1, "sat on the mat and looked at the other cat for"), (2, None), (3, ""), (4, "..."), (None, "word word"), (5, "a"), (1, "sat on the mat and looked at the other cat for")]
    vec = [(k, [1.0, float(k)], k) for k in range(4)] + [(4, None, 0), (None, [1.0, 1.0], None), (5, [], 1), (6, [0.0, 0.0], 1), (7, [None, 1.0], 1), (8, [float("nan"), 1.0], 1), (1, [1.0, 1.0], 1)]
    pages = [(1, "u", "<article><p>x"), (1, "u", "<article><p>x"), (2, None, None), (None, "v", ""), (3, "w", "<div>" + "y " * 100_000)]
    turns = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 1, "assistant", "x" * 100_000), (None, None, "", ""), (2, 5, "tool", " \n")]
    made = {
        "documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(bench, "item_id long, text string"), "embeddings": spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int"), "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
        "conversations": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
    }
    return {k: df.withColumns({c: F.lit(c) for c in CLASH}) for k, df in made.items()}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in ("odd", "empty"):
        out[kind] = f"file://{tmp_path_factory.mktemp(kind)}"
        for name, df in tables(spark).items():
            (df if kind == "odd" else df.limit(0)).write.parquet(f"{out[kind]}/{name}.parquet")
    return out


def source(name):
    return "embeddings" if name.startswith("op6_") else "pages" if name.startswith("op7_") else "documents"


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_a_row_for_each_row(spark, folders, name):
    want = tables(spark)[source(name)]
    key = want.columns[0]
    got = catalog.QUERIES[name](spark, folders["odd"])
    assert name in OTHER or sorted((r[0] for r in got.select(key).collect()), key=str) == sorted((r[0] for r in want.select(key).collect()), key=str)
    first, again = ([sorted(map(str, catalog.QUERIES[name](spark, folders["odd"]).collect()))] for _ in range(2))
    assert first == again
    assert catalog.QUERIES[name](spark, folders["empty"]).count() == 0


def test_stages(spark, folders):
    for kind in ("odd", "empty"):
        docs = spark.read.parquet(f"{folders[kind]}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folders[kind])
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert corpus_pipeline.run(spark, folders[kind]).count() <= docs.count()
