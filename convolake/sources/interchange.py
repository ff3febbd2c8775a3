"""Conversations as JSON lines, graphs as Parquet, JSON, node-link JSON or GraphML, and embeddings as checked tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.conversation import CONVERSATION
from ..operators import graph
from ..operators.quality import DIMENSIONS, average
from ..storage import new_path

# -- conversations --


def serialize(results: DataFrame, metadata: bool = True) -> DataFrame:
    """(json): one document a result; results without a conversation leave a stub with their error.

    results: conversation_id, messages, tool_outputs, success, attempts, repaired, error, and the judged dimensions.
    """
    scores = F.when(average().isNotNull(), F.struct(*[F.col(d) for d in DIMENSIONS], average().alias("average")))
    tools = F.transform("tool_outputs", lambda o: o["endpoint_id"])
    there = F.col("conversation_id").isNotNull()
    full = F.struct(
        F.coalesce(tools, F.array().cast("array<string>")).alias("tools_used"), F.size("messages").alias("num_turns"), F.greatest(F.size("tool_outputs"), F.lit(0)).alias("num_tool_calls"),
        F.col("attempts"), F.col("repaired"), F.col("success"),
    )
    whole = F.struct("conversation_id", "messages", scores.alias("judge_scores"), *([full.alias("metadata")] if metadata else []))
    stub = F.struct(F.lit(None).cast("string").alias("conversation_id"), F.array().cast("array<string>").alias("messages"), *([F.struct("error", F.lit(False).alias("success")).alias("metadata")] if metadata else []))
    return results.select(F.when(there, F.to_json(whole)).otherwise(F.to_json(stub)).alias("json"))


def write_jsonl(results: DataFrame, path: str, failed: bool = False, metadata: bool = True) -> int:
    """Writes serialize() of successful (or all) results; returns how many."""
    kept, seen = results if failed else results.where(F.col("success")), Observation()
    serialize(kept, metadata).observe(seen, F.count("*").alias("n")).write.text(path)
    return seen.get["n"]


def read_jsonl(spark: SparkSession, path: str, schema: str = CONVERSATION, strict: bool = True) -> DataFrame:
    """Conversations of JSON lines; blank lines are passed over, malformed ones raise or (not strict) are left out."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


# -- graphs --


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Two Parquet tables."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S13; a path that isn't there is an empty graph."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/nodes")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return graph.empty(spark)
    return spark.read.schema(graph.NODES).parquet(f"{path}/nodes"), spark.read.schema(graph.EDGES).parquet(f"{path}/edges")


def _assemble(spark: SparkSession, path: str, parts: list[str | DataFrame], compressed: bool) -> None:
    """One file of texts and of tables of lines (column line), in this order.

    Spark writes the lines to the shared folder; their bytes are then joined by the file system's streams, so no rows
    come to the driver's Python. The first character of a table's first line is left out (a comma between elements).
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(conf).create(place, True)
    out = jvm.java.util.zip.GZIPOutputStream(out) if compressed else out
    try:
        for part in parts:
            if isinstance(part, str):
                out.write(bytearray(part.encode()))
                continue
            folder = new_path(spark, "lines")
            part.select("line").write.text(folder)
            source = jvm.org.apache.hadoop.fs.Path(folder)
            fs, first = source.getFileSystem(conf), True
            for file in sorted((f for f in fs.listStatus(source) if f.getLen() and f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName()):
                lines = fs.open(file.getPath())
                if first:
                    lines.read()
                    first = False
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(lines, out, 1 << 16, False)
                lines.close()
            fs.delete(source, True)
    finally:
        out.close()


def write_graph_json(nodes: DataFrame, edges: DataFrame, path: str, links: str = "edges", compressed: bool = False, created: str = "") -> None:
    """S16 and (links="links") S17: one JSON document, an element a line."""
    line = F.concat(F.lit(","), F.to_json(F.struct("*"))).alias("line")
    head = '{"metadata": {"schema_version": "1.0.0", "created_at": "%s"}, "nodes": [\n' % created
    _assemble(nodes.sparkSession, path, [head, nodes.select(line), f'], "{links}": [\n', edges.select(line), "]}\n"], compressed)


def read_graph_json(spark: SparkSession, path: str, links: str = "edges", lined: bool = False) -> tuple[DataFrame, DataFrame]:
    """S16 and S17. A document with an element a line, as write_graph_json() leaves it, can be read in parts (lined)."""
    if lined:
        line = spark.read.text(path).select(F.ltrim(F.col("value"), F.lit(",")).alias("line"))

        def part(schema: str, key: str) -> DataFrame:
            return line.select(F.from_json("line", schema).alias("e")).where(F.col(f"e.{key}").isNotNull()).select("e.*")

        return part(graph.NODES, "id"), part(graph.EDGES, "src")
    doc = spark.read.schema(f"nodes array<struct<{_typed(graph.NODES)}>>, {links} array<struct<{_typed(graph.EDGES)}>>").json(path, multiLine=True)
    return doc.select(F.inline("nodes")), doc.select(F.inline(links))


def _typed(schema: str) -> str:
    return ",".join(":".join(p.split()) for p in schema.split(","))


def _escaped(x: Column, attribute: bool = False) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *((('"', "&quot;"), ("\t", "&#9;")) if attribute else ()), ("\n", "&#10;"), ("\r", "&#13;")):
        x = F.replace(x, F.lit(plain), F.lit(coded))
    return x


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str, compressed: bool = False) -> None:
    """GraphML, an element a line; null attributes are left out."""
    keys, lines = [], []
    for kind, table, ends in (("node", nodes, {"id": "id"}), ("edge", edges, {"source": "src", "target": "dst"})):
        keys += [f'<key id="{kind}_{name}" for="{kind}" attr.name="{name}" attr.type="{type_ if type_ in ("string", "double") else "long"}"/>\n' for name, type_ in table.dtypes]
        named = F.concat(*[F.concat(F.lit(f' {a}="'), _escaped(F.col(c), True), F.lit('"')) for a, c in ends.items()])
        data = F.concat_ws("", *[F.concat(F.lit(f'<data key="{kind}_{c}">'), _escaped(F.col(c).cast("string")), F.lit("</data>")) for c in table.columns])
        lines.append(table.select(F.concat(F.lit(f" <{kind}"), named, F.lit(">"), data, F.lit(f"</{kind}>")).alias("line")))
    head = '<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n'
    _assemble(nodes.sparkSession, path, [head, *keys, '<graph edgedefault="directed">\n', *lines, "</graph>\n</graphml>\n"], compressed)


def read_graphml(spark: SparkSession, path: str, lined: bool = False) -> tuple[DataFrame, DataFrame]:
    """S15, by Spark's own XML reader. A document with an element a line, as write_graphml() leaves it, can be read in parts (lined)."""
    data = "data array<struct<_VALUE:string,_key:string>>"

    def part(kind: str, schema: str) -> DataFrame:
        if lined:
            rows = spark.read.text(path).where(F.ltrim("value").startswith(f"<{kind} ")).select(F.from_xml("value", data).alias("e")).select("e.data")
        else:
            rows = spark.read.schema(data).option("rowTag", kind).xml(path)
        values = F.map_from_entries(F.transform("data", lambda d: F.struct(F.substring(d["_key"], 6, 1000), d["_VALUE"])))
        return rows.select(values.alias("m")).select(*[F.element_at("m", c).cast(t).alias(c) for c, t in (p.split() for p in schema.split(","))])

    return part("node", graph.NODES), part("edge", graph.EDGES)


# -- embeddings --


def _of_size(size: int) -> Column:
    return F.when(F.size("embedding") == size, F.col("embedding")).otherwise(F.raise_error(F.format_string(f"a vector of size %d where {size} is due", F.size("embedding"))))


def save_embeddings(vectors: DataFrame, path: str, size: int) -> None:
    """(id, embedding), all of one size, else it raises."""
    vectors.select("id", _of_size(size).cast("array<float>").alias("embedding")).write.mode("append").parquet(path)


def load_embeddings(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """S19; with a size, a stored vector of another one raises."""
    found = spark.read.schema("id string, embedding array<float>").parquet(path)
    return found if size is None else found.select("id", _of_size(size).cast("array<float>").alias("embedding"))


def clear_embeddings(spark: SparkSession, path: str) -> None:
    """An empty cache at this path."""
    spark.createDataFrame([], "id string, embedding array<float>").write.mode("overwrite").parquet(path)


def hashing_embedder(size: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """An embedder that needs no model: signed hashes of words, normalised."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), size), np.float32)
        for row, text in zip(out, texts):
            for word in text.lower().split():
                h = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
                row[h // 2 % size] += 1 - 2 * (h % 2)
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).tolist()

    return embed


def missing_embeddings(texts: DataFrame, cached: DataFrame) -> DataFrame:
    """texts(id, text) without a vector yet."""
    return texts.join(cached.select("id"), "id", "left_anti")


def embed(texts: DataFrame, cached: DataFrame, embedder: Callable[[list[str]], list[list[float]]], batch: int = 100) -> DataFrame:
    """Cached vectors, and new ones for texts without, made in batches by any embedder."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for k in range(0, len(part), batch):
                some = part.iloc[k : k + batch]
                yield pd.DataFrame({"id": some["id"], "embedding": embedder(some["text"].fillna("").tolist())})

    made = missing_embeddings(texts, cached).select("id", "text").mapInPandas(run, "id string, embedding array<float>")
    return cached.join(texts.select("id"), "id", "left_semi").select("id", "embedding").unionByName(made)
