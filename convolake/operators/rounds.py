"""Conversations in rounds: the answers so far are a table, and each round asks what every open conversation needs next.

A conversation's state is its course (generation.Course): of the talk under way what can't be told from its chain, and what
was judged. It goes on from there, so nothing is replayed. The answers are a log beside it, a line each, that is only added
to. A round is one committed table. A lost executor asks again what its tasks asked in that round, never whole
conversations, and a run that has ended goes on after the last round in its folder.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.conversation import compact
from ..storage import delete, exists
from .generation import RESULT, ROWS, Course, Model, ModelError, Talk, complete, from_batch, generate_one, in_flight, kept_talk, mended_talk, talk_again, to_batch

#: attempts: their chains as JSON. answers: a line each of JSON (prompt's hash, text, error). course: as _kept() has it. prompt_hash: of what is asked next.
STATE = f"conv string, attempts string, answers string, course string, prompt_hash string, result struct<{RESULT}>"


def _hash(prompt: str) -> str:
    return hashlib.md5(prompt.encode()).hexdigest()


class Waiting(Exception):
    """The model was asked as often as it may be; `prompt` is asked next."""

    def __init__(self, prompt: str):
        super().__init__(prompt)
        self.prompt = prompt


class Replay:
    """A model that asks up to `more` times, and adds what it hears, failures included, to the answers on record."""

    def __init__(self, answers: str, ask: Callable[[str], dict] | None = None, more: int = 0):
        self.lines, self.ask, self.more = [answers] if answers else [], ask, more

    @property
    def answers(self) -> str:
        return "\n".join(self.lines)

    def complete(self, prompt: str) -> str:
        if not self.more:
            raise Waiting(prompt)
        answer = self.ask(prompt)
        self.more -= 1
        self.lines.append(compact([_hash(prompt), answer["text"], answer["error"]]))
        if answer["error"] is not None:
            raise ModelError(answer["error"])
        return answer["text"]


def _kept(c: Course) -> str:
    """The course as JSON. The last outcome counts only if all later attempts fail, so it is there from the second on."""
    mended = c.mended.messages if c.mended is not None and c.mended is not c.talk else None
    last = c.last and [c.last[0], kept_talk(c.last[1]) if not c.last[3] else [c.last[1].id, c.last[1].messages, c.last[1].outputs], *c.last[2:]]
    return json.dumps([c.attempt, c.talk and kept_talk(c.talk), c.scores, mended, c.error, last])


def _course(id_: str, chains: list[list[str]], kept: str | None) -> Course:
    if kept is None:
        return Course()
    attempt, talk, scores, mended, error, last = json.loads(kept)
    talk = talk and talk_again(f"{id_}-{attempt}", chains[attempt - 1], talk)
    if last:
        k, held, *judged = last
        last = (k, Talk(held[0], chains[k - 1], messages=held[1], outputs=held[2]) if judged[1] else talk_again(f"{id_}-{k}", chains[k - 1], held), *judged)
    return Course(attempt, talk, scores, mended and mended_talk(talk, mended), error, last)


def _onward(row: dict, model: Replay, threshold: float, turns: int) -> dict:
    """The row with its new answers, and with what is asked next or its result. Here attempts are lists."""
    id_, chains = str(row["conv"]), row["attempts"] or []
    course = _course(id_, chains, row.get("course"))
    try:
        made = {"course": None, "prompt_hash": None, "result": generate_one(model, id_, chains, threshold, turns=turns, course=course)}
    except Waiting as w:
        made = {"course": _kept(course), "prompt_hash": _hash(w.prompt), "result": None}
    return row | made | {"answers": model.answers}


def _mapped(rows: DataFrame, one, window: int) -> DataFrame:
    """one(row) of each row, as STATE."""
    schema = to_arrow_schema(StructType.fromDDL(STATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                yield to_batch(list(in_flight(one, from_batch(batch.slice(k, ROWS)), window)), schema)

    return rows.mapInArrow(run, STATE)


def _at(spark: SparkSession, path: str, done: int, k: int | None = None) -> DataFrame:
    rows = spark.read.schema(f"{STATE}, round int, done int").option("basePath", path).parquet(path if k is None else f"{path}/round={k}")
    return rows.where(F.col("done") == done)


@contextlib.contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Both values of `done` are written side by side: else each task sorts its rows, states and all, by them first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, max(3, int(before)))  # at as many writers as may be, the rest is sorted after all
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write(rows: DataFrame, path: str, k: int) -> None:
    with _unsorted(rows.sparkSession):
        # States hardly repeat, so dictionaries would only be tried.
        rows.withColumn("done", F.col("result").isNotNull().cast("int")).write.mode("overwrite").option("parquet.enable.dictionary", "false").partitionBy("done").parquet(f"{path}/round={k}")


def _last(spark: SparkSession, path: str) -> int | None:
    """The last round that was committed, if there is one."""
    k = None
    while exists(spark, f"{path}/round={0 if k is None else k + 1}/_SUCCESS"):
        k = 0 if k is None else k + 1
    return k


def generate(chains: DataFrame, model: Model, path: str, threshold: float = 6.0, turns: int = 20, requests: int = 3, window: int = 1, known: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """What generation.generate gives for chains(conv, attempts), in rounds under `path`.

    A round makes up to `requests` requests of each open conversation; three are a turn of user, assistant and tool. With
    known(prompt_hash, content), answers by the MD5 sum of their prompt, a round is one request, and only what is not known
    is asked; the first round then asks nothing, as it has no hashes yet. Conversations are dealt to `parts` tasks (the
    session's parallelism, unless given), each with up to `window` in flight. There are as many rounds as the longest conversation has; each reads and writes only those that are still open,
    and what was open before it is dropped once it is committed. Null attempts are none.
    """
    spark, most = chains.sparkSession, requests if known is None else 1

    def ask(prompt: str) -> dict:
        try:
            return {"text": complete(model, prompt), "error": None}
        except ModelError as e:
            return {"text": None, "error": str(e)}

    def one(row: dict, most: int = most) -> dict:
        content, attempts = row.pop("content", None), row["attempts"]
        heard = ask if content is None else lambda prompt: {"text": content, "error": None}
        # The chains stay as they are: only what changes is made into JSON again.
        return _onward(row | {"attempts": attempts and json.loads(attempts)}, Replay(row["answers"], heard, most), threshold, turns) | {"attempts": attempts}

    k = _last(spark, path)
    if k is None:
        k = 0
        # Dealt by conversation once: later rounds read the parts that the one before wrote.
        none = F.lit(None).cast("string")
        dealt = chains.select(F.col("conv").cast("string"), F.to_json("attempts").alias("attempts"), none.alias("answers"), none.alias("course"))
        first = one if known is None else partial(one, most=0)
        _write(_mapped(dealt.repartition(parts or spark.sparkContext.defaultParallelism, "conv"), first, window), path, k)
    while not (open_ := _at(spark, path, 0, k)).isEmpty():
        open_ = open_.select("conv", "attempts", "answers", "course", "prompt_hash")
        if known is not None:
            answers = known.groupBy("prompt_hash").agg(F.min("content").alias("content"))
            open_ = open_.join(answers, "prompt_hash", "left")
        _write(_mapped(open_, one, window), path, k + 1)
        delete(spark, f"{path}/round={k}/done=0")
        k += 1
    return _at(spark, path, 1).select("result.*")


def asked(spark: SparkSession, path: str) -> DataFrame:
    """(conv, number, prompt_hash, content, error) of all requests of the finished conversations under `path`: what a cache takes in."""
    lines = _at(spark, path, 1).where("answers <> ''").select("conv", F.posexplode(F.split("answers", "\n")).alias("number", "line"))
    return lines.withColumn("a", F.from_json("line", "array<string>")).select("conv", "number", F.col("a")[0].alias("prompt_hash"), F.col("a")[1].alias("content"), F.col("a")[2].alias("error"))
