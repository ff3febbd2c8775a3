"""Conversations made by a language model over sampled chains, judged, repaired and retried; and missing schema fields.

A model is any object with complete(prompt) -> str that can be pickled. Each row of chains is one conversation, run to
its end in one Python worker; conversations run in parallel over partitions. FakeModel answers without any network, and
the same each time. Prompts are our own words.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.conversation import MESSAGE, TOOL_OUTPUT, compact, extract_values, grounding_values, repair_text, user_goal
from ..functions.text import is_blank, parse_response_schema, parse_type
from ..operators.quality import DIMENSIONS
from ..operators.validation import ROLES

RESULT = (
    f"conversation_id string, success boolean, attempts long, repaired boolean, error string, messages array<{MESSAGE}>, tool_outputs array<{TOOL_OUTPUT}>,"
    " tool_correctness long, argument_grounding long, task_completion long, naturalness long, endpoint_ids array<string>"
)


class Model(Protocol):
    def complete(self, prompt: str) -> str: ...


class ModelError(Exception):
    """L2: a model could not answer; `transient` ones may be tried again."""

    def __init__(self, text: str, transient: bool = False):
        super().__init__(text)
        self.transient = transient


class RateLimited(ModelError):
    """L2: asked too often; `retry_after` seconds, if the service says so."""

    def __init__(self, text: str, retry_after: float | None = None):
        super().__init__(text, True)
        self.retry_after = retry_after


class ServiceError(ModelError):
    """L2: the service answers with an error; those of its own side (500 and above) are transient."""

    def __init__(self, text: str, status: int | None = None):
        super().__init__(text, status is not None and status >= 500)
        self.status = status


class InvalidAnswer(ModelError):
    """L2: the answer has not the form that was asked for."""


class Unreachable(ModelError):
    """L2: no connection, or none in time."""

    def __init__(self, text: str):
        super().__init__(text, True)


@dataclass
class FakeModel:
    """L1 offline: answers made from the MD5 sum of the prompt, which SQL has too; scores lie between least and 10."""

    least: int = 5
    fail_every: int = 0

    def _hash(self, text: str) -> int:
        return int.from_bytes(hashlib.md5(text.encode()).digest()[:8]) >> 4  # the first 15 hexadecimal digits

    def complete(self, prompt: str) -> str:
        h = self._hash(prompt)
        if self.fail_every and h % self.fail_every == 0:
            raise ModelError("no answer")
        task, _, rest = prompt.partition("\n")
        if task == "JUDGE":
            return f"{{{', '.join([f'"{d}": {self.least + (h >> 8 * k) % (11 - self.least)}' for k, d in enumerate(DIMENSIONS)])}}}"
        if task == "TOOL":
            return f'{{"status": "success", "id": "{h % 10**8:08d}"}}'
        if task == "SCENARIO":
            return f'{{"description": "scenario {h % 1000}", "user_goal": "goal {h % 97}"}}'
        if task == "REPAIR":
            said = json.loads(rest.partition("\n")[2])["messages"]
            for m in [m for m in said if m["role"] == "assistant"][-1:]:
                m["content"] = f"repair {h % 10**6}"
            return json.dumps({"messages": said})
        if task == "TYPE":
            return ("string", "integer", "number", "boolean")[h % 4]
        if task == "SCHEMA":
            return '{"type": "object"}'
        return f"{task.lower()} {h % 10**6}: {rest[-40:].strip()}"


class Paced:
    """L2: a model that is asked at most per_second times a second, by all threads of a worker together."""

    def __init__(self, model: Model, per_second: float):
        self.model, self.per_second = model, per_second
        self._ready()

    def _ready(self) -> None:
        self.lock, self.next = threading.Lock(), 0.0

    def __getstate__(self):
        return {"model": self.model, "per_second": self.per_second}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def complete(self, prompt: str) -> str:
        with self.lock:
            at = self.next = max(self.next, time.monotonic())
            self.next += 1 / self.per_second
        time.sleep(max(0.0, at - time.monotonic()))
        return self.model.complete(prompt)


def _sorted(values: dict[str, str]) -> str:
    return compact(dict(sorted(values.items())))


def in_flight(one, items, window: int) -> Iterator:
    """one(item) for each item, in order, up to `window` of them at a time; no more are taken in than that."""
    if window <= 1:
        yield from map(one, items)
        return
    with ThreadPoolExecutor(window) as pool:
        waiting: deque = deque()
        for item in items:
            waiting.append(pool.submit(one, item))
            if len(waiting) >= window:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def complete(model: Model, prompt: str, tries: int = 3, wait: float = 0.0) -> str:
    """Tries again after transient errors, after as long as the service asks for, else `wait` seconds, doubled each time."""
    for k in range(tries):
        try:
            return model.complete(prompt)
        except ModelError as e:
            if not e.transient or k + 1 == tries:
                raise
            time.sleep(getattr(e, "retry_after", None) or wait * 2**k)
    raise AssertionError


def complete_json(model: Model, prompt: str) -> dict:
    text = complete(model, prompt)
    try:
        return json.loads(text[text.index("{") : text.rindex("}") + 1])
    except ValueError as e:
        raise InvalidAnswer("the answer holds no JSON") from e


def complete_structured(model: Model, prompt: str, fields: dict[str, type]) -> dict:
    """L1: an object that has these fields, of these types."""
    found = complete_json(model, prompt)
    for name, kind in fields.items():
        if not isinstance(found.get(name), kind):
            raise InvalidAnswer(f"the answer's {name} is missing or no {kind.__name__}")
    return found


def chat(model: Model, messages: list[dict]) -> str:
    """L1: the next message of a conversation."""
    return complete(model, "CHAT\n" + "\n".join(f"{m['role']}: {m['content']}" for m in messages if m.get("content")))


def complete_with_tools(model: Model, prompt: str, tools: list[dict]) -> tuple[str, list[dict]]:
    """L1: text and tool calls; an answer that is an object with a known tool's name and arguments is a call."""
    text = complete(model, f"{prompt}\nTools: {json.dumps(tools, sort_keys=True)}")
    try:
        found = json.loads(text)
    except ValueError:
        return text, []
    if isinstance(found, dict) and found.get("name") in {t["name"] for t in tools}:
        call = {"id": "call_" + hashlib.md5(text.encode()).hexdigest()[:8], "function": {"name": found["name"], "arguments": json.dumps(found.get("arguments", {}))}}
        return "", [call]
    return text, []


def _message(role: str, content: str | None, calls: list[dict] | None = None, call_id: str | None = None) -> dict:
    return {"role": role, "content": content, "tool_calls": calls, "tool_call_id": call_id}


@dataclass
class Talk:
    """A conversation under way."""

    id: str
    chain: list[str]
    goal: str = ""
    messages: list[dict] = field(default_factory=list)
    outputs: list[dict] = field(default_factory=list)
    grounding: dict[str, str] = field(default_factory=dict)
    scenario: dict = field(default_factory=dict)
    #: The history of the messages counted so far: messages are only added, so each is put into text once.
    told: str = field(default="", repr=False, compare=False)
    counted: int = field(default=0, repr=False, compare=False)

    def say(self, role: str, content: str | None, calls: list[dict] | None = None, call_id: str | None = None) -> None:
        self.messages.append(_message(role, content, calls, call_id))

    def history(self) -> str:
        new = [f"{m['role']}: {m['content']}" for m in self.messages[self.counted :] if m["content"]]
        if new:
            self.told = "\n".join([self.told, *new] if self.told else new)
        self.counted = len(self.messages)
        return self.told


def _call(talk: Talk, step: int, arguments: str) -> dict:
    return {"id": f"call_{talk.id}_{step}", "function": {"name": talk.chain[step], "arguments": arguments}}


def _output(call: dict, text: str) -> dict:
    return {"endpoint_id": call["function"]["name"], "arguments": call["function"]["arguments"], "result": text, "call_id": call["id"], "success": True}


def kept_talk(talk: Talk) -> list:
    """What of a talk that converse() makes can't be told from its id and chain, as JSON holds it; talk_again() puts it back."""
    arguments = [m["tool_calls"][0]["function"]["arguments"] for m in talk.messages if m["tool_calls"]]
    return [talk.scenario, talk.goal, talk.grounding, [m["content"] for m in talk.messages], arguments]


def talk_again(id_: str, chain: list[str], kept: list) -> Talk:
    scenario, goal, grounding, texts, arguments = kept
    talk = Talk(id_, chain, goal, grounding=grounding, scenario=scenario)
    for step in range(-(-len(texts) // 3)):  # users, assistants and tools in turn
        turn, call = texts[3 * step : 3 * step + 3], _call(talk, step, arguments[step]) if step < len(arguments) else None
        talk.messages.append(_message("user", turn[0]))
        if len(turn) > 1:
            talk.messages.append(_message("assistant", turn[1], call and [call]))
        if len(turn) > 2:
            talk.outputs.append(_output(call, turn[2]))
            talk.messages.append(_message("tool", turn[2], None, call["id"]))
    return talk


def plan(model: Model, talk: Talk) -> None:
    """L3."""
    talk.scenario = complete_json(model, f"SCENARIO\nInvent a user who needs these tools in turn: {', '.join(talk.chain)}")
    talk.goal = user_goal(talk.scenario)


def user_turn(model: Model, talk: Talk) -> None:
    """L4."""
    talk.say("user", complete(model, f"USER\nYour goal: {talk.goal}\nKnown: {compact(talk.grounding)}\nSo far:\n{talk.history()}"))


def assistant_turn(model: Model, talk: Talk) -> None:
    """Calls the next tool of the chain, or closes."""
    step = len(talk.outputs)
    text = complete(model, f"ASSISTANT\nGoal: {talk.goal}\nStep {step}\n{talk.history()}")
    if step < len(talk.chain):
        talk.say("assistant", text, [_call(talk, step, _sorted(talk.grounding))])
    else:
        talk.say("assistant", text)


def tool_turn(model: Model, talk: Talk) -> bool:
    """Answers the first call that waits, and keeps values of the answer; whether there was one."""
    answered, calls = set(), []
    for m in reversed(talk.messages):  # answers come after their calls
        if m["role"] == "tool":
            answered.add(m["tool_call_id"])
        elif m["role"] == "assistant" and m["tool_calls"]:
            calls = m["tool_calls"]
            break
    call = next((c for c in calls if c["id"] not in answered), None)
    if call is None:
        return False
    name, arguments = call["function"]["name"], call["function"]["arguments"]
    try:
        result = complete_json(model, f"TOOL\n{name}({arguments})\nas call {call['id']}")
    except ModelError:
        result = {"status": "success", "id": f"{name}_{call['id'][-8:]}"}
    text = compact(result)
    talk.outputs.append(_output(call, text))
    talk.grounding.update(grounding_values(result))
    talk.say("tool", text, call_id=call["id"])
    return True


def extract(model: Model, result: dict) -> dict[str, str]:
    """Values worth keeping of a tool's result, as the model sees them; by patterns, if it can't say."""
    try:
        found = complete_json(model, f"EXTRACT\nName what later steps may need of {json.dumps(result, sort_keys=True)}")
        return {str(k): v if isinstance(v, str) else json.dumps(v) for k, v in found.items() if v is not None}
    except ModelError:
        return extract_values(result)


def judge(model: Model, talk: Talk) -> dict[str, int]:
    """Four scores between 1 and 10."""
    read = complete_json(model, f"JUDGE\nGoal: {talk.goal}\n{talk.history()}")
    return {d: min(10, max(1, int(read[d]))) for d in DIMENSIONS}


def mended_talk(talk: Talk, messages: list[dict]) -> Talk:
    return Talk(f"{talk.id}-r", talk.chain, talk.goal, messages, list(talk.outputs), dict(talk.grounding), talk.scenario)


def repair(model: Model, talk: Talk, scores: dict[str, int], least: float) -> Talk:
    """The conversation as the model rewrites it, under a new id, if any score is low.

    The same conversation stays if none is, or if what comes back is no conversation: messages of known roles, from a user
    or the system on (V7).
    """
    low = [d for d in DIMENSIONS if scores[d] < least]
    if not low:
        return talk
    try:
        read = complete_json(model, f"REPAIR\nBetter in {', '.join(low)}\n{repair_text(talk.messages, talk.outputs, talk.scenario)}").get("messages")
    except ModelError:
        return talk
    if not isinstance(read, list) or not read or not all(isinstance(m, dict) for m in read):
        return talk
    said = [{"role": m.get("role", "user"), "content": m.get("content"), "tool_calls": m.get("tool_calls"), "tool_call_id": m.get("tool_call_id")} for m in read]
    if said[0]["role"] not in ("user", "system") or any(m["role"] not in ROLES for m in said):
        return talk
    return mended_talk(talk, said)


def converse(model: Model, talk: Talk, turns: int = 20) -> None:
    """Until the chain is done, or after so many turns. A talk that was left goes on after its last message."""
    if not talk.goal:
        plan(model, talk)
    at, role = sum(m["role"] == "user" for m in talk.messages), talk.messages[-1]["role"] if talk.messages else "tool"
    while role != "tool" or (at < turns and (at == 0 or len(talk.outputs) < len(talk.chain))):
        if role == "tool":
            user_turn(model, talk)
            at += 1
        if role != "assistant":
            assistant_turn(model, talk)
        while tool_turn(model, talk):
            pass
        role = "tool"


@dataclass
class Course:
    """How far a conversation has come: the attempt under way, and what came of the last one that was judged."""

    attempt: int = 1
    talk: Talk | None = None
    scores: dict[str, int] | None = None
    #: The talk after its repair; the talk itself if it needed none or can't be mended.
    mended: Talk | None = None
    error: str | None = None
    #: The attempt, its talk as mended, its scores, whether it was repaired.
    last: tuple[int, Talk, dict[str, int], bool] | None = None


def generate_one(model: Model, id_: str, chains: list[list[str]], threshold: float = 6.0, least: float = 6.0, turns: int = 20, course: Course | None = None) -> dict:
    """One attempt a chain: talk, judge, repair what is low, judge again; the first that passes counts.

    A course that was left goes on where it stopped.
    """
    c = course or Course()
    while c.attempt <= len(chains):
        c.talk = c.talk or Talk(f"{id_}-{c.attempt}", chains[c.attempt - 1])
        try:
            if c.scores is None:
                converse(model, c.talk, turns)
                c.scores = judge(model, c.talk)
            if c.mended is None:
                c.mended = repair(model, c.talk, c.scores, least) if min(c.scores.values()) < least else c.talk
            repaired = c.mended is not c.talk
            scores = judge(model, c.mended) if repaired else c.scores
            c.last = (c.attempt, c.mended, scores, repaired)
            if sum(scores.values()) / 4 >= threshold:
                return _row(id_, True, c.attempt, c.last, None)
            c.error = "judged too low"
        except ModelError as e:
            c.error = str(e)
        c.attempt, c.talk, c.scores, c.mended = c.attempt + 1, None, None, None
    return _row(id_, False, len(chains), c.last, c.error)


def _row(id_: str, success: bool, attempts: int, last, error: str | None) -> dict:
    _, talk, scores, repaired = last or (0, Talk(id_, []), dict.fromkeys(DIMENSIONS), False)
    ids = [o["endpoint_id"] for o in talk.outputs]
    return {"conversation_id": talk.id, "success": success, "attempts": attempts, "repaired": repaired, "error": error, "messages": talk.messages, "tool_outputs": talk.outputs, **scores, "endpoint_ids": ids}


#: Rows that a worker hands back at a time, so that what it holds doesn't grow with its part.
ROWS = 200


def _fitted(value, kind: pa.DataType):
    """A value as its column can hold it: what a model gives in place of a text becomes one, in place of a list or an object nothing."""
    if value is None or pa.types.is_string(kind):
        return value if value is None or isinstance(value, str) else str(value)
    if pa.types.is_list(kind):
        return [_fitted(v, kind.value_type) for v in value] if isinstance(value, list) else None
    if pa.types.is_struct(kind):
        return {f.name: _fitted(value.get(f.name), f.type) for f in kind} if isinstance(value, dict) else None
    return value


def to_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    try:
        return pa.RecordBatch.from_pylist(rows, schema=schema)
    except (pa.ArrowInvalid, pa.ArrowTypeError):
        return pa.RecordBatch.from_pylist([{f.name: _fitted(r.get(f.name), f.type) for f in schema} for r in rows], schema=schema)


def _values(column: pa.Array) -> list:
    """The column's values, made level by level: to_pylist makes an object of Arrow's for each on the way."""
    kind = column.type
    if pa.types.is_string(kind):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_list(kind):
        held, ends = _values(column.flatten()), np.cumsum(column.value_lengths().fill_null(0)).tolist()
        return [held[a:b] if there else None for a, b, there in zip([0, *ends], ends, column.is_valid().to_numpy(zero_copy_only=False))]
    if pa.types.is_struct(kind) and not column.null_count:
        names = [f.name for f in kind]
        return [dict(zip(names, x)) for x in zip(*map(_values, column.flatten()))]
    return column.to_pylist()


def from_batch(batch: pa.RecordBatch) -> list[dict]:
    """The batch's rows."""
    return [dict(zip(batch.schema.names, x)) for x in zip(*map(_values, batch.columns))]


def generate(chains: DataFrame, model: Model, threshold: float = 6.0, turns: int = 20, window: int = 1) -> DataFrame:
    """Results (RESULT) for chains(conv, attempts array<array<string>>).

    A worker has up to `window` conversations, and so requests, in flight; the model must then bear several threads.
    """

    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def one(row: dict) -> dict:
        return generate_one(model, str(row["conv"]), row["attempts"] or [], threshold, turns=turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                yield to_batch(list(in_flight(one, from_batch(batch.slice(k, ROWS)), window)), schema)

    return chains.select(F.col("conv").cast("string"), "attempts").mapInArrow(run, RESULT)


def generate_steered(sample, model: Model, batches: int, **options) -> DataFrame:
    """L12 with feedback: sample(results so far, or None) -> chains, once a batch; weights lag one batch behind."""
    from ..storage import stored

    done = None
    for _ in range(batches):
        made = stored(generate(sample(done), model, **options), "results")
        done = made if done is None else done.unionByName(made)
    return done


# -- missing fields of endpoints --


def infer_fields(endpoints: DataFrame, model: Model, cached: DataFrame | None = None, window: int = 1) -> DataFrame:
    """(endpoint_id, field, parameter, value, cached) for missing descriptions, response schemas and parameter types.

    What is asked for is a table, so cached answers (key, value) are joined away first.
    """
    ask = lambda kind, field, where, parameter, text: where.select(F.col("id").alias("endpoint_id"), F.lit(field).alias("field"), parameter.alias("parameter"), F.concat(F.lit(kind + "\n"), text).alias("prompt"))
    what = F.concat_ws(" ", "method", "path", "name")
    none = F.lit(None).cast("string")
    unknown = endpoints.select("id", "method", "path", "name", F.explode("parameters").alias("p")).where("p.type = 'unknown'")
    asked = (
        ask("DESCRIBE", "description", endpoints.where(is_blank("description")), none, what)
        .unionByName(ask("SCHEMA", "response_schema", endpoints.where("response_schema is null"), none, what))
        .unionByName(ask("TYPE", "type", unknown, F.col("p.name"), F.concat_ws(" ", what, F.col("p.name"))))
        .withColumn("key", F.md5("prompt"))
    )
    known = asked.join(cached, "key") if cached is not None else None
    new = asked.join(cached.select("key"), "key", "left_anti") if cached is not None else asked

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def asked(prompt: str) -> str | None:
            try:
                return complete(model, prompt)
            except ModelError:
                return None

        for part in parts:
            answers = list(in_flight(asked, part["prompt"], window))
            yield part[["endpoint_id", "field", "parameter", "key"]].assign(answer=answers)

    made = new.select("endpoint_id", "field", "parameter", "key", "prompt").mapInPandas(run, "endpoint_id string, field string, parameter string, key string, answer string")
    value = F.when(F.col("field") == "type", parse_type("answer")).when(F.col("field") == "response_schema", parse_response_schema("answer")).otherwise(F.trim("answer"))
    out = made.select("endpoint_id", "field", "parameter", value.alias("value"), F.lit(False).alias("cached"), "key")
    return out if known is None else out.unionByName(known.select("endpoint_id", "field", "parameter", "value", F.lit(True).alias("cached"), "key"))


def apply_inferred(endpoints: DataFrame, inferred: DataFrame) -> DataFrame:
    """Endpoints with inferred descriptions and response schemas where theirs are missing, and the fields' names."""
    wide = inferred.where("field <> 'type'").groupBy(F.col("endpoint_id").alias("id")).agg(
        F.max(F.when(F.col("field") == "description", F.col("value"))).alias("_d"), F.max(F.when(F.col("field") == "response_schema", F.col("value"))).alias("_r"), F.array_sort(F.collect_set("field")).alias("inferred_fields"),
    )
    out = endpoints.join(wide, "id", "left")
    return out.withColumn("description", F.when(is_blank("description"), F.col("_d")).otherwise(F.col("description"))).withColumn("response_schema", F.coalesce("response_schema", "_r")).drop("_d", "_r")


def inference_stats(inferred: DataFrame) -> DataFrame:
    """A15."""
    return inferred.groupBy("field").agg(F.count("*").alias("n"), F.count_if("cached").alias("cached"), F.count_if(F.col("value").isNull()).alias("failed"))
