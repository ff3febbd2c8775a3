"""Conversations as rows with arrays of messages: prompts' texts, definitions and values."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from json.encoder import encode_basestring_ascii

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, StructType

from .text import _col, blank_as_null, is_blank

TOOL_CALL = "struct<id:string,function:struct<name:string,arguments:string>>"
MESSAGE = f"struct<role:string,content:string,tool_calls:array<{TOOL_CALL}>,tool_call_id:string>"
TOOL_OUTPUT = "struct<endpoint_id:string,arguments:string,result:string,call_id:string,success:boolean>"
CONVERSATION = f"conversation_id string, messages array<{MESSAGE}>, tool_outputs array<{TOOL_OUTPUT}>, grounding map<string,string>, generated_ids map<string,string>"


def from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conversation_id, messages) from a table of one message a row, in the order of turns."""
    rows = turns.select(F.col(conv).cast("string").alias("conversation_id"), F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")).alias("m"))
    message = lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.lit(None).cast(f"array<{TOOL_CALL}>").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"))
    return rows.groupBy("conversation_id").agg(F.transform(F.array_sort(F.collect_list("m")), message).alias("messages"))


def history_text(messages) -> Column:
    """P25. What users, assistants and the system said; tool messages and empty answers are left out."""
    spoken = F.filter(_col(messages), lambda m: m["role"].isin("user", "system") | ((m["role"] == "assistant") & (F.coalesce(m["content"], F.lit("")) != "")))
    return F.array_join(F.transform(spoken, lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), F.coalesce(m["content"], F.lit("None")))), "\n")


def history_of_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """P25 over one message a row: (conv, history)."""
    line = F.concat(F.initcap("role"), F.lit(": "), F.col("text"))
    spoken = turns.where(F.col("role").isin("user", "system") | ((F.col("role") == "assistant") & (F.coalesce("text", F.lit("")) != "")))
    return spoken.groupBy(conv).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda m: m["line"]), "\n").alias("history"))


def values_text(grounding, generated) -> Column:
    """P26."""

    def lines(title: str, values) -> Column:
        entries = F.transform(F.map_entries(_col(values)), lambda e: F.concat(F.lit("  - "), e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))))
        return F.when(F.size(_col(values)) > 0, F.concat(F.lit(f"{title}:\n"), F.array_join(entries, "\n")))

    return F.concat_ws("\n", lines("Available values", grounding), lines("Generated IDs", generated))


def judge_transcript(messages) -> Column:
    """P27. One line a message, tool calls on lines of their own, tool answers cut to 200 characters."""

    def lines(m: Column) -> Column:
        said = F.coalesce(m["content"], F.lit("None"))
        calls = F.transform(
            F.coalesce(m["tool_calls"], F.array().cast(f"array<{TOOL_CALL}>")),
            lambda c: F.concat(F.lit("Assistant [Tool Call]: "), F.coalesce(c["function"]["name"], F.lit("unknown")), F.lit("("), F.coalesce(c["function"]["arguments"], F.lit("{}")), F.lit(")")),
        )
        spoken = F.when(F.coalesce(m["content"], F.lit("")) != "", F.array(F.concat(F.lit("Assistant: "), said))).otherwise(F.array().cast("array<string>"))
        return (
            F.when(m["role"] == "user", F.array(F.concat(F.lit("User: "), said)))
            .when(m["role"] == "assistant", F.concat(spoken, calls))
            .when(m["role"] == "tool", F.array(F.concat(F.lit("Tool Response: "), F.substring(said, 1, 200), F.lit("..."))))
            .otherwise(F.array().cast("array<string>"))
        )

    text = F.array_join(F.flatten(F.transform(_col(messages), lines)), "\n")
    return F.coalesce(blank_as_null(text), F.lit("No messages"))


def low_score_feedback(scores: dict[str, Column | str], reasoning, least: float = 6.0) -> Column:
    """P28. A line for each judged dimension below the least score, in our own words, then the judge's reasons."""
    advice = {
        "tool_correctness": ("Tool Correctness", "choose the tools that fit the task, in a sensible order"),
        "argument_grounding": ("Argument Grounding", "take arguments from what tools or the user said, and nowhere else"),
        "task_completion": ("Task Completion", "bring the user's goal to its end"),
        "naturalness": ("Naturalness", "let the messages sound like people talking"),
    }
    lines = [F.when(_col(scores[k]) < least, F.concat(F.lit(f"- {title} ("), _col(scores[k]).cast("string"), F.lit(f"/10): {what}."))) for k, (title, what) in advice.items()]
    why = F.concat(F.lit("\nReasons given: "), blank_as_null(reasoning))
    return F.concat_ws("\n", *lines, why)


def content_blocks(message: Column) -> Column:
    """P29. A message as blocks of type text, tool_use or tool_result."""
    block = lambda kind, text, id_, name, args: F.struct(F.lit(kind).alias("type"), text.alias("text"), id_.alias("id"), name.alias("name"), args.alias("input"))
    none = F.lit(None).cast("string")
    calls = F.transform(F.coalesce(message["tool_calls"], F.array().cast(f"array<{TOOL_CALL}>")), lambda c: block("tool_use", none, c["id"], c["function"]["name"], F.coalesce(c["function"]["arguments"], F.lit("{}"))))
    text = F.filter(F.array(block("text", message["content"], none, none, none)), lambda b: F.coalesce(b["text"], F.lit("")) != "")
    return F.when(message["role"] == "tool", F.array(block("tool_result", message["content"], message["tool_call_id"], none, none))).otherwise(F.concat(text, calls))


def text_of_blocks(blocks) -> Column:
    """P29. The text blocks joined by line ends."""
    return F.array_join(F.transform(F.filter(_col(blocks), lambda b: b["type"] == "text"), lambda b: b["text"]), "\n")


def calls_of_blocks(blocks) -> Column:
    """P29. Tool calls of a model's answer."""
    return F.transform(F.filter(_col(blocks), lambda b: b["type"] == "tool_use"), lambda b: F.struct(b["id"].alias("id"), F.struct(b["name"].alias("name"), b["input"].alias("arguments")).alias("function")))


def input_schema(parameters) -> Column:
    """P19. A JSON schema of parameters: unknown types count as strings; default, enum and required only where given."""
    named = F.filter(_col(parameters), lambda p: F.coalesce(p["name"], F.lit("")) != "")
    one = lambda p: F.struct(
        F.when(p["type"] == "unknown", "string").otherwise(p["type"]).alias("type"),
        F.coalesce(blank_as_null(p["description"]), F.concat(F.lit("Parameter "), p["name"])).alias("description"),
        F.when(F.size(p["enum"]) > 0, p["enum"]).alias("enum"),
        p["default"].alias("default"),
    )
    required = F.transform(F.filter(named, lambda p: p["required"]), lambda p: p["name"])
    properties = F.map_from_entries(F.transform(named, lambda p: F.struct(p["name"], one(p))))
    return F.to_json(F.struct(F.lit("object").alias("type"), properties.alias("properties"), F.when(F.size(required) > 0, required).alias("required")))


def tool_definition(id_, name, description, parameters) -> Column:
    """P20."""
    return F.struct(_col(id_).alias("name"), F.coalesce(blank_as_null(description), F.concat(F.lit("Call "), _col(name))).alias("description"), input_schema(parameters).alias("input_schema"))


#: JSON schema types of Spark's; all others are strings.
_JSON_TYPES = {"tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "integer", "float": "number", "double": "number", "boolean": "boolean"}


def _json_schema(kind: DataType) -> dict:
    if isinstance(kind, StructType):
        needed = [f.name for f in kind if not f.nullable]
        return {"type": "object", "properties": {f.name: _json_schema(f.dataType) for f in kind}, **({"required": needed} if needed else {})}
    if isinstance(kind, ArrayType):
        return {"type": "array", "items": _json_schema(kind.elementType)}
    return {"type": "number" if isinstance(kind, DecimalType) else _JSON_TYPES.get(kind.simpleString(), "string")}


def tool_of_schema(name: str, description: str, schema: StructType) -> dict:
    """A tool whose input has these fields; those that can't be null are required."""
    return {"name": name, "description": description, "input_schema": _json_schema(schema)}


def entity_id(kind, conversation) -> Column:
    """P33. An id for a kind of thing that stays the same within a conversation."""
    return F.concat(_col(kind), F.lit("_"), F.substring(F.md5(F.concat_ws("\u0001", _col(conversation), _col(kind))), 1, 8))


def mock_result(endpoint, call_id) -> Column:
    """P32. A result that stands in for a tool that can't be simulated."""
    endpoint, call = F.coalesce(_col(endpoint), F.lit("unknown")), F.coalesce(_col(call_id), F.lit("call_unknown"))
    tail = F.when(F.length(call) > 8, F.substring(call, -8, 8)).otherwise("001")
    data = F.struct(F.concat(F.lit("Mock response for "), endpoint).alias("message"), F.lit("2024-01-15T10:30:00Z").alias("timestamp"))
    return F.to_json(F.struct(F.lit("success").alias("status"), F.concat_ws("_", endpoint, tail).alias("id"), data.alias("data")))


# -- values inside JSON results: objects of any depth, so walked in Python over Arrow batches --

# Keys whose values are worth keeping.
NAME_KEYS = "name full_name first_name last_name"
NUMBER_KEYS = "total amount price balance quantity"
GROUNDING_KEYS = (
    "id user_id order_id booking_id transaction_id name email phone total amount price balance status confirmation_number"
    " temperature weather condition flight_number departure arrival"
)


def _load(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def _as_text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


# The words, in the order that results depend on.
#: Which scalars are kept, and under what name: the first rule whose word is met decides. How a word is met, the words,
#: the name given, and the kinds of values (None: any).
KEPT = (
    ("is", "id", "owner", None), ("ends", "_id", "key", None), ("holds", "status state", "key", None), ("is", NAME_KEYS, "path", None),
    ("is", NUMBER_KEYS, "path", int | float), ("holds", "confirmation reference", "key", None), ("is", "email", "key", str),
)
_MET = {"is": str.__eq__, "ends": str.endswith, "holds": str.__contains__}


def _kept_name(key: str, value, parent: str) -> str | None:
    """Under which name a scalar is kept, if it is."""
    rule = next((r for r in KEPT if any(_MET[r[0]](key.lower(), word) for word in r[1].split())), None)
    if rule is None or (rule[3] is not None and not isinstance(value, rule[3])):
        return None
    before = f"{parent}_" if parent else ""
    return {"key": key, "path": before + key, "owner": f"{before}id" if parent else key}[rule[2]]


def extract_values(data) -> dict[str, str]:
    """P30. Ids, states, names, amounts, references and addresses, with the parent's key where they need one."""
    found: dict[str, str] = {}
    todo = [(data, "")]
    while todo:
        node, parent = todo.pop()
        if isinstance(node, list):
            node = node[0] if node and isinstance(node[0], dict) else None
        if not isinstance(node, dict):
            continue
        inner = []
        for key, value in node.items():
            if isinstance(value, dict | list):
                inner.append((value, key))
            elif value is not None and (name := _kept_name(key, value, parent)):
                found[name] = _as_text(value)
        todo += reversed(inner)
    return found


@functools.lru_cache(4096)
def _grounds(key: str) -> bool:
    return any(w in key.lower() for w in GROUNDING_KEYS.split())


def grounding_values(data) -> dict[str, str]:
    """P31. Scalars whose keys hold one of the known words, under their full path; lists are passed over."""
    found, todo = {}, [(data, "")]
    while todo:
        node, path = todo.pop()
        if not isinstance(node, dict):
            continue
        inner = []
        for key, value in node.items():
            if isinstance(value, dict):
                inner.append((value, f"{path}{key}_"))
            elif value is not None and not isinstance(value, list) and _grounds(key):
                found[path + key] = _as_text(value)
        todo += reversed(inner)
    return found


def _mapped(walk):
    @F.pandas_udf("map<string,string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(lambda t: walk(_load(t)))

    return run


def extracted_values(x) -> Column:
    """P30 of a column of JSON."""
    return _mapped(extract_values)(_col(x))


def extracted_grounding(x) -> Column:
    """P31 of a column of JSON."""
    return _mapped(grounding_values)(_col(x))


# -- rows of single messages --


def first_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """F11. Whether each message is the first of its conversation, and how many user messages stand before it."""
    w = Window.partitionBy(conv).orderBy("turn")
    return turns.withColumn("is_initial", F.row_number().over(w) == 1).withColumn("users_before", F.coalesce(F.sum((F.col("role") == "user").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def at_disambiguation(users_before, points: list[int]) -> Column:
    """F11."""
    return _col(users_before).isin(points) if points else F.lit(False)


def last_assistant(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """W7. The last assistant message that says something."""
    said = turns.where((F.col("role") == "assistant") & ~is_blank("text"))
    return said.groupBy(conv).agg(F.max_by("text", "turn").alias("text"), F.max("turn").alias("turn"))


def pending_call(messages) -> Column:
    """F12. In the last assistant message with calls, the first call that no tool message answers."""
    all_ = _col(messages)
    calls = F.element_at(F.concat(F.array(F.array().cast(f"array<{TOOL_CALL}>")), F.transform(F.filter(all_, lambda m: (m["role"] == "assistant") & (F.size(m["tool_calls"]) > 0)), lambda m: m["tool_calls"])), -1)
    answered = F.transform(F.filter(all_, lambda m: m["role"] == "tool"), lambda m: m["tool_call_id"])
    return F.get(F.filter(calls, lambda c: ~F.array_contains(answered, c["id"])), F.lit(0))


def answered_calls(conversations: DataFrame) -> DataFrame:
    """(conversation_id, call_id, name, arguments, answer): each tool call with what the tool said, null if nothing yet.

    Calls and answers of a conversation are matched inside its row, so nothing is joined.
    """
    none = F.array().cast(f"array<{TOOL_CALL}>")
    calls = F.flatten(F.transform("messages", lambda m: F.coalesce(m["tool_calls"], none)))
    answers = F.filter("messages", lambda m: m["role"] == "tool")
    found = conversations.select("conversation_id", answers.alias("answers"), F.explode(calls).alias("c"))
    answer = F.get(F.filter("answers", lambda m: m["tool_call_id"] == F.col("c.id")), F.lit(0))["content"]
    return found.select("conversation_id", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("arguments"), answer.alias("answer"))


def append_message(messages, role: str, content) -> Column:
    """X1."""
    return F.array_append(_col(messages), F.struct(F.lit(role).alias("role"), _col(content).alias("content"), F.lit(None).cast(f"array<{TOOL_CALL}>").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id")))


def is_complete(tool_outputs, target) -> Column:
    """Whether as many tools answered as were planned."""
    return F.greatest(F.size(_col(tool_outputs)), F.lit(0)) >= (_col(target) if not isinstance(target, int) else F.lit(target))


def turn_stats(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    return turns.groupBy(conv).agg(F.count("*").alias("n_turns"), F.count_if(F.col("role") == "user").alias("n_user"), F.count_if(F.col("role") == "assistant").alias("n_assistant"), F.sum(F.length("text")).alias("n_chars"))


def iso_time(time) -> Column:
    """A time in ISO form, with microseconds where it has some; null stays."""
    time = _col(time)
    return F.when(F.date_format(time, "SSSSSS") == "000000", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def output_of(contexts: DataFrame) -> DataFrame:
    """(conversation_id, messages, tool_outputs, metadata) of contexts(conversation_id, messages, tool_outputs,
    scenario_description, tool_chain, target_steps, seed, start_time); messages and outputs have a timestamp too."""
    pick = lambda column, names: F.transform(column, lambda x: F.struct(*[(iso_time(x[n]) if n == "timestamp" else x[n]).alias(n) for n in names.split()]))
    about = F.struct("scenario_description", "tool_chain", "target_steps", "seed", iso_time("start_time").alias("start_time"))
    return contexts.select(
        "conversation_id", pick("messages", "role content tool_calls tool_call_id timestamp").alias("messages"),
        pick("tool_outputs", "endpoint_id arguments result call_id timestamp success").alias("tool_outputs"), about.alias("metadata"),
    )


def compact(value) -> str:
    """json.dumps(value), which makes a new encoder at each call: for what is small, that is most of its time."""
    text, kind = encode_basestring_ascii, type(value)
    if kind is str:
        return text(value)
    if kind is list:
        return f"[{', '.join([text(v) if type(v) is str else compact(v) for v in value])}]"
    if kind is dict and set(map(type, value)) <= {str}:
        return f"{{{', '.join([f'{text(k)}: {text(v) if type(v) is str else compact(v)}' for k, v in value.items()])}}}"
    return "null" if value is None else json.dumps(value)


def _indented(value, end: str = "\n") -> str:
    """json.dumps(value, indent=2), which is slow: with an indent it encodes piece by piece in Python."""
    inner, text = end + "  ", encode_basestring_ascii
    if type(value) is list and value:
        return f"[{inner}{f',{inner}'.join([text(v) if type(v) is str else _indented(v, inner) for v in value])}{end}]"
    if type(value) is dict and set(map(type, value)) == {str}:
        return f"{{{inner}{f',{inner}'.join([f'{text(k)}: {text(v) if type(v) is str else _indented(v, inner)}' for k, v in value.items()])}{end}}}"
    return json.dumps(value, indent=2).replace("\n", end)


def repair_text(messages: list[dict], outputs: list[dict], scenario: dict | None) -> str:
    """A conversation as JSON for the prompt of a repair: calls and their ids only where there are some."""
    said = [{"role": m["role"], "content": m["content"], **{k: m[k] for k in ("tool_calls", "tool_call_id") if m.get(k)}} for m in messages]
    data = {"messages": said, "tool_outputs": [{k: o[k] for k in ("endpoint_id", "arguments", "result", "call_id")} for o in outputs], "scenario": scenario or {}}
    return _indented(data)


def _parsed_list(text: Column, schema: str) -> Column:
    return F.coalesce(F.from_json(text, schema), F.from_json(F.lit("[]"), schema))


PLANNED_PARAMETERS = "array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>,default:string>>"


def planner_endpoints(chains: DataFrame, endpoints: DataFrame) -> DataFrame:
    """X11 by registry: (conv, at, and the endpoint's columns) of chains(conv, chain: ids); unknown ids are dropped."""
    return chains.select("conv", F.posexplode("chain").alias("at", "id")).join(endpoints, "id")


def planner_chain_data(chains: DataFrame, nodes: DataFrame) -> DataFrame:
    """X11 by chain data: (conv, at, id, name, description, tool_id, domain, parameters) of chains(conv, chain: structs of
    endpoint_id, name, tool_id and domain), with names, descriptions and parameters of nodes(id, name, description,
    parameters_json); steps without a node stay, and parameters that aren't JSON are an empty list."""
    steps = chains.select("conv", F.posexplode("chain").alias("at", "s")).select("conv", "at", F.coalesce("s.endpoint_id", F.lit("")).alias("id"), "s.name", "s.tool_id", "s.domain")
    known = nodes.select("id", F.col("name").alias("_name"), F.col("description").alias("_description"), "parameters_json")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return steps.join(known, "id", "left").select(
        "conv", "at", "id", F.coalesce("_name", "name", "id").alias("name"), blank("_description").alias("description"), blank("tool_id").alias("tool_id"), blank("domain").alias("domain"),
        _parsed_list(F.col("parameters_json"), PLANNED_PARAMETERS).alias("parameters"),
    )


def user_goal(scenario: dict, description: str | None = None) -> str:
    """The scenario's goal, else its description, else a constant."""
    return scenario.get("user_goal") or description or scenario.get("description") or "Complete the task"


def available_tools(scenario: dict) -> list[dict]:
    """The tools that a scenario makes available."""
    return scenario.get("available_tools") or []
