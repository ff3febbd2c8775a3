"""Structure of conversations: what is missing or malformed, as texts in a fixed order.

Conversations have the columns of functions.conversation.CONVERSATION; a single message a row works too (turn_errors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank

ROLES = ("user", "assistant", "tool", "system")


def _list(*checks: Column) -> Column:
    """The texts that are there."""
    return F.array_compact(F.array(*checks))


def _empty() -> Column:
    return F.array().cast("array<string>")


def message_errors(role: Column, content: Column, has_calls: Column, call_id: Column, at: Column) -> Column:
    """V3: what is wrong with a message; at: where it stands."""
    say = lambda text: F.concat(at, F.lit(f": {text}"))
    blank = is_blank(content)
    return _list(
        F.when(role.isNull(), say("role is missing")).when(~role.isin(*ROLES), F.concat(at, F.lit(": invalid role '"), role, F.lit("'"))),
        F.when((role == "user") & blank, say("user message needs content")),
        F.when((role == "assistant") & blank & ~has_calls, say("assistant message needs content or tool calls")),
        F.when((role == "tool") & blank, say("tool message needs content")),
        F.when((role == "tool") & call_id.isNull(), say("tool message needs a call id")),
    )


def _call_errors(message: Column, at: Column, arguments: bool) -> Column:
    """V4: what is wrong with a message's tool calls."""

    def one(call: Column, j: Column) -> Column:
        say = lambda text: F.concat(at, F.lit(".tool_calls["), j.cast("string"), F.lit(f"]: {text}"))
        f = call["function"]
        shape = F.when(f.isNull(), say("needs a function"))
        if not arguments:
            return _list(shape)
        return _list(
            shape, F.when(f.isNotNull() & is_blank(f["name"]), say("name must not be empty")), F.when(f.isNotNull() & f["arguments"].isNull(), say("arguments are missing")),
            F.when(f["arguments"].isNotNull() & F.try_parse_json(f["arguments"]).isNull(), say("arguments are not JSON")),
        )

    return F.coalesce(F.flatten(F.transform(message["tool_calls"], one)), _empty())


def _of_messages(arguments: bool) -> Column:
    def one(m: Column, i: Column) -> Column:
        at = F.concat(F.lit("messages["), i.cast("string"), F.lit("]"))
        return F.concat(message_errors(m["role"], m["content"], F.coalesce(F.size(m["tool_calls"]) > 0, F.lit(False)), m["tool_call_id"], at), _call_errors(m, at, arguments))

    return F.when(F.col("messages").isNull(), F.array(F.lit("messages are missing"))).when(F.size("messages") == 0, F.array(F.lit("messages are empty"))).otherwise(F.flatten(F.transform("messages", one)))


def _of_id() -> Column:
    return _list(F.when(F.col("conversation_id").isNull(), F.lit("conversation id is missing")).when(is_blank("conversation_id"), F.lit("conversation id is empty")))


def _of_outputs() -> Column:
    """V5."""

    def one(o: Column, i: Column) -> Column:
        say = lambda text: F.concat(F.lit("tool_outputs["), i.cast("string"), F.lit(f"]: {text}"))
        is_object = lambda c: F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))
        return _list(
            F.when(is_blank(o["endpoint_id"]), say("endpoint id must not be empty")), F.when(o["arguments"].isNotNull() & ~is_object(o["arguments"]), say("arguments must be an object")),
            F.when(o["result"].isNotNull() & ~is_object(o["result"]), say("result must be an object")), F.when(is_blank(o["call_id"]), say("call id must not be empty")),
        )

    return F.coalesce(F.flatten(F.transform("tool_outputs", one)), _empty())


def validate_structure(conversations: DataFrame) -> DataFrame:
    """V1–V5: adds errors (id, then messages, then outputs) and is_valid."""
    return conversations.withColumn("errors", F.concat(_of_id(), _of_messages(True), _of_outputs())).withColumn("is_valid", F.size("errors") == 0)


def validate_read(conversations: DataFrame) -> DataFrame:
    """V6: the lighter check of conversations that were read: no arguments, no outputs."""
    return conversations.withColumn("errors", F.concat(_of_id(), _of_messages(False))).withColumn("is_valid", F.size("errors") == 0)


def turn_errors(turns: DataFrame, role: str = "role", text: str = "text", call_id: str | None = None) -> DataFrame:
    """V3 for one message a row: adds errors."""
    at = F.concat(F.lit("messages["), F.col("turn").cast("string"), F.lit("]"))
    return turns.withColumn("errors", message_errors(F.col(role), F.col(text), F.lit(False), F.col(call_id) if call_id else F.lit(None).cast("string"), at))


def roles_repairable() -> Column:
    """V7: a repaired conversation has messages, all of known roles."""
    return F.coalesce((F.size("messages") > 0) & F.forall("messages", lambda m: F.coalesce(m["role"].isin(*ROLES), F.lit(False))), F.lit(False))
