"""Registered queries of generation. The offline model answers by MD5 sums, so SQL can hold the same conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import Tables, query
from .operators import generation, quality, rounds
from .storage import new_path

_TURNS = 20


def _hash(prompt: str) -> str:
    """SQL of the model's number for a prompt."""
    return f"CAST('0x' || substr(md5({prompt}), 1, 15) AS BIGINT)"


def _said(task: str, rest: str) -> str:
    """SQL of the model's text for a task and what stands below its name."""
    return f"'{task.lower()} ' || {_hash(f"'{task}' || chr(10) || {rest}")} % 1000000 || ': ' || trim(right({rest}, 40), ' ' || chr(10))"


def _quoted(text: str) -> str:
    """SQL of a text as a JSON string."""
    return f"""'"' || replace(replace(replace({text}, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '"'"""


def _judged(history: str, name: str) -> str:
    """SQL of four scores, as a struct, of a conversation."""
    scores = ", ".join(f"'{d}': 5 + (({name}) >> {8 * k}) % 6" for k, d in enumerate(quality.DIMENSIONS))
    return f"{{{scores}}}".replace(name, _hash(f"'JUDGE' || chr(10) || 'Goal: ' || goal || chr(10) || {history}"))


_LOW = "concat_ws(', ', " + ", ".join(f"CASE WHEN judged.{d} < 6 THEN '{d}' END" for d in quality.DIMENSIONS) + ")"
_LEAST = "least(" + ", ".join(f"judged.{d}" for d in quality.DIMENSIONS) + ")"
_SUM = " + ".join(f"scores.{d}" for d in quality.DIMENSIONS)

#: Both attempts of each order, turn by turn: a user, an assistant that calls the next tool, and the tool's answer; then scores and repair.
_TALKS = f"""WITH RECURSIVE o AS (SELECT l_orderkey AS conv, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS chain FROM lineitem GROUP BY 1),
a AS (SELECT conv, 1 AS attempt, chain FROM o UNION ALL SELECT conv, 2, list_reverse(chain) FROM o),
p AS (SELECT *, conv || '-' || attempt AS id, {_hash("'SCENARIO' || chr(10) || 'Invent a user who needs these tools in turn: ' || array_to_string(chain, ', ')")} AS h FROM a),
t(conv, attempt, id, chain, description, goal, step, answer_id, history, before, answer, said, outputs) AS (
  SELECT conv, attempt, id, chain, 'scenario ' || h % 1000, 'goal ' || h % 97, 0, CAST(NULL AS VARCHAR), '', '', '', '', '' FROM p
  UNION ALL
  SELECT conv, attempt, id, chain, description, goal, step + 1, new_id, h2 || chr(10) || 'tool: ' || result, h1, result,
    CASE WHEN step > 0 THEN said || ',' || chr(10) ELSE '' END || '    {{' || chr(10) || '      "role": "user",' || chr(10) || '      "content": ' || {_quoted("u")} || chr(10) || '    }},' || chr(10)
      || '    {{' || chr(10) || '      "role": "assistant",' || chr(10) || '      "content": ' || {_quoted("s")} || ',' || chr(10) || '      "tool_calls": [' || chr(10) || '        {{' || chr(10) || '          "id": "' || call || '",' || chr(10)
      || '          "function": {{' || chr(10) || '            "name": "' || tool || '",' || chr(10) || '            "arguments": ' || {_quoted("arguments")} || chr(10) || '          }}' || chr(10) || '        }}' || chr(10) || '      ]' || chr(10) || '    }},' || chr(10)
      || '    {{' || chr(10) || '      "role": "tool",' || chr(10) || '      "content": ' || {_quoted("result")} || ',' || chr(10) || '      "tool_call_id": "' || call || '"' || chr(10) || '    }}',
    CASE WHEN step > 0 THEN outputs || ',' || chr(10) ELSE '' END || '    {{' || chr(10) || '      "endpoint_id": "' || tool || '",' || chr(10) || '      "arguments": ' || {_quoted("arguments")} || ',' || chr(10)
      || '      "result": ' || {_quoted("result")} || ',' || chr(10) || '      "call_id": "' || call || '"' || chr(10) || '    }}'
  FROM (SELECT *, '{{"status": "success", "id": "' || new_id || '"}}' AS result FROM (
    SELECT *, lpad(CAST({_hash("'TOOL' || chr(10) || tool || '(' || arguments || ')' || chr(10) || 'as call ' || call")} % 100000000 AS VARCHAR), 8, '0') AS new_id FROM (
    SELECT *, h1 || chr(10) || 'assistant: ' || s AS h2 FROM (
    SELECT *, {_said("ASSISTANT", "asked")} AS s FROM (
    SELECT *, 'Goal: ' || goal || chr(10) || 'Step ' || step || chr(10) || h1 AS asked FROM (
    SELECT *, CASE WHEN step > 0 THEN history || chr(10) ELSE '' END || 'user: ' || u AS h1 FROM (
    SELECT *, {_said("USER", "wanted")} AS u FROM (
    SELECT *, 'Your goal: ' || goal || chr(10) || 'Known: ' || known || chr(10) || 'So far:' || chr(10) || history AS wanted FROM (
    SELECT *, chain[step + 1] AS tool, 'call_' || id || '_' || step AS call,
      CASE WHEN step = 0 THEN '{{}}' ELSE '{{"status": "success", "id": "' || answer_id || '"}}' END AS known, CASE WHEN step = 0 THEN '{{}}' ELSE '{{"id": "' || answer_id || '", "status": "success"}}' END AS arguments
    FROM t WHERE step < least(len(chain), {_TURNS}))))))))))),
j AS (SELECT *, {_judged("history", "number")} AS judged FROM t WHERE step = least(len(chain), {_TURNS})),
m AS (SELECT *, {_LEAST} < 6 AS repaired, {_hash(f'''
  'REPAIR' || chr(10) || 'Better in ' || {_LOW} || chr(10) || '{{' || chr(10) || '  "messages": [' || chr(10) || said || chr(10) || '  ],' || chr(10) || '  "tool_outputs": [' || chr(10) || outputs || chr(10) || '  ],' || chr(10)
  || '  "scenario": {{' || chr(10) || '    "description": "' || description || '",' || chr(10) || '    "user_goal": "' || goal || '"' || chr(10) || '  }}' || chr(10) || '}}\'''')} % 1000000 AS mended FROM j),
f AS (SELECT *, CASE WHEN repaired THEN before || chr(10) || 'assistant: repair ' || mended || chr(10) || 'tool: ' || answer ELSE history END AS final FROM m),
k AS (SELECT *, CASE WHEN repaired THEN {_judged("final", "number")} ELSE judged END AS scores FROM f),
r AS (SELECT *, {_SUM} >= 24 AS success FROM k), b AS (SELECT conv, bool_or(success AND attempt = 1) AS first FROM r GROUP BY 1)
SELECT id || CASE WHEN repaired THEN '-r' ELSE '' END AS conversation_id, success, CAST(attempt AS BIGINT) AS attempts, repaired, {", ".join(f"CAST(scores.{d} AS BIGINT) AS {d}" for d in quality.DIMENSIONS)},
CAST(3 * step AS INTEGER) AS n_messages, array_to_string(chain[:step], ',') AS endpoints, md5(final) AS said_md5 FROM r JOIN b USING (conv) WHERE attempt = CASE WHEN first THEN 1 ELSE 2 END"""


def _chains(spark, d: str) -> DataFrame:
    """Each order is asked for its lines' endpoints in turn, and if that is judged too low, from last to first."""
    return Tables(spark, d).chains().select("conv", F.array("chain", F.reverse("chain")).alias("attempts"))


def _shown(results: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return results.select("conversation_id", "success", "attempts", "repaired", *quality.DIMENSIONS, F.size("messages").alias("n_messages"), F.array_join("endpoint_ids", ",").alias("endpoints"), F.md5(said).alias("said_md5"))


@query("generate_fake", _TALKS)
def _(spark, d):
    return _shown(generation.generate(_chains(spark, d), generation.FakeModel(), turns=_TURNS))


@query("generate_rounds", _TALKS)
def _(spark, d):
    return _shown(rounds.generate(_chains(spark, d), generation.FakeModel(), new_path(spark, "rounds"), turns=_TURNS))
