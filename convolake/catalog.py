"""Registered queries over the star-schema tables, each with the same question as SQL for DuckDB.

Roles of the tables: an order is a conversation, its lines are tool calls (supplier: tool, part: endpoint), a part's brand
is its domain and its type a category; orders also stand for judged results, whose scores come from their keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import conversation, scoring, text
from .operators import diversity, graph, metrics, quality, sampling, similarity, validation
from .plans import patterns
from .sources import cache, interchange
from .storage import new_path, stored
from .streaming import tracker

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


class Tables:
    """The tables in one folder, in their roles."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def called(self) -> DataFrame:
        lines = self.lineitem.select(F.col("l_orderkey").alias("conv"), F.col("l_partkey").alias("endpoint"), F.col("l_suppkey").alias("tool"))
        return lines.join(self.part.select(F.col("p_partkey").alias("endpoint"), F.col("p_brand").alias("domain")), "endpoint")

    def registry(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("endpoint"), F.lit(None).cast("long").alias("tool"), F.col("p_brand").alias("domain"))

    def chains(self) -> DataFrame:
        """(conv, chain): the endpoints of each order, in the order of its lines (numbers repeat, so keys settle it)."""
        step = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
        return self.lineitem.groupBy(F.col("l_orderkey").alias("conv")).agg(F.transform(F.array_sort(F.collect_list(step)), lambda s: s["l_partkey"].cast("string")).alias("chain"))

    def endpoints(self) -> DataFrame:
        """Parts as endpoints of the graph: each belongs to the tool of its number modulo 100."""
        return self.part.select(
            F.concat(F.lit("e"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.lit("t"), (F.col("p_partkey") % 100).cast("string")).alias("tool_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("domain"), ((F.col("p_partkey") % 11) / 10).alias("completeness_score"),
        )

    def tools(self) -> DataFrame:
        return self.endpoints().select(F.col("tool_id").alias("id")).distinct().withColumn("name", F.col("id"))

    def results(self, with_calls: bool = False) -> DataFrame:
        """Judged results; the orders' lines are only read where their calls are asked for."""
        k = F.col("o_orderkey")
        scores = [(F.pmod(k * m, F.lit(10)) + 1).cast("long").alias(d) for m, d in zip((3, 7, 9, 11), quality.DIMENSIONS)]
        base = self.orders.select("o_orderkey", (F.col("o_orderstatus") != "P").alias("success"), (F.pmod(k, F.lit(3)) + 1).alias("attempts"), (F.pmod(k, F.lit(5)) == 0).alias("repaired"), *scores)
        if not with_calls:
            return base
        calls = self.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("endpoint_ids"))
        return base.join(calls, "o_orderkey", "left").withColumn("endpoint_ids", F.coalesce("endpoint_ids", F.array().cast("array<string>")))

    def vectors(self) -> DataFrame:
        return self.embeddings.select(F.col("vec_id").alias("id"), "embedding", F.col("label").alias("domain"))


_RESULTS = """
calls AS (SELECT l_orderkey, count(*) AS n_calls, count(DISTINCT l_suppkey) AS n_tools FROM lineitem GROUP BY 1),
results AS (
  SELECT o_orderkey, o_orderstatus <> 'P' AS success, o_orderkey % 3 + 1 AS attempts, o_orderkey % 5 = 0 AS repaired,
    o_orderkey * 3 % 10 + 1 AS a, o_orderkey * 7 % 10 + 1 AS b, o_orderkey * 9 % 10 + 1 AS c, o_orderkey * 11 % 10 + 1 AS d,
    (o_orderkey * 3 % 10 + o_orderkey * 7 % 10 + o_orderkey * 9 % 10 + o_orderkey * 11 % 10 + 4) / 4.0 AS overall,
    coalesce(n_calls, 0) AS n_calls, coalesce(n_tools, 0) AS n_tools
  FROM orders LEFT JOIN calls ON l_orderkey = o_orderkey
)"""
_PAIRS = """
used AS (SELECT DISTINCT l_orderkey AS conv, CAST(l_suppkey AS VARCHAR) AS tool FROM lineitem JOIN part ON p_partkey = l_partkey),
pairs AS (SELECT x.tool AS a, y.tool AS b, count(*) AS n FROM used x JOIN used y ON x.conv = y.conv AND x.tool < y.tool GROUP BY 1, 2)"""
_ENTROPY = "round(-sum(p * ln(p)), 6)"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# -- entropy and coverage --


@query("tool_entropy", f"WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT n / sum(n) OVER () AS p FROM c) SELECT {_ENTROPY} AS entropy, round(-sum(p * ln(p)) / ln(count(*)), 6) AS entropy_norm, count(*) AS n_items FROM s")
def _(spark, d):
    return _rounded(metrics.entropy(Tables(spark, d).lineitem, "l_suppkey"), "entropy", "entropy_norm")


@query("tool_entropy_bits", "WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT n / sum(n) OVER () AS p FROM c) SELECT round(-sum(p * log2(p)), 6) AS entropy FROM s")
def _(spark, d):
    return _rounded(metrics.entropy(Tables(spark, d).lineitem, "l_suppkey", base=2).select("entropy"), "entropy")


@query("domain_entropy", f"WITH c AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), s AS (SELECT n / sum(n) OVER () AS p FROM c) SELECT {_ENTROPY} AS entropy, count(*) AS n_items FROM s")
def _(spark, d):
    return _rounded(metrics.entropy(Tables(spark, d).called(), "domain").select("entropy", "n_items"), "entropy")


@query(
    "entropy_by_segment",
    f"""WITH c AS (SELECT c_mktsegment, l_suppkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
    s AS (SELECT c_mktsegment, n / sum(n) OVER (PARTITION BY c_mktsegment) AS p FROM c) SELECT c_mktsegment, {_ENTROPY} AS entropy, count(*) AS n_items FROM s GROUP BY 1""",
)
def _(spark, d):
    t = Tables(spark, d)
    calls = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _rounded(metrics.entropy(calls, "l_suppkey", by=["c_mktsegment"]).select("c_mktsegment", "entropy", "n_items"), "entropy")


@query("max_entropy", "SELECT round(ln(count(DISTINCT l_suppkey)), 6) AS max_entropy FROM lineitem")
def _(spark, d):
    return Tables(spark, d).lineitem.agg(F.count_distinct("l_suppkey").alias("k")).select(F.round(metrics.max_entropy("k"), 6).alias("max_entropy"))


@query("tool_pair_counts", f"WITH {_PAIRS} SELECT a, b, n FROM pairs")
def _(spark, d):
    return diversity.tool_pairs(Tables(spark, d).called())


@query(
    "pair_ratio",
    f"WITH {_PAIRS}, items AS (SELECT a AS i FROM pairs UNION SELECT b FROM pairs) SELECT (SELECT count(*) FROM pairs) AS n_pairs, count(*) AS n_items, round((SELECT count(*) FROM pairs) / (count(*) * (count(*) - 1) / 2), 6) AS pair_ratio FROM items",
)
def _(spark, d):
    return _rounded(metrics.pair_ratio(diversity.tool_pairs(Tables(spark, d).called())), "pair_ratio")


@query("pair_coverage", f"WITH {_PAIRS} SELECT count(*) AS n_pairs, CAST(100 AS BIGINT) AS n_items, round(count(*) / 4950, 6) AS pair_ratio FROM pairs")
def _(spark, d):
    return _rounded(metrics.pair_ratio(diversity.tool_pairs(Tables(spark, d).called()), F.lit(100)), "pair_ratio")


@query("pattern_hashes", f"WITH {_PAIRS} SELECT conv, substr(md5(string_agg(tool, ',' ORDER BY tool)), 1, 16) AS pattern FROM used GROUP BY conv")
def _(spark, d):
    return diversity.pattern_hashes(Tables(spark, d).called())


@query("unique_patterns", f"WITH {_PAIRS} SELECT count(DISTINCT k) AS n FROM (SELECT string_agg(tool, ',' ORDER BY tool) AS k FROM used GROUP BY conv)")
def _(spark, d):
    return diversity.pattern_hashes(Tables(spark, d).called()).agg(F.count_distinct("pattern").alias("n"))


@query(
    "diversity_metrics",
    f"""WITH {_PAIRS}, calls AS (SELECT l_suppkey AS tool, p_brand AS domain FROM lineitem JOIN part ON p_partkey = l_partkey),
    t AS (SELECT n / sum(n) OVER () AS p FROM (SELECT count(*) AS n FROM calls GROUP BY tool)), m AS (SELECT n / sum(n) OVER () AS p FROM (SELECT count(*) AS n FROM calls GROUP BY domain)),
    h AS (SELECT conv, string_agg(tool, ',' ORDER BY tool) AS k FROM used GROUP BY conv)
    SELECT (SELECT {_ENTROPY} FROM t) AS tool_entropy, (SELECT count(*) FROM t) AS n_tools, (SELECT {_ENTROPY} FROM m) AS domain_entropy, (SELECT count(*) FROM m) AS n_domains,
    (SELECT count(*) FROM pairs) AS n_pairs, (SELECT count(*) FROM h) AS n_conversations, (SELECT count(DISTINCT k) FROM h) AS n_patterns,
    round((SELECT count(*) FROM pairs) / ((SELECT count(*) FROM t) * ((SELECT count(*) FROM t) - 1) / 2), 6) AS pair_ratio""",
)
def _(spark, d):
    return _rounded(diversity.diversity_metrics(Tables(spark, d).called()), "tool_entropy", "domain_entropy", "pair_ratio")


@query(
    "diversity_weights",
    """WITH n AS (SELECT l_suppkey AS tool, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT s_suppkey AS endpoint, round((SELECT max(n) FROM n) / (coalesce(n, 0) + 1), 6) AS weight FROM supplier LEFT JOIN n ON tool = s_suppkey""",
)
def _(spark, d):
    t = Tables(spark, d)
    registry = t.supplier.select(F.col("s_suppkey").alias("endpoint"), F.col("s_suppkey").alias("tool"), F.lit("").alias("domain"))
    return _rounded(diversity.weights(t.called(), registry), "weight")


@query(
    "suggest_domain",
    f"""WITH {_PAIRS}, n AS (SELECT p_brand AS domain, count(l_orderkey) AS n FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1),
    k AS (SELECT count(DISTINCT tool) AS k, count(DISTINCT conv) AS c FROM used)
    SELECT domain, n, (SELECT c > 5 AND (SELECT count(*) FROM pairs) / (k * (k - 1) / 2) < 0.3 FROM k) AS require_multi_tool FROM n ORDER BY n, domain LIMIT 1""",
)
def _(spark, d):
    t = Tables(spark, d)
    return diversity.suggest(t.called(), t.registry())


@query("top_tools", "SELECT l_suppkey AS tool, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 ORDER BY n DESC, tool LIMIT 5")
def _(spark, d):
    return diversity.top_tools(Tables(spark, d).called())


@query(
    "domain_gini",
    """WITH n AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n) AS i FROM n)
    SELECT round(2 * sum(n * i) / (count(*) * sum(n)) - (count(*) + 1) / count(*), 6) AS gini FROM r""",
)
def _(spark, d):
    return _rounded(metrics.gini(metrics.counts(Tables(spark, d).called(), "domain")), "gini")


# -- judged results --

_RATE = "round(avg(CASE WHEN {} THEN 1.0 ELSE 0.0 END) FILTER (WHERE success), 6)"


@query(
    "aggregate_scores",
    f"""WITH {_RESULTS} SELECT count(*) AS total_conversations, count(*) FILTER (WHERE success) AS successful_conversations, CAST(sum(attempts) AS BIGINT) AS total_attempts, round(sum(attempts) / count(*), 6) AS mean_attempts,
    round(avg(a) FILTER (WHERE success), 6) AS mean_tool_correctness, round(avg(b) FILTER (WHERE success), 6) AS mean_argument_grounding, round(avg(c) FILTER (WHERE success), 6) AS mean_task_completion,
    round(avg(d) FILTER (WHERE success), 6) AS mean_naturalness, round(avg(CAST(overall AS DOUBLE)) FILTER (WHERE success), 6) AS mean_overall,
    {_RATE.format("overall >= 6")} AS pass_rate, {_RATE.format("repaired")} AS repair_rate, {_RATE.format("n_calls >= 3")} AS multi_step_rate, {_RATE.format("n_tools >= 2")} AS multi_tool_rate FROM results""",
)
def _(spark, d):
    out = quality.aggregate_scores(Tables(spark, d).results(with_calls=True))
    return _rounded(out, *[c for c, t in out.dtypes if t == "double"])


@query("mean_scores", f"WITH {_RESULTS} SELECT round(avg(a), 6) AS tool_correctness, round(avg(b), 6) AS argument_grounding, round(avg(c), 6) AS task_completion, round(avg(d), 6) AS naturalness, round(avg(CAST(overall AS DOUBLE)), 6) AS overall FROM results")
def _(spark, d):
    out = quality.mean_scores(Tables(spark, d).results())
    return _rounded(out, *out.columns)


@query("pass_rate", f"WITH {_RESULTS} SELECT round(avg(CASE WHEN overall >= 6 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM results")
def _(spark, d):
    return _rounded(quality.pass_rate(Tables(spark, d).results()), "pass_rate")


@query("needs_repair", f"WITH {_RESULTS} SELECT o_orderkey, CAST(overall AS DOUBLE) AS average FROM results WHERE least(a, b, c, d) < 6")
def _(spark, d):
    return Tables(spark, d).results().where(quality.needs_repair()).select("o_orderkey", quality.average().alias("average"))


@query("dataset_result", f"WITH {_RESULTS} SELECT count(*) AS n, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE NOT success) AS failed, round(avg(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS success_rate FROM results")
def _(spark, d):
    return _rounded(quality.dataset_result(Tables(spark, d).results()), "success_rate")


@query(
    "generation_summary",
    f"""WITH {_RESULTS} SELECT count(*) AS n, count(*) FILTER (WHERE success) AS succeeded, round(avg(n_calls) FILTER (WHERE success), 6) AS avg_calls, round(avg(CAST(overall AS DOUBLE)) FILTER (WHERE success), 6) AS avg_score,
    min(CAST(overall AS DOUBLE)) FILTER (WHERE success) AS min_score, max(CAST(overall AS DOUBLE)) FILTER (WHERE success) AS max_score FROM results""",
)
def _(spark, d):
    found = quality.generation_summary(Tables(spark, d).results(with_calls=True))  # orders have no turns or repairs
    return _rounded(found.select("n", "succeeded", "avg_calls", "avg_score", "min_score", "max_score"), "avg_calls", "avg_score")


@query("quality_histogram", f"WITH {_RESULTS} SELECT CASE WHEN overall / 10 >= 0.9 THEN 'excellent' WHEN overall / 10 >= 0.8 THEN 'good' WHEN overall / 10 >= 0.7 THEN 'fair' WHEN overall / 10 >= 0.6 THEN 'weak' ELSE 'poor' END AS bin, count(*) AS n FROM results GROUP BY 1")
def _(spark, d):
    return metrics.quality_histogram(Tables(spark, d).results().withColumn("share", quality.average() / 10), "share")


def _shown(label: str, value: str, shape: str = "%.2f") -> str:
    return f"printf('{label + ':':<20} {shape}', {value})"


_MEANS = [(label, f"avg({c}) FILTER (WHERE success)") for label, c in (("Tool Correctness", "a"), ("Argument Grounding", "b"), ("Task Completion", "c"), ("Naturalness", "d"), ("Overall Average", "CAST(overall AS DOUBLE)"))]
_SHARES = [(label, f"100 * avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END) FILTER (WHERE success)") for label, c in (("Pass Rate", "overall >= 6"), ("Repair Rate", "repaired"), ("Multi-Step Rate", "n_calls >= 3"), ("Multi-Tool Rate", "n_tools >= 2"))]


@query(
    "stats_report",
    f"""WITH {_RESULTS} SELECT array_to_string([repeat('=', 50), 'Dataset Quality Report', repeat('=', 50), '', 'Total Conversations: ' || count(*), 'Successful: ' || count(*) FILTER (WHERE success), 'Total Attempts: ' || CAST(sum(attempts) AS BIGINT),
    printf('Mean Attempts: %.2f', sum(attempts) / count(*)), '', '--- Quality Scores (1-10) ---', {", ".join(_shown(k, v) for k, v in _MEANS)}, '', '--- Rates ---', {", ".join(_shown(k, f"CAST({v} AS DOUBLE)", "%.1f%%") for k, v in _SHARES)}, repeat('=', 50)], chr(10)) AS report FROM results""",
)
def _(spark, d):
    return quality.report(quality.aggregate_scores(Tables(spark, d).results(with_calls=True)))


# -- messages --

_TURN_ERRORS = """array_to_string(list_filter([
  CASE WHEN role IS NULL THEN 'messages[' || turn || ']: role is missing' WHEN role NOT IN ('user', 'assistant', 'tool', 'system') THEN 'messages[' || turn || ']: invalid role ''' || role || '''' END,
  CASE WHEN role = 'user' AND coalesce(trim(text), '') = '' THEN 'messages[' || turn || ']: user message needs content' END,
  CASE WHEN role = 'assistant' AND coalesce(trim(text), '') = '' THEN 'messages[' || turn || ']: assistant message needs content or tool calls' END,
  CASE WHEN role = 'tool' AND coalesce(trim(text), '') = '' THEN 'messages[' || turn || ']: tool message needs content' END,
  CASE WHEN role = 'tool' THEN 'messages[' || turn || ']: tool message needs a call id' END], lambda x: x IS NOT NULL), '; ')"""
_MUTATED = "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 1 THEN 'robot' WHEN (conv_id + turn) % 7 = 2 THEN 'tool' WHEN (conv_id + turn) % 11 = 3 THEN NULL ELSE role END AS role, CASE WHEN (conv_id + turn) % 5 = 0 THEN '  ' WHEN (conv_id + turn) % 13 = 4 THEN NULL ELSE text END AS text FROM conversations"


def _mutated(t: Tables) -> DataFrame:
    k = F.col("conv_id") + F.col("turn")
    role = F.when(k % 7 == 1, "robot").when(k % 7 == 2, "tool").when(k % 11 == 3, F.lit(None)).otherwise(F.col("role"))
    said = F.when(k % 5 == 0, "  ").when(k % 13 == 4, F.lit(None)).otherwise(F.col("text"))
    return t.conversations.select("conv_id", "turn", role.alias("role"), said.alias("text"))


@query("validate_messages", f"SELECT conv_id, turn, {_TURN_ERRORS} AS errors FROM conversations")
def _(spark, d):
    return validation.turn_errors(Tables(spark, d).conversations).select("conv_id", "turn", F.array_join("errors", "; ").alias("errors"))


@query("invalid_injected", f"WITH m AS ({_MUTATED}) SELECT conv_id, turn, {_TURN_ERRORS} AS errors FROM m")
def _(spark, d):
    return validation.turn_errors(_mutated(Tables(spark, d))).select("conv_id", "turn", F.array_join("errors", "; ").alias("errors"))


@query(
    "validate_conversations",
    f"""WITH m AS ({_MUTATED}), p AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text FROM m), e AS (SELECT conv_id, {_TURN_ERRORS} AS errors FROM p)
    SELECT CAST(conv_id AS VARCHAR) AS conversation_id, bool_and(errors = '') AS is_valid, CAST(sum(CASE WHEN errors = '' THEN 0 ELSE length(errors) - length(replace(errors, ';', '')) + 1 END) AS INTEGER) AS n_errors FROM e GROUP BY 1""",
)
def _(spark, d):
    found = validation.validate_read(conversation.from_turns(_mutated(Tables(spark, d))))
    return found.select("conversation_id", "is_valid", F.size("errors").alias("n_errors"))


@query("history_text", "SELECT conv_id, string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) ORDER BY turn) AS history FROM conversations WHERE role IN ('user', 'system') OR (role = 'assistant' AND text <> '') GROUP BY 1")
def _(spark, d):
    return conversation.history_of_turns(Tables(spark, d).conversations)


@query("judge_transcript", "SELECT CAST(conv_id AS VARCHAR) AS conversation_id, coalesce(string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant')), 'No messages') AS transcript FROM conversations GROUP BY 1")
def _(spark, d):
    return conversation.from_turns(Tables(spark, d).conversations).select("conversation_id", conversation.judge_transcript("messages").alias("transcript"))


@query("turn_stats", "SELECT conv_id, count(*) AS n_turns, count(*) FILTER (WHERE role = 'user') AS n_user, count(*) FILTER (WHERE role = 'assistant') AS n_assistant, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1")
def _(spark, d):
    return conversation.turn_stats(Tables(spark, d).conversations)


@query("last_assistant", "SELECT conv_id, arg_max(text, turn) AS text, max(turn) AS turn FROM conversations WHERE role = 'assistant' AND trim(text) <> '' GROUP BY 1")
def _(spark, d):
    return conversation.last_assistant(Tables(spark, d).conversations)


@query(
    "first_turns",
    "SELECT conv_id, turn, row_number() OVER w = 1 AS is_initial, CAST(coalesce(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS users_before FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
)
def _(spark, d):
    return conversation.first_turns(Tables(spark, d).conversations).select("conv_id", "turn", "is_initial", "users_before")


@query("jsonl_roundtrip", "SELECT CAST(conv_id AS VARCHAR) AS conversation_id, count(*) AS n, md5(string_agg(role || text, '|' ORDER BY turn)) AS digest FROM conversations GROUP BY 1")
def _(spark, d):
    made = conversation.from_turns(Tables(spark, d).conversations).withColumns({"tool_outputs": F.lit(None).cast(f"array<{conversation.TOOL_OUTPUT}>"), "success": F.lit(True), "attempts": F.lit(1), "repaired": F.lit(False), "error": F.lit(None).cast("string"), **{k: F.lit(None).cast("long") for k in quality.DIMENSIONS}})
    path = new_path(spark, "jsonl")
    interchange.write_jsonl(made, path)
    read = interchange.read_jsonl(spark, path)
    return read.select("conversation_id", F.size("messages").cast("long").alias("n"), F.md5(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], m["content"])), "|")).alias("digest"))


@query("serialize_conversations", "SELECT CAST(conv_id AS VARCHAR) AS conversation_id, count(*) AS num_turns, CAST(conv_id % 10 + 1 AS DOUBLE) AS average FROM conversations GROUP BY conv_id")
def _(spark, d):
    made = conversation.from_turns(Tables(spark, d).conversations)
    score = (F.col("conversation_id").cast("long") % 10 + 1).cast("long")
    full = made.withColumns({"tool_outputs": F.array().cast(f"array<{conversation.TOOL_OUTPUT}>"), "success": F.lit(True), "attempts": F.lit(1), "repaired": F.lit(False), "error": F.lit(None).cast("string"), **{k: score for k in quality.DIMENSIONS}})
    doc = interchange.serialize(full).select(F.parse_json("json").alias("v"))
    return doc.select(*[F.variant_get("v", path, kind).alias(name) for name, path, kind in (("conversation_id", "$.conversation_id", "string"), ("num_turns", "$.metadata.num_turns", "bigint"), ("average", "$.judge_scores.average", "double"))])


@query("answered_calls", "SELECT CAST(conv_id AS VARCHAR) AS conversation_id, 'c' || turn AS call_id, CASE WHEN turn % 2 = 0 THEN text END AS answer FROM conversations")
def _(spark, d):
    # Each message becomes a call; every other one is answered by its own text.
    call = lambda t: F.struct(F.concat(F.lit("c"), t.cast("string")).alias("id"), F.struct(F.lit("f").alias("name"), F.lit("{}").alias("arguments")).alias("function"))
    message = lambda role, text_, calls, of: F.struct(F.lit(role).alias("role"), text_.alias("content"), calls.cast(f"array<{conversation.TOOL_CALL}>").alias("tool_calls"), of.cast("string").alias("tool_call_id"))
    rows = Tables(spark, d).conversations.groupBy(F.col("conv_id").cast("string").alias("conversation_id")).agg(F.collect_list(F.struct("turn", "text")).alias("m"))
    asked = F.transform("m", lambda m: message("assistant", F.lit(None).cast("string"), F.array(call(m["turn"])), F.lit(None)))
    told = F.transform(F.filter("m", lambda m: m["turn"] % 2 == 0), lambda m: message("tool", m["text"], F.lit(None), F.concat(F.lit("c"), m["turn"].cast("string"))))
    return conversation.answered_calls(rows.select("conversation_id", F.concat(asked, told).alias("messages"))).select("conversation_id", "call_id", "answer")


# -- text --


@query("truncate_docs", "SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE regexp_replace(CASE WHEN instr(reverse(text[1:197]), ' ') > 0 AND 197 - instr(reverse(text[1:197]), ' ') > 98 THEN text[1:197 - instr(reverse(text[1:197]), ' ')] ELSE text[1:197] END, '\\s+$', '') || '...' END AS short FROM documents")
def _(spark, d):
    return Tables(spark, d).documents.select("doc_id", text.truncate("text", 200).alias("short"))


@query("sanitize_ids", "SELECT p_partkey, nullif(regexp_replace(regexp_replace(left(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(p_name || ' (' || p_type || ')')), '[^a-zA-Z0-9_\\-]', '_', 'g'), '_+', '_', 'g'), '-+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), 128), '[-_]+$', ''), '^$', ''), '') AS id FROM part")
def _(spark, d):
    return Tables(spark, d).part.select("p_partkey", text.sanitize_id(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("id"))


@query("domain_node_ids", "SELECT DISTINCT 'domain_' || regexp_replace(lower(p_brand), '[^a-z0-9]', '_', 'g') AS id FROM part")
def _(spark, d):
    return Tables(spark, d).part.select(text.domain_node_id("p_brand").alias("id")).distinct()


@query("normalize_types", "SELECT event_id, CASE lower(trim(split_part('Str|INT |double|bool|list|dict|thing', '|', CAST(event_id % 7 + 1 AS INTEGER)))) WHEN 'str' THEN 'string' WHEN 'int' THEN 'integer' WHEN 'double' THEN 'number' WHEN 'bool' THEN 'boolean' WHEN 'list' THEN 'array' WHEN 'dict' THEN 'object' ELSE 'unknown' END AS type FROM events")
def _(spark, d):
    raw = F.split_part(F.lit("Str|INT |double|bool|list|dict|thing"), F.lit("|"), (F.col("event_id") % 7 + 1).cast("int"))
    return Tables(spark, d).events.select("event_id", text.normalize_type(raw).alias("type"))


_WORD = "(^|[^\\pL\\pN_])({})($|[^\\pL\\pN_])"
_DOMAIN = " ".join(f"WHEN regexp_matches(x, '{_WORD.format(words.replace(' ', '|'))}') THEN '{name}'" for name, words in text.DOMAIN_KEYWORDS.items())


@query("infer_domain_pages", f"SELECT page_id, CASE {_DOMAIN} ELSE 'general' END AS domain FROM (SELECT page_id, lower(regexp_replace(html, '([a-z])([A-Z])', '\\1 \\2', 'g')) AS x FROM pages)")
def _(spark, d):
    return Tables(spark, d).pages.select("page_id", text.infer_domain(description="html").alias("domain"))


@query("embedding_text", "SELECT p_partkey, p_name || ': ' || p_type || '. Domain: ' || p_brand || '. Method: GET.' AS text FROM part")
def _(spark, d):
    return Tables(spark, d).part.select("p_partkey", text.embedding_text(F.col("p_name"), F.col("p_type"), F.col("p_brand"), F.lit("GET"), F.lit("")).alias("text"))


@query("clean_messages", "SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '^User: ', ''), '^\\s+|\\s+$', '', 'g') AS text FROM conversations")
def _(spark, d):
    return Tables(spark, d).conversations.select("conv_id", "turn", text.clean_user_message(F.concat(F.lit(' "User: '), text.strip("text"), F.lit('"\n'))).alias("text"))


@query("extract_json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, d):
    answer = F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nDone."))
    return Tables(spark, d).events.select("event_id", F.try_variant_get(F.try_parse_json(text.extract_json(answer)), "$.k", "bigint").alias("k"))


# -- completeness --

_GENERIC = ", ".join(f"'{w}'" for w in scoring.GENERIC.split())


@query("path_validity", "SELECT page_id, CASE WHEN url LIKE '%/%' OR trim(url) LIKE 'www.%' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM pages")
def _(spark, d):
    return Tables(spark, d).pages.select("page_id", scoring.score_path("url").alias("score"))


@query("description_score", "SELECT doc_id, CASE WHEN length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM documents")
def _(spark, d):
    return Tables(spark, d).documents.select("doc_id", scoring.score_description("text", 40).alias("score"))


@query("name_quality", f"SELECT p_partkey, CASE WHEN length(trim(p_name)) > 3 AND len(list_filter(string_split_regex(lower(p_name), '[_\\s]+'), lambda w: w <> '' AND w NOT IN ({_GENERIC}))) > 0 AND replace(replace(lower(trim(p_name)), '_', ''), '-', '') NOT IN ({_GENERIC}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM part")
def _(spark, d):
    return Tables(spark, d).part.select("p_partkey", scoring.score_name("p_name").alias("score"))


_ENDPOINT_SCORE = "(CASE WHEN length(p_type) >= 10 THEN 0.2 ELSE 0.0 END + 0.3 * (p_size % 3) / 2 + CASE WHEN p_size % 2 = 0 THEN 0.2 ELSE 0.0 END + 0.1 + 0.2)"


def _endpoint_score() -> dict:
    types = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("unknown"), F.lit("unknown"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("unknown"), F.lit("string"))).otherwise(F.array(F.lit("string"), F.lit("array")))
    return {"description": F.col("p_type"), "types": types, "schema": F.when(F.col("p_size") % 2 == 0, "{}"), "name": F.concat(F.lit("lookup "), "p_name"), "path": F.concat(F.lit("/"), "p_name")}


@query("endpoint_scores", f"SELECT p_partkey, round(CAST({_ENDPOINT_SCORE} AS DOUBLE), 6) AS score FROM part")
def _(spark, d):
    return Tables(spark, d).part.select("p_partkey", F.round(scoring.endpoint_score(**_endpoint_score()), 6).alias("score"))


@query("score_breakdown", "SELECT p_partkey, CASE WHEN length(p_type) >= 10 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS description, CASE WHEN p_size % 2 = 0 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS response, round(0.3::DOUBLE * (p_size % 3) / 2, 3) AS types FROM part")
def _(spark, d):
    b = scoring.breakdown(scoring.endpoint_parts(**_endpoint_score()), scoring.ENDPOINT_WEIGHTS)
    return Tables(spark, d).part.select("p_partkey", b.alias("b")).select("p_partkey", F.col("b.description.weighted").alias("description"), F.col("b.response_schema.weighted").alias("response"), F.col("b.parameter_types.weighted").alias("types"))


@query(
    "tool_scores",
    f"WITH e AS (SELECT 't' || p_partkey % 100 AS id, round(CAST({_ENDPOINT_SCORE} AS DOUBLE) * 100) / 100 AS s FROM part) SELECT id, round(0.2 + 0.5 * avg(s), 6) AS score FROM e GROUP BY id",
)
def _(spark, d):
    t = Tables(spark, d)
    e = t.part.select(F.concat(F.lit("t"), (F.col("p_partkey") % 100).cast("string")).alias("tool_id"), scoring.endpoint_score(**_endpoint_score()).alias("score"))
    tools = e.select(F.col("tool_id").alias("id")).distinct().withColumns({"name": F.lit("get"), "description": F.lit("tbd")})
    return scoring.score_tools(tools, e).select("id", F.round("score_raw", 6).alias("score"))


@query(
    "incomplete_tools",
    """WITH e AS (SELECT 't' || p_partkey % 100 AS id, CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.0 END AS d, p_size % 4 AS n, CASE WHEN p_size % 5 = 0 THEN p_size % 4 ELSE 0 END AS k FROM part),
    s AS (SELECT id, 0.2 + 0.3 * avg(d) + CASE WHEN sum(n) > 0 THEN 0.25 * sum(n) / sum(n) + 0.25 * sum(k) / sum(n) ELSE 0.5 END AS c FROM e GROUP BY id) SELECT id, round(CAST(c AS DOUBLE), 6) AS completeness FROM s WHERE c < 0.65""",
)
def _(spark, d):
    t = Tables(spark, d)
    parameter = F.struct(F.lit("p").alias("name"), F.when(F.col("p_size") % 5 == 0, "string").otherwise("unknown").alias("type"), F.lit("what it is").alias("description"))
    e = t.part.select(F.concat(F.lit("t"), (F.col("p_partkey") % 100).cast("string")).alias("tool_id"), F.when(F.col("p_size") % 2 == 0, "does it").alias("description"), F.array_repeat(parameter, (F.col("p_size") % 4).cast("int")).alias("parameters"))
    tools = e.select(F.col("tool_id").alias("id")).distinct().withColumn("description", F.lit("a tool"))
    return scoring.incomplete_tools(tools, e, 0.65).select("id", F.round("completeness", 6).alias("completeness"))


# -- the graph --

_E = "e AS (SELECT 'e' || p_partkey AS id, 't' || p_partkey % 100 AS tool_id, p_name AS name, p_type AS category, p_brand AS domain, (p_partkey % 11) / 10 AS completeness_score FROM part)"
_G = f"{_E}, g AS (SELECT tool_id AS src, id AS dst, 'HAS_ENDPOINT' AS type FROM e UNION ALL SELECT id, 'domain_' || regexp_replace(lower(domain), '[^a-z0-9]', '_', 'g'), 'IN_DOMAIN' FROM e)"
_N = "n AS (SELECT id, 'Endpoint' AS type FROM e UNION ALL SELECT DISTINCT tool_id, 'Tool' FROM e UNION ALL SELECT DISTINCT 'domain_' || regexp_replace(lower(domain), '[^a-z0-9]', '_', 'g'), 'Domain' FROM e)"


def _graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    return graph.build_nodes(t.tools(), t.endpoints()), graph.build_edges(t.endpoints())


@query("graph_nodes", f"WITH {_E}, {_N} SELECT id, type FROM n")
def _(spark, d):
    return _graph(Tables(spark, d))[0].select("id", "type")


@query("graph_edges", f"WITH {_G} SELECT src, dst, type FROM g")
def _(spark, d):
    return _graph(Tables(spark, d))[1].select("src", "dst", "type")


@query("graph_stats", f"WITH {_G}, {_N}, s AS (SELECT 'node' AS kind, type, count(*) AS n FROM n GROUP BY 2 UNION ALL SELECT 'edge', type, count(*) FROM g GROUP BY 2) SELECT kind, type, n FROM s UNION ALL SELECT kind, NULL, CAST(sum(n) AS BIGINT) FROM s GROUP BY kind")
def _(spark, d):
    return graph.stats(*_graph(Tables(spark, d)))


@query("graph_density", f"WITH {_G}, {_N} SELECT (SELECT count(*) FROM n) AS n_nodes, (SELECT count(*) FROM g) AS n_edges, round((SELECT count(*) FROM g) / ((SELECT count(*) FROM n) * ((SELECT count(*) FROM n) - 1)), 9) AS density")
def _(spark, d):
    return graph.density(*_graph(Tables(spark, d))).withColumn("density", F.round("density", 9))


@query("build_stats", f"WITH {_G} SELECT type, count(*) FILTER (WHERE NOT old) AS added, count(*) FILTER (WHERE old) AS skipped FROM (SELECT type, CASE type WHEN 'HAS_ENDPOINT' THEN CAST(dst[2:] AS BIGINT) ELSE CAST(src[2:] AS BIGINT) END % 4 = 0 AS old FROM g) GROUP BY 1")
def _(spark, d):
    t = Tables(spark, d)
    old = graph.build_edges(t.endpoints().where(F.col("id").substr(2, 20).cast("long") % 4 == 0))
    return graph.build_stats(old, graph.build_edges(t.endpoints()))


@query("domain_stats", "SELECT p_brand AS domain, count(*) AS n FROM part GROUP BY 1")
def _(spark, d):
    return graph.domain_stats(Tables(spark, d).endpoints())


@query("same_domain_edges", f"WITH {_E} SELECT a.id AS src, b.id AS dst, 1.0::DOUBLE AS weight FROM e a JOIN e b ON a.domain = b.domain AND a.id < b.id")
def _(spark, d):
    return graph.same_domain_edges(Tables(spark, d).endpoints()).select("src", "dst", "weight")


@query("neighbors", f"WITH {_G} SELECT src AS node, dst AS other FROM g UNION SELECT dst, src FROM g")
def _(spark, d):
    return graph.neighbors(_graph(Tables(spark, d))[1])


@query(
    "subgraph_domain",
    f"""WITH {_E}, k AS (SELECT * FROM e WHERE domain IN ('Brand#11', 'Brand#23')) SELECT 'node' AS kind, id AS a, domain AS b FROM k
    UNION ALL SELECT 'edge', x.id, y.id FROM k x JOIN k y ON x.domain = y.domain AND x.id < y.id""",
)
def _(spark, d):
    t = Tables(spark, d)
    nodes, edges = _graph(t)
    kept, inner = graph.domain_subgraph(nodes, edges, t.endpoints(), ["Brand#11", "Brand#23"])
    return kept.select(F.lit("node").alias("kind"), F.col("id").alias("a"), F.col("domain").alias("b")).unionByName(inner.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")))


_REGIONS = "g AS (SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier)"


def _regions(t: Tables) -> DataFrame:
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    up = t.nation.select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst")).unionByName(t.supplier.select(name("s", "s_suppkey").alias("src"), name("n", "s_nationkey").alias("dst")))
    return up.withColumn("type", F.lit(graph.IN_DOMAIN))


@query(
    "bfs_depth3",
    f"""WITH RECURSIVE {_REGIONS}, u AS (SELECT src AS a, dst AS b FROM g UNION SELECT dst, src FROM g), w(start, node, depth) AS (
    SELECT 'r' || r_regionkey, 'r' || r_regionkey, 0 FROM region UNION ALL SELECT start, b, depth + 1 FROM w JOIN u ON node = a WHERE depth < 3) SELECT start, node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY 1, 2""",
)
def _(spark, d):
    t = Tables(spark, d)
    return graph.bfs(_regions(t), t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id")), 3)


@query(
    "shortest_path_len",
    f"""WITH RECURSIVE {_REGIONS}, u AS (SELECT src AS a, dst AS b FROM g UNION SELECT dst, src FROM g), w(node, depth) AS (SELECT 's1', 0 UNION SELECT b, depth + 1 FROM w JOIN u ON node = a WHERE depth < 6)
    SELECT CAST(min(depth) AS INTEGER) AS steps FROM w WHERE node = 's2'""",
)
def _(spark, d):
    found = graph.shortest_path(_regions(Tables(spark, d)), "s1", "s2")
    return spark.createDataFrame([(None if found is None else len(found) - 1,)], "steps int")


@query(
    "random_walks",
    f"""WITH {_G}, u AS (SELECT src AS node, dst AS other FROM g UNION SELECT dst, src FROM g),
    m AS (SELECT node, other, row_number() OVER (PARTITION BY node ORDER BY md5(other), other) - 1 AS nth, count(*) OVER (PARTITION BY node) AS degree FROM u),
    w1 AS (SELECT id AS walk, other AS a FROM e JOIN m ON node = id AND nth = CAST('0x' || substr(md5(id || '|1|0'), 1, 8) AS BIGINT) % degree),
    w2 AS (SELECT walk, a, other AS b FROM w1 JOIN m ON node = a AND nth = CAST('0x' || substr(md5(walk || '|2|0'), 1, 8) AS BIGINT) % degree),
    w3 AS (SELECT walk, a, b, other AS c FROM w2 JOIN m ON node = b AND nth = CAST('0x' || substr(md5(walk || '|3|0'), 1, 8) AS BIGINT) % degree)
    SELECT walk, walk || '>' || a || '>' || b || '>' || c AS path FROM w3""",
)
def _(spark, d):
    t = Tables(spark, d)
    starts = t.endpoints().select(F.col("id").alias("walk"), "id")
    return graph.random_walks(_graph(t)[1], starts, 3).withColumn("path", F.array_join("path", ">"))


@query("completeness_filter", f"WITH {_E} SELECT id, round(completeness_score, 6) AS completeness_score FROM e WHERE completeness_score >= 0.65")
def _(spark, d):
    return graph.complete_enough(Tables(spark, d).endpoints(), 0.65).select("id", F.round("completeness_score", 6).alias("completeness_score"))


@query("endpoints_by_domain", f"WITH {_E} SELECT id, tool_id FROM e WHERE domain = 'Brand#23'")
def _(spark, d):
    return graph.by_domain(Tables(spark, d).endpoints(), "Brand#23").select("id", "tool_id")


@query("endpoints_by_category", "SELECT 'e' || p_partkey AS id FROM part WHERE p_partkey % 100 % 6 = 2")
def _(spark, d):
    t = Tables(spark, d)
    tools = t.tools().withColumn("category", (F.col("id").substr(2, 9).cast("int") % 6).cast("string"))
    return graph.by_category(t.endpoints().drop("category"), tools, "2").select("id")


@query("distinct_domains", "SELECT DISTINCT p_brand AS domain FROM part")
def _(spark, d):
    return Tables(spark, d).endpoints().select("domain").distinct()


# -- similarity --

_PAIR_SQL = """u AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings), v AS (SELECT *, sqrt(list_dot_product(x, x)) + 1e-10 AS norm FROM u),
p AS (SELECT * FROM (SELECT a.id AS a, b.id AS b, a.label AS la, b.label AS lb, list_dot_product(a.x, b.x) / (a.norm * b.norm) AS score FROM v a JOIN v b ON a.id < b.id) WHERE score >= 0.3)"""


@query("cosine_pairs", f"WITH {_PAIR_SQL} SELECT a, b, round(score, 6) AS score FROM p")
def _(spark, d):
    return _rounded(similarity.cosine_pairs(Tables(spark, d).vectors(), 0.3), "score")


@query("semantic_edges", f"WITH {_PAIR_SQL} SELECT CAST(a AS VARCHAR) AS src, CAST(b AS VARCHAR) AS dst, round(score, 6) AS score FROM p WHERE la <> lb")
def _(spark, d):
    return _rounded(similarity.semantic_edges(Tables(spark, d).vectors(), 0.3).select("src", "dst", "score"), "score")


@query(
    "semantic_edges_topk",
    f"""WITH {_PAIR_SQL}, s AS (SELECT a AS node, * FROM p UNION ALL SELECT b, * FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, a, b) AS k FROM s)
    SELECT DISTINCT a, b, round(score, 6) AS score FROM r WHERE k <= 3""",
)
def _(spark, d):
    return _rounded(similarity.greedy_top_k(similarity.cosine_pairs(Tables(spark, d).vectors(), 0.3, first=3), 3), "score")


@query(
    "similarity_stats",
    f"""WITH {_PAIR_SQL} SELECT count(*) FILTER (WHERE la <> lb) AS created, (SELECT CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) FROM v) - count(*) AS skipped_threshold, count(*) FILTER (WHERE la = lb) AS skipped_joined,
    round(avg(score) FILTER (WHERE la <> lb), 6) AS mean_score, round(max(score) FILTER (WHERE la <> lb), 6) AS max_score, round(min(score) FILTER (WHERE la <> lb), 6) AS min_score FROM p""",
)
def _(spark, d):
    return _rounded(similarity.similarity_stats_by_domain(Tables(spark, d).vectors(), 0.3), "mean_score", "max_score", "min_score")


@query(
    "similar_topk",
    f"""WITH {_PAIR_SQL}, s AS (SELECT a AS node, b AS other, score FROM p UNION ALL SELECT b, a, score FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, CAST(other AS VARCHAR)) AS k FROM s)
    SELECT CAST(node AS VARCHAR) AS node, CAST(other AS VARCHAR) AS other, round(score, 6) AS score, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 5""",
)
def _(spark, d):
    edges = similarity.semantic_edges(Tables(spark, d).vectors(), 0.3, skip_same_domain=False, first=5)
    return _rounded(similarity.top_similar(edges, 5), "score")


# -- chains and plans --


@query(
    "start_candidates",
    f"""WITH {_E}, k AS (SELECT id, tool_id FROM e WHERE completeness_score >= 0.5), w AS (SELECT id, tool_id, 1 / (count(*) OVER (PARTITION BY tool_id) + 1) AS w FROM k),
    r AS (SELECT *, CAST(row_number() OVER (ORDER BY w DESC, md5(id || '|0'), id) - 1 AS INTEGER) AS rank FROM w) SELECT id, tool_id, round(w, 6) AS w, rank FROM r WHERE rank < 10""",
)
def _(spark, d):
    return _rounded(sampling.start_candidates(Tables(spark, d).endpoints(), sampling.Constraints(min_completeness=0.5)), "w").select("id", "tool_id", "w", "rank")


def _longer(before: str) -> str:
    """Each path with its best four neighbours of the last endpoint's domain."""
    return f"""SELECT path || [id] AS path, ranks || [rank] AS ranks, tools || [tool_id] AS tools, domain FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY w DESC, md5(id || '|0'), id) - 1 AS rank FROM (
    SELECT path, ranks, tools, k.id, k.tool_id, k.domain, 1 / (count(*) OVER (PARTITION BY path, k.tool_id) + 1) AS w FROM {before} p JOIN k ON k.domain = p.domain AND NOT list_contains(path, k.id))) WHERE rank < 4"""


@query(
    "dfs_sample",
    f"""WITH {_E}, k AS (SELECT * FROM e WHERE completeness_score >= 0.3), w AS (SELECT id, tool_id, domain, 1 / (count(*) OVER (PARTITION BY tool_id) + 1) AS w FROM k),
    p1 AS (SELECT [id] AS path, [rank] AS ranks, [tool_id] AS tools, domain FROM (SELECT *, row_number() OVER (ORDER BY w DESC, md5(id || '|0'), id) - 1 AS rank FROM w) WHERE rank < 4),
    p2 AS ({_longer("p1")}), p3 AS ({_longer("p2")}), p4 AS ({_longer("p3")}),
    v AS (SELECT *, row_number() OVER (ORDER BY ranks) AS visit FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4))
    SELECT CAST(visit AS INTEGER) AS visit, array_to_string(path, '>') AS path FROM v WHERE visit <= 100 AND len(path) >= 3 AND len(list_distinct(tools)) > 1""",
)
def _(spark, d):
    t = Tables(spark, d)
    c = sampling.Constraints(min_steps=3, max_steps=4, min_completeness=0.3, require_multi_tool=True)
    return sampling.sample_chains(t.endpoints(), graph.empty(spark)[1], c, starts=4, fan=4, by_domain=True).select("visit", F.array_join("path", ">").alias("path"))


_CHAIN = "c AS (SELECT l_orderkey AS conv, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS chain FROM lineitem GROUP BY 1)"


@query(
    "chain_errors",
    """WITH s AS (SELECT l_orderkey AS conv, l_linenumber AS i, CAST(l_partkey AS VARCHAR) AS id, l_suppkey % 7 AS tool, p_brand AS domain, l_partkey % 11 AS score FROM lineitem JOIN part ON p_partkey = l_partkey),
    c AS (SELECT conv, count(*) AS n, count(DISTINCT tool) AS k, bool_or(domain = 'Brand#12') AS need, list_filter(list(CASE WHEN domain = 'Brand#23' THEN id || ' is of excluded domain Brand#23' END ORDER BY i, id, tool), lambda x: x IS NOT NULL) AS bad,
      list_filter(list(CASE WHEN tool = 3 THEN id || ' is of excluded tool 3' END ORDER BY i, id, tool), lambda x: x IS NOT NULL) AS worse, list_filter(list(CASE WHEN score < 2 THEN id || ' is complete to 0.' || score END ORDER BY i, id, tool), lambda x: x IS NOT NULL) AS low FROM s GROUP BY 1)
    SELECT conv, array_to_string(list_filter([CASE WHEN n < 2 THEN n || ' steps are fewer than 2' END, CASE WHEN n > 5 THEN n || ' steps are more than 5' END, CASE WHEN NOT need THEN 'required domain ''Brand#12'' is missing' END], lambda x: x IS NOT NULL)
      || bad || worse || low || CASE WHEN k < 2 THEN [k || ' tools where two are required'] ELSE [] END, '; ') AS errors FROM c""",
)
def _(spark, d):
    t = Tables(spark, d)
    id_, tool = F.col("l_partkey").cast("string"), F.col("l_suppkey") % 7
    step = F.struct(id_.alias("endpoint_id"), tool.cast("string").alias("tool_id"), F.col("p_brand").alias("domain"), ((F.col("l_partkey") % 11) / 10).alias("completeness_score"))
    placed = F.array_sort(F.collect_list(F.struct("l_linenumber", id_.alias("id"), tool.alias("tool"), step.alias("s"))))
    chains = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("conv")).agg(F.transform(placed, lambda x: x["s"]).alias("chain"))
    c = sampling.Constraints(required_domains=("Brand#12",), excluded_domains=("Brand#23",), excluded_tools=("3",), min_completeness=0.15, require_multi_tool=True)
    return chains.select("conv", F.array_join(sampling.chain_errors("chain", c), "; ").alias("errors"))


@query(
    "valid_chains",
    """WITH s AS (SELECT l_orderkey AS conv, l_suppkey % 7 AS tool, (l_partkey % 11) / 10 AS score FROM lineitem), c AS (SELECT conv, count(*) AS n, count(DISTINCT tool) AS k, min(score) AS low FROM s GROUP BY 1)
    SELECT conv, CAST(n AS INTEGER) AS steps FROM c WHERE n BETWEEN 2 AND 5 AND k > 1 AND low >= 0.15""",
)
def _(spark, d):
    step = F.struct(F.col("l_partkey").cast("string").alias("endpoint_id"), (F.col("l_suppkey") % 7).cast("string").alias("tool_id"), F.lit("x").alias("domain"), ((F.col("l_partkey") % 11) / 10).alias("completeness_score"))
    chains = Tables(spark, d).lineitem.groupBy(F.col("l_orderkey").alias("conv")).agg(F.collect_list(step).alias("chain"))
    return chains.where(sampling.is_valid("chain", sampling.Constraints(min_completeness=0.15, require_multi_tool=True))).select("conv", F.size("chain").alias("steps"))


@query(
    "neighbor_rank",
    f"""WITH {_E}, near AS (SELECT a.id AS start, b.tool_id, b.id FROM e a JOIN e b ON a.domain = b.domain AND a.id <> b.id WHERE b.completeness_score >= 0.5),
    w AS (SELECT *, 1 / (count(*) OVER (PARTITION BY start, tool_id) + 1) AS w FROM near), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY start ORDER BY w DESC, md5(id || '|0'), id) - 1 AS INTEGER) AS rank FROM w)
    SELECT start, id, tool_id, round(w, 6) AS w, rank FROM r WHERE rank < 10""",
)
def _(spark, d):
    e = Tables(spark, d).endpoints()
    return _rounded(sampling.domain_candidates(e, sampling.Constraints(min_completeness=0.5)), "w").select("start", "id", "tool_id", "w", "rank")


def _plan(name: str, sql: str) -> None:
    @query(f"plan_{name}", f"WITH {_CHAIN}, {sql} SELECT conv, CAST(step AS INTEGER) AS step, endpoint_id, array_to_string(depends_on, ',') AS depends_on, is_parallel FROM p")
    def _(spark, d):
        out = patterns.steps(Tables(spark, d).chains().select("conv", patterns.plan("chain", name).alias("plan")), "plan", "conv")
        return out.withColumn("depends_on", F.array_join("depends_on", ","))


_IN_TURN = "SELECT conv, i AS step, {c}[i] AS endpoint_id, CASE WHEN i = 1 THEN [] ELSE [{c}[i - 1]] END AS depends_on, false AS is_parallel FROM (SELECT *, unnest(range(1, len({c}) + 1)) AS i FROM {t})"
_plan("sequential", f"p AS ({_IN_TURN.format(c='chain', t='c')})")
_plan("branching", f"p AS ({_IN_TURN.format(c='chain', t='c')})")
_plan(
    "parallel",
    """p AS (SELECT conv, i AS step, chain[i] AS endpoint_id, CASE WHEN len(chain) < 3 THEN CASE WHEN i = 1 THEN [] ELSE [chain[i - 1]] END WHEN i <= 2 THEN [] WHEN i = 3 THEN chain[1:2] ELSE [chain[i - 1]] END AS depends_on, len(chain) >= 3 AND i <= 2 AS is_parallel
    FROM (SELECT *, unnest(range(1, len(chain) + 1)) AS i FROM c))""",
)
_plan("iterative", f"l AS (SELECT conv, CASE WHEN len(chain) < 3 THEN chain ELSE [chain[1]] || list_transform(range(len(chain) - 2), lambda x: chain[2]) || [chain[len(chain)]] END AS looped FROM c), p AS ({_IN_TURN.format(c='looped', t='l')})")


# -- the cache --

_REQUESTS = "r AS (SELECT event_id, event_type || '-' || user_id AS k FROM events), e AS (SELECT event_type || '-' || user_id AS k, max(ts) AS last, count(*) AS n FROM events WHERE user_id % 3 = 0 GROUP BY 1)"


def _requests(t: Tables) -> tuple[DataFrame, DataFrame]:
    r = t.events.select("event_id", "ts", F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("prompt_hash"), "user_id")
    e = r.where("user_id % 3 = 0").groupBy("prompt_hash").agg(F.max("ts").alias("last_accessed"), F.count("*").alias("hit_count")).withColumn("content", F.lower("prompt_hash"))
    return r, e


@query("cache_lookup", f"WITH {_REQUESTS} SELECT event_id, lower(e.k) AS content FROM r LEFT JOIN e USING (k)")
def _(spark, d):
    return cache.lookup(*_requests(Tables(spark, d))).select("event_id", "content")


@query("uncached_requests", f"WITH {_REQUESTS} SELECT event_id FROM r ANTI JOIN e USING (k)")
def _(spark, d):
    return cache.misses(*_requests(Tables(spark, d))).select("event_id")


@query("cache_lru", f"WITH {_REQUESTS} SELECT k AS prompt_hash, n AS hit_count FROM e ORDER BY last DESC, k LIMIT 50")
def _(spark, d):
    return cache.recent(_requests(Tables(spark, d))[1], 50).select("prompt_hash", "hit_count")


@query("cache_stats", f"WITH {_REQUESTS} SELECT count(e.k) AS hits, count(*) - count(e.k) AS misses, round(count(e.k) / count(*), 6) AS hit_rate, (SELECT count(*) FROM e) AS entries FROM r LEFT JOIN e USING (k)")
def _(spark, d):
    return _rounded(cache.stats(*_requests(Tables(spark, d))), "hit_rate")


@query("uncached_endpoints", "SELECT 'e' || p_partkey AS id FROM part WHERE p_partkey % 3 <> 0")
def _(spark, d):
    e = Tables(spark, d).endpoints()
    return interchange.missing_embeddings(e.select("id", F.col("name").alias("text")), e.where(F.col("id").substr(2, 20).cast("long") % 3 == 0)).select("id")


@query("pending_calls", "SELECT conv_id, CASE WHEN n % 3 = 0 THEN NULL ELSE 'c' || n % 3 END AS call_id FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)")
def _(spark, d):
    n = F.col("n_turns")
    call = lambda i: F.struct(F.lit(i).alias("id"), F.struct(F.lit("f").alias("name"), F.lit("{}").alias("arguments")).alias("function"))
    message = lambda role, calls, of: F.struct(F.lit(role).alias("role"), F.lit("x").alias("content"), calls.alias("tool_calls"), of.alias("tool_call_id"))
    none, no_calls = F.lit(None).cast("string"), F.lit(None).cast(f"array<{conversation.TOOL_CALL}>")
    answered = F.when(n % 3 == 1, F.array().cast("array<string>")).when(n % 3 == 2, F.array(F.lit("c1"))).otherwise(F.array(F.lit("c1"), F.lit("c2")))
    messages = F.concat(F.array(message("user", no_calls, none), message("assistant", F.array(call("c1"), call("c2")), none)), F.transform(answered, lambda i: message("tool", no_calls, i)))
    return conversation.turn_stats(Tables(spark, d).conversations).select("conv_id", conversation.pending_call(messages)["id"].alias("call_id"))


# -- streams, and embeddings --


@query("stream_tool_counts", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(spark, d):
    return tracker.run_once(tracker.tool_counts(tracker.read_events(spark, f"{d}/events.parquet")), "complete").withColumn("total", F.round("total", 4))


@query("stream_first_patterns", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, d):
    # The watermark spans all events, so each pattern passes once.
    return tracker.run_once(tracker.new_patterns(tracker.read_events(spark, f"{d}/events.parquet"), "3650 days")).select("user_id", "event_type")


@query("stream_windows", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    out = tracker.run_to_end(tracker.read_events(spark, f"{d}/events.parquet"), lambda e: tracker.windowed_counts(e, "1 day", "1 second"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "stream_sessions",
    """WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, CAST(min(ts) AS TIMESTAMP) AS start, count(*) AS n FROM n GROUP BY user_id, k""",
)
def _(spark, d):
    out = tracker.run_to_end(tracker.read_events(spark, f"{d}/events.parquet"), lambda e: tracker.sessions(e, "6 hours", "1 second"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "embed_texts",
    """WITH w AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CAST('0x' || substr(md5(unnest(string_split(lower(p_name), ' '))), 1, 8) AS BIGINT) AS h FROM part), c AS (SELECT id, h // 2 % 16 AS pos, sum(1 - 2 * (h % 2)) AS v FROM w GROUP BY 1, 2)
    SELECT id, CAST(pos AS INTEGER) AS pos, round(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS DOUBLE), 4) AS v FROM c WHERE v <> 0""",
)
def _(spark, d):
    p = Tables(spark, d).part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("text"))
    made = interchange.embed(p, spark.createDataFrame([], "id string, embedding array<float>"), interchange.hashing_embedder(16))
    return made.select("id", F.posexplode("embedding").alias("pos", "v")).where("v <> 0").withColumn("v", F.round(F.col("v").cast("double"), 4))


from . import catalog_generation, catalog_records, catalog_scale  # noqa: E402, F401 - register more queries with query()
