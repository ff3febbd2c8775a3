"""Judged results of generation: means, rates and reports.

A result is (conversation_id, success, attempts, repaired, tool_correctness, argument_grounding, task_completion,
naturalness, endpoint_ids); scores are null where nothing was judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("tool_correctness", "argument_grounding", "task_completion", "naturalness")


def average() -> Column:
    total = F.lit(0.0)
    for d in DIMENSIONS:
        total = total + F.col(d)
    return total / 4


def judged() -> Column:
    return F.col("success") & average().isNotNull()


def needs_repair(least: float = 6) -> Column:
    """F9."""
    return F.least(*DIMENSIONS) < least


def passes(threshold: float = 6.0) -> Column:
    """F10."""
    return average() >= threshold


def tool_of(endpoint: Column) -> Column:
    """What stands before the first dot of an endpoint's id."""
    return F.element_at(F.split(endpoint, r"\."), 1)


def aggregate_scores(results: DataFrame, threshold: float = 6.0) -> DataFrame:
    """A5: one row; means and rates over judged results, in one pass."""
    ok = judged()
    rate = lambda c: F.coalesce(F.avg(F.when(ok, F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0))), F.lit(0.0))
    n = F.count_if(ok)
    return results.agg(
        F.count("*").alias("total_conversations"), n.alias("successful_conversations"), F.coalesce(F.sum("attempts"), F.lit(0)).cast("long").alias("total_attempts"),
        F.when(n > 0, F.sum("attempts") / F.count("*")).otherwise(0.0).alias("mean_attempts"),
        *[F.coalesce(F.avg(F.when(ok, F.col(d))), F.lit(0.0)).alias(f"mean_{d}") for d in DIMENSIONS], F.coalesce(F.avg(F.when(ok, average())), F.lit(0.0)).alias("mean_overall"),
        rate(passes(threshold)).alias("pass_rate"), rate(F.col("repaired")).alias("repair_rate"), rate(F.size("endpoint_ids") >= 3).alias("multi_step_rate"),
        rate(F.size(F.array_distinct(F.transform("endpoint_ids", tool_of))) >= 2).alias("multi_tool_rate"),
    )


def mean_scores(results: DataFrame) -> DataFrame:
    """Means of all rows with scores; 0 for none."""
    return results.agg(*[F.coalesce(F.avg(d), F.lit(0.0)).alias(d) for d in DIMENSIONS], F.coalesce(F.avg(average()), F.lit(0.0)).alias("overall"))


def pass_rate(results: DataFrame, threshold: float = 6.0) -> DataFrame:
    """A6."""
    return results.where(average().isNotNull()).agg(F.coalesce(F.avg(F.when(passes(threshold), 1.0).otherwise(0.0)), F.lit(0.0)).alias("pass_rate"))


def dataset_result(results: DataFrame) -> DataFrame:
    """A17."""
    return results.agg(F.count("*").alias("n"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.coalesce(F.avg(F.col("success").cast("double")), F.lit(0.0)).alias("success_rate"))


def generation_summary(results: DataFrame, top: int = 5) -> DataFrame:
    """Totals; turns, calls, scores and tools over successful results; and the `top` tools with their calls.

    An endpoint's tool is its id up to the first slash; calls that name a domain (a field of tool_outputs) count it.
    Turns are null and repairs 0 where results have no messages and no such column.
    """
    calls = F.when(F.col("success"), F.size("endpoint_ids"))
    score = F.when(judged(), average())
    fields = results.schema["tool_outputs"].dataType.elementType.names if "tool_outputs" in results.columns else []
    turns = F.avg(F.when(F.col("success"), F.size("messages"))) if "messages" in results.columns else F.lit(None).cast("double")
    totals = results.agg(
        F.count("*").alias("n"), F.count_if("success").alias("succeeded"), F.coalesce(F.avg(calls), F.lit(0.0)).alias("avg_calls"), F.avg(score).alias("avg_score"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
        F.count_if(~F.coalesce("success", F.lit(False))).alias("failed"), (F.count_if("repaired") if "repaired" in results.columns else F.lit(0).cast("long")).alias("repaired"), turns.alias("avg_turns"),
    )
    good = results.where("success")
    used = good.select(F.explode("endpoint_ids").alias("id")).where("id is not null").groupBy(F.split("id", "/")[0].alias("tool")).agg(F.count("*").alias("n_calls"))
    first = used.orderBy(F.desc("n_calls"), "tool").limit(top).agg(F.array_sort(F.collect_list(F.struct((-F.col("n_calls")).alias("less"), "tool"))).alias("top_tools"))
    first = first.select(F.transform("top_tools", lambda x: F.struct(x["tool"].alias("tool"), (-x["less"]).alias("n_calls"))).alias("top_tools"))
    domains = good.select(F.explode("tool_outputs").alias("o")).select(F.col("o.domain").alias("domain")).where("domain <> ''") if "domain" in fields else good.select(F.lit(None).cast("string").alias("domain")).limit(0)
    one = totals.crossJoin(used.agg(F.count("*").alias("n_tools"))).crossJoin(domains.agg(F.countDistinct("domain").alias("n_domains")))  # single rows
    return one.crossJoin(first)


# The report's headings, and its labels with the columns that they show and their formats, in order.
REPORT = (
    ("", (
        ("Total Conversations", "total_conversations", "%d"),
        ("Successful", "successful_conversations", "%d"),
        ("Total Attempts", "total_attempts", "%d"),
        ("Mean Attempts", "mean_attempts", "%.2f"),
    )),
    ("--- Quality Scores (1-10) ---", (
        ("Tool Correctness", "mean_tool_correctness", "%.2f"),
        ("Argument Grounding", "mean_argument_grounding", "%.2f"),
        ("Task Completion", "mean_task_completion", "%.2f"),
        ("Naturalness", "mean_naturalness", "%.2f"),
        ("Overall Average", "mean_overall", "%.2f"),
    )),
    ("--- Rates ---", (
        ("Pass Rate", "pass_rate", "%.1f%%"),
        ("Repair Rate", "repair_rate", "%.1f%%"),
        ("Multi-Step Rate", "multi_step_rate", "%.1f%%"),
        ("Multi-Tool Rate", "multi_tool_rate", "%.1f%%"),
    )),
)


def report(stats: DataFrame) -> DataFrame:
    """A readable text of aggregate_scores(): sections between rules, values of the headed ones in one column."""
    rule, lines = F.lit("=" * 50), []
    for heading, rows in REPORT:
        lines += [F.lit(""), *[F.lit(heading)] * (heading != "")]
        for label, column, shape in rows:
            value = F.col(column) * 100 if shape.endswith("%%") else F.col(column)
            lines.append(F.format_string(f"{label + ':':<20} {shape}" if heading else f"{label}: {shape}", value))
    return stats.select(F.concat_ws("\n", rule, F.lit("Dataset Quality Report"), rule, *lines, rule).alias("report"))
