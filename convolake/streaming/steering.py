"""Steering: what to sample next follows from what earlier micro-batches have used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import sampling, tracked

#: sampler(requests of a batch, weights, batch number) -> (conv, step, endpoint, …)
Sampler = Callable[[DataFrame, DataFrame, int], DataFrame]


def next_chains(requests: DataFrame, endpoints: DataFrame, c: sampling.Constraints, weights: DataFrame, steps: int, seed: int) -> DataFrame:
    """(conv, step, endpoint, tool, w): each request (conv) gets the next `steps` of the best weighted endpoints (C3, W4), in order of conv.

    Where there are fewer endpoints than are asked for, they are taken in turns. What is numbered in one task is a batch's
    requests, times steps: the size of a micro-batch bounds it.
    """
    requests = requests.select("conv").distinct()
    asked = requests.count() * steps
    best = sampling.start_candidates(endpoints, c, weights, max(asked, 1), seed)
    found = best.count()
    if not found:
        return requests.sparkSession.createDataFrame([], f"conv {requests.schema['conv'].dataType.simpleString()}, step int, endpoint string, tool string, w double")
    numbered = requests.withColumn("number", F.row_number().over(Window.orderBy("conv")) - 1)
    wanted = numbered.select("conv", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), "number")
    wanted = wanted.select("conv", "step", ((F.col("number") * steps + F.col("step") - 1) % found).alias("rank"))
    return wanted.join(best, "rank").select("conv", "step", F.col("id").alias("endpoint"), F.col("tool_id").alias("tool"), "w")


def steer(requests: DataFrame, registry: DataFrame, sampler: Sampler, state: tracked.StateTable, out: str, marks: str, finish: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Runs a stream of requests (conv, …); the results of all batches, with their number (batch).

    A batch reads the state that the batch before it committed, so feedback lags by one batch. Its chains are written
    first, `finish` (generation, say) may turn them into the calls that were really made, and these are committed as the
    state's next version. A batch that is run again, after a failure anywhere in it, reads the same state, replaces its own
    chains and its own version, and so changes nothing.
    """
    spark = requests.sparkSession

    def one(batch: DataFrame, k: int) -> None:
        chains = sampler(batch, tracked.weights(state.before(k), registry), k)
        chains.write.mode("overwrite").parquet(f"{out}/batch={k}")
        made = spark.read.schema(chains.schema).parquet(f"{out}/batch={k}")
        made = finish(made, k) if finish else made
        called = made.select("conv", "endpoint").join(registry.select("endpoint", "tool", "domain"), "endpoint")
        state.commit(k, tracked.contributions(tracked.finished(called)))

    requests.writeStream.option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(one).start().awaitTermination()
    return spark.read.parquet(out)
