"""Execution plans of chains: arrays of struct<endpoint_id, depends_on, is_parallel>, built by expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _none() -> Column:
    return F.array().cast("array<string>")


def _step(endpoint: Column, depends: Column, parallel: bool = False) -> Column:
    return F.struct(endpoint.alias("endpoint_id"), depends.alias("depends_on"), F.lit(parallel).alias("is_parallel"))


def sequential(steps) -> Column:
    """Each step waits for the one before it."""
    steps = _col(steps)
    return F.transform(steps, lambda e, i: _step(e, F.when(i == 0, _none()).otherwise(F.array(F.get(steps, i - 1)))))


def parallel(together, then) -> Column:
    """Some steps at once, then the others in turn; the first of these waits for all."""
    together, then = _col(together), _col(then)
    later = F.transform(then, lambda e, i: _step(e, F.when(i == 0, together).otherwise(F.array(F.get(then, i - 1)))))
    return F.concat(F.transform(together, lambda e: _step(e, _none(), True)), later)


def branching(start, branches, merge, selected=None) -> Column:
    """The start, the steps of the selected branch (default: the first) of a map, and the merge; unknown branches are empty."""
    start, branches, merge = _col(start), _col(branches), _col(merge)
    chosen = F.lit(selected) if isinstance(selected, str) else selected if selected is not None else F.get(F.map_keys(branches), F.lit(0))
    steps = F.when(chosen.isNotNull() & F.map_contains_key(branches, F.coalesce(chosen, F.lit(""))), F.element_at(branches, chosen)).otherwise(_none())
    return sequential(F.concat(F.array(start), steps, F.array(merge)))


def iterative(start, loop, count, end) -> Column:
    """C11: a step repeated between a start and an end."""
    times = F.greatest(_col(count) if not isinstance(count, int) else F.lit(count), F.lit(0)).cast("int")
    return sequential(F.concat(F.array(_col(start)), F.array_repeat(_col(loop), times), F.array(_col(end))))


def plan(chain, pattern: str) -> Column:
    """The plan of a chain in a pattern; chains of fewer than three steps are sequential."""
    chain = _col(chain)
    n = F.size(chain)
    first, last, middle = F.get(chain, F.lit(0)), F.get(chain, n - 1), F.slice(chain, 2, F.greatest(n - 2, F.lit(0)))
    shaped = {
        "sequential": lambda: sequential(chain),
        "parallel": lambda: parallel(F.slice(chain, 1, 2), F.slice(chain, 3, F.greatest(n - 2, F.lit(0)))),
        "branching": lambda: branching(first, F.create_map(F.lit("main"), middle), last),
        "iterative": lambda: iterative(first, F.get(middle, F.lit(0)), F.size(middle), last),
    }[pattern]()
    return F.when(n < 3, sequential(chain)).otherwise(shaped)


def steps(df: DataFrame, plan_col: str = "plan", *keys: str) -> DataFrame:
    """(keys…, step, endpoint_id, depends_on, is_parallel): one row a step, from 1 on."""
    return df.select(*keys, F.posexplode(plan_col).alias("at", "s")).select(*keys, (F.col("at") + 1).alias("step"), "s.endpoint_id", "s.depends_on", "s.is_parallel")
