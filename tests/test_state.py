"""State that adds up: merged and retracted counts, the stateful tracker, steering by batches."""

import datetime
import pickle
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from convolake.operators import diversity, generation, sampling, tracked
from convolake.sources import cache
from convolake.storage import new_path
from convolake.streaming import steering, tracker

GAP = datetime.timedelta(hours=1)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def made(spark, seed=1, convs=40):
    rng = random.Random(seed)
    rows = [(f"c{rng.randrange(convs)}", f"t{rng.randrange(9)}" if rng.random() < 0.95 else None, f"d{rng.randrange(4)}" if rng.random() < 0.9 else None) for _ in range(400)]
    return spark.createDataFrame(rows, "conv string, tool string, domain string")


def test_states_add_up_and_are_taken_back(spark):
    called = made(spark)
    n = F.substring("conv", 2, 9).cast("int")
    part = lambda where: tracked.contributions(tracked.finished(called.where(where)))
    whole = rows_of(part(F.lit(True)).select("kind", "a", "b", "n"))
    assert rows_of(tracked.merged(part(n % 2 == 0), part(n % 2 == 1)).select("kind", "a", "b", "n")) == whole
    less = tracked.merged(part(F.lit(True)), tracked.retracted(part(n % 10 == 3))).select("kind", "a", "b", "n")
    assert rows_of(less) == rows_of(part(n % 10 != 3).select("kind", "a", "b", "n"))
    assert rows_of(tracked.merged(part(F.lit(True)), tracked.retracted(part(F.lit(True))))) == []


def test_state_against_the_conversations(spark):
    called = made(spark).where("tool is not null")
    state = tracked.contributions(tracked.finished(called))
    one, other = (tracked.diversity_metrics(state).first().asDict(), diversity.diversity_metrics(called).first().asDict())
    assert {k: pytest.approx(v) for k, v in one.items()} == other
    registry = spark.createDataFrame([(f"e{k}", f"t{k}") for k in range(12)], "endpoint string, tool string")
    assert rows_of(tracked.weights(state, registry)) == rows_of(diversity.weights(called, registry).select("endpoint", "weight"))
    nothing = tracked.contributions(tracked.finished(called.limit(0)))
    assert {r["weight"] for r in tracked.weights(nothing, registry).collect()} == {1.0} and tracked.diversity_metrics(nothing).count() <= 1


def test_versions_replace_themselves(spark):
    state = tracked.StateTable(spark, new_path(spark, "state"), every=3)
    part = lambda k: spark.createDataFrame([("tool", "t", "", k), ("tool", f"t{k}", "", 1)], tracked.STATE)
    for k in range(8):
        state.commit(k, part(k))
        state.commit(k, part(k))  # run again
        assert {r["a"]: r["n"] for r in state.before(k + 1).collect()} == {"t": sum(range(k + 1)), **{f"t{j}": 1 for j in range(k + 1)}} or k == 0
    assert rows_of(state.before(0)) == [] and {r["a"] for r in state.before(5).collect()} == {"t", *(f"t{j}" for j in range(5))}


def calls(spark, seed=4):
    """Calls of conversations of some minutes each, at different times, dealt to files in any order within some hours."""
    rng, start = random.Random(seed), datetime.datetime(2024, 1, 1)
    rows = []
    for c in range(60):
        begin = start + datetime.timedelta(hours=2 * c)
        rows += [(f"c{c}", f"t{rng.randrange(6)}", f"d{rng.randrange(3)}", begin + datetime.timedelta(minutes=rng.randrange(50))) for _ in range(rng.randint(1, 8))]
    rows.sort(key=lambda r: r[3] + datetime.timedelta(minutes=rng.randrange(300)))
    path = new_path(spark, "calls")
    for at in range(0, len(rows), 60):
        part = rows[at : at + 60]
        rng.shuffle(part)
        spark.createDataFrame(part, "conv string, tool string, domain string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(rows, "conv string, tool string, domain string, ts timestamp")


def versions(state, most=50):
    """How many versions of a state can be read."""
    for k in range(most):
        try:
            state._read(f"parts/{k}").count()
        except Exception:  # noqa: BLE001 - Spark's error for a path that isn't there
            return k
    return most


def test_tracker_out_of_order_and_restarted(spark):
    path, rows = calls(spark)
    want = rows_of(tracked.contributions(tracked.finished(rows)).select("kind", "a", "b", "n"))
    stream = lambda: tracker.read_events(spark, path, files=1)
    state, failed = tracked.StateTable(spark, new_path(spark, "state"), every=2), []

    class Once(tracked.StateTable):
        def commit(self, version, part):
            super().commit(version, part)
            if version == 2 and not failed:
                failed.append(version)
                raise RuntimeError("lost after it was written")

    marks = new_path(spark, "marks")
    with pytest.raises(Exception, match="lost after"):
        tracker.track(stream(), Once(spark, state.path, every=2), GAP, late="6 hours", marks=marks)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider") or spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    tracker.track(stream(), state, GAP, late="6 hours", marks=marks)
    k = versions(state)
    assert failed == [2] and rows_of(state.before(k).select("kind", "a", "b", "n")) == want
    # Conversations ended while calls still came, not all at the end.
    early = state.before(k - 2).where("kind = 'conversation'").first()
    assert early is not None and 0 < early["n"] < 60


def test_tracker_keeps_no_state_a_key(spark):
    path, rows = calls(spark)
    query, state = [], tracked.StateTable(spark, new_path(spark, "state"))

    class Seen(tracked.StateTable):
        def commit(self, version, part):
            super().commit(version, part)
            query.append(part._jdf.queryExecution().toString())

    tracker.track(tracker.read_events(spark, path, files=1), Seen(spark, state.path), GAP, late="6 hours")
    assert query and not any("TransformWithState" in q for q in query)


def test_steering_replays_change_nothing(spark):
    endpoints = spark.createDataFrame([(f"e{k}", f"t{k % 7}", f"d{k % 3}", 0.9) for k in range(40)], "id string, tool_id string, domain string, completeness_score double")
    registry = endpoints.select(F.col("id").alias("endpoint"), F.col("tool_id").alias("tool"), "domain")
    path = new_path(spark, "requests")
    for b in range(3):
        spark.createDataFrame([(f"r{b}{k}",) for k in range(5)], "conv string").coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema("conv string").option("maxFilesPerTrigger", 1).parquet(path)
    sampler = lambda batch, weights, k: steering.next_chains(batch, endpoints, sampling.Constraints(), weights, 2, k)
    state = tracked.StateTable(spark, new_path(spark, "state"))
    whole = steering.steer(stream(), registry, sampler, state, new_path(spark, "out"), new_path(spark, "marks"))
    want = rows_of(whole.select("batch", "conv", "step", "endpoint", "w"))
    assert len(want) == 30 and len({r[4] for r in want}) > 1

    failed = []

    class Failing(tracked.StateTable):
        def commit(self, version, part):
            if version == 1 and len(failed) == 0:
                failed.append("before")
                raise RuntimeError("lost before")
            super().commit(version, part)
            if version == 1 and len(failed) == 1:
                failed.append("after")
                raise RuntimeError("lost after")

    again, out, marks = Failing(spark, new_path(spark, "state")), new_path(spark, "out"), new_path(spark, "marks")
    for what in ("before", "after"):
        with pytest.raises(Exception, match=f"lost {what}"):
            steering.steer(stream(), registry, sampler, again, out, marks)
    assert rows_of(steering.steer(stream(), registry, sampler, again, out, marks).select("batch", "conv", "step", "endpoint", "w")) == want
    assert rows_of(again.before(3).select("kind", "a", "b", "n")) == rows_of(state.before(3).select("kind", "a", "b", "n"))


def test_chains_in_turns_and_without_endpoints(spark):
    endpoints = spark.createDataFrame([("e1", "t1", "d", 0.9), ("e2", "t1", "d", 0.9)], "id string, tool_id string, domain string, completeness_score double")
    requests = spark.createDataFrame([("a",), ("b",), ("b",)], "conv string")
    weights = spark.createDataFrame([("e1", 1.0), ("e2", 2.0)], "endpoint string, weight double")
    got = rows_of(steering.next_chains(requests, endpoints, sampling.Constraints(), weights, 3, 0).select("conv", "step", "endpoint"))
    assert got == [("a", 1, "e2"), ("a", 2, "e1"), ("a", 3, "e2"), ("b", 1, "e1"), ("b", 2, "e2"), ("b", 3, "e1")]
    assert steering.next_chains(requests, endpoints.limit(0), sampling.Constraints(), weights, 3, 0).count() == 0


def test_filters_merge_and_miss_nothing(spark):
    key = F.md5(F.col("id").cast("string")).alias("prompt_hash")
    entries, requests = spark.range(4000).select(key), spark.range(2000, 30_000).select("id", key).unionByName(spark.createDataFrame([(-1, None)], "id long, prompt_hash string"))
    words = cache.bloom_words(4000)
    whole = cache.bloom(entries, words)
    parts = [cache.bloom(spark.range(a, b).select(key), words) for a, b in ((0, 1500), (1000, 3000), (2500, 4000))]
    assert rows_of(cache.blooms_merged(*parts)) == rows_of(whole) and whole.count() <= words
    seen = requests.withColumn("maybe", cache.maybe_there(whole, words))
    there, wrong = seen.where("id between 0 and 3999").agg(F.avg(F.col("maybe").cast("int"))).first()[0], seen.where("id >= 4000").agg(F.avg(F.col("maybe").cast("int"))).first()[0]
    print("false positives:", wrong)
    assert there == 1.0 and wrong < 0.02
    want = rows_of(cache.misses(requests, entries).select("id"))
    assert rows_of(cache.misses_filtered(requests, entries).select("id")) == want == rows_of(cache.misses_filtered(requests, entries, most=10).select("id"))
    assert rows_of(cache.misses_filtered(requests, entries.limit(0)).select("id")) == rows_of(requests.select("id"))


def test_large_domains_are_dealt(spark):
    from convolake.operators import graph

    rows = spark.createDataFrame([(f"e{k}", "a" if k % 3 else f"d{k % 5}") for k in range(90)] + [("x", None), ("y", "")], "id string, domain string")
    one, other = (rows_of(graph.same_domain_edges(rows, most=m).select("src", "dst")) for m in (20_000, 7))
    assert one == other and len(one) == len(set(one)) == sum(n * (n - 1) // 2 for n in (60, 6, 6, 6, 6, 6))


class Slow:
    """The offline model, after a while; counts how many ask at a time."""

    def __init__(self, wait):
        self.wait, self.now, self.most, self.lock = wait, 0, 0, threading.Lock()

    def complete(self, prompt):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(self.wait)
        with self.lock:
            self.now -= 1
        return generation.FakeModel().complete(prompt)


def test_requests_in_flight():
    chains = [(str(k), [[f"e{k}", f"e{k + 1}"], [f"e{k}"]]) for k in range(12)]
    talk = lambda model: lambda x: generation.generate_one(model, *x)
    plain = [talk(generation.FakeModel())(x) for x in chains]
    one, many = Slow(0.01), Slow(0.01)
    began = time.perf_counter()
    assert list(generation.in_flight(talk(one), chains, 1)) == plain
    middle = time.perf_counter()
    assert list(generation.in_flight(talk(many), chains, 6)) == plain
    ended = time.perf_counter()
    assert one.most == 1 and 3 <= many.most <= 6 and (middle - began) > 2.5 * (ended - middle)
    taken = []
    first = next(generation.in_flight(lambda x: x, (taken.append(k) or k for k in range(100)), 4))
    assert first == 0 and len(taken) <= 5  # no more are taken in than are in flight
    with pytest.raises(ZeroDivisionError):
        list(generation.in_flight(lambda x: 1 // x, [1, 0, 1], 3))


def test_a_shared_rate():
    model = pickle.loads(pickle.dumps(generation.Paced(generation.FakeModel(), per_second=100)))
    began = time.perf_counter()
    got = list(generation.in_flight(model.complete, [f"TYPE\n{k}" for k in range(31)], 8))
    assert got == [generation.FakeModel().complete(f"TYPE\n{k}") for k in range(31)] and time.perf_counter() - began >= 0.29


def test_generate_with_a_window(spark):
    chains = spark.createDataFrame([(k, [[f"e{k}", f"e{k + 1}"], [f"e{k}"]]) for k in range(20)], "conv long, attempts array<array<string>>")
    one, many = (sorted(map(str, generation.generate(chains, generation.FakeModel(), window=w).collect())) for w in (1, 5))
    assert one == many and len(one) == 20


def test_parts_of_conversations_do_not_grow_with_the_table(spark):
    """Pairs and states are summed over parts of a bounded number of calls; before, over as many parts as shuffles have."""
    called = spark.range(4000).select((F.col("id") % 500).alias("conv"), (F.col("id") % 7).alias("tool"), F.lit("d").alias("domain"))
    own = max(8, spark.sparkContext.defaultParallelism)
    assert [diversity.dealt(called, rows).rdd.getNumPartitions() for rows in (500_000, 100)] == [own, 40]
    held = diversity.dealt(called, 100).select("conv", F.spark_partition_id().alias("p")).distinct()
    assert held.count() == 500  # a conversation is in one part
    plan = diversity.tool_pairs(called)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 2
    assert "REPARTITION_BY_NUM" in tracked.finished(called)._jdf.queryExecution().executedPlan().toString()
