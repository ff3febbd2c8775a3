"""Conversations in rounds: the same rows as in one go, resumed after a failure, and answered from what is known."""

import json
import os
from collections import Counter
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from convolake.operators import generation, rounds
from convolake.storage import new_path

CHAINS = [(k, [[f"e{k}", f"e{k + 1}", f"e{k % 3}"][: k % 4], [f"x{k}"]]) for k in range(24)]


@dataclass
class Logged:
    """Answers as the offline model does, writes down each request, and stops for good at some while a file is missing."""

    folder: str
    fail_every: int = 0
    never: bool = False

    def complete(self, prompt):
        assert not self.never
        with open(f"{self.folder}/{os.getpid()}", "a") as f:
            f.write(json.dumps(prompt) + "\n")
        if prompt.startswith("ASSISTANT") and "Step 1\n" in prompt and not os.path.exists(f"{self.folder}/go"):
            raise RuntimeError("the worker is lost")
        return generation.FakeModel(fail_every=self.fail_every).complete(prompt)


def _asked(folder):
    return [json.loads(line) for name in os.listdir(folder) if name != "go" for line in open(f"{folder}/{name}")]


@pytest.fixture(scope="module")
def chains(spark):
    return spark.createDataFrame(CHAINS, "conv long, attempts array<array<string>>")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("requests, window, model", [(1, 1, generation.FakeModel()), (3, 4, generation.FakeModel(least=1)), (5, 1, generation.FakeModel(fail_every=7))])
def test_rounds_equal_one_go(spark, chains, requests, window, model):
    found = rounds.generate(chains, model, new_path(spark, "rounds"), requests=requests, window=window, parts=3)
    assert _rows(found) == _rows(generation.generate(chains, model))


def test_a_run_that_ended_goes_on_after_its_last_round(spark, chains, tmp_path):
    path, model = new_path(spark, "rounds"), Logged(str(tmp_path))
    with pytest.raises(Exception, match="the worker is lost"):
        rounds.generate(chains, model, path)
    before = _asked(tmp_path)
    (tmp_path / "go").touch()
    assert _rows(rounds.generate(chains, model, path)) == _rows(generation.generate(chains, generation.FakeModel()))
    # Scenarios belong to the first round, which was committed; only those of second attempts come later.
    again = Counter(_asked(tmp_path)) - Counter(before)
    firsts = {p for p in before if p.startswith("SCENARIO")}
    assert firsts and again and not firsts & set(again)
    done = len(_asked(tmp_path))
    rounds.generate(chains, model, path).collect()
    assert len(_asked(tmp_path)) == done  # finished: nothing is asked again


def test_known_answers_are_not_asked_for(spark, chains, tmp_path):
    path = new_path(spark, "rounds")
    want = _rows(rounds.generate(chains, generation.FakeModel(), path))
    known = rounds.asked(spark, path).where("error is null").select("prompt_hash", "content")
    assert known.where(F.length("prompt_hash") != 32).isEmpty()
    twice = known.unionByName(known)  # repeated entries change nothing
    assert _rows(rounds.generate(chains, Logged(str(tmp_path), never=True), new_path(spark, "rounds"), known=twice)) == want


def test_odd_chains(spark):
    odd = spark.createDataFrame([(None, [["a"]]), ("n", None), ("e", []), ("t", [[]]), ("r", [["a", "b"]]), ("r", [["a", "b"]])], "conv string, attempts array<array<string>>")
    found = {}
    for r in rounds.generate(odd, generation.FakeModel(), new_path(spark, "rounds")).collect():
        found.setdefault(r.conversation_id.removesuffix("-r"), []).append(r)
    assert set(found) == {"None-1", "n", "e", "t-1", "r-1"} and len(found["r-1"]) == 2
    assert not found["n"][0].success and found["n"][0].attempts == found["e"][0].attempts == 0
    assert rounds.generate(odd.limit(0), generation.FakeModel(), new_path(spark, "rounds")).count() == 0


def test_odd_answers_become_texts_as_columns_want_them():
    said = {"role": "user", "content": {"a": 1}, "tool_calls": [{"id": 7, "function": {"name": "f", "arguments": {"x": 2}}}, "no"], "tool_call_id": None}
    schema = generation.pa.schema([("messages", generation.pa.list_(generation.pa.struct([("role", "string"), ("content", "string"), ("tool_calls", generation.pa.list_(generation.pa.struct([("id", "string"), ("function", generation.pa.struct([("arguments", "string")]))])))])))])
    assert generation.to_batch([{"messages": [said]}], schema).to_pylist() == [{"messages": [{"role": "user", "content": "{'a': 1}", "tool_calls": [{"id": "7", "function": {"arguments": "{'x': 2}"}}, None]}]}]


def test_a_round_replays_no_talk(spark, chains, monkeypatch):
    """Work of a round: what is in the talk isn't said again; it was, once a round."""
    said, answers = Counter(), 0
    model, row = generation.FakeModel(), {"conv": "9", "attempts": [[f"e{k}" for k in range(12)]], "answers": [], "talk": None}
    say = generation.Talk.say
    monkeypatch.setattr(generation.Talk, "say", lambda talk, role, *rest, **more: said.update([role]) or say(talk, role, *rest, **more))
    while row.get("result") is None:
        row = rounds._onward(row, rounds.Replay(row["answers"], lambda p: {"text": model.complete(p), "error": None}, 3), 6.0, 20)
        answers += 1
    assert answers > 12 and row["result"] == generation.generate_one(model, "9", row["attempts"])
    assert said == {"user": 24, "assistant": 24, "tool": 24}  # twelve turns here, twelve in one go


def _in_rounds(conv, attempts, model, requests):
    def ask(prompt):
        try:
            return {"text": model.complete(prompt), "error": None}
        except generation.ModelError as e:
            return {"text": None, "error": str(e)}

    row = {"conv": conv, "attempts": attempts, "answers": None}
    while row.get("result") is None:
        row = rounds._onward(row, rounds.Replay(row["answers"], ask, requests), 6.0, 20)
    return row["result"]


def test_second_attempts_and_repairs_are_not_replayed(monkeypatch):
    """Work of a round: a later attempt goes on where it stopped, too, also after a repair."""
    said, say = Counter(), generation.Talk.say
    monkeypatch.setattr(generation.Talk, "say", lambda talk, role, *rest, **more: said.update([role]) or say(talk, role, *rest, **more))
    seen = set()
    for conv in map(str, range(40)):
        attempts = [[f"e{conv}", "f", "g"], ["g", "f", f"e{conv}", "h"]]
        said.clear()
        want = generation.generate_one(generation.FakeModel(), conv, attempts)
        once = Counter(said)
        said.clear()
        assert _in_rounds(conv, attempts, generation.FakeModel(), 3) == want and said == once
        seen.add((want["attempts"], want["repaired"]))
    assert {(1, False), (1, True), (2, True)} <= seen


def test_courses_are_kept_whole():
    """Wherever a round ends, what comes out is what one go gives: failures and the outcome of an earlier attempt as well."""
    kinds = Counter()
    for model in (generation.FakeModel(), generation.FakeModel(least=1), generation.FakeModel(fail_every=7), generation.FakeModel(least=1, fail_every=15)):
        for conv in map(str, range(60)):
            attempts = [["é\n", '"q"'], [], [f"x{conv}", "y"]]
            want = generation.generate_one(model, conv, attempts)
            assert all(_in_rounds(conv, attempts, model, n) == want for n in (1, 2, 3))
            kinds[want["success"], want["repaired"], want["error"]] += 1
    # Some failed in the end and gave the talk of an earlier attempt, as it was repaired or as it was.
    assert kinds[False, True, "no answer"] and kinds[False, False, "no answer"] and kinds[False, True, "judged too low"]
