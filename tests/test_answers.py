"""Answers by the content of the call: asked once, cut where an item would have stopped, kept for good."""

import pytest
from pyspark.sql import functions as F

from checks.tables import StubClient
from stratalog.operators.answers import (
    ANSWER_ROWS, ANSWER_SCHEMA, call_digest, run_stored_calls)
from stratalog.operators.inference import run_calls
from stratalog.schema import ANSWERS
from stratalog.sources.snapshots import SnapshotStore

PROMPTS = ("item_key string, prompts array<struct<call_no: int, label: string, prompt: string>>")


def items(spark, topics):
    """(key, topic) to prompts; a topic of None gives an item without calls."""
    return spark.createDataFrame([
        (key, [] if i is None else [(a.call_no, a.label, f"Item: {i}\n{a.label}") for a in ANSWERS])
        for key, i in topics], PROMPTS)


class Unreachable:
    def complete(self, call_no, label, prompt):
        raise ConnectionError("gone")


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "answers"))


def asked(store):
    return store.read_all(ANSWER_ROWS, ANSWER_SCHEMA).count()


def said(df):
    return sorted((r.item_key, [tuple(x) for x in r.responses]) for r in df.collect())


def test_stored_answers_are_those_of_asking_every_item(spark, store):
    # 17 fails at a required call, 19 is rejected at one, 20 at an optional one; a third share topic 4.
    topics = [(f"k{n}", [4, 17, 19, 20, 34, None][n % 6] if n % 3 else 4) for n in range(24)]
    prompts = items(spark, topics)
    got = said(run_stored_calls(prompts, store, StubClient))
    assert got == said(run_calls(prompts, StubClient))
    wanted = {i for _, i in topics if i is not None}
    assert asked(store) == sum(3 if i % 17 == 0 else 4 if i % 19 == 0 else 6 for i in wanted)


def test_the_next_run_asks_for_failures_and_news_alone(spark, store):
    first = items(spark, [("a", 1), ("b", 1), ("c", 17)])
    run_stored_calls(first, store, StubClient)
    before = asked(store)
    # All that was accepted is there without the client; what had failed fails anew, by its own error.
    lost = dict(said(run_stored_calls(first, store, Unreachable)))
    assert [x[3] for x in lost["a"]] == [None] * 6 and lost["a"] == lost["b"]
    assert lost["c"][-1][3] == "ConnectionError: gone" and len(lost["c"]) == 3
    assert asked(store) == before + 1
    more = items(spark, [("a", 1), ("d", 2)])
    assert said(run_stored_calls(more, store, StubClient)) == said(run_calls(more, StubClient))
    assert asked(store) == before + 1 + 6


def test_an_answer_of_another_item_is_not_told_after_a_failure(spark, store):
    """Two items share their last call; one of them never gets that far."""
    prompts = spark.createDataFrame([
        ("good", [(1, "x", "Item: 1"), (3, "x", "Item: 1"), (5, "x", "Item: 1")]),
        ("bad", [(1, "x", "Item: 17"), (3, "x", "Item: 17"), (5, "x", "Item: 1")])], PROMPTS)
    got = dict(said(run_stored_calls(prompts, store, StubClient)))
    assert [x[0] for x in got["good"]] == [1, 3, 5] and [x[0] for x in got["bad"]] == [1, 3]


def test_no_items_and_unlike_calls(spark, store):
    assert said(run_stored_calls(items(spark, []), store, StubClient)) == []
    calls = spark.createDataFrame(
        [(1, "a", "b"), (1, "a", None), (1, "a", ""), (1, None, "b"), (2, "a", "b"), (1, "ab", "")],
        "call_no int, label string, prompt string").select(call_digest(F.struct("*")).alias("d"))
    assert calls.distinct().count() == 6
