"""A store of model answers by the content of the call, so that no call is paid for twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.operators.inference import Client, run_calls
from stratalog.schema import ANSWERS, Answer
from stratalog.sources.snapshots import SnapshotStore

ANSWER_ROWS = "answers"
ANSWER_SCHEMA = T.StructType([
    T.StructField("digest", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
])
_RESPONSES = "array<struct<call_no: int, raw: string, attempts: int, error: string>>"


def call_digest(call: Column) -> Column:
    """SHA-256 of what a client is given: call number, label and prompt. NULL is not the empty text."""
    return F.sha2(F.to_json(F.struct(call["call_no"], call["label"], call["prompt"])), 256)


def run_stored_calls(
    prompts: DataFrame,
    store: SnapshotStore,
    client_factory: Callable[[], Client],
    answers: Sequence[Answer] = ANSWERS,
    attempts: int = 2,
    partitions: int | None = None,
    calls_per_task: int = 1,
) -> DataFrame:
    """What ``inference.run_calls`` gives for (item_key, prompts), asking only for what ``store`` lacks.

    Equal calls of any items are one question. The calls are asked number by number, each number's
    new questions in one distributed step whose answers are stored before the next: an item that a
    required call has failed for asks no further, and a run that was lost goes on where it stopped.
    Accepted answers are kept for good; a failed call is told to this run and asked again by the next.
    ``prompts`` is read once a call number and must be repeatable and unique by key. An item without
    calls has none. Speculative copies of a task would ask twice: the client sees no store.
    """
    required = [a.call_no for a in answers if a.required]
    calls = prompts.select("item_key", F.explode("prompts").alias("c")).select(
        "item_key", "c.*", call_digest(F.col("c")).alias("digest"))
    narrow = calls.select("item_key", "call_no", "digest")
    before = store.version(ANSWER_ROWS)

    def known() -> DataFrame:
        """One row a digest: an accepted answer of any run, or this run's failure."""
        rows = store.read_all(ANSWER_ROWS, ANSWER_SCHEMA)
        return rows.filter((F.col("_version") > before) | F.col("error").isNull()).drop(
            "_version").dropDuplicates(["digest"])

    for number in sorted(a.call_no for a in answers):
        wanted = calls.filter(F.col("call_no") == number)
        ended = [n for n in required if n < number]
        if ended:
            failed = known().filter("error IS NOT NULL").select("digest")
            stopped = narrow.filter(F.col("call_no").isin(ended)).join(failed, "digest", "left_semi")
            wanted = wanted.join(stopped.select("item_key"), "item_key", "left_anti")
        # Equal calls meet before the store is asked: a prompt that many items share is one row a task.
        questions = wanted.dropDuplicates(["digest"]).join(
            known().select("digest"), "digest", "left_anti")
        asked = run_calls(
            questions.select(F.col("digest").alias("item_key"),
                             F.array(F.struct("call_no", "label", "prompt")).alias("prompts")),
            client_factory, answers, attempts, partitions, calls_per_task)
        store.write(ANSWER_ROWS, asked.select(
            F.col("item_key").alias("digest"), F.inline("responses")).drop("call_no"))

    told = narrow.join(known(), "digest").groupBy("item_key").agg(F.array_sort(F.collect_list(
        F.struct("call_no", "raw", "attempts", "error"))).cast(_RESPONSES).alias("responses"))
    return prompts.select("item_key").join(told, "item_key", "left").select(
        "item_key", _until_failure(F.coalesce("responses", F.array().cast(_RESPONSES)), required)
        .alias("responses"))


def _until_failure(responses: Column, required: Sequence[int]) -> Column:
    """The responses up to the first required call that failed: later ones were asked for other items."""
    failed = F.filter(responses, lambda r: r["error"].isNotNull() & r["call_no"].isin(*required))
    last = F.get(failed, F.lit(0))["call_no"]
    return F.filter(responses, lambda r: last.isNull() | (r["call_no"] <= last))
