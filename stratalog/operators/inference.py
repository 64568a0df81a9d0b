"""Batched model calls through a client the caller supplies."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.operators.responses import FALSE_WORDS, TRUE_WORDS
from stratalog.schema import ANSWERS, RESPONSES_SCHEMA, Answer

_RESPONSE = pa.struct([
    ("call_no", pa.int32()), ("raw", pa.string()), ("attempts", pa.int32()), ("error", pa.string()),
])
_OUT = pa.schema([("item_key", pa.string()), ("responses", pa.list_(_RESPONSE))])


class Client(Protocol):
    def complete(self, call_no: int, label: str, prompt: str) -> str:
        """Raw answer text of one call; raises if the call fails."""


def _refused(constant: str) -> None:
    raise ValueError(f"{constant} is no JSON")


def _distinct(pairs: list[tuple[str, Any]]) -> dict:
    """An object whose names are all different, as the parser of the record wants it."""
    if len({name for name, _ in pairs}) < len(pairs):
        raise ValueError("a name is repeated")
    return dict(pairs)


def _acceptable(answer: Answer, raw: str) -> bool:
    """Whether an answer is worth keeping or must be asked for again.

    Only the retry decision is taken here; ``responses.parse_answer`` judges for the record.
    """
    try:
        data = json.loads(raw, parse_constant=_refused, object_pairs_hook=_distinct)
    except (TypeError, ValueError):
        return False
    if not isinstance(data, dict):
        return False
    for field in answer.fields:
        value: Any = data.get(field.name)
        if value is None:
            if field.nullable:
                continue
            return False
        if field.kind == "string":
            good = isinstance(value, str)
        elif field.kind == "boolean":
            good = isinstance(value, (bool, int, str)) and str(
                value
            ).lower() in TRUE_WORDS + FALSE_WORDS
        else:
            item = str if field.kind == "strings" else dict
            good = isinstance(value, list) and all(isinstance(v, item) for v in value)
        if not good:
            return False
        if field.min_len is not None and len(value) < field.min_len:
            return False
        if field.max_len is not None and len(value) > field.max_len:
            return False
    return True


def run_calls(
    prompts: DataFrame,
    client_factory: Callable[[], Client],
    answers: Sequence[Answer] = ANSWERS,
    attempts: int = 2,
    partitions: int | None = None,
    calls_per_task: int = 1,
) -> DataFrame:
    """Ask all calls of every item: (item_key, responses).

    A task works on ``calls_per_task`` items at a time, each thread with a client of its own; the
    calls of one item follow each other. A call gets ``attempts`` tries; a required call that gets no acceptable
    answer ends its item, an optional one is left out. Items spread over ``partitions`` tasks by
    key, which evens out uneven input files and sets how many calls run at a time.

    The result is neither cached nor repeatable. Write it before using it (``plans.refresh`` does),
    or a second use asks, and pays for, every call again.
    """
    specs = {a.call_no: a for a in answers}

    def ask(client: Client, call: dict) -> dict:
        answer = specs[call["call_no"]]
        raw = error = None
        for attempt in range(1, attempts + 1):
            try:
                raw = client.complete(call["call_no"], call["label"], call["prompt"])
                error = None if _acceptable(answer, raw) else "rejected answer"
            except Exception as problem:  # the client is foreign code: any failure is a failed call
                raw, error = None, f"{type(problem).__name__}: {problem}"
            if error is None:
                break
        return {"call_no": answer.call_no, "raw": raw, "attempts": attempt, "error": error}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = threading.local()

        def answered(item: dict) -> dict:
            if not hasattr(own, "client"):
                own.client = client_factory()
            responses = []
            for call in sorted(item["prompts"], key=lambda c: c["call_no"]):
                responses.append(ask(own.client, call))
                if responses[-1]["error"] and specs[call["call_no"]].required:
                    break
            return {"item_key": item["item_key"], "responses": responses}

        with ThreadPoolExecutor(calls_per_task) as pool:
            for batch in batches:
                rows = list(pool.map(answered, batch.to_pylist()))
                yield pa.RecordBatch.from_pylist(rows, schema=_OUT)

    spread = prompts.repartition(partitions, "item_key") if partitions else prompts
    return spread.select("item_key", "prompts").mapInArrow(run, RESPONSES_SCHEMA)


def infer_counts(ok: Column) -> list[Column]:
    """total, ok and failed of an enrichment run; usable in ``agg`` and in ``observe``."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
    ]


def infer_summary(merged: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Run totals. An enriched item that the catalog no longer has counts as failed."""
    if catalog is None:
        return merged.agg(*infer_counts(F.col("ok")))
    present = catalog.select("item_key", F.lit(True).alias("_present"))
    return merged.join(present, "item_key", "left").agg(
        *infer_counts(F.col("ok") & F.coalesce("_present", F.lit(False)))
    )
