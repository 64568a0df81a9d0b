"""Asking again about items that failed validation, as a frontier that each pass narrows.

A pass takes the items that the one before it queued again, enriches and validates those, and leaves the
rest of the catalog alone: a settled item is written once, whatever the number of passes. It ends when
nothing is queued any more, or after ``passes`` of them; since an item is queued ``max_retries`` times at
most, it ends by itself after that many.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.operators.quality import DEFAULT_RULES, Rule, validation_transition

#: Which items a pass takes: every stale one, or those queued again by the pass before.
SCOPES = ("all", "requeued")

Enrich = Callable[[DataFrame, int], DataFrame]


def requeue_loop(
    catalog: DataFrame,
    enrich: Enrich,
    write: Callable[[DataFrame, str], DataFrame],
    version: int,
    passes: int = 1,
    scope: str = "all",
    rules: Sequence[Rule] = DEFAULT_RULES,
    max_retries: int = fv.MAX_VALIDATION_RETRIES,
) -> DataFrame:
    """The catalog after validation and up to ``passes`` further passes; adds ``outcome`` and ``pass_no``,
    those of the last time that an item was checked (pass 0 is the first validation).

    ``enrich(items, pass_no)`` gives the items that it is given with their enrichment written back.
    ``write(df, name)`` stores a table and returns it as stored; a pass that is lost is repeated from
    what the one before it stored. ``scope`` says what a pass takes: ``all``, every item whose version is
    missing or older than ``version``, so also such as were left out before; ``requeued``, only items that
    the pass before queued again.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")

    def checked(items: DataFrame, pass_no: int) -> DataFrame:
        out = validation_transition(items, rules, max_retries).drop("failures")
        return write(out.withColumn("pass_no", F.lit(pass_no)), f"pass-{pass_no}")

    current = checked(catalog, 0)
    settled = []
    for pass_no in range(1, passes + 1):
        again = F.coalesce(F.col("outcome") == "re_queued", F.lit(False))
        if scope == "all":
            again = F.coalesce(F.col("enrich_version") < version, F.lit(True))
        frontier = current.filter(again)
        if frontier.isEmpty():
            break
        settled.append(current.filter(~again))
        current = checked(enrich(frontier.drop("outcome", "pass_no"), pass_no), pass_no)
    out = current
    for rest in settled:
        out = out.unionByName(rest)
    return out
