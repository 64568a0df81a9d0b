"""The validation state of every item after any number of runs, from what happened in them.

What a run does to an item depends on the item's state, and there are few states. So a run is a table from
state to state, and so are two runs, one after the other, and any number of them. Histories are therefore
folded in parts: what happened in a block of runs is packed into one number by an aggregate that does not
mind the order (each run has its own bits), a block becomes a table, and tables of successive blocks are
composed, block by block, until one table a key is left. No history of a key is in one task or one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv

# What happened to an item in a run, as bits: it was enriched; then it was checked and passed, or failed.
ENRICHED, PASSED, FAILED = 1, 2, 4
_BITS = 3
#: Runs packed into one number.
BLOCK_RUNS = 21
#: Successive tables composed at a time.
FAN = 512
NONE, VALID, GIVEN_UP = 0, 1, 2


def step(state: tuple[int, int, int], event: int, max_retries: int) -> tuple[int, int, int]:
    """One run: (is enriched, status, retries) before and after."""
    enriched, status, retries = state
    if event & ENRICHED:
        enriched, status = 1, NONE
    if event & (PASSED | FAILED) and enriched and status == NONE:
        if not event & FAILED:
            return 1, VALID, 0
        if retries < max_retries:
            return 0, NONE, retries + 1
        status = GIVEN_UP
    return enriched, status, retries


def _states(max_retries: int) -> list[tuple[int, int, int]]:
    """All states. The last number of retries stands for any number beyond the maximum."""
    return [(e, s, r) for e in (0, 1) for s in (NONE, VALID, GIVEN_UP) for r in range(max_retries + 2)]


def _int_array(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _state_number(enriched: Column, status: Column, retries: Column, max_retries: int) -> Column:
    capped = F.least(F.coalesce(retries, F.lit(0)), F.lit(max_retries + 1))
    return ((enriched.cast("int") * 3 + status) * (max_retries + 2) + capped).cast("int")


def _table_of(packed: Column, max_retries: int) -> Column:
    """The table of a block: all its runs, one after the other, from every state."""
    states = _states(max_retries)
    number = {s: i for i, s in enumerate(states)}
    after = _int_array([number[step(s, event, max_retries)] for s in states
                        for event in range(1 << _BITS)])

    def event(i: Column) -> Column:
        shifted = F.call_function("shiftright", packed, i * _BITS)
        return shifted.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    happened = F.filter(F.sequence(F.lit(0), F.lit(BLOCK_RUNS - 1)), lambda i: event(i) != 0)
    return F.aggregate(
        F.transform(happened, event), _int_array(list(range(len(states)))),
        lambda table, e: F.transform(table, lambda s: F.get(after, s * (1 << _BITS) + e)))


def composed(tables: DataFrame, blocks: int) -> DataFrame:
    """One table a key from (key, block, table), blocks in order; a task holds ``FAN`` of a key's."""
    while blocks > 1:
        groups = tables.groupBy("key", F.expr(f"block div {FAN}").alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("block", "table"))).alias("parts"))
        table = F.aggregate(
            F.slice("parts", 2, FAN), F.get("parts", F.lit(0))["table"],
            lambda before, part: F.transform(before, lambda s: F.get(part["table"], s)))
        tables = groups.select("key", "block", table.alias("table"))
        blocks = -(-blocks // FAN)
    return tables.select("key", "table")


def histories(events: DataFrame, max_retries: int = fv.MAX_VALIDATION_RETRIES) -> DataFrame:
    """(key, table) of ``events`` (key, run, enriched, passed).

    ``run`` counts from 0. In a run, enrichment comes before the check; ``passed`` NULL means that the
    item was not checked. Several rows of a key and run are taken together: it was enriched if any says so,
    and a check that failed once has failed, so repeated rows change nothing. Rows without a run or a key
    are left out.
    """
    bits = (F.when(F.coalesce("enriched", F.lit(False)), ENRICHED).otherwise(0)
            + F.when(F.col("passed"), PASSED).when(~F.col("passed"), FAILED).otherwise(0))
    known = events.filter("key IS NOT NULL AND run >= 0")
    at = F.pmod("run", F.lit(BLOCK_RUNS)).cast("int") * _BITS
    packed = known.groupBy("key", F.expr(f"run div {BLOCK_RUNS}").alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", bits.cast("bigint"), at)).alias("packed"))
    last = known.agg(F.max("run")).first()[0]
    tables = packed.select("key", "block", _table_of(F.col("packed"), max_retries).alias("table"))
    return composed(tables, 0 if last is None else last // BLOCK_RUNS + 1)


def validation_replay(
    events: DataFrame, catalog: DataFrame, max_retries: int = fv.MAX_VALIDATION_RETRIES
) -> DataFrame:
    """The catalog's items after all ``events``: key, is_enriched, validated, validation_failed,
    validation_retries.

    ``catalog`` (key, unique; is_enriched, validated, validation_failed, validation_retries) is the state
    before the first run; keys that only events have begin as new items. An item that is neither valid nor
    given up has both flags NULL.
    """
    before = catalog.select(
        "key", F.coalesce("is_enriched", F.lit(False)).alias("is_enriched"),
        F.when(F.col("validated"), VALID).when(F.col("validation_failed"), GIVEN_UP)
        .otherwise(NONE).alias("status"), "validation_retries")
    met = histories(events, max_retries).join(before, "key", "full_outer")
    start = _state_number(F.coalesce("is_enriched", F.lit(False)), F.coalesce("status", F.lit(NONE)),
                          F.col("validation_retries"), max_retries)
    end = F.coalesce(F.get("table", start), start)
    per_status = max_retries + 2
    found = met.withColumn("end", end).withColumn("to", F.expr(f"cast(end div {per_status} % 3 AS int)"))
    retries = F.col("end") % per_status
    return found.select(
        "key", (F.col("end") >= 3 * per_status).alias("is_enriched"),
        F.when(F.col("to") == VALID, True).when(F.col("to") == GIVEN_UP, False).alias("validated"),
        F.when(F.col("to") == GIVEN_UP, True).alias("validation_failed"),
        F.when(retries > max_retries, F.col("validation_retries")).otherwise(retries).cast("int")
        .alias("validation_retries"))
