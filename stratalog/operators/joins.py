"""Joins by key with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after a count has shown that it holds no more rows than this.
BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; stops reading once it has more.

    Meant for data that is already written: on a long plan the check would run the plan.
    """
    return df.limit(limit + 1).count() <= limit


def semi_by_key(big: DataFrame, keys: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys``.

    With ``small`` (a checked size) the keys are broadcast and ``big`` is not shuffled.
    """
    wanted = keys.select(key)
    return big.join(F.broadcast(wanted) if small else wanted, key, "left_semi")
