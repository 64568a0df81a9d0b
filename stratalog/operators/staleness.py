"""Which items need enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_stale(
    catalog: DataFrame, version: int, force: bool = False, single_key: str | None = None
) -> DataFrame:
    """Items never enriched or enriched under an older version.

    ``single_key`` picks that item whatever its state; ``force`` picks all. The predicates are
    plain comparisons, so they reach the file scan.
    """
    if single_key:
        return catalog.filter(F.col("item_key") == single_key)
    if force:
        return catalog
    stamp = F.col("enrich_version")
    return catalog.filter(stamp.isNull() | (stamp < version))
