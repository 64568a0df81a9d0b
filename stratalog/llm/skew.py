"""Look-ups by keys that a large part of all rows may share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than one in so many rows is heavy, so there are fewer heavy keys than this.
HEAVY_SHARE = 1000
# Below this many rows a key is not worth splitting.
HEAVY_ROWS = 1000
# A heavy key's rows are dealt over so many parts.
PARTS = 256


def heavy_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The keys that more than ``rows`` / 1000 of the ``rows`` rows of ``df`` have: under 1000 keys,
    whatever the data, which is what lets them be broadcast."""
    limit = max(HEAVY_ROWS, rows // HEAVY_SHARE)
    return df.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys)


def look_up(df: DataFrame, keys: Sequence[str], given: DataFrame, heavy: DataFrame,
            how: str = "inner") -> DataFrame:
    """``df`` joined with ``given`` (unique by ``keys``, which are not NULL) where the rows of a heavy
    key are dealt over parts and its row of ``given`` is copied to each part."""
    marked = F.broadcast(heavy.select(*keys, F.lit(True).alias("_heavy")))
    rest = [c for c in df.columns if c not in keys]
    part = F.when(F.col("_heavy"), F.pmod(F.xxhash64(*rest), F.lit(PARTS))).otherwise(0)
    left = df.join(marked, list(keys), "left").withColumn("_part", part.cast("int")).drop("_heavy")
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(
        F.array(F.lit(0)))
    right = (given.join(marked, list(keys), "left")
             .withColumn("_part", F.explode(copies)).drop("_heavy"))
    return left.join(right, [*keys, "_part"], how).drop("_part")
