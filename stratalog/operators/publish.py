"""Export rows, their statistics, and the comparison with the previous export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog import fixed_values as fv
from stratalog.schema import CATALOG_SCHEMA, EXPORT_COLUMNS


def iso_timestamp(ts: Column) -> Column:
    """ISO text; the fraction is written only if there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    return F.when(micros == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def export_rows(catalog: DataFrame) -> DataFrame:
    """Enriched items with the exported columns: lists never NULL, dates as ISO text."""
    out = []
    for name in EXPORT_COLUMNS:
        value, kind = F.col(name), CATALOG_SCHEMA[name].dataType
        if isinstance(kind, T.ArrayType):
            value = F.coalesce(value, F.array().cast(kind))
        elif isinstance(kind, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType):
            value = iso_timestamp(value)
        out.append(value.alias(name))
    return catalog.filter(F.col("enrich_version").isNotNull()).select(*out)


def ranked(rows: DataFrame) -> DataFrame:
    """Most popular first. The key breaks ties, which also splits a value that many rows share
    over several range partitions."""
    return rows.orderBy(F.desc("pulls"), F.asc("item_key"))


def renamed(rows: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    return rows.withColumnsRenamed(dict(fv.EXPORT_NAMES if names is None else names))


def export_counts() -> list[Column]:
    """Statistics over export rows; usable in ``agg`` and in ``observe``."""

    def count_true(condition: Column, name: str) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)

    total = F.count(F.lit(1))
    return [
        total.alias("total"),
        count_true(F.col("enrich_version").isNotNull(), "enriched"),
        count_true(F.col("validated"), "validated"),
        count_true(F.col("validation_failed"), "validation_failed"),
        total.alias("exported"),
        count_true(F.length("readme") > 0, "with_readme"),
        count_true(F.size("memory_requirements") > 0, "with_memory"),
        count_true(F.col("is_uncensored"), "uncensored"),
    ]


def export_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(*export_counts())


def snapshot_diff(new: DataFrame, previous: DataFrame, key: str = "item_key") -> DataFrame:
    """One row: total rows of ``new``, keys only in ``new``, keys in both, keys only in the old.

    Both sides are reduced to (key, side) and counted per key in one aggregate: one shuffle of
    bare keys, reduced on the map side first, instead of a join.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = new.select(F.col(key).alias("k"), one.alias("n"), none.alias("p")).unionAll(
        previous.select(F.col(key).alias("k"), none.alias("n"), one.alias("p"))
    )
    per_key = sides.groupBy("k").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    n, p = F.col("n"), F.col("p")
    return per_key.agg(
        F.coalesce(F.sum(n), none).alias("total"),
        F.count_if((n > 0) & (p == 0)).alias("new"),
        F.count_if((n > 0) & (p > 0)).alias("common"),
        F.count_if((n == 0) & (p > 0)).alias("removed"),
    )


def no_change_gate(
    new: DataFrame, previous: DataFrame, ignore: Sequence[str] = ()
) -> DataFrame:
    """One row: how many distinct rows differ in number, and whether nothing changed.

    Equality of the two sets of rows, counting repeats and ignoring order. Each row is reduced to
    a SHA-256 digest before the shuffle, so 32 bytes travel instead of the whole document.
    ``ignore`` leaves columns out, such as a run stamp that every refresh rewrites.
    """
    columns = [c for c in new.columns if c not in ignore]
    digest = F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))
    sides = new.select(digest.alias("d"), F.lit(1).alias("w")).unionAll(
        previous.select(digest.alias("d"), F.lit(-1).alias("w"))
    )
    changed = sides.groupBy("d").agg(F.sum("w").alias("w")).agg(
        F.count_if(F.col("w") != 0).alias("changed_rows")
    )
    return changed.withColumn("unchanged", F.col("changed_rows") == 0)
