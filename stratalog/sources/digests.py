"""Digests stored beside a snapshot, and what changed between two snapshots told from them alone.

A snapshot's keys are dealt into ranges of their hash. For each row the digests hold one number a column;
for each range they hold the number of rows and two sums over its rows; ranges are added up to wider
ranges, up to the whole. Two snapshots are compared from the top: a range whose sums are equal is left
alone, and in the end only the rows of unequal ranges are read and met by key. Sums do not depend on order,
so it does not matter how a snapshot was written, and a row can be added to them or taken from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranges at the bottom: two to this power. A parent holds two to the power of ``FAN_BITS`` of them.
RANGE_BITS = 10
FAN_BITS = 5
# Rows are stored in folders of two to this power, and within each in the order of ranges.
FOLDER_BITS = 4
_PREFIX = "d_"
_SUM = "decimal(38,0)"


def column_digest(name: str, kind: T.DataType) -> Column:
    """64 bits of a value. NULL differs from what is empty, at any depth."""
    value = F.col(name)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        value = F.when(value.isNotNull(), F.to_json(F.struct(value), {"ignoreNullFields": "false"}))
    return F.xxhash64(value.isNull(), value)


def row_sums(*digests: Column) -> list[Column]:
    """Aggregates that tell a bag of rows apart, by number and two independent sums of 64-bit hashes.
    Adding up the sums of parts gives those of the whole."""
    def added(seed: int) -> Column:
        return F.coalesce(F.sum(F.xxhash64(F.lit(seed), *digests).cast(_SUM)),
                          F.lit(0).cast(_SUM))

    return [F.count(F.lit(1)).alias("rows"), added(1).alias("sum1"), added(2).alias("sum2")]


def bag_digest(rows: DataFrame, ignore: Sequence[str] = ()) -> list[Column]:
    """``row_sums`` over whole rows, for ``agg`` or for ``observe`` while the rows are written."""
    return row_sums(*[column_digest(f.name, f.dataType) for f in rows.schema if f.name not in ignore])


def same_bag(a: dict, b: dict) -> bool:
    """Whether two bags of rows are equal, by their sums: nothing is read."""
    return all(a[name] == b[name] for name in ("rows", "sum1", "sum2"))


def without(a: dict, taken: dict) -> dict:
    """The sums of a bag after the rows of another, which it holds, are taken out."""
    return {name: a[name] - taken[name] for name in ("rows", "sum1", "sum2")}


def key_range(key: Column, bits: int = RANGE_BITS) -> Column:
    """The range of a key: the first bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("range"), key), 64 - bits).cast("int")


def _folder(range_: Column, bits: int) -> Column:
    return F.shiftright(range_, max(0, bits - FOLDER_BITS))


def _stored_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def write_digests(rows: DataFrame, path: str, key: str = "item_key", ignore: Sequence[str] = (),
                  bits: int = RANGE_BITS) -> None:
    """Write the digests of ``rows`` under ``path``. Rows with the same key are taken together, as a bag;
    NULL is a key like any other. ``ignore`` leaves columns out, such as a run stamp."""
    kept = [f for f in rows.schema if f.name != key and f.name not in ignore]
    narrow = rows.select(key_range(F.col(key), bits).alias("range"), F.col(key).alias("key"), *[
        column_digest(f.name, f.dataType).cast(_SUM).alias(_PREFIX + f.name) for f in kept])
    # Almost always one row a key; the sums make several rows of a key one.
    names = [_PREFIX + f.name for f in kept]
    bags = narrow.groupBy("range", "key").agg(
        F.count(F.lit(1)).alias("copies"), *[F.sum(F.col(f"`{n}`")).alias(n) for n in names])
    bags = bags.select("range", "key", "copies", *[
        F.xxhash64(F.col("copies"), F.col(f"`{n}`")).alias(n) for n in names])
    bags = bags.withColumn("folder", _folder(F.col("range"), bits))
    (bags.repartition("folder").sortWithinPartitions("folder", "range").write.partitionBy("folder")
     .mode("overwrite").parquet(f"{path}/rows"))
    spark = rows.sparkSession
    # A snapshot without rows has no folders; its columns are told by a table of their own.
    spark.createDataFrame([], bags.schema).write.mode("overwrite").parquet(f"{path}/columns")
    stored = _stored_rows(spark, path)
    leaf = stored.groupBy("range").agg(*row_sums(
        F.col("key"), F.col("copies"), *[F.col(f"`{n}`") for n in names]))
    level = leaf.select(F.lit(bits).alias("bits"), "range", "rows", "sum1", "sum2")
    level.write.mode("overwrite").parquet(f"{path}/ranges")
    while bits > 0:
        fan = min(FAN_BITS, bits)
        bits -= fan
        below = spark.read.parquet(f"{path}/ranges").filter(F.col("bits") == bits + fan)
        wider = below.groupBy(F.shiftright("range", fan).alias("range")).agg(
            F.sum("rows").alias("rows"), F.sum("sum1").cast(_SUM).alias("sum1"),
            F.sum("sum2").cast(_SUM).alias("sum2"))
        wider.select(F.lit(bits).alias("bits"), "range", "rows", "sum1", "sum2").write.mode(
            "append").parquet(f"{path}/ranges")


def unequal_ranges(spark: SparkSession, new: str, old: str | None, bits: int = RANGE_BITS) -> list[int]:
    """The ranges at the bottom whose rows differ. Each step down reads the parts of ranges found
    unequal; what comes to the driver is bounded by the number of ranges."""
    steps = [bits]
    while steps[-1] > 0:
        steps.append(steps[-1] - min(FAN_BITS, steps[-1]))
    found: list[int] = [0]
    sides = [spark.read.parquet(f"{path}/ranges") for path in (new, old) if path]
    for above, here in zip([0, *steps[::-1]], steps[::-1]):
        parent = F.shiftright("range", here - above)
        parts = sides[0]
        for more in sides[1:]:
            parts = parts.unionByName(more)
        parts = parts.filter((F.col("bits") == here) & parent.isin(found))
        each = parts.groupBy("range", "rows", "sum1", "sum2").count()
        unequal = each.filter(F.col("count") < 2).select("range").distinct()
        found = sorted(r["range"] for r in unequal.collect())
        if not found:
            return []
    return found


def change_feed(spark: SparkSession, new: str, old: str | None, bits: int = RANGE_BITS) -> DataFrame:
    """(key, kind, columns): keys added, removed and changed between two snapshots whose digests are under
    ``new`` and ``old`` (None: nothing was there), and which columns of a changed key differ, by name.

    Only rows of unequal ranges are read. A column that only one snapshot has is changed in every key that
    both have, unless it is NULL throughout there.
    """
    def side(path: str, ranges: list[int]) -> DataFrame:
        # Folders without an unequal range are not opened, row groups without one are passed over.
        folders = sorted({r >> max(0, bits - FOLDER_BITS) for r in ranges})
        wanted = F.col("folder").isin(folders) & F.col("range").isin(ranges)
        return _stored_rows(spark, path).filter(wanted)

    ranges = unequal_ranges(spark, new, old, bits)
    n = side(new, ranges).alias("n")
    o = (side(old, ranges) if old else side(new, [])).alias("o")
    names = sorted({c for c in (*n.columns, *o.columns) if c.startswith(_PREFIX)})
    on = (F.col("n.range") == F.col("o.range")) & F.col("n.key").eqNullSafe(F.col("o.key"))
    # What a column that is not there would hold: NULL, once for each copy of the key.
    null = F.xxhash64(F.lit(True), F.lit(None).cast("string")).cast(_SUM)

    def digest(frame: DataFrame, alias: str, name: str) -> Column:
        if name in frame.columns:
            return F.col(f"{alias}.`{name}`")
        copies = F.col(f"{alias}.copies")
        return F.xxhash64(copies, (null * copies).cast(_SUM))

    differing = [F.when(~digest(n, "n", name).eqNullSafe(digest(o, "o", name)),
                        F.lit(name[len(_PREFIX):])) for name in names]
    columns = F.array_compact(F.array(*differing)) if names else F.array().cast("array<string>")
    kind = (F.when(F.col("o.copies").isNull(), "added").when(F.col("n.copies").isNull(), "removed")
            .when((F.size(columns) > 0) | (F.col("n.copies") != F.col("o.copies")), "changed"))
    met = n.join(o, on, "full_outer").select(
        F.coalesce("n.key", "o.key").alias("key"), kind.alias("kind"),
        F.when(kind == "changed", columns).alias("columns"))
    return met.filter("kind IS NOT NULL")
