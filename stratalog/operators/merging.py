"""Many crawls merged into the catalog at once.

Merging crawls one after the other comes down to a rule a column: keep the first value, take the last, take
the last that is not empty, fill in while NULL. Each rule picks a row by its place in the order of crawls,
and picking can be done in any grouping. So all crawls and the catalog are one aggregate by key, with a
step before the shuffle that leaves a row a key and task, where n merges would be n joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.operators.catalog import ACTION
from stratalog.schema import CATALOG_SCHEMA, CONTENT_COLUMNS, ROLLUP_COLUMNS

_LAST = ("pulls", "tags", "last_updated", "last_updated_str", "description", "capability",
         "capabilities")


def upsert_many(
    catalog: DataFrame, crawls: DataFrame, base_url: str, item_type: str = "official",
    spread: bool = False,
) -> DataFrame:
    """Merge all ``crawls`` into the catalog; adds ``_action``. Equals one ``catalog_upsert`` after
    another.

    ``crawls`` has the columns of crawl rows, ``crawl_no`` (their order) and ``run_ts`` (the stamp of a
    crawl). Several rows of a key in one crawl count as crawls one after the other, in the order of a hash,
    so repeated rows change nothing. Crawl rows without a key or a number are left out. The catalog is
    unique by key and may lack columns. ``_action`` is ``inserted`` for keys it had not, ``updated`` or
    ``kept``.

    The step before the shuffle sorts a task's rows. Crawls that are computed from narrower rows come in
    partitions that were measured by those; with ``spread`` all rows are dealt by their own size first, by
    key and crawl, so that partitions stay small and one with many rows of a key can be split.
    """
    detail_columns = [c for c in (*CONTENT_COLUMNS, *ROLLUP_COLUMNS) if c in catalog.columns]
    last_columns = [c for c in _LAST if c in catalog.columns]

    def fields(names: list[str]) -> Column:
        # Cast to the catalog's types, so that both sides of the merge agree.
        return F.struct(*[F.col(n).cast(CATALOG_SCHEMA[n].dataType).alias(n) for n in names],
                        F.lit(1).alias("_there"))

    order = F.struct("crawl_no", F.xxhash64(*[
        F.to_json(F.struct(c), {"ignoreNullFields": "false"}) for c in sorted(crawls.columns)]))
    crawled = crawls.filter("item_key IS NOT NULL AND crawl_no IS NOT NULL").select(
        "item_key", order.alias("at"), F.col("run_ts").cast("timestamp").alias("run_ts"),
        F.col("item_name").cast("string").alias("item_name"), F.col("labels").alias("labels"),
        F.col("is_uncensored_hint").alias("hint"),
        F.coalesce("has_detail", F.lit(False)).alias("has_detail"),
        fields(last_columns).alias("last"), fields(detail_columns).alias("detail"))
    stored = catalog.select("item_key", F.struct(*catalog.columns).alias("c"))
    both = stored.unionByName(crawled, allowMissingColumns=True)
    if spread:
        both = both.withColumn("crawl", F.col("at.crawl_no")).hint("rebalance", "item_key", "crawl")

    at, hint = F.col("at"), F.col("hint")

    def latest(value: str, condition: Column | None = None) -> Column:
        return F.max_by(value, at if condition is None else F.when(condition, at)).alias(value)

    merged = both.groupBy("item_key").agg(
        F.first("c", ignorenulls=True).alias("c"),
        F.min_by(F.struct("item_name", "detail"), at).alias("first"),
        latest("last"), latest("run_ts"), latest("detail", F.col("has_detail")),
        latest("labels", F.size("labels") > 0), F.min_by("hint", F.when(hint.isNotNull(), at)).alias(
            "hint"))

    fresh, touched = F.col("c").isNull(), F.col("first").isNotNull()
    # Content that a crawl brought: the last that was fetched, for new keys else the first row's.
    detail = F.coalesce("detail", F.when(fresh, F.col("first.detail")))
    brought = {
        "id": F.coalesce("c.id", F.sha2("item_key", 256)),
        "item_key": F.col("item_key"),
        "item_name": F.when(fresh, F.col("first.item_name")).otherwise(F.col("c.item_name")),
        "item_type": F.when(fresh, F.lit(item_type)).otherwise(F.col("c.item_type")),
        "url": F.when(fresh, F.concat(F.lit(base_url.rstrip("/") + "/"), "item_key")).otherwise(
            F.col("c.url")),
        "labels": F.coalesce("labels", "c.labels", F.array().cast("array<string>")),
        "is_uncensored": F.coalesce("c.is_uncensored", "hint"),
        "validation_retries": F.when(fresh, F.lit(0)).otherwise(F.col("c.validation_retries")),
        "timestamp": F.col("run_ts"),
    }
    brought |= {name: F.col(f"last.{name}") for name in last_columns}
    brought |= {name: F.when(detail.isNull(), F.col(f"c.{name}")).otherwise(detail[name])
                for name in detail_columns}
    out = []
    for name in catalog.columns:
        kept = F.col(f"c.{name}")
        value = F.when(touched, brought[name]).otherwise(kept) if name in brought else kept
        out.append(value.cast(CATALOG_SCHEMA[name].dataType).alias(name))
    action = F.when(fresh, "inserted").when(touched, "updated").otherwise("kept")
    return merged.select(*out, action.alias(ACTION))
