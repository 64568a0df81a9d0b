"""Merging crawls, reparsed pages and enrichment into the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.functions.amounts import magnitude_to_long
from stratalog.functions.dates import relative_date
from stratalog.operators.detail import detail_and_sections, detail_extract
from stratalog.schema import (
    CATALOG_SCHEMA, CONTENT_COLUMNS, ENRICHMENT_COLUMNS, ROLLUP_COLUMNS,
)

ACTION = "_action"


def conform(df: DataFrame, schema: T.StructType = CATALOG_SCHEMA, **columns: Column) -> DataFrame:
    """Rows in the shape of ``schema``: the given columns, the rest NULL."""
    return df.select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def new_keys(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listing rows whose key the catalog lacks. Of the catalog only the key is read."""
    return listing.join(catalog.select("item_key"), "item_key", "left_anti")


def known_keys(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    return listing.join(catalog.select("item_key"), "item_key", "left_semi")


def detail_attach(
    listing: DataFrame, catalog: DataFrame, pages: DataFrame, force: bool = False
) -> DataFrame:
    """Attach the page of every new key, or of every key with ``force``.

    ``has_detail`` says that a page was really fetched: a failed fetch (no row, NULL or empty html)
    must not wipe what the catalog already holds.

    Keys without a wanted page keep their own join key and are told apart by the join condition.
    Nulling the key instead would send all of them to one task.
    """
    page = pages.select("item_key", "html")
    if force:
        joined = listing.join(page, "item_key", "left")
    else:
        known = catalog.select("item_key", F.lit(True).alias("_known"))
        flagged = listing.join(known, "item_key", "left").withColumn(
            "_new", F.col("_known").isNull()
        )
        page = page.withColumnRenamed("item_key", "_page_key")
        joined = flagged.join(
            page, (F.col("item_key") == F.col("_page_key")) & F.col("_new"), "left"
        ).drop("_known", "_new", "_page_key")
    return joined.withColumn("has_detail", F.coalesce(F.length("html") > 0, F.lit(False)))


def typed_listing(records: DataFrame, as_of: Column) -> DataFrame:
    """Listing records with their figures parsed; other columns are passed through."""
    date, low = relative_date(F.col("updated_text"), as_of)
    return records.withColumns({
        "pulls": magnitude_to_long(F.col("pulls_text")),
        "tags": F.col("tags_count"),
        "last_updated": date,
        "last_updated_str": low,
    }).drop("pulls_text", "tags_count", "updated_text", "page_id", "pos")


def crawl_rows(attached: DataFrame, command_prefix: str, as_of: Column) -> DataFrame:
    """Typed crawl rows of records with their page attached: figures parsed, pages read."""
    return detail_extract(typed_listing(attached, as_of), command_prefix)


def attach_rollups(records: DataFrame, content: DataFrame) -> DataFrame:
    """Crawl rows from records and content that is already extracted: ``has_detail`` and roll-ups.

    Short columns only; the content itself is stored where it was extracted. Content may say by a
    ``has_detail`` of its own which rows are fresh; the others count for new keys alone.
    """
    fresh = F.col("has_detail") if "has_detail" in content.columns else F.lit(True)
    read = content.select("item_key", *ROLLUP_COLUMNS, fresh.alias("has_detail"))
    return records.join(read, "item_key", "left").withColumn(
        "has_detail", F.coalesce("has_detail", F.lit(False))
    )


def _upsert_columns(
    names: list[str], base_url: str, item_type: str, run_ts: Column
) -> list[Column]:
    """Per-column precedence between a stored row ``c`` and a crawled row ``n``."""
    key = F.coalesce("c.item_key", "n.item_key")
    fresh, crawled = F.col("c.item_key").isNull(), F.col("n.item_key").isNotNull()
    detail = fresh | F.coalesce(F.col("n.has_detail"), F.lit(False))

    # The right-hand sides for a key the crawl brings; a key it lacks keeps its row.
    brought = {
        "id": F.coalesce("c.id", F.sha2(key, 256)),
        "item_key": key,
        "item_name": F.when(fresh, F.col("n.item_name")).otherwise(F.col("c.item_name")),
        "item_type": F.when(fresh, F.lit(item_type)).otherwise(F.col("c.item_type")),
        "url": F.when(fresh, F.concat(F.lit(base_url.rstrip("/") + "/"), key))
        .otherwise(F.col("c.url")),
        "labels": F.when(F.size("n.labels") > 0, F.col("n.labels"))
        .otherwise(F.coalesce(F.col("c.labels"), F.array().cast("array<string>"))),
        "is_uncensored": F.coalesce("c.is_uncensored", "n.is_uncensored_hint"),
        "validation_retries": F.when(fresh, F.lit(0)).otherwise(F.col("c.validation_retries")),
        "timestamp": run_ts,
    }
    for name in ("pulls", "tags", "last_updated", "last_updated_str", "description",
                 "capability", "capabilities"):
        brought[name] = F.col(f"n.{name}")
    for name in CONTENT_COLUMNS + ROLLUP_COLUMNS:
        # Content columns are asked for only if the catalog has them.
        brought[name] = F.when(detail, F.col(f"n.{name}")).otherwise(F.col(f"c.{name}"))

    out = []
    for name in names:
        kept, value = F.col(f"c.{name}"), brought.get(name)
        merged = kept if value is None else F.when(crawled, value).otherwise(kept)
        out.append(merged.cast(CATALOG_SCHEMA[name].dataType).alias(name))
    action = F.when(fresh, "inserted").when(crawled, "updated").otherwise("kept")
    return [*out, action.alias(ACTION)]


def catalog_upsert(
    catalog: DataFrame,
    crawl: DataFrame,
    base_url: str,
    run_ts: Column,
    item_type: str = "official",
    small_crawl: bool = False,
) -> DataFrame:
    """Merge crawl rows (unique by key) into the catalog; adds ``_action``.

    New keys are inserted, known keys get fresh figures and, if their page was fetched, fresh
    detail; keys the crawl lacks are kept. A stored flag wins over the crawl's hint and an empty
    label list overwrites nothing. The catalog may lack columns, such as its content columns; the
    result has the columns it has.

    The general form is one full outer join, which shuffles the catalog by key. With
    ``small_crawl`` (a checked size, see ``joins.is_small``) the crawl is broadcast instead and the
    catalog stays where it is: matched rows come from a left join, inserts from the crawl rows
    whose key was not found, a set no larger than the crawl.
    """
    columns = _upsert_columns(catalog.columns, base_url, item_type, run_ts)
    c, n = catalog.alias("c"), crawl.alias("n")
    on = F.col("c.item_key") == F.col("n.item_key")
    if not small_crawl:
        return c.join(n, on, "full_outer").select(*columns)
    merged = c.join(F.broadcast(n), on, "left").select(*columns)
    keys = F.broadcast(crawl.select("item_key"))
    found = catalog.select("item_key").join(keys, "item_key", "left_semi")
    unseen = crawl.join(F.broadcast(found), "item_key", "left_anti").alias("n")
    # A stored side that is empty by definition: the optimizer turns this join into NULL columns.
    nothing = catalog.filter(F.lit(False)).alias("c")
    return merged.unionByName(unseen.join(nothing, on, "left").select(*columns))


def upsert_summary(merged: DataFrame) -> DataFrame:
    return merged.agg(*action_counts("inserted", "updated"))


def action_counts(*actions: str) -> list[Column]:
    """Counts over ``_action``; usable in ``agg`` and in ``observe``."""
    return [F.count_if(F.col(ACTION) == a).alias(a) for a in actions]


def reparse(catalog: DataFrame, pages: DataFrame, command_prefix: str) -> DataFrame:
    """Read the stored pages again and refresh what depends on them; adds ``_action``.

    Pages are read before the join, so the shuffle carries what they say and not the markup.
    """
    return merge_content(catalog, read_content(pages, command_prefix))


def read_content(pages: DataFrame, command_prefix: str) -> DataFrame:
    """Content and roll-ups of pages (item_key, html); pages without markup are left out."""
    return detail_extract(_with_markup(pages), command_prefix)


def read_whole(pages: DataFrame, command_prefix: str) -> DataFrame:
    """What ``read_content`` gives, and the sections the prompts need, in the same pass."""
    return detail_and_sections(_with_markup(pages), command_prefix)


def _with_markup(pages: DataFrame) -> DataFrame:
    return pages.select("item_key", "html").filter(F.coalesce(F.length("html"), F.lit(0)) > 0)


def merge_content(catalog: DataFrame, content: DataFrame) -> DataFrame:
    """Put content (unique by key) on the catalog.

    Content is replaced even by NULL, a roll-up only by a new value. Items without content are
    ``skipped``.
    """
    names = [c for c in CONTENT_COLUMNS if c in catalog.columns]
    fresh = content.select("item_key", *names, *ROLLUP_COLUMNS, F.lit(True).alias("_read"))
    c, p = catalog.alias("c"), fresh.alias("p")
    read = F.coalesce(F.col("p._read"), F.lit(False))
    out = []
    for name in catalog.columns:
        kept = F.col(f"c.{name}")
        if name in CONTENT_COLUMNS:
            kept = F.when(read, F.col(f"p.{name}")).otherwise(kept)
        elif name in ROLLUP_COLUMNS:
            kept = F.coalesce(F.col(f"p.{name}"), kept)
        out.append(kept.alias(name))
    action = F.when(read, "updated").otherwise("skipped").alias(ACTION)
    return c.join(p, F.col("c.item_key") == F.col("p.item_key"), "left").select(*out, action)


def reparse_summary(reparsed: DataFrame) -> DataFrame:
    return reparsed.agg(*action_counts("updated", "skipped"))


def enrichment_writeback(catalog: DataFrame, enrichment: DataFrame, version: int) -> DataFrame:
    """Put enrichment rows (unique by key) on the catalog.

    Stamps the version and clears both validation flags; the retry counter stays.
    """
    c, e = catalog.alias("c"), enrichment.select("item_key", *ENRICHMENT_COLUMNS).alias("e")
    hit = F.col("e.item_key").isNotNull()
    new = {name: F.col(f"e.{name}") for name in ENRICHMENT_COLUMNS}
    new["enrich_version"] = F.lit(version)
    new["validated"] = new["validation_failed"] = F.lit(None).cast("boolean")
    out = [
        (F.when(hit, new[n]).otherwise(F.col(f"c.{n}")) if n in new else F.col(f"c.{n}")).alias(n)
        for n in catalog.columns
    ]
    return c.join(e, F.col("c.item_key") == F.col("e.item_key"), "left").select(*out)
