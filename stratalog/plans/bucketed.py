"""Upserts into a catalog that is kept in buckets of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from stratalog.operators.catalog import ACTION, catalog_upsert
from stratalog.sources.buckets import BucketedTables


def upsert_bucketed(
    tables: BucketedTables, catalog: DataFrame, crawl: DataFrame, into: str, base_url: str,
    run_ts: Column, item_type: str = "official",
) -> DataFrame:
    """``catalog_upsert`` of ``crawl`` into ``catalog``, a table of ``tables``; the new table ``into``.

    The crawl is written into the same buckets, which shuffles the crawl alone. The join then goes bucket
    by bucket, and its rows are written where they are: the catalog is neither shuffled to be read nor to be
    written. The result has ``_action`` and is what the next upsert takes as its catalog.
    """
    crawled = tables.write(f"{into}_crawl", crawl)
    stored = catalog.drop(ACTION)
    return tables.write(into, catalog_upsert(stored, crawled, base_url, run_ts, item_type), dealt=True)
