"""Page snapshots landed by a fetcher: (page_id, url, html), NULL html for a failed fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.functions.text import key_from_href
from stratalog.sources.snapshots import latest_rows

PAGES_DDL = "page_id bigint, url string, html string"


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan over at least as many tasks as the cluster runs at a time.

    Reading pages is work for the processor, so a few files must not become a few tasks. An input
    with enough files or splits, which is every large one, is left alone and not shuffled.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= slots else scan.repartition(slots)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(PAGES_DDL).parquet(path))


def detail_pages(pages: DataFrame, url_prefix: str) -> DataFrame:
    """(item_key, html) of the pages under ``url_prefix``, the highest page_id winning per key.

    A failed fetch (NULL html) never wins over a page that was read. A query, a fragment or a slash
    at the end of an address is no part of the key.
    """
    read = pages.filter(F.col("url").startswith(url_prefix) & F.col("html").isNotNull())
    keyed = read.select(
        key_from_href(_bare(F.col("url")), url_prefix).alias("item_key"), "html",
        F.col("page_id").alias("_version"),
    )
    listing = _bare(F.lit(url_prefix))
    return latest_rows(keyed.filter((F.col("item_key") != "") & (F.col("item_key") != listing)))


def listing_pages(pages: DataFrame, listing_url: str) -> DataFrame:
    """Pages whose address is the listing itself, with or without a query."""
    return pages.filter(_bare(F.col("url")) == listing_url.rstrip("/")).select("page_id", "html")


def _bare(url: Column) -> Column:
    """An address without query, fragment and slashes at its end."""
    return F.regexp_replace(url, r"(?s)/*([?#].*)?\z", "")


