"""Take landed page snapshots into the catalog as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from stratalog.plans.refresh import CATALOG, Refresh
from stratalog.sources.pages import PAGES_DDL, detail_pages, listing_pages


def intake(
    spark: SparkSession,
    landing: str,
    refresh: Callable[[], Refresh],
    listing_url: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> DataStreamWriter:
    """Stream over new files in ``landing``; each batch is one crawl. Start it with ``.start()``.

    Every batch tags the snapshots it writes. A batch that is replayed after a failure finds its
    tag and does nothing, so each page is taken exactly once. A page may land before or after its
    listing: the catalog is the same for every ``files_per_batch``.
    """
    pages = (
        spark.readStream.schema(PAGES_DDL)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )

    def take(batch: DataFrame, batch_id: int) -> None:
        run, tag = refresh(), f"{checkpoint}#{batch_id}"
        if run.store.has_tag(CATALOG, tag):
            return
        prefix = listing_url.rstrip("/") + "/"
        run.crawl(listing_pages(batch, listing_url), detail_pages(batch, prefix), tag)

    return (
        pages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
