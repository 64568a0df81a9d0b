"""Reading stored pages again where they, or the reader, have changed.

What a page says depends on its markup and on the reader alone, so it is kept under the digest of the one
and the version of the other: equal pages are read once and unchanged ones never again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.operators.catalog import merge_content, read_content
from stratalog.operators.joins import is_small, semi_by_key
from stratalog.schema import CATALOG_SCHEMA, CONTENT_COLUMNS, ROLLUP_COLUMNS
from stratalog.sources.snapshots import SnapshotStore

READ_ROWS, WANTED_ROWS = "readings", "readings-wanted"
_SAID = [*CONTENT_COLUMNS, *ROLLUP_COLUMNS]
READ_SCHEMA = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("reader", T.StringType()),
    *[CATALOG_SCHEMA[name] for name in _SAID]])
_WANTED_SCHEMA = T.StructType([T.StructField("item_key", T.StringType())])


def reparse_changed(catalog: DataFrame, pages: DataFrame, store: SnapshotStore, command_prefix: str,
                    reader: str = "1") -> DataFrame:
    """What ``catalog.reparse`` gives, with only those pages read that ``store`` has no reading of.

    ``pages`` (item_key, html) is unique by key; ``reader`` names the reader's version and settings, and a
    new name reads all pages once. Of equal pages the one with the smallest key is read. Digests are
    compared, not markup, and markup is filtered where it lies as long as few pages are new. NULL and
    empty pages are skipped, as ``reparse`` skips them.
    """
    reader = f"{reader}:{command_prefix}"
    held = pages.filter(F.length("html") > 0)
    digests = held.select("item_key", F.sha2("html", 256).alias("digest"))
    unread = digests.groupBy("digest").agg(F.min("item_key").alias("item_key")).join(
        readings(store, reader).select("digest"), "digest", "left_anti")
    store.write(WANTED_ROWS, unread.select("item_key"))
    wanted = store.read(WANTED_ROWS, _WANTED_SCHEMA)
    fresh = semi_by_key(held.select("item_key", "html"), wanted, "item_key", is_small(wanted))
    # The digest travels in the place of the key, so that the markup is read in this one pass.
    said = read_content(fresh.select(F.sha2("html", 256).alias("item_key"), "html"), command_prefix)
    store.write(READ_ROWS, said.select(
        F.col("item_key").alias("digest"), F.lit(reader).alias("reader"), *_SAID))
    content = digests.join(readings(store, reader), "digest").drop("digest", "reader")
    return merge_content(catalog, content)


def readings(store: SnapshotStore, reader: str) -> DataFrame:
    """The stored readings of a reader, one a digest: a digest that is known is not read again."""
    rows = store.read_all(READ_ROWS, READ_SCHEMA)
    return rows.filter(F.col("reader") == reader).drop("_version")
