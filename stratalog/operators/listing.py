"""Listing pages to one raw record per linked item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions.arrays import first_or_null, split_badges
from stratalog.functions.markup import read_page
from stratalog.functions.text import blank_to_null, key_from_href, keyword_flag, strip


def listing_anchors(
    pages: DataFrame, prefix: str, badge_class: str = "px-2", badge_class_part: str = "px-"
) -> DataFrame:
    """Every anchor under ``prefix`` with its page, position and content.

    Anchors that hold a colon after the prefix (variants of an item) or no key are dropped.
    """
    anchors = read_page(
        F.col("html"), ("anchors",),
        prefix=prefix, badge_class=badge_class, badge_class_part=badge_class_part,
    )["anchors"]
    return (
        pages.select("page_id", anchors.alias("a"))
        .select("page_id", F.inline("a"))
        .filter(~F.col("href").contains(":"))
        .withColumn("item_key", key_from_href(F.col("href"), prefix))
        .filter(F.col("item_key") != "")
    )


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of every key.

    An aggregate, not a window: each task reduces its rows per key before the shuffle, so a key
    that holds a third of the input costs one row per task.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    row = F.struct(*order_by, *rest)
    return df.groupBy(key).agg(F.min(row).alias("_row")).select(key, "_row.*")


def listing_records(
    anchors: DataFrame,
    capability_tags: Sequence[str] = fv.CAPABILITY_TAGS,
    keywords: Sequence[str] = fv.FLAG_KEYWORDS,
) -> DataFrame:
    """Raw listing records of anchors: name, description, counts as text, badges, flag hint."""
    text = F.col("text")
    capabilities, labels = split_badges(F.col("badges"), capability_tags)
    # How the three figures are written in an anchor.
    pulls = F.regexp_extract(text, r"(?iU)([\d.]+[MKB]?)\s+Pulls", 1)
    tags = F.regexp_extract(text, r"(?iU)(\d+)\s+Tags", 1)
    updated = F.regexp_extract(text, r"(?dU)Updated\s+(.+?)(?:\n|$)", 1)
    named = anchors.withColumn("item_name", F.coalesce("title", "item_key"))
    return named.select(
        "page_id", "pos", "item_key", "item_name", "description",
        pulls.alias("pulls_text"),
        F.coalesce(blank_to_null(tags).try_cast("int"), F.lit(0)).alias("tags_count"),
        strip(updated).alias("updated_text"),
        labels.alias("labels"),
        capabilities.alias("capabilities"),
        first_or_null(capabilities).alias("capability"),
        keyword_flag(F.col("item_key"), F.col("item_name"), F.col("description"), keywords)
        .alias("is_uncensored_hint"),
    )


def listing_extract(pages: DataFrame, prefix: str, **options) -> DataFrame:
    """Listing pages (page_id, html) to one raw record per key; the first occurrence wins."""
    anchor_options = {
        k: options.pop(k) for k in ("badge_class", "badge_class_part") if k in options
    }
    anchors = listing_anchors(pages, prefix, **anchor_options)
    return listing_records(first_per_key(anchors, "item_key", ["page_id", "pos"]), **options)
