"""What must hold of the physical plans whatever the size of the data."""

import re

from pyspark.sql import functions as F

from __spark_entry__ import queries
from stratalog.operators import catalog as cat
from stratalog.operators.detail import detail_extract, html_sections
from stratalog.operators.listing import listing_extract
from stratalog.operators.prompts import build_prompts
from stratalog.operators.quality import validation_transition
from stratalog.operators.responses import merge_answers
from stratalog.schema import CATALOG_SCHEMA, PAGE_ARCHIVE_SCHEMA, RESPONSES_SCHEMA
from stratalog.sources import snapshots
from stratalog.sources.snapshots import SnapshotStore, latest_rows
from tests.test_catalog import CRAWL

QUERIES = queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, schema, name="t"):
    """An empty table on disk: plans over it show real scans."""
    path = str(tmp_path / name)
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_row_wise_stages_do_not_shuffle(spark, tmp_path):
    catalog = stored(spark, tmp_path, CATALOG_SCHEMA, "c")
    pages = stored(spark, tmp_path, PAGE_ARCHIVE_SCHEMA, "p")
    responses = stored(spark, tmp_path, RESPONSES_SCHEMA, "r")
    sections = html_sections(pages).withColumns({
        c: F.lit(None).cast("string") for c in ("description", "readme")
    }).withColumn("labels", F.array(F.lit("x")))
    for df in (validation_transition(catalog), detail_extract(pages, "run"),
               build_prompts(sections), merge_answers(responses)):
        assert "Exchange" not in plan(df)


def test_a_page_is_read_by_one_python_pass(spark, tmp_path):
    """Markup is parsed once; the choice among its specification rows is a step of its own, made once."""
    pages = stored(spark, tmp_path, PAGE_ARCHIVE_SCHEMA)
    assert plan(html_sections(pages)).count("ArrowEvalPython") == 1
    for df in (detail_extract(pages, "run"),
               detail_extract(pages, "run").filter("readme IS NOT NULL AND min_ram_gb > 1")):
        steps = re.findall(r"ArrowEvalPython \[([^\]]*)\]", plan(df))
        assert sorted("html" in step for step in steps) == [False, True], steps


def test_listing_reduces_before_the_shuffle(spark, tmp_path):
    pages = stored(spark, tmp_path, "page_id bigint, url string, html string")
    text = plan(listing_extract(pages, "/"))
    assert text.count("Exchange") == 1 and "Window" not in text
    # Read bottom-up: partial aggregate, exchange, final aggregate.
    below = text[text.index("Exchange hashpartitioning"):]
    assert "partial_min" in below
    assert re.search(r"FileScan parquet \[page_id#\d+L,html#\d+\]", text)


def test_small_crawl_leaves_the_catalog_in_place(spark, tmp_path):
    catalog = stored(spark, tmp_path, CATALOG_SCHEMA, "c")
    crawl = stored(spark, tmp_path, CRAWL, "n")
    small = plan(cat.catalog_upsert(catalog, crawl, "u", F.now(), small_crawl=True))
    assert "hashpartitioning" not in small and "SortMergeJoin" not in small
    full = plan(cat.catalog_upsert(catalog, crawl, "u", F.now()))
    assert full.count("hashpartitioning") == 2 and "FullOuter" in full


def test_unwanted_details_do_not_share_a_null_key(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog = stored(spark, tmp_path, CATALOG_SCHEMA, "c")
        listing = stored(spark, tmp_path, "item_key string, x int", "l")
        pages = stored(spark, tmp_path, PAGE_ARCHIVE_SCHEMA, "p")
        text = plan(cat.detail_attach(listing, catalog, pages))
        assert re.search(r"SortMergeJoin \[item_key#\d+\], \[_page_key#\d+\], LeftOuter, _new", text)
        # The listing is shuffled once for both joins.
        assert text.count("hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def versions(spark, tmp_path, n, keys):
    store = SnapshotStore(spark, str(tmp_path))
    for version in range(n):
        store.write("pages", spark.createDataFrame(
            [(k, f"{k}{version}") for k in keys(version)], PAGE_ARCHIVE_SCHEMA))
    return store.read_all("pages", PAGE_ARCHIVE_SCHEMA)


def newest(df):
    return sorted((r["item_key"], r["html"]) for r in df.collect())


def test_markup_is_not_shuffled_unless_much_is_outdated(spark, tmp_path, monkeypatch):
    fresh = latest_rows(versions(spark, tmp_path / "a", 2, lambda v: [f"k{v}"]))
    assert "Join" not in plan(fresh) and newest(fresh) == [("k0", "k00"), ("k1", "k11")]
    rows = versions(spark, tmp_path / "b", 3, lambda v: ["hot", f"k{v}"])
    few = latest_rows(rows)
    text, expected = plan(few), [("hot", "hot2"), ("k0", "k00"), ("k1", "k11"), ("k2", "k22")]
    assert "LeftAnti" in text and "SortMergeJoin" not in text and newest(few) == expected
    monkeypatch.setattr(snapshots, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = latest_rows(rows)
        text = plan(many)
        # Both sides are spread over key and version, not over the key alone.
        assert len(re.findall(r"hashpartitioning\(item_key#\d+, _version#\d+", text)) == 2
        assert "LeftSemi" in text and newest(many) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_comparison_ships_keys_and_digests_only(spark, sf_dir):
    text = plan(QUERIES["snapshot_diff"](spark, sf_dir))
    assert "Join" not in text and "partial_sum" in text
    gate = plan(QUERIES["no_change_gate"](spark, sf_dir))
    assert "Join" not in gate and "HashAggregate(keys=[d#" in gate


def test_no_query_uses_a_cross_join(spark, sf_dir):
    for name in ("vocab_table", "new_keys", "known_keys", "detail_attach", "catalog_upsert",
                 "writeback", "reparse", "listing_records"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
