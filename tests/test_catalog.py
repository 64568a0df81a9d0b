"""Upsert precedence, reparse, write-back, staleness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalog.operators import catalog as cat
from stratalog.operators.listing import first_per_key
from stratalog.operators.staleness import select_stale
from stratalog.schema import CATALOG_SCHEMA

NOW = dt.datetime(2024, 2, 1, 12, 0)
CRAWL = (
    "item_key string, item_name string, description string, capability string, "
    "capabilities array<string>, labels array<string>, is_uncensored_hint boolean, "
    "has_detail boolean, pulls bigint, tags int, last_updated date, last_updated_str string, "
    "readme string, applications array<struct<name:string,launch_command:string>>, "
    "memory_requirements array<struct<tag:string,size:string,size_gb:double,"
    "recommended_ram_gb:double,quantization:string,context:string,context_window:bigint>>, "
    "min_ram_gb double, context_window bigint, speed_tier string"
)


def crawl(spark, *rows):
    base = dict(
        item_name="New", description=None, capability=None, capabilities=[], labels=[],
        is_uncensored_hint=False, has_detail=False, pulls=5, tags=2, last_updated=None,
        last_updated_str="", readme=None, applications=None, memory_requirements=None,
        min_ram_gb=None, context_window=None, speed_tier=None,
    )
    names = [c.split(":")[0].split()[0] for c in
             "item_key item_name description capability capabilities labels is_uncensored_hint "
             "has_detail pulls tags last_updated last_updated_str readme applications "
             "memory_requirements min_ram_gb context_window speed_tier".split()]
    data = [tuple({**base, **r}[n] for n in names) for r in rows]
    return spark.createDataFrame(data, CRAWL)


def catalog(spark, *rows):
    data = [tuple(r.get(f.name) for f in CATALOG_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, CATALOG_SCHEMA)


STORED = dict(
    id="id-a", item_key="a", item_name="Old", item_type="kind", url="u", description="d",
    labels=["7b"], pulls=1, tags=1, readme="stored", min_ram_gb=4.1, speed_tier="medium",
    context_window=8, domain="Code", enrich_version=1, validated=True, validation_retries=2,
)


@pytest.fixture(params=[False, True], ids=["full", "small"])
def upsert(request, spark):
    def run(stored, crawled):
        merged = cat.catalog_upsert(
            stored, crawled, "https://e.org/lib/", F.lit(NOW), small_crawl=request.param
        )
        assert [f.name for f in CATALOG_SCHEMA] == merged.columns[:-1]
        return {r["item_key"]: r for r in merged.collect()}
    return run


def test_insert(spark, upsert):
    row = upsert(catalog(spark), crawl(spark, dict(
        item_key="n", labels=None, is_uncensored_hint=True, readme="r", has_detail=False
    )))["n"]
    assert row["_action"] == "inserted" and row["url"] == "https://e.org/lib/n"
    assert (row["item_type"], row["labels"], row["validation_retries"]) == ("official", [], 0)
    assert (row["readme"], row["is_uncensored"], row["enrich_version"]) == ("r", True, None)
    assert row["timestamp"] == NOW and len(row["id"]) == 64


def test_stats_only_keeps_detail_and_overwrites_with_null(spark, upsert):
    row = upsert(catalog(spark, STORED), crawl(spark, dict(item_key="a")))["a"]
    assert row["_action"] == "updated" and row["id"] == "id-a" and row["item_name"] == "Old"
    assert (row["readme"], row["min_ram_gb"], row["speed_tier"]) == ("stored", 4.1, "medium")
    assert (row["description"], row["pulls"], row["tags"]) == (None, 5, 2)
    assert row["labels"] == ["7b"] and row["is_uncensored"] is False
    assert (row["domain"], row["enrich_version"], row["validation_retries"]) == ("Code", 1, 2)


def test_detail_overwrites_even_with_null(spark, upsert):
    row = upsert(catalog(spark, {**STORED, "is_uncensored": True}), crawl(
        spark, dict(item_key="a", has_detail=True, labels=["9b"], min_ram_gb=1.0)
    ))["a"]
    assert (row["readme"], row["min_ram_gb"], row["context_window"]) == (None, 1.0, None)
    assert row["labels"] == ["9b"] and row["is_uncensored"] is True


def test_absent_keys_are_kept(spark, upsert):
    rows = upsert(catalog(spark, STORED), crawl(spark, dict(item_key="n")))
    assert rows["a"]["_action"] == "kept" and rows["a"]["timestamp"] is None
    assert set(rows) == {"a", "n"}


def test_upsert_is_idempotent(spark, upsert):
    crawled = crawl(spark, dict(item_key="a"), dict(item_key="n", has_detail=True, readme="x"))
    once = upsert(catalog(spark, STORED), crawled)
    again = upsert(catalog(spark, *[r.asDict(recursive=True) for r in once.values()]), crawled)
    strip = lambda rows: {k: r.asDict(recursive=True) | {"_action": 0} for k, r in rows.items()}
    assert strip(once) == strip(again)


def test_upsert_summary(spark):
    merged = cat.catalog_upsert(
        catalog(spark, STORED), crawl(spark, dict(item_key="a"), dict(item_key="n")), "u", F.lit(NOW)
    )
    assert cat.upsert_summary(merged).first().asDict() == {"inserted": 1, "updated": 1}


def test_failed_fetch_wipes_nothing(spark, upsert):
    listing = spark.createDataFrame([("a",), ("n",), ("m",)], "item_key string")
    pages = spark.createDataFrame([("a", None), ("n", "<p/>")], "item_key string, html string")
    got = cat.detail_attach(listing, catalog(spark, STORED), pages, force=True)
    assert {r["item_key"]: r["has_detail"] for r in got.collect()} == {
        "a": False, "n": True, "m": False
    }


def test_detail_attach_takes_new_keys_only(spark):
    listing = spark.createDataFrame([("a",), ("n",)], "item_key string")
    pages = spark.createDataFrame([("a", "<a/>"), ("n", "<p/>")], "item_key string, html string")
    got = cat.detail_attach(listing, catalog(spark, STORED), pages)
    assert {r["item_key"]: r["html"] for r in got.collect()} == {"a": None, "n": "<p/>"}


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS k", "30000 - id AS o", "id"
    )
    rows = {r["k"]: r["id"] for r in first_per_key(df, "k", ["o"]).collect()}
    assert rows["hot"] == 29997 and len(rows) == 8


def test_reparse_keeps_rollup_without_specs(spark):
    stored = catalog(spark, STORED, {**STORED, "item_key": "b"}, {**STORED, "item_key": "c"},
                     {**STORED, "item_key": "d"})
    pages = spark.createDataFrame([
        ("a", "<p>no rows</p>"), ("b", ""), ("c", '<p id="readme">x 1 GB 8K</p>')
    ], "item_key string, html string")
    merged = cat.reparse(stored, pages, "run")
    rows = {r["item_key"]: r for r in merged.collect()}
    a, b, c, d = (rows[k] for k in "abcd")
    assert (a["readme"], a["memory_requirements"], a["min_ram_gb"]) == (None, None, 4.1)
    assert (b["readme"], b["_action"]) == ("stored", "skipped") == (d["readme"], d["_action"])
    assert (c["readme"], c["min_ram_gb"], c["speed_tier"], c["context_window"]) == (
        "x 1 GB 8K", 1.0, "fast", 8000
    )
    assert cat.reparse_summary(merged).first().asDict() == {"updated": 2, "skipped": 2}


def test_writeback(spark):
    stored = catalog(spark, {**STORED, "validation_failed": False}, {**STORED, "item_key": "b"})
    new = catalog(spark, dict(item_key="a", domain="Math"), dict(item_key="z", domain="Law"))
    rows = {r["item_key"]: r for r in cat.enrichment_writeback(stored, new, 4).collect()}
    assert set(rows) == {"a", "b"}
    a, b = rows["a"], rows["b"]
    assert (a["domain"], a["enrich_version"], a["validated"], a["validation_failed"]) == (
        "Math", 4, None, None
    )
    assert a["validation_retries"] == 2 and a["readme"] == "stored"
    assert (b["domain"], b["enrich_version"], b["validated"]) == ("Code", 1, True)


@pytest.mark.parametrize("rows,version,force,single,expected", [
    ([("a", None), ("b", 1)], 1, False, None, ["a"]),
    ([("a", None), ("b", 1)], 1, True, None, ["a", "b"]),
    ([("a", None), ("b", None)], 1, False, "b", ["b"]),
    ([], 1, False, None, []),
    ([("a", 0)], 1, False, None, ["a"]),
    ([("a", 1)], 1, False, "a", ["a"]),
])
def test_select_stale(spark, rows, version, force, single, expected):
    df = spark.createDataFrame(rows, "item_key string, enrich_version int")
    got = select_stale(df, version, force, single).orderBy("item_key").collect()
    assert [r["item_key"] for r in got] == expected


def test_stale_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "c")
    catalog(spark, STORED).write.parquet(path)
    select_stale(spark.read.parquet(path), 2).select("item_key").explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [Or(IsNull(enrich_version),LessThan(enrich_version,2))]" in plan
    assert "ReadSchema: struct<item_key:string,enrich_version:int>" in plan
