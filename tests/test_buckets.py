"""Upserts into a catalog kept in buckets."""

import glob
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.operators.catalog import ACTION, catalog_upsert, conform
from stratalog.plans.bucketed import upsert_bucketed
from stratalog.schema import CATALOG_SCHEMA
from stratalog.sources.buckets import BucketedTables
from tests.test_history import CRAWL_DDL
from tests.test_plans import plan

WITH_ACTION = T.StructType([*CATALOG_SCHEMA.fields, T.StructField(ACTION, T.StringType())])


@pytest.fixture
def tables(spark, tmp_path):
    return BucketedTables(spark, str(tmp_path), buckets=4)


def stamp():
    return F.lit("2024-02-01").cast("timestamp")


def fresh(name):
    return f"{name}_{uuid.uuid4().hex}"


def crawl(spark, keys):
    rows = [(key, "new", "d", "Tools", ["Tools"], ["l"], None, i % 2 == 0, i, 1, None, "now", f"r{i}",
             None, None, 2.5, None, None) for i, key in enumerate(keys)]
    return spark.createDataFrame(rows, CRAWL_DDL)


def state(spark, n):
    return conform(spark.range(n), item_key=F.concat(F.lit("k"), "id"), item_name=F.lit("old"),
                   readme=F.lit("old"), validation_retries=F.lit(1))


def rows(df):
    return sorted(repr(r.asDict(recursive=True)) for r in df.collect())


def test_upserts_equal_those_of_the_plain_join(spark, tables):
    want, got = state(spark, 60), tables.write(fresh("state"), state(spark, 60))
    for keys in ([f"k{i}" for i in range(40, 80)], [f"k{i}" for i in range(0, 90, 7)], []):
        given = crawl(spark, keys)
        want = spark.createDataFrame(
            catalog_upsert(want.drop(ACTION), given, "https://x", stamp()).collect(),
            WITH_ACTION)
        got = upsert_bucketed(tables, got, given, fresh("merged"), "https://x", stamp())
        assert rows(got) == rows(want)


def test_empty_sides(spark, tables):
    nothing = tables.write(fresh("state"), state(spark, 0))
    merged = upsert_bucketed(tables, nothing, crawl(spark, ["a"]), fresh("merged"), "https://x", stamp())
    assert [r[ACTION] for r in merged.collect()] == ["inserted"]
    merged = upsert_bucketed(tables, nothing, crawl(spark, []), fresh("merged"), "https://x", stamp())
    assert merged.collect() == []


def test_no_side_is_exchanged_and_a_bucket_is_one_file(spark, tables):
    name = fresh("merged")
    stored = tables.write(fresh("state"), state(spark, 500))
    crawled = tables.write(fresh("crawl"), crawl(spark, [f"k{i}" for i in range(400, 700)]))
    joined = catalog_upsert(stored, crawled, "https://x", stamp())
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    merged = upsert_bucketed(tables, stored, crawl(spark, [f"k{i}" for i in range(400, 700)]), name,
                             "https://x", stamp())
    again = merged.drop(ACTION).alias("c").join(crawled.alias("n"), "item_key", "full_outer")
    assert "Exchange" not in plan(again)
    files = glob.glob(os.path.join(tables.root, name, "*.parquet"))
    buckets = {re.search(r"_(\d{5})\.c\d+", path).group(1) for path in files}
    assert len(files) == len(buckets) == 4


def test_another_session_attaches_the_table(spark, tables):
    name = fresh("state")
    written = tables.write(name, state(spark, 50))
    schema, want = written.schema, rows(written)
    other = BucketedTables(spark.newSession(), tables.root, tables.buckets)
    spark.sql(f"DROP TABLE {name}")  # the files of a table with a path of its own stay
    attached = other.attach(name, schema)
    assert rows(attached) == want
    assert "Exchange" not in plan(attached.groupBy("item_key").count())


def test_a_table_is_written_once(spark, tables):
    name = fresh("state")
    tables.write(name, state(spark, 3))
    with pytest.raises(Exception, match="already exists"):
        tables.write(name, state(spark, 4))
    with pytest.raises(ValueError):
        tables.write("../x", state(spark, 4))
