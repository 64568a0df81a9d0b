"""Pages read again: the rows of a whole reparse, and only new pages through the reader."""

from pyspark.sql import functions as F

from stratalog.operators import rereading
from stratalog.operators.catalog import conform, reparse
from stratalog.operators.rereading import READ_ROWS, READ_SCHEMA, reparse_changed
from stratalog.schema import PAGE_ARCHIVE_SCHEMA
from stratalog.sources.snapshots import SnapshotStore


def page(text):
    return f"<div id='readme'><p>{text}</p></div><p>run:7b 4 GB 8K</p>"


def test_unchanged_and_equal_pages_are_not_read(spark, tmp_path, monkeypatch):
    store = SnapshotStore(spark, str(tmp_path))
    keys = spark.createDataFrame([(k,) for k in "abcdefg"], "k string")
    catalog = conform(keys, item_key=F.col("k"), readme=F.lit("old"))

    def run(rows, **options):
        pages = spark.createDataFrame(rows, PAGE_ARCHIVE_SCHEMA)
        got = reparse_changed(catalog, pages, store, "run", **options)
        whole = reparse(catalog, pages, "run")
        assert got.columns == whole.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))
        return store.read_all(READ_ROWS, READ_SCHEMA).count()

    first = [("a", page("x")), ("b", page("x")), ("c", page("y")), ("d", None), ("e", ""), ("z", page("q"))]
    assert run([]) == 0
    assert run(first) == 3
    assert run(first) == 3
    # From here on as if too many pages were new to broadcast their keys.
    monkeypatch.setattr(rereading, "is_small", lambda keys: False)
    # One changed, one with another's markup, one new.
    assert run([("a", page("y")), ("b", page("x2")), ("c", page("y")), ("f", page("x2" * 9000))]) == 5
    # Another reader reads all, once.
    assert run(first, reader="2") == 8
    assert run(first, reader="2") == 8
