"""Archive, URL rules and neighbours."""

import base64
import hashlib

import numpy as np
import pytest

from stratalog.llm import neighbours
from stratalog.llm.common import new_folder
from stratalog.llm.url_filters import judge_urls, rule_table
from stratalog.llm.warc import export_warc, parsed, read_archive, write_archive

PAGES = [(1, "http://a.com/x", "<p>ü</p>"), (2, "http://b.com", "<p>ü</p>"), (3, None, None),
         (4, "u", ""), (5, "v\r\nw", "x\r\n\r\ny"), (5, "v\r\nw", "x\r\n\r\ny"), (None, "n", "<p>ü</p>")]
DDL = "page_id bigint, url string, html string"


def test_archive_round_trip(spark):
    path = new_folder(spark, "archive")
    write_archive(spark.createDataFrame([(*p, "clash") for p in PAGES], DDL + ", sha256 string"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    records = read_archive(spark, path)
    html = {p[0]: p[2] or "" for p in PAGES}
    assert {(r.page_id, r.payload.decode()) for r in records.collect()} == set(html.items())
    rows = parsed(records).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        data = html[r.page_id].encode()
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert kinds == {(1, "response", None), (2, "revisit", 1), (None, "revisit", 1),
                     (3, "response", None), (4, "revisit", 3), (5, "response", None)}
    files = new_folder(spark, "warc")
    export_warc(records, files)
    whole = "".join(r.value for r in spark.read.text(files, wholetext=True).collect())
    assert whole.count("WARC/1.1\r\n") == len(PAGES) and whole.endswith("\r\n\r\n")
    write_archive(spark.createDataFrame([], DDL), empty := new_folder(spark, "archive"))
    assert parsed(read_archive(spark, empty)).collect() == []


def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es/", "allow")]
    cases = {
        "http://Example.com/en/a?q": ("example.com", "/en/a", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://x.www.example.com/en/#t": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "ftp://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://É.com/": ("É.com", "/", "com/", "allow"), "://net/es/": ("net", "/es/", "net/es/", "block"),
    }
    pages = spark.createDataFrame([(i, url, "clash") for i, url in enumerate(cases)] * 2,
                                  "page_id bigint, url string, host string")
    rows = judge_urls(pages, rule_table(spark, rules)).collect()
    assert len(rows) == 2 * len(cases)
    want = dict(enumerate(cases.values()))
    assert all((r.host, r.path, r.rule, r.verdict) == want[r.page_id] for r in rows)
    none = judge_urls(pages, rule_table(spark, rules).limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == 2 * len(cases)
    assert judge_urls(pages.limit(0), rule_table(spark, rules)).collect() == []


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours_reach_recall(spark, scale):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((1200, 32))
    v[600:700] = v[0] + rng.normal(0, .01, (100, 32))
    if scale:
        v *= rng.uniform(.2, 3, (1200, 1))
    rows = [(i, [float(x) for x in u], 1.0) for i, u in enumerate(v)]
    bad = [(2000, None, 1.0), (2001, [0.0] * 32, 1.0), (2002, [None] * 32, 1.0),
           (2003, [float("nan")] * 32, 1.0), (2004, [float("inf")] * 32, 1.0), (2005, [], 1.0)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, score double")
    found = neighbours.nearest(frame, 40, neighbours.Search(block=512, query_block=16)).collect()
    assert {r.query_id for r in found} == set(range(0, 1200, 40))
    hit = 0
    for q in range(0, 1200, 40):
        scores = v @ v[q]
        best = [i for i in np.lexsort((np.arange(1200), -scores)) if i != q][:20]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in own)
        hit += len({r.vec_id for r in own} & set(best))
    assert hit >= .9 * 20 * 30


def test_neighbours_of_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (1, [1.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted(neighbours.nearest(frame).collect(), key=lambda r: r.rank)
    assert [r.vec_id for r in found] == [1, 3, 3, None] and {r.score for r in found} == {1.0}
    assert neighbours.nearest(frame.limit(0)).collect() == []
