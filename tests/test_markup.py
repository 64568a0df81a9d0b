"""The fast reading of a page against the lenient one."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalog.functions import markup as m

PIECES = [
    "<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "</br>", "<div class='a b'>", "</div>", "<DIV ID=x>",
    "<a href=\"/x?a=1&amp;b=2\" class=px-2 disabled>", "</a>", "<img src='y'/>", "<h2>", "</h2 >",
    "<script>if (a < b) '</p>'</script>", "<style>p{}</style>", "<!-- c - d -->", "<!DOCTYPE html>",
    "<custom-tag x:y=\"1\" @z='2'>", "</custom-tag>", "<pre>  ", "</pre>", "<template>t", "</template>",
    "text", " ", "\n", "  \n ", "&amp;", "&copy;", "&copy ", "&unknown;", "&#65;", "&#150;", "& ",
    "AT&T ", "ä·ß", "<p/>", "<span\nid=\"q\" id=\"r\">", "</span>", "5 > 4",
    "<script src=\"x\"></script>", "<p title=\"a>b\">", "<p title=\"\">",
]
ODD = ["<", "<3", "<!", "<!-- -- -->", "<![CDATA[x]]>", "&", "&#", "&#x41;", "</", "<a b=c/d>", "<a  =x>",
       "<?pi?>", "</p x>", "<script>", "<!-->", "<a'b>", "&am", "<p a=\"1\"b=\"2\">", "<a / b>", "&#65"]


def flat(page):
    nodes = [(n.name, n.attrs, n.parent, n.first, n.last, n.end, n.contents,
              n.only if not isinstance(n.only, m._Node) else n.only.name) for n in page.nodes]
    return nodes, page.texts, page.owners


def compare(text):
    fast = m._Page(m._feed_plain, text)
    if fast.complete:
        assert flat(fast) == flat(m._Page(m._feed_lenient, text)), text
    return fast.complete


@pytest.mark.parametrize("seed", range(5))
def test_plain_markup_reads_the_same(seed):
    rng = random.Random(seed)
    taken = sum(
        compare("".join(rng.choices(PIECES, k=rng.randint(1, 25)))) for _ in range(2000)
    )
    assert taken > 1500


@pytest.mark.parametrize("seed", range(5))
def test_odd_markup_reads_the_same_or_is_left(seed):
    rng = random.Random(100 + seed)
    for _ in range(3000):
        text = "".join(rng.choices(PIECES + ODD, k=rng.randint(1, 12)))
        try:
            compare(text)
        except (AssertionError, ValueError) as problem:
            if not isinstance(problem, AssertionError) or text in str(problem):
                raise


@pytest.mark.parametrize("seed", range(3))
def test_character_noise(seed):
    rng = random.Random(200 + seed)
    for _ in range(5000):
        compare("".join(rng.choices("<>/&;#!-=\"' \nabpx1", k=rng.randint(1, 14))))


def test_real_pages_take_the_fast_way(sf_dir):
    pages = pq.read_table(f"{sf_dir}/pages.parquet", columns=["html"])["html"].to_pylist()
    assert all(compare(p) for p in pages)


def test_pages_are_read_in_parts_of_bounded_size(spark, monkeypatch):
    """What is read goes on a part at a time, however many pages a batch has; none is lost or moved."""
    lengths = [0, 10, 3, 0, 50, 7, 7, 7, 1, 0]
    batch = pa.array([None if n == 0 else "x" * n for n in lengths])
    monkeypatch.setattr(m, "BYTES_AT_ONCE", 14)
    parts = list(m._bounded(batch))
    assert pa.concat_arrays(parts).equals(batch)
    assert len(parts) > 3 and all(len(p) == 1 or sum(len(v or "") for v in p.to_pylist()) < 28
                                  for p in parts)
    assert [len(p) for p in m._bounded(batch[:0])] == [0]
    pages = spark.range(3000).selectExpr(
        "id", "if(id % 7 = 0, null, concat('<p>', repeat('x', 2000), id, '</p>')) AS html").coalesce(1)
    read = m.read_page(F.col("html"), ("detail",), readme_id="readme", applications_title="A")
    rows = pages.select("id", "html", read["detail"]["page_text"].alias("text")).collect()
    assert len(rows) == 3000
    assert all(r.text == (r.html and "x" * 2000 + str(r.id)) for r in rows)
