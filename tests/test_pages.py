"""Reading pages: listing, detail, sections."""

import pyarrow as pa
from pyspark.sql import functions as F

from stratalog.operators.detail import detail_extract, html_sections, page_text
from stratalog.operators.listing import listing_extract
from stratalog.sources.pages import detail_pages, listing_pages


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id bigint, html string")


def detail(spark, html, prefix="run"):
    return detail_extract(pages(spark, html), prefix).first()


def page(readme="", rows=""):
    return (f'<html><body><section id="readme">{readme}</section>'
            f'<div class="info">{rows}</div></body></html>')


def test_readme_node(spark):
    row = detail(spark, page("This is a really <b>useful</b> item."))
    assert row["readme"] == "This is a really \nuseful\n item."


def test_readme_missing_and_capped(spark):
    row = detail(spark, "<html><body></body></html>")
    assert row["readme"] is None and row["memory_requirements"] is None
    assert row["applications"] is None
    assert len(detail(spark, page("a" * 20000))["readme"]) == 10000


def test_readme_from_section_and_from_text(spark):
    assert detail(spark, "<section>My Readme here</section>")["readme"] == "My Readme here"
    html = "<p>readme</p><p>first</p><p>second</p><p>Tags</p><p>x</p>"
    assert detail(spark, html)["readme"] == "first\nsecond"
    assert detail(spark, "<p>Readme</p>all to the end\n")["readme"] == "all to the end"


def test_detail_rollup(spark):
    html = page("Helpful", "<p>7b 4.1 GB · 4096 context</p><p>13b 7.9 GB · 128K context</p>")
    row = detail(spark, html)
    assert [r["tag"] for r in row["memory_requirements"]] == ["7b", "13b"]
    assert (row["min_ram_gb"], row["context_window"], row["speed_tier"]) == (4.1, 128000, "medium")


def test_applications(spark):
    html = ("<section><h2> Applications </h2><div>Tool <i>One</i></div><code>run one</code>"
            "<p>Two</p><p>Three</p><code>run three</code><code>run four</code></section>"
            "<div><h2>Applications</h2><p>Five</p><p>run five</p></div>"
            "<h2>Applications</h2><p>run six</p>")
    row = detail(spark, html)
    assert [tuple(a) for a in row["applications"]] == [
        ("One", "run one"), ("Three", "run three"), ("Five", "run five")
    ]


def test_null_empty_and_odd_pages(spark):
    rows = detail_extract(pages(
        spark, None, "", "<![foo", "plain &amp; text", "<p>a<p>b</i>c</p>d<br/>e<div/>f"
    ), "run").collect()
    assert [r["readme"] for r in rows] == [None] * 5
    texts = page_text(pages(
        spark, None, "plain &amp; text &unknown; &#65;", "<p>a<p>b</i>c</p>d<br/>e<div/>f",
        "x<!-- c -->y<script>no</script> \n <style>no</style><pre>  </pre><![CDATA[z]]>",
    ))
    assert [r["page_text"] for r in texts.orderBy("page_id").collect()] == [
        None, "plain & text &unknown A", "a\nb\nc\nd\ne\nf", "x\ny\n\n\n  \nz"
    ]


def sections(spark, html):
    return html_sections(pages(spark, html)).first()


def test_main_content_fallbacks(spark):
    tail = "<article> the  article </article><main>main</main>"
    assert sections(spark, '<b id="x-ReadMe">by id</b><p class="a content">c</p>')[
        "main_content"] == "by id"
    assert sections(spark, '<p class="a page-content">by class</p>' + tail)[
        "main_content"] == "by class"
    assert sections(spark, tail)["main_content"] == "the article"
    assert sections(spark, "<main>main</main>")["main_content"] == "main"
    assert sections(spark, "<p>none</p>")["main_content"] is None
    assert len(sections(spark, "<main>" + "ab " * 2000 + "</main>")["main_content"]) == 2500


def test_section_lists(spark):
    row = sections(spark, (
        "<h3>Other applications</h3>stray<p>one</p><script>s()</script><ul><li>two</li><li>3</li></ul>"
        "<h2>End</h2><p>no</p><a href='https://huggingface.co/hidden'>MIT</a>"
    ))
    assert row["applications_raw"] == ["one", "s()", "two3"]
    assert row["hf_links"] is None and row["license_mentions"] == ["MIT"]
    assert row["benchmark_mentions"] is None and row["context_mentions"] is None


LISTING = """
<a href="/library/alpha"><h2> Alpha </h2><p>First <b>item</b></p><span class="px-2">Tools</span>
 <span class="px-2 y">8B</span><span class="px-3">no</span><i>12.5M</i> Pulls <i>3</i> Tags Updated 2 weeks ago
 end</a>
<a href="/library/alpha:latest"><h2>Variant</h2></a>
<a href="/library/alpha"><h2>Again</h2></a>
<a href="/library/">none</a><a href="/other/x">x</a>
<a href="/library/beta-uncensored"><span class="px-4">Vision</span><span>x</span>1,200 Pulls</a>
"""


def test_listing(spark):
    rows = {r["item_key"]: r for r in listing_extract(pages(
        spark, LISTING, '<a href="/library/beta-uncensored"><h2>Later</h2></a>'
    ), "/library/").collect()}
    assert set(rows) == {"alpha", "beta-uncensored"}
    a, b = rows["alpha"], rows["beta-uncensored"]
    assert (a["item_name"], a["description"]) == ("Alpha", "Firstitem")
    assert (a["pulls_text"], a["tags_count"], a["updated_text"]) == ("12.5M", 3, "2 weeks ago")
    assert (a["capabilities"], a["labels"], a["capability"]) == (["Tools"], ["8b"], "Tools")
    assert a["is_uncensored_hint"] is False
    assert (b["item_name"], b["description"], b["pulls_text"]) == ("beta-uncensored", None, "200")
    assert (b["tags_count"], b["updated_text"], b["capability"]) == (0, "", "Vision")
    assert b["is_uncensored_hint"] is True


def test_page_sources(spark):
    df = spark.createDataFrame([
        (1, "https://e.org/lib?sort=new", "l"), (2, "https://e.org/lib/a", "old"),
        (3, "https://e.org/lib/a", None), (4, "https://e.org/lib/b", "b"),
        (5, "https://e.org/x", "x"), (4, "https://e.org/lib/b", "b"), (6, "https://e.org/lib/c", None),
    ], "page_id bigint, url string, html string")
    assert [r["page_id"] for r in listing_pages(df, "https://e.org/lib").collect()] == [1]
    got = detail_pages(df, "https://e.org/lib/").orderBy("item_key").collect()
    # A failed fetch doesn't win over a page, and a page landed twice is one.
    assert [tuple(r) for r in got] == [("a", "old"), ("b", "b")]


def test_arrow_batches_are_bounded_by_bytes(spark):
    """Rows alone bound no memory: a thousand rows of 40 kB are a batch of 40 MB."""
    from stratalog import session

    session.ship(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    rows = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("x"), 40_000).alias("t"))
    found = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 40e6 and max(found) < 1.1 * session.BATCH_BYTES
