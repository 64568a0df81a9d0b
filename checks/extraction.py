"""Page and text extraction over ``pages``, ``documents``, ``part``, ``events``, ``lineitem``.

Inputs that the tables lack (badges, specification rows, ages) are written by one SQL expression
that both engines evaluate over every row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from checks.registry import check, table, text_table
from stratalog.functions import mentions
from stratalog.functions.amounts import magnitude_to_long
from stratalog.functions.arrays import adjacent_pairs, first_or_null, split_badges
from stratalog.functions.dates import relative_date
from stratalog.functions.specs import size_tier, spec_max_context, spec_min_gb, spec_rows
from stratalog.functions.text import clean_text, keyword_flag
from stratalog.operators.detail import detail_extract, html_sections, page_text, rollup_by_key
from stratalog.operators.listing import first_per_key, listing_anchors, listing_extract

# ---- pages as text nodes, for the oracles ----------------------------------------------------

UNESCAPE = (
    "regexp_replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), "
    "'&middot;', '·'), '&amp;?', '&', 'g')"
)


def nodes_sql(html: str, source: str = "pages", key: str = "page_id") -> str:
    """(key, nodes) with the text nodes of ``html`` as a list."""
    cut = (
        f"regexp_replace({html}, "
        r"'(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>', "
        "chr(1), 'g')"
    )
    text = UNESCAPE.format(x="x")
    return (
        f"SELECT {key}, list_transform(list_filter(string_split({cut}, chr(1)), "
        f"lambda x: x <> ''), lambda x: CASE WHEN regexp_full_match(x, '\\s+') "
        f"THEN CASE WHEN contains(x, chr(10)) THEN chr(10) ELSE ' ' END ELSE {text} END) AS nodes "
        f"FROM {source}"
    )


def full_text_sql(nodes: str = "nodes") -> str:
    return (
        f"array_to_string(list_filter(list_transform({nodes}, lambda x: trim(x, ' ' || chr(10) || "
        "chr(9) || chr(13))), lambda x: x <> ''), ' ')"
    )


def ordered_distinct(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def joined(col: Column | str, sep: str = "|") -> Column:
    return F.array_join(col, sep)


# ---- scalars ---------------------------------------------------------------------------------

MAGNITUDE_TEXT = """CASE p_partkey % 7
    WHEN 0 THEN concat(p_size, '.', p_partkey % 10, 'M')
    WHEN 1 THEN concat(p_size, '.', p_partkey % 10, 'k')
    WHEN 2 THEN concat('  ', p_size, '.', p_partkey % 10, 'B ')
    WHEN 3 THEN concat(p_size, '.', p_partkey % 10)
    WHEN 4 THEN concat(p_size, ',', lpad(CAST(p_partkey % 1000 AS VARCHAR(20)), 3, '0'))
    WHEN 5 THEN concat(p_size, '.', p_partkey % 10, '.1M')
    ELSE 'N/A' END"""


@check("magnitude_parse", f"""
    WITH t AS (SELECT p_partkey, {MAGNITUDE_TEXT} AS pulls_text FROM part),
    u AS (SELECT *, replace(upper(trim(pulls_text)), ',', '') AS u FROM t)
    SELECT p_partkey, pulls_text, CAST(coalesce(CASE
        WHEN contains(u, 'M') THEN trunc(try_cast(replace(u, 'M', '') AS DOUBLE) * 1e6)
        WHEN contains(u, 'K') THEN trunc(try_cast(replace(u, 'K', '') AS DOUBLE) * 1e3)
        WHEN contains(u, 'B') THEN trunc(try_cast(replace(u, 'B', '') AS DOUBLE) * 1e9)
        WHEN regexp_full_match(u, '[0-9]+') THEN CAST(u AS BIGINT) END, 0) AS BIGINT) AS pulls
    FROM u""")
def magnitude_parse(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.expr(MAGNITUDE_TEXT).alias("pulls_text")).withColumn(
        "pulls", magnitude_to_long(F.col("pulls_text"))
    )


AGE_TEXT = """CASE event_id % 5
    WHEN 0 THEN concat(1 + user_id % 11, ' years ago')
    WHEN 1 THEN concat(1 + user_id % 29, ' Months ago ')
    WHEN 2 THEN concat('Updated ', 1 + user_id % 11, ' week ago')
    WHEN 3 THEN concat(user_id, ' days  ago')
    ELSE concat('just now ', user_id) END"""


@check("relative_date_parse", f"""
    WITH t AS (SELECT event_id, lower(trim({AGE_TEXT})) AS s, event_id % 5 AS kind,
                      CAST(1 + user_id % 11 AS INTEGER) AS n,
                      CAST(1 + user_id % 29 AS INTEGER) AS months,
                      CAST(user_id AS INTEGER) AS days FROM events)
    SELECT event_id, CAST(CASE kind
        WHEN 0 THEN DATE '2024-03-31' - to_years(n)
        WHEN 1 THEN DATE '2024-03-31' - to_months(months)
        WHEN 2 THEN DATE '2024-03-31' - to_days(7 * n)
        WHEN 3 THEN DATE '2024-03-31' - to_days(days)
        ELSE DATE '2024-03-31' END AS DATE) AS last_updated, s AS last_updated_str FROM t""")
def relative_date_parse(spark, sf_dir):
    as_of = F.lit("2024-03-31").cast("date")
    date, low = relative_date(F.expr(AGE_TEXT), as_of)
    return table(spark, sf_dir, "events").select(
        "event_id", date.alias("last_updated"), low.alias("last_updated_str")
    )


@check("keyword_flag", """
    WITH t AS (SELECT p_partkey, lower(concat(upper(p_name), ' ', p_brand, ' ',
        CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('a ', p_type, ' one') END)) AS s FROM part)
    SELECT p_partkey, (contains(s, 'red') OR contains(s, 'promo') OR contains(s, 'a small'))
        AS flagged FROM t""")
def keyword_flags(spark, sf_dir):
    description = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("a "), "p_type", F.lit(" one")))
    flag = keyword_flag(
        F.upper("p_name"), F.col("p_brand"), description, ["red", "promo", "a small"]
    )
    return table(spark, sf_dir, "part").select("p_partkey", flag.alias("flagged"))


TAGS = ["widget", "bolt", "economy", "promo"]


@check("badge_split", """
    WITH b AS (SELECT p_partkey, list_filter(list_transform(
            [upper(string_split(p_name, ' ')[1]), string_split(p_name, ' ')[2], p_type, '  ',
             concat(' ', p_brand)], lambda x: lower(trim(x))), lambda x: x <> '') AS b FROM part),
    c AS (SELECT p_partkey, b, list_transform(
            list_filter(b, lambda x: x IN ('widget', 'bolt', 'economy', 'promo')),
            lambda x: concat(upper(x[1:1]), x[2:])) AS c FROM b)
    SELECT p_partkey, c[1] AS capability, array_to_string(c, '|') AS capabilities,
        array_to_string(list_filter(b, lambda x: x NOT IN ('widget', 'bolt', 'economy', 'promo')),
            '|') AS labels FROM c""")
def badge_split(spark, sf_dir):
    words = F.split("p_name", " ")
    badges = F.array(
        F.upper(words[0]), words[1], F.col("p_type"), F.lit("  "), F.concat(F.lit(" "), "p_brand")
    )
    capabilities, labels = split_badges(badges, TAGS)
    return table(spark, sf_dir, "part").select(
        "p_partkey", capabilities.alias("c"), labels.alias("l")
    ).select(
        "p_partkey", first_or_null(F.col("c")).alias("capability"),
        joined("c").alias("capabilities"), joined("l").alias("labels"),
    )


@check("readme_clean", """
    WITH t AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS raw
               FROM documents),
    s AS (SELECT doc_id, raw, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS s FROM t)
    SELECT doc_id,
        CASE WHEN raw IS NULL OR raw = '' THEN 'N/A' ELSE substring(s, 1, 1200) END AS snippet,
        CASE WHEN raw IS NULL OR raw = '' THEN 'N/A' ELSE substring(s, 1, 500) END AS short
    FROM s""")
def readme_clean(spark, sf_dir):
    raw = F.expr("CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END")
    return text_table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw")).select(
        "doc_id", clean_text(F.col("raw")).alias("snippet"),
        clean_text(F.col("raw"), 500).alias("short"),
    )


# ---- mentions --------------------------------------------------------------------------------

LICENSE_RE = (
    r"(?:^|[^\p{L}\p{N}_])(MIT|Apache[\s\-]2\.0|Llama[\s\p{L}\p{N}_]*License"
    r"|Gemma[\s\p{L}\p{N}_]*(?:Terms|License)|DeepSeek License|Qwen License|CC BY[\s\d\.]+"
    r"|GPL[\s\-]?\d?|AGPL|Proprietary|Commercial|Apache License)"
)


@check("license_mentions", f"""
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?i){LICENSE_RE}', 1) AS m FROM documents),
    d AS (SELECT doc_id, m, {ordered_distinct("m")} AS d FROM m)
    SELECT doc_id, CAST(len(d[1:3]) AS INTEGER) AS n, array_to_string(d[1:3], '|') AS mentions
    FROM d""")
def license_mentions(spark, sf_dir):
    return text_table(spark, sf_dir, "documents").select(
        "doc_id", mentions.license_mentions(F.col("text")).alias("m")
    ).select("doc_id", F.size("m").alias("n"), joined("m").alias("mentions"))


# Matches end in blanks, which the next match may need before it, so the oracle uses a zero-width
# boundary. That one knows ASCII only: letters outside ASCII are written as x on both sides.
@check("number_mentions", """
    WITH t AS (SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g') AS t FROM documents),
    m AS (SELECT doc_id, regexp_extract_all(t,
        '(?i)\\b((?:the|de|der|for)[^\\n]{0,60}?\\d+\\.?\\d*\\s*%?)', 1)[1:8] AS m FROM t)
    SELECT doc_id, array_to_string(
        list_filter(m, lambda x, i: list_position(m, x) = i), '|') AS mentions FROM m""")
def number_mentions(spark, sf_dir):
    found = mentions.score_mentions(F.col("text"), ["the", "de", "der", "for"])
    return text_table(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_replace(joined(found), r"[^\x00-\x7F]", "x").alias("mentions")
    )


CONTEXT_TEXT = """concat(text, ' up to ', doc_id, 'K context or ', n_chars, ' tokens, ',
    n_chars, ' tokens and ', doc_id % 9, 'm  Windows see https://hub.example.org/a/', doc_id % 5,
    ' and "http://hub.example.org/b', n_chars, '" or https://hub.example.org/a/', doc_id % 5)"""


@check("context_and_url_mentions", f"""
    WITH t AS (SELECT doc_id, {CONTEXT_TEXT} AS t FROM documents),
    m AS (SELECT doc_id,
        regexp_extract_all(t, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])(\\d+[KM]?\\s*(?:context|token|window)s?)', 1) AS c,
        regexp_extract_all(t, 'https?://hub\\.example\\.org/[^\\s"''>]+') AS u FROM t)
    SELECT doc_id, array_to_string(({ordered_distinct("c")})[1:5], '|') AS contexts,
        array_to_string(({ordered_distinct("u")})[1:5], '|') AS urls FROM m""")
def context_and_url_mentions(spark, sf_dir):
    text = F.col("t")
    return text_table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(CONTEXT_TEXT).alias("t")
    ).select(
        "doc_id", joined(mentions.context_mentions(text)).alias("contexts"),
        joined(mentions.url_mentions(text, "hub.example.org")).alias("urls"),
    )


# ---- listing ---------------------------------------------------------------------------------

ANCHORS_SQL = f"""a AS (
        SELECT page_id, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS h,
            unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2)) AS t,
            CAST(unnest(range(len(regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1)))) AS
                INTEGER) AS pos
        FROM pages),
    k AS (SELECT page_id, pos, trim(replace({UNESCAPE.format(x="h")}, '/', '')) AS item_key,
            trim({UNESCAPE.format(x="t")}) AS name, {UNESCAPE.format(x="h")} AS href FROM a),
    f AS (SELECT * FROM k WHERE item_key <> '' AND NOT contains(href, ':')
        QUALIFY row_number() OVER (PARTITION BY item_key ORDER BY page_id, pos) = 1)"""


@check("listing_links", f"WITH {ANCHORS_SQL} SELECT item_key, page_id, pos, href FROM f")
def listing_links(spark, sf_dir):
    anchors = listing_anchors(text_table(spark, sf_dir, "pages"), "/")
    return first_per_key(anchors, "item_key", ["page_id", "pos"]).select(
        "item_key", "page_id", "pos", "href"
    )


def _rich_anchors() -> Column:
    """Every navigation link turned into a full listing card."""
    card = F.concat(
        F.lit('<a href="/$1"><h2> $2</h2><p>About <b>$2</b> </p><span class="px-2 x">Tools</span>'
              '<span class="a px-2">'), F.col("page_id") % 13, F.lit('B</span><i>'),
        F.col("page_id") % 90, F.lit("."), F.col("page_id") % 10, F.lit("K</i> Pulls "),
        F.col("page_id") % 40, F.lit(" Tags Updated "), F.col("page_id") % 50,
        F.lit(" weeks ago \n more</a>"),
    )
    return F.regexp_replace(
        "html", F.lit('<a href="/([^"]*)">([^<]*)</a>'), card
    )


@check("listing_records", f"""WITH {ANCHORS_SQL}
    SELECT item_key, name AS item_name, concat('About', name) AS description,
        concat(page_id % 90, '.', page_id % 10, 'K') AS pulls_text,
        CAST(page_id % 40 AS INTEGER) AS tags_count,
        concat(page_id % 50, ' weeks ago') AS updated_text,
        'Tools' AS capability, 'Tools' AS capabilities, concat(page_id % 13, 'b') AS labels,
        (contains(lower(concat(item_key, ' ', name, ' About', name)), 'que')
         OR contains(lower(concat(item_key, ' ', name, ' About', name)), 'the')) AS hint
    FROM f""")
def listing_records(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages").withColumn("html", _rich_anchors())
    records = listing_extract(pages, "/", keywords=["que", "the"])
    return records.select(
        "item_key", "item_name", "description", "pulls_text", "tags_count", "updated_text",
        "capability", joined("capabilities").alias("capabilities"),
        joined("labels").alias("labels"), F.col("is_uncensored_hint").alias("hint"),
    )


# ---- detail pages ----------------------------------------------------------------------------

@check("page_text", f"""WITH n AS ({nodes_sql("html")})
    SELECT page_id, array_to_string(nodes, chr(10)) AS page_text FROM n""")
def page_texts(spark, sf_dir):
    return page_text(text_table(spark, sf_dir, "pages").select("page_id", "html"))


DETAIL_EXTRA = """concat(
    CASE page_id % 3
        WHEN 0 THEN concat('<section id="readme"><h2>About</h2><p>Body &amp; ', page_id,
                           '</p></section>')
        WHEN 1 THEN concat('<p>README</p><p>Text of ', page_id, '</p><p>models</p>')
        ELSE '' END,
    '<p>a', page_id % 7, ' ', page_id % 5 + 1, '.5 GB · ', (page_id % 4 + 1) * 8, 'K context</p>',
    '<p>b', page_id % 7, '-Q8_0 ', page_id % 3 + 2, ' GB - ', page_id % 6, 'M context</p>',
    '<p>c', page_id % 7, ' ', page_id % 5 + 1, '.5 GB · ', (page_id % 4 + 1) * 8, 'K context</p>',
    '<p>a', page_id % 7, ' 1.0 GB · 1K context</p>',
    '<div><h2>Applications</h2><b>App ', page_id, '</b><i>go run ', page_id,
    '</i><i>go more</i><u>Tail</u><u>go on</u></div>')"""


@check("detail_extract", """
    WITH t AS (SELECT page_id, page_id % 5 + 1.5 AS sa, CAST(page_id % 3 + 2 AS DOUBLE) AS sb,
        (page_id % 4 + 1) * 8 AS ka, page_id % 6 AS mb FROM pages),
    s AS (SELECT page_id, CAST(sa AS DOUBLE) AS sa, sb, ka, mb,
        concat('a', page_id % 7, '/', page_id % 5 + 1, '.5 GB/q4_k_m/', ka, 'K context') AS ra,
        concat('b', page_id % 7, '-Q8_0/', page_id % 3 + 2, ' GB/q8_0/', mb, 'M context') AS rb
        FROM t)
    SELECT page_id,
        CASE page_id % 3 WHEN 0 THEN concat('About', chr(10), 'Body & ', page_id)
            WHEN 1 THEN concat('Text of ', page_id) END AS readme,
        CASE WHEN sa <= sb THEN concat(ra, '|', rb) ELSE concat(rb, '|', ra) END AS specs,
        round_even(least(sa, sb) * 1.25, 1) AS first_ram,
        concat('App ', page_id, '/go run ', page_id, '|Tail/go on') AS applications,
        least(sa, sb) AS min_ram_gb,
        CAST(greatest(ka * 1000, mb * 1000000) AS BIGINT) AS context_window,
        CASE WHEN least(sa, sb) <= 2.5 THEN 'fast' WHEN least(sa, sb) <= 6 THEN 'medium'
            ELSE 'slow' END AS speed_tier
    FROM s""")
def detail_pages(spark, sf_dir):
    html = F.replace(
        "html", F.lit("</article>"), F.concat(F.lit("</article>"), F.expr(DETAIL_EXTRA))
    )
    pages = text_table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    detail = detail_extract(pages, "go")
    spec = F.transform("memory_requirements", lambda r: F.concat_ws(
        "/", r["tag"], r["size"], r["quantization"], r["context"]
    ))
    app = F.transform("applications", lambda a: F.concat_ws("/", a["name"], a["launch_command"]))
    return detail.select(
        "page_id", "readme", joined(spec).alias("specs"),
        F.col("memory_requirements")[0]["recommended_ram_gb"].alias("first_ram"),
        joined(app).alias("applications"), "min_ram_gb", "context_window", "speed_tier",
    )


MAIN_SQL = full_text_sql("nodes")


@check("page_main_content", f"""
    WITH n AS ({nodes_sql("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")})
    SELECT page_id, substring(trim(regexp_replace({MAIN_SQL}, '\\s+', ' ', 'g')), 1, 2500)
        AS main_content FROM n""")
def page_main_content(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages").select("page_id", "html")
    return html_sections(pages).select("page_id", "main_content")


SECTION_EXTRA = """concat('<div class="x Markdown-body">Main ', page_id, '</div>',
    '<p>Apache-2.0, see https://huggingface.co/org/m', page_id, ' now: 128K context, MMLU is 7',
    page_id % 10, '.5%</p><section><h2>The Applications</h2><p>one</p>tail<p>two <b>', page_id,
    '</b></p><h3>Other</h3><p>none</p></section>')"""
# The pages' own words hold short license names too ("mit"), so this oracle reads the whole text.
_EXTRA_HTML = f"replace(html, '</article>', concat('</article>', {SECTION_EXTRA}))"


SCORE_RE = (
    r"(?:^|[^\p{L}\p{N}_])((?:MMLU|HumanEval|GSM8K|SWE-bench|MATH|HellaSwag|ARC|MBPP|BigBench"
    r"|TruthfulQA|WinoGrande|PIQA|GPQA|AIME|AMC)[^\n]{0,60}?\d+\.?\d*\s*%?)"
)


@check("html_sections", f"""
    WITH n AS ({nodes_sql(_EXTRA_HTML)}),
    t AS (SELECT page_id, {MAIN_SQL} AS t FROM n),
    m AS (SELECT page_id, regexp_extract_all(t, '(?i){LICENSE_RE}', 1) AS lic,
        regexp_extract_all(t, '(?i){SCORE_RE}', 1)[1:8] AS sc FROM t)
    SELECT page_id, concat('Main ', page_id) AS main_content,
        concat('https://huggingface.co/org/m', page_id) AS hf_links,
        '128K context' AS context_mentions,
        array_to_string(({ordered_distinct("lic")})[1:3], '|') AS license_mentions,
        array_to_string({ordered_distinct("sc")}, '|') AS benchmark_mentions,
        concat('one|two', page_id) AS applications_raw
    FROM m""")
def sections(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages").select(
        "page_id",
        F.replace(
            "html", F.lit("</article>"), F.concat(F.lit("</article>"), F.expr(SECTION_EXTRA))
        ).alias("html"),
    )
    out = html_sections(pages)
    lists = ["hf_links", "context_mentions", "license_mentions", "benchmark_mentions",
             "applications_raw"]
    return out.select("page_id", "main_content", *[joined(c).alias(c) for c in lists])


# The outer form of explode below keeps the optimizer from evaluating the array twice, once for an
# inferred "is not empty" filter.

# ---- specification rows and pairs ------------------------------------------------------------

SPEC_TEXT = """concat(
    'http-', l_linenumber, ' 7 GB · 4K context\n',
    l_returnflag, l_linenumber, ' ', CAST(l_quantity AS INT), ' GB · ', l_linenumber * 4,
    'K context\n',
    l_linestatus, l_linenumber, ' ', CAST(l_quantity AS INT), ' GB · ', l_linenumber * 4,
    'K context\n',
    l_linestatus, l_linenumber, ' ', CAST(l_quantity AS INT) + l_suppkey % 3, 'GB ',
    l_linenumber * 4, 'K context\n',
    l_returnflag, l_linenumber + l_suppkey % 2, '-fp16 ', l_partkey % 60, ' GB - ',
    l_orderkey % 3, 'M context')"""

_SPEC_CANDIDATES = """
    base AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
        CAST(l_quantity AS INTEGER) AS q FROM lineitem),
    c AS (
        SELECT *, 1 AS i, concat(l_returnflag, l_linenumber) AS tag, q AS gb,
            concat(q, ' GB') AS size, 'q4_k_m' AS quantization,
            concat(l_linenumber * 4, 'K context') AS context,
            CAST(l_linenumber * 4000 AS BIGINT) AS win, TRUE AS kept FROM base
        UNION ALL
        SELECT *, 3, concat(l_linestatus, l_linenumber), q + l_suppkey % 3,
            concat(q + l_suppkey % 3, 'GB'), 'q4_k_m', concat(l_linenumber * 4, 'K context'),
            l_linenumber * 4000, l_suppkey % 3 <> 0 FROM base
        UNION ALL
        SELECT *, 4, concat(l_returnflag, l_linenumber + l_suppkey % 2, '-fp16'), l_partkey % 60,
            concat(l_partkey % 60, ' GB'), 'fp16', concat(l_orderkey % 3, 'M context'),
            l_orderkey % 3 * 1000000, TRUE FROM base),
    k AS (SELECT *, CAST(gb AS DOUBLE) AS size_gb FROM c WHERE kept)"""


def _spec_arrays(spark, sf_dir):
    line = text_table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        spec_rows(F.expr(SPEC_TEXT)).alias("specs"),
    )


@check("spec_rows", f"""WITH {_SPEC_CANDIDATES}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, tag, size, size_gb,
        CASE WHEN gb <> 0 THEN round_even(size_gb * 1.25, 1) END AS recommended_ram_gb,
        quantization, context, win AS context_window,
        CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
            l_returnflag, l_linestatus, q
            ORDER BY CASE WHEN gb = 0 THEN 999 ELSE gb END, i) - 1 AS INTEGER) AS pos
    FROM k""")
def spec_row_list(spark, sf_dir):
    return _spec_arrays(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.posexplode_outer("specs").alias("pos", "r"),
    ).filter(F.col("pos").isNotNull()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pos", "r.*")


_TIER_SQL = """CASE WHEN min_ram_gb <= 2.5 THEN 'fast' WHEN min_ram_gb <= 6 THEN 'medium'
        WHEN min_ram_gb IS NOT NULL THEN 'slow' END AS speed_tier"""


@check("spec_rollup", f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(least(CAST(l_quantity AS INTEGER), CASE WHEN l_partkey % 60 > 0 THEN l_partkey % 60
            ELSE 999999 END) AS DOUBLE) AS min_ram_gb,
        CAST(greatest(l_linenumber * 4000, l_orderkey % 3 * 1000000) AS BIGINT) AS context_window
        FROM lineitem)
    SELECT *, {_TIER_SQL} FROM t""")
def spec_rollup(spark, sf_dir):
    return _spec_arrays(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        spec_min_gb(F.col("specs")).alias("min_ram_gb"),
        spec_max_context(F.col("specs")).alias("context_window"),
    ).withColumn("speed_tier", size_tier(F.col("min_ram_gb")))


@check("spec_rollup_by_key", f"""
    WITH t AS (SELECT l_partkey, round_even(min(l_quantity - 5) FILTER (l_quantity > 5), 1)
            AS min_ram_gb,
        CAST(max((l_linenumber - 1) * 1000) FILTER (l_linenumber > 1) AS BIGINT) AS context_window
        FROM lineitem GROUP BY l_partkey)
    SELECT *, {_TIER_SQL} FROM t""")
def spec_rollup_by_key(spark, sf_dir):
    specs = table(spark, sf_dir, "lineitem").select(
        "l_partkey", (F.col("l_quantity") - 5).alias("size_gb"),
        ((F.col("l_linenumber") - 1) * 1000).cast("bigint").alias("context_window"),
    )
    return rollup_by_key(specs, "l_partkey")


@check("name_command_pairs", """
    WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
            unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents),
    c AS (SELECT *, starts_with(x, 'Th') AS cmd,
            lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS name,
            max(CASE WHEN NOT starts_with(x, 'Th') THEN i END) OVER (
                PARTITION BY doc_id ORDER BY i) AS last_plain FROM t)
    SELECT doc_id, name, x AS launch_command,
        CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos
    FROM c WHERE cmd AND CASE WHEN last_plain IS NULL THEN (i - 1) % 2 = 1
        ELSE (i - last_plain) % 2 = 1 END""")
def name_command_pairs(spark, sf_dir):
    pairs = adjacent_pairs(F.split("text", "\n"), "Th")
    return text_table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode_outer(pairs).alias("pos", "p")
    ).filter(F.col("pos").isNotNull()).select("doc_id", "pos", "p.*")
