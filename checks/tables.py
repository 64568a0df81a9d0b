"""Catalog operators over the star-schema tables, ``documents``, ``labels`` and ``pages``."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from checks.extraction import ANCHORS_SQL, DETAIL_EXTRA, joined
from checks.registry import check, table, text_table
from stratalog.functions.arrays import canonical_term, canonical_terms, first_contained
from stratalog.operators import catalog as cat
from stratalog.operators.inference import infer_summary, run_calls
from stratalog.operators.joins import is_small
from stratalog.operators.listing import first_per_key, listing_anchors
from stratalog.operators.prompts import build_prompts, prompts_long
from stratalog.operators.publish import (
    export_rows, export_stats, no_change_gate, ranked, snapshot_diff,
)
from stratalog.operators.quality import (
    DEFAULT_RULES, Rule, rule_validate, validation_summary, validation_transition,
)
from stratalog.operators.responses import merge_answers, parse_answer
from stratalog.operators.staleness import select_stale
from stratalog.operators.vocab import (
    classify_by_table, map_audience, map_family, normalise_arrays_by_table, normalise_by_table,
)
from stratalog.plans.bucketed import upsert_bucketed
from stratalog.plans.refresh import Options, Refresh, Site, local_or_shared_root
from stratalog.schema import ANSWERS
from stratalog.sources.buckets import BucketedTables
from stratalog.sources.exports import read_export, write_export
from stratalog.sources.snapshots import SnapshotStore

# ---- vocabularies ----------------------------------------------------------------------------

SEGMENT_TEXT = """CASE c_nationkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment)
    WHEN 2 THEN concat('  ', c_mktsegment, ' ') ELSE concat(c_mktsegment, 'x') END"""
SEGMENTS = ["HOUSEHOLD", "Machines", "Cars"]
SEGMENT_ALIASES = {
    "household": "HOUSEHOLD", "machinery": "Machines", "automobile": "Cars",
    "furniture": "HOUSEHOLD",
}


@check("vocab_scalar", f"""
    WITH v AS (SELECT c_custkey, {SEGMENT_TEXT} AS v FROM customer)
    SELECT c_custkey, CASE WHEN v IN ('HOUSEHOLD', 'Machines', 'Cars') THEN v
        ELSE CASE lower(trim(v)) WHEN 'household' THEN 'HOUSEHOLD' WHEN 'machinery' THEN 'Machines'
            WHEN 'automobile' THEN 'Cars' WHEN 'furniture' THEN 'HOUSEHOLD' ELSE 'Other' END
        END AS term FROM v""")
def vocab_scalar(spark, sf_dir):
    term = canonical_term(F.expr(SEGMENT_TEXT), SEGMENTS, SEGMENT_ALIASES, "Other")
    return table(spark, sf_dir, "customer").select("c_custkey", term.alias("term"))


BRAND_TEXT = """CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat(' ', p_name)
    ELSE concat('T-', p_brand) END"""


@check("vocab_table", f"""
    WITH a AS (SELECT DISTINCT p_name AS alias, concat('T-', p_brand) AS term FROM part
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_brand) = 1),
    v AS (SELECT p_partkey, {BRAND_TEXT} AS v FROM part)
    SELECT p_partkey, v, coalesce(e.term, b.term, 'Other') AS term FROM v
    LEFT JOIN (SELECT DISTINCT term FROM a) e ON e.term = v
    LEFT JOIN a b ON b.alias = lower(trim(v))""")
def vocab_table(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    vocabulary = part.groupBy(F.col("p_name").alias("alias")).agg(
        F.concat(F.lit("T-"), F.min("p_brand")).alias("term")
    )
    values = part.select("p_partkey", F.expr(BRAND_TEXT).alias("v"))
    return normalise_by_table(values, "v", vocabulary, "Other", "term")


NAMES = ["ring", "Bolt", "Economy"]
NAME_ALIASES = {"bolt": "Bolt", "rod": "ring", "economy": "Economy", "red": "Bolt"}


@check("vocab_array", """
    WITH v AS (SELECT p_partkey, [string_split(p_name, ' ')[2], upper(string_split(p_name, ' ')[1]),
        ' Bolt', p_type, string_split(p_name, ' ')[2], CASE WHEN p_size % 2 = 0 THEN 'ring' END]
        [CASE WHEN p_size % 3 = 0 THEN 4 ELSE 1 END:] AS v FROM part),
    m AS (SELECT p_partkey, list_filter(list_transform(v, lambda x: CASE
        WHEN x IN ('ring', 'Bolt', 'Economy') THEN x
        ELSE CASE lower(trim(x)) WHEN 'bolt' THEN 'Bolt' WHEN 'rod' THEN 'ring'
            WHEN 'economy' THEN 'Economy' WHEN 'red' THEN 'Bolt' END END),
        lambda x: x IS NOT NULL) AS m FROM v),
    d AS (SELECT p_partkey, list_filter(m, lambda x, i: list_position(m, x) = i)[1:2] AS d FROM m)
    SELECT p_partkey, CASE WHEN len(d) = 0 THEN 'none' ELSE array_to_string(d, '|') END AS terms
    FROM d""")
def vocab_array(spark, sf_dir):
    words = F.split("p_name", " ")
    values = F.array(
        words[1], F.upper(words[0]), F.lit(" Bolt"), F.col("p_type"), words[1],
        F.when(F.col("p_size") % 2 == 0, "ring"),
    )
    values = F.slice(values, F.when(F.col("p_size") % 3 == 0, 4).otherwise(1), F.lit(6))
    terms = canonical_terms(values, NAMES, NAME_ALIASES, "none", cap=2)
    return table(spark, sf_dir, "part").select("p_partkey", joined(terms).alias("terms"))


@check("substring_classify", """
    WITH v AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'Gizmo' ELSE
        concat(' ', upper(p_name), p_type) END AS v FROM part)
    SELECT p_partkey, CASE WHEN v IN ('Gizmo', 'Round') THEN v
        WHEN contains(lower(v), 'ring') THEN 'Round' WHEN contains(lower(v), 'old b') THEN 'Antique'
        WHEN contains(lower(v), 'ol') THEN 'Ol' WHEN contains(lower(v), 'large') THEN 'Big'
        ELSE 'Other' END AS family FROM v""")
def substring_classify(spark, sf_dir):
    value = F.when(F.col("p_size") % 4 == 0, "Gizmo").otherwise(
        F.concat(F.lit(" "), F.upper("p_name"), "p_type")
    )
    aliases = [("ring", "Round"), ("old b", "Antique"), ("ol", "Ol"), ("large", "Big")]
    family = first_contained(value, ["Gizmo", "Round"], aliases, "Other")
    return table(spark, sf_dir, "part").select("p_partkey", family.alias("family"))


PART_TERMS = """
    a AS (SELECT p_name AS alias, concat('T-', min(p_brand)) AS term, min(p_partkey) AS rank
        FROM part GROUP BY p_name)"""


def _part_terms(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("alias")).agg(
        F.concat(F.lit("T-"), F.min("p_brand")).alias("term"), F.min("p_partkey").alias("rank"))


@check("vocab_array_table", f"""WITH {PART_TERMS},
    v AS (SELECT p_partkey, unnest([upper(p_name), concat('T-', p_brand), p_type, p_name])
        AS v, unnest([0, 1, 2, 3]) AS i FROM part),
    t AS (SELECT p_partkey, i, coalesce(e.term, b.term) AS term FROM v
        LEFT JOIN (SELECT DISTINCT term FROM a) e ON e.term = v
        LEFT JOIN a b ON b.alias = lower(trim(v))),
    d AS (SELECT p_partkey, term, min(i) AS i FROM t WHERE term IS NOT NULL GROUP BY ALL)
    SELECT p_partkey, coalesce(string_agg(term, '|' ORDER BY i), 'none') AS terms
    FROM part LEFT JOIN d USING (p_partkey) GROUP BY p_partkey""")
def vocab_array_table(spark, sf_dir):
    values = table(spark, sf_dir, "part").select("p_partkey", F.array(
        F.upper("p_name"), F.concat(F.lit("T-"), "p_brand"), "p_type", "p_name").alias("v"))
    out = normalise_arrays_by_table(
        values, "p_partkey", "v", _part_terms(spark, sf_dir), "none", "terms")
    return out.select("p_partkey", joined("terms").alias("terms"))


@check("substring_classify_table", f"""WITH {PART_TERMS},
    v AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN concat('T-', p_brand)
        WHEN 1 THEN concat('my ', upper(p_name), '!') WHEN 2 THEN p_type
        ELSE concat(p_type, p_name) END AS v FROM part),
    f AS (SELECT v, min_by(term, rank) AS term FROM (SELECT DISTINCT v FROM v) JOIN a
        ON contains(lower(v), alias) GROUP BY v)
    SELECT p_partkey, CASE WHEN v IN (SELECT term FROM a) THEN v ELSE coalesce(term, 'Other') END
        AS term FROM v LEFT JOIN f USING (v)""")
def substring_classify_table(spark, sf_dir):
    value = F.expr("CASE p_size % 4 WHEN 0 THEN concat('T-', p_brand) WHEN 1 THEN "
                   "concat('my ', upper(p_name), '!') WHEN 2 THEN p_type "
                   "ELSE concat(p_type, p_name) END")
    values = table(spark, sf_dir, "part").select("p_partkey", value.alias("v"))
    return classify_by_table(values, "v", _part_terms(spark, sf_dir), "Other", "term").select(
        "p_partkey", "term")


# ---- key split, detail, upsert ---------------------------------------------------------------

def _known(spark, sf_dir):
    """The catalog side: all customers."""
    return table(spark, sf_dir, "customer")


def _orders(spark, sf_dir):
    """The crawl side: all orders, their keys moved on so that some are not in the catalog."""
    return table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey") + 100)


_ORDERS_SQL = "(SELECT o_custkey + 100 AS o_custkey, o_orderdate FROM orders)"


def _listed(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return orders.select(F.concat(F.lit("c"), "o_custkey").alias("item_key")).distinct()


def _known_keys(spark, sf_dir):
    return _known(spark, sf_dir).select(F.concat(F.lit("c"), "c_custkey").alias("item_key"))


_LISTED_SQL = f"SELECT DISTINCT concat('c', o_custkey) AS item_key FROM {_ORDERS_SQL}"
_KNOWN_SQL = "SELECT concat('c', c_custkey) FROM customer"


@check("new_keys", f"SELECT * FROM ({_LISTED_SQL}) WHERE item_key NOT IN ({_KNOWN_SQL})")
def new_keys(spark, sf_dir):
    return cat.new_keys(_listed(spark, sf_dir), _known_keys(spark, sf_dir))


@check("known_keys", f"SELECT * FROM ({_LISTED_SQL}) WHERE item_key IN ({_KNOWN_SQL})")
def known_keys(spark, sf_dir):
    return cat.known_keys(_listed(spark, sf_dir), _known_keys(spark, sf_dir))


def _attach(spark, sf_dir, force):
    def keyed(name):
        return F.concat(F.lit("d"), name).alias("item_key")

    listing = text_table(spark, sf_dir, "documents").select(keyed("doc_id"), "lang")
    catalog = table(spark, sf_dir, "labels").select(keyed("doc_id"))
    html = F.when(F.col("page_id") % 3 != 0, F.col("html"))
    pages = text_table(spark, sf_dir, "pages").select(keyed("page_id"), html.alias("html"))
    out = cat.detail_attach(listing, catalog, pages, force)
    return out.select("item_key", "lang", "has_detail", F.length("html").alias("html_chars"))


def _attach_sql(wanted):
    return f"""
    SELECT concat('d', doc_id) AS item_key, lang, coalesce(page_id % 3 <> 0 AND {wanted}, FALSE)
        AS has_detail,
        CASE WHEN page_id % 3 <> 0 AND {wanted} THEN CAST(length(html) AS INTEGER) END AS html_chars
    FROM documents LEFT JOIN pages ON doc_id = page_id"""


@check("detail_attach", _attach_sql("doc_id NOT IN (SELECT doc_id FROM labels)"))
def detail_attach(spark, sf_dir):
    return _attach(spark, sf_dir, force=False)


@check("detail_attach_force", _attach_sql("TRUE"))
def detail_attach_force(spark, sf_dir):
    return _attach(spark, sf_dir, force=True)


def _stored_catalog(spark, sf_dir):
    e = F.expr
    return cat.conform(
        _known(spark, sf_dir),
        id=e("concat('id', c_custkey)"), item_key=e("concat('c', c_custkey)"),
        item_name=F.col("c_name"), item_type=F.lit("old"), namespace=F.lit("ns"),
        url=e("concat('old/', c_custkey)"), description=F.col("c_mktsegment"),
        readme=F.lit("old readme"), capability=F.lit("Old"), capabilities=e("array('Old')"),
        labels=e("array(c_mktsegment)"), pulls=F.col("c_custkey"), tags=F.lit(1),
        last_updated=e("DATE '2020-01-01'"), last_updated_str=F.lit("old"),
        min_ram_gb=F.col("c_acctbal"), context_window=F.lit(5), speed_tier=F.lit("slow"),
        is_uncensored=e("CASE c_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END"),
        domain=F.lit("Code"), enrich_version=F.lit(1), validation_retries=F.lit(2),
        timestamp=e("TIMESTAMP '2020-01-01 00:00:00'"),
    )


def _crawl(spark, sf_dir):
    """One crawl row per customer with an order; the counts are reduced before the shuffle."""
    orders = _orders(spark, sf_dir)
    n = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").cast("date").alias("d")
    )
    return n.selectExpr(
        "concat('c', o_custkey) AS item_key", "concat('crawl ', o_custkey) AS item_name",
        "CASE WHEN n % 2 = 0 THEN concat('desc ', n) END AS description",
        "'Tools' AS capability", "array('Tools', 'Code') AS capabilities",
        "CASE WHEN n % 3 = 0 THEN CAST(array() AS array<string>) ELSE array(concat('l', n)) END"
        " AS labels",
        "n % 2 = 0 AS is_uncensored_hint", "n % 2 = 1 AS has_detail", "n AS pulls",
        "CAST(n + 1 AS INT) AS tags", "d AS last_updated", "concat(n, ' days ago') AS last_updated_str",
        "CASE WHEN n <> 3 THEN concat('new ', n) END AS readme",
        "CAST(NULL AS array<struct<name:string,launch_command:string>>) AS applications",
        "CAST(NULL AS array<struct<tag:string,size:string,size_gb:double,recommended_ram_gb:double,"
        "quantization:string,context:string,context_window:bigint>>) AS memory_requirements",
        "CAST(n AS DOUBLE) AS min_ram_gb", "n * 1000 AS context_window",
        "CASE WHEN n <= 2 THEN 'fast' ELSE 'medium' END AS speed_tier",
    )


_MERGE_SQL = f"""
    n AS (SELECT o_custkey, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS d FROM {_ORDERS_SQL}
          GROUP BY o_custkey),
    c AS (SELECT * FROM customer),
    m AS (SELECT c_custkey AS c, o_custkey AS k, coalesce(c_custkey, o_custkey) AS key, * FROM c
          FULL JOIN n ON c_custkey = o_custkey)"""

UPSERT_SQL = f"""WITH {_MERGE_SQL}
    SELECT CASE WHEN c IS NULL THEN sha256(concat('c', key)) ELSE concat('id', key) END AS id,
        concat('c', key) AS item_key,
        CASE WHEN c IS NULL THEN concat('crawl ', key) ELSE c_name END AS item_name,
        CASE WHEN c IS NULL THEN 'official' ELSE 'old' END AS item_type,
        CASE WHEN c IS NOT NULL THEN 'ns' END AS namespace,
        concat(CASE WHEN c IS NULL THEN 'https://example.org/items/c' ELSE 'old/' END, key) AS url,
        CASE WHEN k IS NULL THEN c_mktsegment WHEN n % 2 = 0 THEN concat('desc ', n) END
            AS description,
        CASE WHEN k IS NULL THEN 'Old' ELSE 'Tools|Code' END AS capabilities,
        CASE WHEN k IS NOT NULL AND n % 3 <> 0 THEN concat('l', n) WHEN c IS NULL THEN ''
            ELSE c_mktsegment END AS labels,
        CASE WHEN k IS NULL THEN c_custkey ELSE n END AS pulls,
        CAST(CASE WHEN k IS NULL THEN 1 ELSE n + 1 END AS INTEGER) AS tags,
        CASE WHEN k IS NULL THEN DATE '2020-01-01' ELSE d END AS last_updated,
        CASE WHEN k IS NULL THEN 'old' ELSE concat(n, ' days ago') END AS last_updated_str,
        CASE WHEN c IS NULL OR coalesce(n % 2 = 1, FALSE)
            THEN CASE WHEN n <> 3 THEN concat('new ', n) END ELSE 'old readme' END AS readme,
        CASE WHEN c IS NULL OR coalesce(n % 2 = 1, FALSE) THEN CAST(n AS DOUBLE)
            ELSE c_acctbal END AS min_ram_gb,
        CAST(CASE WHEN c IS NULL OR coalesce(n % 2 = 1, FALSE) THEN n * 1000 ELSE 5 END AS BIGINT)
            AS context_window,
        CASE WHEN c IS NULL OR coalesce(n % 2 = 1, FALSE)
            THEN CASE WHEN n <= 2 THEN 'fast' ELSE 'medium' END ELSE 'slow' END AS speed_tier,
        CASE WHEN c IS NULL THEN n % 2 = 0 ELSE CASE c_nationkey % 3 WHEN 1 THEN TRUE
            WHEN 2 THEN FALSE ELSE n % 2 = 0 END END AS is_uncensored,
        CASE WHEN c IS NOT NULL THEN 'Code' END AS domain,
        CAST(CASE WHEN c IS NOT NULL THEN 1 END AS INTEGER) AS enrich_version,
        CASE WHEN c IS NULL THEN 0 ELSE 2 END AS validation_retries,
        CASE WHEN k IS NULL THEN DATE '2020-01-01' ELSE DATE '2024-02-01' END AS stamped,
        CASE WHEN c IS NULL THEN 'inserted' WHEN k IS NULL THEN 'kept' ELSE 'updated' END AS action
    FROM m"""


def _upserted(spark, sf_dir, small):
    return cat.catalog_upsert(
        _stored_catalog(spark, sf_dir), _crawl(spark, sf_dir), "https://example.org/items",
        F.lit("2024-02-01").cast("timestamp"), small_crawl=small,
    )


def _upsert_view(merged):
    return merged.select(
        "id", "item_key", "item_name", "item_type", "namespace", "url", "description",
        joined("capabilities").alias("capabilities"), joined("labels").alias("labels"),
        "pulls", "tags", "last_updated", "last_updated_str", "readme", "min_ram_gb",
        "context_window", "speed_tier", "is_uncensored", "domain", "enrich_version",
        "validation_retries", F.to_date("timestamp").alias("stamped"),
        F.col(cat.ACTION).alias("action"),
    )


@check("catalog_upsert", UPSERT_SQL)
def catalog_upsert(spark, sf_dir):
    return _upsert_view(_upserted(spark, sf_dir, small=False))


@check("catalog_upsert_small_crawl", UPSERT_SQL)
def catalog_upsert_small_crawl(spark, sf_dir):
    # Broadcast if the crawl is small enough; the general join otherwise.
    small = is_small(_crawl(spark, sf_dir))
    return _upsert_view(_upserted(spark, sf_dir, small))


@check("upsert_bucketed", UPSERT_SQL)
def upsert_in_buckets(spark, sf_dir):
    made = uuid.uuid4().hex
    tables = BucketedTables(spark, local_or_shared_root(spark, "buckets"), buckets=16)
    stored = tables.write(f"state_{made}", _stored_catalog(spark, sf_dir))
    return _upsert_view(upsert_bucketed(
        tables, stored, _crawl(spark, sf_dir), f"merged_{made}", "https://example.org/items",
        F.lit("2024-02-01").cast("timestamp")))


@check("upsert_summary", f"""WITH {_MERGE_SQL}
    SELECT count(*) FILTER (c IS NULL) AS inserted,
        count(*) FILTER (c IS NOT NULL AND k IS NOT NULL) AS updated FROM m""")
def upsert_summary(spark, sf_dir):
    return cat.upsert_summary(_upserted(spark, sf_dir, small=False))


REPARSE_HTML = f"""CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN html
    ELSE replace(html, '</article>', concat('</article>', {DETAIL_EXTRA})) END"""


def _reparsed(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages")
    catalog = cat.conform(
        pages.select("page_id"), item_key=F.col("page_id"), readme=F.lit("old"),
        min_ram_gb=F.lit(4.1), context_window=F.lit(77), speed_tier=F.lit("medium"),
    )
    stored = pages.select(
        F.col("page_id").cast("string").alias("item_key"), F.expr(REPARSE_HTML).alias("html")
    )
    return cat.reparse(catalog, stored, "go")


@check("reparse", """
    WITH t AS (SELECT page_id, page_id % 5 AS v, least(page_id % 5 + 1.5, page_id % 3 + 2) AS gb,
        greatest((page_id % 4 + 1) * 8000, page_id % 6 * 1000000) AS cw FROM pages)
    SELECT CAST(page_id AS VARCHAR) AS item_key,
        CASE WHEN v < 2 THEN 'old' WHEN v = 2 THEN NULL
            WHEN page_id % 3 = 0 THEN concat('About', chr(10), 'Body & ', page_id)
            WHEN page_id % 3 = 1 THEN concat('Text of ', page_id) END AS readme,
        CAST(CASE WHEN v > 2 THEN 2 END AS INTEGER) AS n_specs,
        CAST(CASE WHEN v > 2 THEN gb ELSE 4.1 END AS DOUBLE) AS min_ram_gb,
        CAST(CASE WHEN v > 2 THEN cw ELSE 77 END AS BIGINT) AS context_window,
        CASE WHEN v <= 2 THEN 'medium' WHEN gb <= 2.5 THEN 'fast' ELSE 'medium' END AS speed_tier,
        CASE WHEN v < 2 THEN 'skipped' ELSE 'updated' END AS action
    FROM t""")
def reparse(spark, sf_dir):
    return _reparsed(spark, sf_dir).select(
        "item_key", "readme", F.size("memory_requirements").alias("n_specs"), "min_ram_gb",
        "context_window", "speed_tier", F.col(cat.ACTION).alias("action"),
    )


@check("reparse_summary", """
    SELECT count(*) FILTER (page_id % 5 >= 2) AS updated,
        count(*) FILTER (page_id % 5 < 2) AS skipped FROM pages""")
def reparse_summary(spark, sf_dir):
    return cat.reparse_summary(_reparsed(spark, sf_dir))


# ---- staleness and prompts -------------------------------------------------------------------

_VERSION = "CAST(nullif(p_size % 4, 3) AS INT)"


def _versions(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "concat(p_name, '-', p_partkey) AS item_key", f"{_VERSION} AS enrich_version"
    )


_VERSION_SQL = f"SELECT concat(p_name, '-', p_partkey) AS item_key, {_VERSION} AS enrich_version FROM part"


@check("stale_select", f"SELECT * FROM ({_VERSION_SQL}) WHERE enrich_version IS NULL OR enrich_version < 2")
def stale_select(spark, sf_dir):
    return select_stale(_versions(spark, sf_dir), 2)


@check("stale_select_force", _VERSION_SQL)
def stale_select_force(spark, sf_dir):
    return select_stale(_versions(spark, sf_dir), 2, force=True)


@check("stale_select_single", f"SELECT * FROM ({_VERSION_SQL}) WHERE item_key = 'red widget-1'")
def stale_select_single(spark, sf_dir):
    return select_stale(_versions(spark, sf_dir), 2, force=True, single_key="red widget-1")


TEMPLATES = {
    1: "Item {key}: {description}\nAnswer with JSON.",
    3: "{key} has {labels}",
    4: "Text: {text}",
    6: "{links} / {scores} / {labels}",
}


def _prompt_items(spark, sf_dir):
    e = F.expr
    return table(spark, sf_dir, "part").select(
        e("concat('p', p_partkey)").alias("item_key"),
        e("CASE WHEN p_size % 2 = 0 THEN p_name END").alias("description"),
        e("CASE WHEN p_size % 3 <> 0 THEN array(p_brand, p_type) END").alias("labels"),
        e("concat(p_name, '  of ', p_type)").alias("readme"),
        e("CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN '' END").alias("main_content"),
        e("CASE WHEN p_size % 2 = 0 THEN array(p_brand) END").alias("hf_links"),
        e("CASE WHEN p_size % 5 = 0 THEN array(p_name, p_name) END").alias("benchmark_mentions"),
    )


@check("prompt_build", """
    WITH s AS (SELECT concat('p', p_partkey) AS item_key, p_size,
        CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END AS description,
        CASE WHEN p_size % 3 <> 0 THEN concat('["', p_brand, '","', p_type, '"]') ELSE '[]' END
            AS labels,
        CASE WHEN p_size % 3 = 0 THEN p_type ELSE concat(p_name, ' of ', p_type) END AS text,
        CASE WHEN p_size % 2 = 0 THEN concat('["', p_brand, '"]') ELSE 'none' END AS links,
        CASE WHEN p_size % 5 = 0 THEN concat('["', p_name, '","', p_name, '"]') ELSE 'none' END
            AS scores FROM part)
    SELECT item_key, 1 AS call_no, 'domain_family' AS label,
        concat('Item ', item_key, ': ', description, chr(10), 'Answer with JSON.') AS prompt FROM s
    UNION ALL SELECT item_key, 3, 'basics', concat(item_key, ' has ', labels) FROM s
    UNION ALL SELECT item_key, 4, 'summary', concat('Text: ', text) FROM s
    UNION ALL SELECT item_key, 6, 'metadata', concat(links, ' / ', scores, ' / ', labels) FROM s""")
def prompt_build(spark, sf_dir):
    return prompts_long(build_prompts(_prompt_items(spark, sf_dir), TEMPLATES))


# ---- inference -------------------------------------------------------------------------------

class StubClient:
    """Answers that depend on the item's number alone; some calls fail."""

    def complete(self, call_no: int, label: str, prompt: str) -> str:
        i = int(re.match(r"Item: (\d+)", prompt).group(1))
        if (call_no == 3 and i % 17 == 0) or (call_no == 6 and i % 5 == 0):
            raise TimeoutError("no answer")
        return json.dumps({
            1: {"domain": ["nlp", "Code", " LAW ", "cooking"][i % 4],
                "model_family": ["codellama", "Dolphin", "dolphin", "?"][i % 4]},
            2: {"use_cases": [["rag", "Math", "analysis", "rag"], ["nothing"]][i % 2]},
            3: {"languages": [["english", "french"], ["english"], ["German", "mandarin"]][i % 3],
                "complexity": ["easy", "HARD", "odd"][i % 3], "is_fine_tuned": i % 2 == 0,
                "is_uncensored": i % 7 == 0},
            4: {"best_for": "short" if i % 19 == 0 else f"Useful for item {i}",
                "license": None if i % 2 else "MIT"},
            5: {"strengths": ["a", "b"], "limitations": [],
                "target_audience": [["developer", "Students"], ["none"]][i % 2]},
            6: {"creator_org": "Unknown" if i % 3 == 0 else f"Org{i % 10}",
                "is_multimodal": i % 2 == 1, "base_model": None, "huggingface_url": f"https://x/{i}",
                "benchmark_scores": [{"name": "S", "score": i % 100 + 0.5, "unit": "%"}],
                "parameter_sizes": ["7B"]},
        }[call_no])


def _answers(spark, sf_dir):
    none = F.lit(None)
    items = text_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("item_key"), F.col("lang").alias("description"),
        F.array("source").alias("labels"), F.col("text").alias("readme"),
        none.cast("string").alias("main_content"),
        none.cast("array<string>").alias("hf_links"),
        none.cast("array<string>").alias("benchmark_mentions"),
    )
    return run_calls(build_prompts(items), StubClient, partitions=8)


@check("infer_merge", """
    WITH t AS (SELECT doc_id AS i, doc_id % 17 <> 0 AND doc_id % 19 <> 0 AS ok,
        doc_id % 5 <> 0 AS six FROM documents)
    SELECT CAST(i AS VARCHAR) AS item_key, ok,
        CASE WHEN ok THEN ['Language', 'Code', 'Legal', 'General'][i % 4 + 1] END AS domain,
        CASE WHEN ok THEN ['Llama', 'Dolphin', 'Phi', 'Other'][i % 4 + 1] END AS model_family,
        CASE WHEN ok THEN ['RAG / Retrieval|Math|Data Analysis', 'Chat Assistant'][i % 2 + 1] END
            AS use_cases,
        CASE WHEN ok THEN ['French', 'English', 'German|Chinese'][i % 3 + 1] END AS ai_languages,
        CASE WHEN ok THEN ['beginner', 'advanced', 'intermediate'][i % 3 + 1] END AS complexity,
        CASE WHEN ok THEN i % 2 = 0 END AS is_fine_tuned,
        CASE WHEN ok THEN i % 7 = 0 END AS is_uncensored,
        CASE WHEN ok THEN concat('Useful for item ', i) END AS best_for,
        CASE WHEN ok AND i % 2 = 0 THEN 'MIT' END AS license,
        CASE WHEN ok THEN 'a|b' END AS strengths,
        CASE WHEN ok THEN '' END AS limitations,
        CASE WHEN ok THEN ['Developers|Students', 'Developers'][i % 2 + 1] END AS target_audience,
        CASE WHEN ok AND six AND i % 3 <> 0 THEN concat('Org', i % 10) END AS creator_org,
        CASE WHEN ok THEN six AND i % 2 = 1 END AS is_multimodal,
        CASE WHEN ok AND six THEN concat('https://x/', i) END AS huggingface_url,
        CASE WHEN ok AND six THEN CAST(i % 100 + 0.5 AS DOUBLE) END AS score,
        CASE WHEN ok AND six THEN '7B' END AS parameter_sizes,
        CASE WHEN i % 17 = 0 THEN 3 WHEN i % 19 = 0 THEN 4 ELSE 6 END AS n_calls
    FROM t""")
def infer_merge(spark, sf_dir):
    # Calls and merge in one plan, which uses the responses once; a run writes them first.
    responses = _answers(spark, sf_dir)
    merged = merge_answers(responses.withColumn(
        "item_key", F.concat_ws(":", "item_key", F.size("responses"))
    ))
    lists = ["use_cases", "ai_languages", "strengths", "limitations", "target_audience",
             "parameter_sizes"]
    return merged.select(
        F.split_part("item_key", F.lit(":"), F.lit(1)).alias("item_key"),
        F.split_part("item_key", F.lit(":"), F.lit(2)).cast("int").alias("n_calls"),
        "ok", "domain", "model_family", "complexity", "is_fine_tuned", "is_uncensored", "best_for",
        "license", "creator_org", "is_multimodal", "huggingface_url",
        F.get("benchmark_scores", F.lit(0))["score"].alias("score"),
        *[F.when(F.col(c).isNotNull(), joined(c)).alias(c) for c in lists],
    )


@check("infer_summary", """
    WITH t AS (SELECT doc_id % 17 <> 0 AND doc_id % 19 <> 0 AS ok FROM documents)
    SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed
    FROM t""")
def infer_totals(spark, sf_dir):
    return infer_summary(merge_answers(_answers(spark, sf_dir)))


RAW_JSON = """CASE event_id % 7
    WHEN 0 THEN concat('{"best_for": "', event_type, ' of ', user_id, '", "license": "MIT"}')
    WHEN 1 THEN concat('{"best_for": "users who ', event_type, '", "license": null, "x": 1}')
    WHEN 2 THEN concat('{"license": "', event_type, '"}')
    WHEN 3 THEN concat('{"best_for": "users who ', event_type)
    WHEN 4 THEN concat('{"best_for": ', user_id, ', "license": ["MIT"]}')
    WHEN 5 THEN concat('"', event_type, '"')
    ELSE concat('{"best_for": "', event_type, repeat(' and more', 40), '"}') END"""


@check("structured_parse", f"""
    WITH t AS (SELECT event_id, {RAW_JSON} AS raw FROM events),
    j AS (SELECT event_id, json_valid(raw) AND left(raw, 1) = '{{' AS obj,
        CASE WHEN json_valid(raw) THEN json_type(raw, '$.best_for') END AS bt,
        CASE WHEN json_valid(raw) THEN json_type(raw, '$.license') END AS lt,
        CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.best_for') END AS b,
        CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.license') END AS l FROM t),
    v AS (SELECT *, CASE WHEN NOT obj THEN ['not an object'] ELSE list_filter([
        CASE WHEN bt <> 'VARCHAR' AND bt <> 'NULL' THEN 'best_for: wrong type' END,
        CASE WHEN bt IS NULL OR bt = 'NULL' THEN 'best_for: missing' END,
        CASE WHEN bt = 'VARCHAR' AND length(b) < 10 THEN 'best_for: too short' END,
        CASE WHEN bt = 'VARCHAR' AND length(b) > 300 THEN 'best_for: too long' END,
        CASE WHEN lt <> 'VARCHAR' AND lt <> 'NULL' THEN 'license: wrong type' END],
        lambda x: x IS NOT NULL) END AS v FROM j)
    SELECT event_id, len(v) = 0 AS is_valid, array_to_string(v, '; ') AS violations,
        CASE WHEN len(v) = 0 THEN b END AS best_for, CASE WHEN len(v) = 0 THEN l END AS license
    FROM v""")
def structured_parse(spark, sf_dir):
    parsed = parse_answer(F.expr(RAW_JSON), ANSWERS[3])
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("p")).select(
        "event_id", "p.is_valid", joined("p.violations", "; ").alias("violations"),
        "p.value.best_for", "p.value.license",
    )


@check("writeback", """
    SELECT CAST(d.doc_id AS VARCHAR) AS item_key, CASE WHEN l.doc_id IS NULL THEN 'old'
            ELSE concat('q', quality) END AS domain,
        CASE WHEN l.doc_id IS NULL THEN NULL ELSE toxic = 1 END AS is_uncensored,
        CAST(CASE WHEN l.doc_id IS NULL THEN 1 ELSE 3 END AS INTEGER) AS enrich_version,
        CASE WHEN l.doc_id IS NULL THEN TRUE END AS validated,
        CAST(d.doc_id % 4 AS INTEGER) AS validation_retries
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def writeback(spark, sf_dir):
    catalog = cat.conform(
        text_table(spark, sf_dir, "documents"), item_key=F.col("doc_id"), domain=F.lit("old"),
        enrich_version=F.lit(1), validated=F.lit(True), validation_retries=F.col("doc_id") % 4,
    )
    enrichment = cat.conform(
        table(spark, sf_dir, "labels"), item_key=F.col("doc_id"),
        domain=F.expr("concat('q', quality)"), is_uncensored=F.expr("toxic = 1"),
    )
    return cat.enrichment_writeback(catalog, enrichment, 3).select(
        "item_key", "domain", "is_uncensored", "enrich_version", "validated", "validation_retries"
    )


# ---- quality ---------------------------------------------------------------------------------

_QUALITY_ITEM = {
    "domain": "nullif(lang, 'de')",
    "use_cases": "CASE n_chars % 3 WHEN 0 THEN {empty} WHEN 1 THEN {one} END",
    "ai_languages": "CASE WHEN doc_id % 17 <> 0 THEN {one} ELSE {empty} END",
    "complexity": "nullif(source, 'src1')",
    # The whole text without small letters: short enough for the length rule in part of the rows.
    "best_for": "translate(text, 'abcdefghijklmnopqrstuvwxyz ,', '')",
    "strengths": "CASE WHEN n_chars % 7 <> 0 THEN {one} END",
    "limitations": "CASE WHEN doc_id % 11 <> 0 THEN {empty} END",
    "model_family": "CASE WHEN doc_id % 13 <> 0 THEN lang END",
    "target_audience": "CASE WHEN doc_id % 19 <> 0 THEN {one} END",
    "enrich_version": "CASE WHEN doc_id % 10 <> 9 THEN 2 END",
    "validated": "CASE doc_id % 6 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
    "validation_failed": "CASE doc_id % 9 WHEN 2 THEN TRUE WHEN 3 THEN FALSE END",
    "validation_retries": "CAST(nullif(doc_id % 6, 5) AS INT)",
}


def _quality_items(spark, sf_dir):
    words = {"empty": "CAST(array() AS array<string>)", "one": "array(lang)"}
    columns = {k: F.expr(v.format(**words)) for k, v in _QUALITY_ITEM.items()}
    return cat.conform(text_table(spark, sf_dir, "documents"), item_key=F.col("doc_id"), **columns)


_ITEMS_SQL = "q AS (SELECT CAST(doc_id AS VARCHAR) AS item_key, " + ", ".join(
    f"{v.format(empty='[]::VARCHAR[]', one='[lang]')} AS {k}" for k, v in _QUALITY_ITEM.items()
) + """ FROM documents),
    f AS (SELECT *, list_filter([
        CASE WHEN domain IS NULL THEN 'domain: domain must not be null' END,
        CASE WHEN coalesce(len(use_cases), 0) < 1
            THEN 'use_cases: use_cases must have at least 1 item' END,
        CASE WHEN coalesce(len(ai_languages), 0) < 1
            THEN 'ai_languages: ai_languages must have at least 1 item' END,
        CASE WHEN complexity IS NULL THEN 'complexity: complexity must not be null' END,
        CASE WHEN length(best_for) < 10 THEN 'best_for: best_for must be at least 10 chars' END,
        CASE WHEN coalesce(len(strengths), 0) < 1
            THEN 'strengths: strengths must have at least 1 item' END,
        CASE WHEN limitations IS NULL THEN 'limitations: limitations must not be null' END,
        CASE WHEN model_family IS NULL THEN 'model_family: model_family must not be null' END,
        CASE WHEN coalesce(len(target_audience), 0) < 1
            THEN 'target_audience: target_audience must have at least 1 item' END],
        lambda x: x IS NOT NULL) AS f FROM q),
    o AS (SELECT *, CASE WHEN enrich_version IS NULL THEN NULL WHEN validated THEN 'skip_valid'
        WHEN validation_failed THEN 'skip_failed' WHEN len(f) = 0 THEN 'valid'
        WHEN coalesce(validation_retries, 0) < 3 THEN 're_queued' ELSE 'failed' END AS outcome
        FROM f)"""


@check("rule_failures", f"""WITH {_ITEMS_SQL}
    SELECT item_key, len(f) = 0 AS is_valid, array_to_string(f, '; ') AS failure_text FROM o""")
def rule_failures(spark, sf_dir):
    return rule_validate(_quality_items(spark, sf_dir)).select(
        "item_key", "is_valid", "failure_text"
    )


@check("validation_transition", f"""WITH {_ITEMS_SQL}
    SELECT item_key, outcome,
        CAST(CASE WHEN outcome = 're_queued' THEN NULL ELSE enrich_version END AS INTEGER)
            AS enrich_version,
        CASE WHEN outcome = 'valid' THEN TRUE WHEN outcome = 're_queued' THEN NULL
            WHEN outcome = 'failed' THEN FALSE ELSE validated END AS validated,
        CASE WHEN outcome IN ('valid', 're_queued') THEN NULL WHEN outcome = 'failed' THEN TRUE
            ELSE validation_failed END AS validation_failed,
        CAST(CASE WHEN outcome = 'valid' THEN 0
            WHEN outcome = 're_queued' THEN coalesce(validation_retries, 0) + 1
            ELSE validation_retries END AS INTEGER) AS validation_retries
    FROM o""")
def validation_states(spark, sf_dir):
    return validation_transition(_quality_items(spark, sf_dir)).select(
        "item_key", "outcome", "enrich_version", "validated", "validation_failed",
        "validation_retries",
    )


@check("validation_summary", f"""WITH {_ITEMS_SQL}
    SELECT count(outcome) AS total, count(*) FILTER (outcome IN ('skip_valid', 'valid')) AS valid,
        count(*) FILTER (outcome IN ('re_queued', 'failed')) AS invalid,
        count(*) FILTER (outcome = 're_queued') AS re_queued,
        count(*) FILTER (outcome IN ('skip_failed', 'failed')) AS failed FROM o""")
def validation_totals(spark, sf_dir):
    return validation_summary(validation_transition(_quality_items(spark, sf_dir)))


# ---- export and comparison -------------------------------------------------------------------

def _export_catalog(spark, sf_dir):
    e = F.expr
    return cat.conform(
        table(spark, sf_dir, "part"), item_key=e("concat('p', p_partkey)"),
        item_name=F.col("p_name"), pulls=e("CAST(p_retailprice * 10 AS BIGINT)"),
        labels=e("CASE WHEN p_size % 3 <> 0 THEN array(p_brand, p_type) END"),
        readme=e("CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN '' END"),
        memory_requirements=e("CASE WHEN p_size % 5 = 0 THEN array(named_struct('tag', p_name, "
                              "'size', '', 'size_gb', 1D, 'recommended_ram_gb', 1D, "
                              "'quantization', '', 'context', '', 'context_window', 1L)) END"),
        last_updated=e("CASE WHEN p_size % 2 = 0 THEN date_add(DATE '2024-01-01', p_size) END"),
        timestamp=e("timestamp_millis(1704067200000 + p_partkey * 500)"),
        enrich_version=e("CASE WHEN p_size % 10 <> 0 THEN 1 END"),
        validated=e("CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END"),
        validation_failed=e("CASE p_size % 6 WHEN 0 THEN true WHEN 1 THEN false END"),
        is_uncensored=e("CASE p_size % 7 WHEN 0 THEN true WHEN 1 THEN false END"),
    )


@check("export_ranked", """
    SELECT concat('p', p_partkey) AS item_key, p_name AS item_name,
        CAST(trunc(p_retailprice * 10) AS BIGINT) AS pulls,
        CASE WHEN p_size % 3 <> 0 THEN concat(p_brand, '|', p_type) ELSE '' END AS labels,
        0 AS n_use_cases, CAST(CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_specs,
        CASE WHEN p_size % 2 = 0 THEN strftime(DATE '2024-01-01' + CAST(p_size AS INTEGER),
            '%Y-%m-%d') END AS last_updated,
        concat(strftime(TIMESTAMP '2024-01-01' + to_seconds(p_partkey // 2), '%Y-%m-%dT%H:%M:%S'),
            CASE WHEN p_partkey % 2 = 1 THEN '.500000' ELSE '' END) AS stamp,
        CASE p_size % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS validated
    FROM part WHERE p_size % 10 <> 0""")
def export_ranked(spark, sf_dir):
    return ranked(export_rows(_export_catalog(spark, sf_dir))).select(
        "item_key", "item_name", "pulls", joined("labels").alias("labels"),
        F.size("use_cases").alias("n_use_cases"), F.size("memory_requirements").alias("n_specs"),
        "last_updated", F.col("timestamp").alias("stamp"), "validated",
    )


@check("export_file", """
    SELECT concat('p', p_partkey) AS item_key, CAST(trunc(p_retailprice * 10) AS BIGINT) AS pulls,
        CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN '' END AS readme,
        CASE WHEN p_size % 3 <> 0 THEN concat(p_brand, '|', p_type) ELSE '' END AS labels,
        row_number() OVER (ORDER BY trunc(p_retailprice * 10) DESC, concat('p', p_partkey)) AS rank
    FROM part WHERE p_size % 10 <> 0""")
def export_file(spark, sf_dir):
    """The export written, read back, and ranked by where each row stands in its files."""
    path = local_or_shared_root(spark, "export")
    write_export(_export_catalog(spark, sf_dir), path)
    rows = read_export(spark, path).select(
        "item_key", "pulls", "readme", joined("labels").alias("labels"),
        F.col("_metadata.file_name").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"))
    in_file = rows.withColumn("row", F.row_number().over(
        Window.partitionBy("file").orderBy("place")))
    # One row per file: files come in rank order.
    before = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", (F.sum("n").over(
        Window.orderBy("file")) - F.col("n")).alias("before"))
    return in_file.join(before, "file").select(
        "item_key", "pulls", "readme", "labels", (F.col("row") + F.col("before")).alias("rank"))


@check("export_stats", """
    SELECT count(*) AS total, count(*) AS enriched, count(*) FILTER (p_size % 3 = 0) AS validated,
        count(*) FILTER (p_size % 6 = 0) AS validation_failed, count(*) AS exported,
        count(*) FILTER (p_size % 4 = 0) AS with_readme,
        count(*) FILTER (p_size % 5 = 0) AS with_memory,
        count(*) FILTER (p_size % 7 = 0) AS uncensored
    FROM part WHERE p_size % 10 <> 0""")
def export_totals(spark, sf_dir):
    return export_stats(export_rows(_export_catalog(spark, sf_dir)))


@check("snapshot_diff", """
    WITH n AS (SELECT o_orderkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
    p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
    SELECT (SELECT count(*) FROM n) AS total,
        (SELECT count(DISTINCT k) FROM n WHERE k NOT IN (SELECT k FROM p)) AS new,
        (SELECT count(DISTINCT k) FROM n WHERE k IN (SELECT k FROM p)) AS common,
        (SELECT count(DISTINCT k) FROM p WHERE k NOT IN (SELECT k FROM n)) AS removed""")
def diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return snapshot_diff(
        orders.filter("o_orderdate >= '1996-01-01'"), orders.filter("o_orderdate < '2000-01-01'"),
        key="o_orderkey",
    )


def _snapshots(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    return orders, orders.withColumn(
        "o_totalprice", F.expr("CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 "
                               "ELSE o_totalprice END")
    )


@check("no_change_gate", """
    SELECT 2 * count(*) AS changed_rows, count(*) = 0 AS unchanged FROM orders
    WHERE o_orderstatus = 'P'""")
def gate(spark, sf_dir):
    new, previous = _snapshots(spark, sf_dir)
    return no_change_gate(new, previous)


@check("no_change_gate_ignoring", """
    SELECT 0 * count(*) AS changed_rows, count(*) >= 0 AS unchanged FROM orders""")
def gate_ignoring(spark, sf_dir):
    new, previous = _snapshots(spark, sf_dir)
    return no_change_gate(new, previous, ignore=["o_totalprice"])


# ---- a whole run -----------------------------------------------------------------------------

class KeyedClient:
    """Answers by the length of the item's key: some items never get call 2, some no license."""

    def complete(self, call_no: int, label: str, prompt: str) -> str:
        key = prompt.split("\n", 1)[0][len("Item: "):]
        n = len(key)
        if call_no == 2 and n % 5 == 0:
            raise TimeoutError("no answer")
        return json.dumps({
            1: {"domain": "Code", "model_family": "phi"},
            2: {"use_cases": ["rag"]},
            3: {"languages": ["french"], "complexity": "easy", "is_fine_tuned": False,
                "is_uncensored": False},
            4: {"best_for": "people who like " + key, "license": None if n % 3 == 0 else "MIT"},
            5: {"strengths": ["x"], "limitations": [], "target_audience": ["Students"]},
            6: {"is_multimodal": False},
        }[call_no])


LICENSED = Rule("license", "license IS NOT NULL", "license must be known")


def _run(spark, sf_dir, **options):
    """Crawl all pages and run every stage; an item's detail page is the page that lists it."""
    pages = text_table(spark, sf_dir, "pages").select("page_id", "html")
    links = first_per_key(listing_anchors(pages, "/"), "item_key", ["page_id", "pos"])
    details = links.select("item_key", "page_id").join(pages, "page_id").select("item_key", "html")
    store = SnapshotStore(spark, local_or_shared_root(spark, "refresh"))
    run = Refresh(
        store, Site("https://example.org", "/", "go"), KeyedClient, "2024-02-01 00:00:00",
        Options(rules=(*DEFAULT_RULES, LICENSED), **options),
    )
    return run, run.run(pages, details)


@check("refresh_cycle", f"""WITH {ANCHORS_SQL},
    s AS (SELECT item_key, length(item_key) AS n FROM f)
    SELECT item_key, concat('https://example.org/', item_key) AS url,
        CASE WHEN n % 5 = 0 THEN NULL ELSE 'Code' END AS domain,
        CAST(CASE WHEN n % 5 = 0 OR n % 3 = 0 THEN NULL ELSE 1 END AS INTEGER) AS enrich_version,
        CASE WHEN n % 5 = 0 OR n % 3 = 0 THEN NULL ELSE TRUE END AS validated,
        CAST(CASE WHEN n % 5 <> 0 AND n % 3 = 0 THEN 2 ELSE 0 END AS INTEGER)
            AS validation_retries
    FROM s""")
def refresh_cycle(spark, sf_dir):
    run, _ = _run(spark, sf_dir)
    return run.catalog().select(
        "item_key", "url", "domain", "enrich_version", "validated", "validation_retries"
    )


@check("default_vocabularies", """
    WITH v AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN concat('mixtral ', p_name)
        WHEN 1 THEN concat(p_type, '-Codellama') WHEN 2 THEN 'BERT' ELSE p_name END AS v FROM part)
    SELECT p_partkey, CASE WHEN v = 'BERT' THEN 'BERT' WHEN contains(lower(v), 'llama') THEN 'Llama'
        WHEN contains(lower(v), 'mixtral') THEN 'Mistral' ELSE 'Other' END AS family,
        CASE WHEN p_partkey % 2 = 0 THEN 'Students|Developers' ELSE 'Developers' END AS audience
    FROM v JOIN part USING (p_partkey)""")
def default_vocabularies(spark, sf_dir):
    value = F.expr("CASE p_size % 4 WHEN 0 THEN concat('mixtral ', p_name) WHEN 1 THEN "
                   "concat(p_type, '-Codellama') WHEN 2 THEN 'BERT' ELSE p_name END")
    audience: Column = F.when(
        F.col("p_partkey") % 2 == 0, F.array(F.lit("student"), F.col("p_name"), F.lit("Developers"))
    ).otherwise(F.array("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", map_family(value).alias("family"),
        joined(map_audience(audience)).alias("audience"),
    )
