"""Rules that raise, change feeds, replayed states and many crawls, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.extraction import joined
from checks.registry import check, table, text_table
from checks.tables import REPARSE_HTML, StubClient, _known, _stored_catalog
from stratalog.functions.guarded import field, given, total, when
from stratalog.operators import catalog as cat
from stratalog.operators.answers import ANSWER_ROWS, ANSWER_SCHEMA, run_stored_calls
from stratalog.operators.merging import upsert_many
from stratalog.operators.quality import Rule, rule_validate
from stratalog.operators.replay import validation_replay
from stratalog.operators.rereading import READ_ROWS, READ_SCHEMA, reparse_changed
from stratalog.plans.refresh import local_or_shared_root
from stratalog.plans.requeue import requeue_loop
from stratalog.schema import ANSWERS
from stratalog.sources.digests import bag_digest, change_feed, same_bag, without, write_digests
from stratalog.sources.snapshots import SnapshotStore

# ---- rules that raise ------------------------------------------------------------------------

_RAISING_ITEM = {
    "amount": "CASE event_id % 5 WHEN 0 THEN concat('', event_id) WHEN 1 THEN 'n/a' WHEN 2 THEN NULL "
              "WHEN 3 THEN concat(event_id, 'x') ELSE '12' END",
    "parts": "event_id % 4",
    "big": "9223372036854775807 - event_id % 3",
    "kind": "nullif(event_type, 'view')",
}

RAISING_RULES = (
    Rule("amount", lambda: field("amount").cast("bigint") >= 12, "amount must be 12 or more"),
    Rule("parts", lambda: field("user_id") / field("parts") > 20,
         "parts must leave more than 20 each"),
    Rule("parts", lambda: (field("parts") != 0) & (field("user_id") / field("parts") > 20),
         "parts are known"),
    Rule("words", lambda: field("words")[field("parts") - 1] != "error",
         "words must not end in an error"),
    Rule("big", lambda: field("big") + 1 > 0, "big must leave room"),
    Rule("kind", lambda: when(field("kind").is_null(), given(1) / 0 > 0,
                              total(F.length, field("kind")) > 4), "kind must be a long word"),
    Rule("user_id", "user_id % 7 <> 0", "user_id must not be round"),
)


@check("rules_that_raise", f"""
    WITH v AS (SELECT event_id, user_id, event_type, {', '.join(
        f"{sql} AS {name}" for name, sql in _RAISING_ITEM.items())} FROM events),
    -- Two words from the fourth event type on, none else.
    w AS (SELECT *, event_id % 3 AS n_words FROM v),
    f AS (SELECT event_id, list_filter([
        CASE WHEN event_id % 5 IN (1, 3) THEN concat('amount: rule check errored (value=''',
                CASE event_id % 5 WHEN 1 THEN 'n/a' ELSE concat(event_id, 'x') END, ''')')
            WHEN event_id % 5 = 2 OR event_id % 5 = 0 AND event_id < 12
            THEN 'amount: amount must be 12 or more' END,
        CASE WHEN event_id % 4 = 0 THEN 'parts: rule check errored (value=0)'
            WHEN user_id / (event_id % 4) <= 20 THEN 'parts: parts must leave more than 20 each' END,
        CASE WHEN event_id % 4 = 0 THEN 'parts: parts are known'
            WHEN user_id / (event_id % 4) <= 20 THEN 'parts: parts are known' END,
        -- words[parts - 1] of n_words words: index -1 is the last one.
        CASE WHEN CASE WHEN event_id % 4 = 0 THEN n_words = 0 ELSE event_id % 4 - 1 >= n_words END
            THEN concat('words: rule check errored (value=[',
                array_to_string(list_transform(range(n_words), lambda x: event_type), ', '), '])')
            WHEN event_type = 'error' THEN 'words: words must not end in an error' END,
        CASE WHEN event_id % 3 = 0 THEN 'big: rule check errored (value=9223372036854775807)' END,
        CASE WHEN event_type = 'view' THEN 'kind: rule check errored (value=None)'
            WHEN length(event_type) <= 4 THEN 'kind: kind must be a long word' END,
        CASE WHEN user_id % 7 = 0 THEN 'user_id: user_id must not be round' END],
        lambda x: x IS NOT NULL) AS f FROM w)
    SELECT event_id, len(f) = 0 AS is_valid, array_to_string(f, '; ') AS failure_text FROM f""")
def rules_that_raise(spark, sf_dir):
    items = table(spark, sf_dir, "events").withColumns(
        {name: F.expr(sql) for name, sql in _RAISING_ITEM.items()})
    items = items.withColumn("words", F.array_repeat("event_type", F.expr("int(event_id % 3)")))
    return rule_validate(items, RAISING_RULES).select("event_id", "is_valid", "failure_text")


# ---- change feed and stored gate -------------------------------------------------------------

_FEED_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

#: What happened to the orders between two snapshots: some keys went, some came, some changed.
_FEED_SQL = {
    "old": "SELECT {columns} FROM orders WHERE o_orderkey % 1000 <> 1",
    "new": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 3 THEN NULL ELSE o_orderstatus "
           "END AS o_orderstatus, CASE WHEN o_orderkey % 500 = 3 THEN o_totalprice + 1 ELSE "
           "o_totalprice END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 1000 <> 2",
}


def _feed_side(spark, sf_dir, side):
    """The snapshots as DataFrames, by the functions that Spark has for the same."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    if side == "old":
        return orders.filter(key % 1000 != 1).select(*_FEED_COLUMNS)
    return orders.filter(key % 1000 != 2).withColumns({
        "o_orderstatus": F.when(key % 1000 != 3, F.col("o_orderstatus")),
        "o_totalprice": F.col("o_totalprice") + F.when(key % 500 == 3, 1).otherwise(0),
    }).select(*_FEED_COLUMNS)


def written_feed(spark, sf_dir):
    """Digests of both snapshots."""
    root = local_or_shared_root(spark, "feed")
    for side in ("old", "new"):
        write_digests(_feed_side(spark, sf_dir, side), f"{root}/{side}", "o_orderkey")
    return f"{root}/new", f"{root}/old"


@check("change_feed", f"""
    WITH o AS ({_FEED_SQL['old'].format(columns=', '.join(_FEED_COLUMNS))}), n AS ({_FEED_SQL['new']}),
    m AS (SELECT coalesce(n.o_orderkey, o.o_orderkey) AS key,
        CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed'
            ELSE 'changed' END AS kind,
        list_filter([
            CASE WHEN n.o_custkey IS DISTINCT FROM o.o_custkey THEN 'o_custkey' END,
            CASE WHEN n.o_orderpriority IS DISTINCT FROM o.o_orderpriority THEN 'o_orderpriority' END,
            CASE WHEN n.o_orderstatus IS DISTINCT FROM o.o_orderstatus THEN 'o_orderstatus' END,
            CASE WHEN n.o_totalprice IS DISTINCT FROM o.o_totalprice THEN 'o_totalprice' END],
            lambda x: x IS NOT NULL) AS c
        FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey)
    SELECT key, kind, CASE WHEN kind = 'changed' THEN array_to_string(c, '|') END AS columns
    FROM m WHERE kind <> 'changed' OR len(c) > 0""")
def feed(spark, sf_dir):
    found = change_feed(spark, *written_feed(spark, sf_dir))
    return found.select("key", "kind", joined("columns").alias("columns"))


@check("stored_gate", f"""
    WITH o AS ({_FEED_SQL['old'].format(columns=', '.join(_FEED_COLUMNS))}), n AS ({_FEED_SQL['new']})
    SELECT (SELECT count(*) FROM o) AS stored_rows, (SELECT count(*) FROM n) AS new_rows,
        (SELECT count(*) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)) = 0
            AND (SELECT count(*) FROM o) = (SELECT count(*) FROM n) AS unchanged,
        TRUE AS unchanged_in_other_order, FALSE AS unchanged_but_repeated,
        TRUE AS unchanged_after_taking_back""")
def stored_gate(spark, sf_dir):
    """The gate over sums that are kept with each snapshot. They are gathered here by one aggregate a
    snapshot; ``digests.bag_digest`` gives the same while a snapshot is written."""
    old, new = (_feed_side(spark, sf_dir, side) for side in ("old", "new"))
    some = old.filter("o_orderstatus = 'F'")

    def sums(rows):
        return rows.agg(*bag_digest(old)).first().asDict()

    stored, now = sums(old), sums(new)
    turned, twice, more = (sums(r) for r in (
        old.orderBy(F.desc("o_totalprice")), old.unionAll(some), some))
    return spark.range(1).select(
        *[F.lit(n["rows"]).cast("bigint").alias(c) for n, c in ((stored, "stored_rows"), (now, "new_rows"))],
        F.lit(same_bag(stored, now)).alias("unchanged"),
        F.lit(same_bag(stored, turned)).alias("unchanged_in_other_order"),
        F.lit(same_bag(stored, twice)).alias("unchanged_but_repeated"),
        F.lit(same_bag(stored, without(twice, more))).alias("unchanged_after_taking_back"))


# ---- histories -------------------------------------------------------------------------------

@check("validation_replay", """
    WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key, event_id // 7 AS run,
        bit_or(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END
            | CASE WHEN event_id % 4 = 1 THEN 0 WHEN value > 12 THEN 2 ELSE 4 END) AS code
        FROM events GROUP BY ALL),
    h AS (SELECT key, list(code ORDER BY run) AS codes FROM e GROUP BY key),
    c AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 100 END
            + CASE c_custkey % 7 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE 0 END AS state,
        c_custkey % 6 AS r FROM customer),
    m AS (SELECT coalesce(h.key, c.key) AS key, coalesce(codes, []) AS codes,
        coalesce(state, 0) + coalesce(r, 0) AS s FROM h FULL JOIN c ON h.key = c.key),
    -- Hundreds: enriched; tens: 1 valid, 2 given up; ones: retries.
    f AS (SELECT key, list_reduce(list_prepend(s, list_transform(codes, lambda x: x::BIGINT)),
        lambda s, e: CASE
            WHEN e & 6 = 0 OR (CASE WHEN e & 1 = 1 THEN 100 + s % 10 ELSE s END) // 10 <> 10
                THEN CASE WHEN e & 1 = 1 THEN 100 + s % 10 ELSE s END
            WHEN e & 4 = 0 THEN 110
            WHEN s % 10 < 3 THEN s % 10 + 1
            ELSE 120 + s % 10 END) AS s FROM m)
    SELECT key, s >= 100 AS is_enriched, CASE s // 10 % 10 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END
        AS validated, CASE WHEN s // 10 % 10 = 2 THEN TRUE END AS validation_failed,
        (s % 10)::INTEGER AS validation_retries FROM f""")
def replay(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END").alias("key"),
        F.expr("event_id div 7").alias("run"), (F.col("event_type") == "click").alias("enriched"),
        F.when(F.col("event_id") % 4 != 1, F.col("value") > 12).alias("passed"))
    catalog = _known(spark, sf_dir).select(
        F.col("c_custkey").alias("key"), (F.col("c_custkey") % 4 != 0).alias("is_enriched"),
        F.expr("c_custkey % 7 = 1").alias("validated"),
        F.expr("c_custkey % 7 = 2").alias("validation_failed"),
        F.expr("int(c_custkey % 6)").alias("validation_retries"))
    return validation_replay(events, catalog)


# ---- many crawls -----------------------------------------------------------------------------

_CRAWLS = 4
_STAMP = "TIMESTAMP '2024-02-0{day} 00:00:00'"


def _crawl_sql(number):
    """Crawl ``number``, one row a customer with orders of its share; the last repeats the first."""
    share = number % (_CRAWLS - 1)
    return f"""SELECT concat('c', o_custkey + 100) AS item_key, count(*) AS n,
        CAST(max(o_orderdate) AS DATE) AS d FROM orders WHERE o_orderkey % 3 = {share}
        GROUP BY o_custkey"""


_N_COLUMNS = f"""'crawl ' || n.n || '/{{number}}' AS item_name,
    CASE WHEN n.n % 2 = 0 THEN 'desc ' || n.n END AS description,
    CASE WHEN n.n % 3 = 0 THEN '' ELSE 'l' || n.n END AS labels,
    CASE n.n % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS hint, n.n % 2 = 1 AS has_detail,
    n.n AS pulls, n.d AS last_updated, CASE WHEN n.n <> 3 THEN 'new ' || n.n || '/{{number}}' END
        AS readme, CAST(n.n AS DOUBLE) AS min_ram_gb"""


def _step_sql(number):
    share = number % (_CRAWLS - 1)
    return f"""
    n{number} AS (SELECT item_key, {_N_COLUMNS.format(number=share)} FROM ({_crawl_sql(number)}) n),
    c{number + 1} AS (SELECT coalesce(c.item_key, n.item_key) AS item_key,
        CASE WHEN c.item_key IS NULL THEN n.item_name ELSE c.item_name END AS item_name,
        CASE WHEN n.item_key IS NULL THEN c.description ELSE n.description END AS description,
        CASE WHEN n.labels <> '' THEN n.labels WHEN c.item_key IS NULL THEN '' ELSE c.labels END
            AS labels,
        coalesce(c.is_uncensored, n.hint) AS is_uncensored,
        CASE WHEN n.item_key IS NULL THEN c.pulls ELSE n.pulls END AS pulls,
        CASE WHEN n.item_key IS NULL THEN c.last_updated ELSE n.last_updated END AS last_updated,
        CASE WHEN c.item_key IS NULL OR coalesce(n.has_detail, FALSE) THEN n.readme ELSE c.readme END
            AS readme,
        CASE WHEN c.item_key IS NULL OR coalesce(n.has_detail, FALSE) THEN n.min_ram_gb
            ELSE c.min_ram_gb END AS min_ram_gb,
        c.domain, CASE WHEN n.item_key IS NULL THEN c.stamped ELSE DATE '2024-02-0{number + 1}' END
            AS stamped,
        CASE WHEN c.item_key IS NULL THEN 'inserted' WHEN c.action = 'inserted' THEN 'inserted'
            WHEN n.item_key IS NULL THEN c.action ELSE 'updated' END AS action
        FROM c{number} c FULL JOIN n{number} n ON c.item_key = n.item_key)"""


@check("upsert_many", f"""
    WITH c0 AS (SELECT concat('c', c_custkey) AS item_key, c_name AS item_name,
        c_mktsegment AS description, c_mktsegment AS labels,
        CASE c_nationkey % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS is_uncensored,
        c_custkey AS pulls, DATE '2020-01-01' AS last_updated, 'old readme' AS readme,
        c_acctbal AS min_ram_gb, 'Code' AS domain, DATE '2020-01-01' AS stamped, 'kept' AS action
        FROM customer),{','.join(_step_sql(i) for i in range(_CRAWLS))}
    SELECT * FROM c{_CRAWLS}""")
def many_crawls(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("share", F.col("o_orderkey") % 3)
    n = orders.groupBy("o_custkey", "share").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").cast("date").alias("d"))
    first = n.withColumn("crawl_no", F.col("share").cast("int"))
    again = n.filter("share = 0").withColumn("crawl_no", F.lit(_CRAWLS - 1))
    rows = first.unionByName(again).selectExpr(
        "crawl_no", "concat('c', o_custkey + 100) AS item_key",
        "timestamp(date_add(DATE '2024-02-01', crawl_no)) AS run_ts",
        "concat('crawl ', n, '/', share) AS item_name",
        "CASE WHEN n % 2 = 0 THEN concat('desc ', n) END AS description",
        "CASE WHEN n % 3 = 0 THEN CAST(array() AS array<string>) ELSE array(concat('l', n)) END"
        " AS labels",
        "CASE n % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_uncensored_hint",
        "n % 2 = 1 AS has_detail", "n AS pulls", "1 AS tags", "d AS last_updated",
        "'now' AS last_updated_str", "'Tools' AS capability", "array('Tools') AS capabilities",
        "CASE WHEN n <> 3 THEN concat('new ', n, '/', share) END AS readme",
        "NULL AS applications", "NULL AS memory_requirements", "double(n) AS min_ram_gb",
        "n * 1000 AS context_window", "'fast' AS speed_tier")
    merged = upsert_many(_stored_catalog(spark, sf_dir), rows, "https://example.org/items", spread=True)
    return merged.select(
        "item_key", "item_name", "description", joined("labels").alias("labels"), "is_uncensored",
        "pulls", "last_updated", "readme", "min_ram_gb", "domain",
        F.to_date("timestamp").alias("stamped"), F.col(cat.ACTION).alias("action"))


# ---- asking again ----------------------------------------------------------------------------

#: An item's answer is good from its n-th time on; some items are left out of the first pass.
_NEEDS, _LEFT_OUT = "doc_id % 6", "doc_id % 5 = 4"


def _requeue(spark, sf_dir, passes, scope):
    docs = text_table(spark, sf_dir, "documents").select("doc_id")
    items = cat.conform(
        docs, item_key=F.col("doc_id"), validation_retries=F.lit(0),
        enrich_version=F.expr(f"CASE WHEN NOT {_LEFT_OUT} THEN 1 END"),
        domain=F.expr(f"CASE WHEN NOT {_LEFT_OUT} AND {_NEEDS} = 0 THEN 'Code' END"))
    root = local_or_shared_root(spark, "requeue")

    def enrich(stale, pass_no):
        good = F.col("item_key").cast("bigint") % 6 <= pass_no
        return stale.withColumns({
            "domain": F.when(good, "Code"), "enrich_version": F.lit(1),
            "validated": F.lit(None).cast("boolean"),
            "validation_failed": F.lit(None).cast("boolean")})

    def write(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    rules = [Rule("domain", "domain IS NOT NULL", "domain must not be null")]
    out = requeue_loop(items, enrich, write, 1, passes, scope, rules)
    return out.select(F.lit(scope).alias("scope"), F.lit(passes).alias("passes"), "item_key",
                      "enrich_version", "validated", "validation_failed", "validation_retries")


@check("requeue_loop", f"""
    WITH runs AS (SELECT unnest(['all', 'all', 'all', 'requeued', 'requeued', 'requeued']) AS scope,
        unnest([0, 1, 3, 0, 1, 3]) AS passes),
    -- The checks an item has had: one in the first pass unless it was left out, and one a pass.
    t AS (SELECT scope, passes, doc_id, {_NEEDS} AS needs, {_LEFT_OUT} AS late,
        CASE WHEN {_LEFT_OUT} THEN CASE WHEN scope = 'all' THEN passes ELSE 0 END ELSE passes + 1 END
            AS checks FROM documents, runs),
    -- It is good from pass number ``needs`` on; a late item is first checked in pass 1.
    g AS (SELECT *, checks > 0 AND needs <= passes AS good,
        CASE WHEN late THEN greatest(least(needs, passes + 1) - 1, 0) ELSE least(needs, passes + 1) END
            AS bad FROM t)
    SELECT scope, passes, CAST(doc_id AS VARCHAR) AS item_key,
        CAST(CASE WHEN good OR checks > 0 AND bad > 3 THEN 1 END AS INTEGER) AS enrich_version,
        CASE WHEN good THEN TRUE WHEN checks > 0 AND bad > 3 THEN FALSE END AS validated,
        CASE WHEN NOT good AND checks > 0 AND bad > 3 THEN TRUE END AS validation_failed,
        CAST(CASE WHEN good OR checks = 0 THEN 0 ELSE least(bad, 3) END AS INTEGER)
            AS validation_retries
    FROM g""")
def requeued(spark, sf_dir):
    runs = [_requeue(spark, sf_dir, passes, scope) for scope in ("all", "requeued")
            for passes in (0, 1, 3)]
    out = runs[0]
    for more in runs[1:]:
        out = out.unionByName(more)
    return out


# ---- answers asked once ----------------------------------------------------------------------

#: A third of all documents share one topic, the others have theirs with those of equal hundreds.
_TOPIC = "CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 100 + doc_id % 400 END"


def _topic_prompts(spark, sf_dir):
    calls = F.array(*[F.struct(
        F.lit(a.call_no).alias("call_no"), F.lit(a.label).alias("label"),
        F.concat(F.lit("Item: "), F.col("topic").cast("string"), F.lit("\n"), F.lit(a.label)).alias("prompt"))
        for a in ANSWERS])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("item_key"), F.expr(_TOPIC).alias("topic")
    ).select("item_key", calls.alias("prompts"))


@check("answer_cache", f"""
    WITH t AS (SELECT doc_id, {_TOPIC} AS i FROM documents),
    n AS (SELECT *, CASE WHEN i % 17 = 0 THEN 3 WHEN i % 19 = 0 THEN 4 ELSE 6 END AS n_calls FROM t),
    -- Each topic's calls are asked once; of a second run, those alone that had failed.
    s AS (SELECT sum(n_calls) AS first_asked,
        sum(CASE WHEN n_calls < 6 OR i % 5 = 0 THEN 1 ELSE 0 END) AS second_asked
        FROM (SELECT DISTINCT i, n_calls FROM n))
    SELECT CAST(doc_id AS VARCHAR) AS item_key, CAST(n_calls AS INTEGER) AS n_calls,
        CAST(CASE WHEN n_calls < 6 OR i % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_failed,
        CAST(first_asked AS BIGINT) AS first_asked, CAST(second_asked AS BIGINT) AS second_asked
    FROM n, s""")
def answer_cache(spark, sf_dir):
    store = SnapshotStore(spark, local_or_shared_root(spark, "answers"))
    prompts = _topic_prompts(spark, sf_dir)
    asked = [0]
    for _ in range(2):
        responses = run_stored_calls(prompts, store, StubClient, partitions=8)
        asked.append(store.read_all(ANSWER_ROWS, ANSWER_SCHEMA).count())
    return responses.select(
        "item_key", F.size("responses").alias("n_calls"),
        F.size(F.filter("responses", lambda r: r["error"].isNotNull())).alias("n_failed"),
        F.lit(asked[1]).cast("bigint").alias("first_asked"),
        F.lit(asked[2] - asked[1]).cast("bigint").alias("second_asked"))


# ---- pages read where they have changed ------------------------------------------------------

@check("reparse_incremental", """
    WITH t AS (SELECT page_id, html, page_id % 5 AS v, least(page_id % 5 + 1.5, page_id % 3 + 2) AS gb,
        greatest((page_id % 4 + 1) * 8000, page_id % 6 * 1000000) AS cw FROM pages),
    -- What a page was made from: its markup, and for some a part that the number decides.
    n AS (SELECT count(DISTINCT concat(html, v, CASE WHEN v > 2 THEN page_id % 60 END))
            FILTER (v >= 2) AS first_read,
        count(DISTINCT concat(html, page_id % 60)) FILTER (v = 3) AS second_read FROM t)
    SELECT concat(side, page_id) AS item_key,
        CASE WHEN v < 2 THEN 'old' WHEN v = 2 THEN NULL
            WHEN page_id % 3 = 0 THEN concat('About', chr(10), 'Body & ', page_id)
            WHEN page_id % 3 = 1 THEN concat('Text of ', page_id) END AS readme,
        CAST(CASE WHEN v > 2 THEN 2 END AS INTEGER) AS n_specs,
        CAST(CASE WHEN v > 2 THEN gb ELSE 4.1 END AS DOUBLE) AS min_ram_gb,
        CASE WHEN v < 2 THEN 'skipped' ELSE 'updated' END AS action,
        CAST(first_read AS BIGINT) AS first_read, CAST(second_read AS BIGINT) AS second_read
    FROM t, n, (VALUES ('page-'), ('copy-')) sides(side)""")
def reparse_incremental(spark, sf_dir):
    """All pages, and then the same with a copy of each, a fifth of them with other markup."""
    pages = text_table(spark, sf_dir, "pages").select("page_id", F.expr(REPARSE_HTML).alias("html"))
    sides = F.explode(F.array(F.lit("page-"), F.lit("copy-")))
    both = pages.withColumn("side", sides)
    key = F.concat("side", F.col("page_id").cast("string"))
    catalog = cat.conform(both.select(key.alias("k")), item_key=F.col("k"), readme=F.lit("old"),
                          min_ram_gb=F.lit(4.1))
    changed = F.when(F.col("page_id") % 5 == 3, F.concat("html", F.lit("<!-- again -->")))
    store = SnapshotStore(spark, local_or_shared_root(spark, "readings"))
    read = [0]
    for landed in (
            pages.select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("item_key"), "html"),
            both.select(key.alias("item_key"), F.coalesce(changed, "html").alias("html"))):
        out = reparse_changed(catalog, landed, store, "go")
        read.append(store.read_all(READ_ROWS, READ_SCHEMA).count())
    return out.select(
        "item_key", "readme", F.size("memory_requirements").alias("n_specs"), "min_ram_gb",
        F.col(cat.ACTION).alias("action"), F.lit(read[1]).cast("bigint").alias("first_read"),
        F.lit(read[2] - read[1]).cast("bigint").alias("second_read"))
