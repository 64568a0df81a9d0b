"""Rules that raise, digests and change feeds, replayed states, many crawls at once, asking again."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stratalog.functions import guarded as g
from stratalog.operators import replay as rp
from stratalog.operators.catalog import catalog_upsert, conform
from stratalog.operators.merging import upsert_many
from stratalog.operators.quality import Rule, rule_validate, validation_transition
from stratalog.plans.requeue import requeue_loop
from stratalog.schema import CATALOG_SCHEMA
from stratalog.sources import digests as dg
from tests.test_plans import plan


# ---- rules that raise ------------------------------------------------------------------------

def f(name):
    return g.field(name)


@pytest.mark.parametrize("build,given,want", [
    (lambda: f("s").cast("int") > 3, {"s": "4"}, "ok"),
    (lambda: f("s").cast("int") > 3, {"s": "x"}, "raised"),
    (lambda: f("s").cast("int") > 3, {"s": None}, "failed"),
    (lambda: 1 / f("a") > 0, {"a": 0}, "raised"),
    (lambda: (f("a") != 0) & (1 / f("a") > 0), {"a": 0}, "failed"),
    (lambda: (1 / f("a") > 0) & (f("a") != 0), {"a": 0}, "raised"),
    (lambda: (f("a") == 0) | (1 / f("a") > 0), {"a": 0}, "ok"),
    (lambda: (f("a") != 0) | (1 / f("a") > 0), {"a": 0}, "raised"),
    (lambda: (f("a") > 0) & (1 / f("b") > 0), {"a": None, "b": 0}, "raised"),
    (lambda: f("a") % f("b") == 1, {"a": 5, "b": 0}, "raised"),
    (lambda: f("a") % f("b") == 1, {"a": 5, "b": 2}, "ok"),
    (lambda: f("a") + 1 > 0, {"a": 2**63 - 1}, "raised"),
    (lambda: 1 + f("a") > 0, {"a": 2**63 - 2}, "ok"),
    (lambda: f("a") - 2 < 0, {"a": -2**63 + 1}, "raised"),
    (lambda: 2 - f("a") > 0, {"a": -2**63}, "raised"),
    (lambda: f("a") * 2 > 0, {"a": 2**62}, "raised"),
    (lambda: 2 * f("a") > 0, {"a": 2**61}, "ok"),
    (lambda: f("l")[0] == "x", {"l": ["x"]}, "ok"),
    (lambda: f("l")[-1] == "y", {"l": ["x", "y"]}, "ok"),
    (lambda: f("l")[1] == "x", {"l": ["x"]}, "raised"),
    (lambda: f("l")[-2] == "x", {"l": ["x"]}, "raised"),
    (lambda: f("l")[0] == "x", {"l": []}, "raised"),
    (lambda: f("l")[0] == "x", {"l": [None]}, "failed"),
    (lambda: f("l")[0] == "x", {"l": None}, "failed"),
    (lambda: f("l")[f("a")] == "x", {"l": ["x"], "a": None}, "failed"),
    (lambda: ~(f("l")[3] == "x"), {"l": ["x"]}, "raised"),
    (lambda: g.when(f("a") > 0, f("s").cast("int"), 1) == 1, {"a": 0, "s": "x"}, "ok"),
    (lambda: g.when(f("a") > 0, f("s").cast("int"), 1) == 1, {"a": 1, "s": "x"}, "raised"),
    (lambda: g.either(f("a"), f("s").cast("int")) == 1, {"a": 1, "s": "x"}, "ok"),
    (lambda: g.either(f("a"), f("s").cast("int")) == 1, {"a": None, "s": "x"}, "raised"),
    (lambda: g.total(F.length, f("s")) >= 2, {"s": "xy"}, "ok"),
    (lambda: f("s").is_null(), {"s": None}, "ok"),
    (lambda: f("a") <= f("b"), {"a": 1, "b": 1}, "ok"),
    (lambda: f("a") < f("b"), {"a": 1, "b": 1}, "failed"),
])
def test_guarded_conditions(spark, build, given, want):
    row = {"s": None, "a": None, "b": None, "l": None, **given}
    items = spark.createDataFrame([row], "s string, a bigint, b bigint, l array<string>")
    rule = Rule("s", build, "no")
    [got] = rule_validate(items, [rule]).collect()
    shown = "None" if row["s"] is None else f"'{row['s']}'"
    assert got["failures"] == {"ok": [], "failed": ["s: no"],
                               "raised": [f"s: rule check errored (value={shown})"]}[want]


def test_raising_rules_count_as_failures_and_stay_one_projection(spark, tmp_path):
    path = str(tmp_path / "items")
    items = conform(spark.range(6), item_key=F.col("id"), enrich_version=F.lit(1),
                    best_for=F.expr("CASE id WHEN 0 THEN '7' WHEN 1 THEN 'x' END"))
    items.write.parquet(path)
    stored = spark.read.schema(CATALOG_SCHEMA).parquet(path)
    rules = [Rule("best_for", lambda: f("best_for").cast("int") > 1, "must be more than 1")]
    checked = validation_transition(stored, rules)
    text = plan(checked.select("item_key", "outcome", "failures"))
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Python" not in text
    outcomes = {r["item_key"]: (r["outcome"], r["failures"]) for r in checked.collect()}
    assert len(outcomes) == 6 and outcomes["0"] == ("valid", [])
    assert outcomes["1"] == ("re_queued", ["best_for: rule check errored (value='x')"])
    assert outcomes["2"] == ("re_queued", ["best_for: must be more than 1"])


# ---- digests ---------------------------------------------------------------------------------

DDL = "k string, a bigint, l array<string>, m map<string,string>, s struct<x:int,y:string>"
OLD = [("one", 1, ["x"], {"p": "q"}, (1, "y")), ("two", 2, [], None, None),
       ("three", None, None, None, (None, "y")), ("gone", 4, ["x", None], {}, None),
       (None, 5, None, None, None), ("twice", 1, None, None, None), ("twice", 2, None, None, None)]


def feed_of(spark, tmp_path, new, old, columns=None, bits=4):
    paths = []
    for name, rows in (("new", new), ("old", old)):
        df = spark.createDataFrame(rows, DDL)
        df = df.drop(*columns[name]) if columns and name in columns else df
        dg.write_digests(df, str(tmp_path / name), "k", bits=bits)
        paths.append(str(tmp_path / name))
    return dg.change_feed(spark, *paths, bits=bits)


def told(feed):
    return {(r["key"], r["kind"], tuple(r["columns"] or ())) for r in feed.collect()}


def test_feed_tells_kinds_and_columns(spark, tmp_path):
    new = [("one", 1, ["x", None], {"p": "q"}, (1, None)), ("two", 2, None, None, None),
           ("three", None, None, {}, (None, "y")), ("come", 1, None, None, None),
           (None, 6, None, None, None), ("twice", 2, None, None, None), ("twice", 1, None, None, None)]
    assert told(feed_of(spark, tmp_path, new, OLD)) == {
        ("one", "changed", ("l", "s")), ("two", "changed", ("l",)), ("three", "changed", ("m",)),
        ("come", "added", ()), ("gone", "removed", ()), (None, "changed", ("a",))}
    first = dg.change_feed(spark, str(tmp_path / "new"), None, bits=4)
    assert {k for _, k, _ in told(first)} == {"added"} and first.count() == 6


def test_feed_of_repeated_keys_and_new_columns(spark, tmp_path):
    fewer = [r for r in OLD if r != ("twice", 2, None, None, None)]
    found = told(feed_of(spark, tmp_path / "a", fewer, OLD))
    assert {(k, kind) for k, kind, _ in found} == {("twice", "changed")}
    found = told(feed_of(spark, tmp_path / "b", OLD, OLD, {"old": ["m"]}))
    assert found == {("one", "changed", ("m",)), ("gone", "changed", ("m",))}
    assert told(feed_of(spark, tmp_path / "c", [], [])) == set()


def test_only_unequal_ranges_are_read(spark, tmp_path):
    old = [(f"k{i}", i, None, None, None) for i in range(200)]
    new = [(k, a + (k == "k7"), *rest) for k, a, *rest in old]
    feed = feed_of(spark, tmp_path, new, old, bits=8)
    text = plan(feed)
    assert told(feed) == {("k7", "changed", ("a",))}
    assert len(dg.unequal_ranges(spark, str(tmp_path / "new"), str(tmp_path / "old"), 8)) == 1
    # One folder is listed, and in it rows are filtered by their range where they are read.
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\],", text)
    assert len(scans) == 2 and all("folder" in f and "(range" in p for f, p in scans), scans
    same = feed_of(spark, tmp_path / "same", old, list(reversed(old)), bits=8)
    assert same.count() == 0


def test_bags_add_up(spark):
    df = spark.createDataFrame(OLD, DDL)

    def sums(rows):
        return rows.agg(*dg.bag_digest(df)).first().asDict()

    assert dg.same_bag(sums(df), sums(df.orderBy("a")))
    assert not dg.same_bag(sums(df), sums(df.filter("k <> 'gone' OR k IS NULL")))
    assert not dg.same_bag(sums(df), sums(df.withColumn("l", F.coalesce("l", F.array()))))
    both = sums(df.unionAll(df))
    assert dg.same_bag(sums(df), dg.without(both, sums(df)))
    assert sums(df.limit(0))["rows"] == 0


# ---- replay ----------------------------------------------------------------------------------

def brute_replay(events, state, most):
    for run in sorted({e[0] for e in events}):
        here = [e for e in events if e[0] == run]
        code = rp.ENRICHED * any(e[1] for e in here)
        code |= rp.PASSED * any(e[2] is True for e in here)
        code |= rp.FAILED * any(e[2] is False for e in here)
        state = rp.step(state, code, most)
    return state


@pytest.mark.parametrize("runs,most", [(5, 3), (30, 1), (400, 3)])
def test_replay_equals_run_after_run(spark, monkeypatch, runs, most):
    monkeypatch.setattr(rp, "FAN", 3)
    rng = random.Random(runs)
    rows = [(rng.choice(["hot", "a", "b", "c"]), rng.randrange(runs), rng.choice([True, False, None]),
             rng.choice([True, False, False, None])) for _ in range(300)]
    rows += rows[:50] + [(None, 1, True, True), ("a", None, True, True), ("a", -1, True, True)]
    before = {"a": (1, 0, 0), "b": (1, 1, 0), "d": (1, 2, 9), "hot": (1, 0, most + 5)}
    catalog = [(k, bool(e), s == 1, s == 2, r) for k, (e, s, r) in before.items()]
    got = rp.validation_replay(
        spark.createDataFrame(rows, "key string, run bigint, enriched boolean, passed boolean"),
        spark.createDataFrame(catalog, "key string, is_enriched boolean, validated boolean, "
                                       "validation_failed boolean, validation_retries int"), most)
    found = {r["key"]: (int(r["is_enriched"]), 1 if r["validated"] else 2 if r["validation_failed"]
                        else 0, r["validation_retries"]) for r in got.collect()}
    want = {}
    for key in {"hot", "a", "b", "c", "d"}:
        events = [e[1:] for e in rows if e[0] == key and e[1] is not None and e[1] >= 0]
        want[key] = brute_replay(events, before.get(key, (0, 0, 0)), most)
    assert found == want


def test_replay_has_no_window_and_counts_before_the_shuffle(spark):
    events = spark.createDataFrame([("a", 1, True, True)],
                                   "key string, run bigint, enriched boolean, passed boolean")
    text = plan(rp.histories(events))
    assert "Window" not in text and "partial_bit_or" in text
    assert rp.histories(events.limit(0)).collect() == []


# ---- many crawls -----------------------------------------------------------------------------

CRAWL_DDL = ("item_key string, item_name string, description string, capability string, capabilities "
             "array<string>, labels array<string>, is_uncensored_hint boolean, has_detail boolean, "
             "pulls bigint, tags int, last_updated date, last_updated_str string, readme string, "
             "applications array<struct<name:string,launch_command:string>>, memory_requirements "
             "array<struct<tag:string,size:string,size_gb:double,recommended_ram_gb:double,quantization:"
             "string,context:string,context_window:bigint>>, min_ram_gb double, context_window bigint, "
             "speed_tier string")


def test_many_crawls_equal_one_after_another(spark):
    rng = random.Random(8)

    def row(key):
        return (key, f"n{rng.randrange(9)}", rng.choice([None, "d"]), "Tools", ["Tools"],
                rng.choice([None, [], [f"l{rng.randrange(9)}"]]), rng.choice([None, True, False]),
                rng.choice([None, True, False]), rng.randrange(99), 1, None, "now",
                rng.choice([None, "", f"r{rng.randrange(99)}"]), None, None,
                rng.choice([None, float(rng.randrange(9))]), None, rng.choice([None, "fast"]))

    crawls = [[row(f"k{i}") for i in range(40) if rng.random() < 0.6] for _ in range(4)]
    crawls.append(crawls[1])
    stored = conform(
        spark.range(25), id=F.expr("CASE WHEN id % 2 = 0 THEN concat('i', id) END"),
        item_key=F.concat(F.lit("k"), "id"), item_name=F.lit("old"), url=F.lit("u"),
        labels=F.expr("CASE WHEN id % 3 = 0 THEN array('old') END"), readme=F.lit("old"),
        is_uncensored=F.expr("CASE id % 3 WHEN 0 THEN true WHEN 1 THEN false END"),
        min_ram_gb=F.lit(1.5), domain=F.lit("Code"), validation_retries=F.lit(2))
    stored = spark.createDataFrame(stored.collect(), CATALOG_SCHEMA)
    want, actions = stored, {}
    for number, rows in enumerate(crawls):
        stamp = F.lit(f"2024-02-0{number + 1} 00:00:00").cast("timestamp")
        merged = catalog_upsert(want, spark.createDataFrame(rows, CRAWL_DDL), "https://x", stamp)
        found = merged.collect()
        actions |= {r["item_key"]: r["_action"] for r in found
                    if r["_action"] == "inserted" or actions.get(r["item_key"], "kept") == "kept"}
        want = spark.createDataFrame([r[:-1] for r in map(tuple, found)], CATALOG_SCHEMA)
    every = [(n, f"2024-02-0{n + 1} 00:00:00", *r) for n, rows in enumerate(crawls) for r in rows]
    odd = [every[3], (None, None, *crawls[0][0]), (1, "2024-02-02 00:00:00", None, *crawls[0][0][1:])]
    given = spark.createDataFrame(
        every + odd, "crawl_no int, run_ts string, " + CRAWL_DDL)
    got = upsert_many(stored, given, "https://x/")
    assert plan(got).count("Exchange") == 1 and "Join" not in plan(got)
    rows = {r["item_key"]: r for r in got.collect()}
    assert {k: r["_action"] for k, r in rows.items()} == actions
    assert {k: tuple(r)[:-1] for k, r in rows.items()} == {
        r["item_key"]: tuple(r) for r in want.collect()}
    dealt = upsert_many(stored, given, "https://x/", spread=True)
    assert plan(dealt).count("Exchange") == 2 and {r["item_key"]: r for r in dealt.collect()} == rows
    narrow = upsert_many(stored.drop("readme", "applications", "memory_requirements"), given, "https://x")
    assert {r["item_key"]: r["min_ram_gb"] for r in narrow.collect()} == {
        k: r["min_ram_gb"] for k, r in rows.items()}
    assert upsert_many(stored.limit(0), given.limit(0), "https://x").collect() == []


# ---- asking again ----------------------------------------------------------------------------

def test_requeue_narrows_and_ends(spark, tmp_path):
    items = conform(spark.range(10), item_key=F.col("id"), enrich_version=F.lit(1),
                    validation_retries=F.lit(0), domain=F.expr("CASE WHEN id < 5 THEN 'Code' END"))
    asked = []

    def enrich(stale, pass_no):
        asked.append(stale.count())
        good = F.col("item_key").cast("int") < 5 + 2 * pass_no
        return stale.withColumns({"domain": F.when(good, "Code"), "enrich_version": F.lit(1)})

    def write(df, name):
        path = str(tmp_path / name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rules = [Rule("domain", "domain IS NOT NULL", "domain must not be null")]
    out = requeue_loop(items, enrich, write, 1, 99, "requeued", rules).collect()
    assert asked == [5, 3, 1]  # and nothing is queued any more
    assert {r["item_key"]: r["pass_no"] for r in out} == {
        str(i): 0 if i < 5 else (i - 3) // 2 for i in range(10)}
    assert all(r["validated"] for r in out)
    asked.clear()
    never = requeue_loop(items, lambda stale, n: stale.withColumn("enrich_version", F.lit(1)), write, 1,
                         99, "all", rules, max_retries=2).filter("validation_failed").collect()
    assert len(never) == 5 and {r["pass_no"] for r in never} == {2}
    with pytest.raises(ValueError):
        requeue_loop(items, enrich, write, 1, 1, "some")
