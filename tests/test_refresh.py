"""Prompts, model calls, structured answers, whole runs."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.tables import StubClient
from stratalog.operators.inference import run_calls
from stratalog.operators.prompts import build_prompts, prompts_long, render
from stratalog.operators.quality import DEFAULT_RULES, Rule
from stratalog.operators.responses import merge_answers, parse_answer, widen_calls
from stratalog.plans.refresh import CATALOG, PAGES, RESPONSES, Options, Refresh, Site
from stratalog.schema import ANSWERS, PAGE_ARCHIVE_SCHEMA
from stratalog.sources.snapshots import SnapshotStore, latest_rows
from stratalog.streaming.intake import intake

ITEM = (
    "item_key string, description string, labels array<string>, readme string, "
    "main_content string, hf_links array<string>, benchmark_mentions array<string>"
)


def prompts(spark, *items):
    df = spark.createDataFrame(list(items), ITEM)
    return {(r["item_key"], r["call_no"]): r["prompt"]
            for r in prompts_long(build_prompts(df)).collect()}


def test_prompts_hold_what_they_must(spark):
    got = prompts(
        spark, ("deepseek-r1", "Fast reasoning item", ["8b", "70b"], "r  e", None, ["u"], None),
        ("x", None, None, None, "main", None, ["MMLU 5"]),
    )
    assert len(got) == 12
    for no in range(1, 7):
        assert "deepseek-r1" in got["deepseek-r1", no]
        assert "Fast reasoning item" in got["deepseek-r1", no]
    for words, no in [(["General", "domain", "model_family", "Llama"], 1),
                      (["Code Generation", "use_cases"], 2),
                      (["8b", "70b", "complexity", "beginner"], 3), (["Text: r e"], 4),
                      (["target_audience", "DevOps"], 5), (['Links: ["u"]', "Scores: none"], 6)]:
        assert all(w in got["deepseek-r1", no] for w in words)
    assert "Text: main" in got["x", 4] and 'Scores: ["MMLU 5"]' in got["x", 6]


def test_render_null_slot(spark):
    out = spark.range(1).select(render("a{x}b{y}", {"x": F.lit(None).cast("string"), "y": F.lit("!")}))
    assert out.first()[0] == "ab!"


def parse(spark, call_no, *raw):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    out = df.select("i", parse_answer(F.col("raw"), ANSWERS[call_no - 1]).alias("p"))
    return [r["p"] for r in sorted(out.collect(), key=lambda r: r["i"])]


@pytest.mark.parametrize("call_no,value,violations", [
    (1, {"domain": "x", "model_family": "y", "more": 1}, []),
    (1, {"domain": 5, "model_family": None},
     ["domain: wrong type", "model_family: missing"]),
    (2, {"use_cases": []}, ["use_cases: too short"]),
    (2, {"use_cases": list("abcdef")}, ["use_cases: too long"]),
    (2, {"use_cases": ["a", 1]}, ["use_cases: wrong type"]),
    (2, {"use_cases": [None]}, ["use_cases: wrong type"]),
    (2, {"use_cases": "a"}, ["use_cases: wrong type"]),
    (3, {"languages": ["a"], "complexity": "c", "is_fine_tuned": "TRUE", "is_uncensored": 0}, []),
    (3, {"languages": ["a"], "complexity": "c", "is_fine_tuned": 2, "is_uncensored": "maybe"},
     ["is_fine_tuned: wrong type", "is_uncensored: wrong type"]),
    (4, {"best_for": "x" * 10}, []),
    (4, {"best_for": "x" * 9, "license": None}, ["best_for: too short"]),
    (4, {"best_for": "x" * 301, "license": 1}, ["best_for: too long", "license: wrong type"]),
    (5, {"strengths": ["a"], "limitations": [], "target_audience": ["b"]}, []),
    (5, {"strengths": ["a"], "target_audience": ["b"]}, ["limitations: missing"]),
    (6, {"is_multimodal": True, "benchmark_scores": [{"name": "M", "score": "85.2"}, {}]}, []),
    (6, {"is_multimodal": True, "benchmark_scores": [1]}, ["benchmark_scores: wrong type"]),
    (6, {}, ["is_multimodal: missing"]),
])
def test_parse_answer(spark, call_no, value, violations):
    from stratalog.operators.inference import _acceptable

    raw = json.dumps(value)
    [p] = parse(spark, call_no, raw)
    assert p["violations"] == violations and p["is_valid"] is (not violations)
    assert (p["value"] is None) is bool(violations)
    assert _acceptable(ANSWERS[call_no - 1], raw) is (not violations)


def test_parse_answer_values(spark):
    a, b, c, d = parse(
        spark, 6, json.dumps({"is_multimodal": "yes", "benchmark_scores": [
            {"name": "M", "score": "85.2", "unit": "%"}, {"score": "85.2%", "shots": 5}]}), "no json", "[1]", None)
    assert a["value"]["is_multimodal"] is True
    assert [tuple(s) for s in a["value"]["benchmark_scores"]] == [
        ("M", 85.2, "%", '{"name":"M","score":"85.2","unit":"%"}'),
        (None, None, None, '{"score":"85.2%","shots":5}'),
    ]
    assert [x["violations"] for x in (b, c, d)] == [["not an object"]] * 3


class FlakyClient(StubClient):
    """Fails the first try of every call."""

    def __init__(self):
        self.tries = Counter()

    def complete(self, call_no, label, prompt):
        self.tries[prompt] += 1
        if self.tries[prompt] == 1:
            return "not json" if call_no % 2 else 1 / 0
        return super().complete(call_no, label, prompt)


def calls(spark, factory, keys, **options):
    items = spark.createDataFrame([(str(k), "d", None, None, None, None, None) for k in keys], ITEM)
    return run_calls(build_prompts(items), factory, **options)


def test_calls_stop_at_the_first_required_failure(spark):
    rows = {int(r["item_key"]): r["responses"]
            for r in calls(spark, StubClient, [17, 5, 19, 1], partitions=2).collect()}
    assert [r["call_no"] for r in rows[17]] == [1, 2, 3]
    assert rows[17][2]["error"].startswith("TimeoutError") and rows[17][2]["attempts"] == 2
    assert [r["call_no"] for r in rows[5]] == list(range(1, 7)) and rows[5][5]["error"]
    assert rows[19][-1]["error"] == "rejected answer" and rows[19][-1]["call_no"] == 4
    assert all(r["attempts"] == 1 for r in rows[1])


def test_retries_are_bounded(spark):
    [row] = calls(spark, FlakyClient, [1]).collect()
    assert [r["attempts"] for r in row["responses"]] == [2] * 6
    assert not any(r["error"] for r in row["responses"])
    [row] = calls(spark, FlakyClient, [1], attempts=1).collect()
    assert len(row["responses"]) == 1


def test_merge_from_long_calls(spark):
    responses = calls(spark, StubClient, range(1, 40))
    rows = responses.collect()
    fixed = spark.createDataFrame(rows, responses.schema)
    long = fixed.select("item_key", F.inline("responses")).drop("attempts")
    a = merge_answers(fixed).drop("violations")
    b = merge_answers(widen_calls(long)).drop("violations")
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert a.filter("ok").count() == 39 - 4  # 17, 34, 19 and 38 fail


# ---- whole runs -------------------------------------------------------------------------------

SITE = Site("https://e.org/lib", "/lib/", "run")


class ShopClient:
    """Answers by key; ``bare`` never has a license, ``mute`` never answers call 1."""

    def complete(self, call_no, label, prompt):
        key = prompt.split("\n", 1)[0][len("Item: "):]
        if key == "mute" and call_no == 1:
            raise TimeoutError
        return json.dumps({
            1: {"domain": "Code", "model_family": key},
            2: {"use_cases": ["rag"]},
            3: {"languages": ["french"], "complexity": "easy", "is_fine_tuned": False,
                "is_uncensored": key.startswith("un")},
            4: {"best_for": "people who like " + key, "license": None if key == "bare" else "MIT"},
            5: {"strengths": ["x"], "limitations": [], "target_audience": ["Students"]},
            6: {"is_multimodal": False},
        }[call_no])


def listing(spark, *keys):
    html = "".join(f'<a href="/lib/{k}"><h2>{k}</h2>5K Pulls</a>' for k in keys)
    return spark.createDataFrame([(0, html)], "page_id bigint, html string")


def details(spark, **html):
    return spark.createDataFrame(list(html.items()), PAGE_ARCHIVE_SCHEMA)


def refresh(spark, root, ts="2024-02-01 00:00:00", **options):
    return Refresh(SnapshotStore(spark, str(root)), SITE, ShopClient, ts, Options(**options))


def by_key(df):
    return {r["item_key"]: r for r in df.collect()}


def test_two_runs(spark, tmp_path):
    first = refresh(spark, tmp_path)
    out = first.run(listing(spark, "alpha", "mute"), details(
        spark, alpha='<p id="readme">a 2 GB 8K</p>', other="<p/>"))
    assert out["crawl"] == {"inserted": 2, "updated": 0}
    assert out["enrich"] == {"total": 2, "ok": 1, "failed": 1}
    assert out["validation"] == dict(total=1, valid=1, invalid=0, re_queued=0, failed=0)
    assert out["export"]["stats"]["total"] == 1 and out["export"]["unchanged"] is False
    assert out["export"]["diff"] == dict(total=1, new=1, common=0, removed=0)
    row = by_key(first.catalog())["alpha"]
    assert (row["min_ram_gb"], row["domain"], row["validated"]) == (2.0, "Code", True)
    # A page that no listing shows yet is kept for later, but is no item.
    assert set(by_key(first.pages())) == {"alpha", "other"}
    assert set(by_key(first.catalog())) == {"alpha", "mute"}

    second = refresh(spark, tmp_path, "2024-02-08 00:00:00")
    out = second.run(listing(spark, "alpha", "beta"), details(spark, alpha="<p/>", beta="<p/>"))
    assert out["crawl"] == {"inserted": 1, "updated": 1}
    assert out["enrich"] == {"total": 2, "ok": 1, "failed": 1}
    assert out["export"]["diff"] == dict(total=2, new=1, common=1, removed=0)
    rows = by_key(second.catalog())
    assert set(rows) == {"alpha", "beta", "mute"} and rows["alpha"]["min_ram_gb"] == 2.0

    third = refresh(spark, tmp_path, "2024-02-09 00:00:00", skip_crawl=True, skip_enrich=True)
    out = third.run()
    assert out["export"]["unchanged"] is True and set(out) == {"validation", "export"}


def test_requeue_runs_once_more_and_terminal_failure(spark, tmp_path):
    rules = (*DEFAULT_RULES, Rule("license", "license IS NOT NULL", "license must be known"))
    pages = details(spark, bare="<p/>", alpha="<p/>")
    one = refresh(spark, tmp_path, rules=rules)
    out = one.run(listing(spark, "alpha", "bare", "mute"), pages)
    assert out["enrich"]["total"] == 3
    # Everything stale is taken again, not only what was queued again.
    assert out["enrich_again"] == {"total": 2, "ok": 1, "failed": 1}
    assert out["validation"]["re_queued"] == 1
    assert by_key(one.catalog())["bare"]["validation_retries"] == 2
    two = refresh(spark, tmp_path, "2024-02-02 00:00:00", skip_crawl=True, rules=rules,
                  requeue_scope="requeued")
    out = two.run()
    assert out["enrich_again"]["total"] == 1 and out["validation"]["failed"] == 1
    bare = by_key(two.catalog())["bare"]
    assert (bare["validation_failed"], bare["validated"], bare["enrich_version"]) == (True, False, 1)
    assert out["export"]["stats"]["validation_failed"] == 1


def test_switches(spark, tmp_path):
    run = refresh(spark, tmp_path, dry_run=True, lots=3)
    out = run.run(listing(spark, "alpha", "beta"), details(spark, alpha="<p/>"))
    assert set(out) == {"crawl", "enrich"} and out["enrich"]["ok"] == 2
    single = refresh(spark, tmp_path, "2024-02-02 00:00:00", skip_crawl=True, single_key="beta",
                     dry_run=True)
    assert single.run()["enrich"]["total"] == 1
    force = refresh(spark, tmp_path, "2024-02-03 00:00:00", skip_crawl=True, force_enrich=True,
                    dry_run=True)
    assert force.run()["enrich"]["total"] == 2
    bump = refresh(spark, tmp_path, "2024-02-04 00:00:00", skip_crawl=True, enrich_version=2,
                   dry_run=True)
    assert bump.run()["enrich"]["total"] == 2
    assert bump.run()["enrich"]["total"] == 2  # the same run again: answers are read, not asked


def test_force_crawl_and_reparse(spark, tmp_path):
    refresh(spark, tmp_path).crawl(listing(spark, "a", "b"), details(
        spark, a='<p id="readme">old</p>', b='<p id="readme">b</p>'))
    force = refresh(spark, tmp_path, force_crawl=True)
    force.crawl(listing(spark, "a", "b"), details(spark, a='<p id="readme">new</p>', b=None))
    rows = by_key(force.catalog())
    assert rows["a"]["readme"] == "new" and rows["b"]["readme"] == "b"
    assert by_key(force.pages())["a"]["html"].endswith("new</p>")
    assert force.reparse() == {"updated": 2, "skipped": 0}
    assert by_key(force.catalog())["a"]["readme"] == "new"


def test_resumed_run_asks_missing_lots_only(spark, tmp_path):
    run = refresh(spark, tmp_path, lots=2)
    run.crawl(listing(spark, "alpha", "beta", "gamma"), details(spark, alpha="<p/>"))
    run.enrich()
    before = run.store.version(RESPONSES)
    assert run.enrich()["total"] == 3 and run.store.version(RESPONSES) == before == 2


def test_repeated_run_changes_nothing(spark, tmp_path):
    rules = (*DEFAULT_RULES, Rule("license", "license IS NOT NULL", "license must be known"))
    pages = details(spark, bare="<p/>", alpha="<p/>")

    def once():
        run = refresh(spark, tmp_path, rules=rules, lots=2)
        if not run.store.version(CATALOG):
            run.crawl(listing(spark, "alpha", "bare", "mute"), pages)
        run = refresh(spark, tmp_path, rules=rules, lots=2, skip_crawl=True)
        out = run.run()
        names = ["export/models", CATALOG, PAGES, RESPONSES, "content", "enrichment"]
        return out, sorted(map(str, run.catalog().collect())), {
            n: run.store.version(n) for n in names}

    first, second = once(), once()
    assert first == second and first[0]["validation"]["re_queued"] == 1


def test_run_broken_after_a_stage_goes_on(spark, tmp_path, monkeypatch):
    pages = details(spark, alpha='<p id="readme">x</p>')
    whole = refresh(spark, tmp_path / "whole")
    expected = whole.run(listing(spark, "alpha", "mute"), pages)
    broken = refresh(spark, tmp_path / "broken")
    broken.crawl(listing(spark, "alpha", "mute"), pages)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(Refresh, "export", lambda self: (_ for _ in ()).throw(RuntimeError()))
        refresh(spark, tmp_path / "broken", skip_crawl=True).run()
    out = refresh(spark, tmp_path / "broken", skip_crawl=True).run()
    assert out["validation"] == expected["validation"] and out["enrich"] == expected["enrich"]
    assert by_key(whole.catalog()) == by_key(refresh(spark, tmp_path / "broken").catalog())


def test_parallel_calls_give_the_same_answers(spark):
    one, eight = ({r["item_key"]: r["responses"] for r in calls(
        spark, StubClient, range(1, 40), calls_per_task=n).collect()} for n in (1, 8))
    assert one == eight


class SlowClient(StubClient):
    def complete(self, call_no, label, prompt):
        time.sleep(0.05)
        return super().complete(call_no, label, prompt)


def test_parallel_calls_overlap(spark):
    def seconds(n):
        start = time.monotonic()
        calls(spark, SlowClient, range(1, 25), partitions=1, calls_per_task=n).collect()
        return time.monotonic() - start

    seconds(8)
    assert seconds(1) > 3 * seconds(8)


@pytest.mark.parametrize("raw", ['{"domain": "x", "model_family": "y", "z": NaN}',
                                 '{"domain": "x", "model_family": "y", "domain": "z"}'])
def test_answers_that_the_record_refuses_are_asked_again(raw):
    from stratalog.operators.inference import _acceptable

    assert not _acceptable(ANSWERS[0], raw)


def test_store(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.version(CATALOG) == 0 and store.read(PAGES, PAGE_ARCHIVE_SCHEMA).count() == 0
    store.write(PAGES, details(spark, a="1", b="1"), tag="t1")
    found = store.write(PAGES, details(spark, a="2"), [F.max("html").alias("m")], tag="t2")
    assert found == {"m": "2", "rows_in": 1}
    assert by_key(store.read(PAGES, PAGE_ARCHIVE_SCHEMA)).keys() == {"a"}
    archive = store.read_all(PAGES, PAGE_ARCHIVE_SCHEMA)
    assert {(r["item_key"], r["html"]) for r in latest_rows(archive).collect()} == {
        ("a", "2"), ("b", "1")
    }
    assert store.read_all(PAGES, PAGE_ARCHIVE_SCHEMA, "t1").count() == 2
    assert store.has_tag(PAGES, "t2") and not store.has_tag(PAGES, "t3")
    assert store.write(PAGES, details(spark).limit(0)) == {"rows_in": 0}


def test_store_announces_together_or_not_at_all(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(PAGES, details(spark, a="1"))
    with pytest.raises(RuntimeError):
        with store.together():
            store.write(PAGES, details(spark, b="1"))
            assert store.version(PAGES) == 2
            raise RuntimeError
    assert store.version(PAGES) == SnapshotStore(spark, str(tmp_path)).version(PAGES) == 1
    with store.together():
        store.write(PAGES, details(spark, b="1"), tag="t")
        store.write(CATALOG, details(spark, b="1"))
        assert SnapshotStore(spark, str(tmp_path)).version(PAGES) == 1
    again = SnapshotStore(spark, str(tmp_path))
    assert (again.version(PAGES), again.version(CATALOG), again.has_tag(PAGES, "t")) == (2, 1, True)
    assert by_key(again.read(PAGES, PAGE_ARCHIVE_SCHEMA)).keys() == {"b"}


def test_intake(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    anchors = '<a href="/lib/a"><h2>A</h2></a>'
    ddl = "page_id bigint, url string, html string"

    def land(*rows):
        spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(landing)

    def take():
        query = intake(spark, landing, lambda: refresh(spark, root), "https://e.org/lib",
                       str(tmp_path / "cp")).start()
        query.awaitTermination()

    land((1, "https://e.org/lib?p=1", anchors), (2, "https://e.org/lib/a", "<p id='readme'>x</p>"))
    take()
    catalog = refresh(spark, root).catalog()
    assert [(r["item_key"], r["readme"]) for r in catalog.collect()] == [("a", "x")]
    land((3, "https://e.org/lib", anchors + '<a href="/lib/b">b</a>'))
    take()
    take()
    run = refresh(spark, root)
    assert set(by_key(run.catalog())) == {"a", "b"} and run.store.version(CATALOG) == 2


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_intake_in_any_batches(spark, tmp_path, files_per_batch):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    ddl = "page_id bigint, url string, html string"
    anchors = '<a href="/lib/a"><h2>A</h2></a><a href="/lib/b">b</a>'
    for row in [(1, "https://e.org/lib/b", "<p id='readme'>early 2 GB 8K</p>"),
                (2, "https://e.org/lib/", anchors),
                (3, "https://e.org/lib/a?x=1", "<p id='readme'>late 4 GB 8K</p>")]:
        spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(landing)
        time.sleep(0.02)  # files are taken in the order of their times
    query = intake(spark, landing, lambda: refresh(spark, root), "https://e.org/lib",
                   str(tmp_path / "cp"), files_per_batch).start()
    query.awaitTermination()
    rows = by_key(refresh(spark, root).catalog())
    got = {k: (r["readme"], r["min_ram_gb"]) for k, r in rows.items()}
    assert got == {"a": ("late 4 GB 8K", 4.0), "b": ("early 2 GB 8K", 2.0)}
