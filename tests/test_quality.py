"""Quality rules, validation states, export, comparison."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from stratalog.operators.publish import (
    export_rows, export_stats, no_change_gate, ranked, snapshot_diff,
)
from stratalog.operators.quality import (
    DEFAULT_RULES, Rule, rule_validate, validation_summary, validation_transition,
)
from stratalog.schema import EXPORT_COLUMNS
from stratalog.sources.exports import export_name, read_export, write_export
from tests.test_catalog import catalog

GOOD = dict(
    item_key="otter", item_name="Otter", item_type="official", labels=["2b"], pulls=1_234,
    tags=3, enrich_version=1, domain="Code", use_cases=["Summaries"],
    ai_languages=["Welsh"], complexity="advanced",
    best_for="Writing short notes about long meetings", strengths=["Small", "Steady"],
    limitations=["Knows two languages"], model_family="Gemma", target_audience=["Students"],
)


@pytest.mark.parametrize("override,fields", [
    ({}, []), ({"domain": None}, ["domain"]), ({"use_cases": []}, ["use_cases"]),
    ({"use_cases": None}, ["use_cases"]), ({"ai_languages": []}, ["ai_languages"]),
    ({"complexity": None}, ["complexity"]), ({"best_for": "Short"}, ["best_for"]),
    ({"best_for": None}, ["best_for"]), ({"best_for": "1234567890"}, []),
    ({"strengths": []}, ["strengths"]), ({"limitations": []}, []),
    ({"limitations": None}, ["limitations"]), ({"model_family": None}, ["model_family"]),
    ({"target_audience": None}, ["target_audience"]),
    ({"domain": None, "use_cases": [], "complexity": None}, ["domain", "use_cases", "complexity"]),
])
def test_rules(spark, override, fields):
    row = rule_validate(catalog(spark, {**GOOD, **override})).first()
    assert [f.split(":")[0] for f in row["failures"]] == fields
    assert row["is_valid"] is (not fields)
    assert row["failure_text"] == "; ".join(row["failures"])


def test_rule_table():
    assert [r.field for r in DEFAULT_RULES] == [
        "domain", "use_cases", "ai_languages", "complexity", "best_for", "strengths",
        "limitations", "model_family", "target_audience",
    ]
    assert all(isinstance(r.message, str) for r in DEFAULT_RULES)


def validate(spark, *rows):
    out = validation_transition(catalog(spark, *[
        {**GOOD, "item_key": f"k{i}", **r} for i, r in enumerate(rows)
    ]))
    return out.orderBy("item_key").collect(), validation_summary(out).first().asDict()


def state(row):
    return (row["outcome"], row["enrich_version"], row["validated"], row["validation_failed"],
            row["validation_retries"])


@pytest.mark.parametrize("given,expected", [
    ({"validation_retries": 2}, ("valid", 1, True, None, 0)),
    ({"domain": None}, ("re_queued", None, None, None, 1)),
    ({"domain": None, "validation_retries": 2}, ("re_queued", None, None, None, 3)),
    ({"domain": None, "validation_retries": 3}, ("failed", 1, False, True, 3)),
    ({"domain": None, "validated": True}, ("skip_valid", 1, True, None, None)),
    ({"validated": False, "validation_failed": True}, ("skip_failed", 1, False, True, None)),
    ({"enrich_version": None}, (None, None, None, None, None)),
    ({"domain": None, "validated": False, "validation_failed": False},
     ("re_queued", None, None, None, 1)),
])
def test_transition(spark, given, expected):
    [row], _ = validate(spark, given)
    assert state(row) == expected


def test_summary(spark):
    zero = dict(total=0, valid=0, invalid=0, re_queued=0, failed=0)
    assert validate(spark)[1] == zero
    assert validate(spark, {"enrich_version": None})[1] == zero
    assert validate(spark, {}, {"domain": None})[1] == dict(
        total=2, valid=1, invalid=1, re_queued=1, failed=0)
    assert validate(spark, {"validated": True}, {"validation_failed": True})[1] == dict(
        total=2, valid=1, invalid=0, re_queued=0, failed=1)


def test_four_validations_before_failing(spark):
    row = {**GOOD, "domain": None}
    seen = []
    for _ in range(5):
        out = validation_transition(catalog(spark, row)).first().asDict(recursive=True)
        seen.append(out["outcome"])
        row = {**out, "enrich_version": 1, "validated": None, "validation_failed": None}
    assert seen == ["re_queued"] * 3 + ["failed"] * 2


def test_states_are_total(spark):
    rng = random.Random(3)
    rows = [{
        "enrich_version": rng.choice([None, 1]), "validated": rng.choice([None, True, False]),
        "validation_failed": rng.choice([None, True, False]),
        "validation_retries": rng.choice([None, 0, 2, 3, 7]), "domain": rng.choice([None, "Code"]),
    } for _ in range(200)]
    out, s = validate(spark, *rows)
    assert sum(r["outcome"] is not None for r in out) == s["total"]
    skipped = sum(r["outcome"] == "skip_failed" for r in out)
    assert s["valid"] + s["invalid"] + skipped == s["total"]
    assert s["re_queued"] + s["failed"] == s["invalid"] + skipped


def test_custom_rule_that_is_null_fails(spark):
    out = rule_validate(catalog(spark, GOOD), [Rule("url", "length(url) > 3", "url is too short")])
    assert out.first()["failures"] == ["url: url is too short"]


# ---- export -----------------------------------------------------------------------------------

def exportable(spark):
    return catalog(
        spark,
        {**GOOD, "item_key": "b", "pulls": 7, "validated": True, "readme": "é",
         "last_updated": dt.date(2024, 1, 2), "timestamp": dt.datetime(2024, 1, 2, 3, 4, 5)},
        {**GOOD, "item_key": "a", "pulls": 7, "validation_failed": True, "labels": None,
         "readme": "", "timestamp": dt.datetime(2024, 1, 2, 3, 4, 5, 60)},
        {**GOOD, "item_key": "c", "pulls": 90, "is_uncensored": True, "memory_requirements": [
            ("t", "1 GB", 1.0, 1.2, "q", "8K", 8000)]},
        {**GOOD, "item_key": "d", "enrich_version": None},
    )


def test_export_rows(spark):
    rows = ranked(export_rows(exportable(spark))).collect()
    assert [r["item_key"] for r in rows] == ["c", "a", "b"]
    assert len(rows[0]) == len(EXPORT_COLUMNS) == 42
    assert rows[1]["labels"] == [] and rows[1]["applications"] == []
    assert rows[2]["last_updated"] == "2024-01-02"
    assert [rows[i]["timestamp"] for i in (1, 2)] == [
        "2024-01-02T03:04:05.000060", "2024-01-02T03:04:05"
    ]


def test_export_stats(spark):
    assert export_stats(export_rows(exportable(spark))).first().asDict() == dict(
        total=3, enriched=3, validated=1, validation_failed=1, exported=3, with_readme=1,
        with_memory=1, uncensored=1,
    )


def test_export_file_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    stats = write_export(exportable(spark), path)
    assert (stats["total"], stats["output_path"]) == (3, path)
    lines = [json.loads(line) for f in sorted((tmp_path / "out").glob("part-*"))
             for line in f.read_text("utf-8").splitlines()]
    assert [x["model_identifier"] for x in lines] == ["c", "a", "b"]
    assert len(lines[0]) == 42 and lines[2]["readme"] == "é" and lines[0]["license"] is None
    back = read_export(spark, path)
    assert back.columns == EXPORT_COLUMNS
    assert no_change_gate(back, export_rows(exportable(spark))).first()["unchanged"]
    assert read_export(spark, str(tmp_path / "none")) is None
    array = tmp_path / "array.json"
    array.write_text(json.dumps(lines, indent=2), "utf-8")
    again = read_export(spark, str(array), array_file=True)
    assert no_change_gate(back, again).first()["unchanged"]


def test_export_name():
    assert export_name("lab/model:7b") == "models_lab-model-7b"
    assert export_name(None) == export_name("") == "models"


def keys(spark, text):
    return spark.createDataFrame([(k,) for k in text], "item_key string")


@pytest.mark.parametrize("new,old,expected", [
    ("bc", "ab", (2, 1, 1, 1)), ("ab", "ab", (2, 0, 2, 0)), ("ab", "", (2, 2, 0, 0)),
    ("", "ab", (0, 0, 0, 2)), ("", "", (0, 0, 0, 0)),
])
def test_snapshot_diff(spark, new, old, expected):
    assert tuple(snapshot_diff(keys(spark, new), keys(spark, old)).first()) == expected


def test_gate(spark):
    rows = export_rows(exportable(spark))
    assert tuple(no_change_gate(rows, rows.orderBy("id")).first()) == (0, True)
    other = rows.withColumn("timestamp", F.lit("x"))
    assert tuple(no_change_gate(rows, other).first()) == (6, False)
    assert no_change_gate(rows, other, ignore=["timestamp"]).first()["unchanged"]
    # Repeats count.
    assert not no_change_gate(rows, rows.unionAll(rows)).first()["unchanged"]
    # NULL differs from an empty text.
    blank = rows.withColumn("license", F.lit(""))
    assert not no_change_gate(rows, blank).first()["unchanged"]
