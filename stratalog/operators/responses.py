"""Structured answers: parse, judge, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.text import let, null_like
from stratalog.operators import vocab
from stratalog.schema import ANSWERS, Answer, AnswerField


# Texts and numbers that stand for a boolean, in any case.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


def _kind(variant: Column, field: AnswerField) -> Column:
    """JSON type of a field as text; NULL if it is missing or JSON null.

    Read off the JSON itself, since a cast would accept 5 as a text. A list counts as a list of
    texts or of objects only if every item is one.
    """
    path = f"$.{field.name}"
    kind = F.nullif(
        F.schema_of_variant(F.try_variant_get(variant, path, "variant")), F.lit("VOID")
    )
    if field.kind not in ("strings", "scores"):
        return kind
    item = "STRING" if field.kind == "strings" else "OBJECT<"
    items = F.try_variant_get(variant, path, "array<variant>")
    good = F.forall(items, lambda v: F.schema_of_variant(v).startswith(item))
    return F.when(F.coalesce(good, F.lit(False)), "LIST").when(kind.isNotNull(), "OTHER")


def _value(variant: Column, field: AnswerField) -> Column:
    path = f"$.{field.name}"
    if field.kind == "string":
        return F.try_variant_get(variant, path, "string")
    if field.kind == "boolean":
        word = F.lower(F.try_variant_get(variant, path, "string"))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if field.kind == "strings":
        return F.try_variant_get(variant, path, "array<string>")
    return F.transform(
        F.try_variant_get(variant, path, "array<variant>"),
        lambda v: F.struct(
            F.try_variant_get(v, "$.name", "string").alias("name"),
            F.try_variant_get(v, "$.score", "double").alias("score"),
            F.try_variant_get(v, "$.unit", "string").alias("unit"),
            F.to_json(v).alias("given"),
        ),
    )


def _violations(kind: Column, value: Column, field: AnswerField) -> list[Column]:
    if field.kind == "string":
        typed = kind == "STRING"
    elif field.kind == "boolean":
        typed = kind.isin("BOOLEAN", "STRING", "BIGINT") & value.isNotNull()
    else:
        typed = kind == "LIST"
    length = F.length(value) if field.kind == "string" else F.size(value)

    def note(condition: Column, text: str) -> Column:
        return F.when(condition, F.lit(f"{field.name}: {text}"))

    out = [note(kind.isNotNull() & ~typed, "wrong type")]
    if not field.nullable:
        out.append(note(kind.isNull(), "missing"))
    if field.min_len:
        out.append(note(typed & (length < field.min_len), "too short"))
    if field.max_len is not None:
        out.append(note(typed & (length > field.max_len), "too long"))
    return out


def parse_answer(raw: Column, answer: Answer) -> Column:
    """JSON text as struct(value, is_valid, violations); the value is NULL unless valid.

    Extra fields are ignored. Text that is no JSON object has the one violation ``not an object``.
    """
    fields = answer.fields

    def read(variant: Column) -> Column:
        is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT<"), F.lit(False))
        return F.struct(
            is_object.alias("is_object"),
            F.struct(*[_kind(variant, f).alias(f.name) for f in fields]).alias("kinds"),
            F.struct(*[
                _value(variant, f).cast(f.spark_type).alias(f.name) for f in fields
            ]).alias("value"),
        )

    def judge(r: Column) -> Column:
        notes = [
            note for f in fields for note in _violations(r["kinds"][f.name], r["value"][f.name], f)
        ]
        return F.struct(
            r["value"].alias("value"),
            F.when(r["is_object"], F.array_compact(F.array(*notes)))
            .otherwise(F.array(F.lit("not an object"))).alias("violations"),
        )

    def settle(r: Column) -> Column:
        valid = F.size(r["violations"]) == 0
        return F.struct(
            F.when(valid, r["value"]).alias("value"),
            valid.alias("is_valid"),
            r["violations"].alias("violations"),
        )

    return let(let(let(F.try_parse_json(raw), read), judge), settle)


def _raw_of(call_no: int) -> Column:
    hits = F.filter(
        F.col("responses"), lambda r: (r["call_no"] == call_no) & r["error"].isNull()
    )
    return F.get(hits, F.lit(0))["raw"]


def widen_calls(calls: DataFrame, answers: Sequence[Answer] = ANSWERS) -> DataFrame:
    """(item_key, call_no, raw, error) rows, unique per call, back to one row per item."""
    good = F.when(F.col("error").isNull(), F.col("raw"))
    packed = calls.groupBy("item_key").agg(*[
        F.max(F.when(F.col("call_no") == a.call_no, good)).alias(f"_{a.call_no}") for a in answers
    ])
    entries = [
        F.struct(
            F.lit(a.call_no).alias("call_no"),
            F.col(f"_{a.call_no}").alias("raw"),
            F.lit(1).alias("attempts"),
            F.when(F.col(f"_{a.call_no}").isNull(), F.lit("no answer")).alias("error"),
        )
        for a in answers
    ]
    return packed.select("item_key", F.array(*entries).alias("responses"))


def merge_answers(responses: DataFrame, answers: Sequence[Answer] = ANSWERS) -> DataFrame:
    """(item_key, responses) to one enrichment row per item with ``ok`` and ``violations``.

    An item is ok when all required calls gave a valid answer. A missing optional answer leaves
    its fields NULL and ``is_multimodal`` false. Free-form values are mapped onto the vocabularies.
    Everything happens within the row.
    """
    parsed = responses.select("item_key", *[
        parse_answer(_raw_of(a.call_no), a).alias(f"_{a.call_no}") for a in answers
    ])
    ok = F.lit(True)
    for a in answers:
        if a.required:
            ok = ok & F.col(f"_{a.call_no}.is_valid")
    notes = F.flatten(F.array(*[
        F.transform(
            F.col(f"_{a.call_no}.violations"), lambda v, a=a: F.concat(F.lit(f"{a.label}."), v)
        )
        for a in answers
    ]))

    def got(call_no: int, name: str) -> Column:
        return F.col(f"_{call_no}.value.{name}")

    columns = {
        "use_cases": vocab.map_use_cases(got(2, "use_cases")),
        "domain": vocab.map_domain(got(1, "domain")),
        "ai_languages": vocab.map_languages(got(3, "languages")),
        "complexity": vocab.map_complexity(got(3, "complexity")),
        "best_for": got(4, "best_for"),
        "license": got(4, "license"),
        "base_model": got(6, "base_model"),
        "model_family": vocab.map_family(got(1, "model_family")),
        "is_fine_tuned": got(3, "is_fine_tuned"),
        "is_uncensored": got(3, "is_uncensored"),
        "strengths": got(5, "strengths"),
        "limitations": got(5, "limitations"),
        "target_audience": vocab.map_audience(got(5, "target_audience")),
        "creator_org": null_like(got(6, "creator_org")),
        "is_multimodal": F.coalesce(got(6, "is_multimodal"), F.lit(False)),
        "huggingface_url": got(6, "huggingface_url"),
        "benchmark_scores": got(6, "benchmark_scores"),
        "parameter_sizes": got(6, "parameter_sizes"),
    }
    return parsed.withColumn("ok", ok).select(
        "item_key", "ok", notes.alias("violations"),
        *[F.when(F.col("ok"), c).alias(n) for n, c in columns.items()],
    )
