"""Prompt texts, one per structured call, from templates with named slots."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions.text import blank_to_null, clean_text
from stratalog.schema import ANSWERS

_SLOT = re.compile(r"\{(\w+)\}")


def _options(terms) -> str:
    return ", ".join(f'"{t}"' for t in terms)


_HEAD = "Item: {key}\nDescription: {description}\n"

# Our wording. A slot is a name in braces; see ``prompt_slots``.
DEFAULT_TEMPLATES = {
    1: _HEAD + (
        f"\nClassify the item. Answer with a JSON object holding domain, one of "
        f"{_options(fv.DOMAINS)}, and model_family, one of {_options(fv.FAMILIES)}."
    ),
    2: _HEAD + (
        f"\nAnswer with a JSON object holding use_cases, a list of one to four entries taken from "
        f"{_options(fv.USE_CASES)}."
    ),
    3: _HEAD + "Sizes: {labels}\n" + (
        f"\nAnswer with a JSON object holding languages, a list of one to six entries taken from "
        f"{_options(fv.LANGUAGES)}; complexity, one of {_options(fv.COMPLEXITIES)} by the memory "
        f"it needs (under 8 GB, up to 32 GB, more); is_fine_tuned and is_uncensored, booleans."
    ),
    4: _HEAD + "Text: {text}\n" + (
        "\nAnswer with a JSON object holding best_for, one sentence on the ideal use, and "
        "license, its name or null if the text names none."
    ),
    5: _HEAD + (
        f"\nAnswer with a JSON object holding strengths, two or three short texts; limitations, "
        f"up to two short texts; target_audience, a list of one to three entries taken from "
        f"{_options(fv.AUDIENCES)}."
    ),
    6: _HEAD + "Sizes: {labels}\nLinks: {links}\nScores: {scores}\n" + (
        "\nAnswer with a JSON object holding creator_org, is_multimodal, base_model, "
        "huggingface_url, benchmark_scores (objects with name, score and unit) and "
        "parameter_sizes; use null for what is not known."
    ),
}


def prompt_slots() -> dict[str, Column]:
    """Slot values of a catalog row joined with its page sections."""
    empty = F.array().cast("array<string>")
    text = F.coalesce(
        blank_to_null(F.col("main_content")), clean_text(F.col("readme"), fv.PROMPT_README_CAP)
    )

    def listed(name: str) -> Column:
        return F.when(F.size(name) > 0, F.to_json(name)).otherwise(F.lit("none"))

    return {
        "key": F.col("item_key"),
        "description": F.coalesce("description", F.lit("")),
        "labels": F.to_json(F.coalesce(F.col("labels"), empty)),
        "text": text,
        "links": listed("hf_links"),
        "scores": listed("benchmark_mentions"),
    }


def render(template: str, slots: Mapping[str, Column]) -> Column:
    """A template as one concatenation; NULL slots become empty."""
    parts, at = [], 0
    for slot in _SLOT.finditer(template):
        parts.append(F.lit(template[at:slot.start()]))
        parts.append(F.coalesce(slots[slot.group(1)], F.lit("")))
        at = slot.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def build_prompts(
    items: DataFrame,
    templates: Mapping[int, str] = DEFAULT_TEMPLATES,
    slots: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(item_key, prompts), the prompts of an item as one array in call order.

    Keeping them in the item's row lets the calls of an item run, stop and be merged without a
    shuffle. ``prompts_long`` gives one row per call.
    """
    slots = prompt_slots() if slots is None else slots
    labels = {a.call_no: a.label for a in ANSWERS}
    calls = [
        F.struct(
            F.lit(no).alias("call_no"),
            F.lit(labels.get(no, str(no))).alias("label"),
            render(template, slots).alias("prompt"),
        )
        for no, template in sorted(templates.items())
    ]
    return items.select("item_key", F.array(*calls).alias("prompts"))


def prompts_long(prompts: DataFrame) -> DataFrame:
    return prompts.select("item_key", F.inline("prompts"))
