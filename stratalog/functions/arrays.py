"""Array columns: pairs of neighbours, badge split, closed vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.text import let, strip

# A vocabulary inlined as a map literal is part of the plan; larger ones belong in a table
# (see the functions ``..._by_table`` of operators.vocab).
MAX_INLINE_TERMS = 1000


def null_if_empty(items: Column) -> Column:
    return let(items, lambda a: F.when(F.size(a) > 0, a))


def adjacent_pairs(tokens: Column, prefix: str) -> Column:
    """(name, launch_command) pairs of neighbouring tokens whose second starts with ``prefix``.

    A token used as a command cannot be the name of the next pair. A command that was not used
    can, so this is a fold over the array and not a filter on the following token.
    """
    pair_type = "struct<name:string,launch_command:string>"
    start = F.struct(
        F.lit(None).cast("string").alias("pending"),
        F.array().cast(f"array<{pair_type}>").alias("out"),
    )

    def step(state: Column, token: Column) -> Column:
        used = state["pending"].isNotNull() & token.startswith(prefix)
        pair = F.struct(state["pending"].alias("name"), token.alias("launch_command"))
        return F.struct(
            F.when(~F.coalesce(used, F.lit(False)), token).alias("pending"),
            F.when(used, F.concat(state["out"], F.array(pair)))
            .otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(tokens, start, step, lambda state: state["out"])


def split_badges(badges: Column, capability_tags: Sequence[str]) -> tuple[Column, Column]:
    """Badge texts as (capabilities with a capital first letter, remaining labels)."""
    low = F.filter(F.transform(badges, lambda b: F.lower(strip(b))), lambda b: b != "")
    tags = terms_literal(capability_tags)
    capabilities = F.transform(
        F.filter(low, lambda b: F.array_contains(tags, b)),
        lambda b: F.concat(F.upper(F.substring(b, 1, 1)), F.substring(b, 2, 1 << 30)),
    )
    return capabilities, F.filter(low, lambda b: ~F.array_contains(tags, b))


def first_or_null(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def terms_literal(terms: Sequence[str]) -> Column:
    """Array literal as one SQL expression: a call per term would dominate plan building."""
    if len(terms) > MAX_INLINE_TERMS:
        raise ValueError(f"{len(terms)} terms; inline vocabularies hold {MAX_INLINE_TERMS}")
    return F.expr(f"array({', '.join(map(_sql, terms))})")


def map_literal(mapping: Mapping[str, str]) -> Column:
    if len(mapping) > MAX_INLINE_TERMS:
        raise ValueError(f"{len(mapping)} entries; inline vocabularies hold {MAX_INLINE_TERMS}")
    return F.expr(f"map({', '.join(map(_sql, chain.from_iterable(mapping.items())))})")


def canonical_term(
    value: Column, terms: Sequence[str], aliases: Mapping[str, str], default: str | None
) -> Column:
    """Canonical term: the value itself, else its lower-case alias, else the default."""
    mapped = F.when(F.array_contains(terms_literal(terms), value), value).otherwise(
        F.try_element_at(map_literal(aliases), F.lower(strip(value)))
    )
    return mapped if default is None else F.coalesce(mapped, F.lit(default))


def canonical_terms(
    values: Column,
    terms: Sequence[str],
    aliases: Mapping[str, str],
    default: str,
    cap: int | None = None,
) -> Column:
    """Mapped items in their order, unmapped ones dropped, distinct, capped, never empty."""
    mapped = F.array_distinct(F.filter(
        F.transform(values, lambda v: canonical_term(v, terms, aliases, None)),
        lambda v: v.isNotNull(),
    ))
    if cap is not None:
        mapped = F.slice(mapped, 1, cap)
    return F.coalesce(null_if_empty(mapped), F.array(F.lit(default)))


def first_contained(
    value: Column, terms: Sequence[str], aliases: Sequence[tuple[str, str]], default: str
) -> Column:
    """The value if it is a term, else the term of the first alias it contains, else the default."""

    def first(low: Column) -> Column:
        # The first alias contained, found by its place in the list: the order decides.
        hit = F.filter(terms_literal([a for a, _ in aliases]), lambda a: low.contains(a))
        return F.try_element_at(map_literal(dict(aliases)), F.get(hit, F.lit(0)))

    return F.when(F.array_contains(terms_literal(terms), value), value).otherwise(
        F.coalesce(let(F.lower(strip(value)), first), F.lit(default))
    )
