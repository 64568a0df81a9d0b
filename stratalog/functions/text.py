"""Text columns: whitespace, keys, keyword flags, null-like words."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog import fixed_values as fv

# Unicode white space plus the four ASCII separators, as a regex class and as a list.
SPACE = r"[\s\x1c-\x1f]"
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often the body mentions it.

    Array lambdas are interpreted, so a common subexpression in two branches would run twice.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` alone removes blanks only)."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def squeeze(col: Column) -> Column:
    """Collapse white space runs to one blank and trim."""
    # A single blank stays as it is: only runs and other white space are replaced.
    return F.trim(F.regexp_replace(col, rf"(?U)[{SPACE}&&[^ ]]{SPACE}*+| {SPACE}++", " "))


def clean_text(col: Column, max_chars: int = fv.CLEAN_CAP) -> Column:
    """Text for a prompt: squeezed and capped; NULL or empty becomes ``N/A``."""
    return F.when(col.isNull() | (col == ""), F.lit("N/A")).otherwise(
        F.substring(squeeze(col), 1, max_chars)
    )


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def null_like(col: Column, words: Sequence[str] = fv.NULL_WORDS) -> Column:
    """NULL for an empty text and for words that mean "nothing", in any case."""
    return F.when((col != "") & ~F.lower(col).isin(list(words)), col)


def key_from_href(href: Column, prefix: str) -> Column:
    return strip(F.replace(href, F.lit(prefix), F.lit("")))


def keyword_flag(
    key: Column, name: Column, description: Column, keywords: Sequence[str] = fv.FLAG_KEYWORDS
) -> Column:
    """True when any keyword occurs, as a substring and in any case, in the three texts."""
    empty = F.lit("")
    text = F.lower(F.concat_ws(
        " ", F.coalesce(key, empty), F.coalesce(name, empty), F.coalesce(description, empty)
    ))
    return reduce(lambda a, b: a | b, [text.contains(k) for k in keywords], F.lit(False))
