"""Mentions found in running text. Every builder scans the whole text once.

``\\b`` before a word is spelled out as a look-behind on letters, digits and underscore, and
``\\w`` as the same class: the meaning of both shorthands depends on the engine and its version.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog import fixed_values as fv

WORD = r"\p{L}\p{N}_"
_START = rf"(?<![{WORD}])"
# Letters that more than two characters stand for when case is ignored.
_MORE_CASES = {"i": "\\u0130\\u0131", "k": "\\u212A", "s": "\\u017F"}


def _first_letters(terms: Sequence[str]) -> str:
    """A look-ahead for the letters the terms begin with, or nothing if one begins otherwise.

    It is tried first at every position of a text and fails at most of them with one table look-up.
    """
    letters = {t[0].lower() for t in terms}
    if not all(c.isascii() and c.isalpha() for c in letters):
        return ""
    return f"(?=[{''.join(c + c.upper() + _MORE_CASES.get(c, '') for c in sorted(letters))}])"


def _distinct_capped(found: Column, cap: int) -> Column:
    return F.slice(F.array_distinct(found), 1, cap)


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


# The patterns of this module say what counts as a mention.
def url_mentions(text: Column, host: str = fv.MENTION_HOST, cap: int = 5) -> Column:
    return _distinct_capped(_all(text, rf"(?U)https?://{re.escape(host)}/[^\s\"'>]+"), cap)


def context_mentions(text: Column, cap: int = 5) -> Column:
    # A digit, or a character outside ASCII that may be one.
    pattern = rf"(?=[0-9\u0080-\x{{10FFFF}}]){_START}(?iU:\d+[KM]?\s*(?:context|token|window)s?)"
    return _distinct_capped(_all(text, pattern), cap)


def license_mentions(
    text: Column, terms: Sequence[str] = fv.LICENSE_TERMS, cap: int = 3
) -> Column:
    """Distinct license names. A term may be the start of a longer word."""
    body = "|".join(t.replace(r"\w", WORD) for t in terms)
    return _distinct_capped(_all(text, rf"{_first_letters(terms)}{_START}(?iU:{body})"), cap)


def score_mentions(
    text: Column, names: Sequence[str] = fv.BENCHMARK_NAMES, cap: int = 8
) -> Column:
    """A known name with the first number at most 60 characters on; capped, then distinct."""
    body = "|".join(names)
    pattern = (
        rf"{_first_letters(names)}{_START}(?iU:(?:{body})[^\n]{{0,60}}?\d+\.?\d*\s*%?)"
    )
    return F.array_distinct(F.slice(_all(text, pattern), 1, cap))
