"""Numbers written as text, and decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.text import let, strip

_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"


def number_or_null(text: Column) -> Column:
    """Plain decimal number as double; NULL for anything else (``1.2.3``, ``1d``, ``NaN``)."""
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def magnitude_to_long(text: Column) -> Column:
    """``110.4M``, ``78.4K``, ``1.2B`` or a plain integer as a whole number; otherwise 0.

    M is looked for before K and K before B; fractions of the result are cut off.
    """
    raw = F.replace(F.upper(strip(text)), F.lit(","), F.lit(""))
    raw = F.regexp_replace(raw, r"(?<=[0-9])_(?=[0-9])", "")

    def scaled(unit: str, factor: float) -> Column:
        number = number_or_null(strip(F.replace(raw, F.lit(unit), F.lit(""))))
        return (number * F.lit(factor)).try_cast("bigint")

    value = (
        F.when(raw.contains("M"), scaled("M", 1e6))
        .when(raw.contains("K"), scaled("K", 1e3))
        .when(raw.contains("B"), scaled("B", 1e9))
        .otherwise(F.when(raw.rlike(_INTEGER), raw.try_cast("bigint")))
    )
    return F.coalesce(value, F.lit(0).cast("bigint"))


def round_tenth(x: Column) -> Column:
    """Round to one decimal, deciding ties on the exact binary value and then half to even.

    ``bround`` decides on the printed decimal: it gives 0.4 for 0.35, which is stored as a little
    less than 0.35. Here 20*x is formed without error as ``s + err`` (16x and 4x are exact) and
    compared with the odd number 2k+1 that marks the tie above k tenths.
    """
    def decide(x: Column) -> Column:
        def with_k(k: Column) -> Column:
            a, b = x * 16.0, x * 4.0
            s = a + b
            err = (a - (s - (s - a))) + (b - (s - a))
            tie = k * 2.0 + 1.0
            up = (
                F.when(s > tie, True).when(s < tie, False)
                .when(err > 0, True).when(err < 0, False)
                .otherwise(F.pmod(k, F.lit(2.0)) == 1.0)
            )
            return (k + F.when(up, 1.0).otherwise(0.0)) / 10.0

        return let(F.floor(x * 10.0).cast("double"), with_k)

    return let(x, decide)
