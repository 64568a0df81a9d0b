"""Expressions whose failing operations are noted instead of ending the job.

A guarded expression is a value and a flag. Each operation that can fail on some rows (a cast, an index, an
arithmetic operation) is built in its ``try_`` form, and the flag says where that form gave NULL although
its inputs were there. ``&``, ``|``, ``when`` and ``either`` take the flag only from the side that a row
comes to: what a condition on the left has ruled out does not fail. Everything stays in one projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _and(*conditions: Column) -> Column:
    out = conditions[0]
    for more in conditions[1:]:
        out = out & more
    return out


def _true(condition: Column) -> Column:
    """NULL is not true."""
    return F.coalesce(condition, F.lit(False))


@dataclass(frozen=True, eq=False)
class Guarded:
    """A value, and whether getting it failed; ``failed`` is never NULL and then ``value`` is."""

    value: Column
    failed: Column

    # ---- operations that can fail -----------------------------------------------------------

    def _tried(self, result: Column, *inputs: Guarded) -> Guarded:
        """``result`` of inputs: it failed if it is NULL and they are not."""
        here = _and(result.isNull(), *[g.value.isNotNull() for g in inputs])
        return Guarded(result, _any_failed(*inputs) | here)

    def _arithmetic(self, other: Any, form: Callable, turned: bool = False) -> Guarded:
        a, b = (given(other), self) if turned else (self, given(other))
        return self._tried(form(a.value, b.value), a, b)

    def __add__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_add)

    def __radd__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_add, True)

    def __sub__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_subtract)

    def __rsub__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_subtract, True)

    def __mul__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_multiply)

    def __rmul__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_multiply, True)

    def __truediv__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_divide)

    def __rtruediv__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_divide, True)

    def __mod__(self, other: Any) -> Guarded:
        return self._arithmetic(other, F.try_mod)

    def cast(self, kind: str) -> Guarded:
        return self._tried(self.value.try_cast(kind), self)

    def __getitem__(self, index: Any) -> Guarded:
        """An element of an array, from 0, or from the end with a negative index. An element that is
        there and NULL is NULL; one that is not there fails."""
        at = given(index)
        place = F.when(at.value < 0, at.value).otherwise(at.value + 1).cast("int")
        size = F.size(self.value)
        outside = (at.value >= size) | (at.value < -size)
        here = _true(_and(self.value.isNotNull(), at.value.isNotNull(), outside))
        return Guarded(F.try_element_at(self.value, place), _any_failed(self, at) | here)

    # ---- operations that cannot ---------------------------------------------------------------

    def _total(self, other: Any, form: Callable) -> Guarded:
        b = given(other)
        return Guarded(form(self.value, b.value), _any_failed(self, b))

    def __gt__(self, other: Any) -> Guarded:
        return self._total(other, lambda a, b: a > b)

    def __ge__(self, other: Any) -> Guarded:
        return self._total(other, lambda a, b: a >= b)

    def __lt__(self, other: Any) -> Guarded:
        return self._total(other, lambda a, b: a < b)

    def __le__(self, other: Any) -> Guarded:
        return self._total(other, lambda a, b: a <= b)

    def __eq__(self, other: Any) -> Guarded:  # type: ignore[override]
        return self._total(other, lambda a, b: a == b)

    def __ne__(self, other: Any) -> Guarded:  # type: ignore[override]
        return self._total(other, lambda a, b: a != b)

    def __invert__(self) -> Guarded:
        return Guarded(~self.value, self.failed)

    def __and__(self, other: Any) -> Guarded:
        b = given(other)
        reached = F.coalesce(self.value, F.lit(True))
        return Guarded(self.value & b.value, self.failed | (reached & b.failed))

    def __or__(self, other: Any) -> Guarded:
        b = given(other)
        return Guarded(self.value | b.value, self.failed | (~_true(self.value) & b.failed))

    def is_null(self) -> Guarded:
        return Guarded(self.value.isNull(), self.failed)


def _any_failed(*inputs: Guarded) -> Column:
    out = inputs[0].failed
    for more in inputs[1:]:
        out = out | more.failed
    return out


def given(value: Any) -> Guarded:
    """A guarded expression as it is, a column or a constant that cannot fail."""
    if isinstance(value, Guarded):
        return value
    return Guarded(value if isinstance(value, Column) else F.lit(value), F.lit(False))


def field(name: str) -> Guarded:
    return given(F.col(name))


def total(function: Callable[..., Column], *inputs: Any) -> Guarded:
    """A function that fails on no row, such as ``F.length``."""
    guarded = [given(i) for i in inputs]
    return Guarded(function(*[g.value for g in guarded]), _any_failed(*guarded))


def when(condition: Any, then: Any, otherwise: Any = None) -> Guarded:
    c, a, b = given(condition), given(then), given(otherwise)
    taken = _true(c.value)
    return Guarded(F.when(taken, a.value).otherwise(b.value),
                   c.failed | F.when(taken, a.failed).otherwise(b.failed))


def either(*inputs: Any) -> Guarded:
    """The first value that is not NULL; inputs behind it cannot fail."""
    guarded = [given(i) for i in inputs]
    out = guarded[-1]
    for g in reversed(guarded[:-1]):
        out = Guarded(F.coalesce(g.value, out.value),
                      g.failed | (g.value.isNull() & out.failed))
    return out
