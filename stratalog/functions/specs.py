"""Specification rows (tag, size, context) in page text, and their roll-up."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions.amounts import round_tenth
from stratalog.functions.markup import in_parts

# What a specification row looks like. A tag is a whole run of tag characters, so a
# match starts where a run starts or where the last match ended: a long run without white space is
# scanned once, not once per character. White space is what Unicode says, without the separators of
# ASCII that Python counts too.
_TAG = r"0-9A-Za-z_.:\-\w"
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# How a specification row is written. The last group is the tag character after it, if any.
_FIELDS = (
    rf"([{_TAG}]++){_SPACE}++(([0-9.\d]+){_SPACE}*[Gg][Bb]){_SPACE}*[·\-]?{_SPACE}*"
    rf"(([0-9.\d]+)((?i:[KM]?)){_SPACE}*(?i:context|(K|M))?)(?=([{_TAG}]?))"
)
_ROW, _NEXT_ROW = re.compile(rf"(?<![{_TAG}]){_FIELDS}"), re.compile(_FIELDS)
_QUANT = re.compile(r"q\d+\w*|fp16|bf16|int\d", re.I)
_FACTORS = {"K": 1e3, "k": 1e3, "M": 1e6}
_LARGEST = (1 << 63) - 1
#: Bytes of text whose rows are made before they are handed on.
_SEARCHED = 1 << 19

_FOUND = ("array<struct<tag:string,size:string,size_gb:double,recommended_ram_gb:double,"
          "quantization:string,context:string,context_window:bigint>>")
_FIELD_TYPES = {
    "tag": pa.string(), "size": pa.string(), "size_gb": pa.float64(),
    "recommended_ram_gb": pa.float64(), "quantization": pa.string(), "context": pa.string(),
    "context_window": pa.int64(),
}


def _strings(texts: pa.Array) -> list[str]:
    """The texts, none for NULL; bytes that are no text are replaced."""
    try:
        return [text or "" for text in texts.to_pylist()]
    except UnicodeDecodeError:
        return [(text or b"").decode("utf-8", "replace") for text in texts.cast(pa.binary()).to_pylist()]


def _matches(text: str) -> list[tuple[str, ...]]:
    """All matches of a text. Where one ends inside a run of tag characters, the next may begin there."""
    found = _ROW.findall(text)
    for match in found:
        if match[7]:
            break
    else:
        return found
    found, match = [], _ROW.search(text)
    while match:
        found.append(match.groups(""))
        match = _NEXT_ROW.match(text, match.end()) or _ROW.search(text, match.end())
    return found


def _number(digits: str) -> float | None:
    """Digits and points as a number, NULL where they are none (``1.2.3``) or not ASCII."""
    try:
        return float(digits) if digits.isascii() else None
    except ValueError:
        return None


def _sized(digits: str) -> tuple[float, float | None, float | None]:
    """(place in the order, size, recommended memory)."""
    gb = _number(digits)
    return gb or fv.UNSIZED_SORT_KEY, gb, round(gb * fv.RAM_FACTOR, 1) if gb else None


def _window(digits: str, unit: str) -> int | None:
    number, factor = _number(digits), _FACTORS.get(unit)
    if number is None or factor is None or number * factor > 2.0 ** 63:
        return None
    return min(int(number * factor), _LARGEST)


def _quantization(tag: str) -> str:
    found = _QUANT.search(tag)
    return found.group().lower() if found else fv.QUANT_DEFAULT


class _Memory(dict):
    """What a function gave for the arguments seen so far."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, arguments):
        self[arguments] = value = self.function(*arguments)
        return value


def _rows_of(texts: list[str]) -> pa.Array:
    """The specification rows of each text."""
    sized, windows, quants = _Memory(_sized), _Memory(_window), _Memory(_quantization)
    rows, bounds = [], [0]
    for text in texts:
        tags, figures, kept = set(), set(), []
        for tag, size, digits, context, number, unit, unit_after, _ in _matches(text) if text else ():
            if tag in tags or "http" in tag.lower():
                continue
            place, gb, ram = sized[digits,]
            figure = (gb, context.strip())
            if figure not in figures:
                tags.add(tag)
                figures.add(figure)
                kept.append((place, tag, size, gb, ram, quants[tag,], figure[1],
                             windows[number, unit or unit_after]))
        kept.sort(key=lambda row: row[0])
        rows += kept
        bounds.append(len(rows))
    columns = list(zip(*rows, strict=True))[1:] if rows else [[]] * len(_FIELD_TYPES)
    values = pa.StructArray.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, _FIELD_TYPES.values(), strict=True)],
        list(_FIELD_TYPES))
    none = [start == end for start, end in zip(bounds, bounds[1:], strict=False)]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values, mask=pa.array(none, pa.bool_()))


def _spec_rows(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([_rows_of(_strings(part)) for part in in_parts(texts, _SEARCHED)])


def spec_rows(page_text: Column) -> Column:
    """All specification rows of a page, deduplicated in page order, smallest size first.

    A row is kept when neither its tag nor its (size, context) belongs to a row kept before it; a
    rejected row blocks nothing, so two independent "first of" windows would lose rows. All of
    it is one Arrow step: array functions would compare every row of a page with every other, and
    lambdas are interpreted. Texts that name no unit are not searched. Sizes that are missing or zero
    sort after everything up to 999 GB. No row gives NULL.
    """
    searched = F.when(page_text.rlike("[gG][bB]"), page_text)
    # Declared as not deterministic so that a filter on the result does not make the choice twice.
    return F.arrow_udf(_spec_rows, _FOUND).asNondeterministic()(searched)


def size_tier(min_gb: Column) -> Column:
    return (
        F.when(min_gb <= fv.FAST_MAX_GB, "fast")
        .when(min_gb <= fv.MEDIUM_MAX_GB, "medium")
        .when(min_gb.isNotNull(), "slow")
    )


def spec_min_gb(specs: Column) -> Column:
    """Smallest positive size, to one decimal."""
    sizes = F.transform(specs, lambda r: r["size_gb"])
    return round_tenth(F.array_min(F.filter(sizes, lambda s: s > 0)))


def spec_max_context(specs: Column) -> Column:
    contexts = F.transform(specs, lambda r: r["context_window"])
    return F.array_max(F.filter(contexts, lambda c: c != 0))
