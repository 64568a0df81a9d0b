"""Personal data in texts, plain and disguised, with spans in the source text.

Plain forms are found by patterns. Disguised ones go through transducers that rewrite a text and keep,
for each character written, the range of source characters it stands for: look-alike letters and digits
become ASCII, invisible characters go, spelled digits become digits, and at/dot in words or brackets
become ``@`` and ``.``. The same detectors run on the result and their spans are mapped back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.session import ship

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A part that repeats never gives characters back: what follows it starts with one it cannot hold.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Digits that begin no address are passed over as a whole, not from each of them anew.
_IP = re.compile(r"[0-9]++(?:((?:\.[0-9]++){3})|)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the longest run of name characters before an ``@``, then a dotted name."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def ips(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        if match.group(1) is None:
            continue
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield match.span()


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() <= 2 * 19:
            digits = match.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield match.span()


def phones(text: str) -> Iterator[Span]:
    for match in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(match.group())) <= 15:
            yield match.span()


DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = dict(
    zip(KINDS, (emails, ips, cards, phones), strict=True))

# Letters of other scripts that look like ASCII ones, in the order of those.
_LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһӏԛԝ" "АВЕКМНОРСТУХІЈЅ" "αοινυκρτχ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "․。＠·",
    "aeopcyxijsdhlqw" "ABEKMHOPCTYXIJS" "aoivukptx" "ABEZHIKMNOPTYX" "..@.")
_FULLWIDTH = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_OTHER_DIGITS = {c: str(unicodedata.digit(chr(c))) for c in range(0x80, 0x2000)
                 if unicodedata.category(chr(c)) == "Nd"}
_ASCII = _OTHER_DIGITS | _FULLWIDTH | _LOOKALIKES
_INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]")
_ODD = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_ASCII)))) + "]")

# Words for digits.
_DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_VALUES = {word: str(value) for value, word in enumerate(_DIGITS)} | {"oh": "0"}


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SPELLED = "(?:" + "|".join(_any_case(word) for word in (*_DIGITS, "oh")) + ")"
_ITEM = rf"(?:\b{_SPELLED}\b|[0-9]++)"
_POINT = rf"[ ]*[\[({{]?[ ]*(?:{_any_case('dot')}|{_any_case('point')})[ ]*[\])}}]?[ ]*|\."
_RUN = re.compile(rf"(?:\b{_any_case('plus')}[ ]+|\+[ ]*)?{_ITEM}(?:(?:[ ,-]{{1,3}}|{_POINT}){_ITEM})+")
_TOKEN = re.compile(rf"{_SPELLED}|[0-9]+|{_any_case('plus')}|\+|{_POINT}|[ ,-]+")
# Hints are searched in lower case; they may say yes too often, never no where there is a disguise.
_WORD_HINT = "(?:" + "|".join(_VALUES) + ")"
_SPELLED_HINT = re.compile(
    rf"{_WORD_HINT}(?:[ ,-]{{1,3}}|[\[({{ ]+(?:dot|point)|\.)[0-9a-z \])}}]"
    rf"|[0-9](?:[ ,-]{{1,3}}|[ ]*[\[({{]?[ ]*(?:dot|point)[ ]*[\])}}]?[ ]*|\.){_WORD_HINT}")

_OPEN, _CLOSE = r"[ ]*[\[({<][ ]*", r"[ ]*[\])}>][ ]*"
_AT, _DOT = _any_case("at"), _any_case("dot")
_BRACKET_AT = re.compile(rf"{_OPEN}(?:{_AT}|@){_CLOSE}|&#64;|&commat;")
_BRACKET_DOT = re.compile(rf"{_OPEN}(?:{_DOT}|\.){_CLOSE}|&#46;|&period;")
_BARE_DOT, _BARE_AT = rf"[ _]+{_DOT}[ _]+", rf"[ _]+{_AT}[ _]+"
# A bare at before a figure (at 10.30) is no mark.
_FIGURE = rf"[0-9.]++(?!{_BARE_DOT}|[A-Za-z0-9-])"
_BARE = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9.%+-]++(?:{_BARE_DOT}[A-Za-z0-9.%+-]++)*"
                   rf"(?:@|{_BARE_AT}(?!{_FIGURE}))[A-Za-z0-9-]++(?:(?:\.|{_BARE_DOT})[A-Za-z0-9-]++)+")
_BARE_MARK = re.compile(rf"({_BARE_AT})|({_BARE_DOT})")
_POINTS = rf"(?:{_DOT}|{_any_case('point')})"
# A dot in brackets between figures is one wherever it stands; one in words only where no plain point is
# beside the figures: versions and sections are written like that.
_NUMBER_DOT = re.compile(rf"(?<=[0-9])[ ]*[\[({{][ ]*{_POINTS}[ ]*[\])}}][ ]*(?=[0-9])")
_NUMBER_RUN = re.compile(rf"(?<![0-9.])[0-9]++(?:[ ]*{_POINTS}[ ]*[0-9]++)+(?!\.[0-9])")
_NUMBER_MARK = re.compile(rf"[ ]*{_POINTS}[ ]*")

# Last labels that a name with a bare at and plain dots may end in, words before such an at
# that are no names, words that announce an address, and those that announce a version.
_LAST_LABELS = frozenset(
    "com org net edu gov io co uk de fr es it nl eu us ca au ch at be br cn dk fi in info jp mx no nz pl "
    "pt ru se dev app example test".split())
_NO_NAMES = frozenset(
    "a all also am an and are arrive arrived at available back be begin begins bought but buy call chat check "
    "click come contact day down email ends file files find found free go had has have he her here hers him "
    "his home host hosted i in info is it its join live lives located look looked looking looks mail me "
    "meet meeting met more my new news not now off on online only open or order our ours out page pages point "
    "points post posted price published purchase purchased reach read register request sale sell she shop "
    "sign site sold start starts stay stop store stored talk that the their theirs them there these they "
    "this those time times today together up us version via visit was we website week were which who will "
    "work worked working works write you your yours".split())
_CUE = re.compile(r"(?i)\b(?:e-?mails?|mails?|contact|write|reach|address(?:es)?|message|ping|send)"
                  r"(?:[ :,(]+(?:to|me|us|is|are|him|her|them))*[ :,(]+\Z")
_VERSION = re.compile(r"(?i)\b(?:versions?|releases?|sections?|chapters?|v)[ .]*\Z")
#: Characters before a name or number in which an announcing word is looked for.
_NEAR = 40


def _is_name(text: str, match: re.Match) -> bool:
    """Whether what stands before a bare at is a name, and what follows it an address.

    With a dot in words, any but a common word is. With plain dots alone, which end sentences as well,
    the last label must be a known one in small letters, and the name have a figure or mark in it or an
    announcing word right before it.
    """
    said, marks = match.group(), list(_BARE_MARK.finditer(match.group()))
    at = next((mark for mark in marks if mark.group(1)), None)
    if at is None:
        return True
    name = said[:at.start()]
    if name.lower() in _NO_NAMES:
        return False
    if any(mark.group(2) for mark in marks):
        return True
    return said[said.rfind(".") + 1:] in _LAST_LABELS and (
        not name.isalpha() or _CUE.search(text, max(0, match.start() - _NEAR), match.start()) is not None)


_MARK_HINT = re.compile(r"[\[({<][ ]*(?:at|@|\.)[ ]*[\])}>]|&#64|&#46|&commat|&period"
                        r"|[ _]at[ _]+[a-z0-9-]++\.[a-z0-9-]")


def _hints(text: str) -> tuple[bool, bool]:
    """Whether a text may have spelled digits, and at or dot in words or brackets."""
    low = text.lower()
    return (_SPELLED_HINT.search(low) is not None,
            "dot" in low or "point" in low or _MARK_HINT.search(low) is not None)


class Traced:
    """A rewritten text and, for each of its characters, the source range it stands for."""

    def __init__(self, source: str):
        self.text = source
        self.starts: list[int] = list(range(len(source)))
        self.ends: list[int] = list(range(1, len(source) + 1))

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace ranges, given in order; each new character stands for its whole range."""
        text, starts, ends, at = [], [], [], 0
        for start, end, new in changes:
            text.append(self.text[at:start])
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            text.append(new)
            starts += [self.starts[start]] * len(new)
            ends += [self.ends[end - 1]] * len(new)
            at = end
        if changes:
            self.text = "".join([*text, self.text[at:]])
            self.starts = starts + self.starts[at:]
            self.ends = ends + self.ends[at:]

    def replace(self, pattern: re.Pattern, new: str) -> None:
        self.rewrite([(*match.span(), new) for match in pattern.finditer(self.text)])

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _spelled_changes(text: str) -> list[tuple[int, int, str]]:
    """Spelled digits in runs of two items or more; between digits, marks of the run go."""
    changes = []
    for run in _RUN.finditer(text):
        tokens = list(_TOKEN.finditer(text, *run.span()))
        if not any(token.group().lower() in _VALUES for token in tokens):
            continue
        if _VERSION.search(text, max(0, run.start() - _NEAR), run.start()):
            continue
        for k, token in enumerate(tokens):
            said = token.group()
            word = said.strip(" [](){}").lower()
            if word in _VALUES:
                changes.append((*token.span(), _VALUES[word]))
            elif word in ("dot", "point"):
                changes.append((*token.span(), "."))
            elif word == "plus":
                changes.append((*token.span(), "+"))
            elif not said.strip(" ,-") and k and any(
                    near.group().lower() in _VALUES for near in tokens[k - 1:k + 2]):
                changes.append((*token.span(), ""))
    return changes


def _mark_changes(text: str) -> list[tuple[int, int, str]]:
    return [(*mark.span(), "@" if mark.group(1) else ".")
            for match in _BARE.finditer(text) if _is_name(text, match)
            for mark in _BARE_MARK.finditer(text, *match.span())]


def _number_changes(text: str) -> list[tuple[int, int, str]]:
    return [(*mark.span(), ".")
            for run in _NUMBER_RUN.finditer(text)
            if not _VERSION.search(text, max(0, run.start() - _NEAR), run.start())
            for mark in _NUMBER_MARK.finditer(text, *run.span())]


def disguised(text: str) -> Traced | None:
    """The text with its disguises taken off; None where it has none."""
    odd = not text.isascii() and (_ODD.search(text) or _INVISIBLE.search(text))
    spelled, marks = _hints(text)
    if not (odd or spelled or marks):
        return None
    traced = Traced(text)
    if odd:
        traced.text = text.translate(_ASCII)  # one character for one
        traced.replace(_INVISIBLE, "")
        spelled, marks = _hints(traced.text)
    if spelled:
        traced.rewrite(_spelled_changes(traced.text))
    if marks:
        traced.replace(_BRACKET_AT, "@")
        traced.replace(_BRACKET_DOT, ".")
        traced.replace(_NUMBER_DOT, ".")
        traced.rewrite(_number_changes(traced.text))
        traced.rewrite(_mark_changes(traced.text))
    return traced


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised) by start, kind and end; offsets are code points of ``text``.

    A disguised span that overlaps a plain one of its kind is left out: the plain one stays.
    """
    found = []
    traced = disguised(text)
    for order, (kind, detect) in enumerate(DETECTORS.items()):
        plain = list(detect(text))
        found += [(start, order, end, False) for start, end in plain]
        if traced is None:
            continue
        at = 0
        for span in detect(traced.text):
            start, end = traced.source(span)
            while at < len(plain) and plain[at][1] <= start:
                at += 1
            if at == len(plain) or plain[at][0] >= end:
                found.append((start, order, end, True))
    return [(KINDS[order], start, end, added) for start, order, end, added in sorted(found)]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                   ("disguised", pa.bool_())])


def _spans(batches):
    names = [field.name for field in _SPAN]
    for batch in batches:
        rows = [[dict(zip(names, span, strict=True)) for span in find_spans(text or "")]
                for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "spans"])


def private_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text).

    ``spans`` is an array of (kind, start, end, disguised) in the order of ``find_spans``; NULL text
    counts as empty and has none. Rows repeated and NULL ids are kept as they are. Other columns are not
    read. No rows: no rows. A text is searched in time that grows with its length.
    """
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _spans, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, "
                "disguised: boolean>>")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
