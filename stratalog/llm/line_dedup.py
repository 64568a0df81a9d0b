"""Line deduplication: documents that share rare pieces of lines are aligned, and what a document has in
common with an earlier one goes from the later of the two.

1. Candidates. Of the shorter runs of words in each run of ``block_words`` words, the one with the least hash
   is its anchor; equal runs have equal anchors and about one shorter run in seven is an anchor at all. A text
   meets others through the anchors it shares, and among those through the runs it shares: each run
   leads to a document that has the whole of it and a smaller id, however many have it.
2. Alignment. Runs that follow each other in a text and in its holder make one common block. The blocks
   of each pair of texts are aligned by patience; those that cross the alignment are aligned anew, until
   nothing that both have is left.
3. The aligned blocks go from the later text, word by word: a block may begin and end mid-line.

Words are what white space divides; which white space it is does not count. ``cut_lines`` says what a line
is where removed lines are counted.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import written
from stratalog.session import ship

MIN_WORDS, LONG_WORDS, CUT_ONE_IN = 4, 24, 8
BLOCK_WORDS = 25
#: Characters whose words are hashed in one go, powers that are remembered, and characters of a word that is
#: hashed by itself.
CHUNK_CHARS, CHUNK_WORDS, LONG_WORD = 1 << 19, 1 << 20, 64
#: Entries that a task compares and deals at once, and characters of text to a bucket of each kind.
LOT_ENTRIES, ANCHOR_CHARS, RUN_CHARS = 1 << 18, 1 << 26, 1 << 24

_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+[^\S\n]*\n?|\n|\Z)")
_WORD = re.compile(r"\S+\s*")
_WHITE = re.compile(r"\s")


def _sentences(text: str) -> Iterator[tuple[str, int]]:
    """(line, words) in order, before long lines are cut."""
    held, held_words = "", 0
    for match in _SENTENCE.finditer(text):
        part = match.group()
        if not part:
            continue
        held += part
        held_words += len(part.split())
        if held_words >= MIN_WORDS or part.endswith("\n"):
            yield held, held_words
            held, held_words = "", 0
    if held:
        yield held, held_words


def cut_lines(text: str) -> list[tuple[str, int]]:
    """(line, words) in order; the lines run together are the text."""
    lines = []
    for line, words in _sentences(text):
        lines.extend(_cut_long(line) if words > LONG_WORDS else [(line, words)])
    return lines


def _touched_lines(text: str, gone: list[tuple[int, int]]) -> int:
    """How many lines of a text have characters in ranges, which rise. Lines without are not cut on."""
    touched, at, k = 0, 0, 0
    for sentence, words in _sentences(text):
        end = at + len(sentence)
        while k < len(gone) and gone[k][1] <= at:
            k += 1
        if k < len(gone) and gone[k][0] < end:
            for line, _ in _cut_long(sentence) if words > LONG_WORDS else [(sentence, words)]:
                while k < len(gone) and gone[k][1] <= at:
                    k += 1
                touched += k < len(gone) and gone[k][0] < at + len(line)
                at += len(line)
        at = end
    return touched


_SPACES = np.array([chr(code).isspace() for code in range(0x3002)])


def _word_starts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    white = _SPACES[np.minimum(codes, len(_SPACES) - 1)]
    return np.flatnonzero(~white & np.append(True, white[:-1]))


def _cut_long(line: str) -> list[tuple[str, int]]:
    parts, start, count = [], 0, 0
    for match in _WORD.finditer(line):
        count += 1
        word = match.group().rstrip()
        if count >= MIN_WORDS and zlib.crc32(word.encode()) % CUT_ONE_IN == 0:
            parts.append((line[start:match.end()], count))
            start, count = match.end(), 0
    if start < len(line):
        parts.append((line[start:], count))
    return parts


_BASE = 0x9E3779B97F4A7C15
_held_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64, remembered up to ``CHUNK_WORDS``."""
    held = _held_powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK_WORDS), base, np.uint64)
        held[:1] = 1
        np.multiply.accumulate(held, out=held)
        if n <= CHUNK_WORDS:
            _held_powers[base] = held
    return held[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(factor)
    return values ^ (values >> np.uint64(29))


#: A number for each code point.
_LETTERS = _mixed(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(_BASE))


def _hashed_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(first characters, hashes) of the words of a text. All words are hashed at once, as polynomials of
    their characters; the few that are longer than ``LONG_WORD`` one by one."""
    if text.isascii():
        codes = np.frombuffer(text.encode("ascii"), np.uint8)
        white = _SPACES[codes]
    else:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        white = _SPACES[np.minimum(codes, len(_SPACES) - 1)]
    white = np.concatenate(([True], white, [True]))
    edges = np.flatnonzero(white[1:] != white[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_LETTERS[codes] * _powers(_BASE, len(codes)), out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(codes))[starts])
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(text[starts[k]:ends[k]])
    return starts, hashes


def _word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """What ``_hashed_words`` gives, a bounded part of the text at a time."""
    if len(text) <= CHUNK_CHARS:
        return _hashed_words(text)
    parts, at = [], 0
    while at < len(text):
        white = _WHITE.search(text, at + CHUNK_CHARS)
        end = white.start() if white else len(text)
        starts, hashes = _hashed_words(text[at:end])
        parts.append((starts + at, hashes))
        at = end
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` elements: a polynomial modulo 2**64, whose base can be divided by."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=sums[1:])
    return (sums[n:] - sums[:-n]) * _powers(_INVERSE, len(hashes) - n + 1)


def _anchors(hashes: np.ndarray, block_words: int) -> np.ndarray:
    """The anchor of each run of ``block_words`` words, which depends on the run's words alone."""
    gram = block_words // 2 + 1
    least = _rolled(hashes, gram)
    least ^= least >> np.uint64(32)
    least *= np.uint64(0xD6E8FEB86659FD93)
    least ^= least >> np.uint64(32)
    held, span = 1, block_words - gram + 1
    while held < span:
        step = min(held, span - held)
        least = np.minimum(least[:-step], least[step:])
        held += step
    return least.view(np.int64)


def _runs(texts: list[str], block_words: int):
    """(text numbers, first words, anchors, words' hashes, places of the runs among these) of all runs,
    some texts at a time."""
    first, chars = 0, 0
    for number, text in enumerate(texts):
        chars += len(text or "")
        if chars < CHUNK_CHARS and number + 1 < len(texts):
            continue
        held = [text or "" for text in texts[first:number + 1]]
        numbers, offsets = np.arange(first, number + 1), np.zeros(len(held), np.int64)
        np.cumsum([len(text) + 1 for text in held[:-1]], out=offsets[1:])
        first, chars = number + 1, 0
        starts, hashes = _word_hashes("\n".join(held))
        if len(hashes) < block_words:
            continue
        firsts = np.searchsorted(starts, offsets)
        counts = np.diff(np.append(firsts, len(starts)))
        at = np.arange(len(hashes)) - np.repeat(firsts, counts)
        whole = np.flatnonzero(at + block_words <= np.repeat(counts, counts))
        if len(whole):
            yield (np.repeat(numbers, counts)[whole], at[whole].astype(np.int32),
                   _anchors(hashes, block_words)[whole], hashes, whole)


def _first_holders(keys: np.ndarray, docs: np.ndarray, at: np.ndarray | None = None):
    """(least id, its least place, largest id) among the entries of each entry's key."""
    order = np.argsort(keys)
    starts = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)[:len(order)])
    if not len(order):
        return docs, at, docs
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    least = np.minimum.reduceat(docs[order], starts)[group]
    most = np.maximum.reduceat(docs[order], starts)[group]
    if at is not None:
        placed = np.where(docs == least, at, np.iinfo(at.dtype).max)
        at = np.minimum.reduceat(placed[order], starts)[group]
    return least, at, most


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


class _Lot:
    """Entries of a task, dealt to buckets when there are enough.

    An entry whose key an earlier document of the lot has needs no other to tell that it is shared:
    it goes to a bucket by its document. Only a key's first document in a lot goes to the bucket of the
    key's anchor, so a key that a third of all documents have sends its bucket one document a lot.
    """

    def __init__(self, names: list[str], buckets: int):
        self.names, self.buckets, self.parts, self.held = names, buckets, [], 0

    def add(self, *entries: np.ndarray):
        self.parts.append(entries)
        self.held += len(entries[0])
        if self.held >= LOT_ENTRIES:
            yield self.dealt()

    def rest(self):
        if self.parts:
            yield self.dealt()

    def dealt(self) -> pa.RecordBatch:
        keys, docs, anchors, *runs = map(np.concatenate, zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        at, hashes = runs or (None, None)
        holders, holder_at, most = _first_holders(keys, docs, at)
        bucket = _bucket_of(np.where(holders < docs, docs, anchors), self.buckets)
        if self.buckets <= 1 << 16:
            bucket = bucket.astype(np.uint16)  # sorted by radix
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order].astype(np.int64)
        starts = np.flatnonzero(np.append(True, np.diff(bucket) != 0))
        offsets = pa.array(np.append(starts, len(order)), pa.int32())
        have = {"keys": keys, "docs": docs, "several": holders < most, "at": at, "hashes": hashes,
                "holders": holders, "holder_at": holder_at}
        lists = [pa.ListArray.from_arrays(offsets, pa.array(have[name][order])) for name in self.names]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts]), *lists], ["bucket", *self.names])


_ANCHOR_LISTS = {"keys": "bigint", "docs": "bigint", "several": "boolean"}
_RUN_LISTS = {"keys": "bigint", "docs": "bigint", "at": "int", "hashes": "bigint", "holders": "bigint",
         "holder_at": "int"}


def _dealt_type(columns: dict[str, str]) -> str:
    return "bucket bigint, " + ", ".join(f"{name} array<{kind}>" for name, kind in columns.items())


def _anchor_entries(block_words: int, buckets: int):
    """Each anchor of each text."""

    def entries_of(batches):
        lot = _Lot(list(_ANCHOR_LISTS), buckets)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, _, anchors, *_ in _runs(batch.column("text").to_pylist(), block_words):
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (anchors[1:] != anchors[:-1])
                yield from lot.add(anchors[new], ids[rows[new]], anchors[new])
        yield from lot.rest()

    return entries_of


def _run_entries(block_words: int, buckets: int):
    """Each run of a text whose anchor another document has too."""

    def entries_of(batches):
        lot = _Lot(list(_RUN_LISTS), buckets)
        for batch in batches:
            ids, hashes = batch.column("key").to_numpy(), batch.column("text_hash").to_numpy()
            shared = batch.column("shared")
            bounds, shared = shared.offsets.to_numpy(), shared.values.to_numpy()
            for rows, at, anchors, words, places in _runs(
                    batch.column("text").to_pylist(), block_words):
                # An anchor that one text shares is shared in all texts that have it.
                keep = np.isin(anchors, shared[bounds[rows[0]]:bounds[rows[-1] + 1]])
                if keep.any():
                    runs = _rolled(words, block_words).view(np.int64)[places[keep]]
                    yield from lot.add(
                        runs, ids[rows[keep]], anchors[keep], at[keep], hashes[rows[keep]])
        yield from lot.rest()

    return entries_of


def _entries(bucket: pa.Table) -> dict[str, np.ndarray]:
    return {name: bucket.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            for name in bucket.column_names if name != "bucket"}


def _by_document(docs: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """One row for each id, with its values of the columns as lists."""
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    new = np.append(True, docs[1:] != docs[:-1])[:len(docs)]
    starts = np.flatnonzero(new)
    offsets = pa.array(np.append(starts, len(docs)), pa.int32())
    lists = {name: pa.ListArray.from_arrays(offsets, pa.array(v[order])) for name, v in columns.items()}
    return pa.table({"doc_id": pa.array(docs[starts]), **lists})


def _shared_anchors(bucket: pa.Table) -> pa.Table:
    """(doc_id, anchors): those that documents of several ids have."""
    entry = _entries(bucket)
    least, _, most = _first_holders(entry["keys"], entry["docs"])
    shared = entry["several"] | (least < most)
    return _by_document(entry["docs"][shared], anchors=entry["keys"][shared])


def _joined(texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, holders: np.ndarray,
            holder_starts: np.ndarray) -> list[np.ndarray]:
    """The same columns with ranges that go on in both texts made one, by text."""
    if not len(texts):
        return [texts, starts, ends, holders, holder_starts]
    shift = holder_starts.astype(np.int64) - starts
    order = np.lexsort((starts, shift, holders, texts))
    texts, starts, ends, holders, holder_starts, shift = (
        values[order] for values in (texts, starts, ends, holders, holder_starts, shift))
    first = np.flatnonzero(np.append(True, (
        np.diff(texts) != 0) | (np.diff(holders) != 0) | (np.diff(shift) != 0) | (starts[1:] > ends[:-1])))
    return [texts[first], starts[first], np.maximum.reduceat(ends, first), holders[first],
            holder_starts[first]]


def _common_ranges(block_words: int):
    """The ranges of words that a document with a smaller id has, each with a holder and its place
    there. The runs of an anchor are in one bucket, so a range is many runs."""

    def ranges_of(bucket: pa.Table) -> pa.Table:
        entry = _entries(bucket)
        docs, at = entry["docs"], entry["at"]
        least, least_at, _ = _first_holders(entry["keys"], docs, at)
        told = entry["holders"] < docs
        holders = np.where(told, entry["holders"], least)
        holder_at = np.where(told, entry["holder_at"], least_at)
        later = np.flatnonzero(holders < docs)
        later = later[np.argsort(docs[later], kind="stable")]
        # Texts get numbers, so that ranges of two of them are never joined.
        docs, at = docs[later], at[later]
        numbers = np.cumsum(np.append(True, np.diff(docs) != 0)[:len(docs)]) - 1
        hashes = entry["hashes"][later]
        _, texts = np.unique(np.stack([numbers, hashes]), axis=1, return_inverse=True)
        texts = texts.reshape(-1)
        doc_of, hash_of = np.empty((2, len(docs)), np.int64)
        doc_of[texts], hash_of[texts] = docs, hashes
        texts, *ranges = _joined(texts, at, at + np.int32(block_words), holders[later], holder_at[later])
        out = [doc_of[texts], hash_of[texts], *ranges]
        return pa.table(dict(zip(["doc_id", *_BLOCK], out, strict=True)))

    return ranges_of


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs (i, j), rising in both, with a[i] == b[j]: equal ends, then the longest rising series of
    elements that both have once, and the same again in each gap between them."""
    matches, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matches.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matches.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        once = [(i, where[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in where]
        i0, j0 = a0, b0
        for i, j in _rising(once):
            todo.append((i0, i, j0, j))
            matches.append((i, j))
            i0, j0 = i + 1, j + 1
        if i0 > a0:
            todo.append((i0, a1, j0, b1))
    return sorted(matches)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second members rise."""
    tails, tops, before = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before.append(tops[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            tops.append(k)
        else:
            tails[at], tops[at] = j, k
    chain, k = [], tops[-1] if tops else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def aligned(ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The common ranges (from_word, to_word, holder, holder_from) of a text, in the order they are aligned
    in: for each holder the longest series that rises in both texts, then what crosses it, and so on
    until none is left."""
    common = defaultdict(list)
    for block in ranges:
        common[block[2]].append(block)
    blocks = []
    for left in common.values():
        while left:
            here = list(range(len(left)))
            there = sorted(here, key=lambda k: left[k][3])
            chain = {i for i, _ in patience(here, there)}
            blocks += [left[i] for i in sorted(chain)]
            left = [block for i, block in enumerate(left) if i not in chain]
    return blocks


_BLOCK = {"text_hash": "bigint", "from_word": "int", "to_word": "int", "holder": "bigint",
          "holder_from": "int"}
_BLOCKS = f"array<struct<{', '.join(f'{name}: {kind}' for name, kind in _BLOCK.items())}>>"


def _aligned_blocks(batches):
    """The blocks of each document, from its common ranges in any order."""
    kind = pa.list_(pa.struct([(name, pa.int64() if of == "bigint" else pa.int32())
                               for name, of in _BLOCK.items()]))
    for batch in batches:
        parts = batch.column("parts")
        counts = np.diff(parts.offsets.to_numpy())
        values = parts.flatten()
        hashes, *ranges = (values.field(name).to_numpy() for name in _BLOCK)
        rows = np.repeat(np.arange(len(counts)), counts)
        _, texts = np.unique(np.stack([rows, hashes]), axis=1, return_inverse=True)
        texts = texts.reshape(-1)
        row_of, hash_of = np.empty((2, len(texts)), np.int64)
        row_of[texts], hash_of[texts] = rows, hashes
        texts, *ranges = _joined(texts, *ranges)
        found: list[list] = [[] for _ in counts]
        bounds = np.flatnonzero(np.append(True, np.diff(texts) != 0)[:len(texts)])
        every = list(zip(*(column.tolist() for column in ranges), strict=True))
        for start, end in zip(bounds, np.append(bounds[1:], len(texts)), strict=True):
            text = int(hash_of[texts[start]])
            found[row_of[texts[start]]] += [
                dict(zip(_BLOCK, (text, *block), strict=True)) for block in sorted(aligned(every[start:end]))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "blocks"])


def _keyed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Texts dealt by id, or by the text where there is none. Both joins use all four columns, so that
    Spark moves the texts once and reads that exchange twice."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))
    return docs.select(
        key.alias("key"), F.xxhash64("text").alias("text_hash"), "text",
        F.struct(*[c for c in columns if c != "text"]).alias("row")).repartition("key")


def _blocks_of(keyed: DataFrame, docs: DataFrame, block_words: int) -> DataFrame:
    ship(docs.sparkSession)
    texts = docs.filter("doc_id IS NOT NULL AND text <> ''").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chars = texts.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    shared = written(
        texts.mapInArrow(_anchor_entries(block_words, chars // ANCHOR_CHARS + 1), _dealt_type(_ANCHOR_LISTS))
        .groupBy("bucket").applyInArrow(_shared_anchors, "doc_id bigint, anchors array<bigint>")
        .groupBy("doc_id").agg(F.flatten(F.collect_list("anchors")).alias("shared")), "anchors")
    runs = keyed.join(shared.withColumnRenamed("doc_id", "key"), "key").select(
        "key", "text_hash", "text", "shared", F.length(F.col("row").cast("string")).alias("_used"))
    ranges = (
        runs.mapInArrow(_run_entries(block_words, chars // RUN_CHARS + 1), _dealt_type(_RUN_LISTS))
        .groupBy("bucket").applyInArrow(
            _common_ranges(block_words), "doc_id bigint, " + ", ".join(
                f"{name} {kind}" for name, kind in _BLOCK.items())))
    parts = F.collect_list(F.struct(*_BLOCK)).alias("parts")
    return ranges.groupBy("doc_id").agg(parts).mapInArrow(
        _aligned_blocks, f"doc_id bigint, blocks {_BLOCKS}")


def aligned_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, blocks): for each document that has runs of words of an earlier one, its aligned blocks:
    ``text_hash`` tells texts with one id apart, ``from_word`` to ``to_word`` is the range of words that
    goes, and ``holder`` has the same words from ``holder_from`` on. Blocks may overlap."""
    return _blocks_of(_keyed(docs, ["doc_id", "text"]), docs, block_words)


def without_words(text: str, blocks: list[tuple[int, int]]) -> tuple[str, int]:
    """A text without ranges of its words, in order of their first words, and how many of its lines are
    cut wholly or in part. White space goes with the word before it, and with the first word where none
    is before."""
    bounds = [0, *_word_starts(text)[1:].tolist(), len(text)]
    gone, kept, at = [], [], 0
    for first, last in blocks:
        if gone and bounds[first] <= gone[-1][1]:
            gone[-1] = (gone[-1][0], max(gone[-1][1], bounds[last]))
        else:
            gone.append((bounds[first], bounds[last]))
    for start, end in gone:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]]), _touched_lines(text, gone)


def _without(texts: pd.Series, blocks: pd.Series) -> pd.DataFrame:
    out = [(None, None) if text is None or ranges is None else without_words(
        text, [(r["from_word"], r["to_word"]) for r in ranges])
        for text, ranges in zip(texts, blocks, strict=True)]
    return pd.DataFrame(out, columns=["text", "lines"]).astype({"text": object, "lines": "Int32"})


def line_dedup(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any others) with each text without the runs of ``block_words`` words and
    more that a document with a smaller id has, and the column ``removed_lines``: how many lines are
    cut wholly or in part (0 where the text is as it was).

    Repeats within one document stay, and so do those between rows of one id. Rows with a NULL id, NULL
    text or empty text are returned as they are; a copy of an earlier document becomes the empty text.
    Other columns are passed on whatever their names; one called ``removed_lines`` is replaced. No
    rows: no rows.
    """
    kept = [c for c in docs.columns if c != "removed_lines"]
    keyed = _keyed(docs, kept)
    blocks = _blocks_of(keyed, docs, block_words).withColumnRenamed("doc_id", "key")
    of_text = F.filter("blocks", lambda b: b["text_hash"] == F.col("text_hash"))
    hit = F.col("row.doc_id").isNotNull() & (F.size("blocks") > 0)
    both = keyed.join(blocks, "key", "left").withColumn("blocks", of_text)
    cut = F.pandas_udf(_without, "text string, lines int")
    both = both.withColumn("hit", hit).withColumn("cut", cut(
        F.when(F.col("hit"), F.col("text")),
        F.transform("blocks", lambda b: F.struct(b["from_word"], b["to_word"]))))
    text = F.when(F.col("hit"), F.col("cut.text")).otherwise(F.col("text"))
    return both.select(
        *[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in kept],
        F.when(F.col("hit"), F.col("cut.lines")).otherwise(0).alias("removed_lines"))
