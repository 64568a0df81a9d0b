"""Phrases that occur together more often than their parts, by sorting suffixes.

Every word of a text begins a suffix: the words from there to the end of its piece, ``max_words`` at most.
Suffixes are packed by language and leading word and routed by them, so all suffixes with the same leading
word meet in one task, unless they are so many that they are dealt over several by the words that follow.
A task sorts its suffixes by multikey quicksort: a partition is split by one word into less, equal and
greater, and the equal part goes on with the next word. Equal partitions are the phrases and the weight in
them is their number; a partition too light for any phrase is given up. All partitions of a depth of
the recursion are split at once on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.llm.common import LOWER, UPPER, written
from stratalog.llm.skew import heavy_keys, look_up
from stratalog.operators.joins import is_small

# Fixed value: what ends a piece.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
NEWLINE, SPACE = 10, 32
# Inside a packed suffix words are joined by NUL. Text may hold a NUL itself: it becomes a tab, which
# can't be in a word.
JOIN = "\x00"
_BYTES = bytes.maketrans((UPPER + PIECE_ENDS + "\t\x00").encode(),
                         (LOWER + "\n" * len(PIECE_ENDS) + " \t").encode())

PACK = "lang string, head string, entries bigint, weight bigint, rests string"
COUNTED = "lang string, phrase string, f bigint"


@dataclass(frozen=True)
class Mining:
    max_words: int = 3
    min_count: int = 10
    inside_percent: int = 50  # of its number a phrase may have inside a longer one
    top: int = 2000  # phrases of a language
    scale: int = 1_000_000
    part_bytes: int = 8 << 20  # text taken apart at once in a task
    task_entries: int = 500_000  # packed suffixes that one task sorts
    split_entries: int = 100_000  # suffixes of one leading word that go to one task


def _parts(texts: list[bytes], size: int) -> Iterator[bytes]:
    """The texts, one below the other, in parts of about ``size`` that end where a piece ends."""
    held, much = [], 0
    for text in texts:
        at = 0
        while len(text) - at > size:
            end = text.find(b"\n", at + size)
            if end < 0:
                break
            yield text[at:end]
            at = end
        held.append(text[at:])
        much += len(text) - at
        if much >= size:
            yield b"\n".join(held)
            held, much = [], 0
    if held:
        yield b"\n".join(held)


def _words(part: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
    """The distinct words, the number of each word in text order, and the piece it is in."""
    data = np.frombuffer(part, np.uint8)
    ends = data == NEWLINE
    inside = ~(ends | (data == SPACE))
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    if not begin.size:
        return None
    offsets = np.concatenate(([0], np.cumsum(end - begin)))
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), begin.size,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])])
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).cast(pa.string())
    return words, coded.indices.to_numpy().astype(np.int64), np.cumsum(ends)[begin]


def _pack(lang: str, part: bytes, max_words: int) -> pa.RecordBatch | None:
    """One row a leading word: its suffixes as lines ``w2 NUL w3``, with the number after a space
    where it is not 1."""
    read = _words(part)
    if read is None:
        return None
    words, ids, piece = read
    n, base = ids.size, len(words) + 1
    following = []
    for k in range(1, max_words):
        next_word = np.zeros(n, np.int64)
        next_word[:-k] = np.where(piece[k:] == piece[:-k], ids[k:] + 1, 0)
        following.append(next_word)
    code = ids
    for next_word in following:
        _, code = np.unique(code, return_inverse=True)
        code = code * base + next_word
    _, first, number = np.unique(code, return_index=True, return_counts=True)
    # Words that follow, with 0 for none; from the third on with the sign that joins them.
    none = pa.array([""])
    second = pa.concat_arrays([none, words])
    later = pa.concat_arrays([none, pc.binary_join_element_wise("", words, JOIN)])
    fields = [(later if k else second).take(pa.array(w[first])) for k, w in enumerate(following)]
    text = pa.array(number).cast(pa.string())
    many = pc.if_else(pa.array(number == 1), "", pc.binary_join_element_wise("", text, " "))
    line = pc.binary_join_element_wise(*fields, many, "")
    # Codes are ordered by leading word first, so its suffixes lie together.
    head = ids[first]
    starts = np.flatnonzero(np.diff(head, prepend=-1))
    bounds = np.append(starts, first.size)
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), line)
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * starts.size, pa.string()), words.take(pa.array(head[starts])),
        pa.array(np.diff(bounds)), pa.array(np.add.reduceat(number, starts).astype(np.int64)),
        pc.binary_join(lists, "\n")],
        names=["lang", "head", "entries", "weight", "rests"])


def packed_suffixes(docs: DataFrame, mining: Mining) -> DataFrame:
    """Packs of suffixes of all documents, counted together within a task's parts of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text")
            for lang in langs.unique().to_pylist():
                mine = texts.filter(pc.equal(langs, lang)).to_pylist()
                for part in _parts([t.encode().translate(_BYTES) for t in mine], mining.part_bytes):
                    rows = _pack(lang, part, mining.max_words)
                    if rows is not None:
                        yield rows

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, PACK)


def equal_partitions(keys: np.ndarray, weight: np.ndarray, minimum: int, shared: np.ndarray,
                     whole_from: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of the columns of ``keys`` (words by depth, -1 behind the end).

    Yields (depth, members, weights): for equal partitions of ``depth`` words, one column out of each and
    the weight in it. A partition lighter than ``minimum`` is given up, but where a column in it is
    ``shared`` (other tasks have some of the same leading words) not before ``whole_from`` words.
    """
    depths, n = keys.shape
    order, length, depth = np.arange(n), np.array([n]), np.array([0])
    while order.size:
        start = np.cumsum(length) - length
        segment = np.repeat(np.arange(length.size), length)
        value = keys[depth[segment], order]
        side = np.sign(value - value[start + length // 2][segment]) + 1
        # A stable move to the three parts of each partition, without sorting.
        counts = np.bincount(segment * 3 + side, minlength=3 * length.size)
        begin = (np.cumsum(counts) - counts)
        target = np.empty(order.size, np.int64)
        for s in range(3):
            mine = side == s
            seen = np.cumsum(mine)
            before = (seen[start] - mine[start])[segment]
            target[mine] = (begin[segment * 3 + s] + seen - before - 1)[mine]
        moved = np.empty_like(order)
        moved[target] = order
        held = np.flatnonzero(counts)
        length, equal, depth = counts[held], held % 3 == 1, depth[held // 3]
        start = np.cumsum(length) - length
        total = np.add.reduceat(weight[moved], start)
        open_ = np.maximum.reduceat(shared[moved], start)
        member = moved[start]
        ended = equal & (keys[depth, member] < 0)
        depth = depth + equal
        stays = (total >= minimum) | (open_ & (depth < whole_from))
        for d in range(1, depths + 1):
            found = equal & ~ended & (depth == d) & ((total >= minimum) | (open_ & (d <= whole_from)))
            if found.any():
                yield d, member[found], total[found]
        stays &= ~ended & (depth < depths)
        order, length, depth = moved[np.repeat(stays, length)], length[stays], depth[stays]


def _sort_task(packs: pa.Table, mining: Mining) -> Iterator[pa.RecordBatch]:
    lines = pc.split_pattern(packs["rests"].combine_chunks().cast(pa.large_string()), "\n")
    pack = np.repeat(np.arange(packs.num_rows), np.diff(np.asarray(lines.offsets)))
    line = lines.flatten()
    halves = pc.split_pattern(line, " ", max_splits=1)
    at = np.asarray(halves.offsets)
    flat = halves.flatten()
    weight = np.ones(len(line), np.int64)
    counted = np.flatnonzero(np.diff(at) == 2)
    weight[counted] = flat.take(pa.array(at[counted] + 1)).cast(pa.int64()).to_numpy()
    rests = pc.split_pattern(flat.take(pa.array(at[:-1])), JOIN)
    at, flat = np.asarray(rests.offsets), rests.flatten()
    coded = flat.dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    empty = pc.index(words, pa.scalar("", words.type)).as_py()  # no word follows
    keys = np.full((mining.max_words, len(line)), -1, np.int64)
    lead = pc.binary_join_element_wise(packs["lang"], packs["head"], "\n").combine_chunks()
    keys[0] = lead.dictionary_encode().indices.to_numpy().astype(np.int64)[pack]
    for k in range(1, mining.max_words):
        has = np.flatnonzero(np.diff(at) >= k)
        found = ids[at[has] + k - 1]
        keys[k, has] = np.where(found == empty, -1, found)
    shared = np.asarray(packs["shared"])[pack]
    for depth, member, total in equal_partitions(keys, weight, mining.min_count, shared, 2):
        if depth == 1:
            continue  # leading words are counted over all packs
        of = pa.array(pack[member])
        fields = [packs["head"].combine_chunks().take(of).cast(words.type)]
        fields += [words.take(pa.array(keys[k, member])) for k in range(1, depth)]
        phrase = pc.binary_join_element_wise(*fields, pa.scalar(JOIN, words.type)).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [packs["lang"].combine_chunks().take(of), phrase, pa.array(total)],
            names=["lang", "phrase", "f"])


def phrase_counts(docs: DataFrame, mining: Mining) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``max_words`` words with ``min_count`` occurrences, words
    joined by NUL; and (lang, n), all occurrences of words."""
    packs = written(packed_suffixes(docs, mining), "suffixes")
    heads = written(packs.groupBy("lang", "head").agg(
        F.sum("entries").alias("entries"), F.sum("weight").alias("weight")), "leading_words")
    size = heads.groupBy("lang").agg(F.sum("weight").alias("n"))
    entries = heads.agg(F.sum("entries")).first()[0] or 0
    # Suffixes of one leading word that are too many for a task are dealt by the words that follow.
    limit = mining.split_entries
    split = written(heads.filter(F.col("entries") > limit).select(
        "lang", "head", F.ceil(F.col("entries") / limit).cast("int").alias("ways")), "split_words")
    head = ["lang", "head"]
    if is_small(split):
        routed = packs.join(F.broadcast(split), head, "left")
    else:
        routed = look_up(packs, head, split, heavy_keys(packs, head, packs.count()), "left")
    lone = routed.filter("ways IS NULL").select(
        "lang", "head", F.lit(0).alias("way"), "rests", F.lit(False).alias("shared"))
    way = F.pmod(F.xxhash64(F.substring_index("line", " ", 1)), "ways").cast("int")
    dealt = routed.filter("ways IS NOT NULL").select(
        "lang", "head", "ways", F.explode(F.split("rests", "\n")).alias("line")).select(
        "lang", "head", way.alias("way"), F.col("line").alias("rests"), F.lit(True).alias("shared"))
    tasks = max(1, -(-entries // mining.task_entries))
    placed = lone.unionByName(dealt).repartition(tasks, "lang", "head", "way")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if sum(b.num_rows for b in held):
            yield from _sort_task(pa.Table.from_batches(held), mining)

    longer = placed.mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    single = heads.select("lang", F.col("head").alias("phrase"), F.col("weight").alias("f"))
    found = single.unionByName(longer).filter(F.col("f") >= mining.min_count)
    return written(found, "phrases"), size


def _words_of(phrase: Column) -> Column:
    return F.split(phrase, JOIN)


def collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The best phrases of each language of ``docs`` (text, lang): lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's number, ``l`` and ``r`` those of the two parts that its weakest cut leaves, ``n``
    all words of the language, ``score`` scale * a * a / (l * r), exact and rounded down. A phrase that
    is mostly met inside a longer one is left out. NULL text is empty, NULL lang is ``und``. Repeated rows
    count each time. Texts of any length are read whole; ties go by number, then by the phrase's bytes.
    Other columns are not read. An empty table, or one without words, gives no rows.
    """
    found, size = phrase_counts(docs, mining)
    words = _words_of(F.col("phrase"))
    many = F.size("words")
    cands = found.withColumn("words", words).filter(many >= 2)
    cuts = cands.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(
        F.sequence(F.lit(1), many - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k",
                       F.array_join(F.slice("words", F.lit(1), F.col("k")), JOIN).alias("first"),
                       F.array_join(F.slice("words", F.col("k") + 1, many - F.col("k")), JOIN)
                       .alias("rest"))
    cuts = written(cuts, "cuts")
    rows = cuts.count()
    for side, number in (("first", "l"), ("rest", "r")):
        given = found.select("lang", F.col("phrase").alias(side), F.col("f").alias(number))
        cuts = look_up(cuts, ["lang", side], given, heavy_keys(cuts, ["lang", side], rows))
    a, left, right = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", a * a * mining.scale, left * right)
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), least)

    longer = cands.filter(many >= 3)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), many - 1), lambda size_: F.transform(
        F.sequence(F.lit(1), many - size_ + 1),
        lambda at: F.array_join(F.slice("words", at, size_), JOIN))))
    inner = longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("within"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("within").isNull() | (100 * F.col("within") < mining.inside_percent * F.col("a")))
    # Back to spaces, and to the NUL that a tab stands for.
    shown = F.replace(F.replace(F.col("phrase"), F.lit(JOIN), F.lit(" ")), F.lit("\t"), F.lit("\x00"))
    kept = kept.select("lang", shown.alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(
        F.col("rank") <= mining.top)
    return best.join(size, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
