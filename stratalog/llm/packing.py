"""Best-fit packing of token sequences in bulk-synchronous rounds.

Texts become token ids, an end mark behind each. Only what is longer than a sequence is cut. Pieces of
more than half a sequence open one each. The others are taken by ranges of length, longest first; a range
is a round. In a round documents and gaps are dealt to cells of about ``CELL`` each, every cell sorts
its documents by length and sweeps them over its gaps: a document goes to the successor of its length, the
smallest gap that holds it. Of documents that want one gap the first in rank (longer, then smaller number)
has it, and a document without one opens a sequence. What is left of the gaps goes to the next round. Gaps
too small for a range wait for the later ones.

Cells are dealt by hash of unique numbers, so they are even however many documents have one length, and
what a cell wastes is about one sequence in ``CELL`` documents.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import written
from stratalog.session import ship

CAPACITY, END_ID, CELL = 2048, 0, 4096
#: Upper ends of the length ranges, as parts of the capacity.
RANGES = (2, 8, 32)
CACHED_WORDS, CACHED_LENGTH = 600_000, 64
# The one special token of the vocabulary, which is no ordinary text, and its id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

# Fixed value: how the public byte-level vocabulary splits text before it merges bytes.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def default_vocabulary() -> str:
    """The ranks of the 50k byte-level vocabulary, whose ids are those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class WordTokens:
    """Token ids of texts, as bytes of little-endian 32-bit numbers.

    A single space between two characters that are no white space always begins a word of its own, so a
    text may be cut there and the parts' ids joined; ids of parts are remembered, up to a bound.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            pairs = (line.split() for line in lines)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._encoding = tiktoken.Encoding("pack", pat_str=SPLIT, mergeable_ranks=ranks,
                                           special_tokens={})
        self._known: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        ids = array("I", self._encoding.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            between = SPECIAL_ID.to_bytes(4, "little")
            return between.join([self._plain(part) if part else b"" for part in text.split(SPECIAL)])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        first, *parts = text.split(" ")
        if any(not part or part[0].isspace() or part[-1].isspace() for part in (first, *parts)):
            first, *parts = _SINGLE_SPACE.split(text)
        known = self._known
        try:
            rest = b"".join([known[part] for part in parts])
        except KeyError:
            new = {part: self._direct(" " + part) for part in set(parts) if part not in known}
            rest = b"".join([new[part] if part in new else known[part] for part in parts])
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
            known.update((k, v) for k, v in new.items() if len(k) <= CACHED_LENGTH)
        return self._direct(first) + rest


@dataclass(frozen=True)
class Packing:
    capacity: int = CAPACITY
    end_id: int = END_ID
    vocabulary: str | None = None


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole but for the first, which has the remainder."""
    head = n % capacity or capacity
    return [(0, head), *((start, capacity) for start in range(head, n, capacity))]


def _pieces(packing: Packing):
    end = packing.end_id.to_bytes(4, "little")

    def cut(batches):
        tokens = WordTokens(packing.vocabulary or default_vocabulary())
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                ids = (tokens(text) if text else b"") + end
                for k, (start, length) in enumerate(piece_bounds(len(ids) // 4, packing.capacity)):
                    out.append((doc_id, k, start, length,
                                zlib.crc32(ids[4 * start:4 * (start + length)])))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


_PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
_PIECE_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:  # noqa: B008
    """The pieces of every text, written, each with a number of its own (``pid``)."""
    ship(docs.sparkSession)
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(packing), _PIECE_DDL)
    return written(pieces.withColumn("pid", F.monotonically_increasing_id()), "pieces")


def best_fit(lengths: list[int], ids: list[int], gaps: list[tuple[int, int]],
             capacity: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((id, sequence, offset) of each document, gaps left) for documents in rank order and gaps
    (sequence, free). Gaps of one size are taken in order of their number."""
    by_size: dict[int, list[int]] = {}
    for sequence, free in sorted(gaps, reverse=True):
        by_size.setdefault(free, []).append(sequence)
    sizes = sum(1 << size for size in by_size)  # bit g is set while there is a gap of g
    placed = []
    for length, own in zip(lengths, ids, strict=True):
        fitting = sizes >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = by_size[free].pop()
            if not by_size[free]:
                sizes ^= 1 << free
        else:
            free, sequence = capacity, own
        placed.append((own, sequence, capacity - free))
        if free > length:
            by_size.setdefault(free - length, []).append(sequence)
            sizes |= 1 << (free - length)
    return placed, [(s, free) for free, held in by_size.items() for s in held]


_ROUND_DDL = "id bigint, sequence_id bigint, offset bigint, free bigint"


def _sweep(capacity: int):
    def sweep(cell: pd.DataFrame) -> pd.DataFrame:
        docs = cell[cell["free"].isna()].sort_values(["length", "id"], ascending=[False, True])
        gaps = cell[cell["free"].notna()]
        placed, left = best_fit(
            docs["length"].astype(int).tolist(), docs["id"].tolist(),
            list(zip(gaps["id"].tolist(), gaps["free"].astype(int).tolist(), strict=True)), capacity)
        rows = [(own, sequence, offset, None) for own, sequence, offset in placed]
        rows += [(None, sequence, None, free) for sequence, free in left]
        out = pd.DataFrame(rows, columns=["id", "sequence_id", "offset", "free"])
        return out.astype("Int64")

    return sweep


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(pid, sequence_id, offset) of pieces (pid, length); a sequence has the number of its first."""
    half = capacity // RANGES[0]
    whole = pieces.filter(F.col("length") > half)
    parts = [whole.select("pid", F.col("pid").alias("sequence_id"),
                          F.lit(0).cast("bigint").alias("offset"))]
    gaps = whole.filter(F.col("length") < capacity).select(
        F.col("pid").alias("id"), (capacity - F.col("length")).alias("free"))
    ends = [capacity // part for part in RANGES] + [0]
    for high, low in zip(ends, ends[1:], strict=False):
        docs = pieces.filter((F.col("length") <= high) & (F.col("length") > low))
        wide, narrow = gaps.filter(F.col("free") > low), gaps.filter(F.col("free") <= low)
        most = max(docs.count(), wide.count())
        cell = F.pmod(F.xxhash64("id"), F.lit(-(-most // CELL) or 1).cast("bigint"))
        both = docs.select(F.col("pid").alias("id"), "length",
                           F.lit(None).cast("bigint").alias("free")).unionByName(
            wide.select("id", F.lit(None).cast("bigint").alias("length"), "free"))
        done = written(both.withColumn("cell", cell).groupBy("cell")
                       .applyInPandas(_sweep(capacity), _ROUND_DDL), "round")
        parts.append(done.filter("id IS NOT NULL").select(
            F.col("id").alias("pid"), "sequence_id", "offset"))
        gaps = done.filter("free IS NOT NULL").select(
            F.col("sequence_id").alias("id"), "free").unionByName(narrow)
    return reduce(DataFrame.unionByName, parts)


def packed(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:  # noqa: B008
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    NULL and empty texts have the end mark alone. Rows repeated, and rows with a NULL id, are documents
    of their own. The special token's string becomes its one id, wherever it stands. Other columns of
    ``docs`` are not read. No rows: no rows.
    """
    pieces = token_pieces(docs, packing)
    return pieces.join(pack(pieces, packing.capacity), "pid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
