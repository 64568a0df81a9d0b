"""Exact deduplication against an index of digests seen before.

The index is a minimal perfect hash over the distinct SHA-256 digests of the texts seen so far. The
digests are dealt into buckets by hash; each bucket has a cascade of bit arrays in which every digest
has one bit of its own, and the rank of the bit is the slot. A slot holds the full digest and the
place of the row that stays. New texts look their slot up and compare all bytes of the digest: a hash
of this kind gives strangers a slot too. Members are repeats; the rest are grouped among themselves.

Buckets hold about ``KEYS_PER_BUCKET`` digests whatever the data, since digests are distinct and
uniform, and arrivals are grouped by digest before they move, so copies of one text are one row a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stratalog.llm.common import WHITE, by_id, written
from stratalog.session import ship

KEYS_PER_BUCKET = 1024
BITS_PER_KEY = 2
MAX_LEVELS = 64
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

SLOT_DDL = ("bucket bigint, slot bigint, digest binary, keep struct<_none: boolean, _id: bigint, "
            "uid: bigint>, copies bigint, levels binary")


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places of digests (rows of four 64-bit words) in a level's bit array."""
    with np.errstate(over="ignore"):
        mixed = (words[:, level % 4] + np.uint64(level) * _GOLDEN) * (_GOLDEN | np.uint64(1))
    return ((mixed >> np.uint64(16)) % np.uint64(size)).astype(np.int64)


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def perfect_hash(digests: list[bytes]) -> tuple[bytes, np.ndarray]:
    """(bit arrays, slot of each digest); slots are 0 to n - 1, one for each distinct digest.

    A level is a 4-byte size and its packed bits. Digests that meet in a level go to the next; two
    different ones that meet in all levels have equal words and cannot exist.
    """
    words = _words(digests)
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, used, levels = np.arange(len(digests)), 0, []
    for level in range(MAX_LEVELS):
        if not len(left):
            break
        size = max(8, BITS_PER_KEY * len(left))
        places = _positions(words[left], level, size)
        alone = np.bincount(places, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        placed = alone[places]
        slots[left[placed]] = used + rank[places[placed]]
        levels.append(np.uint32(size).tobytes() + np.packbits(alone).tobytes())
        used, left = used + int(alone.sum()), left[~placed]
    if len(left):
        raise ValueError("digests to index must be distinct")
    return b"".join(levels), slots


def find_slots(levels: bytes, digests: list[bytes]) -> np.ndarray:
    """The slot of each digest, -1 where no level has its bit."""
    words, found = _words(digests), np.full(len(digests), -1, dtype=np.int64)
    left, used, at, level = np.arange(len(digests)), 0, 0, 0
    while at < len(levels) and len(left):
        size = int(np.frombuffer(levels, np.uint32, 1, at)[0])
        packed = np.frombuffer(levels, np.uint8, (size + 7) // 8, at + 4)
        bits = np.unpackbits(packed, count=size).astype(bool)
        places = _positions(words[left], level, size)
        hit = bits[places]
        rank = np.cumsum(bits) - 1
        found[left[hit]] = used + rank[places[hit]]
        used, left = used + int(bits.sum()), left[~hit]
        at, level = at + 4 + len(packed), level + 1
    return found


def _bucket_slots(group: pd.DataFrame) -> pd.DataFrame:
    levels, slots = perfect_hash(list(group["digest"]))
    group["slot"] = slots
    group["levels"] = [levels if slot == 0 else None for slot in slots]
    return group[["bucket", "slot", "digest", "keep", "copies", "levels"]]


@F.pandas_udf(LongType())
def _slot(bucket: pd.Series, levels: pd.Series, digest: pd.Series) -> pd.Series:
    slots = np.full(len(digest), -1, dtype=np.int64)
    for rows in bucket.groupby(bucket).indices.values():
        if levels.iloc[rows[0]] is not None:
            slots[rows] = find_slots(bytes(levels.iloc[rows[0]]),
                                     [bytes(digest.iloc[row]) for row in rows])
    return pd.Series(slots)


@dataclass
class DigestIndex:
    """Slots as a table in the shared folder; one row of each bucket also has its bit arrays."""

    slots: DataFrame
    n_buckets: int


def text_digest(text: Column) -> Column:
    """SHA-256 of a text with each run of white space as one space; NULL counts as empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def digest_rows(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, digest) of every row, written; ``uid`` tells rows with one doc_id apart."""
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
    return written(rows.withColumn("uid", F.monotonically_increasing_id()), "digests")


def _grouped(rows: DataFrame) -> DataFrame:
    keep = F.struct(*by_id(F.col("doc_id")), "uid")
    return rows.groupBy("digest").agg(F.min(keep).alias("keep"), F.count("*").alias("copies"))


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets).cast("bigint"))


def build_index(rows: DataFrame) -> DigestIndex:
    """Index of the distinct digests of (uid, doc_id, digest) rows. No rows: an empty index."""
    ship(rows.sparkSession)
    groups = written(_grouped(rows), "history")
    n_buckets = max(1, -(-groups.count() // KEYS_PER_BUCKET))
    slots = (groups.withColumn("bucket", _bucket(n_buckets)).groupBy("bucket")
             .applyInPandas(_bucket_slots, SLOT_DDL))
    return DigestIndex(written(slots, "slots"), n_buckets)


def look_up(groups: DataFrame, index: DigestIndex) -> DataFrame:
    """``groups`` (digest, keep, copies) with the slot found and whether its digest is the same."""
    functions = index.slots.filter("levels IS NOT NULL").select("bucket", "levels")
    slots = index.slots.select("bucket", "slot", F.col("digest").alias("stored"))
    probes = (groups.withColumn("bucket", _bucket(index.n_buckets))
              .join(functions, "bucket", "left")
              .withColumn("slot", _slot("bucket", "levels", "digest")).drop("levels"))
    return (probes.join(slots, ["bucket", "slot"], "left")
            .withColumn("member", F.coalesce(F.col("stored") == F.col("digest"), F.lit(False)))
            .drop("stored"))


def resolve(arrivals: DataFrame, index: DigestIndex) -> DataFrame:
    """(digest, keep, copies) of all texts of the index and of the arriving rows together."""
    looked = written(look_up(_grouped(arrivals), index), "looked")
    repeats = looked.filter("member").select(
        "bucket", "slot", F.col("keep").alias("new_keep"), F.col("copies").alias("new_copies"))
    known = index.slots.join(repeats, ["bucket", "slot"], "left").select(
        "digest", F.least("keep", F.coalesce("new_keep", "keep")).alias("keep"),
        (F.col("copies") + F.coalesce("new_copies", F.lit(0))).alias("copies"))
    return known.unionByName(looked.filter("NOT member").select("digest", "keep", "copies"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    The lower half of the range of ids counts as history and is indexed; the other rows arrive and
    are looked up. Where the cut lies doesn't change the result. Of equal texts the smallest doc_id
    stays; NULL ids come last, and of rows repeated with one id one stays. NULL text is the empty
    text, and empty texts are equal to each other. Other columns of ``docs`` are not read. An empty
    table gives no rows.
    """
    rows = digest_rows(docs)
    cut = rows.agg(F.expr("min(doc_id) div 2 + max(doc_id) div 2")).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(cut).cast("bigint"), F.lit(False))
    groups = resolve(rows.filter(~old), build_index(rows.filter(old)))
    return rows.join(groups, "digest").select(
        "doc_id", F.col("keep._id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("uid") == F.col("keep.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
