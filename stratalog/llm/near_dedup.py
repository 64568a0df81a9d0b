"""Near-duplicate documents: banded MinHash candidates under sequential Bayesian verification.

Texts with the same words are one class. Each class has a signature of ``Settings.hashes`` minimum
hashes over its word shingles; those that agree in a band of ``Settings.rows`` of them share a bucket.
A bucket doesn't give all its pairs: in each of ``Settings.hub_rounds`` rounds its members meet one of
them, and links found merge them into components. Last, the classes of buckets that still hold several
components meet through their rarest shingles, those of different components alone. So every pair that
shares a bucket and can be linked is compared or already known to be connected.

Candidates are compared by batches of their signatures. After n hashes with m equal, the similarity has
the posterior Beta(m + 1, n - m + 1); a pair whose chance to reach the threshold is under
``Settings.miss`` is dropped. What survives is verified on the full shingle sets.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import lower_ascii, words_of, written
from stratalog.llm.components import components
from stratalog.session import ship


@dataclass(frozen=True)
class Settings:
    """A pair is linked when ``100 * intersection >= percent * union`` of the shingle sets.

    At the threshold itself a pair shares no bucket with probability (1 - t**rows) ** (hashes/rows):
    for 128 hashes in bands of 4, 5e-8 at 0.8 and 6e-11 at 0.85.
    """

    words: int = 5
    percent: int = 80
    hashes: int = 128
    rows: int = 4
    batch: int = 16
    miss: float = 1e-9
    hub_rounds: int = 2


OP_SETTINGS = Settings(words=3, percent=85)

_SEED = 20240229
_WORDS_AT_ONCE = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def shingles(words: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the k-word shingles of documents given as ranges of word hashes.

    With fewer than k words the whole sequence is the one shingle; without words there is none.
    """
    counts = ends - starts
    per_doc = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    doc = np.repeat(np.arange(len(starts)), per_doc)
    first = np.cumsum(per_doc) - per_doc
    at = starts[doc] + (np.arange(len(doc)) - first[doc])
    length = np.minimum(counts, k)[doc]
    padded = np.concatenate([words.view(np.uint64), np.zeros(k, np.uint64)])
    value = _mix(length.astype(np.uint64) + np.uint64(k))
    with np.errstate(over="ignore"):
        for i in range(k):
            step = _mix(value * np.uint64(0x9E3779B97F4A7C15) + padded[at + i])
            value = np.where(i < length, step, value)
    return value, doc


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    top = np.iinfo(np.uint64).max
    return (rng.integers(0, top, n, np.uint64) | np.uint64(1), rng.integers(0, top, n, np.uint64))


def signatures(value: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Minimum hashes (uint32) of runs of shingles that begin at ``first``; no run is empty."""
    a, b = _coefficients(n)
    out = np.empty((len(first), n), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(n):
            moved = (value * a[i] + b[i]) >> np.uint64(32)
            out[:, i] = np.minimum.reduceat(moved, first)
    return out


def _runs(counts: np.ndarray, most: int):
    """Slices of documents with about ``most`` words together, one document at least."""
    total, at = np.cumsum(counts), 0
    while at < len(counts):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + most, "right")))
        yield at, end
        at = end


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column without NULLs, of which values are not copied."""
    return (np.asarray(column.values), np.asarray(column.offsets, dtype=np.int64))


def _signed(settings: Settings):
    bands = settings.hashes // settings.rows

    def sign(batches):
        for batch in batches:
            words, offsets = _lists(batch.column("words"))
            for at, end in _runs(np.diff(offsets), _WORDS_AT_ONCE):
                starts, ends = offsets[at:end], offsets[at + 1:end + 1]
                value, doc = shingles(words, starts, ends, settings.words)
                per_doc = np.bincount(doc, minlength=end - at)
                order = np.lexsort((value, doc))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(value[order].view(np.int64)) != 0) | (np.diff(doc[order]) != 0)
                distinct = np.bincount(doc[order][new], minlength=end - at)
                some = np.flatnonzero(per_doc)
                first = (np.cumsum(per_doc) - per_doc)[some]
                signature = np.zeros((end - at, settings.hashes), np.uint32)
                if len(some):
                    signature[some] = signatures(value, first, settings.hashes)
                parts = signature.reshape(end - at, bands, settings.rows).astype(np.uint64)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (end - at, bands))
                with np.errstate(over="ignore"):
                    for i in range(settings.rows):
                        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
                flat = pa.array(np.ascontiguousarray(key).view(np.int64).reshape(-1))
                edges = pa.array(np.arange(end - at + 1, dtype=np.int32) * bands)
                rest = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns[:3], pa.array(distinct),
                     pa.array([row.tobytes() for row in signature], pa.binary()),
                     pa.ListArray.from_arrays(edges, flat)],
                    [*rest.schema.names[:3], "n_shingles", "signature", "bands"])

    return sign


def _tokens(text: Column) -> Column:
    return words_of(lower_ascii(text))


def _class_digest(words: Column) -> Column:
    """The words joined by one space, hashed: equal for texts with the same words."""
    return F.unhex(F.substring(F.sha2(F.array_join(words, " ").cast("binary"), 256), 1, 32))


def classes(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(rows, classes), written. Rows: doc_id, text_hash, digest, n_shingles. Classes: a row for each different
    sequence of words with its smallest doc_id, a number of its own (node), signature and bands."""
    ship(docs.sparkSession)
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                         _tokens(F.col("text")).alias("tokens"))
    hashed = tokens.select("doc_id", "text_hash", _class_digest(F.col("tokens")).alias("digest"),
                           F.transform("tokens", lambda w: F.xxhash64(w)).alias("words"))
    signed = written(hashed.mapInArrow(
        _signed(settings), "doc_id bigint, text_hash bigint, digest binary, n_shingles bigint, "
                           "signature binary, bands array<bigint>"), "signed")
    groups = signed.groupBy("digest").agg(
        F.min("doc_id").alias("min_id"), F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        F.first("bands").alias("bands"))
    nodes = written(groups.withColumn("node", F.monotonically_increasing_id()), "classes")
    return signed.select("doc_id", "text_hash", "digest", "n_shingles"), nodes


def least_matches(settings: Settings) -> list[int]:
    """For each number n of hashes compared, the fewest equal ones a pair needs to stay.

    The chance that Beta(m + 1, n - m + 1) is t or more is that of at most m hits in n + 1 tries
    of t each.
    """
    t, needed = settings.percent / 100, []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        chance = np.cumsum([comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m) for m in range(n + 1)])
        needed.append(int(np.searchsorted(chance, settings.miss)))
    return needed


def _pruned(settings: Settings):
    needed = least_matches(settings)

    def prune(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32)
                           .reshape(-1, settings.hashes) for name in ("left", "right"))
            alive, equal = np.arange(len(left)), np.zeros(len(left), np.int64)
            for k, least in enumerate(needed):
                part = slice(k * settings.batch, (k + 1) * settings.batch)
                equal = equal + (left[alive, part] == right[alive, part]).sum(axis=1)
                stay = equal >= least
                alive, equal = alive[stay], equal[stay]
            if len(alive):
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return prune


def _survivors(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that the sequential test leaves, written."""
    def side(node: str, signature: str) -> DataFrame:
        return nodes.select(F.col("node").alias(node), F.col("signature").alias(signature))

    both = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b")
    return written(both.select("a", "b", "left", "right")
                   .mapInArrow(_pruned(settings), "a bigint, b bigint"), "survivors")


def _full_sets(settings: Settings):
    def collect(batches):
        for batch in batches:
            words, offsets = _lists(batch.column("words"))
            for at, end in _runs(np.diff(offsets), _WORDS_AT_ONCE):
                value, doc = shingles(words, offsets[at:end], offsets[at + 1:end + 1], settings.words)
                bounds = np.searchsorted(doc, np.arange(end - at + 1))
                sets = [np.unique(value[bounds[i]:bounds[i + 1]]) for i in range(end - at)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(at, end - at),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    ["node", "shingles"])

    return collect


def _shingle_sets(ids: DataFrame, docs: DataFrame, nodes: DataFrame,
                  settings: Settings) -> DataFrame:
    """(node, shingles), written: the full shingle sets, sorted, of the classes ``ids`` (node)."""
    wanted = nodes.join(ids, "node").select(
        "node", F.col("min_id").alias("class_id"), F.col("digest").alias("class"))
    texts = docs.select("doc_id", "text").join(
        wanted, docs["doc_id"].eqNullSafe(wanted["class_id"])).select(
        "node", "class", _tokens(F.col("text")).alias("tokens"))
    texts = texts.filter(_class_digest(F.col("tokens")) == F.col("class"))
    hashed = texts.select("node", F.transform("tokens", lambda w: F.xxhash64(w)).alias("words"))
    return written(hashed.mapInArrow(_full_sets(settings), "node bigint, shingles array<bigint>")
                   .dropDuplicates(["node"]), "sets")


def _confirmed(settings: Settings):
    def confirm(batches):
        for batch in batches:
            (left, a), (right, b) = (_lists(batch.column(name)) for name in ("left", "right"))
            keep = []
            for i in range(batch.num_rows):
                x, y = left[a[i]:a[i + 1]], right[b[i]:b[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= settings.percent * (len(x) + len(y) - both):
                    keep.append(i)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return confirm


def _links(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Of surviving pairs those that reach the threshold on full shingle sets, written."""
    def side(node: str, name: str) -> DataFrame:
        return sets.select(F.col("node").alias(node), F.col("shingles").alias(name))

    both = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b")
    return written(both.select("a", "b", "left", "right")
                   .mapInArrow(_confirmed(settings), "a bigint, b bigint"), "confirmed")


def _owned(buckets: DataFrame, owners: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, with their component."""
    owned = buckets.join(owners.withColumnRenamed("component", "owner"), "node", "left").withColumn(
        "owner", F.coalesce("owner", "node"))
    mixed = owned.groupBy("band").agg(F.min("owner").alias("low"), F.max("owner").alias("high"))
    return owned.join(mixed.filter("low < high").select("band"), "band")


def _hub_pairs(owned: DataFrame, seed: int) -> DataFrame:
    """Each member of a bucket with the bucket's hub, unless they are connected.

    In the first round the hub is the member that shares most buckets with most others: of the copies of
    one text, those that differ least from it, which most of the rest can be linked with. The next round
    draws by chance. All buckets rank alike, so those of one group mostly have few hubs.
    """
    draw = F.xxhash64("node", F.lit(seed))
    rank = F.struct(draw)
    if seed == 0:
        sizes = owned.groupBy("band").agg(F.count("*").alias("members"))
        shared = owned.join(sizes, "band").groupBy("node").agg(F.sum("members").alias("shared"))
        owned = owned.join(shared, "node")
        rank = F.struct(-F.col("shared"), draw)
    hubs = owned.groupBy("band").agg(F.min_by("node", rank).alias("hub"),
                                     F.min_by("owner", rank).alias("hub_owner"))
    pairs = owned.join(hubs, "band").filter("owner <> hub_owner")
    return pairs.select(F.least("node", "hub").alias("a"),
                        F.greatest("node", "hub").alias("b")).distinct()


def _mixed_pairs(owned: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of different components that can be linked, of classes whose buckets hold several.

    Buckets shared because of a common passage would give very many pairs. So the pairs come from the
    sets themselves: with shingles in one order, rarest first, two sets of n and more elements that
    reach the threshold t share one of the first n - ceil(t * n) + 1 of each, and from the first one
    they share on, both have enough left for the overlap that t asks for. What a common passage adds
    stands at the end of that order.
    """
    members = owned.select("node", "owner", "n_shingles").distinct()
    rows = written(sets.join(members, "node").select(
        "node", "owner", "n_shingles", F.explode("shingles").alias("shingle")), "shingles")
    held = rows.groupBy("shingle").agg(
        F.count("*").alias("holders"), (F.min("owner") < F.max("owner")).alias("shared"))
    needed = F.expr(f"(n_shingles * {settings.percent} + 99) div 100")
    first = F.slice(F.sort_array(F.collect_list(F.struct("holders", "shingle", "shared"))), F.lit(1),
                    F.first(F.col("n_shingles") - needed + 1).cast("int"))
    rarest = rows.join(held, "shingle").groupBy("node", "owner", "n_shingles").agg(
        first.alias("first")).select("node", "owner", "n_shingles",
                                     F.posexplode("first").alias("place", "item"))
    rarest = written(rarest.filter("item.shared").select(
        "node", "owner", "n_shingles", F.col("item.shingle").alias("shingle"),
        (F.col("n_shingles") - F.col("place")).alias("rest")), "rarest")
    x, y = rarest.alias("x"), rarest.alias("y")
    close = F.expr(f"{100 + settings.percent} * least(x.rest, y.rest) >= "
                   f"{settings.percent} * (x.n_shingles + y.n_shingles)")
    pairs = x.join(y, F.expr("x.shingle = y.shingle AND x.owner < y.owner") & close)
    return pairs.select(F.least("x.node", "y.node").alias("a"),
                        F.greatest("x.node", "y.node").alias("b")).distinct()


def _merged(owners: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component), written, once ``links`` (a, b) are added to ``owners``: only components that
    the new links join are looked at again."""
    if owners is None:
        return components(links)

    def side(name: str) -> DataFrame:
        return owners.select(F.col("node").alias(name), F.col("component").alias(f"{name}_owner"))

    between = components(links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("a_owner", "a").alias("a"), F.coalesce("b_owner", "b").alias("b")))
    moved = owners.join(between.select(F.col("node").alias("component"), F.col("component").alias(
        "joined")), "component", "left").select("node", F.coalesce("joined", "component").alias(
            "component"))
    return written(moved.unionByName(between.join(owners, "node", "left_anti")), "owners")


def near_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, text_hash.

    Words are taken from the whole text, A-Z as a-z. ``component_id`` is the smallest doc_id that can
    be reached over links, ``kept`` says that it is the row's own. NULL text and text without words has
    no shingles and no links, so each such row is a component of its own. Rows repeated with one id are
    one document and are all kept or all not; a NULL id is never smallest, and a component that has no
    other id has a NULL ``component_id``. Other columns of ``docs`` are not read. No rows: no rows.
    """
    rows, nodes = classes(docs, settings)
    sized = nodes.filter("n_shingles > 0")
    buckets = sized.select("node", "n_shingles", F.explode("bands").alias("band"))
    owners = nodes.select("node", F.col("node").alias("component")).limit(0)
    owned = written(_owned(buckets, owners), "shared_buckets")
    sets = _shingle_sets(owned.select("node").distinct(), docs, nodes, settings)
    buckets, owners = owned.drop("owner"), None
    for seed in range(settings.hub_rounds + 1):
        if seed < settings.hub_rounds:
            pairs = _hub_pairs(owned, seed)
        else:
            pairs = _mixed_pairs(owned, sets, settings)
        owners = _merged(owners, _links(_survivors(pairs, nodes, settings), sets, settings))
        if seed < settings.hub_rounds:
            owned = written(_owned(buckets, owners), "mixed_buckets")
    named = nodes.join(owners, "node", "left").withColumn("owner", F.coalesce("component", "node"))
    smallest = named.groupBy("owner").agg(F.min("min_id").alias("component_id"))
    by_class = named.join(smallest, "owner").select("digest", "component_id")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(by_class, "digest").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        own.eqNullSafe(F.col("doc_id")).alias("kept"), "text_hash")


def without_near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` (doc_id, text, any others) that ``near_dedup`` keeps, as they are."""
    gone = near_dedup(docs, settings).filter("NOT kept").select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")
