"""Nearest neighbours by inner product through collision counting.

Vectors are put on a sphere: to each is added the component that brings its length to the largest one,
which leaves inner products alone and makes the largest of them the smallest distance. Each block of
vectors keeps, for every one of a set of single projections, a sorted array; a query's window in it is
centred on the query's own projection and found by binary search. A vector collides with the query in a
projection if it is in the window, and what collides in enough projections is verified with the exact
inner product. Windows are wider from level to level (virtual rehashing: the arrays stay). A query ends
in a block once its k nearest there are within the level's radius; if no level gives that, the whole
block is verified, so nothing is lost where the windows don't tell vectors apart.

Blocks of vectors meet blocks of queries, both dealt by hash and of bounded size. The queries are a
stated share of the rows, so the work grows with both.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.llm.common import written
from stratalog.session import ship

#: Every so many queries of a block one begins at the first level.
RESTART = 32
#: More than sums of products of one vector can differ by the order of adding, as part of its length.
ROUNDING = 1e-9


@dataclass(frozen=True)
class Search:
    """``radii`` are parts of the largest length; a vector at exactly the radius of a level collides in
    each projection with the chance of a standard normal within ``window``, and is a candidate unless
    it stays ``slack`` standard deviations under the mean."""

    k: int = 20
    projections: int = 64
    radii: tuple[float, ...] = (0.5, 0.9, 1.1, 1.2)
    window: float = 1.0
    slack: float = 1.2
    block: int = 4096
    query_block: int = 512
    seed: int = 11


@lru_cache(maxsize=4)
def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    """Orthonormal directions; no more than there are dimensions."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(n, dim))))
    return q.T


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, vector in enumerate(vectors):
        out[i, :len(vector)] = vector
    return out


class SortedBlock:
    """A block of vectors with its sorted arrays."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, longest: float, search: Search):
        self.search, self.longest = search, longest
        self.vectors, self.ids = vectors, ids
        n, dim = vectors.shape
        rest = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        self.directions = _directions(dim + 1, search.projections, search.seed)
        values = self.directions @ np.column_stack([vectors, rest]).T
        order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=1)
        places = np.broadcast_to(np.arange(n, dtype=np.uint16), values.shape)
        self.ranks = np.empty(values.shape, np.uint16)
        np.put_along_axis(self.ranks, order, places, axis=1)
        m = len(self.directions)
        chance = erf(search.window / sqrt(2))
        self.threshold = m * chance - search.slack * sqrt(m * chance * (1 - chance))
        # One array for all projections: each is moved behind the one before it.
        self.step = 4 * longest + 1
        self.behind = np.arange(m) * self.step
        self.flat = (self.sorted + self.behind[:, None]).ravel()
        self.first = np.arange(m) * n
        self.level = self.asked = 0

    def _candidates(self, centre: np.ndarray, radius: float) -> np.ndarray:
        half = self.search.window * radius / sqrt(self.directions.shape[1])
        # No value is further than the longest vector from zero; ends beyond it keep to their array.
        low, high = (np.searchsorted(self.flat, np.clip(
            centre + end, -1.5 * self.longest, 1.5 * self.longest) + self.behind, side) - self.first
            for end, side in ((-half, "left"), (half, "right")))
        # Unsigned: a rank under the window's low end wraps round and is over its width.
        inside = (self.ranks - low.astype(np.uint16)[:, None]) < (high - low).astype(
            np.uint16)[:, None]
        return np.flatnonzero(inside.view(np.uint8).sum(axis=0, dtype=np.uint16) >= self.threshold)

    def nearest(self, query: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, inner products) of the k nearest found, without row number ``own``."""
        size = np.sqrt((query ** 2).sum())
        centre = self.directions @ np.append(query * (self.longest / size), 0.0)
        # A wider level's candidates include a narrower one's: begin where the query before ended, and
        # at the first level now and then.
        if self.asked % RESTART == 0:
            self.level = 0
        self.asked += 1
        for level in range(self.level, len(self.search.radii)):
            self.level = level
            part = self.search.radii[level]
            found = self._candidates(centre, part * self.longest)
            best, scores = self._best(found, query, own)
            if len(best) == self.search.k:
                cosine = scores[-1] / (size * self.longest)
                if sqrt(max(2 - 2 * cosine, 0)) <= part:
                    return best, scores
        return self._best(np.arange(len(self.vectors)), query, own)

    def _best(self, found: np.ndarray, query: np.ndarray, own: int):
        found = found[self.ids["uid"][found] != own]
        if len(found) > self.search.k:
            rough = self.vectors[found] @ query
            least = np.partition(rough, len(rough) - self.search.k)[-self.search.k]
            found = found[rough >= least - ROUNDING * self.longest ** 2]
        # Row by row, so that equal vectors have equal sums.
        scores = (self.vectors[found] * query).sum(axis=1)
        order = np.lexsort((self.ids["uid"][found], self.ids["vec_id"][found],
                            self.ids["none"][found], -scores))[:self.search.k]
        return found[order], scores[order]


_FOUND_DDL = "query_uid bigint, query_id bigint, vec_id bigint, uid bigint, score double"


def _search(search: Search, dim: int, longest: float):
    def run(key, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(queries):
            vec_id = block["vec_id"].astype("Int64")
            ids = {"uid": block["uid"].to_numpy(), "none": vec_id.isna().to_numpy(),
                   "vec_id": vec_id.fillna(0).to_numpy(np.int64)}
            index = SortedBlock(_matrix(block["vector"], dim), ids, longest, search)
            for query, uid, query_id in zip(_matrix(queries["vector"], dim), queries["uid"],
                                            queries["vec_id"], strict=True):
                best, scores = index.nearest(query, uid)
                out.append(pd.DataFrame({
                    "query_uid": uid, "query_id": int(query_id), "vec_id": vec_id.iloc[best].array,
                    "uid": ids["uid"][best], "score": scores}))
        columns = ["query_uid", "query_id", "vec_id", "uid", "score"]
        return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

    return run


def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, query_every: int = 20, search: Search = Search()) -> DataFrame:  # noqa: B008
    """The ``search.k`` rows of ``rows`` (vec_id, embedding) with the largest inner product, for each
    row whose vec_id is divisible by ``query_every``: query_id, rank, vec_id, score.

    Candidates are all rows but the query's own; ties go to the smaller vec_id, NULL last. Vectors that
    are NULL, empty or zero, or have a NULL or non-finite component, take no part. Shorter vectors count
    as having zeros behind. Of rows repeated each is a query and a candidate of its own. Other columns
    are not read. Fewer than k candidates: all of them. No rows: no rows.
    """
    ship(rows.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    valid = rows.select("vec_id", vector.alias("vector")).filter(
        F.coalesce(_usable(F.col("vector")), F.lit(False)))
    valid = written(valid.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    is_query = F.coalesce(F.col("vec_id") % query_every == 0, F.lit(False))
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, n_queries, dim, longest = valid.agg(
        F.count("*"), F.count_if(is_query), F.max(F.size("vector")), F.max(size)).first()
    blocks, query_blocks = max(1, -(-n // search.block)), max(1, -(-n_queries // search.query_block))

    def part(of: int) -> Column:
        return F.pmod(F.xxhash64("uid"), F.lit(of).cast("bigint"))

    def each(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(of - 1).cast("bigint")))

    vectors = valid.withColumn("v", part(blocks)).withColumn("q", each(query_blocks))
    queries = valid.filter(is_query).withColumn("q", part(query_blocks)).withColumn(
        "v", each(blocks))
    found = vectors.groupBy("v", "q").cogroup(queries.groupBy("v", "q")).applyInPandas(
        _search(search, dim or 1, longest or 1.0), _FOUND_DDL)
    order = Window.partitionBy("query_uid").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= search.k).select("query_id", "rank", "vec_id", "score")
