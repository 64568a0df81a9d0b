"""Mixing to target weights where documents belong to domains only in part.

A labelled table names the domain of some documents. A naive Bayes classifier over hashed words, learnt
from it, gives every document its domain posteriors. Document i with n tokens and posterior p adds
``rate * n * p[k]`` expected tokens to domain k; the rates bring the expected totals as near to the targets
as rates can, by the squared distance. Among rates with the same totals they are those nearest to 1, which
are 1 less the product of p with one vector, never under the least rate. That vector is found by projected
gradient in the metric of the second moments of the documents that are not at the least rate, with the
best of some step sizes, until the gradient is gone. What goes through the driver is a few numbers for
each pair of domains and step. Everything is built-in functions.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import lower_ascii, words_of, written


@dataclass(frozen=True)
class Mixture:
    """``train_rows`` labelled documents at most are learnt from, in the order of a hash of the id;
    ``buckets`` is the number of word classes. ``keep_all`` gives no document a rate under 1 and takes
    the smallest total with which that is possible. ``nearness`` weighs the squared distance of the rates
    from 1 against that of the totals from the targets: small enough to decide between equal totals only.
    """

    train_rows: int = 20_000
    buckets: int = 4096
    steps: int = 40
    tolerance: float = 1e-6
    keep_all: bool = False
    nearness: float = 1e-8


#: Parts of a step that are tried at once.
_PARTS = (1.0, 0.5, 0.25, 0.125, 2.0 ** -4, 2.0 ** -6, 2.0 ** -9, 2.0 ** -13)


def _buckets(text: Column, n: int) -> Column:
    return F.transform(words_of(lower_ascii(text)),
                       lambda word: F.pmod(F.xxhash64(word), F.lit(n).cast("bigint")).cast("int"))


def _constant(values: np.ndarray) -> Column:
    """An array as one constant of the plan."""
    return F.split(F.lit(",".join(f"{v:.9g}" for v in values)), ",").cast("array<double>")


def _looked_up(buckets: str, table: Column) -> Column:
    return F.aggregate(buckets, F.lit(0.0), lambda total, at: total + F.get(table, at))


def learn(docs: DataFrame, domains: DataFrame, names: list[str],
          mixture: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """(log priors, log chances by domain and word class) from ``domains`` (doc_id, domain).

    A document with several domains in the table counts once, for the first by name. Domains without
    rows have the prior of half a row.
    """
    known = domains.filter(F.col("domain").isin(names)).groupBy("doc_id").agg(
        F.min("domain").alias("domain"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(mixture.train_rows)
    rows = written(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "domain", _buckets(F.col("text"), mixture.buckets).alias("buckets")), "labelled")
    sizes = dict(rows.groupBy("domain").count().collect())
    counts = np.full((len(names), mixture.buckets), 0.5)
    per_class = rows.select("domain", F.explode("buckets").alias("bucket")).groupBy(
        "domain", "bucket").count()
    for domain, bucket, count in per_class.collect():  # at most domains x buckets rows
        counts[names.index(domain), bucket] += count
    prior = np.array([sizes.get(name, 0) + 0.5 for name in names])
    return (np.log(prior / prior.sum()),
            np.log(counts / counts.sum(axis=1, keepdims=True)))


def posteriors(docs: DataFrame, prior: np.ndarray, chances: np.ndarray) -> DataFrame:
    """(doc_id, uid, tokens, p), written. The evidence of n words counts as that of their square root,
    for words of one document are no independent witnesses; without words p is the prior."""
    buckets = docs.select("doc_id", _buckets(F.col("text"), chances.shape[1]).alias("buckets"))
    tokens = F.size("buckets").cast("bigint")
    centred = chances - chances.mean(axis=0)
    logits = []
    for k, row in enumerate(centred):
        total = _looked_up("buckets", _constant(row))
        logits.append(total / F.sqrt(F.greatest(tokens, F.lit(1))) + F.lit(float(prior[k])))
    rows = buckets.select("doc_id", tokens.alias("tokens"), F.array(*logits).alias("z"))
    powers = F.transform("z", lambda z: F.exp(z - F.array_max("z")))
    rows = rows.withColumn("e", powers).select(
        "doc_id", F.monotonically_increasing_id().alias("uid"), "tokens",
        F.transform("e", lambda e: e / F.aggregate("e", F.lit(0.0), lambda s, x: s + x)).alias("p"))
    return written(rows, "posteriors")


def _along(vector: np.ndarray) -> Column:
    """1 less the product of p with a vector: the rate before it is held at the least one."""
    moves = [F.get("p", F.lit(i)) * F.lit(float(v)) for i, v in enumerate(vector)]
    return F.lit(1.0) - sum(moves[1:], moves[0])


def _pieces(rows: DataFrame, vectors: list[np.ndarray], least: float, k: int) -> list[tuple]:
    """For each vector: (sum of the squares that fall, totals, second moments of rows above ``least``)."""
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    sums = []
    for n in range(len(vectors)):
        free, rate = F.col(f"u{n}") > least, F.greatest(F.col(f"u{n}"), F.lit(least))
        sums.append(F.sum(F.col("tokens") * rate * (F.col(f"u{n}") - rate / 2)))
        sums += [F.sum(F.col("tokens") * rate * F.get("p", F.lit(i))) for i in range(k)]
        sums += [F.sum(F.when(free, F.col("tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j)))
                       .otherwise(0.0)) for i, j in pairs]
    held = rows.select("tokens", "p", *[_along(v).alias(f"u{n}") for n, v in enumerate(vectors)])
    got = np.array([v or 0.0 for v in held.agg(*sums).first()], float).reshape(len(vectors), -1)
    out = []
    for line in got:
        moments = np.zeros((k, k))
        for (i, j), v in zip(pairs, line[1 + k:], strict=True):
            moments[i, j] = moments[j, i] = v
        out.append((line[0], line[1:1 + k], moments))
    return out


def fit_rates(members: DataFrame, weights: list[float], mixture: Mixture) -> Column:
    """The rate of a row of ``members`` (tokens, p) as an expression, for domain weights that are
    normalised to sum 1. Where no rates reach the targets the nearest totals are met, and a warning says
    how far they are; another says so where the steps end before the gradient is gone."""
    k = len(weights)
    share = np.array(weights, float) / sum(weights)
    least = 1.0 if mixture.keep_all else 0.0
    vector = np.zeros(k)
    # At the vector 0 all rates are 1, and all rows count as free.
    value, reached, free = _pieces(members, [vector], -1.0, k)[0]
    tokens = reached.sum()
    if not tokens:
        return F.lit(1.0)
    wanted = share > 0
    scale = (reached[wanted] / share[wanted]).max() if mixture.keep_all else tokens
    targets = share * scale
    weight = mixture.nearness * tokens

    def height(value: float, at: np.ndarray) -> float:
        return value + targets @ at + weight / 2 * (at @ at)

    # The height is convex; its gradient is the gap of the targets with what nearness costs.
    for left in range(mixture.steps, -1, -1):
        slope = targets - reached + weight * vector
        if np.abs(slope).max() <= mixture.tolerance * scale:
            break
        if not left:
            warnings.warn(f"mixing: {mixture.steps} steps left a gradient of "
                          f"{np.abs(slope).max() / scale:.2g} of all tokens", stacklevel=2)
            break
        step = np.linalg.solve(free + weight * np.eye(k), slope)
        tried = [vector - part * step for part in _PARTS]
        found = _pieces(members, tried, least, k)
        best = min(range(len(tried)), key=lambda n: height(found[n][0], tried[n]))
        vector, (value, reached, free) = tried[best], found[best]
    gap = np.abs(reached - targets).max() / scale
    if gap > 1e-4:
        warnings.warn(f"mixing: no rates reach the targets; the nearest totals miss one by {gap:.2g} of all "
                      "tokens", stacklevel=2)
    return F.greatest(F.lit(least), _along(vector))


def mixed(docs: DataFrame, domains: DataFrame, weights: dict[str, float],
          mixture: Mixture = Mixture()) -> DataFrame:  # noqa: B008
    """(doc_id, uid, tokens, p, rate, copies) of every row of ``docs`` (doc_id, text).

    ``p`` is in the order of ``weights``. ``copies`` is the rate rounded up or down, up for the part of
    the ids that makes the mean the rate. Texts without words have no tokens, the prior as posterior and
    a rate like others. Rows repeated have rates of their own, which are equal; NULL ids are kept. Other
    columns are not read. No rows, or no words at all: rates of 1.
    """
    names = list(weights)
    prior, chances = learn(docs, domains, names, mixture)
    members = posteriors(docs, prior, chances)
    rate = fit_rates(members, list(weights.values()), mixture)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    rows = members.withColumn("rate", rate)
    up = (chance < F.col("rate") - F.floor("rate")).cast("bigint")
    return rows.withColumn("copies", F.floor("rate") + up)


def remixed(docs: DataFrame, domains: DataFrame, weights: dict[str, float],
            mixture: Mixture = Mixture()) -> DataFrame:  # noqa: B008
    """``docs`` with each row as often as its ``copies`` say, other columns as they are."""
    rates = mixed(docs, domains, weights, mixture)
    # One document has one rate, however often its row is there.
    by_id = rates.groupBy("doc_id", "tokens").agg(F.max("copies").alias("copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"),
                       F.size(words_of(F.col("text"))).cast("bigint").alias("tokens"))
    same = rows["doc_id"].eqNullSafe(by_id["doc_id"]) & (rows["tokens"] == by_id["tokens"])
    return rows.join(by_id, same).select(
        "row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
