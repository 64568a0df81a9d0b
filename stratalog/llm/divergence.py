"""How far the sources of a language differ in their words, with equal texts read once.

Equal texts of a language are collapsed to one, with the number of copies that each source has. The text
is taken apart once; its words count, for every source that has it, as often as that source has copies,
both as occurrences and as documents. Texts that occur once have nothing to meet and are taken apart where
they lie, so that only copied texts are shuffled. Pairs of sources are then compared on words that occur: a word that
neither has adds the same to every pair, a word that one has depends on its number there alone, so those
are added up by number, and only words that both have are met by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.llm.common import lower_ascii, written
from stratalog.operators.joins import is_small
from stratalog.sources.pages import spread

# Fixed value: what stands between two terms.
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


# Hashes of copied texts that are broadcast at most, 8 bytes each; with more, all texts are collapsed.
COPIED_HASHES = 1_000_000


@dataclass(frozen=True)
class Audit:
    min_docs: int = 30  # documents of the language that a kept term is in
    added: int = 5  # to each count
    scale: int = 1_000_000_000
    top_terms: int = 50
    # Sources met by one task for one term; more are dealt over blocks of this size.
    block: int = 128


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, held): each distinct text of a language once; ``held`` says how often each source
    has it. Copies meet as digests and numbers; a text leaves a task once, however many copies it has."""
    none = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c), none).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    held = rows.groupBy("lang", "digest", "source").count().groupBy("lang", "digest").agg(
        F.collect_list(F.struct("source", F.col("count").alias("copies"))).alias("held"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(held, ["lang", "digest"]).select("lang", "text", "held")


def by_copies(docs: DataFrame, limit: int = COPIED_HASHES) -> tuple[DataFrame | None, DataFrame]:
    """Rows whose text and language occur once, and the others; None and all with more than ``limit``
    hashes of texts that occur again. Texts that share a hash by chance are among the others."""
    none = F.lit("")
    rows = spread(docs.select("lang", "source", "text")).withColumn(
        "hash", F.xxhash64(F.coalesce("lang", none), F.coalesce("text", none)))
    copied = written(rows.groupBy("hash").count().filter("count > 1").select("hash"), "copied")
    if not is_small(copied, limit):
        return None, docs
    copied = F.broadcast(copied)
    return (rows.join(copied, "hash", "left_anti").drop("hash"),
            rows.join(copied, "hash", "left_semi").drop("hash"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term."""
    words = F.filter(F.split(lower_ascii(F.col("text")), BETWEEN_TERMS), lambda w: w != "")
    # All words for the occurrences, distinct words for the documents.
    views = F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(d).alias("d"), words_.alias("words"))
        for n, d, words_ in ((1, 0, F.col("words")), (0, 1, F.array_distinct("words")))]))
    once, others = by_copies(docs)
    each = (collapsed(others).select("lang", "held", words.alias("words"))
            .select("lang", "held", views.alias("v"))
            .select("lang", F.explode("held").alias("h"), "v")
            .select("lang", "h.source", "h.copies", "v.n", "v.d", F.explode("v.words").alias("term")))
    if once is not None:
        none, one = F.lit(""), F.lit(1).cast("bigint")
        each = each.unionByName(
            once.select(*[F.coalesce(F.col(c), none).alias(c) for c in ("lang", "source")],
                        words.alias("words"))
            .select("lang", "source", views.alias("v"))
            .select("lang", "source", one.alias("copies"), "v.n", "v.d",
                    F.explode("v.words").alias("term")))
    return each.groupBy("lang", "source", "term").agg(
        F.sum(F.col("n") * F.col("copies")).alias("n"),
        F.sum(F.col("d") * F.col("copies")).alias("docs"))


def _wide(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def _share(count: Column, total: Column, vocabulary: Column, audit: Audit) -> Column:
    """1 + floor(scale * (count + added) / (total + added * vocabulary)), exact."""
    over = _wide(total) + _wide(vocabulary) * audit.added
    part = F.call_function("div", (_wide(count) + audit.added) * audit.scale, F.nullif(over, F.lit(0)))
    return part + 1


def _with_groups(df: DataFrame, groups: DataFrame, keys: list[str], small: bool) -> DataFrame:
    return df.join(F.broadcast(groups) if small else groups, keys)


def divergence(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of ``docs`` (text, lang, source).

    Part ``pair``: the distance of each source to every other of its language, farthest first. Part
    ``term``: the words that a source has more often than its language, the first ``top_terms``. NULL text,
    lang and source are empty strings; an empty source is a source. A group without terms has its pairs;
    a language without kept terms has pairs of value 0. Repeated rows count each time. Words of any length
    and texts of any length are whole. Ties go by the item's bytes. Other columns are not read. An empty
    table gives no rows.
    """
    # The sums of a language stand beside its counts, so that these are shuffled once more and not joined.
    of_term = Window.partitionBy("lang", "term")
    kept = written(term_counts(docs).withColumns({
        "lang_n": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term)}).filter(
        F.col("docs") >= audit.min_docs).drop("docs"), "kept_terms")

    blank = F.lit("")
    occurring = docs.select(F.coalesce("lang", blank).alias("lang"),
                            F.coalesce("source", blank).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang_terms = kept.select("lang", "term", "lang_n").distinct()
    langs = lang_terms.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("bigint")
    groups = (occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c)
                                          for c in ("total", "terms", "lang_total")]))
    groups = written(groups.withColumn(
        "p0", _share(zero, F.col("total"), F.col("terms"), audit)), "groups")
    small = is_small(groups)

    p = _share(F.col("n"), F.col("total"), F.col("terms"), audit)
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), audit)
    shares = _with_groups(kept, groups, ["lang", "source"], small).select(
        "lang", "source", "term", "n", "p0", p.alias("p"), q.alias("q"))
    by_term = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    by_term = by_term.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= audit.top_terms)
    by_pair = _pairs(shares, groups, small, audit).withColumn("rank", F.row_number().over(order))
    return by_pair.unionByName(by_term)


def _pairs(shares: DataFrame, groups: DataFrame, small: bool, audit: Audit) -> DataFrame:
    """Sum of |p - q| over all kept terms for every two sources of a language."""
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-most // audit.block))

    # Terms that neither has, and terms of one source, which its number of occurrences tells all of.
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    two = _with_groups(groups.select("lang", "source", "p0", "terms"), other, ["lang"], small)
    two = two.filter("source <> item")
    start = two.select("lang", "source", "item", F.coalesce(
        F.col("terms") * F.abs(F.col("p0") - F.col("q0")), F.lit(0)).alias("value"))
    numbers = shares.groupBy("lang", "source", "n", "p", "p0").agg(F.count("*").alias("many"))
    alone = _with_groups(numbers, other, ["lang"], small).filter("source <> item")
    beyond = F.col("many") * (F.abs(F.col("p") - F.col("q0")) - F.abs(F.col("p0") - F.col("q0")))
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(beyond).alias("value"))

    # Terms that both have: what the two sums above put wrongly is put right.
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cells = shares.select("lang", "term", "source", "p", "p0", block.alias("mine"))
    left = cells.withColumn("theirs", every)
    right = cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"),
                         F.col("p0").alias("q0"), F.col("mine").alias("theirs")).withColumn("mine", every)
    met = left.join(right, ["lang", "term", "mine", "theirs"]).filter("source < item")

    def gap(a: str, b: str) -> Column:
        return F.abs(F.col(a) - F.col(b))

    both = met.groupBy("lang", "source", "item").agg(F.sum(
        gap("p", "q") - gap("p", "q0") - gap("p0", "q") + gap("p0", "q0")).alias("value"))

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    parts = [start, alone, turned(alone), both, turned(both)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
