"""Free-form answers to closed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog import fixed_values as fv
from stratalog.functions.arrays import canonical_term, canonical_terms, first_contained
from stratalog.functions.text import strip
from stratalog.operators.joins import BROADCAST_ROWS, is_small


def map_domain(value: Column) -> Column:
    return canonical_term(value, fv.DOMAINS, fv.DOMAIN_ALIASES, fv.DOMAIN_DEFAULT)


def map_complexity(value: Column) -> Column:
    return canonical_term(value, fv.COMPLEXITIES, fv.COMPLEXITY_ALIASES, fv.COMPLEXITY_DEFAULT)


def map_use_cases(values: Column) -> Column:
    return canonical_terms(values, fv.USE_CASES, fv.USE_CASE_ALIASES, fv.USE_CASE_DEFAULT)


def map_languages(values: Column) -> Column:
    return canonical_terms(
        values, fv.LANGUAGES, fv.LANGUAGE_ALIASES, fv.LANGUAGE_DEFAULT, fv.LANGUAGE_CAP
    )


def map_audience(values: Column) -> Column:
    return canonical_terms(
        values, fv.AUDIENCES, fv.AUDIENCE_ALIASES, fv.AUDIENCE_DEFAULT, fv.AUDIENCE_CAP
    )


def map_family(value: Column) -> Column:
    return first_contained(value, fv.FAMILIES, fv.FAMILY_ALIASES, fv.FAMILY_DEFAULT)


def normalise_by_table(
    df: DataFrame, value: str, vocabulary: DataFrame, default: str | None, out: str
) -> DataFrame:
    """Scalar normalisation against a vocabulary table (alias, term), for large vocabularies.

    ``alias`` is lower case and unique. The table is broadcast if a count shows that it is small,
    and the rows are not shuffled. Otherwise each distinct value is mapped once and the result is
    joined back on the value; a value that fills a third of the rows meets a single row there, and
    AQE splits its side of the join.
    """
    exact = vocabulary.select(F.col("term").alias("_exact"), F.col("term").alias("_t")).distinct()
    alias = vocabulary.select(F.col("alias").alias("_alias"), F.col("term").alias("_u"))

    def mapped(rows: DataFrame, column: str, hint) -> DataFrame:
        return (
            rows.join(hint(exact), F.col(column) == F.col("_exact"), "left")
            .join(hint(alias), F.lower(strip(F.col(column))) == F.col("_alias"), "left")
            .withColumn(out, F.coalesce("_t", "_u", F.lit(default)))
            .drop("_exact", "_t", "_alias", "_u")
        )

    if is_small(vocabulary, BROADCAST_ROWS):
        return mapped(df, value, F.broadcast)
    terms = mapped(df.select(F.col(value).alias("_v")).distinct(), "_v", lambda table: table)
    return (
        df.join(terms, F.col(value) == F.col("_v"), "left")
        .withColumn(out, F.coalesce(out, F.lit(default)))
        .drop("_v")
    )


def normalise_arrays_by_table(
    df: DataFrame, key: str, values: str, vocabulary: DataFrame, default: str, out: str,
    cap: int | None = None,
) -> DataFrame:
    """``canonical_terms`` against a vocabulary table (alias, term); ``key`` is unique in ``df``.

    Items are mapped one row each by ``normalise_by_table`` and come back as one array per key,
    joined to the row that they are from; what else ``df`` holds is not exploded.
    """
    items = df.select(F.col(key).alias("_key"), F.posexplode(values).alias("_pos", "_item"))
    terms = normalise_by_table(items, "_item", vocabulary, None, "_term").filter(
        F.col("_term").isNotNull())
    first = terms.groupBy("_key", "_term").agg(F.min("_pos").alias("_pos"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_term"))),
                          lambda t: t["_term"])
    if cap is not None:
        ordered = F.slice(ordered, 1, cap)
    lists = first.groupBy("_key").agg(ordered.alias("_terms"))
    joined = df.join(lists, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce("_terms", F.array(F.lit(default)))).drop(
        "_key", "_terms")


# Fixed length of the grams by which aliases are looked up; shorter aliases are their own gram.
GRAM = 4


def classify_by_table(
    df: DataFrame, value: str, vocabulary: DataFrame, default: str, out: str
) -> DataFrame:
    """``first_contained`` against a vocabulary table (alias, term, rank): the term of the contained
    alias with the smallest rank. Aliases are lower case, unique and not empty.

    Containment is no equality, so each distinct value meets only the aliases that begin with one
    of its grams, and these are compared in full.
    """
    exact = vocabulary.select(F.col("term").alias("_exact")).distinct()
    distinct = df.select(F.col(value).alias("_v")).filter("_v IS NOT NULL").distinct()
    low = distinct.withColumn("_low", F.lower(strip(F.col("_v"))))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.length("_low")), lambda at: F.transform(
        F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.substring("_low", at, n))))
    grams = F.when(F.length("_low") > 0, F.array_distinct(grams))
    aliases = vocabulary.select(
        F.substring("alias", 1, GRAM).alias("_gram"), F.col("alias").alias("_alias"),
        F.col("term").alias("_term"), F.col("rank").alias("_rank"))
    hits = low.withColumn("_gram", F.explode(grams)).join(aliases, "_gram").filter(
        F.contains("_low", "_alias"))
    found = hits.groupBy("_v").agg(F.min_by("_term", "_rank").alias("_hit"))
    terms = distinct.join(exact, F.col("_v") == F.col("_exact"), "left").join(
        found, "_v", "left").select("_v", F.coalesce("_exact", "_hit").alias("_term"))
    return df.join(terms, F.col(value) == F.col("_v"), "left").withColumn(
        out, F.coalesce("_term", F.lit(default))).drop("_v", "_term")
