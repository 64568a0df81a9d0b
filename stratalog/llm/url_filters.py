"""Allow and block rules for URLs, matched through hash prefixes of host and path expressions.

A rule is a host and the start of a path. Each URL is expanded into the suffixes of its host at label
borders, and the starts of its path in the lengths that rules have; a URL's expression that equals a
rule is found by an equi-join on the first four bytes of its digest and confirmed by the whole digest.
Expressions are made distinct before they meet the rules, so a host that most pages share is one row
a task; what leads back to the pages is a plain equi-join, whose large keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.common import lower_ascii

DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; else empty."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    # A rule's text is its host and path run together; the length keeps the two parts apart.
    return F.sha2(F.concat_ws("\n", F.length(host).cast("string"), host, path), 256)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows from a list that is part of the program."""
    rows = [F.struct(*[F.lit(part).alias(name) for part, name in
                       zip(rule, ("host", "path", "verdict"), strict=True)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _best(rules: DataFrame) -> DataFrame:
    """Rules by digest; of several with one host and path, block wins over allow."""
    named = rules.filter("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    named = named.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    return named.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, 8))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url).

    ``rules`` (host, path, verdict allow or block): a rule fits its host and all subdomains where the
    path starts with the rule's. The longest rule text wins, then the longer host. NULL urls and those
    without ``://`` have an empty host and path; where no rule fits, ``rule`` is NULL and the verdict
    ``DEFAULT_VERDICT``. Rows repeated stay repeated; rules with a NULL part or an empty host are passed over. Other
    columns of ``pages`` are not read. No pages: no rows; no rules: the default for every page.
    """
    best = _best(rules)
    # The lengths of rule paths are few: at most as many as the longest rule path has characters.
    lengths = [row[0] for row in best.select(F.length("rule_path")).distinct().collect()]
    starts = F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")
    sites = pages.select("page_id", url_host(F.col("url")).alias("host"),
                         url_path(F.col("url")).alias("path"))
    # Host and path, not the page, decide: pages with the same ones are judged once.
    addresses = sites.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    start = F.explode(F.transform(
        F.filter(starts, lambda n: n <= F.length("path")),
        lambda n: F.substring("path", F.lit(1), n)))
    spread = (addresses.withColumn("suffix", suffix).withColumn("start", start)
              .withColumn("digest", _digest(F.col("suffix"), F.col("start"))))
    distinct = spread.select("digest").distinct().withColumn("short", F.substring("digest", 1, 8))
    hits = (distinct.withColumnRenamed("digest", "full").join(best, "short")
            .filter(F.col("full") == F.col("digest"))
            .select("digest", "rule_host", "rule_path", "verdict"))
    order = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("long"),
                     F.length("rule_host").alias("host_long"),
                     F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    judged = (spread.join(hits, "digest").groupBy("host", "path")
              .agg(F.max(order).alias("won")))
    return sites.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))
