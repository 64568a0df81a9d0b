"""Connected components of an edge table by alternating star steps.

Each round lets every node hand its larger neighbours, then its smaller ones, to the smallest node it
knows. The number of edges never grows, a hub's edges are aggregated before they move, and the rounds
grow with the logarithm of the longest chain. Each round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import written


def _with_smallest(edges: DataFrame) -> DataFrame:
    """(a, b, low): directed edges with the smallest node that ``a`` sees, itself included."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    return edges.join(low.withColumn("low", F.least("low", "a")), "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b, of a type with an order); the component is
    its smallest node. Edges repeated or from a node to itself add nothing; no edges: no rows."""
    links = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    before = _sums(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_with_smallest(both).filter("b > a").select(F.col("b").alias("a"),
                                                             F.col("low").alias("b"))).distinct()
        small = _with_smallest(large)
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            small.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        after = written(small, "links")
        sums = _sums(after)
        if sums == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        links, before = after, sums


def _sums(edges: DataFrame) -> tuple:
    """Count and the sums of two hashes: equal for equal tables of distinct edges."""
    a, b = (F.xxhash64(*columns).cast("decimal(38,0)") for columns in (("a", "b"), ("b", "a")))
    return tuple(edges.agg(F.count("*"), F.sum(a), F.sum(b)).first())
