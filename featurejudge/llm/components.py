"""Connected components of a link table, by alternating star contraction.

Every round replaces links by links to smaller neighbours (first from larger
neighbours, then from smaller ones), so a component ends as a star around its
smallest node.  Per-node minima are combined on the map side; the join that
hands them back has two plain exchanges, so adaptive execution can split a hub.
Each round is a written table in the shared folder, which keeps lineage short
and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _minima(pairs: DataFrame) -> DataFrame:
    return cut_lineage(pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a")))


def _round(links: DataFrame) -> DataFrame:
    both = _both(links)
    large = (both.join(_minima(both), "a").where("b > a")
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    large = cut_lineage(large.where("a > b"))
    small_min = _minima(large)
    small = large.join(small_min, "a")
    out = (small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
           .unionByName(small_min.select("a", F.col("m").alias("b"))))
    return cut_lineage(out.where("a > b").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: any ordered type, a != b) -> (node, root): one row per
    linked node, root being the smallest node of its component (the root
    itself included).  Nodes without a link are not in the result; links with
    a null end are ignored; no link at all gives an empty table."""
    links = cut_lineage(links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        # a star forest no longer changes: compare an order-free digest of the links
        mark = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (mark["n"], mark["s"]) == seen or mark["n"] == 0:
            break
        seen = (mark["n"], mark["s"])
        links = _round(links)
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
