"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import written


def _stamp(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """`node, component`: each node of `links` (`a, b`) and the smallest node it is connected with.

    Large-star and small-star steps alternate until nothing changes: every step
    ties nodes to the smallest of their neighbours, and the edges become stars.
    Each step is written, so the plan stays short; the tables joined are plain
    files, so Spark can split a node with very many neighbours. A link of a node
    with itself makes no edge. No links, no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi != lo")
    edges = written(edges.distinct(), "edges")
    stamp = _stamp(edges)
    while True:
        ways = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
        ways = ways.unionByName(edges.select(F.col("lo").alias("node"), F.col("hi").alias("near")))
        lowest = written(ways.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("low")), "lowest")
        stars = ways.join(lowest, "node").filter("near > node").select(F.col("near").alias("hi"), F.col("low").alias("lo"))
        stars = written(stars.distinct(), "large-stars")
        lowest = written(stars.groupBy("hi").agg(F.min("lo").alias("low")), "lowest")
        joined = stars.join(lowest, "hi")
        down = joined.filter("lo != low").select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
        edges = written(down.unionByName(joined.select("hi", F.col("low").alias("lo"))).distinct(), "small-stars")
        before, stamp = stamp, _stamp(edges)
        if stamp == before:
            break
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
