"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """The least of each node and its neighbours; combined per task first, so a hub is one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("node"), F.least("u", "least").alias("least"))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _star(pairs: DataFrame, name: str) -> DataFrame:
    """Each node's neighbours linked to the least of them."""
    pairs = stored(pairs, f"{name}-pairs")
    least = stored(_least(pairs), f"{name}-least")
    return pairs.join(least, F.col("u") == F.col("node"))


def components(links: DataFrame) -> DataFrame:
    """``node, component``: for each node of ``links`` (u, v) the least node that it is connected with.

    Links to itself and repeated links change nothing; links with a null end are left out. Without
    links the result is empty. Each step is a grouping and a join, written to the scratch folder;
    the number of steps grows with the logarithm of the longest chain.
    """
    edges = stored(
        links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .filter("u < v").distinct(), "links")
    before = _signature(edges)
    while True:
        # Large star: neighbours greater than the node go to the least neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, "large").filter("v > u").select(F.col("least").alias("u"), "v").distinct()
        # Small star: the node and its smaller neighbours go to the least of them.
        smaller = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        starred = _star(smaller, "small")
        moved = starred.select(F.col("least").alias("u"), F.explode(F.array("u", "v")).alias("v"))
        edges = stored(moved.filter("u < v").distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
