"""Connected components of a link table by alternating large-star and small-star passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links -> (id, component): the smallest id reachable, for every linked id.

    Each pass replaces a node's links by links to its smallest neighbour, with a per-node minimum
    (combined before the shuffle), never a list of neighbours. Passes grow with the logarithm of the
    longest chain. Nulls and self-links are ignored; no links give an empty table.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = _written(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, after = _written(small.unionByName(low.select("u", F.col("m").alias("v"))))
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The distinct edges, written, with their number and an order-free sum of their hashes, taken while writing."""
    seen = Observation()
    edges = written(edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "links")
    return edges, (seen.get["n"], int(seen.get["h"] or 0))
