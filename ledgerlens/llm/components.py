"""Connected components on Spark by alternating star contractions.

Each round points every node's larger neighbours, then its smaller ones, at the
smallest of its neighbourhood (large-star and small-star, Kiveris et al. 2014);
the edges end as one star per component around its smallest node. Each step of a round is
written to the shared folder, so lineage stays short and a lost executor costs
one round; the driver sees a count and a checksum of the edges, never the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import written


def _least(edges: DataFrame) -> DataFrame:
    """Every edge with the smallest of u and u's neighbours. The minimum comes from
    partial sums, so a hub is one row in that shuffle; it is written before the join, so
    the edges meet it from a shuffle of their own, in which AQE may split a hub's."""
    low = written(edges.groupBy("u").agg(F.min("v").alias("low")), "component-lows")
    return edges.join(low, "u").withColumn("low", F.least("u", "low"))


def _round(edges: DataFrame) -> DataFrame:
    """edges: (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_least(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
             .where("u <> v").distinct())
    large = written(large, "component-edges")
    small = _least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    return (small.select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
            .where("u <> v").distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links``
    (a, b), roots included. Null ends and loops are no links."""
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "component-edges")
    last = None
    for _ in range(max_rounds):
        sign = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sign == last:
            break
        last = sign
        edges = written(_round(edges), "component-edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
