"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import discard, written


def connected(links: DataFrame, most: int = 100) -> DataFrame:
    """(node, root) for every node that links (columns a, b) name; root is the smallest node that is reachable.

    Every step is one aggregation (smallest neighbour, combined before the shuffle) and one join; each round's
    table is written to the shared folder, and the rounds, logarithmic in the longest chain, end when a round
    changes nothing. Nothing but two sums a round reaches the driver. Without an end after `most` rounds: an error.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most):
        n, check = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == before:
            break
        before = (n, check)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = written(small, "edges")
        discard(edges)
        edges = after
    else:
        raise RuntimeError(f"components are not complete after {most} rounds")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
