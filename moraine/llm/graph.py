"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.sources.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): every linked node and the least node it is connected with.

    Large-star and small-star steps in turn: each keeps the components and
    hangs nodes on smaller ones, until each hangs on its root. Every step is
    written to the shared folder, so a lost executor costs one step at most.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours hang on the least of all neighbours.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours, and the node itself, hang on the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = tuple(
            edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        )
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
