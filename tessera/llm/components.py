"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component, for every node with an edge.

    Each round is written into the shared folder.  Large-star links the larger neighbours
    of a node to its smallest one, small-star the smaller neighbours; rounds end when the
    edge set stays the same, which is then one star per component.  Nulls and loops are
    ignored; no edges give no rows.
    """
    current = written(edges.where(F.col(a) != F.col(b))
                      .select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct(), "edges")
    mark = None
    while True:
        found = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if found == mark or not found[0]:
            return current.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
                current.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())
        mark = found
        both = current.unionAll(current.select("y", "x"))
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        large = (both.join(least, "x").where(F.col("y") > F.col("x"))
                 .select(F.col("y").alias("x"), F.least("x", "m").alias("y")).distinct())
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = (large.join(least, "x").where(F.col("y") != F.col("m")).select(F.col("y").alias("x"), F.col("m").alias("y"))
                 .unionAll(least.select("x", F.col("m").alias("y"))).distinct())
        current = written(small, "edges")
