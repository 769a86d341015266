"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours hung on its smallest neighbour.

    A node's smallest neighbour is an aggregate joined back, so that no node's
    neighbours meet in one group.
    """
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        hung = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        joined = down.join(least, "a")
        hung = joined.select(F.col("b").alias("x"), F.col("least").alias("y")).unionByName(
            least.select(F.col("a").alias("x"), F.col("least").alias("y"))
        )
    return hung.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Both stars keep what is connected, and alternating them ends in one star
    per component (Kiveris et al., 2014).  Every round is written, so lineage
    stays short.  No links give no rows.
    """
    current = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        flat = written(_star(_star(current, True), False), "links")
        # Stars already: nobody hangs on two nodes, and no node that is hung on has one above it.
        twice = flat.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
        chained = flat.select("b").join(flat.select(F.col("a").alias("b")), "b", "left_semi").select(F.col("b").alias("a"))
        current = flat
        if twice.unionByName(chained).isEmpty():
            break
    top = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(top)
