"""Connected components of a graph that is a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.workspace import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node that edges (a, b) name; a component is its smallest node.

    Each round hangs the larger neighbours of every node on its smallest one, then the smaller ones,
    until nothing moves: about log rounds, each of three shuffles. The smallest neighbours combine on the map
    side. An edge notes whether it moved, so a round is also its own test for the end. Each round's edges are written
    to the shared folder: a plan that held the rounds before it would grow with their number. Loops are ignored;
    edges may repeat, in either direction.
    """
    moved = F.lit(True).alias("moved")
    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), moved), name)
    while not current.where("moved").isEmpty():
        both = current.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = current.select("a", "b").join(least, "b").select("a", F.col("m").alias("b"), (F.col("m") < F.col("b")).alias("moved"))
        # Every edge now leads from a larger to a smaller node. Those of one larger node are in one partition, where they
        # are made distinct and compared without another shuffle.
        own = Window.partitionBy("a")
        large = large.repartition("a").groupBy("a", "b").agg(F.max("moved").alias("moved"))
        small = large.select("a", "b", F.min("b").over(own).alias("m"), F.max("moved").over(own).alias("moved"))
        first = F.col("b") == F.col("m")
        ends = [F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")]
        current = written(small.select(*ends, (~first | F.col("moved")).alias("moved")), name)
    # Nothing moved: each node but the smallest of its component has one edge, to that one.
    named = F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.col("b").alias("component")) for c in "ab"]))
    return written(current.select(named).distinct(), name)
