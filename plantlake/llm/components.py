"""Connected components of a graph that is given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import stored


def labels(links: DataFrame) -> DataFrame:
    """node, label of each node of `links` (a, b): the smallest node that links lead to.

    Alternates two steps until nothing changes: all larger neighbours of a node are hung on the smallest node around it,
    then all smaller ones. Both work on counted links of a table, keep components as they are and never gather a component;
    the number of rounds grows with the logarithm of its size. Each round is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, mark = _settled(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.where("u <> v").distinct()
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        moved = hung.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges, new = _settled(moved.unionByName(least.withColumnRenamed("m", "v")).distinct())
        if new == mark:
            break
        mark = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a stored table, and a fingerprint of it."""
    edges = stored(edges, "edges")
    key = F.xxhash64("u", "v")
    mark = edges.agg(F.count("*"), F.sum(key.cast("decimal(20,0)")), F.bit_xor(key)).first()
    return edges, tuple(mark)
