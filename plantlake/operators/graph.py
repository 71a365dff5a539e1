"""Graphs as edge tables: closure, paths, tops, dangling references."""

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.session import checkpoint


def closure(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All (ancestor, descendant, depth) pairs of a graph (parent, child), with the least depth.

    Level by level: each round extends the newest pairs by one edge and keeps those not seen
    before, so cycles end. Every level is checkpointed, and only its emptiness reaches the driver.
    """
    steps = edges.select("parent", "child").distinct()
    frontier = checkpoint(
        steps.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).alias("depth"))
    )
    found, depth = frontier, 1
    while max_depth is None or depth < max_depth:
        depth += 1
        longer = (
            frontier.join(steps, F.col("descendant") == F.col("parent"))
            .select("ancestor", F.col("child").alias("descendant"))
            .distinct()
            .join(found, ["ancestor", "descendant"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = checkpoint(longer)
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def roots(edges: DataFrame) -> DataFrame:
    """Nodes that are a parent but nobody's child."""
    parents = edges.select(F.col("parent").alias("node")).distinct()
    return parents.join(edges.select(F.col("child").alias("node")).distinct(), "node", "left_anti")


def jumps(edges: DataFrame) -> Iterator[DataFrame]:
    """(node, far) for all walks of 1, 2, 4, 8 ... edges (parent, child) from a node upwards, one table for each length.

    Each table joins the one before with itself, so a chain of 20,000 levels takes 15. They end where no walk is that long; in a
    graph with cycles where it would be longer than the graph has nodes.
    """
    steps = edges.select(F.col("child").alias("node"), F.col("parent").alias("far")).distinct()
    table = checkpoint(steps.where("node IS NOT NULL AND far IS NOT NULL"))
    nodes, length = None, 1
    while not table.isEmpty():
        yield table
        length *= 2
        if nodes is None:
            nodes = table.select("node").union(table.select("far")).distinct().count()
        if length > nodes:
            break
        table = checkpoint(_extended(table, table))


def _extended(near: DataFrame, on: DataFrame) -> DataFrame:
    """Walks of `near` with those of `on` that go on where they end."""
    then = on.select(F.col("node").alias("far"), F.col("far").alias("further"))
    return near.join(then, "far").select("node", F.col("further").alias("far")).distinct()


def ancestry(edges: DataFrame) -> DataFrame:
    """node, parent, root and depth of every node of a forest (parent, child) that a root leads to.

    A node has one parent at most; for nodes with more use `hierarchy_paths`. Depths and roots double the length they cover each
    round, so the rounds grow with the logarithm of the depth and the rows are as many as nodes. Nodes in or below a
    cycle have no root and are left out. The path of a node is its parents', written out by `path_texts`.
    """
    found = roots(edges).select("node", F.col("node").alias("root"), F.lit(0).alias("depth"))
    for k, jump in enumerate(jumps(edges)):
        reached = jump.join(found.withColumnRenamed("node", "far"), "far")
        reached = reached.select("node", "root", (F.col("depth") + (1 << k)).alias("depth"))
        found = checkpoint(found.unionByName(reached))
    parents = edges.select(F.col("child").alias("node"), "parent").distinct()
    return found.join(parents, "node", "left").select("node", "parent", "root", "depth")


def hierarchy_paths(edges: DataFrame) -> DataFrame:
    """Every path from a root: node, depth and the joined path. A path ends before a node it already holds.

    Paths of up to 2^k edges are a path to some node and a piece of 2^(k-1) edges on from it, so the rounds grow with
    the logarithm of the depth. Rows and texts are as many and as long as asked; `ancestry` needs neither.
    """
    steps = edges.select("parent", "child").where("parent IS NOT NULL AND child IS NOT NULL").distinct()
    found = roots(edges).select("node", F.lit(0).alias("depth"), F.array("node").alias("path"))
    # Pieces (from, node, path) of one length; a path leaves out the node that its piece starts from.
    piece = steps.where("parent <> child").select(F.col("parent").alias("from"), F.col("child").alias("node"), F.array("child").alias("path"))
    found, piece, length = checkpoint(found), checkpoint(piece), 1
    while not piece.isEmpty():
        there = found.select(F.col("node").alias("from"), F.col("depth").alias("d"), F.col("path").alias("start"))
        longer = piece.join(there, "from").where(~F.arrays_overlap("start", "path"))
        longer = longer.select("node", (F.col("d") + length).alias("depth"), F.concat("start", "path").alias("path"))
        found = checkpoint(found.unionByName(longer))
        on = piece.select(F.col("from").alias("middle"), F.col("node").alias("end"), F.col("path").alias("rest"))
        double = piece.join(on, F.col("node") == F.col("middle"))
        simple = ~F.arrays_overlap("path", "rest") & ~F.array_contains("rest", F.col("from"))
        piece = checkpoint(double.where(simple).select("from", F.col("end").alias("node"), F.concat("path", "rest").alias("path")))
        length *= 2
    return found.select("node", "depth", F.array_join("path", "/").alias("path"))


def path_texts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and path of some `nodes` (node) of a forest, the path from its root joined, without the paths of any other node."""
    up = [(1 << k, jump) for k, jump in enumerate(jumps(edges))]
    # All ancestors of the wanted nodes alone, with their distance.
    above = nodes.select("node", F.col("node").alias("far"), F.lit(0).alias("distance")).distinct()
    for hop, jump in up:
        on = jump.select(F.col("node").alias("far"), F.col("far").alias("further"))
        above = checkpoint(above.unionByName(
            above.join(on, "far").select("node", F.col("further").alias("far"), (F.col("distance") + hop).alias("distance"))
        ))
    order = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), "far")))
    return above.groupBy("node").agg(F.array_join(F.transform(order, lambda s: s["far"]), "/").alias("path"))


def dangling(edges: DataFrame, ids: DataFrame, target: str = "target", node: str = "id") -> DataFrame:
    """Edges whose target is not a declared id."""
    return edges.join(ids.select(F.col(node).alias(target)).distinct(), target, "left_anti")
