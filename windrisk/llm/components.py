"""Connected components of an edge table that no task and no driver ever holds whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrisk.llm.common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """(node, parent) with parent < node -> (node, root) by pointer jumping, every round halves the depth."""
    while True:
        up = parents.select(F.col("node").alias("mid"), F.col("parent").alias("top"))
        parents = stored(parents.join(up, F.col("parent") == F.col("mid"), "left")
                         .select("node", F.coalesce("top", "parent").alias("parent"), F.col("top").isNotNull().alias("moved")), "jump")
        if parents.where("moved").isEmpty():
            return parents.select("node", "parent")
        parents = parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """Edges `a`, `b` -> `node`, `component` for every node that is not the smallest of its component.

    Each round hooks every node to its smallest smaller neighbour (a grouped minimum, summed up in the
    tasks first, so a hub costs one row for each task), jumps to the roots, and contracts the edges.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = None
    while found is None or not edges.isEmpty():
        roots = _roots(stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "hooks"))
        if found is None:
            found = roots.withColumnRenamed("parent", "component")
        else:
            up = roots.select(F.col("node").alias("mid"), F.col("parent").alias("top"))
            found = (found.join(up, F.col("component") == F.col("mid"), "left")
                     .select("node", F.coalesce("top", "component").alias("component"))
                     .unionByName(roots.withColumnRenamed("parent", "component")))
            found = stored(found, "found")
        for side in ("a", "b"):
            up = roots.select(F.col("node").alias("mid"), F.col("parent").alias("top"))
            edges = edges.join(up, F.col(side) == F.col("mid"), "left").withColumn(side, F.coalesce("top", side)).drop("mid", "top")
        edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return found
