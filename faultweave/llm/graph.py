"""Connected components of an undirected graph given as rows of (a, b), a and b whole numbers.

Every round hooks each node to its smallest smaller neighbour, which gives a forest, and
flattens the forest by pointer jumping; edges are then drawn between roots. Both steps end
after a number of rounds logarithmic in the graph. Tables between rounds are written to
the shared folder: they survive lost executors, and a node with very many edges is then
split by adaptive execution, since its join has one exchange on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.sources.workspace import materialise, release


def _replace(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """`column` through `mapping` (node, root) where it has an entry."""
    by = mapping.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = df.join(by, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _flatten(forest: DataFrame) -> DataFrame:
    while True:
        jumped = _replace(forest, "root", forest)
        changed = jumped.join(forest.select("node", F.col("root").alias("was")), "node").filter("root <> was")
        jumped = materialise(jumped, "forest")
        done = changed.isEmpty()
        release(forest)
        if done:
            return jumped
        forest = jumped


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of an edge."""
    ordered = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    left = materialise(ordered.filter("lo < hi").distinct(), "edges")
    roots = materialise(
        left.select(F.col("lo").alias("node")).union(left.select("hi")).distinct().withColumn("root", F.col("node")),
        "roots",
    )
    while not left.isEmpty():
        hooks = left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
        forest = _flatten(materialise(hooks, "hooks"))
        old = roots, left, forest
        roots = materialise(_replace(roots, "root", forest), "roots")
        moved = _replace(_replace(left, "lo", forest), "hi", forest)
        moved = moved.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
        left = materialise(moved.filter("lo < hi").distinct(), "edges")
        release(*old)
    release(left)
    return roots
