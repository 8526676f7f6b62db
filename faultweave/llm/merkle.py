"""A Merkle tree over the documents of each source, and one over the sources.

A leaf is the hash of a document's fields. In every tree runs of FANOUT consecutive nodes
become their common hash until one node remains; the trees' last nodes, in order of their
sources, are the leaves of one more tree, whose last node is the root of the dataset.

Method. The leaves of a tree are numbered without a window over the tree
(`positions.numbered`) and cut into cells of FANOUT ** LEVELS. Runs never cross a cell, so
all levels inside a cell come from windows over the cell, which share one exchange and one
sort. At level l a node stands in the row of its first leaf; lag and lead over FANOUT ** l
and its double, masked by the node's slot in its run and by the run's length, give its
siblings, and the rows of first children hash the run into the parent. A running "last
value" hands every leaf the siblings of its ancestors. The cells' top nodes are the leaves
of the next storey. What stands above a cell is joined to its leaves on the way back, by
tree and cell, in the partitioning that the windows left.

No task ever holds a tree: windows see a cell, the storey above has FANOUT ** LEVELS times
fewer rows, and a source with a third of all documents is spread over its cells.

Defined results: a null field is hashed as `-`, differently from the empty one; the null
source is a tree of its own and stands first; null ids stand first in their tree; rows of
one id are ordered by their leaf, so equal rows are neighbours and their order doesn't
matter; a tree of one leaf is that leaf; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.operators.positions import numbered
from faultweave.sources.workspace import materialise

FANOUT = 3
# A cell has 2,187 rows, so that its windows stay below Spark's in-memory limit of rows.
LEVELS = 7

FIELDS = ("doc_id", "source", "lang", "n_chars")
STEPS = "array<struct<left:string,right:string>>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """The value behind its length in bytes, `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    """A document's leaf; `text` in place of its own text, as in a received copy."""
    return hashed(*[field(F.col(c)) for c in FIELDS], field(F.col("text") if text is None else text))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, step: hashed(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """Adds cell, steps (the siblings of each node and of its ancestors in the cell) and top,
    the cell's last node, to nodes with tree, at, n and node.

    Levels above a tree's last node add no step and pass the node on.
    """
    size = FANOUT**levels
    cell = Window.partitionBy("tree", "cell").orderBy("at")
    upto = cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at, n = F.col("at"), F.col("n")
    rows = nodes.withColumns({"cell": F.floor(at / size), "_node_0": F.col("node")})
    for level in range(levels):
        unit = FANOUT**level
        node = f"_node_{level}"
        rows = rows.withColumns(
            {
                "_lag_2": F.lag(node, 2 * unit).over(cell),
                "_lag_1": F.lag(node, unit).over(cell),
                "_lead_1": F.lead(node, unit).over(cell),
                "_lead_2": F.lead(node, 2 * unit).over(cell),
            }
        )
        index = F.floor(at / unit)
        slot = index % FANOUT
        left_over = F.ceil(n / unit) - (index - slot)
        several = n > unit

        def masked(name: str, when: Column) -> Column:
            return F.when(when, F.col(name)).otherwise(F.lit(""))

        left = F.concat(masked("_lag_2", slot == 2), masked("_lag_1", slot >= 1))
        right = F.concat(
            masked("_lead_1", (slot < 2) & (left_over > slot + 1)), masked("_lead_2", (slot == 0) & (left_over > 2))
        )
        stands, first = at % unit == 0, at % (FANOUT * unit) == 0
        rows = rows.withColumns(
            {
                f"_step_{level}": F.when(stands & several, F.struct(left.alias("left"), right.alias("right"))),
                f"_node_{level + 1}": F.when(
                    first, F.when(several, hashed(F.col(node), right)).otherwise(F.col(node))
                ),
            }
        )
    filled = [F.last(f"_step_{level}", ignorenulls=True).over(upto) for level in range(levels)]
    rows = rows.withColumns(
        {
            "_steps": F.array(*filled) if filled else F.array().cast(STEPS),
            "top": F.last(f"_node_{levels}", ignorenulls=True).over(upto),
        }
    )
    steps = F.filter("_steps", lambda step: step.isNotNull()).cast(STEPS).alias("steps")
    return rows.select(*nodes.columns, "cell", steps, "top")


def _needed(largest: int, levels: int) -> int:
    """Levels until trees of at most `largest` nodes have one left, at most `levels`."""
    needed = 0
    while FANOUT**needed < largest and needed < levels:
        needed += 1
    return needed


def _storeys(leaves: DataFrame, levels: int) -> tuple[list[DataFrame], int]:
    """The leaves, the top nodes of their cells, and so on until every tree lies in one cell;
    and the number of nodes of the largest tree on the last storey."""
    size = FANOUT**levels
    largest = leaves.agg(F.max("n")).first()[0] or 1
    storeys = [leaves]
    while largest > size:
        tops = _climb(storeys[-1], levels).filter(F.col("at") % size == 0)
        tops = tops.select("tree", F.col("cell").alias("at"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
        storeys.append(materialise(tops, "merkle-storey"))
        largest = -(-largest // size)
    return storeys, largest


def _descend(storeys: list[DataFrame], largest: int, above: DataFrame, levels: int) -> DataFrame:
    """The leaves with path, root and subroot; `above`: tree, cell, and these over each last cell."""
    for storey in reversed(storeys):
        keys = [F.col("tree").alias("_tree"), F.col("cell").alias("_cell"), F.col("path").alias("_path")]
        over = above.select(*keys, "root", "subroot")
        climbed = _climb(storey, _needed(largest, levels) if storey is storeys[-1] else levels)
        met = climbed.join(over, (F.col("tree") == F.col("_tree")) & (F.col("cell") == F.col("_cell")))
        found = met.select(*storey.columns, F.concat("steps", "_path").alias("path"), "root", "subroot")
        if storey is not storeys[0]:
            above = found.select("tree", F.col("at").alias("cell"), "path", "root", "subroot")
            above = materialise(above, "merkle-above")
    return found


def _last_nodes(storeys: list[DataFrame], largest: int, levels: int) -> DataFrame:
    """tree and node: the last node of each tree."""
    last = _climb(storeys[-1], _needed(largest, levels)).filter("at = 0")
    return last.select("tree", F.col("top").alias("node"))


def manifest(docs: DataFrame, carried: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, position in the source, leaf, subroot, root and path of every document.

    `path` lists the levels from the leaf to the root, each with the siblings on the left and
    on the right as hex digests in a row. `carried`: further columns, computed from the
    documents' rows in the same pass.
    """
    carried = carried or {}
    # A name no source has: null comes before "+..." and sources keep their order.
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    leaves = docs.select(
        "doc_id", "source", tree.alias("tree"), leaf_hash().alias("node"),
        F.monotonically_increasing_id().alias("tie"),
        F.struct(*[c.alias(name) for name, c in carried.items()], F.lit(0).alias("_")).alias("carried"),
    )
    leaves = materialise(leaves, "merkle-leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("node").asc(), F.col("tie").asc()]
    leaves = numbered(leaves, order, ["tree"], "at", "n").drop("tie")

    storeys, largest = _storeys(leaves, levels)
    subroots = materialise(_last_nodes(storeys, largest, levels), "merkle-subroots")
    # The tree over the sources: one tree, whose leaves are numbered and climbed alike.
    tops = numbered(subroots.withColumnRenamed("tree", "name"), [F.col("name").asc()], (), "at", "n")
    tops = tops.withColumn("tree", F.lit(""))
    top_storeys, top_largest = _storeys(tops, levels)
    crown = _last_nodes(top_storeys, top_largest, levels).select(
        "tree", F.lit(0).cast("long").alias("cell"), F.array().cast(STEPS).alias("path"),
        F.col("node").alias("root"), F.lit(None).cast("string").alias("subroot"),
    )
    over_sources = _descend(top_storeys, top_largest, crown, levels)
    above = over_sources.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("cell"), "path", "root", F.col("node").alias("subroot")
    )
    above = materialise(above, "merkle-sources")
    found = _descend(storeys, largest, above, levels)
    return found.select(
        "doc_id", "source", F.col("at").alias("position"), F.col("node").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"carried.{name}").alias(name) for name in carried],
    )


def verified(listed: DataFrame, leaf: str) -> DataFrame:
    """Adds folded_root, recomputed from the leaf in column `leaf` and the listed siblings,
    and verified, whether it is the listed root."""
    folded = listed.withColumn("folded_root", fold(F.col(leaf), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
