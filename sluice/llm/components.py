"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart without comparing them row by row."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _numbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges with numbers for nodes, in the order of the nodes, and ``name, number``."""
    names = edges.select(F.explode(F.array("u", "v")).alias("name")).distinct().sort("name")
    names = materialise(names.withColumn("number", F.monotonically_increasing_id()), "names")
    for side in "uv":
        ends = names.select(F.col("name").alias(side), F.col("number").alias(f"number_{side}"))
        edges = edges.join(ends, side)
    return edges.select(F.col("number_u").alias("u"), F.col("number_v").alias("v")), names


def components(edges: DataFrame) -> DataFrame:
    """Columns ``u, v`` in, ``node, root`` out: the smallest node it is connected to.

    Nodes may be numbers or strings.  Only nodes with an edge to another appear,
    and not the roots themselves.  Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the graph.  A node with
    many neighbours never meets them in one task: minima are taken first.
    """
    edges, names = edges.where("u <> v"), None
    if dict(edges.dtypes)["u"] == "string":  # minima of numbers need no sort
        edges, names = _numbered(materialise(edges, "named"))
    edges = materialise(edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        now = _mark(edges)
        if now == before:
            break
        before = now
    if names is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    nodes, roots = (names.select(F.col("number").alias(end), F.col("name").alias(name))
                    for end, name in (("u", "node"), ("v", "root")))
    return materialise(edges.join(nodes, "u").join(roots, "v").select("node", "root"), "components")
