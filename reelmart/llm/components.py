"""Connected components of an edge table by alternating large and small stars.

Each round replaces the edges of a node by edges to the least node it knows; rounds needed
grow with the logarithm of the longest path. Nothing is gathered per node: minima are
combined before the shuffle and joined back, where adaptive execution splits large nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart.session import cut_lineage

# Edges that are kept in one partition, whatever the input's size; their rounds need no shuffle.
FEW_EDGES = 20_000


def toward_least(edges: DataFrame, few: bool) -> DataFrame:
    """Edges (node, other) with the least neighbour of node."""
    if few:
        return edges.withColumn("least", F.min("other").over(Window.partitionBy("node")))
    least = edges.groupBy("node").agg(F.min("other").alias("least"))
    return edges.join(least, "node")


def two_edges(edges: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two edges (node, other) of the named columns for each row."""
    ends = [F.struct(F.col(node).alias("node"), F.col(other).alias("other")) for node, other in (first, second)]
    return edges.select(F.inline(F.array(*ends)))


def one_round(edges: DataFrame, few: bool) -> DataFrame:
    """A large star and a small star; ``edges`` holds (node, other) with node > other."""
    large = toward_least(two_edges(edges, ("node", "other"), ("other", "node")), few).filter("other > node")
    large = large.select(F.col("other").alias("node"), F.least("node", "least").alias("other")).distinct()
    small = toward_least(large, few)
    return two_edges(small, ("other", "least"), ("node", "least")).filter("node > other").distinct()


def components(edges: DataFrame, left: str, right: str, few_edges: int = FEW_EDGES) -> DataFrame:
    """``node, root`` of every node that has an edge; root is the least node reachable."""
    pair = F.least(left, right).alias("other"), F.greatest(left, right).alias("node")
    state = cut_lineage(edges.select(*pair).filter("node > other").distinct(), "edges")
    before = None
    while True:
        print_of = state.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if print_of == before or not print_of[0]:
            break
        before, few = print_of, print_of[0] <= few_edges
        state = cut_lineage(one_round(state.coalesce(1) if few else state, few), "stars")
    roots = state.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
    return state.select("node", F.col("other").alias("root")).unionByName(roots)


def extended(roots: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """``roots`` as :func:`components` gives them, after more links.

    Only what the links join is worked on: the components they touch, a node each.
    """
    named = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"_{name}"))
    ends = links.join(named(left), left, "left").join(named(right), right, "left")
    joined = components(ends.select(F.coalesce(f"_{left}", left).alias(left), F.coalesce(f"_{right}", right).alias(right)), left, right)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left")
    first_seen = joined.join(roots.select("node"), "node", "left_anti")
    return cut_lineage(moved.select("node", F.coalesce("_new", "root").alias("root")).unionByName(first_seen), "roots")
