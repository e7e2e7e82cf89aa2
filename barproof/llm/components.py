"""Connected components of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.session import materialize


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one instead: of larger nodes (large), or of smaller ones.

    ``links`` has src > dst. The smallest neighbours are a table of their own, so that the join's
    sides are plain and Spark can split a node with very many links.
    """
    if large:
        both = links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        smallest = materialize(both.groupBy("src").agg(F.min("dst").alias("least")))
        pairs = both.join(smallest, "src").select(
            F.col("dst").alias("node"), F.least("least", "src").alias("least"), F.col("src").alias("of")
        )
        moved = pairs.where("node > of").select(F.col("node").alias("src"), F.col("least").alias("dst"))
    else:
        smallest = materialize(links.groupBy("src").agg(F.min("dst").alias("least")))
        pairs = links.join(smallest, "src")
        moved = pairs.select(F.col("dst").alias("src"), F.col("least").alias("dst")).union(
            smallest.select("src", F.col("least").alias("dst"))
        )
    return moved.where("src > dst").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller one at most, and none to a node that has one."""
    ends = links.select(F.col("src").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("dst", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """The smallest node each linked node can reach: (node, component).

    ``links``: (src, dst), long, in any order and as often as they like. Nodes without a link to
    another node are not listed. Each round is a few shuffles of the links that are left, and is
    written before the next one; the number of rounds grows with the logarithm of the longest
    chain.
    """
    state = materialize(
        links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .where("src > dst")
        .distinct()
    )
    while not _are_stars(state):
        state = materialize(_starred(materialize(_starred(state, large=True)), large=False))
    # All links now lead from a node to the smallest one of its component.
    found = state.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return materialize(found.union(found.select("component", "component").distinct()))
