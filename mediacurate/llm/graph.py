"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacurate.session import settle_table


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): nodes of one component share a root.

    In each round every node goes over to the lowest of itself and its neighbours in a pseudo-random order that changes with
    the round, and links between merged nodes are dropped; so the nodes left shrink by a constant share each round, whatever
    the shape. Neighbours are folded by a minimum, which is combined before the shuffle, so a node with very many links
    is no burden. Each round is written to the checkpoint folder; only whether links are left reaches the driver.
    """
    edges = settle_table(links.filter("a <> b").select("a", "b").distinct(), "links")
    roots = settle_table(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "roots"
    )
    turn = 0
    while not edges.isEmpty():
        turn += 1

        def rank(node: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(node)), F.col(node).alias("to"))

        both = edges.select("a", "b").union(edges.select("b", "a"))
        moves = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("best"))
        moves = settle_table(
            moves.select("node", F.least(F.col("best"), rank("node"))["to"].alias("to")), "moves"
        )
        renamed = (
            edges.join(moves.withColumnsRenamed({"node": "a", "to": "a2"}), "a")
            .join(moves.withColumnsRenamed({"node": "b", "to": "b2"}), "b")
            .filter("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct()
        )
        edges = settle_table(renamed, "links")
        followed = roots.join(moves.withColumnsRenamed({"node": "root"}), "root", "left")
        roots = settle_table(followed.select("node", F.coalesce("to", "root").alias("root")), "roots")
    return roots
