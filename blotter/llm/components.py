"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import discard, stored

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round hangs all larger neighbours of a node below its smallest neighbour and then the
    smaller ones; the number of rounds grows with the logarithm of the longest path. A node's
    minimum is an aggregation with partial sums and its neighbours are met by a join, so a node
    with very many links is split like any skewed key. Rounds are stored in the shared folder.
    Nulls and self-links are ignored, repeated edges count once; no edges, no rows.
    """
    up, down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = stored(edges.dropna().where("a <> b").select(up, down).distinct(), "stars")
    for _ in range(MAX_ROUNDS):
        large = _star(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        small = stored(_hang(large), "stars")
        # In a forest of stars no centre hangs below another node and no node below two.
        centres = small.select(F.col("b").alias("a")).distinct()
        settled = small.join(centres, "a", "left_semi").isEmpty() and (
            small.groupBy("a").count().where("count > 1").isEmpty()
        )
        discard(stars)
        stars = small
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _star(both: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _hang(down: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (edges lead downwards)."""
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    met = down.join(least, "a")
    own = least.select("a", F.col("m").alias("b"))
    others = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(others).distinct()
