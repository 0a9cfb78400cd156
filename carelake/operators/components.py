"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """`node`, `component` (its smallest node) for every node of `edges` (`a`, `b`); null ends are left out.

    Contraction: each round a node moves to a neighbour, and edges are rewritten to where their ends moved. In the first
    round that is the least neighbour, which turns stars around their least node into one node; later it is the one with
    the least random rank of the round, which takes a fixed share of the nodes even off a chain. The number of rounds
    grows with the logarithm of the nodes, and what they write shrinks from round to round. Joins see a hot node only as
    one side of a sort-merge join, which the adaptive plan splits.

    `keep` writes a table under a name and returns it read back; it cuts the lineage of every round.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    live = keep(both, "edges-0")
    where = live.select(F.col("a").alias("node"), F.col("a").alias("at")).distinct()
    turn = 0
    while not live.isEmpty():
        by = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)) if turn else F.lit(0), F.col(c).alias("v"))  # noqa: B023, E731
        best = live.groupBy("a").agg(F.min(by("b")).alias("o"))
        moved = keep(best.select("a", F.least(F.col("o"), by("a"))["v"].alias("to")), f"moves-{turn}")
        ends = moved.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        nearer = (live.join(moved, "a").join(ends, "b").where("to <> to_b")
                  .select(F.col("to").alias("a"), F.col("to_b").alias("b")).distinct())
        where = where.join(moved.select(F.col("a").alias("at"), "to"), "at", "left").select(
            "node", F.coalesce("to", "at").alias("at"))
        turn += 1
        live = keep(nearer, f"edges-{turn}")
    least = where.groupBy("at").agg(F.min("node").alias("component"))
    return keep(where.join(least, "at").select("node", "component"), "components")
