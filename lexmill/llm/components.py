"""Connected components by random-mate contraction, in SQL joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.runtime import discard, known_rows, materialize


def _coin(vertex: Column, turn: int, seed: int) -> Column:
    """True for the vertices that stay put in this round. Derived by hash, so a repeated task tosses the same."""
    return F.xxhash64(vertex, F.lit(turn), F.lit(seed)).bitwiseAND(F.lit(1)) == 1


def components(edges: DataFrame, src: str = "src", dst: str = "dst", seed: int = 17) -> DataFrame:
    """(``vertex``, ``component``) for every vertex of ``edges``; a component is named by one of its vertices.

    Each round tosses a coin for every vertex; a vertex with tails collapses into a neighbour with heads, edges are
    renamed, loops and repeats go. Rounds go on until no edge is left (expected O(log n) of them); then the maps of the
    rounds are unwound from the last to the first. Vertices may be of any one type. Edges with a null end are ignored,
    loops keep their vertex, repeats do no harm, an empty table gives an empty table. A vertex of any degree is safe:
    mates are a minimum, taken on the map side first, and a hub's edges are joined with its one mate by a sort-merge join
    whose large partitions adaptive execution splits; no task gathers a neighbourhood.
    """
    ends = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    vertices = ends.select(F.explode(F.array("u", "v")).alias("vertex")).distinct()
    live = materialize(ends.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges", compact=False, counted=True)
    rounds: list[tuple[DataFrame, DataFrame]] = []
    turn = 0
    while known_rows(live):
        both = live.select("u", "v").union(live.select("v", "u"))
        mates = both.where(~_coin(F.col("u"), turn, seed) & _coin(F.col("v"), turn, seed)).groupBy("u").agg(F.min("v").alias("to"))
        a = mates.select("u", F.col("to").alias("ua"))
        b = mates.select(F.col("u").alias("v"), F.col("to").alias("vb"))
        moved = live.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("ua", "u").alias("u"), F.coalesce("vb", "v").alias("v"))
        after = moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        rounds.append((mates, live))
        live = materialize(after, "edges", compact=False, counted=True)
        turn += 1
    done: DataFrame | None = None
    for k in range(len(rounds) - 1, -1, -1):
        step = rounds[k][0]  # computed again from the round's written edges; the coins are hashes
        if done is None:
            done = step.select(F.col("u").alias("vertex"), F.col("to").alias("component"))
            continue
        later = done.select(F.col("vertex").alias("to"), F.col("component").alias("root"))
        first = step.join(later, "to", "left").select(F.col("u").alias("vertex"), F.coalesce("root", "to").alias("component"))
        done = first.unionByName(done)
        if k % 4 == 0:  # keeps the plan short
            done = materialize(done, "unwound", compact=False)
    if done is None:
        return vertices.select("vertex", F.col("vertex").alias("component"))
    done = materialize(done, "unwound", compact=False)
    for _, edges_then in rounds:
        discard(edges_then)
    return vertices.join(done, "vertex", "left").select("vertex", F.coalesce("component", "vertex").alias("component"))
