"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.texts import with_totals, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    low = F.least("low", "a")
    return (
        with_totals(both, least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), low.alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    joined = with_totals(down, least, "a").filter(F.col("b") > F.col("low")).select("b", "low")
    return joined.toDF("a", "b").union(least.toDF("a", "b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in an edge but the smallest.

    ``edges`` has columns ``a`` and ``b``; loops and repeated edges do no harm. Each round is
    a few joins and aggregates over the edges, whose state is written between rounds.
    """
    state = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        total = state.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if total == seen or not total[0]:
            break
        seen = total
        state = written(_small_star(_large_star(state)), "edges", total[0])
    return state.select(F.col("a").alias("id"), F.col("b").alias("component"))
