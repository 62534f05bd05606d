"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.storage import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b): the smallest node reachable.

    Alternates two steps: every node hands its smallest neighbour to its larger neighbours, then to
    its smaller ones. Each step is an aggregation with map-side combine and a join, so a node with
    very many neighbours is no single task; paths shrink by at least half in a round. NULL ends and
    loops are ignored; no edges give no rows.
    """
    edges = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    links = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A node that is the smallest of its surroundings keeps its larger neighbours as they are.
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m")), F.struct(F.col("b").alias("x"), F.col("m")))).alias("e"))
            .select(F.col("e.x").alias("a"), F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = stored(small)
        if stars(now):
            links = now
            break
        links = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def stars(links: DataFrame) -> bool:
    """Every node points to one root, and no root points on."""
    many = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    onward = links.join(links.select(F.col("a").alias("b")), "b", "left_semi").select("a")
    return many.union(onward).isEmpty()
