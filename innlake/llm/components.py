"""Connected components by alternating large-star and small-star steps.

Each step takes a node's smallest neighbour by an aggregation with map-side combine and hands it on by a join
on the node, so a node with very many links is never gathered in one task. Rounds grow with the logarithm
of a component's diameter; each writes its links to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innlake.llm.workspace import removed, saved


def _least(links: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link. ``links`` has u and v."""
    now = saved(links.select("u", "v").where("u != v").distinct())
    state = _state(now)
    while state[0]:
        then = saved(_small_star(_large_star(now)))
        removed(now)
        now, old, state = then, state, _state(then)
        if state == old:
            break
    tops = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
