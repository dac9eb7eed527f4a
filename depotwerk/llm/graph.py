"""Connected components of a graph given by its links, without bringing links to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in ``links`` (columns a, b: long).

    Alternates the large-star and small-star steps until links no longer
    change: a logarithmic number of rounds, and each round holds at most one
    link per link before.  The smallest neighbour is pre-aggregated, so an id
    with very many links does not meet in one task.  Every round is written.
    """
    now = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = _digest(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        now = written(small.unionByName(down.select("a", F.col("low").alias("b"))).distinct())
        before, state = state, _digest(now)
        if state == before:
            break
    stars = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
