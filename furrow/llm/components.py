"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import settle


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # Each link hangs on its larger end, so only the links upwards are joined.
    return e.select(F.col("b").alias("a"), F.col("a").alias("up")).join(least, "a").select(F.col("up").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def connected_components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node it reaches) for every node that has
    a link to another one and is not itself the smallest of its component.

    Links to itself and links with a null end are ignored; an empty table gives an
    empty one. Each round is written to the shared folder, so that a lost executor
    costs one round; only two numbers a round come to the driver. A node with many
    links is a hot join key that adaptive execution splits; nothing is collected
    per node.
    """
    a, b = F.col(first), F.col(second)
    e = settle(
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    before = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        e = settle(_small_star(_large_star(e).distinct()))
