"""Connected components of a table of links, by repeated star contractions.

Each round joins every node to the smallest one it knows (large star, then small star) and writes the
links, so lineage stays short and lost executors cost one round. Rounds end when the links no longer
change; their number grows with the logarithm of the longest chain. A node with very many links is folded
before the shuffle, and the joins are left to adaptive execution, which splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger node to the smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (u, v; longs, no nulls) can reach,
    for every node but the roots themselves. No links give no rows."""
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
