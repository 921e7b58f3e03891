"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtrace.session import remove, written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return (
        both.join(least, F.col("u") == F.col("c"))
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(u, v) links of longs -> (node, root): the smallest node reachable, for every node but the roots.

    Each round is a least-neighbour aggregate and a join, so no neighbour list is
    gathered; a node with very many links is split by adaptive execution's skew join.
    Rounds are written to the shared folder, the one before removed, and only a row
    count and a checksum come to the driver. Rounds grow with the logarithm of the
    longest chain; max_rounds of them without an end raise. Null ends and self links are left out; an empty
    table gives an empty table.
    """
    now = written(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        last, now = now, written(_small_star(_large_star(now)), "links")
        remove(last)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
