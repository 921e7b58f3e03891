"""Connected groups of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtrace.session import remove, written


def connected_groups(links: DataFrame, a: str = "a", b: str = "b", most: int = 64) -> DataFrame:
    """(node, root): the smallest node that each node of links reaches, roots included; nodes may be of any type that sorts.

    A round takes the least root among a node and its neighbours and then that
    root's own root, so chains shrink by powers; no list of neighbours is gathered.
    Rounds are written, the one before is removed, and a count and a checksum come
    to the driver. `most` rounds without an end raise; null ends are left out.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("to")).where("node is not null and to is not null")
    both = written(both.union(both.select(F.col("to").alias("node"), F.col("node").alias("to"))).distinct(), "ends")
    now, seen = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("root")), "roots"), None
    for _ in range(most):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
        if mark == seen:
            remove(both)
            return now
        seen, last = mark, now
        near = both.join(now.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("root").alias("near"))
        lower = now.join(near, "node").select("node", F.least("root", "near").alias("root"))
        of = now.select(F.col("node").alias("root"), F.col("root").alias("further"))
        now = written(lower.join(of, "root").select("node", F.least("root", "further").alias("root")), "roots")
        remove(last)
    raise RuntimeError(f"no fixed point after {most} rounds")
