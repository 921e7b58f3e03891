"""Every row of a table with every row of a small one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of so many rows at most travels to every task as one row.
MOST = 10_000


def with_each(left: DataFrame, few: DataFrame, most: int = MOST) -> DataFrame:
    """left's rows, each with all rows of few; their columns must differ.

    few is counted first. Up to `most` rows it is one broadcast row. Beyond that it is
    dealt into blocks of about that size, each row of left goes to every block, and
    they meet in an equi join on the block.
    """
    n = -(-few.count() // most)
    if n <= 1:
        listed = few.agg(F.collect_list(F.struct(*few.columns)).alias("_few"))
        return left.join(F.broadcast(listed), F.lit(True)).select(*left.columns, F.inline("_few"))
    dealt = few.withColumn("_block", F.pmod(F.xxhash64(*few.columns), F.lit(n)).cast("int"))
    return left.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(dealt, "_block").drop("_block")
