"""Runs in ordered data, found chunk by chunk so that one long channel is never one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: str, gap: int, chunk: int | None = None) -> DataFrame:
    """(keys, first, last, n): maximal runs of rows whose neighbours in `order` are at most gap apart.

    chunk: rows are first split by floor(order / chunk), so a window holds one
    chunk of one key; the runs of chunks, few by then, are joined in a second pass.
    The result doesn't depend on chunk.
    """
    df = df.withColumn("_chunk", F.floor(F.col(order) / chunk) if chunk else F.lit(0))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order)
    new = (F.col(order) - F.lag(order).over(inner) > gap) | F.lag(order).over(inner).isNull()
    marked = df.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy(*keys, "_chunk", "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
    if not chunk:
        return runs.select(*keys, "first", "last", "n")
    outer = Window.partitionBy(*keys).orderBy("first")
    apart = (F.col("first") - F.lag("last").over(outer) > gap) | F.lag("last").over(outer).isNull()
    joined = runs.withColumn("_new", apart.cast("int")).withColumn("_run", F.sum("_new").over(outer.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy(*keys, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("_run")


def running(condition: Column, window) -> Column:
    """Number of rows so far that meet condition: an island number."""
    return F.sum(condition.cast("long")).over(window.rowsBetween(Window.unboundedPreceding, 0))


def band_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, low: str, high: str, bucket: int, how: str = "inner") -> DataFrame:
    """Rows with equal keys and low <= at <= high.

    The right side's ranges are listed per bucket of `at`, so the join is an equi
    join on keys and bucket with the range as residual: no nested loop, and a long
    series is spread over its buckets. `how`: inner, left or left_semi.
    """
    of = F.explode(F.sequence(F.floor(F.col(low) / bucket), F.floor(F.col(high) / bucket)))
    spread = right.select(*(F.col(k).alias(f"_key_{k}") for k in keys), *(c for c in right.columns if c not in keys), of.alias("_range"))
    cut = left.withColumn("_bucket", F.floor(F.col(at) / bucket))
    on = [F.col(k) == F.col(f"_key_{k}") for k in keys]
    on += [F.col("_bucket") == F.col("_range"), F.col(at) >= F.col(low), F.col(at) <= F.col(high)]
    return cut.join(spread, on, how).drop("_bucket", "_range", *(f"_key_{k}" for k in keys))
