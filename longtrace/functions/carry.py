"""Window functions over long keys in two passes: chunks of a key first, then what each hands to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UP, DOWN = Window.unboundedPreceding, Window.unboundedFollowing


def carried(
    df: DataFrame,
    keys: list[str],
    order: str,
    chunk: int,
    ties: list[str] | None = None,
    lag: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    top: dict[str, Column] | None = None,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
) -> DataFrame:
    """df with a column for each name given, over rows of a key by order, then ties.

    lag, lead: the value in the row before and after; total: the sum of values up to
    the row, nulls as 0; top: the largest value of all rows before; before, after:
    the last value known up to the row and the first from it on.

    A chunk is floor(order / chunk) of a key. Of each chunk one row is made (first and
    last values, sums, largest and known values); windows over these rows, one for
    each chunk, give what the chunks before and after hand over; a window over one
    chunk then finishes its rows. No task holds more than a chunk of a key, and the
    result doesn't depend on chunk, but for the order in which doubles are added.
    Keys are without nulls.
    """
    lag, lead, total, top, before, after = (x or {} for x in (lag, lead, total, top, before, after))
    ties = ties or []
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    # a plain number as the order, and values one by one, keep the aggregate a hash aggregate
    at = F.struct(order, *ties) if ties else F.col(order)
    made = [F.count("*").alias("_made")]
    made += [F.max_by(c, at).alias(f"_lag_{n}") for n, c in lag.items()]
    made += [F.min_by(c, at).alias(f"_lead_{n}") for n, c in lead.items()]
    made += [F.sum(F.coalesce(c, F.lit(0))).alias(f"_total_{n}") for n, c in total.items()]
    made += [F.max(c).alias(f"_top_{n}") for n, c in top.items()]
    made += [F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_before_{n}") for n, c in before.items()]
    made += [F.min_by(c, F.when(c.isNotNull(), at)).alias(f"_after_{n}") for n, c in after.items()]
    outer = Window.partitionBy(*keys).orderBy("_chunk")
    earlier, later = outer.rowsBetween(UP, -1), outer.rowsBetween(1, DOWN)
    handed = [F.lag(f"_lag_{n}").over(outer).alias(f"_lag_{n}") for n in lag]
    handed += [F.lead(f"_lead_{n}").over(outer).alias(f"_lead_{n}") for n in lead]
    handed += [F.sum(f"_total_{n}").over(earlier).alias(f"_total_{n}") for n in total]
    handed += [F.max(f"_top_{n}").over(earlier).alias(f"_top_{n}") for n in top]
    handed += [F.last(f"_before_{n}", ignorenulls=True).over(earlier).alias(f"_before_{n}") for n in before]
    handed += [F.first(f"_after_{n}", ignorenulls=True).over(later).alias(f"_after_{n}") for n in after]
    chunks = rows.groupBy(*keys, "_chunk").agg(*made).select(*keys, "_chunk", *handed)
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order, *ties)
    done = {}
    for n in lag:
        done[n] = F.when(F.row_number().over(inner) == 1, F.col(f"_lag_{n}")).otherwise(F.lag(lag[n]).over(inner))
    for n in lead:
        done[n] = F.when(F.lead(F.lit(1)).over(inner).isNull(), F.col(f"_lead_{n}")).otherwise(F.lead(lead[n]).over(inner))
    for n, c in total.items():
        done[n] = F.sum(F.coalesce(c, F.lit(0))).over(inner.rowsBetween(UP, 0)) + F.coalesce(f"_total_{n}", F.lit(0))
    for n, c in top.items():
        done[n] = F.greatest(F.max(c).over(inner.rowsBetween(UP, -1)), f"_top_{n}")
    for n, c in before.items():
        done[n] = F.coalesce(F.last(c, ignorenulls=True).over(inner.rowsBetween(UP, 0)), f"_before_{n}")
    for n, c in after.items():
        done[n] = F.coalesce(F.first(c, ignorenulls=True).over(inner.rowsBetween(0, DOWN)), f"_after_{n}")
    joined = rows.join(chunks, [*keys, "_chunk"])
    return joined.select(*df.columns, *(c.alias(n) for n, c in done.items()))
