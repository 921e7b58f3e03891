"""Repair of event identity (inventory group I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtrace.functions.islands import running
from longtrace.operators.aggregates import FC, event_frame_counts, odd_frames
from longtrace.operators.sequence import EVENTS, HOUR, segments
from longtrace.plans.standins import Book

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def stitch_fragments(events: DataFrame, keys: list[str], period: int, most: int) -> DataFrame:
    """events with `whole` and `offset`: a fragment that starts less than most periods after the one before joins it; its frame numbers go on behind the whole numbers of frames before and between.

    Columns: start and stop in time, n frames. offset is added to a fragment's own numbers.
    """
    w = Window.partitionBy(*keys).orderBy("start")
    gap = F.col("start") - F.lag("stop").over(w)
    apart = F.coalesce(gap >= period * most, F.lit(True))
    step = F.when(apart, 0).otherwise(F.lag("n").over(w) + F.floor(gap / period) - 1)
    rows = events.withColumn("whole", running(apart, w)).withColumn("_s", step)
    inner = Window.partitionBy(*keys, "whole").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("offset", F.sum("_s").over(inner).cast("long")).drop("_s")


STITCH = f"""{EVENTS}, g AS (SELECT *, start - lag(stop) OVER w AS gap, lag(n) OVER w AS pn FROM segments WINDOW w AS (PARTITION BY unit ORDER BY start)),
h AS (SELECT *, sum(CASE WHEN gap < {12 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY unit ORDER BY start) AS whole, CASE WHEN gap < {12 * HOUR} THEN pn + gap // {HOUR} - 1 ELSE 0 END AS s FROM g),
stitched AS (SELECT unit, event, start, stop, n, whole::BIGINT AS whole, (sum(s) OVER (PARTITION BY unit, whole ORDER BY start))::BIGINT AS "offset" FROM h)"""


def stitched(spark, sf) -> DataFrame:
    return stitch_fragments(segments(spark, sf), ["unit"], HOUR, 12)


@BOOK.add("i1_stitch_fragments", f"WITH {STITCH} SELECT * FROM stitched")
def _i1(spark, sf):
    return stitched(spark, sf)


def renumber_events(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """df with `renumbered`: numbers from 1 without holes, in the old order."""
    return df.withColumn("renumbered", F.dense_rank().over(Window.partitionBy(*keys).orderBy(number)))


@BOOK.add("i2_renumber_events", f"WITH {EVENTS} SELECT unit, event, dense_rank() OVER (PARTITION BY unit ORDER BY event)::INTEGER AS renumbered FROM segments WHERE n > 1")
def _i2(spark, sf):
    return renumber_events(segments(spark, sf).where("n > 1").select("unit", "event"), ["unit"], "event")


def drop_stray_events(counts: DataFrame, keys: list[str], event: str, cam: str, few: int) -> DataFrame:
    """counts without events behind the last of their key that all cameras saw with equal counts, if one camera alone saw them in fewer than few frames."""
    stats = counts.groupBy(*keys, event).agg(F.count("n").alias("_cams"), F.min("n").alias("_lo"), F.max("n").alias("_hi"), F.count("*").alias("_all"))
    last = stats.where("_cams = _all and _lo = _hi").groupBy(*keys).agg(F.max(event).alias("_last"))
    stray = stats.join(last, keys, "left").where((F.col("_last").isNull() | (F.col(event) > F.col("_last"))) & (F.col("_cams") == 1) & (F.col("_hi") < few))
    return counts.join(stray.select(*keys, event), [*keys, event], "left_anti")


@BOOK.add(
    "i3_drop_stray_events",
    f"WITH {FC}, c AS (SELECT event // 8 AS session, event, cam, CASE WHEN k >= 46 THEN k // 20 END AS n FROM counts), s AS (SELECT session, event, count(n) AS cams, min(n) AS lo, max(n) AS hi, count(*) AS a FROM c GROUP BY 1, 2), "
    "l AS (SELECT session, max(event) AS l FROM s WHERE cams = a AND lo = hi GROUP BY session) SELECT session, event, cam, n FROM c WHERE event NOT IN (SELECT event FROM s LEFT JOIN l USING (session) WHERE (l IS NULL OR event > l) AND cams = 1 AND hi < 3)",
)
def _i3(spark, sf):
    counts = event_frame_counts(odd_frames(spark, sf), "event", "cam")
    seen = counts.select(F.expr("event div 8").alias("session"), "event", "cam", F.expr("case when n >= 46 then n div 20 end").alias("n"))
    return drop_stray_events(seen, ["session"], "event", "cam", 3)


def adjustment_record(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_before, n_after, start_before, start_after), side by side."""
    old = before.select(*keys, F.col("n").alias("n_before"), F.col("start").alias("start_before"))
    new = after.select(*keys, F.col("n").alias("n_after"), F.col("start").alias("start_after"))
    return old.join(new, keys, "full")


@BOOK.add("i4_adjustment_record", f'WITH {STITCH}, a AS (SELECT unit, whole AS event, sum(n)::BIGINT AS n_after, min(start) AS start_after FROM stitched GROUP BY 1, 2) SELECT coalesce(s.unit, a.unit) AS unit, coalesce(s.event, a.event) AS event, n AS n_before, n_after, start AS start_before, start_after FROM segments s FULL JOIN a ON s.unit = a.unit AND s.event = a.event')
def _i4(spark, sf):
    after = stitched(spark, sf).groupBy("unit", F.col("whole").alias("event")).agg(F.sum("n").alias("n"), F.min("start").alias("start"))
    return adjustment_record(segments(spark, sf), after, ["unit", "event"])
