"""Cleaning of trajectories and reach segmentation (inventory group D, the parts with peaks, fits and loops).

Trajectories are of any length: what needs a walk runs over chunks of frames with rims
(per_chunk), over peaks (functions.peaks) or over runs of neighbouring jumps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longtrace.functions import peaks
from longtrace.functions.carry import carried
from longtrace.functions.islands import band_join, islands, running
from longtrace.operators.sequence import derivatives, interpolate_series, speed, threshold_crossings
from longtrace.plans.standins import FRAMES, POSE, Book, frames, pose

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
KEYS = ["event", "marker"]


def per_trajectory(df: DataFrame, keys: list[str], frame: str, columns: list[str], out: dict[str, T.DataType], f: Callable[[pd.DataFrame], dict]) -> DataFrame:
    """(keys, frame, out): f over each trajectory's columns in frame order, giving arrays as long as it.

    Trajectories come sorted, many to a batch, and the parts of one that batches cut
    are held until its end is there. Null keys are equal.
    """
    schema = T.StructType([*(df.schema[k] for k in keys), df.schema[frame], *(T.StructField(n, t) for n, t in out.items())])

    def walked(pdf: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        found = [f(pdf.iloc[a:b].reset_index(drop=True)) for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True)]
        return pdf[[*keys, frame]].assign(**{n: np.concatenate([x[n] for x in found]) for n in out})[schema.names]

    def starts_of(pdf: pd.DataFrame) -> list[int]:
        before = pdf[keys].shift()
        return np.flatnonzero(((pdf[keys] != before) & ~(pdf[keys].isna() & before.isna())).any(axis=1) | (np.arange(len(pdf)) == 0)).tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            starts = starts_of(pdf)
            if held and len(starts_of(pd.concat([held[-1].iloc[-1:], pdf.iloc[:1]], ignore_index=True))) == 1:
                if len(starts) == 1:
                    held.append(pdf)
                    continue
                held.append(pdf.iloc[: starts[1]])
                pdf, starts = pdf.iloc[starts[1] :], [k - starts[1] for k in starts[1:]]
            if held:
                yield walked(pd.concat(held, ignore_index=True), [0])
            if len(starts) > 1:
                yield walked(pdf.iloc[: starts[-1]], starts[:-1])
            held = [pdf.iloc[starts[-1] :]]
        if held:
            yield walked(pd.concat(held, ignore_index=True), [0])

    rows = df.select(*dict.fromkeys([*keys, frame, *columns])).repartition(*keys).sortWithinPartitions(*keys, frame)
    return rows.mapInPandas(run, schema)


def per_chunk(df: DataFrame, keys: list[str], frame: str, columns: list[str], out: dict[str, T.DataType], f: Callable[[pd.DataFrame], dict], chunk: int, rim: int) -> DataFrame:
    """per_trajectory over chunks of frames, each with rim frames of its neighbours, for an f whose results don't depend on frames further off."""
    reach = F.sequence(F.floor((F.col(frame) - rim) / chunk), F.floor((F.col(frame) + rim) / chunk))
    spread = df.select(*dict.fromkeys([*keys, frame, *columns])).withColumn("_chunk", F.explode(reach))
    done = per_trajectory(spread, [*keys, "_chunk"], frame, columns, out, f)
    return done.where(F.floor(F.col(frame) / chunk) == F.col("_chunk")).drop("_chunk")


def find_peaks(df: DataFrame, keys: list[str], frame: str, value: str, height: float, distance: int, prominence: float, chunk: int = 1 << 16, wlen: int | None = None) -> DataFrame:
    """(keys, frame) of maxima of at least height, the highest first where nearer than distance, that stand prominence above the higher of the lows on both sides; wlen: lows within half of it only."""
    if wlen is None:
        return peaks.find_peaks(df, keys, frame, value, height, distance, prominence, chunk).select(*keys, frame)
    found = peaks.thinned(peaks.local_maxima(df, keys, frame, value, height, chunk), keys, frame, value, distance, chunk)
    marked = df.select(*keys, frame, value).join(found.select(*keys, frame, F.lit(True).alias("_top")), [*keys, frame], "left")
    half = wlen // 2

    def rises(p: pd.DataFrame) -> dict:
        x = p[value].to_numpy(float)
        out = np.full(len(x), np.nan)
        for k in np.flatnonzero(p["_top"].notna()):
            sides = []
            for side in (x[max(0, k - half) : k][::-1], x[k + 1 : k + half + 1]):
                end = np.flatnonzero(~(side <= x[k]))
                sides.append(min(x[k], side[: end[0] if len(end) else len(side)].min(initial=np.inf)))
            out[k] = x[k] - max(sides)
        return {"rise": out}

    return per_chunk(marked, keys, frame, [value, "_top"], {"rise": T.DoubleType()}, rises, chunk, half).where((F.col("rise") >= prominence) & ~F.isnan("rise")).select(*keys, frame)


@BOOK.add("d26_find_peaks")
def _d26(spark, sf):
    return find_peaks(pose(spark, sf), KEYS, "frame", "y", 60, 3, 20, chunk=64)


@BOOK.add("d26b_find_peaks_within")
def _d26b(spark, sf):
    return find_peaks(pose(spark, sf), KEYS, "frame", "y", 60, 3, 20, chunk=64, wlen=15)


def error_slices(df: DataFrame, keys: list[str], frame: str, error: str, height: float = 40, distance: int = 20, window: int = 20, step: int = 10, multiples: int = 4, chunk: int = 1 << 16) -> DataFrame:
    """(keys, peak, first, last, top): what lies around each peak of the error, between calm frames.

    A frame is calm at m if its error is below m times the key's median. Before and
    after the peak the nearest calm frame within the window counts, at the smallest m
    up to `multiples` that has one; if none has, the window grows by steps, and a peak
    whose window would leave the key is left out. A peak within the slice of an
    earlier one that is kept has none of its own. Missing errors are interpolated.
    """
    rows = interpolate_series(df.select(*keys, frame, error), keys, frame, error, chunk).select(*keys, frame, F.col("filled").alias("_e"))
    stats = df.groupBy(*keys).agg(F.percentile(error, F.lit(0.5)).alias("_m"), F.min(frame).alias("_lo"), F.max(frame).alias("_hi"))
    tops = peaks.find_peaks(rows, keys, frame, "_e", height, distance, 0.0, chunk)
    calm = rows.join(stats, keys)
    calm = carried(calm, keys, frame, chunk, lag={"_p": F.col("_e")})
    levels = range(1, multiples + 1)
    near = carried(
        calm, keys, frame, chunk,
        before={f"_s{m}": F.when(F.col("_p") < m * F.col("_m"), F.col(frame) - 1) for m in levels},
        after={f"_t{m}": F.when(F.col("_e") < m * F.col("_m"), F.col(frame)) for m in levels},
    )
    at = near.join(tops.select(*keys, frame), [*keys, frame])
    f, last = F.col(frame), multiples
    grown = lambda need: F.ceil(F.greatest(F.lit(0), need - window) / step) * step
    pre, post = window + grown(f - F.col(f"_s{last}")), window + grown(F.col(f"_t{last}") - f + 1)
    first = F.coalesce(*(F.when(f - F.col(f"_s{m}") <= pre, F.col(f"_s{m}")) for m in levels))
    stop = F.coalesce(*(F.when(F.col(f"_t{m}") - f + 1 <= post, F.col(f"_t{m}")) for m in levels))
    inside = (f - pre >= F.col("_lo")) & ((post == window) | (f + post <= F.col("_hi") + 1))
    slices = at.where(inside).select(*keys, f.alias("peak"), first.alias("first"), stop.alias("last")).where("first is not null and last is not null")
    ended = carried(slices, keys, "peak", chunk, top={"_ended": F.col("last")})
    apart = F.coalesce(F.col("peak") > F.col("_ended"), F.lit(True)).cast("long")
    runs = carried(ended.withColumn("_apart", apart), keys, "peak", chunk, total={"_run": F.col("_apart")}).select(*keys, "_run", "peak", "first", "last")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        stop, kept = None, []
        for k in np.argsort(pdf["peak"].to_numpy()):
            if stop is None or pdf["peak"].iloc[k] > stop:
                kept.append(k)
                stop = pdf["last"].iloc[k]
        return pdf.iloc[kept]

    chosen = runs.groupBy(*keys, "_run").applyInPandas(walk, runs.schema).drop("_run")
    tallest = band_join(rows.withColumnRenamed(frame, "_f"), chosen, keys, "_f", "first", "last", chunk)
    return tallest.groupBy(*keys, "peak", "first", "last").agg(F.max("_e").alias("top"))


def on_lines(df: DataFrame, found: DataFrame, keys: list[str], frame: str, values: list[str], order: str) -> DataFrame:
    """df with line_<value>: the straight line through the values at first and last of the slice of found that holds the frame, of several the one with the largest `order`, then the shortest."""
    ends = found.select(*keys, "first", "last", F.col(order).alias("_order"))
    for side in ("first", "last"):
        ends = ends.join(df.select(*keys, F.col(frame).alias(side), *(F.col(v).alias(f"_{side}_{v}") for v in values)), [*keys, side])
    share = F.coalesce((F.col(frame) - F.col("first")) / F.when(F.col("last") > F.col("first"), F.col("last") - F.col("first")), F.lit(0.0))
    spread = ends.withColumn(frame, F.explode(F.sequence("first", "last")))
    line = F.struct(*((F.col(f"_first_{v}") + (F.col(f"_last_{v}") - F.col(f"_first_{v}")) * share).alias(f"line_{v}") for v in values))
    chosen = spread.groupBy(*keys, frame).agg(F.max_by(line, F.struct("_order", "first", -F.col("last"))).alias("_line"))
    return df.join(chosen, [*keys, frame], "left").select(*df.columns, *(F.col(f"_line.line_{v}") for v in values))


def fix_jumps(df: DataFrame, keys: list[str], frame: str, values: list[str], error: str, height: float = 40, distance: int = 20, window: int = 20, deviation: float = 9.5, most: float = 40, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, fixed_<value>): within each slice around an error peak (error_slices) the values follow the straight line between its ends, if they stray from it by more than deviation on average or the error exceeds most; slices with a missing value stay."""
    slices = error_slices(df, keys, frame, error, height, distance, window, chunk=chunk)
    rows = df.select(*keys, frame, *values)
    ends = slices
    for side in ("first", "last"):
        ends = ends.join(rows.select(*keys, F.col(frame).alias(side), *(F.col(v).alias(f"_{side}_{v}") for v in values)), [*keys, side])
    inside = band_join(rows.withColumnRenamed(frame, "_f"), ends, keys, "_f", "first", "last", chunk)
    share = F.coalesce((F.col("_f") - F.col("first")) / F.when(F.col("last") > F.col("first"), F.col("last") - F.col("first")), F.lit(0.0))
    off = F.sqrt(sum(((F.col(v) - F.col(f"_first_{v}") - (F.col(f"_last_{v}") - F.col(f"_first_{v}")) * share) ** 2 for v in values), F.lit(0.0)))
    stats = inside.groupBy(*keys, "peak", "first", "last", "top").agg(F.avg(off).alias("_d"), F.count(off).alias("_n"))
    bad = stats.where((F.col("_n") == F.col("last") - F.col("first") + 1) & ((F.col("_d") > deviation) | (F.col("top") > most)))
    lined = on_lines(rows, bad, keys, frame, values, "peak")
    return lined.select(*keys, frame, *(F.coalesce(f"line_{v}", v).alias(f"fixed_{v}") for v in values))


@BOOK.add("d16_fix_jumps")
def _d16(spark, sf):
    rows = pose(spark, sf)
    fixed = fix_jumps(rows, KEYS, "frame", ["y", "z"], "error", window=4, distance=5, chunk=64)
    return fixed.select(*KEYS, "frame", F.round("fixed_y", 6).alias("fixed_y"), F.round("fixed_z", 6).alias("fixed_z"))


def blips(df: DataFrame, keys: list[str], frame: str, value: str, longest: int) -> DataFrame:
    """(keys, first, last, before, after): runs of NULLs of at most longest frames with a value on both sides, and those values."""
    runs = islands(df.where(F.col(value).isNull()), keys, frame, 1).where(F.col("n") <= longest)
    edge = lambda c, d, n: df.select(*keys, (F.col(frame) + d).alias(c), F.col(value).alias(n)).where(F.col(n).isNotNull())
    return runs.join(edge("first", 1, "before"), [*keys, "first"]).join(edge("last", -1, "after"), [*keys, "last"]).select(*keys, "first", "last", "before", "after")


def blip_stats(df: DataFrame, found: DataFrame, keys: list[str], frame: str, raw: str, error: str) -> DataFrame:
    """found with `deviation` (mean distance of the raw values from the straight line), `peak` (largest), `mean_error` and `tracked` (share of frames with an error)."""
    rows = df.select(*keys, F.col(frame).alias("_f"), F.col(raw).alias("_x"), F.col(error).alias("_e"))
    inside = band_join(rows, found, keys, "_f", "first", "last", 256)
    line = F.col("before") + (F.col("after") - F.col("before")) * (F.col("_f") - F.col("first") + 1) / (F.col("last") - F.col("first") + 2)
    off = F.abs(F.col("_x") - line)
    return inside.groupBy(*keys, "first", "last", "before", "after").agg(F.avg(off).alias("deviation"), F.max(off).alias("peak"), F.avg("_e").alias("mean_error"), (F.count("_e") / F.count("*")).alias("tracked"))


def checked(spark, sf) -> DataFrame:
    """Trajectories with y NULL where the error exceeds 40, and the raw y as raw; an error counts as known from two cameras on."""
    return pose(spark, sf).select(*KEYS, "frame", F.col("y").alias("raw"), F.when(F.col("ncams") >= 2, F.col("error")).alias("error"), F.when(F.col("error") <= 40, F.col("y")).alias("y"))


BLIP = f"""{POSE}, q AS (SELECT event, marker, frame, y AS raw, CASE WHEN ncams >= 2 THEN error END AS error, CASE WHEN error <= 40 THEN y END AS y FROM pose),
nul AS (SELECT event, marker, min(frame) AS first, max(frame) AS last FROM (SELECT *, frame - row_number() OVER (PARTITION BY event, marker ORDER BY frame) AS g FROM q WHERE y IS NULL) GROUP BY event, marker, g HAVING count(*) <= 6),
blips AS (SELECT n.*, a.y AS before, b.y AS after FROM nul n JOIN q a ON a.event = n.event AND a.marker = n.marker AND a.frame = n.first - 1 JOIN q b ON b.event = n.event AND b.marker = n.marker AND b.frame = n.last + 1),
stats AS (SELECT b.event, b.marker, first, last, before, after, avg(abs(raw - (before + (after - before) * (frame - first + 1) / (last - first + 2)))) AS deviation, max(abs(raw - (before + (after - before) * (frame - first + 1) / (last - first + 2)))) AS peak, avg(error) AS mean_error, count(error) / count(*) AS tracked FROM blips b JOIN q ON q.event = b.event AND q.marker = b.marker AND q.frame BETWEEN first AND last GROUP BY ALL)"""


def widened(df: DataFrame, found: DataFrame, keys: list[str], frame: str, error: str, before: int, after: int = 20, chunk: int = 1 << 12) -> DataFrame:
    """found with from_ and to: the last frame, of those up to `before` frames ahead of the blip, whose error is below the smallest multiple of the key's median that any of them is below, and the first such frame of `after` behind it; the blip's own neighbours where none has an error."""
    mid = df.groupBy(*keys).agg(F.percentile(error, F.lit(0.5)).alias("_m"))
    rows = df.select(*keys, F.col(frame).alias("_f"), F.col(error).alias("_e")).where("_e is not null").join(mid, keys).where("_m > 0")
    rows = rows.select(*keys, "_f", (F.floor(F.col("_e") / F.col("_m")) + 1).alias("_x"))
    ranges = {"from_": (F.col("first") - 1 - before, F.col("first") - 1, F.struct(-F.col("_x"), F.col("_f"))), "to": (F.col("last") + 2, F.col("last") + 2 + after, F.struct(-F.col("_x"), -F.col("_f")))}
    out = found
    for name, (low, high, order) in ranges.items():
        windows = found.select(*keys, "first", "last").withColumn("_low", low).withColumn("_high", high)
        best = band_join(rows, windows, keys, "_f", "_low", "_high", chunk).groupBy(*keys, "first", "last").agg(F.max_by("_f", order).alias(name))
        out = out.join(best, [*keys, "first", "last"], "left")
    return out.withColumn("from_", F.coalesce("from_", F.col("first") - 1)).withColumn("to", F.coalesce(F.col("to") - 1, F.col("last") + 1))


def fill_blips(df: DataFrame, keys: list[str], frame: str, value: str, raw: str, error: str, longest: int, deviation: float, peak: float, high_error: float, window: int = 20, manual: DataFrame | None = None) -> DataFrame:
    """(keys, frame, filled): short NULL runs whose raw values stray far from the straight line (over 2 * deviation, or deviation with a peak) at a high error or tracked less than half the time are filled, others stay NULL.

    The line goes between the raw values of calm frames around (widened), over all
    between; of overlapping lines the later blip's counts. manual: (keys, first, last)
    slices that follow their line whatever they hold, over what was found.
    """
    stats = blip_stats(df, blips(df, keys, frame, value, longest), keys, frame, raw, error)
    far = (F.col("deviation") > 2 * deviation) | ((F.col("deviation") > deviation) & (F.col("peak") > peak))
    bad = stats.where(far & ((F.col("tracked") < 0.5) | (F.col("mean_error") > high_error)))
    wide = widened(df, bad.select(*keys, "first", "last"), keys, frame, error, window)
    slices = wide.select(*keys, F.col("from_").alias("first"), F.col("to").alias("last"), F.col("first").alias("_by"))
    if manual is not None:
        slices = slices.unionByName(manual.select(*keys, F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), F.lit(1 << 62).alias("_by")))
    lined = on_lines(df.select(*keys, frame, value, raw), slices, keys, frame, [raw], "_by")
    return lined.select(*keys, frame, F.coalesce(f"line_{raw}", value).alias("filled"))


_WIDE = (
    "bad AS (SELECT * FROM stats WHERE (deviation > 30 OR (deviation > 15 AND peak > 26)) AND (tracked < 0.5 OR mean_error > 40)), em AS (SELECT event, marker, quantile_cont(error, 0.5) AS m FROM q GROUP BY 1, 2), "
    "ex AS (SELECT q.event, q.marker, frame, floor(error / m) + 1 AS x FROM q JOIN em USING (event, marker) WHERE error IS NOT NULL AND m > 0), "
    "wa AS (SELECT b.event, b.marker, first, arg_max(frame, (-x, frame)) AS a FROM bad b JOIN ex e ON e.event = b.event AND e.marker = b.marker AND frame BETWEEN first - 5 AND first - 1 GROUP BY ALL), "
    "wb AS (SELECT b.event, b.marker, first, arg_max(frame, (-x, -frame)) AS b FROM bad b JOIN ex e ON e.event = b.event AND e.marker = b.marker AND frame BETWEEN last + 2 AND last + 22 GROUP BY ALL), "
    "sl AS (SELECT bad.event, bad.marker, coalesce(a, bad.first - 1) AS s, coalesce(b - 1, last + 1) AS t, bad.first AS by_ FROM bad LEFT JOIN wa ON wa.event = bad.event AND wa.marker = bad.marker AND wa.first = bad.first LEFT JOIN wb ON wb.event = bad.event AND wb.marker = bad.marker AND wb.first = bad.first "
    "UNION ALL SELECT event, marker, min(frame), min(frame) + 3, 4611686018427387904 FROM pose WHERE x > 95 GROUP BY event, marker), "
    "ln AS (SELECT q.event, q.marker, q.frame, arg_max(u.raw + (v.raw - u.raw) * CASE WHEN t > s THEN (q.frame - s) / (t - s) ELSE 0 END, (by_, s)) AS line FROM sl JOIN q u ON u.event = sl.event AND u.marker = sl.marker AND u.frame = s JOIN q v ON v.event = sl.event AND v.marker = sl.marker AND v.frame = t JOIN q ON q.event = sl.event AND q.marker = sl.marker AND q.frame BETWEEN s AND t GROUP BY ALL)"
)


@BOOK.add("d17_fill_blips", f"WITH {BLIP}, {_WIDE} SELECT q.event, q.marker, q.frame, round(coalesce(line, y), 4) AS filled FROM q LEFT JOIN ln ON ln.event = q.event AND ln.marker = q.marker AND ln.frame = q.frame")
def _d17(spark, sf):
    # slices given by hand: four frames from a key's first very high x on
    manual = pose(spark, sf).where("x > 95").groupBy(*KEYS).agg(F.min("frame").alias("first")).withColumn("last", F.col("first") + 3)
    return fill_blips(checked(spark, sf), KEYS, "frame", "y", "raw", "error", 6, 15, 26, 40, window=4, manual=manual).withColumn("filled", F.round("filled", 4))


def merge_jumpy_blips(found: DataFrame, keys: list[str], jump: float, near: int) -> DataFrame:
    """(keys, first, last): neighbouring blips less than near frames apart joined when the value jumps by more than jump between them."""
    w = Window.partitionBy(*keys).orderBy("first")
    joined = (F.col("first") - F.lag("last").over(w) < near) & (F.abs(F.col("before") - F.lag("after").over(w)) > jump)
    return found.withColumn("_g", running(~F.coalesce(joined, F.lit(False)), w)).groupBy(*keys, "_g").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_g")


@BOOK.add(
    "d18_merge_jumpy_blips",
    f"WITH {BLIP}, j AS (SELECT *, sum(CASE WHEN first - lag(last) OVER w < 8 AND abs(before - lag(after) OVER w) > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY event, marker ORDER BY first) AS g FROM (SELECT * FROM blips) WINDOW w AS (PARTITION BY event, marker ORDER BY first)) SELECT event, marker, min(first) AS first, max(last) AS last FROM j GROUP BY event, marker, g".replace(
        "sum(CASE WHEN first - lag(last) OVER w < 8 AND abs(before - lag(after) OVER w) > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY event, marker ORDER BY first) AS g FROM (SELECT * FROM blips) WINDOW w AS (PARTITION BY event, marker ORDER BY first)",
        "sum(c) OVER (PARTITION BY event, marker ORDER BY first) AS g FROM (SELECT *, CASE WHEN first - lag(last) OVER w < 8 AND abs(before - lag(after) OVER w) > 20 THEN 0 ELSE 1 END AS c FROM blips WINDOW w AS (PARTITION BY event, marker ORDER BY first))",
    ),
)
def _d18(spark, sf):
    return merge_jumpy_blips(blips(checked(spark, sf), KEYS, "frame", "y", 6), KEYS, 20, 8)


def retain_good_paths(df: DataFrame, keys: list[str], frame: str, value: str, raw: str, error: str, longest: int, deviation: float, high_error: float) -> DataFrame:
    """(keys, frame, kept): NULL runs whose raw values stay within deviation of the straight line get them back; within 1.5 * deviation too, if their mean error is below high_error and over 0.4 of their frames are tracked."""
    stats = blip_stats(df, blips(df, keys, frame, value, longest), keys, frame, raw, error)
    loose = (F.col("deviation") < 1.5 * deviation) & (F.col("mean_error") < high_error) & (F.col("tracked") > 0.4)
    good = stats.where((F.col("deviation") < deviation) | loose).select(*keys, F.explode(F.sequence("first", "last")).alias(frame), F.lit(True).alias("_g"))
    return df.join(good, [*keys, frame], "left").select(*keys, frame, F.when(F.col("_g"), F.col(raw)).otherwise(F.col(value)).alias("kept"))


@BOOK.add(
    "d19_retain_good_paths",
    f"WITH {BLIP} SELECT q.event, q.marker, q.frame, CASE WHEN b.first IS NOT NULL THEN raw ELSE y END AS kept FROM q LEFT JOIN stats b ON q.event = b.event AND q.marker = b.marker AND q.frame BETWEEN first AND last AND (deviation < 20 OR (deviation < 30 AND mean_error < 60 AND tracked > 0.4))",
)
def _d19(spark, sf):
    return retain_good_paths(checked(spark, sf), KEYS, "frame", "y", "raw", "error", 6, 20, 60)


def trim_tail(df: DataFrame, keys: list[str], frame: str, same: Column, known: Column, least: float = 0.25, timeout: int = 0, width: int = 101, margin: int = 100, manual: DataFrame | None = None, chunk: int = 1 << 16) -> DataFrame:
    """df with `kept`: whether a frame stays before the cut and outside the slices given by hand.

    The end counts as the frame `timeout` frames before the key's end, or its last known
    frame if that is sooner. The share of unchanged frames (same) from a frame up to the
    end is smoothed by a local cubic over width frames; the cut is at the first frame
    whose share is below least and below least of the largest, the first and last margin
    frames left out of that. manual: (keys, first, last). frame counts from 0 without gaps.
    """
    ends = df.groupBy(*keys).agg(F.max(frame).alias("_hi"), F.max(F.when(known, F.col(frame))).alias("_known"), F.count_if(same).alias("_all"))
    ends = ends.withColumn("_end", F.least(F.col("_hi") + 1 - timeout, F.col("_known")))
    rows = df.select(*keys, frame, same.cast("long").alias("_same")).join(ends.select(*keys, "_end"), keys).where(F.col(frame) < F.col("_end"))
    whole = rows.groupBy(*keys).agg(F.sum("_same").alias("_whole"))
    running_ = carried(rows, keys, frame, chunk, total={"_sum": F.col("_same")}).join(whole, keys)
    share = running_.select(*keys, frame, "_end", ((F.col("_whole") - F.col("_sum") + F.col("_same")) / (F.col("_end") - F.col(frame))).alias("_share"))
    smooth = savgol_smooth(share, keys, frame, "_share", width, chunk=chunk).join(ends.select(*keys, "_end"), keys)
    best = smooth.where((F.col(frame) >= margin) & (F.col(frame) < F.col("_end") - margin)).groupBy(*keys).agg(F.max("smooth").alias("_best"))
    cut = smooth.join(best, keys).where((F.col("smooth") < least) & (F.col("smooth") < least * F.col("_best"))).groupBy(*keys).agg(F.min(frame).alias("_cut"))
    told = df.join(cut, keys, "left")
    kept = F.col("_cut").isNull() | (F.col(frame) < F.col("_cut"))
    if manual is None:
        return told.withColumn("kept", kept).drop("_cut")
    out = manual.select(*keys, F.explode(F.sequence("first", "last")).alias(frame)).distinct().withColumn("_out", F.lit(True))
    return told.join(out, [*keys, frame], "left").withColumn("kept", kept & F.col("_out").isNull()).drop("_cut", "_out")


def savgol_fit(width: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(fit, powers) of a local polynomial over an odd number of frames: fit @ window are its coefficients, powers @ those its values."""
    powers = np.vander(np.arange(-(width // 2), width // 2 + 1), order + 1, increasing=True)
    return np.linalg.pinv(powers), powers


def savgol_smooth(df: DataFrame, keys: list[str], frame: str, value: str, width: int, order: int = 3, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, smooth): local polynomial fit over width (made odd) frames within each gap-free run; at a run's ends the end fit's values; runs shorter than width stay as they are."""
    half = width // 2
    width = 2 * half + 1
    fit, powers = savgol_fit(width, order)

    def f(p: pd.DataFrame) -> dict:
        x, n = p[value].to_numpy(float), p[frame].to_numpy()
        out = x.copy()
        whole = ~np.isnan(x)
        cut = np.flatnonzero((np.diff(n) != 1) | (whole[1:] != whole[:-1])) + 1
        for a, b in zip([0, *cut], [*cut, len(x)], strict=True):
            if whole[a] and b - a >= width:
                run = x[a:b]
                out[a + half : b - half] = np.lib.stride_tricks.sliding_window_view(run, width) @ fit[0]
                out[a : a + half] = (powers @ (fit @ run[:width]))[:half]
                out[b - half : b] = (powers @ (fit @ run[-width:]))[half + 1 :]
        return {"smooth": out}

    # a row's window, and what tells it from a run's end, lie within width frames
    return per_chunk(df, keys, frame, [value], {"smooth": T.DoubleType()}, f, chunk, width)


def savgol_sql(source: str, value: str, width: int, order: int = 3) -> str:
    """SQL giving (event, marker, frame, smooth) of gap-free series longer than width that start at frame 0: a table of weights for each place from either end."""
    half = width // 2
    fit, powers = savgol_fit(width, order)
    rows = [f"({k}, {j}, {w!r}::DOUBLE)" for k, line in enumerate((powers @ fit).tolist()) for j, w in enumerate(line)]
    place = f"CASE WHEN frame < {half} THEN frame WHEN frame > hi - {half} THEN {2 * half} - (hi - frame) ELSE {half} END"
    begin = f"CASE WHEN frame < {half} THEN 0 WHEN frame > hi - {half} THEN hi - {2 * half} ELSE frame - {half} END"
    return (
        f"SELECT p.event, p.marker, p.frame, sum(w.w * q.x) AS smooth FROM (SELECT event, marker, frame, {place} AS place, {begin} AS begin FROM (SELECT event, marker, frame, max(frame) OVER (PARTITION BY event, marker) AS hi FROM {source})) p "
        f"JOIN (VALUES {', '.join(rows)}) w(place, k, w) ON w.place = p.place JOIN (SELECT event, marker, frame, {value} AS x FROM {source}) q ON q.event = p.event AND q.marker = p.marker AND q.frame = p.begin + w.k GROUP BY ALL"
    )


@BOOK.add("d24_savgol_smooth", f"WITH {POSE} SELECT event, marker, frame, round(smooth, 6) AS smooth FROM ({savgol_sql('pose', 'y', 7)})")
def _d24(spark, sf):
    return savgol_smooth(pose(spark, sf), KEYS, "frame", "y", 7, chunk=32).withColumn("smooth", F.round("smooth", 6))


@BOOK.add(
    "d20_trim_tail",
    f"WITH {POSE}, e AS (SELECT event, marker, least(max(frame) + 1 - 3, max(frame) FILTER (ncams >= 1)) AS e FROM pose GROUP BY 1, 2), r AS (SELECT p.event, p.marker, frame, e, avg((error <= 40)::INT) OVER (PARTITION BY p.event, p.marker ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM pose p JOIN e ON e.event = p.event AND e.marker = p.marker WHERE frame < e), "
    f"sm AS ({savgol_sql('r', 'share', 7)}), b AS (SELECT sm.event, sm.marker, max(smooth) AS best FROM sm JOIN e USING (event, marker) WHERE frame >= 4 AND frame < e - 4 GROUP BY 1, 2), c AS (SELECT event, marker, min(frame) AS cut FROM sm JOIN b USING (event, marker) WHERE smooth < 0.45 AND smooth < 0.45 * best GROUP BY 1, 2), "
    "m AS (SELECT event, marker, min(frame) AS f FROM pose WHERE x > 95 GROUP BY 1, 2) "
    "SELECT p.event, p.marker, p.frame, (cut IS NULL OR p.frame < cut) AND (f IS NULL OR p.frame NOT BETWEEN f AND f + 2) AS kept FROM pose p LEFT JOIN c ON c.event = p.event AND c.marker = p.marker LEFT JOIN m ON m.event = p.event AND m.marker = p.marker",
)
def _d20(spark, sf):
    rows = pose(spark, sf)
    manual = rows.where("x > 95").groupBy(*KEYS).agg(F.min("frame").alias("first")).withColumn("last", F.col("first") + 2)
    return trim_tail(rows, KEYS, "frame", F.col("error") <= 40, F.col("ncams") >= 1, 0.45, 3, 7, 4, manual, 64).select(*KEYS, "frame", "kept")


def reach_segments(df: DataFrame, keys: list[str], frame: str, value: str, velocity: str, level: float, fast: float, height: float, chunk: int = 1 << 16, open_ends: bool = False) -> DataFrame:
    """(keys, start, stop, peaks): start is the last speed rise at or before a value rise, stop the first speed fall at or after the value's next fall; kept if a value peak lies in [start, stop).

    open_ends: a key that begins above level has a rise at its first frame, one that
    ends above it a fall behind its last; where there is no speed rise before or fall
    after, the reach's own ends count.
    """
    v = threshold_crossings(df, keys, frame, F.col(value) > level, chunk).select(*keys, frame, F.col("way").alias("v_way"), F.lit(None).cast("int").alias("s_way"))
    s = threshold_crossings(df.where(F.col(velocity).isNotNull()), keys, frame, F.col(velocity) > fast, chunk).select(*keys, frame, F.lit(None).cast("int").alias("v_way"), F.col("way").alias("s_way"))
    v = v.withColumn("_o", F.when(F.col("v_way") == 1, 1).otherwise(0))
    if open_ends:
        ends = df.groupBy(*keys).agg(F.min_by(F.struct(frame, value), frame).alias("_a"), F.max_by(F.struct(frame, value), frame).alias("_b"))
        made = lambda end, at, way, o: ends.where(F.col(f"{end}.{value}") > level).select(*keys, at.alias(frame), F.lit(way).alias("v_way"), F.lit(None).cast("int").alias("s_way"), F.lit(o).alias("_o"))
        v = v.unionByName(made("_a", F.col(f"_a.{frame}"), 1, -1)).unionByName(made("_b", F.col(f"_b.{frame}") + 1, -1, 0))
    both = v.unionByName(s.withColumn("_o", F.when(F.col("s_way") == 1, 0).otherwise(1)))
    way = lambda c, w: F.when(F.col(c) == w, F.col(frame))
    seen = carried(both, keys, frame, chunk, ["_o"], before={"_rise": way("s_way", 1)}, after={"_fall": way("s_way", -1)}).where("v_way is not null")
    seen = carried(seen, keys, frame, chunk, ["_o"], after={"_down": F.when(F.col("v_way") == -1, F.struct(F.col(frame).alias("f"), F.col("_fall").alias("s")))})
    start, stop = F.col("_rise"), F.col("_down.s")
    if open_ends:
        start, stop = F.coalesce(start, F.col(frame)), F.coalesce(stop, F.col("_down.f"))
    reaches = seen.where("v_way = 1").select(*keys, start.alias("start"), stop.alias("stop")).where("start is not null and stop is not null").distinct()
    tops = peaks.local_maxima(df, keys, frame, value, height, chunk).select(*keys, F.col(frame).alias("_p"))
    held = band_join(tops, reaches.withColumn("_last", F.col("stop") - 1).where("_last >= start"), keys, "_p", "start", "_last", 256)
    return held.groupBy(*keys, "start", "stop").agg(F.array_sort(F.collect_set("_p")).alias("peaks"))


def moving(spark, sf) -> DataFrame:
    rows = derivatives(pose(spark, sf), KEYS, "frame", ["y", "z"], 1.0)
    return rows.withColumn("s", speed(F.col("v_y"), F.col("v_z")))


_CROSSED = (
    f"{POSE}, vel AS (SELECT *, (lead(y) OVER w - y) AS vy, (lead(z) OVER w - z) AS vz FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), mov AS (SELECT event, marker, frame, y, sqrt(vy * vy + vz * vz) AS s FROM vel), "
    "vc AS (SELECT event, marker, frame, (lead(y > 60) OVER w)::INT - (y > 60)::INT AS way FROM mov WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), sc AS (SELECT event, marker, frame, (lead(s > 15) OVER w)::INT - (s > 15)::INT AS way FROM mov WHERE s IS NOT NULL WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "grp AS (SELECT event, marker, min(frame) AS f, max(frame) AS l, any_value(y) AS y FROM (SELECT *, sum(new) OVER (PARTITION BY event, marker ORDER BY frame) AS g FROM (SELECT *, CASE WHEN y = lag(y) OVER (PARTITION BY event, marker ORDER BY frame) THEN 0 ELSE 1 END AS new FROM mov)) GROUP BY event, marker, g), "
    "tops AS (SELECT event, marker, (f + l) // 2 AS p FROM (SELECT *, lag(y) OVER w AS a, lead(y) OVER w AS b FROM grp WINDOW w AS (PARTITION BY event, marker ORDER BY f)) WHERE y > a AND y > b AND y >= 70)"
)
_HELD = "SELECT r.event, r.marker, start, stop, list_sort(list(DISTINCT p)) AS peaks FROM (SELECT DISTINCT event, marker, start, stop FROM r WHERE start IS NOT NULL AND stop IS NOT NULL) r JOIN tops t ON t.event = r.event AND t.marker = r.marker AND p >= start AND p < stop GROUP BY ALL"


@BOOK.add(
    "d28_reach_segments",
    f"WITH {_CROSSED}, d AS (SELECT event, marker, frame, (SELECT min(b.frame) FROM vc b WHERE b.event = a.event AND b.marker = a.marker AND b.way = -1 AND b.frame > a.frame) AS down FROM vc a WHERE way = 1), "
    "r AS (SELECT event, marker, (SELECT max(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = 1 AND sc.frame <= d.frame) AS start, (SELECT min(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = -1 AND sc.frame >= d.down) AS stop FROM d) "
    + _HELD,
)
def _d28(spark, sf):
    return reach_segments(moving(spark, sf), KEYS, "frame", "y", "s", 60, 15, 70, chunk=64)


@BOOK.add(
    "d28b_reach_open_ends",
    f"WITH {_CROSSED}, e AS (SELECT event, marker, min(frame) AS lo, max(frame) AS hi, arg_min(y, frame) > 60 AS a, arg_max(y, frame) > 60 AS b FROM mov GROUP BY 1, 2), "
    "w AS (SELECT event, marker, frame, way FROM vc WHERE way <> 0 UNION ALL SELECT event, marker, lo, 1 FROM e WHERE a UNION ALL SELECT event, marker, hi + 1, -1 FROM e WHERE b), "
    "d AS (SELECT event, marker, frame, (SELECT min(b.frame) FROM w b WHERE b.event = a.event AND b.marker = a.marker AND b.way = -1 AND b.frame >= a.frame AND (b.frame > a.frame OR a.frame = (SELECT lo FROM e WHERE e.event = a.event AND e.marker = a.marker))) AS down FROM w a WHERE way = 1), "
    "r AS (SELECT event, marker, coalesce((SELECT max(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = 1 AND sc.frame <= d.frame), frame) AS start, coalesce((SELECT min(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = -1 AND sc.frame >= d.down), down) AS stop FROM d WHERE down IS NOT NULL) "
    + _HELD,
)
def _d28b(spark, sf):
    return reach_segments(moving(spark, sf), KEYS, "frame", "y", "s", 60, 15, 70, chunk=64, open_ends=True)


def clip_reaches(reaches: DataFrame, ranges: DataFrame, tops: DataFrame, keys: list[str], frame: str, chunk: int = 1 << 12) -> DataFrame:
    """(keys, start, stop, peaks): reaches (keys, start, stop) that touch a range given by hand, clipped to it, with the peaks (tops: keys, frame) in [start, stop) of what is left; reaches without a peak go."""
    touched = ranges.select(*keys, F.col("start").alias("_lo"), F.col("stop").alias("_hi"))
    both = reaches.select(*keys, "start", "stop").join(touched, keys).where("start <= _hi and stop >= _lo")
    cut = both.select(*keys, F.greatest("start", "_lo").alias("start"), F.least("stop", "_hi").alias("stop")).distinct()
    held = band_join(tops.select(*keys, F.col(frame).alias("_p")), cut.withColumn("_end", F.col("stop") - 1).where("_end >= start"), keys, "_p", "start", "_end", chunk)
    return held.groupBy(*keys, "start", "stop").agg(F.array_sort(F.collect_set("_p")).alias("peaks"))


@BOOK.add(
    "d32b_clipped_peaks",
    f"WITH {_CROSSED}, d AS (SELECT event, marker, frame, (SELECT min(b.frame) FROM vc b WHERE b.event = a.event AND b.marker = a.marker AND b.way = -1 AND b.frame > a.frame) AS down FROM vc a WHERE way = 1), "
    "r0 AS (SELECT event, marker, (SELECT max(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = 1 AND sc.frame <= d.frame) AS start, (SELECT min(frame) FROM sc WHERE sc.event = d.event AND sc.marker = d.marker AND sc.way = -1 AND sc.frame >= d.down) AS stop FROM d), "
    "h AS (SELECT DISTINCT r.event, r.marker, start, stop FROM r0 r JOIN tops t ON t.event = r.event AND t.marker = r.marker AND p >= start AND p < stop), g AS (SELECT event, marker, min(frame) AS lo, min(frame) + 12 AS hi FROM pose WHERE x > 80 GROUP BY 1, 2), "
    "r AS (SELECT h.event, h.marker, greatest(start, lo) AS start, least(stop, hi) AS stop FROM h JOIN g ON g.event = h.event AND g.marker = h.marker WHERE start <= hi AND stop >= lo) "
    + _HELD,
)
def _d32b(spark, sf):
    rows = moving(spark, sf)
    reaches = reach_segments(rows, KEYS, "frame", "y", "s", 60, 15, 70, chunk=64)
    ranges = rows.where("x > 80").groupBy(*KEYS).agg(F.min("frame").alias("start")).withColumn("stop", F.col("start") + 12)
    return clip_reaches(reaches, ranges, peaks.local_maxima(rows, KEYS, "frame", "y", 70, 64), KEYS, "frame")


def velocity_extrema(df: DataFrame, keys: list[str], frame: str, velocity: str, order: int, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, v): frames whose velocity is above, or below, all others within order frames."""
    spread = df.select(*keys, frame, F.col(velocity).alias("v")).where("v is not null").withColumn("_chunk", F.explode(F.sequence(F.floor((F.col(frame) - order) / chunk), F.floor((F.col(frame) + order) / chunk))))
    w = Window.partitionBy(*keys, "_chunk").orderBy(frame)
    sides = [w.rangeBetween(-order, -1), w.rangeBetween(1, order)]
    over = lambda f: [f("v").over(side) for side in sides]
    tops, lows = over(F.max), over(F.min)
    found = spread.withColumn("_x", (F.col("v") > tops[0]) & (F.col("v") > tops[1]) | (F.col("v") < lows[0]) & (F.col("v") < lows[1]))
    return found.where(F.col("_x") & (F.floor(F.col(frame) / chunk) == F.col("_chunk"))).select(*keys, frame, "v")


def velocity_jumps(df: DataFrame, keys: list[str], frame: str, velocity: str, order: int = 11, near: int = 100, spread: float = 5.0, above: float = 3.5, chunk: int = 1 << 16) -> DataFrame:
    """(keys, first, last): windows about two neighbouring velocity extrema of opposite sign, less than near frames apart, whose acceleration is unusual.

    A window reaches half the extrema's distance beyond both. Its steps of velocity
    are unusual if their sizes deviate `spread` times as much as those of the key's
    other frames, or their mean is above the others' by `above` deviations. The others'
    sums are the key's less the window's, so frames are read once for all windows.
    """
    at = velocity_extrema(df, keys, frame, velocity, order, chunk)
    pairs = carried(at, keys, frame, chunk, lead={"_to": F.col(frame), "_w": F.col("v")}).where((F.col("_to") - F.col(frame) < near) & (F.signum("v") != F.signum("_w")))
    half = F.ceil((F.col("_to") - F.col(frame)) / 2)
    bounds = df.groupBy(*keys).agg(F.min(frame).alias("_lo"), F.max(frame).alias("_hi"))
    windows = pairs.select(*keys, (F.col(frame) - half).alias("first"), (F.col("_to") + half - 1).alias("last")).join(bounds, keys)
    windows = windows.select(*keys, F.greatest("first", "_lo").cast("long").alias("first"), F.least("last", "_hi").cast("long").alias("last")).distinct()
    steps = carried(df.select(*keys, frame, F.col(velocity).alias("_v")), keys, frame, chunk, lead={"_n": F.col("_v")})
    steps = steps.select(*keys, F.col(frame).alias("_f"), F.abs(F.col("_n") - F.col("_v")).alias("_a")).where("_a is not null")
    sums = [F.count("_a").alias("_c"), F.sum("_a").alias("_s"), F.sum(F.col("_a") * F.col("_a")).alias("_q")]
    whole = steps.groupBy(*keys).agg(*(x.alias(n) for x, n in zip(sums, ("_count", "_sum", "_squares"), strict=True)))
    held = band_join(steps, windows.withColumn("_end", F.col("last") - 1), keys, "_f", "first", "_end", chunk).groupBy(*keys, "first", "last").agg(*sums).join(whole, keys)
    mean, sd = lambda c, s: s / F.when(c > 0, c), lambda c, s, q: F.sqrt(F.greatest(F.lit(0.0), q / F.when(c > 0, c) - (s / F.when(c > 0, c)) ** 2))
    inner = (F.col("_c"), F.col("_s"), F.col("_q"))
    outer = (F.col("_count") - F.col("_c"), F.col("_sum") - F.col("_s"), F.col("_squares") - F.col("_q"))
    unusual = (sd(*inner) > spread * sd(*outer)) | (mean(*inner[:2]) > mean(*outer[:2]) + above * sd(*outer))
    return held.where(unusual).select(*keys, "first", "last")


def velocity_jump_filter(df: DataFrame, keys: list[str], frame: str, value: str, velocity: str, longest: int = 200, chunk: int = 1 << 16, **limits) -> DataFrame:
    """(keys, frame, filtered): within velocity_jumps value follows the straight line between the window's ends, in windows of longest frames or more it is NULL; of several windows the last counts, of those that begin together the shortest."""
    found = velocity_jumps(df, keys, frame, velocity, chunk=chunk, **limits)
    lined = on_lines(df.select(*keys, frame, value), found, keys, frame, [value], "first")
    long_ = found.where(F.col("last") - F.col("first") + 1 >= longest).select(*keys, F.explode(F.sequence("first", "last")).alias(frame), F.lit(True).alias("_long")).distinct()
    return lined.join(long_, [*keys, frame], "left").select(*keys, frame, F.when(F.col("_long"), None).otherwise(F.coalesce(f"line_{value}", value)).alias("filtered"))


@BOOK.add(
    "d34_velocity_jump_filter",
    f"WITH {POSE}, v AS (SELECT event, marker, frame, y, lead(y) OVER (PARTITION BY event, marker ORDER BY frame) - y AS v FROM pose), "
    "x AS (SELECT *, max(v) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS a, max(v) OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS b, min(v) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS c, min(v) OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS d FROM v WHERE v IS NOT NULL WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "e AS (SELECT event, marker, frame, v FROM x WHERE (v > a AND v > b) OR (v < c AND v < d)), p AS (SELECT *, lead(frame) OVER w AS t, lead(v) OVER w AS u FROM e WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "g AS (SELECT event, marker, min(frame) AS lo, max(frame) AS hi FROM v GROUP BY 1, 2), "
    "win AS (SELECT DISTINCT p.event, p.marker, greatest(lo, frame - ceil((t - frame) / 2)::BIGINT) AS first, least(hi, t + ceil((t - frame) / 2)::BIGINT - 1) AS last FROM p JOIN g ON g.event = p.event AND g.marker = p.marker WHERE t - frame < 8 AND sign(v) <> sign(u)), "
    "st AS (SELECT event, marker, frame, abs(lead(v) OVER (PARTITION BY event, marker ORDER BY frame) - v) AS a FROM v), "
    "j AS (SELECT win.event, win.marker, first, last, avg(a) FILTER (frame BETWEEN first AND last - 1) AS im, stddev_pop(a) FILTER (frame BETWEEN first AND last - 1) AS isd, avg(a) FILTER (frame NOT BETWEEN first AND last - 1) AS om, stddev_pop(a) FILTER (frame NOT BETWEEN first AND last - 1) AS osd FROM win JOIN st ON st.event = win.event AND st.marker = win.marker GROUP BY ALL), "
    "bad AS (SELECT * FROM j WHERE isd > 1.9 * osd OR im > om + 0.8 * osd), "
    "l AS (SELECT f.event, f.marker, f.frame, max(b.last - b.first + 1) AS size, arg_max(s.y + (t.y - s.y) * CASE WHEN b.last > b.first THEN (f.frame - b.first) / (b.last - b.first) ELSE 0 END, b.first) AS line FROM v f JOIN bad b ON b.event = f.event AND b.marker = f.marker AND f.frame BETWEEN b.first AND b.last JOIN v s ON s.event = b.event AND s.marker = b.marker AND s.frame = b.first JOIN v t ON t.event = b.event AND t.marker = b.marker AND t.frame = b.last GROUP BY ALL) "
    "SELECT v.event, v.marker, v.frame, CASE WHEN size >= 9 THEN NULL ELSE round(coalesce(line, y), 6) END AS filtered FROM v LEFT JOIN l ON l.event = v.event AND l.marker = v.marker AND l.frame = v.frame",
)
def _d34(spark, sf):
    rows = derivatives(pose(spark, sf), KEYS, "frame", ["y"], 1.0, 64)
    return velocity_jump_filter(rows, KEYS, "frame", "y", "v_y", 9, 64, order=2, near=8, spread=1.9, above=0.8).withColumn("filtered", F.round("filtered", 6))


def edge_jump_trim(df: DataFrame, keys: list[str], frame: str, value: str, reach: int, factor: float, chunk: int = 1 << 16) -> DataFrame:
    """df with `trimmed`: rows up to reach frames from a gap's edge whose step exceeds factor times the key's median step are NULL."""
    hole = F.when(F.col(value).isNull(), F.col(frame))
    rows = carried(df, keys, frame, chunk, lag={"_p": F.col(value)}, before={"_b": hole}, after={"_a": hole}).withColumn("_d", F.abs(F.col(value) - F.col("_p")))
    mid = rows.groupBy(*keys).agg(F.percentile("_d", F.lit(0.5)).alias("_m"))
    near = F.least(F.col(frame) - F.col("_b"), F.col("_a") - F.col(frame))
    return rows.join(mid, keys).withColumn("trimmed", F.when((near <= reach) & (F.col("_d") > factor * F.col("_m")), None).otherwise(F.col(value))).select(*df.columns, "trimmed")


@BOOK.add(
    "d35_edge_jump_trim",
    f"WITH {POSE}, q AS (SELECT event, marker, frame, CASE WHEN error <= 40 THEN y END AS y FROM pose), s AS (SELECT *, abs(y - lag(y) OVER w) AS d, least(frame - last_value(CASE WHEN y IS NULL THEN frame END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), first_value(CASE WHEN y IS NULL THEN frame END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - frame) AS n FROM q WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "m AS (SELECT *, quantile_cont(d, 0.5) OVER (PARTITION BY event, marker) AS m FROM s) SELECT event, marker, frame, CASE WHEN n <= 2 AND d > 1.7 * m THEN NULL ELSE y END AS trimmed FROM m",
)
def _d35(spark, sf):
    return edge_jump_trim(checked(spark, sf).select(*KEYS, "frame", "y"), KEYS, "frame", "y", 2, 1.7).select(*KEYS, "frame", "trimmed")


def fill_gaps(df: DataFrame, keys: list[str], frame: str, value: str, longest: int, chunk: int = 1 << 16) -> DataFrame:
    """df with `filled`: NULL runs between two values less than `longest` frames apart on the straight line between them, longer ones NULL."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(frame).alias("f"), F.col(value).alias("x")))
    rows = carried(df, keys, frame, chunk, before={"_b": known}, after={"_a": known})
    apart = F.col("_a.f") - F.col("_b.f")
    line = F.col("_b.x") + (F.col("_a.x") - F.col("_b.x")) * (F.col(frame) - F.col("_b.f")) / F.when(apart > 0, apart)
    return rows.withColumn("filled", F.coalesce(F.col(value), F.when(apart < longest, line))).drop("_a", "_b")


def brief_jump_filter(df: DataFrame, keys: list[str], frame: str, value: str, least: float, factor: float, reach: int = 3, near: int = 3, chunk: int = 1 << 16) -> DataFrame:
    """df with `calm`: NULL where the step to the next row exceeds least and factor times the median of the steps around, and, where two such frames are at most near apart, between them and as far again behind the second."""
    steps = carried(df, keys, frame, chunk, lead={"_n": F.col(value)}).withColumn("_d", F.abs(F.col("_n") - F.col(value)))
    spread = steps.withColumn("_chunk", F.explode(F.sequence(F.floor((F.col(frame) - reach) / chunk), F.floor((F.col(frame) + reach) / chunk))))
    w = Window.partitionBy(*keys, "_chunk").orderBy(frame).rowsBetween(-reach, reach)
    rows = spread.withColumn("_mid", F.percentile("_d", F.lit(0.5)).over(w)).where(F.floor(F.col(frame) / chunk) == F.col("_chunk")).drop("_chunk")
    jump = rows.withColumn("_jump", F.coalesce((F.col("_d") > least) & (F.col("_d") > factor * F.col("_mid")), F.lit(False)))
    at = carried(jump.where("_jump").select(*keys, frame), keys, frame, chunk, lead={"_to": F.col(frame)})
    pairs = at.where(F.col("_to") - F.col(frame) <= near).select(*keys, F.explode(F.sequence(F.col(frame), 2 * F.col("_to") - F.col(frame) - 1)).alias(frame)).distinct()
    gone = jump.join(pairs.withColumn("_more", F.lit(True)), [*keys, frame], "left")
    return gone.withColumn("calm", F.when(F.col("_jump") | F.col("_more").isNotNull(), None).otherwise(F.col(value))).select(*df.columns, "calm")


_BRIEF = (
    f"{POSE}, s AS (SELECT *, abs(lead(y) OVER (PARTITION BY event, marker ORDER BY frame) - y) AS d FROM pose), m AS (SELECT *, quantile_cont(d, 0.5) OVER (PARTITION BY event, marker ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM s), j AS (SELECT event, marker, frame FROM m WHERE d > 0.75 AND d > 2.6 * m), "
    "n AS (SELECT event, marker, frame, lead(frame) OVER (PARTITION BY event, marker ORDER BY frame) AS t FROM j), x AS (SELECT event, marker, frame FROM j UNION SELECT event, marker, unnest(range(frame, 2 * t - frame)) FROM n WHERE t - frame <= 3), "
    "c AS (SELECT p.event, p.marker, p.frame, CASE WHEN x.frame IS NULL THEN y END AS calm FROM pose p LEFT JOIN x ON x.event = p.event AND x.marker = p.marker AND x.frame = p.frame)"
)
_GAP = (
    "k AS (SELECT *, last_value(CASE WHEN calm IS NOT NULL THEN frame END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS bf, last_value(calm IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS bx, first_value(CASE WHEN calm IS NOT NULL THEN frame END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS af, "
    "first_value(calm IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ax FROM c WINDOW w AS (PARTITION BY event, marker ORDER BY frame))"
)


@BOOK.add("d36_brief_jump_filter", f"WITH {_BRIEF} SELECT * FROM c")
def _d36(spark, sf):
    return brief_jump_filter(pose(spark, sf), KEYS, "frame", "y", 0.75, 2.6, chunk=64).select(*KEYS, "frame", "calm")


@BOOK.add("d36b_gaps_filled", f"WITH {_BRIEF}, {_GAP} SELECT event, marker, frame, round(coalesce(calm, CASE WHEN af - bf < 4 THEN bx + (ax - bx) * (frame - bf) / (af - bf) END), 5) AS filled FROM k")
def _d36b(spark, sf):
    calm = brief_jump_filter(pose(spark, sf), KEYS, "frame", "y", 0.75, 2.6, chunk=64).select(*KEYS, "frame", "calm")
    return fill_gaps(calm, KEYS, "frame", "calm", 4, 64).select(*KEYS, "frame", F.round("filled", 5).alias("filled"))


@BOOK.add(
    "d35b_trimmed_filled",
    f"WITH {POSE}, q AS (SELECT event, marker, frame, CASE WHEN error <= 40 THEN y END AS y FROM pose), s AS (SELECT *, abs(y - lag(y) OVER w) AS d, least(frame - last_value(CASE WHEN y IS NULL THEN frame END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), first_value(CASE WHEN y IS NULL THEN frame END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - frame) AS n FROM q WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    f"m AS (SELECT *, quantile_cont(d, 0.5) OVER (PARTITION BY event, marker) AS m FROM s), c AS (SELECT event, marker, frame, CASE WHEN n <= 2 AND d > 1.7 * m THEN NULL ELSE y END AS calm FROM m), {_GAP} SELECT event, marker, frame, round(coalesce(calm, CASE WHEN af - bf < 5 THEN bx + (ax - bx) * (frame - bf) / (af - bf) END), 5) AS filled FROM k",
)
def _d35b(spark, sf):
    trimmed = edge_jump_trim(checked(spark, sf).select(*KEYS, "frame", "y"), KEYS, "frame", "y", 2, 1.7, 64).select(*KEYS, "frame", "trimmed")
    return fill_gaps(trimmed, KEYS, "frame", "trimmed", 5, 64).select(*KEYS, "frame", F.round("filled", 5).alias("filled"))


def prob_edge_trim(df: DataFrame, keys: list[str], frame: str, score: str, least: float = 0.9, jump: float = 0.03, short: int = 50, width: int = 5, smooth: int = 51, order: int = 5, chunk: int = 1 << 16) -> DataFrame:
    """(keys, first, last): where a key's trajectory is to begin and end, NULL where it isn't trimmed; keys that aren't have no row.

    Steps of the score are smoothed by a local cubic over `smooth` frames. At one above
    jump that is the highest within order frames, with fewer than short scores of at
    least `least` before it, the trajectory begins at the next frame whose mean score
    over width frames from it on is at least `least`. At one below -jump, the lowest
    around, with fewer than short such scores from it on, it ends at the last frame
    before whose mean over the width frames before it and itself is. frame counts from 0.
    """
    rows = carried(df.select(*keys, frame, F.col(score).alias("_s")), keys, frame, chunk, lead={"_n": F.col("_s")}, total={"_good": (F.col("_s") >= least).cast("long")})
    steps = rows.where("_n is not null").select(*keys, frame, (F.col("_n") - F.col("_s")).alias("_d"))
    even = savgol_smooth(steps, keys, frame, "_d", smooth, chunk=chunk).withColumn("smooth", F.round("smooth", 9))
    at = velocity_extrema(even, keys, frame, "smooth", order, chunk).where(F.abs("v") > jump)
    spread = rows.withColumn("_chunk", F.explode(F.sequence(F.floor((F.col(frame) - width) / chunk), F.floor((F.col(frame) + width) / chunk))))
    w = Window.partitionBy(*keys, "_chunk").orderBy(frame)
    means = spread.withColumn("_on", F.avg("_s").over(w.rowsBetween(0, width - 1))).withColumn("_off", F.avg("_s").over(w.rowsBetween(-width, 0))).where(F.floor(F.col(frame) / chunk) == F.col("_chunk")).drop("_chunk")
    pick = lambda c: F.when(F.round(c, 9) >= least, F.col(frame))
    near = carried(means, keys, frame, chunk, before={"_last": pick("_off")}, after={"_first": pick("_on")}).withColumn("_self", pick("_off"))
    near = carried(near, keys, frame, chunk, lag={"_earlier": F.col("_last")})
    whole = rows.groupBy(*keys).agg(F.max("_good").alias("_all"))
    told = near.join(at, [*keys, frame]).join(whole, keys)
    good_before = F.col("_good") - (F.col("_s") >= least).cast("long")
    begin = F.max(F.when((F.col("v") > 0) & (good_before < short), F.col("_first")))
    end = F.min(F.when((F.col("v") < 0) & (F.col("_all") - good_before < short), F.col("_earlier")))
    return told.groupBy(*keys).agg(begin.alias("first"), end.alias("last")).where("first is not null or last is not null")


@BOOK.add(
    "d37_prob_edge_trim",
    f"WITH {POSE}, d AS (SELECT event, marker, frame, lead(score) OVER w - score AS d FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), dd AS (SELECT * FROM d WHERE d IS NOT NULL), sm AS (SELECT event, marker, frame, round(smooth, 9) AS smooth FROM ({savgol_sql('dd', 'd', 7)})), "
    "x AS (SELECT *, max(smooth) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS a, max(smooth) OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS b, min(smooth) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS c, min(smooth) OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS e FROM sm WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "ext AS (SELECT event, marker, frame, smooth AS v FROM x WHERE abs(smooth) > 0.03 AND ((smooth > a AND smooth > b) OR (smooth < c AND smooth < e))), "
    "m AS (SELECT event, marker, frame, score, round(avg(score) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), 9) AS f, round(avg(score) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 9) AS g, coalesce(sum((score >= 0.6)::INT) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum((score >= 0.6)::INT) OVER (PARTITION BY event, marker) AS total FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame)), "
    "r AS (SELECT ext.event, ext.marker, (SELECT min(n.frame) FROM m n WHERE n.event = ext.event AND n.marker = ext.marker AND n.f >= 0.6 AND n.frame >= ext.frame AND v > 0 AND m.before < 12) AS first, (SELECT max(n.frame) FROM m n WHERE n.event = ext.event AND n.marker = ext.marker AND n.g >= 0.6 AND n.frame < ext.frame AND v < 0 AND m.total - m.before < 12) AS last FROM ext JOIN m ON m.event = ext.event AND m.marker = ext.marker AND m.frame = ext.frame) "
    "SELECT event, marker, max(first) AS first, min(last) AS last FROM r GROUP BY 1, 2 HAVING max(first) IS NOT NULL OR min(last) IS NOT NULL",
)
def _d37(spark, sf):
    return prob_edge_trim(pose(spark, sf), KEYS, "frame", "score", 0.6, 0.03, 12, 5, 7, 2, 64)


def outlier_frames(df: DataFrame, keys: list[str], frame: str, axes: list[str], jump: float, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, distance) of rows further than jump from the row before."""
    near = carried(df.select(*keys, frame, *axes), keys, frame, chunk, lag={f"_p_{a}": F.col(a) for a in axes})
    d = F.sqrt(sum(((F.col(a) - F.col(f"_p_{a}")) ** 2 for a in axes), F.lit(0.0)))
    return near.select(*keys, frame, d.alias("distance")).where(F.col("distance") > jump)


@BOOK.add("d38_outlier_frames", f"WITH {POSE}, d AS (SELECT event, marker, frame, sqrt(pow(y - lag(y) OVER w, 2) + pow(z - lag(z) OVER w, 2)) AS d FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame)) SELECT event, marker, frame, round(d, 5) AS distance FROM d WHERE d > 50.003")
def _d38(spark, sf):
    return outlier_frames(pose(spark, sf), KEYS, "frame", ["y", "z"], 50.003).withColumn("distance", F.round("distance", 5))


def pad_short_event(df: DataFrame, event: str, cam: str, number: str, time: str) -> DataFrame:
    """(event, cam, number, time) of frames to append where a camera has fewer frames than the mean (rounded down) of the others: numbers go on, time by whole mean steps."""
    stats = df.groupBy(event, cam).agg(F.count("*").alias("n"), F.max(number).alias("_l"), F.max(time).alias("_t"), F.min(time).alias("_t0"))
    w = Window.partitionBy(event)
    others = F.floor((F.sum("n").over(w) - F.col("n")) / (F.count("*").over(w) - 1))
    lack = stats.withColumn("_need", others - F.col("n")).withColumn("_step", F.expr("(_t - _t0) div greatest(n - 1, 1)")).where("_need > 0")
    rows = lack.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_need"))))
    return rows.select(event, cam, (F.col("_l") + F.col("_k")).alias(number), (F.col("_t") + F.col("_k") * F.col("_step")).alias(time))


@BOOK.add(
    "d39_pad_short_event",
    f"WITH {FRAMES}, s AS (SELECT event, cam, count(*) AS n, max(frame_no) AS l, max(t) AS t, (max(t) - min(t)) // greatest(count(*) - 1, 1) AS step FROM frames GROUP BY 1, 2), o AS (SELECT *, floor((sum(n) OVER (PARTITION BY event) - n) / (count(*) OVER (PARTITION BY event) - 1))::BIGINT - n AS need FROM s), k AS (SELECT *, unnest(range(1, need + 1)) AS k FROM o WHERE need > 0) SELECT event, cam, l + k AS frame_no, t + k * step AS t FROM k",
)
def _d39(spark, sf):
    return pad_short_event(frames(spark, sf), "event", "cam", "frame_no", "t")


