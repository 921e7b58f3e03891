"""Peaks of long series, chunk by chunk: maxima, thinning by distance, and prominence from summaries that neighbouring chunks join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from longtrace.functions.carry import carried
from longtrace.functions.islands import islands
from longtrace.session import written

#: Rounds of thinning over all peaks; what is then left is thinned run by run.
ROUNDS = 8


def local_maxima(df: DataFrame, keys: list[str], frame: str, value: str, height: float, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, value) of maxima of at least height: the middle of a run of equal values above both its neighbours.

    frame counts rows without gaps. The ends of a key and rows beside a missing value
    are no maxima. A run of equal values may be of any length.
    """
    x = F.col(value)
    rows = df.select(*keys, frame, F.when(~F.isnan(x.cast("double")), x.cast("double")).alias(value))
    near = carried(rows, keys, frame, chunk, lag={"_p": x, "_has_p": F.lit(True)}, lead={"_n": x, "_has_n": F.lit(True)})
    begins, ends = F.col("_has_p").isNull() | ~x.eqNullSafe(F.col("_p")), F.col("_has_n").isNull() | ~x.eqNullSafe(F.col("_n"))
    edge = lambda at, other: F.when(at, F.struct(F.col(frame).alias("f"), F.col(other).alias("x")))
    runs = carried(near, keys, frame, chunk, before={"_from": edge(begins, "_p")}, after={"_to": edge(ends, "_n")})
    middle = F.col(frame) == F.floor((F.col("_from.f") + F.col("_to.f")) / 2)
    return runs.where((x > F.col("_from.x")) & (x > F.col("_to.x")) & middle & (x >= height)).select(*keys, frame, value)


def thinned(peaks: DataFrame, keys: list[str], frame: str, value: str, distance: int, chunk: int = 1 << 16, rounds: int = ROUNDS) -> DataFrame:
    """peaks without those nearer than distance to a higher one that stays (of equal ones the first).

    In each round a peak that is the highest of those undecided around it stays, and
    those around it go: windows over chunks with rims. That decides nearly all in a few
    rounds; the rest, where peaks rise one after the other in steps below distance,
    falls into runs of such peaks, which are walked one by one.
    """
    if distance <= 1:
        return peaks
    d, chunk = distance - 1, max(chunk, 4 * distance)
    open_, kept = peaks.select(*keys, frame, value), None
    for _ in range(rounds):
        spread = open_.withColumn("_chunk", F.explode(F.sequence(F.floor((F.col(frame) - 2 * d) / chunk), F.floor((F.col(frame) + 2 * d) / chunk))))
        w = Window.partitionBy(*keys, "_chunk").orderBy(frame).rangeBetween(-d, d)
        best = spread.withColumn("_best", F.max(F.struct(F.col(value).alias("x"), (-F.col(frame)).alias("f"))).over(w)["f"] == -F.col(frame))
        near = best.withColumn("_near", F.max("_best").over(w)).where(F.floor(F.col(frame) / chunk) == F.col("_chunk"))
        done = written(near.select(*keys, frame, value, "_best", "_near"), "thinned")
        stay = done.where("_best").select(*keys, frame, value)
        kept = stay if kept is None else kept.unionByName(stay)
        open_ = done.where("not _near").select(*keys, frame, value)
        if open_.isEmpty():
            return kept
    groups = islands(open_, keys, frame, d, chunk)
    inner = groups.select(*keys, F.col("first").alias("_first"), F.explode(F.sequence(F.floor(F.col("first") / chunk), F.floor(F.col("last") / chunk))).alias("_chunk"), F.col("last").alias("_last"))
    placed = open_.withColumn("_chunk", F.floor(F.col(frame) / chunk)).join(inner, [*keys, "_chunk"]).where(F.col(frame).between(F.col("_first"), F.col("_last")))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        at, x = pdf[frame].to_numpy(), pdf[value].to_numpy()
        gone, stay = np.zeros(len(at), bool), []
        for k in np.lexsort((at, -x)).tolist():
            if not gone[k]:
                stay.append(k)
                gone |= np.abs(at - at[k]) < distance
        return pdf.iloc[stay][[*keys, frame, value]]

    return kept.unionByName(placed.groupBy(*keys, "_first").applyInPandas(walk, open_.schema))


def _lows(x: np.ndarray) -> np.ndarray:
    """For each place the least value back to the nearest higher one, or the start."""
    stack, out = [], np.empty(len(x))
    for i, v in enumerate(x.tolist()):
        low = v
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        stack.append((v, low))
        out[i] = low
    return out


def _stairs(x: np.ndarray) -> list[dict]:
    """Seen from the end of x: each value above all behind it, and the least of those behind it."""
    back = x[::-1]
    top = np.concatenate([[-np.inf], np.maximum.accumulate(back)[:-1]])
    low = np.concatenate([[np.inf], np.minimum.accumulate(back)[:-1]])
    return [{"x": float(v), "low": float(m)} for v, m in zip(back[back > top], low[back > top], strict=True)]


_OPEN = "array<struct<frame:long,x:double>>"
_STAIRS = "array<struct<x:double,low:double>>"


def prominences(df: DataFrame, peaks: DataFrame, keys: list[str], frame: str, value: str, chunk: int = 1 << 16) -> DataFrame:
    """peaks (keys, frame, value) with `rise`: how far each stands above the higher of the lows on its two sides, a side ending at the nearest higher value or the end of the key.

    A chunk finds the lows of its own rows, and keeps for others: its largest and
    least value, and the stairs of values above all up to its end. The chunks of a key
    are walked in order with a stack of falling maxima, which tells each side that is
    still open the chunk where it ends and the least value up to there; that chunk's
    stairs, joined by chunk, have the rest. A task holds one chunk at a time. Missing
    values end a side as a higher value does.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    named = ", ".join(f"{k} {kinds[k]}" for k in keys)
    marked = df.select(*keys, frame, F.col(value).cast("double").alias("_x")).join(peaks.select(*keys, frame, F.lit(True).alias("_peak")), [*keys, frame], "left")
    marked = marked.withColumn("_chunk", F.floor(F.col(frame) / chunk))

    def summed(key: tuple, n: np.ndarray, x: np.ndarray, peak: np.ndarray) -> list[tuple]:
        x = np.where(np.isnan(x), np.inf, x)
        at = np.flatnonzero(peak)
        left, right = _lows(x), _lows(x[::-1])[::-1]
        open_left, open_right = np.maximum.accumulate(x) <= x, np.maximum.accumulate(x[::-1])[::-1] <= x
        listed = lambda flag: [{"frame": int(n[p]), "x": float(x[p])} for p in at if flag[p]]
        rows = [(*key, int(n[p]), x[p], left[p], right[p], None, None, None, None, None, None) for p in at]
        rows.append((*key, None, None, None, None, x.max(), x.min(), listed(open_left), listed(open_right), _stairs(x), _stairs(x[::-1])))
        return rows

    columns = [*keys, "_chunk", "frame", "x", "low_left", "low_right", "top", "bottom", "open_left", "open_right", "stairs_end", "stairs_start"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order, chunk by chunk; the last chunk of a batch waits for the next."""

        def told(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            n, x, peak = pdf[frame].to_numpy(), pdf["_x"].to_numpy(float), pdf["_peak"].notna().to_numpy()
            names = list(zip(*(pdf[k].iloc[starts[:-1]].tolist() for k in [*keys, "_chunk"]), strict=True))
            return pd.DataFrame([r for name, a, b in zip(names, starts[:-1], starts[1:], strict=True) for r in summed(name, n[a:b], x[a:b], peak[a:b])], columns=columns)

        held = []
        for pdf in batches:
            if not len(pdf):
                continue
            if held and pdf[[*keys, "_chunk"]].iloc[-1].tolist() == held[0][[*keys, "_chunk"]].iloc[0].tolist():
                held.append(pdf)
                continue
            pdf = pd.concat([*held, pdf]) if held else pdf
            named = pdf[[*keys, "_chunk"]]
            starts = np.flatnonzero((named != named.shift()).any(axis=1).to_numpy())
            if len(starts) > 1:
                yield told(pdf, starts)
            held = [pdf.iloc[starts[-1] :]]
        if held:
            pdf = pd.concat(held)
            yield told(pdf, np.array([0, len(pdf)]))

    schema = f"{named}, _chunk long, frame long, x double, low_left double, low_right double, top double, bottom double, open_left {_OPEN}, open_right {_OPEN}, stairs_end {_STAIRS}, stairs_start {_STAIRS}"
    ordered = marked.select(*keys, "_chunk", frame, "_x", "_peak").repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", frame)
    parts = written(ordered.mapInPandas(each, schema), "peaks")
    chunks = parts.where("frame is null")

    def far(side: str) -> DataFrame:
        out = to_arrow_schema(StructType.fromDDL(f"{named}, frame long, x double, low double, at long"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, stack = None, []
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    if key != (key := [row[k] for k in keys]):
                        stack = []
                    for q in row["open"]:
                        low, at = np.inf, None
                        for top, bottom, number in reversed(stack):
                            if top > q["x"]:
                                at = number
                                break
                            low = min(low, bottom)
                        found.append({**{k: row[k] for k in keys}, "frame": q["frame"], "x": q["x"], "low": low, "at": at})
                    bottom = row["bottom"]
                    while stack and stack[-1][0] <= row["top"]:
                        bottom = min(bottom, stack.pop()[1])
                    stack.append((row["top"], bottom, row["_chunk"]))
                yield pa.RecordBatch.from_pylist(found, out)

        order = F.col("_chunk") if side == "left" else F.col("_chunk").desc()
        walked = chunks.select(*keys, "_chunk", "top", "bottom", F.col(f"open_{side}").alias("open")).repartition(*keys).sortWithinPartitions(*keys, order)
        asked = walked.mapInArrow(run, f"{named}, frame long, x double, low double, at long")
        stairs = chunks.select(*keys, F.col("_chunk").alias("at"), F.col("stairs_end" if side == "left" else "stairs_start").alias("_s"))
        step = F.get(F.filter("_s", lambda s: s["x"] > F.col("x")), F.lit(0))["low"]
        return asked.join(stairs, [*keys, "at"], "left").select(*keys, "frame", F.least(F.col("low"), step).alias(f"_far_{side}"))

    own = parts.where("frame is not null").select(*keys, "frame", "x", "low_left", "low_right")
    whole = own.join(far("left"), [*keys, "frame"], "left").join(far("right"), [*keys, "frame"], "left")
    rise = F.col("x") - F.greatest(F.least("low_left", "_far_left"), F.least("low_right", "_far_right"))
    return whole.select(*keys, F.col("frame").alias(frame), F.col("x").alias(value), rise.alias("rise"))


def find_peaks(df: DataFrame, keys: list[str], frame: str, value: str, height: float, distance: int = 1, prominence: float = 0.0, chunk: int = 1 << 16) -> DataFrame:
    """(keys, frame, value) of maxima of at least height, the highest first where nearer than distance, that rise by prominence; the result doesn't depend on chunk."""
    found = thinned(local_maxima(df, keys, frame, value, height, chunk), keys, frame, value, distance, chunk)
    if prominence <= 0:
        return found
    return prominences(df, found, keys, frame, value, chunk).where(F.col("rise") >= prominence).select(*keys, frame, value)
