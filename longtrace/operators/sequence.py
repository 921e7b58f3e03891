"""Pulses, runs, gaps and fills of ordered data (inventory group D, set-based part)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtrace.functions.carry import carried
from longtrace.functions.islands import band_join, islands
from longtrace.plans.standins import FRAMES, HOUR, POSE, SIGNAL, SPIKES, Book, frames, pose, signal, spikes

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
#: Chunks of the queries on event times: the stand-in's units have a few events a day.
CHUNK = 240 * HOUR


def pulse_onsets(df: DataFrame, keys: list[str], index: str, value: str, threshold: float, chunk: int = 1 << 20) -> DataFrame:
    """(keys, index): the first row of every run of rows above threshold."""
    return islands(df.where(F.col(value) > threshold), keys, index, 1, chunk).select(*keys, F.col("first").alias(index))


_ONSETS = f"{SIGNAL}, up AS (SELECT channel, i, t, lag(i) OVER (PARTITION BY channel ORDER BY i) AS p FROM signal WHERE v > 30), onsets AS (SELECT channel, i, t FROM up WHERE p IS NULL OR i - p > 1)"


@BOOK.add("d1_pulse_onsets", f"WITH {_ONSETS} SELECT channel, i FROM onsets")
def _d1(spark, sf):
    return pulse_onsets(signal(spark, sf), ["channel"], "i", "v", 30, chunk=16)


def segment_events(df: DataFrame, keys: list[str], time: str, gap: int, chunk: int, end: int | None = None) -> DataFrame:
    """(keys, event, start, stop, n): runs split where neighbours are more than gap apart, numbered in time; the last stop is at most end."""
    runs = islands(df, keys, time, gap, chunk)
    stop = F.least(F.col("last"), F.lit(end)) if end is not None else F.col("last")
    return runs.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("first")).cast("long").alias("event"), F.col("first").alias("start"), stop.alias("stop"), "n")


EVENTS = f"{SPIKES}, marked AS (SELECT *, sum(new) OVER (PARTITION BY unit ORDER BY t, spike) AS event FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike) <= {6 * HOUR} THEN 0 ELSE 1 END AS new FROM spikes)), segments AS (SELECT unit, event::BIGINT AS event, min(t) AS start, max(t) AS stop, count(*) AS n FROM marked GROUP BY unit, event)"


def segments(spark, sf) -> DataFrame:
    return segment_events(spikes(spark, sf), ["unit"], "t", 6 * HOUR, chunk=48 * HOUR)


@BOOK.add("d2_segment_events", f"WITH {EVENTS} SELECT * FROM segments")
def _d2(spark, sf):
    return segments(spark, sf)


def short_breaks(df: DataFrame, keys: list[str], time: str, least: int, most: int, chunk: int = HOUR) -> DataFrame:
    """(keys, break_start, break_stop): gaps longer than least and at most most."""
    gaps = carried(df.select(*keys, F.col(time).alias("break_stop")), keys, "break_stop", chunk, lag={"break_start": F.col("break_stop")})
    return gaps.where((F.col("break_stop") - F.col("break_start") > least) & (F.col("break_stop") - F.col("break_start") <= most))


BREAKS = f"{SPIKES}, breaks AS (SELECT unit, p AS break_start, t AS break_stop FROM (SELECT unit, t, lag(t) OVER (PARTITION BY unit ORDER BY t) AS p FROM spikes) WHERE t - p > {HOUR} AND t - p <= {6 * HOUR})"


@BOOK.add("d3_short_breaks", f"WITH {BREAKS} SELECT * FROM breaks")
def _d3(spark, sf):
    return short_breaks(spikes(spark, sf), ["unit"], "t", HOUR, 6 * HOUR, CHUNK)


def events_from_triggers(onsets: DataFrame, trials: DataFrame, keys: list[str], time: str, chunk: int = 1 << 20) -> DataFrame:
    """(keys, trial, start, stop): times of the pulses whose ordinals (from 1) a trial table names as first_pulse and last_pulse."""
    numbered = carried(onsets, keys, time, chunk, total={"_n": F.lit(1)})
    at = lambda n: numbered.select(*keys, F.col("_n").alias(f"{n}_pulse"), F.col(time).alias("start" if n == "first" else "stop"))
    return trials.join(at("first"), [*keys, "first_pulse"]).join(at("last"), [*keys, "last_pulse"]).select(*keys, "trial", "start", "stop")


@BOOK.add(
    "d4_events_from_triggers",
    f"WITH {_ONSETS}, n AS (SELECT channel, i, row_number() OVER (PARTITION BY channel ORDER BY i) AS k FROM onsets), tr AS (SELECT DISTINCT channel, (k - 1) // 4 AS trial FROM n) "
    "SELECT tr.channel, trial, a.i AS start, b.i AS stop FROM tr JOIN n a ON a.channel = tr.channel AND a.k = trial * 4 + 1 JOIN n b ON b.channel = tr.channel AND b.k = trial * 4 + 3",
)
def _d4(spark, sf):
    onsets = pulse_onsets(signal(spark, sf), ["channel"], "i", "v", 30, chunk=64)
    n = onsets.groupBy("channel").agg(F.count("*").alias("n"))
    trials = n.select("channel", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div 4"))).alias("trial")).withColumns({"first_pulse": F.col("trial") * 4 + 1, "last_pulse": F.col("trial") * 4 + 3})
    return events_from_triggers(onsets, trials, ["channel"], "i")


def runs_of_value(df: DataFrame, keys: list[str], index: str, value: Column, chunk: int | None = None) -> DataFrame:
    """(keys, first, last, n) of every run of consecutive rows that meet value."""
    return islands(df.where(value), keys, index, 1, chunk)


@BOOK.add(
    "d5_runs_of_value",
    f"WITH {SIGNAL}, m AS (SELECT channel, i, i - row_number() OVER (PARTITION BY channel ORDER BY i) AS g FROM signal WHERE v <= 20) SELECT channel, min(i) AS first, max(i) AS last, count(*) AS n FROM m GROUP BY channel, g",
)
def _d5(spark, sf):
    return runs_of_value(signal(spark, sf), ["channel"], "i", F.col("v") <= 20, chunk=32)


def dropout_intervals(spikes: DataFrame, keys: list[str], time: str, start: int, stop: int, width: int, chunk: int = 4096) -> DataFrame:
    """(keys, start_time, stop_time, drop_duration): bins of width within [start, stop) in which no unit fires, joined.

    Only whole bins count, an event at the end of the last one belongs to it; an
    interval that reaches the last bin is closed with stop. Without any event of a
    key there's no row; no dropout gives an empty table.
    """
    bins = (stop - start) // width
    number = F.floor((F.col(time) - start) / width)
    fired = spikes.where((F.col(time) >= start) & (F.col(time) <= start + bins * width)).select(*keys, F.least(number, F.lit(bins - 1)).alias("bin")).distinct()
    grid = fired.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    runs = islands(grid.join(fired, [*keys, "bin"], "left_anti"), keys, "bin", 1, chunk)
    begin, end = F.col("first") * width + start, F.when(F.col("last") == bins - 1, stop).otherwise((F.col("last") + 1) * width + start)
    return runs.select(*keys, begin.cast("long").alias("start_time"), end.cast("long").alias("stop_time"), (end - begin).cast("long").alias("drop_duration"))


DAYS30 = 30 * 24 * HOUR
FIRED = f"{SPIKES}, fired AS (SELECT DISTINCT unit % 10 AS grp, least(t // {HOUR}, 719) AS bin FROM spikes WHERE t >= 0 AND t <= {DAYS30})"
DROPOUT = f"{FIRED}, silent AS (SELECT g.grp, b.bin FROM (SELECT DISTINCT grp FROM fired) g, (SELECT unnest(range(0, 720)) AS bin) b WHERE NOT EXISTS (SELECT 1 FROM fired f WHERE f.grp = g.grp AND f.bin = b.bin)), dropout AS (SELECT grp, min(bin) * {HOUR} AS start_time, CASE WHEN max(bin) = 719 THEN {DAYS30} ELSE (max(bin) + 1) * {HOUR} END AS stop_time FROM (SELECT *, bin - row_number() OVER (PARTITION BY grp ORDER BY bin) AS g FROM silent) GROUP BY grp, g)"


def dropouts(spark, sf) -> DataFrame:
    rows = spikes(spark, sf).withColumn("grp", F.col("unit") % 10)
    return dropout_intervals(rows, ["grp"], "t", 0, DAYS30, HOUR, chunk=100)


@BOOK.add("d6_dropout_intervals", f"WITH {DROPOUT} SELECT grp, start_time::BIGINT AS start_time, stop_time::BIGINT AS stop_time, (stop_time - start_time)::BIGINT AS drop_duration FROM dropout")
def _d6(spark, sf):
    return dropouts(spark, sf)


def isi(df: DataFrame, keys: list[str], time: str, chunk: int = HOUR) -> DataFrame:
    """Adds `isi`, the time since the key's event before, NULL for its first."""
    return carried(df, keys, time, chunk, lag={"_t": F.col(time)}).withColumn("isi", F.col(time) - F.col("_t")).drop("_t")


@BOOK.add("d7_isi", f"WITH {SPIKES} SELECT unit, t, t - lag(t) OVER (PARTITION BY unit ORDER BY t) AS isi FROM spikes")
def _d7(spark, sf):
    return isi(spikes(spark, sf).select("unit", "t"), ["unit"], "t", CHUNK)


def drop_duplicate_spikes(df: DataFrame, keys: list[str], time: str, closer: int, only: Column, chunk: int = HOUR) -> DataFrame:
    """df without the earlier event of every pair closer than `closer`, for rows that meet `only`; one pass, other rows stay."""
    next_ = carried(df, keys, time, chunk, lead={"_after": F.col(time)})
    return next_.where(~only | F.col("_after").isNull() | (F.col("_after") - F.col(time) >= closer)).drop("_after")


@BOOK.add("d8_drop_duplicate_spikes", f"WITH {SPIKES} SELECT unit, t, spike FROM (SELECT *, lead(t) OVER (PARTITION BY unit ORDER BY t) - t AS a FROM spikes) WHERE unit % 4 = 0 OR a IS NULL OR a >= {HOUR}")
def _d8(spark, sf):
    return drop_duplicate_spikes(spikes(spark, sf).select("unit", "t", "spike"), ["unit"], "t", HOUR, F.col("unit") % 4 != 0, CHUNK)


def frame_gaps(df: DataFrame, event: str, cam: str, number: str, chunk: int = 1 << 20) -> DataFrame:
    """(event, cam, good, first_missing, last_missing): holes in frame numbers, before the first frame (from 1), between, and up to the event's last frame over all cameras. good: the frame before, or the first one."""
    last = df.groupBy(event).agg(F.max(number).alias("_event_last"))
    ends = df.groupBy(event, cam).agg(F.max(number).alias("_last")).join(last, event)
    tail = ends.where("_last < _event_last").select(event, cam, F.col("_last").alias("good"), (F.col("_last") + 1).alias("first_missing"), F.col("_event_last").alias("last_missing"))
    before = F.coalesce("_before", F.lit(0))
    holes = carried(df.select(event, cam, number), [event, cam], number, chunk, lag={"_before": F.col(number)}).select(event, cam, F.when(before == 0, F.col(number)).otherwise(before).alias("good"), (before + 1).alias("first_missing"), (F.col(number) - 1).alias("last_missing")).where("last_missing >= first_missing")
    return holes.unionByName(tail)


GAPS = f"""{FRAMES}, lagged AS (SELECT event, cam, frame_no, coalesce(lag(frame_no) OVER (PARTITION BY event, cam ORDER BY frame_no), 0) AS p FROM frames),
lasts AS (SELECT event, cam, max(frame_no) AS l, max(max(frame_no)) OVER (PARTITION BY event) AS m FROM frames GROUP BY event, cam),
gaps AS (SELECT event, cam, CASE WHEN p = 0 THEN frame_no ELSE p END AS good, p + 1 AS first_missing, frame_no - 1 AS last_missing FROM lagged WHERE frame_no > p + 1
UNION ALL SELECT event, cam, l, l + 1, m FROM lasts WHERE l < m)"""


@BOOK.add("d9_frame_gaps", f"WITH {GAPS} SELECT * FROM gaps")
def _d9(spark, sf):
    return frame_gaps(frames(spark, sf), "event", "cam", "frame_no", chunk=20)


def fill_dropped_frames(df: DataFrame, event: str, cam: str, number: str, time: str, period: int) -> DataFrame:
    """(event, cam, number, source, time): one row per missing frame; it copies `source` and is dated by whole periods from it."""
    missing = frame_gaps(df, event, cam, number).select(event, cam, F.col("good").alias("source"), F.explode(F.sequence("first_missing", "last_missing")).alias("_n"))
    times = df.select(event, cam, F.col(number).alias("source"), F.col(time).alias("_t"))
    made = missing.join(times, [event, cam, "source"])
    return made.select(event, cam, F.col("_n").alias(number), "source", (F.col("_t") + (F.col("_n") - F.col("source")) * period).alias(time))


@BOOK.add("d10_fill_dropped_frames", f"WITH {GAPS}, x AS (SELECT event, cam, good, unnest(range(first_missing, last_missing + 1)) AS n FROM gaps) SELECT x.event, x.cam, n AS frame_no, good AS source, f.t + (n - good) * 5000 AS t FROM x JOIN frames f ON f.event = x.event AND f.cam = x.cam AND f.frame_no = good")
def _d10(spark, sf):
    return fill_dropped_frames(frames(spark, sf), "event", "cam", "frame_no", "t", 5000)


def drop_mask(whole: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """whole with `is_good`: False for rows listed in dropped."""
    return whole.join(dropped.select(*keys).distinct().withColumn("_d", F.lit(True)), keys, "left").withColumn("is_good", F.col("_d").isNull()).drop("_d")


@BOOK.add(
    "d11_drop_mask",
    f"WITH {GAPS}, m AS (SELECT DISTINCT event, cam, max(frame_no) OVER (PARTITION BY event) AS m FROM frames), g AS (SELECT event, cam, unnest(range(1, m + 1)) AS frame_no FROM m) SELECT g.*, f.frame_no IS NOT NULL AS is_good FROM g LEFT JOIN frames f USING (event, cam, frame_no)",
)
def _d11(spark, sf):
    rows = frames(spark, sf)
    last = rows.groupBy("event").agg(F.max("frame_no").alias("m"))
    grid = rows.select("event", "cam").distinct().join(last, "event").select("event", "cam", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("frame_no"))
    return drop_mask(grid, fill_dropped_frames(rows, "event", "cam", "frame_no", "t", 5000), ["event", "cam", "frame_no"])


def repair_frame_numbers(df: DataFrame, keys: list[str], number: str, time: str, period: int, chunk: int = HOUR) -> DataFrame:
    """df with `repaired`: numbers moved up by what the clock says is missing between neighbours."""
    near = carried(df, keys, time, chunk, [number], lag={"_n": F.col(number), "_t": F.col(time)})
    told = F.expr(f"({time} - _t + {period // 2}) div {period}")
    moved = near.withColumn("_add", F.coalesce(F.greatest(F.lit(0), told - (F.col(number) - F.col("_n"))), F.lit(0))).drop("_n", "_t")
    return carried(moved, keys, time, chunk, [number], total={"_moved": F.col("_add")}).withColumn("repaired", F.col(number) + F.col("_moved")).drop("_add", "_moved")


@BOOK.add(
    "d12_repair_frame_numbers",
    f"WITH {FRAMES}, a AS (SELECT *, coalesce(greatest(0, (t - lag(t) OVER w + {HOUR // 2}) // {HOUR} - (frame_no - lag(frame_no) OVER w)), 0) AS a FROM frames WINDOW w AS (PARTITION BY event, cam ORDER BY t, frame_no)) "
    "SELECT event, cam, frame_no, (frame_no + sum(a) OVER (PARTITION BY event, cam ORDER BY t, frame_no))::BIGINT AS repaired FROM a",
)
def _d12(spark, sf):
    return repair_frame_numbers(frames(spark, sf), ["event", "cam"], "frame_no", "t", HOUR, CHUNK).select("event", "cam", "frame_no", "repaired")


def clean_chunks(df: DataFrame, keys: list[str], frame: str, valid: Column, shortest: int, stitch: int, chunk: int = 1 << 20) -> DataFrame:
    """(keys, first, last): runs of valid frames of at least `shortest` frames, joined when fewer than `stitch` frames lie between."""
    long_enough = islands(df.where(valid), keys, frame, 1, chunk).where(F.col("n") >= shortest)
    near = carried(long_enough, keys, "first", chunk, lag={"_last": F.col("last")})
    apart = F.coalesce(F.col("first") - F.col("_last") - 1 >= stitch, F.lit(True))
    return carried(near.withColumn("_apart", apart.cast("long")), keys, "first", chunk, total={"_g": F.col("_apart")}).groupBy(*keys, "_g").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_g")


CHUNKS = f"""{POSE}, v AS (SELECT event, marker, frame, frame - row_number() OVER (PARTITION BY event, marker ORDER BY frame) AS g FROM pose WHERE error <= 40),
r AS (SELECT event, marker, min(frame) AS f, max(frame) AS l FROM v GROUP BY event, marker, g HAVING count(*) >= 2),
s AS (SELECT *, sum(a) OVER (PARTITION BY event, marker ORDER BY f) AS k FROM (SELECT *, CASE WHEN f - lag(l) OVER (PARTITION BY event, marker ORDER BY f) - 1 < 3 THEN 0 ELSE 1 END AS a FROM r)),
chunks AS (SELECT event, marker, min(f) AS first, max(l) AS last FROM s GROUP BY event, marker, k)"""


@BOOK.add("d13_clean_chunks", f"WITH {CHUNKS} SELECT * FROM chunks")
def _d13(spark, sf):
    return clean_chunks(pose(spark, sf), ["event", "marker"], "frame", F.col("error") <= 40, 2, 3, chunk=20)


def linear_fill(df: DataFrame, keys: list[str], frame: str, value: str, chunk: int = 1 << 20) -> DataFrame:
    """df with `filled`: NULLs between two values on the straight line between them; at the ends NULL."""
    return _filled(df, keys, frame, value, chunk).drop("_last")


def _filled(df: DataFrame, keys: list[str], frame: str, value: str, chunk: int) -> DataFrame:
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(frame).alias("f"), F.col(value).alias("x")))
    rows = carried(df, keys, frame, chunk, before={"_b": known}, after={"_a": known})
    line = F.col("_b.x") + (F.col("_a.x") - F.col("_b.x")) * (F.col(frame) - F.col("_b.f")) / (F.col("_a.f") - F.col("_b.f"))
    return rows.withColumn("filled", F.coalesce(F.col(value), line)).withColumn("_last", F.col("_b.x")).drop("_a", "_b")


_FILL = f"""{POSE}, q AS (SELECT event, marker, frame, CASE WHEN error <= 40 THEN y END AS y FROM pose),
b AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN frame END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS bf, last_value(y IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS bx,
first_value(CASE WHEN y IS NOT NULL THEN frame END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS af, first_value(y IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ax FROM q WINDOW w AS (PARTITION BY event, marker ORDER BY frame)),
filled AS (SELECT *, coalesce(y, bx + (ax - bx) * (frame - bf) / (af - bf)) AS filled FROM b)"""


def _checked(spark, sf):
    return pose(spark, sf).select("event", "marker", "frame", F.when(F.col("error") <= 40, F.col("y")).alias("y"))


@BOOK.add("d14_linear_fill", f"WITH {_FILL} SELECT event, marker, frame, round(filled, 5) AS filled FROM filled")
def _d14(spark, sf):
    return linear_fill(_checked(spark, sf), ["event", "marker"], "frame", "y", 20).select("event", "marker", "frame", F.round("filled", 5).alias("filled"))


def interpolate_series(df: DataFrame, keys: list[str], frame: str, value: str, chunk: int = 1 << 20) -> DataFrame:
    """linear_fill, and behind the last value that value goes on."""
    return _filled(df, keys, frame, value, chunk).withColumn("filled", F.coalesce("filled", "_last")).drop("_last")


@BOOK.add("d15_interpolate_series", f"WITH {_FILL} SELECT event, marker, frame, round(coalesce(filled, bx), 5) AS filled FROM filled")
def _d15(spark, sf):
    return interpolate_series(_checked(spark, sf), ["event", "marker"], "frame", "y", 20).select("event", "marker", "frame", F.round("filled", 5).alias("filled"))


def derivatives(df: DataFrame, keys: list[str], frame: str, axes: list[str], fps: float, chunk: int = 1 << 20) -> DataFrame:
    """df with `v_<axis>`: step to the next frame times fps; NULL at the end of a key."""
    near = carried(df, keys, frame, chunk, lead={f"_n_{a}": F.col(a) for a in axes})
    return near.withColumns({f"v_{a}": (F.col(f"_n_{a}") - F.col(a)) * fps for a in axes}).drop(*(f"_n_{a}" for a in axes))


@BOOK.add("d21_derivatives", f"WITH {POSE} SELECT event, marker, frame, round((lead(y) OVER w - y) * 200.0, 5)::DOUBLE AS v_y, round((lead(z) OVER w - z) * 200.0, 5)::DOUBLE AS v_z FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame)")
def _d21(spark, sf):
    return derivatives(pose(spark, sf), ["event", "marker"], "frame", ["y", "z"], 200.0, 20).select("event", "marker", "frame", F.round("v_y", 5).alias("v_y"), F.round("v_z", 5).alias("v_z"))


def speed(*velocities: Column) -> Column:
    return F.sqrt(sum((v * v for v in velocities), F.lit(0.0)))


_SPEED = f"{POSE}, vel AS (SELECT *, (lead(y) OVER w - y) AS vy, (lead(z) OVER w - z) AS vz FROM pose WINDOW w AS (PARTITION BY event, marker ORDER BY frame))"


@BOOK.add("d22_speed", f"WITH {_SPEED} SELECT event, marker, frame, round(sqrt(vy * vy + vz * vz), 5) AS speed FROM vel")
def _d22(spark, sf):
    rows = derivatives(pose(spark, sf), ["event", "marker"], "frame", ["y", "z"], 1.0)
    return rows.select("event", "marker", "frame", F.round(speed(F.col("v_y"), F.col("v_z")), 5).alias("speed"))


def gaussian_weights(sigma: float, reach: float = 4.0) -> list[float]:
    import math

    k = int(reach * sigma + 0.5)
    w = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-k, k + 1)]
    return [x / sum(w) for x in w]


def stencil(df: DataFrame, keys: list[str], frame: str, value: str, weights: list[float], out: str, chunk: int = 1 << 16) -> DataFrame:
    """df with `out`: the weighted sum over neighbours of a gap-free series, mirrored at its ends, as often as a short
    series needs.

    Rows are spread to the rows they touch by chunk: each chunk of a key takes in a
    halo of half the weights from either side, so a key is never one task.
    """
    k = len(weights) // 2
    ends = df.groupBy(*keys).agg(F.min(frame).alias("_lo"), F.max(frame).alias("_hi"))
    rows = df.join(ends, keys)
    period = 2 * (F.col("_hi") - F.col("_lo") + 1)
    turns = F.sequence(-(F.floor(k / period) + 1), F.floor(k / period) + 1)
    images = F.flatten(F.transform(turns, lambda m: F.array(F.col(frame) + m * period, 2 * F.col("_lo") - 1 - F.col(frame) + m * period)))
    mirror = F.filter(images, lambda f: f.between(F.col("_lo") - k, F.col("_hi") + k))
    seen = rows.withColumn("_f", F.explode(F.array_distinct(mirror)))
    halo = F.sequence(F.floor((F.col("_f") - k) / chunk), F.floor((F.col("_f") + k) / chunk))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_f")
    total = sum((F.coalesce(F.lag(value, k - i).over(w) if i < k else F.lead(value, i - k).over(w), F.lit(0.0)) * x for i, x in enumerate(weights)), F.lit(0.0))
    spread = seen.withColumn("_chunk", F.explode(halo)).withColumn(out, total)
    return spread.where((F.floor(F.col(frame) / chunk) == F.col("_chunk")) & (F.col("_f") == F.col(frame))).drop("_chunk", "_f", "_lo", "_hi")


def gaussian_smooth(df: DataFrame, keys: list[str], frame: str, value: str, sigma: float = 1.5, out: str = "smooth", chunk: int = 1 << 16) -> DataFrame:
    return stencil(df, keys, frame, value, gaussian_weights(sigma), out, chunk)


_G = gaussian_weights(1.5)


@BOOK.add(
    "d23_gaussian_smooth",
    f"WITH {POSE}, e AS (SELECT event, marker, max(frame) AS hi FROM pose GROUP BY event, marker), w AS (SELECT unnest(range(-6, 7)) AS d, unnest([{', '.join(map(repr, _G))}]) AS w), "
    "x AS (SELECT event, marker, frame, w, least((frame + d + 40 * (hi + 1)) % (2 * (hi + 1)), 2 * hi + 1 - (frame + d + 40 * (hi + 1)) % (2 * (hi + 1))) AS src FROM pose JOIN e USING (event, marker), w) "
    "SELECT x.event, x.marker, x.frame, round(sum(w * p.y), 5) AS smooth FROM x JOIN pose p ON p.event = x.event AND p.marker = x.marker AND p.frame = src GROUP BY ALL",
)
def _d23(spark, sf):
    rows = pose(spark, sf).select("event", "marker", "frame", "y")
    smooth = gaussian_smooth(rows, ["event", "marker"], "frame", "y", chunk=10)
    return smooth.select("event", "marker", "frame", F.round("smooth", 5).alias("smooth"))


def median_filter(df: DataFrame, keys: list[str], frame: str, value: str, width: int, chunk: int = 1 << 16) -> DataFrame:
    """df with `median` over width rows about each, zeros beyond the ends of a key.

    frame numbers are without gaps, so a row also goes to the chunk before or behind
    if that has a row within half the width: a window holds one chunk and its rims.
    """
    k = width // 2
    spread = df.withColumn("_chunk", F.explode(F.sequence(F.floor((F.col(frame) - k) / chunk), F.floor((F.col(frame) + k) / chunk))))
    w = Window.partitionBy(*keys, "_chunk").orderBy(frame)
    near = [F.lag(value, -j).over(w) if j < 0 else F.lead(value, j).over(w) if j > 0 else F.col(value) for j in range(-k, k + 1)]
    ranked = spread.withColumn("median", F.get(F.sort_array(F.array(*(F.coalesce(x, F.lit(0.0)) for x in near))), F.lit(k)))
    return ranked.where(F.floor(F.col(frame) / chunk) == F.col("_chunk")).drop("_chunk")


@BOOK.add(
    "d25_median_filter",
    f"WITH {POSE}, n AS (SELECT event, marker, frame, list(y) OVER (PARTITION BY event, marker ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS l FROM pose) "
    "SELECT event, marker, frame, list_sort(list_concat(l, list_transform(range(0, 7 - len(l)), lambda i: 0.0::DOUBLE)))[4] AS median FROM n",
)
def _d25(spark, sf):
    return median_filter(pose(spark, sf), ["event", "marker"], "frame", "y", 7, chunk=20).select("event", "marker", "frame", "median")


def threshold_crossings(df: DataFrame, keys: list[str], frame: str, flag: Column, chunk: int = 1 << 20) -> DataFrame:
    """(keys, frame, way): rows before the flag changes; way 1: it becomes true, -1: it ends."""
    near = carried(df.select(*keys, frame, flag.cast("int").alias("_flag")), keys, frame, chunk, lead={"_next": F.col("_flag")})
    return near.select(*keys, frame, (F.col("_next") - F.col("_flag")).alias("way")).where("way <> 0")


CROSS = f"{POSE}, cross_ AS (SELECT event, marker, frame, (lead(y > 60) OVER (PARTITION BY event, marker ORDER BY frame))::INT - (y > 60)::INT AS way FROM pose), crossings AS (SELECT * FROM cross_ WHERE way <> 0)"


@BOOK.add("d27_threshold_crossings", f"WITH {CROSS} SELECT * FROM crossings")
def _d27(spark, sf):
    return threshold_crossings(pose(spark, sf), ["event", "marker"], "frame", F.col("y") > 60, chunk=20)


def reach_by_level(df: DataFrame, keys: list[str], frame: str, value: str, level: float, chunk: int = 1 << 20) -> DataFrame:
    """(keys, start, stop): from the row before value rises above level to the row before it falls again; open runs are left out."""
    crossings = threshold_crossings(df, keys, frame, F.col(value) > level, chunk)
    return carried(crossings, keys, frame, chunk, after={"stop": F.when(F.col("way") == -1, F.col(frame))}).where("way = 1 and stop is not null").select(*keys, F.col(frame).alias("start"), "stop")


REACH = f"{CROSS}, reaches AS (SELECT event, marker, frame AS start, stop FROM (SELECT *, first_value(CASE WHEN way = -1 THEN frame END IGNORE NULLS) OVER (PARTITION BY event, marker ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM crossings) WHERE way = 1 AND stop IS NOT NULL)"


@BOOK.add("d29_reach_by_y", f"WITH {REACH} SELECT * FROM reaches")
def _d29(spark, sf):
    return reach_by_level(pose(spark, sf), ["event", "marker"], "frame", "y", 60, chunk=20)


def reach_by_velocity(df: DataFrame, keys: list[str], frame: str, value: str, peak: float, bound: float) -> DataFrame:
    """Runs above bound that hold a value above peak."""
    runs = reach_by_level(df, keys, frame, value, bound)
    high = df.where(F.col(value) > peak).select(*keys, F.col(frame).alias("_f"))
    held = band_join(high, runs.withColumn("_first", F.col("start") + 1), keys, "_f", "_first", "stop", 256)
    return held.select(*keys, "start", "stop").distinct()


@BOOK.add(
    "d30_reach_by_velocity",
    f"WITH {_SPEED}, s AS (SELECT event, marker, frame, sqrt(vy * vy + vz * vz) AS s FROM vel), c AS (SELECT event, marker, frame, (lead(s > 20) OVER (PARTITION BY event, marker ORDER BY frame))::INT - (s > 20)::INT AS way FROM s), "
    "r AS (SELECT event, marker, frame AS start, first_value(CASE WHEN way = -1 THEN frame END IGNORE NULLS) OVER (PARTITION BY event, marker ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop, way FROM c WHERE way <> 0) "
    "SELECT event, marker, start, stop FROM r WHERE way = 1 AND stop IS NOT NULL AND EXISTS (SELECT 1 FROM s WHERE s.event = r.event AND s.marker = r.marker AND s.s > 60 AND s.frame > start AND s.frame <= stop)",
)
def _d30(spark, sf):
    rows = derivatives(pose(spark, sf), ["event", "marker"], "frame", ["y", "z"], 1.0).withColumn("s", speed(F.col("v_y"), F.col("v_z")))
    return reach_by_velocity(rows, ["event", "marker"], "frame", "s", 60, 20)


def reach_manual(reaches: DataFrame, manual: DataFrame, keys: list[str]) -> DataFrame:
    """Reaches of a manual table where it has any for the key, else those found."""
    return reaches.join(manual.select(*keys).distinct(), keys, "left_anti").unionByName(manual.join(reaches.select(*keys).distinct(), keys, "left_semi"))


_MANUAL = "manual AS (SELECT DISTINCT event, marker, 2::BIGINT AS start, 7::BIGINT AS stop FROM reaches WHERE event % 2 = 0)"


@BOOK.add("d31_reach_manual", f"WITH {REACH}, {_MANUAL} SELECT * FROM reaches WHERE event % 2 <> 0 UNION ALL SELECT * FROM manual")
def _d31(spark, sf):
    found = _d29(spark, sf)
    manual = found.where("event % 2 = 0").select("event", "marker", F.lit(2).cast("long").alias("start"), F.lit(7).cast("long").alias("stop")).distinct()
    return reach_manual(found, manual, ["event", "marker"])


def reach_manual_clip(reaches: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Reaches that touch a manual range, clipped to it."""
    r = ranges.select(*keys, F.col("start").alias("_lo"), F.col("stop").alias("_hi"))
    touched = reaches.join(r, keys).where("start <= _hi and stop >= _lo")
    return touched.select(*keys, F.greatest("start", "_lo").alias("start"), F.least("stop", "_hi").alias("stop"))


@BOOK.add("d32_reach_manual_clip", f"WITH {REACH} SELECT event, marker, greatest(start, 3) AS start, least(stop, 30) AS stop FROM reaches WHERE start <= 30 AND stop >= 3")
def _d32(spark, sf):
    found = _d29(spark, sf)
    ranges = found.select("event", "marker", F.lit(3).cast("long").alias("start"), F.lit(30).cast("long").alias("stop")).distinct()
    return reach_manual_clip(found, ranges, ["event", "marker"])


def merge_overlaps(df: DataFrame, keys: list[str], start: str, stop: str, slack: int = 0, chunk: int = HOUR) -> DataFrame:
    """(keys, start, stop): intervals joined when the next starts less than slack after all before have ended, or at their end."""
    ended = carried(df, keys, start, chunk, [stop], top={"_ended": F.col(stop)})
    apart = F.coalesce(F.col(start) - F.col("_ended") > slack, F.lit(True)).cast("long")
    return carried(ended.withColumn("_apart", apart), keys, start, chunk, [stop], total={"_g": F.col("_apart")}).groupBy(*keys, "_g").agg(F.min(start).alias(start), F.max(stop).alias(stop)).drop("_g")


@BOOK.add(
    "d33_merge_overlaps",
    f"WITH {SPIKES}, v AS (SELECT unit, t AS start, t + {HOUR} * (spike % 9) AS stop FROM spikes), m AS (SELECT *, max(stop) OVER (PARTITION BY unit ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM v), "
    "g AS (SELECT *, sum(CASE WHEN start - e > 0 OR e IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY unit ORDER BY start, stop) AS g FROM m) SELECT unit, min(start) AS start, max(stop) AS stop FROM g GROUP BY unit, g",
)
def _d33(spark, sf):
    rows = spikes(spark, sf).select("unit", F.col("t").alias("start"), (F.col("t") + HOUR * (F.col("spike") % 9)).alias("stop"))
    return merge_overlaps(rows, ["unit"], "start", "stop", chunk=CHUNK)
