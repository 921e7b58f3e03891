"""Range, tolerance, as-of and matching joins (inventory group F)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtrace.functions.carry import carried
from longtrace.functions.islands import band_join
from longtrace.operators.sequence import BREAKS, EVENTS, HOUR, REACH, _d3, _d29, segments
from longtrace.plans.standins import ELECTRODES, POSE, SIGNAL, SPIKES, Book, electrodes, pose, signal, spikes

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
UP = Window.unboundedPreceding


def frames_in_event(pulses: DataFrame, events: DataFrame, keys: list[str], time: str, bucket: int) -> DataFrame:
    """Pulses with the event whose closed range [start, stop] holds them."""
    return band_join(pulses, events, keys, time, "start", "stop", bucket)


@BOOK.add("f1_frames_in_event", f"WITH {EVENTS} SELECT s.unit, s.t, g.event FROM spikes s JOIN segments g ON s.unit = g.unit AND s.t BETWEEN g.start AND g.stop WHERE g.n > 1")
def _f1(spark, sf):
    return frames_in_event(spikes(spark, sf).select("unit", "t"), segments(spark, sf).where("n > 1"), ["unit"], "t", 24 * HOUR).select("unit", "t", "event")


def spikes_in_range(df: DataFrame, time: str, start: int, stop: int) -> DataFrame:
    return df.where(F.col(time).between(start, stop))


@BOOK.add("f2_spikes_in_range", f"WITH {SPIKES} SELECT unit, t FROM spikes WHERE t BETWEEN {24 * HOUR} AND {72 * HOUR}")
def _f2(spark, sf):
    return spikes_in_range(spikes(spark, sf).select("unit", "t"), "t", 24 * HOUR, 72 * HOUR)


def reach_slice(kinematics: DataFrame, reaches: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """Rows with start <= frame < stop of a reach of their event."""
    half_open = reaches.withColumn("_last", F.col("stop") - 1)
    return band_join(kinematics, half_open, keys, frame, "start", "_last", 256).drop("_last")


@BOOK.add("f3_reach_slice", f"WITH {REACH} SELECT p.event, p.marker, p.frame, p.y, r.start FROM pose p JOIN reaches r ON p.event = r.event AND p.marker = r.marker AND p.frame >= r.start AND p.frame < r.stop")
def _f3(spark, sf):
    return reach_slice(pose(spark, sf).select("event", "marker", "frame", "y"), _d29(spark, sf), ["event", "marker"], "frame").select("event", "marker", "frame", "y", "start")


def reach_times(reaches: DataFrame, times: DataFrame, keys: list[str], frame: str, time: str) -> DataFrame:
    """Reaches with start_time, and stop_time of the frame before stop."""
    at = lambda c: times.select(*keys, F.col(frame).alias("_f"), F.col(time).alias(c))
    first = reaches.withColumn("_f", F.col("start")).join(at("start_time"), [*keys, "_f"]).drop("_f")
    return first.withColumn("_f", F.col("stop") - 1).join(at("stop_time"), [*keys, "_f"]).drop("_f")


@BOOK.add("f4_reach_times", f"WITH {REACH} SELECT r.event, r.marker, r.start, r.stop, a.z AS start_time, b.z AS stop_time FROM reaches r JOIN pose a ON a.event = r.event AND a.marker = r.marker AND a.frame = r.start JOIN pose b ON b.event = r.event AND b.marker = r.marker AND b.frame = r.stop - 1")
def _f4(spark, sf):
    return reach_times(_d29(spark, sf), pose(spark, sf), ["event", "marker"], "frame", "z").select("event", "marker", "start", "stop", "start_time", "stop_time")


def spike_to_sample(df: DataFrame, samples: DataFrame, keys: list[str], time: str, sample_time: str, step: int, tolerance: int) -> DataFrame:
    """Each event with its nearest grid sample within tolerance: an equi join on whole steps, then the exact difference."""
    number = lambda c: F.expr(f"({c} + {step // 2}) div {step}")
    grid = samples.select(*keys, F.col(sample_time), number(sample_time).alias("_n"))
    return df.withColumn("_n", number(time)).join(grid, [*keys, "_n"]).where(F.abs(F.col(time) - F.col(sample_time)) <= tolerance).drop("_n")


@BOOK.add("f5_spike_to_sample", f"WITH {SPIKES}, g AS (SELECT DISTINCT unit, ((t + {HOUR // 2}) // {HOUR}) * {HOUR} AS s FROM spikes) SELECT spikes.unit, t, s FROM spikes JOIN g ON g.unit = spikes.unit AND s // {HOUR} = (t + {HOUR // 2}) // {HOUR} AND abs(t - s) <= {HOUR // 6}")
def _f5(spark, sf):
    rows = spikes(spark, sf).select("unit", "t")
    grid = rows.select("unit", (F.expr(f"(t + {HOUR // 2}) div {HOUR}") * HOUR).alias("s")).distinct()
    return spike_to_sample(rows, grid, ["unit"], "t", "s", HOUR, HOUR // 6)


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, after: bool = False, chunk: int = HOUR) -> DataFrame:
    """left with the last value of right at or before its time (after: the first at or behind it); both are walked together in chunks of time."""
    rows = left.withColumn("_side", F.lit(0 if after else 1)).unionByName(right.select(*keys, time, F.col(value).alias("_v")).withColumn("_side", F.lit(1 if after else 0)), allowMissingColumns=True)
    rows = carried(rows, keys, time, chunk, ["_side"], **{"after" if after else "before": {value: F.col("_v")}})
    return rows.where(F.col("_side") == (0 if after else 1)).select(*left.columns, value)


@BOOK.add("f6_as_of", f"WITH {SPIKES}, c AS (SELECT unit, t, t AS crossing FROM spikes WHERE amplitude > 100), q AS (SELECT unit, spike, t + {HOUR} AS t FROM spikes) SELECT q.unit, q.spike, c.crossing FROM q ASOF LEFT JOIN c ON q.unit = c.unit AND q.t >= c.t")
def _f6(spark, sf):
    rows = spikes(spark, sf)
    found = rows.where("amplitude > 100").select("unit", "t", F.col("t").alias("crossing"))
    return as_of(rows.select("unit", "spike", (F.col("t") + HOUR).alias("t")), found, ["unit"], "t", "crossing", chunk=240 * HOUR).drop("t")


@BOOK.add("f6b_as_of_next", f"WITH {SPIKES}, c AS (SELECT unit, t, t AS crossing FROM spikes WHERE amplitude > 100), q AS (SELECT unit, spike, t + {HOUR} AS t FROM spikes) SELECT q.unit, q.spike, c.crossing FROM q ASOF LEFT JOIN c ON q.unit = c.unit AND q.t <= c.t")
def _f6b(spark, sf):
    rows = spikes(spark, sf)
    found = rows.where("amplitude > 100").select("unit", "t", F.col("t").alias("crossing"))
    return as_of(rows.select("unit", "spike", (F.col("t") + HOUR).alias("t")), found, ["unit"], "t", "crossing", after=True, chunk=240 * HOUR).drop("t")


def unit_electrodes(units: DataFrame, electrodes: DataFrame, channel: str) -> DataFrame:
    """Units with their electrode's columns; the dimension is broadcast when Spark finds it small."""
    return units.join(electrodes, channel, "left")


@BOOK.add("f7_unit_electrode_join", f"WITH {SPIKES}, {ELECTRODES}, u AS (SELECT unit, count(*) AS n FROM spikes GROUP BY unit) SELECT unit, n, label, ex, ey FROM u LEFT JOIN electrodes e ON e.channel = u.unit")
def _f7(spark, sf):
    units = spikes(spark, sf).groupBy("unit").agg(F.count("*").alias("n"))
    return unit_electrodes(units.withColumn("channel", F.col("unit")), electrodes(spark, sf), "channel").select("unit", "n", "label", "ex", "ey")


def impedance_lists(electrodes: DataFrame, impedances: DataFrame, label: str, value: str) -> DataFrame:
    """Every electrode with the list of its impedances, in order."""
    lists = impedances.groupBy(label).agg(F.array_sort(F.collect_list(value)).alias("impedances"))
    return electrodes.join(lists, label, "left").withColumn("impedances", F.coalesce("impedances", F.array().cast("array<double>")))


@BOOK.add("f8_impedance_join", f"WITH {ELECTRODES} SELECT channel, coalesce(array_to_string(list_sort(list(c_acctbal)), ','), '') AS impedances FROM electrodes LEFT JOIN customer ON c_nationkey = channel GROUP BY channel")
def _f8(spark, sf):
    measured = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_nationkey").cast("long").alias("channel"), "c_acctbal")
    joined = impedance_lists(electrodes(spark, sf).select("channel"), measured, "channel", "c_acctbal")
    return joined.select("channel", F.array_join(F.transform("impedances", lambda x: x.cast("string")), ",").alias("impedances"))


def intact_electrodes(mapped: DataFrame, recorded: DataFrame, label: str) -> DataFrame:
    """mapped with `intact`: whether the recording has the label."""
    return mapped.join(recorded.select(label).distinct().withColumn("_r", F.lit(True)), label, "left").withColumn("intact", F.col("_r").isNotNull()).drop("_r")


@BOOK.add("f9_intact_electrodes", f"WITH {SPIKES}, {ELECTRODES} SELECT channel, label, channel IN (SELECT unit FROM spikes GROUP BY unit HAVING count(*) >= 66) AS intact FROM electrodes")
def _f9(spark, sf):
    recorded = spikes(spark, sf).groupBy(F.col("unit").alias("channel")).agg(F.count("*").alias("n")).where("n >= 66")
    return intact_electrodes(electrodes(spark, sf).select("channel", "label"), recorded, "channel").select("channel", "label", "intact")


def session_match(events: DataFrame, sessions: DataFrame, keys: list[str]) -> DataFrame:
    return events.join(sessions.select(*keys).distinct(), keys, "left_semi")


@BOOK.add("f10_session_match", f"WITH {EVENTS} SELECT * FROM segments WHERE unit IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def _f10(spark, sf):
    sessions = spark.read.parquet(f"{sf}/supplier.parquet").where("s_acctbal > 0").select(F.col("s_suppkey").alias("unit"))
    return session_match(segments(spark, sf), sessions, ["unit"])


def camera_event_align(df: DataFrame, session: str, cam: str, start: str, slack: int) -> DataFrame:
    """df with `common`: the event number shared by starts of a session that lie within slack of their neighbour."""
    w = Window.partitionBy(session).orderBy(start, cam)
    new = F.coalesce(F.col(start) - F.lag(start).over(w) > slack, F.lit(True))
    return df.withColumn("common", F.sum(new.cast("long")).over(w.rowsBetween(UP, 0)))


@BOOK.add(
    "f11_camera_event_align",
    f"WITH {EVENTS}, m AS (SELECT unit % 10 AS session, unit, event, start, CASE WHEN start - lag(start) OVER (PARTITION BY unit % 10 ORDER BY start, unit) <= {HOUR // 4} THEN 0 ELSE 1 END AS n FROM segments) SELECT session, unit, event, (sum(n) OVER (PARTITION BY session ORDER BY start, unit))::BIGINT AS common FROM m",
)
def _f11(spark, sf):
    rows = segments(spark, sf).withColumn("session", F.col("unit") % 10)
    return camera_event_align(rows, "session", "unit", "start", HOUR // 4).select("session", "unit", "event", "common")


def best_shift(pulses: DataFrame, video: DataFrame, keys: list[str], number: str, count: str, most: int) -> DataFrame:
    """(keys, shift, cost): of the shifts 0..most of the pulse list along the video list the one with the least sum of absolute differences; ties: the smaller."""
    shifted = pulses.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("_n", F.col(number) + F.col("_s"))
    other = video.select(*keys, F.col(number).alias("_n"), F.col(count).alias("_c"))
    cost = shifted.join(other, [*keys, "_n"], "left").groupBy(*keys, "_s").agg(F.sum(F.abs(F.col(count) - F.coalesce("_c", F.lit(0)))).alias("cost"))
    return cost.groupBy(*keys).agg(F.min(F.struct("cost", "_s")).alias("b")).select(*keys, F.col("b._s").cast("long").alias("shift"), F.col("b.cost").alias("cost"))


@BOOK.add(
    "f12_count_align",
    f"WITH {EVENTS}, v AS (SELECT unit, event, n FROM segments), p AS (SELECT unit, event - 2 AS event, n FROM segments WHERE event > 2), c AS (SELECT p.unit, s.s, sum(abs(p.n - coalesce(v.n, 0))) AS cost FROM p, (SELECT unnest(range(0, 5)) AS s) s LEFT JOIN v ON v.unit = p.unit AND v.event = p.event + s.s GROUP BY p.unit, s.s) "
    "SELECT unit, arg_min(s, cost * 100 + s)::BIGINT AS shift, min(cost)::BIGINT AS cost FROM c GROUP BY unit",
)
def _f12(spark, sf):
    video = segments(spark, sf).select("unit", "event", "n")
    pulses = video.where("event > 2").withColumn("event", F.col("event") - 2)
    return best_shift(pulses, video, ["unit"], "event", "n", 4)


def best_lag(a: DataFrame, b: DataFrame, keys: list[str], frame: str, value: str, most: int) -> DataFrame:
    """(keys, lag, rmse): the shift -most..most-1 of b with the lowest RMSE after both means on the overlap are taken off."""
    moved = b.select(*keys, F.explode(F.sequence(F.lit(-most), F.lit(most - 1))).alias("lag"), F.col(frame).alias("_f"), F.col(value).alias("_b")).withColumn(frame, F.col("_f") + F.col("lag")).drop("_f")
    stats = a.join(moved, [*keys, frame]).groupBy(*keys, "lag").agg(F.sqrt(F.var_pop(F.col(value) - F.col("_b"))).alias("rmse"))
    return stats.groupBy(*keys).agg(F.min(F.struct(F.round("rmse", 5).alias("rmse"), "lag")).alias("m")).select(*keys, F.col("m.lag").cast("long").alias("lag"), "m.rmse")


@BOOK.add(
    "f13_best_lag_align",
    f"WITH {POSE}, m AS (SELECT a.event, l AS lag, round(stddev_pop(a.y - b.y), 5) AS rmse FROM pose a JOIN (SELECT *, unnest(range(-4, 4)) AS l FROM pose WHERE marker = 'view') b ON a.event = b.event AND a.frame = b.frame + l WHERE a.marker = 'click' GROUP BY a.event, l) "
    "SELECT event, arg_min(lag, (rmse, lag)) AS lag, min(rmse) AS rmse FROM m GROUP BY event",
)
def _f13(spark, sf):
    rows = pose(spark, sf)
    pick = lambda m: rows.where(F.col("marker") == m).select("event", "frame", "y")
    return best_lag(pick("click"), pick("view"), ["event"], "frame", "y", 4)


VEC = "x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS k FROM embeddings), centres AS (SELECT label, k, avg(v) AS c FROM x GROUP BY label, k)"


def centres(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, vector): mean vector per label, averaged item by item."""
    items = df.select(label, F.posexplode(vector).alias("k", "v")).groupBy(label, "k").agg(F.avg(F.col("v").cast("double")).alias("c"))
    return items.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda s: s["c"]).alias(vector))


def spike_pairs(a: DataFrame, b: DataFrame, keys: list[str], time: str, most: int, keep: list[str] | None = None) -> DataFrame:
    """(keys, t_a, t_b): pairs at most `most` apart; b is listed in the three buckets around it, so it is an equi join. Columns of keep come along as <name>_a and <name>_b from the sides that have them."""
    bucket = lambda c: F.floor(F.col(c) / (most + 1))
    more = lambda df, side: [F.col(c).alias(f"{c}_{side}") for c in keep or [] if c in df.columns]
    left = a.select(*keys, F.col(time).alias("t_a"), *more(a, "a")).withColumn("_k", bucket("t_a"))
    right = b.select(*keys, F.col(time).alias("t_b"), *more(b, "b")).withColumn("_k", F.explode(F.array(bucket("t_b") - 1, bucket("t_b"), bucket("t_b") + 1)))
    return left.join(right, [*keys, "_k"]).where(F.abs(F.col("t_a") - F.col("t_b")) <= most).drop("_k")


PAIRS = f"{SPIKES}, trains AS (SELECT unit // 2 AS pair, unit % 2 AS side, t FROM spikes), pairs AS (SELECT a.pair, a.t AS t_a, b.t AS t_b FROM trains a JOIN trains b ON a.pair = b.pair AND abs(a.t - b.t) <= {4 * HOUR} WHERE a.side = 0 AND b.side = 1)"


def train_pairs(spark, sf, most=4 * HOUR) -> DataFrame:
    rows = spikes(spark, sf).select(F.expr("unit div 2").alias("pair"), (F.col("unit") % 2).alias("side"), "t")
    return spike_pairs(rows.where("side = 0"), rows.where("side = 1"), ["pair"], "t", most)


@BOOK.add("f15_spike_pair_band_join", f"WITH {PAIRS} SELECT * FROM pairs")
def _f15(spark, sf):
    return train_pairs(spark, sf)


def near_duplicates(df: DataFrame, time: str, place: str, size: str, key: str, most: int, reach: float) -> DataFrame:
    """(key) of events with another within most in time and reach in place that is larger, or as large and earlier."""
    cut = df.select(F.col(key).alias("k"), F.col(time).alias("t"), F.col(place).alias("p"), F.col(size).alias("s")).withColumn("_b", F.floor(F.col("t") / (most + 1)))
    other = cut.select(*(F.col(c).alias(f"{c}2") for c in "ktps"), F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)).alias("_b"))
    larger = (F.col("s2") > F.col("s")) | ((F.col("s2") == F.col("s")) & (F.struct("t2", "k2") < F.struct("t", "k")))
    near = (F.abs(F.col("t") - F.col("t2")) <= most) & (F.abs(F.col("p") - F.col("p2")) < reach) & (F.col("k") != F.col("k2"))
    on = (cut["_b"] == other["_b"]) & near & larger
    return cut.join(other, on, "left_semi").select(F.col("k").alias(key))


@BOOK.add("f16_near_duplicates", f"WITH {SPIKES} SELECT spike FROM spikes a WHERE EXISTS (SELECT 1 FROM spikes b WHERE a.spike <> b.spike AND abs(a.t - b.t) <= {HOUR // 12} AND abs(a.unit - b.unit) < 20 AND (b.amplitude > a.amplitude OR (b.amplitude = a.amplitude AND (b.t, b.spike) < (a.t, a.spike))))")
def _f16(spark, sf):
    return near_duplicates(spikes(spark, sf), "t", "unit", "amplitude", "spike", HOUR // 12, 20)


def train_agreement(pairs: DataFrame, a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, matched, miss, false_positive, score) of two trains: events of a with a partner in b, rates of those without, 1 - (fp + miss)."""
    hit = pairs.groupBy(key).agg(F.count_distinct("t_a").alias("ma"), F.count_distinct("t_b").alias("mb"))
    sizes = a.groupBy(key).agg(F.count("*").alias("na")).join(b.groupBy(key).agg(F.count("*").alias("nb")), key)
    rows = sizes.join(hit, key, "left").select(key, F.coalesce("ma", F.lit(0)).alias("matched"), (1 - F.coalesce("ma", F.lit(0)) / F.col("na")).alias("miss"), (1 - F.coalesce("mb", F.lit(0)) / F.col("nb")).alias("false_positive"))
    return rows.withColumn("score", 1 - (F.col("miss") + F.col("false_positive")))


AGREE = f"{PAIRS}, h AS (SELECT pair, count(DISTINCT t_a) AS ma, count(DISTINCT t_b) AS mb FROM pairs GROUP BY pair), n AS (SELECT pair, count(*) FILTER (side = 0) AS na, count(*) FILTER (side = 1) AS nb FROM trains GROUP BY pair HAVING count(*) FILTER (side = 0) > 0 AND count(*) FILTER (side = 1) > 0), agree AS (SELECT pair, coalesce(ma, 0) AS matched, 1 - coalesce(ma, 0) / na AS miss, 1 - coalesce(mb, 0) / nb AS false_positive FROM n LEFT JOIN h USING (pair))"


def agreement(spark, sf) -> DataFrame:
    rows = spikes(spark, sf).select(F.expr("unit div 2").alias("pair"), (F.col("unit") % 2).alias("side"), "t")
    return train_agreement(train_pairs(spark, sf), rows.where("side = 0"), rows.where("side = 1"), "pair")


@BOOK.add("f17_train_agreement", f"WITH {AGREE} SELECT pair, matched, round(miss, 5) AS miss, round(false_positive, 5) AS false_positive, round(1 - (miss + false_positive), 5) AS score FROM agree")
def _f17(spark, sf):
    return agreement(spark, sf).select("pair", "matched", *(F.round(c, 5).alias(c) for c in ("miss", "false_positive", "score")))


def correction_merge(labels: DataFrame, corrected: DataFrame, keys: list[str], least: float = 50.0, wrong_side: Column | None = None) -> DataFrame:
    """labels with corrected x and y where they moved and both exceed least; their likelihood becomes 1. wrong_side: labels of one side that the camera of the other can't see, whose likelihood becomes 0 unless corrected."""
    unseen = F.lit(False) if wrong_side is None else F.coalesce(wrong_side, F.lit(False))
    new = corrected.select(*keys, F.col("x").alias("_x"), F.col("y").alias("_y"))
    moved = F.coalesce((F.col("_x") > least) & (F.col("_y") > least) & ((F.col("_x") != F.col("x")) | (F.col("_y") != F.col("y"))), F.lit(False))
    swap = lambda a, b: F.when(moved, b).otherwise(a)
    return labels.join(new, keys, "left").select(*keys, swap(F.col("x"), F.col("_x")).alias("x"), swap(F.col("y"), F.col("_y")).alias("y"), swap(F.when(unseen, 0.0).otherwise(F.col("likelihood")), F.lit(1.0)).alias("likelihood"))


@BOOK.add(
    "f20_correction_merge",
    f"WITH {POSE}, c AS (SELECT event, marker, frame, CASE WHEN frame % 6 = 0 THEN 0.0 ELSE x + frame % 2 END AS cx, y AS cy FROM pose WHERE frame % 3 = 0), m AS (SELECT p.*, cx, cy, coalesce(cx > 50 AND cy > 50 AND (cx <> x OR cy <> y), false) AS moved FROM pose p LEFT JOIN c USING (event, marker, frame)) "
    "SELECT event, marker, frame, CASE WHEN moved THEN cx ELSE x END AS x, CASE WHEN moved THEN cy ELSE y END AS y, CASE WHEN moved THEN 1.0 WHEN marker = 'view' AND ncams < 2 THEN 0.0 ELSE score END::DOUBLE AS likelihood FROM m",
)
def _f20(spark, sf):
    rows = pose(spark, sf).withColumnRenamed("score", "likelihood")
    corrected = rows.where("frame % 3 = 0").select("event", "marker", "frame", F.when(F.col("frame") % 6 == 0, 0.0).otherwise(F.col("x") + F.col("frame") % 2).alias("x"), "y")
    return correction_merge(rows, corrected, ["event", "marker", "frame"], wrong_side=(F.col("marker") == "view") & (F.col("ncams") < 2))


def insert_manual_labels(predicted: DataFrame, manual: DataFrame, keys: list[str]) -> DataFrame:
    """predicted with the manual x and y where there are such; their likelihood becomes 1."""
    new = manual.select(*keys, F.col("x").alias("_x"), F.col("y").alias("_y"))
    return predicted.join(new, keys, "left").select(*keys, F.coalesce("_x", "x").alias("x"), F.coalesce("_y", "y").alias("y"), F.when(F.col("_x").isNotNull(), 1.0).otherwise(F.col("likelihood")).alias("likelihood"))


@BOOK.add("f21_insert_manual_labels", f"WITH {POSE} SELECT event, marker, frame, CASE WHEN frame % 5 = 0 THEN 9.5 ELSE x END::DOUBLE AS x, CASE WHEN frame % 5 = 0 THEN z ELSE y END::DOUBLE AS y, CASE WHEN frame % 5 = 0 THEN 1.0 ELSE score END::DOUBLE AS likelihood FROM pose")
def _f21(spark, sf):
    rows = pose(spark, sf).withColumnRenamed("score", "likelihood")
    return insert_manual_labels(rows, rows.where("frame % 5 = 0").select("event", "marker", "frame", F.lit(9.5).alias("x"), F.col("z").alias("y")), ["event", "marker", "frame"])


def corrected_frames(original: DataFrame, corrected: DataFrame, keys: list[str], frame: str, width: int, threshold: float) -> DataFrame:
    """(keys, frame) where a label's shift exceeds its running median by more than threshold."""
    from longtrace.operators.sequence import median_filter

    both = original.join(corrected.select(*keys, frame, F.col("x").alias("_x"), F.col("y").alias("_y")), [*keys, frame])
    moved = both.select(*keys, frame, F.sqrt((F.col("x") - F.col("_x")) ** 2 + (F.col("y") - F.col("_y")) ** 2).alias("d"))
    return median_filter(moved, keys, frame, "d", width).where(F.col("d") - F.col("median") > threshold).select(*keys, frame)


@BOOK.add(
    "f22_find_corrected_frames",
    f"WITH {POSE}, d AS (SELECT event, marker, frame, sqrt(pow(z - x, 2)) AS d FROM pose), n AS (SELECT *, list(d) OVER (PARTITION BY event, marker ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS l FROM d) "
    "SELECT event, marker, frame FROM n WHERE d - list_sort(list_concat(l, list_transform(range(0, 5 - len(l)), lambda i: 0.0::DOUBLE)))[3] > 40",
)
def _f22(spark, sf):
    rows = pose(spark, sf).select("event", "marker", "frame", "x", "y", "z")
    return corrected_frames(rows, rows.select("event", "marker", "frame", F.col("z").alias("x"), "y"), ["event", "marker"], "frame", 5, 40)


def broadcast_axis_labels(labels: DataFrame, event: str, frame: str, marker: str, value: str, markers: list[str], share: float) -> DataFrame:
    """(event, frame, marker, value): the labels of the first frame of the lowest event with at least `share` of markers, copied to every frame; what is broadcast is one row for each of `markers` at most."""
    full = labels.where(F.col(value).isNotNull() & F.col(marker).isin(*markers)).groupBy(event, frame).agg(F.count_distinct(marker).alias("n"), F.collect_set(F.struct(marker, value)).alias("set")).where(F.col("n") >= share * len(markers))
    first = full.agg(F.min_by("set", F.struct(event, frame)).alias("set")).select(F.inline("set"))
    return labels.select(event, frame).distinct().join(F.broadcast(first), F.lit(True))


@BOOK.add(
    "f23_broadcast_axis_labels",
    f"WITH {POSE}, q AS (SELECT event, frame, marker, CASE WHEN error <= 60 THEN z END AS z FROM pose WHERE marker IN ('click', 'view', 'cart')), n AS (SELECT event, frame FROM q WHERE z IS NOT NULL GROUP BY event, frame HAVING count(DISTINCT marker) >= 0.49 * 3 ORDER BY event, frame LIMIT 1) "
    "SELECT DISTINCT p.event, p.frame, q.marker, q.z FROM pose p, q JOIN n ON q.event = n.event AND q.frame = n.frame WHERE q.z IS NOT NULL",
)
def _f23(spark, sf):
    rows = pose(spark, sf).select("event", "frame", "marker", F.when(F.col("error") <= 60, F.col("z")).alias("z"))
    return broadcast_axis_labels(rows, "event", "frame", "marker", "z", ["click", "view", "cart"], 0.49)


def existing_key_anti(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key isn't stored yet."""
    return new.join(stored.select(*keys).distinct(), keys, "left_anti")


@BOOK.add("f24_existing_key_anti", f"WITH {EVENTS} SELECT * FROM segments WHERE (unit, start) NOT IN (SELECT unit, start FROM segments WHERE n > 2)")
def _f24(spark, sf):
    rows = segments(spark, sf)
    return existing_key_anti(rows, rows.where("n > 2"), ["unit", "start"])


def break_to_frame(breaks: DataFrame, events: DataFrame, frames: DataFrame, keys: list[str], at: str, time: str, bucket: int) -> DataFrame:
    """(keys, at, event, frame): breaks strictly inside an event and the number of its frames at or before them."""
    inside = band_join(breaks, events.select(*keys, "event", "start", "stop"), keys, at, "start", "stop", bucket).where((F.col(at) > F.col("start")) & (F.col(at) < F.col("stop")))
    inside = inside.select(*keys, at, "event", "start")
    before = band_join(frames.select(*keys, time), inside.select(*keys, F.col("start").alias("_s"), F.col(at).alias("_at")), keys, time, "_s", "_at", bucket)
    counts = before.groupBy(*keys, "_at").agg(F.count("*").alias("frame")).withColumnRenamed("_at", at)
    return inside.join(counts, [*keys, at], "left").select(*keys, at, "event", F.coalesce("frame", F.lit(0)).alias("frame"))


@BOOK.add(
    "f25_break_to_frame",
    f"WITH {BREAKS}, mk AS (SELECT *, sum(new) OVER (PARTITION BY unit ORDER BY t, spike) AS event FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike) <= {6 * HOUR} THEN 0 ELSE 1 END AS new FROM spikes)), sg AS (SELECT unit, event::BIGINT AS event, min(t) AS start, max(t) AS stop FROM mk GROUP BY unit, event) "
    "SELECT b.unit, b.break_start, g.event, (SELECT count(*) FROM spikes s WHERE s.unit = b.unit AND s.t >= g.start AND s.t <= b.break_start) AS frame FROM breaks b JOIN sg g ON b.unit = g.unit AND b.break_start > g.start AND b.break_start < g.stop",
)
def _f25(spark, sf):
    return break_to_frame(_d3(spark, sf).select("unit", "break_start"), segments(spark, sf), spikes(spark, sf), ["unit"], "break_start", "t", 24 * HOUR)


@BOOK.add("f26_window_around_time", f"WITH {SIGNAL} SELECT a.channel, a.i AS centre, b.i, b.v FROM signal a JOIN signal b ON a.channel = b.channel AND b.t BETWEEN a.t - {2 * HOUR} AND a.t + {2 * HOUR} WHERE a.v > 200")
def _f26(spark, sf):
    rows = signal(spark, sf)
    around = rows.where("v > 200").select("channel", F.col("i").alias("centre"), (F.col("t") - 2 * HOUR).alias("lo"), (F.col("t") + 2 * HOUR).alias("hi"))
    return band_join(rows, around, ["channel"], "t", "lo", "hi", 12 * HOUR).select("channel", "centre", "i", "v")


