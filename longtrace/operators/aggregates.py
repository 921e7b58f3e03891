"""Counts, rates, histograms and audits (inventory group G)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longtrace.functions.carry import carried
from longtrace.functions.few import with_each
from longtrace.operators.joins import PAIRS, VEC, centres, spike_pairs, train_pairs
from longtrace.operators.sequence import CHUNK, DAYS30, DROPOUT, EVENTS, GAPS, HOUR, REACH, _d29, dropouts, frame_gaps, segment_events, segments
from longtrace.plans.standins import EV, FRAMES, POSE, SIGNAL, SPIKES, Book, events, frames, pose, signal, spikes
from longtrace.session import written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
UP = Window.unboundedPreceding


def bin_spikes(df: DataFrame, keys: list[str], time: str, start: int, stop: int, width: int, binary: bool = False) -> DataFrame:
    """(keys, bin, n): events per bin of [start, stop), empty bins included; the last whole bin takes its right edge."""
    bins = (stop - start) // width
    inside = df.where((F.col(time) >= start) & (F.col(time) <= start + bins * width))
    counts = inside.groupBy(*keys, F.least(F.floor((F.col(time) - start) / width), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("_n"))
    grid = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    n = F.coalesce("_n", F.lit(0))
    return grid.join(counts, [*keys, "bin"], "left").select(*keys, "bin", (F.least(n, F.lit(1)) if binary else n).cast("long").alias("n"))


_BINS = f"{SPIKES}, c AS (SELECT unit, least(t // {24 * HOUR}, 29) AS bin, count(*) AS n FROM spikes WHERE t >= 0 AND t <= {DAYS30} GROUP BY 1, 2), bins AS (SELECT u.unit, b.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT unit FROM spikes) u CROSS JOIN (SELECT unnest(range(0, 30)) AS bin) b LEFT JOIN c ON c.unit = u.unit AND c.bin = b.bin)"


def day_bins(spark, sf) -> DataFrame:
    return bin_spikes(spikes(spark, sf), ["unit"], "t", 0, DAYS30, 24 * HOUR)


@BOOK.add("g1_bin_spikes", f"WITH {_BINS} SELECT * FROM bins")
def _g1(spark, sf):
    return day_bins(spark, sf)


def population_activity(binned: DataFrame) -> DataFrame:
    """(bin, n, active): sum over units."""
    return binned.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("active", F.col("n") > 0)


@BOOK.add("g2_population_activity", f"WITH {_BINS} SELECT bin, sum(n)::BIGINT AS n, sum(n) > 0 AS active FROM bins GROUP BY bin")
def _g2(spark, sf):
    return population_activity(day_bins(spark, sf))


def dropout_fraction(binned: DataFrame, keys: list[str]) -> DataFrame:
    return binned.groupBy(*keys).agg(F.round(F.avg((F.col("n") == 0).cast("double")), 8).alias("fraction"))


@BOOK.add("g3_dropout_fraction", f"WITH {_BINS} SELECT unit, round(avg((n = 0)::INT), 8) AS fraction FROM bins GROUP BY unit")
def _g3(spark, sf):
    return dropout_fraction(day_bins(spark, sf), ["unit"])


def duration_histogram(df: DataFrame, keys: list[str], value: str, width: int, bins: int) -> DataFrame:
    """(keys, bin, n) of values in [0, width * bins)."""
    number = F.floor(F.col(value) / width)
    return df.where((F.col(value) >= 0) & (number < bins)).groupBy(*keys, number.alias("bin")).agg(F.count("*").alias("n"))


@BOOK.add("g4_duration_histogram", f"WITH {DROPOUT} SELECT grp, (stop_time - start_time) // {HOUR} AS bin, count(*) AS n FROM dropout WHERE (stop_time - start_time) // {HOUR} < 50 GROUP BY 1, 2")
def _g4(spark, sf):
    return duration_histogram(dropouts(spark, sf), ["grp"], "drop_duration", HOUR, 50)


def event_frame_counts(df: DataFrame, event: str, cam: str) -> DataFrame:
    """(event, cam, n): frames of every pair of an event and a camera seen anywhere; NULL where there are none."""
    grid = with_each(df.select(event).distinct(), df.select(cam).distinct())
    return grid.join(df.groupBy(event, cam).agg(F.count("*").alias("n")), [event, cam], "left")


FC = f"{FRAMES}, odd AS (SELECT f.* FROM frames f JOIN (SELECT event, cam FROM frames GROUP BY 1, 2 HAVING count(*) >= 44) USING (event, cam)), counts AS (SELECT e.event, c.cam, count(o.event) AS k FROM (SELECT DISTINCT event FROM odd) e CROSS JOIN (SELECT DISTINCT cam FROM odd) c LEFT JOIN odd o ON o.event = e.event AND o.cam = c.cam GROUP BY 1, 2)"


def odd_frames(spark, sf) -> DataFrame:
    """Frames of cameras that ran: one with under 44 frames of an event has none."""
    rows = frames(spark, sf)
    return rows.join(rows.groupBy("event", "cam").agg(F.count("*").alias("_n")).where("_n >= 44").drop("_n"), ["event", "cam"], "left_semi")


@BOOK.add("g5_event_frame_counts", f"WITH {FC} SELECT event, cam, nullif(k, 0) AS n FROM counts")
def _g5(spark, sf):
    return event_frame_counts(odd_frames(spark, sf), "event", "cam")


def pulse_counts(pulses: DataFrame, counts: DataFrame, event: str, time: str) -> DataFrame:
    """(event, pulses, kept, surplus, end_time): pulses beyond the largest camera count are cut; end_time is the last kept."""
    most = counts.groupBy(event).agg(F.max("n").alias("_m"))
    w = Window.partitionBy(event).orderBy(time)
    ranked = pulses.withColumn("_k", F.row_number().over(w)).join(most, event)
    return ranked.groupBy(event).agg(F.count("*").alias("pulses"), F.count_if(F.col("_k") <= F.col("_m")).alias("kept"), F.max(F.when(F.col("_k") <= F.col("_m"), F.col(time))).alias("end_time")).withColumn("surplus", F.col("pulses") - F.col("kept"))


@BOOK.add(
    "g6_pulse_counts",
    f"WITH {FC}, m AS (SELECT event, max(k) AS m FROM counts GROUP BY event), r AS (SELECT user_id // 4 AS event, t, row_number() OVER (PARTITION BY user_id // 4 ORDER BY t) AS k FROM ev WHERE event_type = 'click') "
    "SELECT event, count(*) AS pulses, count(*) FILTER (k <= m) AS kept, max(t) FILTER (k <= m) AS end_time, count(*) FILTER (k > m) AS surplus FROM r JOIN m USING (event) GROUP BY event",
)
def _g6(spark, sf):
    pulses = events(spark, sf).where("event_type = 'click'").select(F.expr("user_id div 4").alias("event"), "t")
    return pulse_counts(pulses, event_frame_counts(odd_frames(spark, sf), "event", "cam"), "event", "t")


def event_info(events: DataFrame, sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Events with their session's columns and the time to the next event of the key."""
    gap = F.lead("start").over(Window.partitionBy(*keys).orderBy("start")) - F.col("stop")
    return events.withColumn("to_next", gap).join(sessions, keys, "left")


@BOOK.add("g7_event_info", f"WITH {EVENTS} SELECT unit, event, start, stop, n, lead(start) OVER (PARTITION BY unit ORDER BY start) - stop AS to_next, s_name AS session FROM segments LEFT JOIN supplier ON s_suppkey = unit")
def _g7(spark, sf):
    sessions = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("unit"), F.col("s_name").alias("session"))
    return event_info(segments(spark, sf), sessions, ["unit"])


def spurious_sessions(events: DataFrame, session: str, least_events: int, least_length: int) -> DataFrame:
    """Sessions to drop: none, one or two events that are all shorter than least_length, or fewer than least_events events."""
    length = F.col("stop") - F.col("start")
    stats = events.groupBy(session).agg(F.count("*").alias("n"), F.max(length).alias("longest"))
    return stats.where(((F.col("n") <= 2) & (F.col("longest") < least_length)) | (F.col("n") < least_events))


@BOOK.add("g8_spurious_sessions", f"WITH {EVENTS} SELECT unit, count(*) AS n, max(stop - start) AS longest FROM segments GROUP BY unit HAVING (count(*) <= 2 AND max(stop - start) < {HOUR}) OR count(*) < 36")
def _g8(spark, sf):
    return spurious_sessions(segments(spark, sf), "unit", 36, HOUR)


def dropped_sessions(events: DataFrame, expected: DataFrame, keys: list[str], session: str, kind: str, least_length: int, least_apparatus: int = 5) -> DataFrame:
    """(keys, session, rule): sessions that count as spurious, and the first rule that says so.

    kind: `free` or `apparatus`, the channel of an event. 1: no free event, or one or
    two that are all shorter than least_length. 2, where more than one session is left:
    more than one free event but fewer than least_apparatus on the apparatus. 3, where
    more than one is still left: not the only one with at least the expected events on
    the apparatus (expected: keys, expected). Sessions are few rows, events are counted
    before they meet.
    """
    length, free = F.col("stop") - F.col("start"), F.col(kind) == "free"
    stats = events.groupBy(*keys, session).agg(F.count_if(free).alias("_f"), F.max(F.when(free, length)).alias("_longest"), F.count_if(~free).alias("_a")).join(expected, keys, "left")
    one = (F.col("_f") == 0) | ((F.col("_f") <= 2) & (F.col("_longest") < least_length))
    w = Window.partitionBy(*keys)
    first = stats.withColumn("_1", one).withColumn("_left", F.count_if(~F.col("_1")).over(w))
    second = first.withColumn("_2", (F.col("_left") > 1) & ~F.col("_1") & (F.col("_f") > 1) & (F.col("_a") < least_apparatus)).withColumn("_left", F.count_if(~F.col("_1") & ~F.col("_2")).over(w))
    full = F.coalesce(F.col("_a") >= F.col("expected"), F.lit(False))
    third = second.withColumn("_full", full).withColumn("_3", (F.col("_left") > 1) & (F.count_if("_full").over(w) == 1) & ~F.col("_full"))
    return third.select(*keys, session, F.when(F.col("_1"), 1).when(F.col("_2"), 2).when(F.col("_3"), 3).alias("rule")).where("rule is not null")


_KINDS = (
    f"{EV}, kinds AS (SELECT user_id // 5 AS recording, user_id AS session, CASE WHEN event_type IN ('click', 'view') THEN 'free' ELSE 'apparatus' END AS kind, t, event_id FROM ev WHERE value > 60), "
    f"mk AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY recording, session, kind ORDER BY t, event_id) <= {6 * HOUR} THEN 0 ELSE 1 END AS new FROM kinds), "
    "sg AS (SELECT recording, session, kind, min(t) AS start, max(t) AS stop FROM (SELECT *, sum(new) OVER (PARTITION BY recording, session, kind ORDER BY t, event_id) AS g FROM mk) GROUP BY recording, session, kind, g)"
)


@BOOK.add(
    "g8b_dropped_sessions",
    f"WITH {_KINDS}, st AS (SELECT recording, session, count(*) FILTER (kind = 'free') AS f, max(stop - start) FILTER (kind = 'free') AS longest, count(*) FILTER (kind <> 'free') AS a FROM sg GROUP BY 1, 2), "
    f"r1 AS (SELECT *, f = 0 OR (f <= 2 AND longest < {2 * HOUR}) AS one FROM st), r2 AS (SELECT *, NOT one AND f > 1 AND a < 14 AND count(*) FILTER (NOT one) OVER (PARTITION BY recording) > 1 AS two FROM r1), "
    "r3 AS (SELECT *, a < 19 AND count(*) FILTER (NOT one AND NOT two) OVER (PARTITION BY recording) > 1 AND count(*) FILTER (a >= 19) OVER (PARTITION BY recording) = 1 AS three FROM r2) "
    "SELECT recording, session, CASE WHEN one THEN 1 WHEN two THEN 2 ELSE 3 END AS rule FROM r3 WHERE one OR two OR three",
)
def _g8b(spark, sf):
    kind = F.when(F.col("event_type").isin("click", "view"), "free").otherwise("apparatus")
    rows = events(spark, sf).where("value > 60").select(F.expr("user_id div 5").alias("recording"), F.col("user_id").alias("session"), kind.alias("kind"), "t")
    found = segment_events(rows, ["recording", "session", "kind"], "t", 6 * HOUR, CHUNK)
    expected = found.select("recording").distinct().withColumn("expected", F.lit(19))
    return dropped_sessions(found, expected, ["recording"], "session", "kind", 2 * HOUR, 14)


def event_lengths(df: DataFrame, keys: list[str], number: str, time: str) -> DataFrame:
    """(keys, n, last_frame, length): length from the first to the last frame's time."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.max_by(number, time).alias("last_frame"), (F.max(time) - F.min(time)).alias("length"))


@BOOK.add("g9_event_lengths", f"WITH {FRAMES} SELECT event, cam, count(*) AS n, max(frame_no) AS last_frame, max(t) - min(t) AS length FROM frames GROUP BY event, cam")
def _g9(spark, sf):
    return event_lengths(frames(spark, sf), ["event", "cam"], "frame_no", "t")


def candidate_ends(fragments: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, event, to_start, off): time from the key's first start to each fragment's end, and how far that is from the reference length."""
    first = F.min("start").over(Window.partitionBy(*keys))
    rows = fragments.withColumn("to_start", F.col("stop") - first)
    return rows.join(reference, keys).select(*keys, "event", "to_start", F.abs(F.col("to_start") - F.col("length")).alias("off"))


@BOOK.add("g10_candidate_event_ends", f"WITH {EVENTS} SELECT unit, event, stop - min(start) OVER (PARTITION BY unit) AS to_start, abs(stop - min(start) OVER (PARTITION BY unit) - {100 * HOUR}) AS off FROM segments")
def _g10(spark, sf):
    rows = segments(spark, sf)
    return candidate_ends(rows, rows.select("unit").distinct().withColumn("length", F.lit(100 * HOUR)), ["unit"])


def unit_rates(df: DataFrame, keys: list[str], time: str, refractory: int, chunk: int = HOUR) -> DataFrame:
    """(keys, n, rate, violations, isi_violation_rate): rate per unit of time from first to last event; violations: intervals below refractory."""
    gaps = carried(df.select(*keys, F.col(time).alias("_t")), keys, "_t", chunk, lag={"_b": F.col("_t")}).withColumn("_i", F.col("_t") - F.col("_b"))
    stats = gaps.groupBy(*keys).agg(F.count("*").alias("n"), (F.max("_t") - F.min("_t")).alias("_d"), F.count_if(F.col("_i") < refractory).alias("violations"))
    rate = F.when(F.col("_d") > 0, F.col("n") / F.col("_d"))
    return stats.select(*keys, "n", rate.alias("rate"), "violations", (F.col("violations") / (2 * F.col("n") * refractory) / rate).alias("isi_violation_rate"))


_RATES = f"{SPIKES}, i AS (SELECT unit, t, t - lag(t) OVER (PARTITION BY unit ORDER BY t) AS i FROM spikes), rates AS (SELECT unit, count(*) AS n, max(t) - min(t) AS d, count(*) FILTER (i < {HOUR}) AS violations FROM i GROUP BY unit)"


@BOOK.add("g11_firing_rate", f"WITH {_RATES} SELECT unit, n, CASE WHEN d > 0 THEN round(n * {float(24 * HOUR)} / d, 5) END AS per_day FROM rates")
def _g11(spark, sf):
    return unit_rates(spikes(spark, sf), ["unit"], "t", HOUR, CHUNK).select("unit", "n", F.round(F.col("rate") * float(24 * HOUR), 5).alias("per_day"))


@BOOK.add("g12_isi_violation_rate", f"WITH {_RATES} SELECT unit, violations, CASE WHEN d > 0 THEN round((violations / (2.0 * n * {HOUR})) / (n / d), 5) END AS isi_violation_rate FROM rates")
def _g12(spark, sf):
    return unit_rates(spikes(spark, sf), ["unit"], "t", HOUR, CHUNK).select("unit", "violations", F.round("isi_violation_rate", 5).alias("isi_violation_rate"))


def snr(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, snr): mean absolute amplitude over the median absolute deviation / 0.6745; two aggregates joined by key."""
    mid = df.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("_m"))
    stats = df.join(mid, keys).groupBy(*keys).agg(F.avg(F.abs(value)).alias("_a"), F.percentile(F.abs(F.col(value) - F.col("_m")), F.lit(0.5)).alias("_d"))
    return stats.select(*keys, F.when(F.col("_d") > 0, F.col("_a") / (F.col("_d") / 0.6745)).alias("snr"))


@BOOK.add("g13_snr", f"WITH {SPIKES}, m AS (SELECT unit, quantile_cont(amplitude, 0.5) AS m FROM spikes GROUP BY unit), d AS (SELECT unit, avg(abs(amplitude)) AS a, quantile_cont(abs(amplitude - m), 0.5) AS d FROM spikes JOIN m USING (unit) GROUP BY unit) SELECT unit, CASE WHEN d > 0 THEN round(a / (d / 0.6745), 5) END AS snr FROM d")
def _g13(spark, sf):
    return snr(spikes(spark, sf), ["unit"], "amplitude").withColumn("snr", F.round("snr", 5))


def noise_threshold(df: DataFrame, keys: list[str], value: str, factor: float = 5.0) -> DataFrame:
    return df.groupBy(*keys).agg((F.percentile(F.abs(value), F.lit(0.5)) * factor / 0.6745).alias("threshold"))


@BOOK.add("g14_noise_threshold", f"WITH {SIGNAL} SELECT channel, round(5.0 * quantile_cont(abs(v), 0.5) / 0.6745, 4) AS threshold FROM signal GROUP BY channel")
def _g14(spark, sf):
    return noise_threshold(signal(spark, sf), ["channel"], "v").withColumn("threshold", F.round("threshold", 4))


def cross_correlogram(pairs: DataFrame, key: str, bins: int, width: int) -> DataFrame:
    """(key, bin, n) for bins -bins..bins of width, nearest bin, halves away from zero; empty bins included."""
    d = F.col("t_b") - F.col("t_a")
    number = F.signum(d) * F.floor((F.abs(d) + width // 2) / width)
    counts = pairs.groupBy(key, number.cast("long").alias("bin")).agg(F.count("*").alias("_n"))
    grid = pairs.select(key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(-bins).cast("long"), F.lit(bins).cast("long"))))
    return grid.join(counts, [key, "bin"], "left").select(key, "bin", F.coalesce("_n", F.lit(0)).alias("n"))


CCG = f"{PAIRS}, c AS (SELECT pair, (sign(t_b - t_a) * ((abs(t_b - t_a) + {HOUR // 2}) // {HOUR}))::BIGINT AS bin, count(*) AS n FROM pairs GROUP BY 1, 2), ccg AS (SELECT p.pair, b.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT pair FROM pairs) p CROSS JOIN (SELECT unnest(range(-4, 5)) AS bin) b LEFT JOIN c ON c.pair = p.pair AND c.bin = b.bin)"


@BOOK.add("g15_cross_correlogram", f"WITH {CCG} SELECT * FROM ccg")
def _g15(spark, sf):
    return cross_correlogram(train_pairs(spark, sf), "pair", 4, HOUR)


@F.pandas_udf(T.DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    return z.map(lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2))))


def refractory_scores(ccg: DataFrame, sizes: DataFrame, key: str, bins: int, width: int, widths: int = 10) -> DataFrame:
    """(key, i, q00, q01, q, r) for i = 1..widths from a correlogram of bins -bins..bins of width.

    sizes: (key, n_a, n_b, length of the recording). Rates are relative to those of
    independent trains: q00 of the outer halves, q01 of the larger near shoulder
    (10 to 50 bins off), q of the i bins either way of zero, itself left out. r:
    chance of so few there if they came at the largest of the shoulder rates
    (normal approximation); NULL if the shoulders are empty.
    """
    b, n = F.col("bin"), F.col("n")
    outer = b.between(1 - bins, -(bins // 2) - 1) | b.between(bins // 2, bins - 1)
    mean = lambda where: F.avg(F.when(where, n))
    near = [F.sum(F.when((F.abs(b) <= i) & (b != 0), n)) for i in range(1, widths + 1)]
    stats = ccg.groupBy(key).agg(mean(outer).alias("_o"), F.greatest(mean(b.between(-50, -10)), mean(b.between(11, 49))).alias("_s"), F.array(*near).alias("_near")).join(sizes, key)
    expected = width * F.col("n_a") * F.col("n_b") / F.col("length")
    rows = stats.select(key, F.col("_o").alias("_outer"), F.greatest("_o", "_s").alias("_base"), expected.alias("_e"), F.col("_s").alias("_shoulder"), F.posexplode("_near").alias("_i", "_c")).withColumn("i", F.col("_i") + 1)
    lam = F.col("_base") * F.col("i")
    z = (F.col("_c") / 2 - lam) / F.sqrt(F.when(lam > 0, lam))
    return rows.select(key, "i", (F.col("_outer") / F.col("_e")).alias("q00"), (F.col("_shoulder") / F.col("_e")).alias("q01"), (F.col("_c") / (2 * F.col("i") * F.col("_e"))).alias("q"), normal_cdf(z).alias("r"))


def phi_sql(z: str) -> str:
    """The normal distribution function in SQL: the all-positive series of the error function."""
    x = f"greatest(abs({z}) / sqrt(2), 1e-12)"
    series = f"2 / sqrt(pi()) * exp(-{x} * {x}) * list_sum(list_transform(range(0, 140), lambda j: exp(2 * j * ln(2) + (2 * j + 1) * ln({x}) + lgamma(j + 1) - lgamma(2 * j + 2))))"
    return f"(0.5 * (1 + sign({z}) * CASE WHEN {x} > 6 THEN 1 ELSE {series} END))"


WIDTH, BINS = HOUR // 3, 60
WIDE = f"{SPIKES}, trains AS (SELECT unit // 2 AS pair, unit % 2 AS side, t FROM spikes), pairs AS (SELECT a.pair, a.t AS t_a, b.t AS t_b FROM trains a JOIN trains b ON a.pair = b.pair AND abs(a.t - b.t) <= {BINS * WIDTH} WHERE a.side = 0 AND b.side = 1), c AS (SELECT pair, (sign(t_b - t_a) * ((abs(t_b - t_a) + {WIDTH // 2}) // {WIDTH}))::BIGINT AS bin, count(*) AS n FROM pairs GROUP BY 1, 2), ccg AS (SELECT p.pair, b.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT pair FROM pairs) p CROSS JOIN (SELECT unnest(range(-{BINS}, {BINS + 1})) AS bin) b LEFT JOIN c ON c.pair = p.pair AND c.bin = b.bin), sizes AS (SELECT pair, count(*) FILTER (side = 0) AS n_a, count(*) FILTER (side = 1) AS n_b, max(t) - min(t) AS length FROM trains GROUP BY pair)"


@BOOK.add(
    "g16_refractory_scores",
    f"WITH {WIDE}, s AS (SELECT pair, avg(n) FILTER (bin BETWEEN {1 - BINS} AND {-(BINS // 2) - 1} OR bin BETWEEN {BINS // 2} AND {BINS - 1}) AS o, greatest(avg(n) FILTER (bin BETWEEN -50 AND -10), avg(n) FILTER (bin BETWEEN 11 AND 49)) AS s FROM ccg GROUP BY pair), "
    f"k AS (SELECT pair, i, sum(n) FILTER (abs(bin) <= i AND bin <> 0) AS c FROM ccg, (SELECT unnest(range(1, 11)) AS i) GROUP BY 1, 2), x AS (SELECT pair, i::INTEGER AS i, o, s.s, c, {float(WIDTH)} * n_a * n_b / length AS e, greatest(o, s.s) * i AS lam FROM k JOIN s USING (pair) JOIN sizes USING (pair)), z AS (SELECT *, (c / 2.0 - lam) / sqrt(CASE WHEN lam > 0 THEN lam END) AS z FROM x) "
    f"SELECT pair, i, round(o / e, 6) AS q00, round(s / e, 6) AS q01, round(c / (2.0 * i * e), 6) AS q, round({phi_sql('z')}, 6) AS r FROM z",
)
def _g16(spark, sf):
    rows = spikes(spark, sf).select(F.expr("unit div 2").alias("pair"), (F.col("unit") % 2).alias("side"), "t")
    sizes = rows.groupBy("pair").agg(F.count_if(F.col("side") == 0).alias("n_a"), F.count_if(F.col("side") == 1).alias("n_b"), (F.max("t") - F.min("t")).alias("length"))
    found = refractory_scores(cross_correlogram(train_pairs(spark, sf, BINS * WIDTH), "pair", BINS, WIDTH), sizes, "pair", BINS, WIDTH)
    return found.select("pair", "i", *(F.round(c, 6).alias(c) for c in ("q00", "q01", "q", "r")))


def contamination_cutoff(df: DataFrame, unit: str, time: str, amplitude: str, levels: list[float], bins: int, width: int, most: float = 0.1, chance: float = 0.05) -> DataFrame:
    """(unit, cutoff, n, good): levels are tried from the highest; the last before a failure is the cutoff.

    A level's events fail if Q, the least rate next to zero over the larger baseline
    of their correlogram, exceeds `most`, or R, the least chance of so few, exceeds
    `chance`, or either is unknown. If the first level's Q is below most / 2, later
    levels may reach twice that Q only, at least most / 10 and at most most / 2.
    """
    listed = F.array(*(F.lit(x) for x in levels))
    reached = lambda x: F.filter(listed, lambda y: y <= x)
    rows = df.where(F.size(reached(F.col(amplitude))) > 0).select(unit, F.col(time).alias("_t"), F.array_max(reached(F.col(amplitude))).alias("_l"))
    at_level = rows.groupBy(unit, "_l").agg(F.count("*").alias("n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    sizes = at_level.select("*", F.explode(reached(F.col("_l"))).alias("level")).groupBy(F.struct(unit, "level").alias("k")).agg(F.sum("n").alias("n_a"), F.sum("n").alias("n_b"), (F.max("_hi") - F.min("_lo")).alias("length"))
    # a pair of events belongs to the levels that both reach: pairs are made and counted once, their counts spread over levels
    pairs = spike_pairs(rows, rows, [unit], "_t", bins * width, ["_l"])
    d = F.col("t_b") - F.col("t_a")
    bin_ = (F.signum(d) * F.floor((F.abs(d) + width // 2) / width)).cast("long")
    counts = pairs.groupBy(unit, F.least("_l_a", "_l_b").alias("_l"), bin_.alias("bin")).agg(F.count("*").alias("n"))
    counts = counts.select("*", F.explode(reached(F.col("_l"))).alias("level")).groupBy(F.struct(unit, "level").alias("k"), "bin").agg(F.sum("n").alias("_n"))
    grid = sizes.select("k", F.explode(F.sequence(F.lit(-bins).cast("long"), F.lit(bins).cast("long"))).alias("bin"))
    ccg = grid.join(counts, ["k", "bin"], "left").select("k", "bin", F.coalesce("_n", F.lit(0)).alias("n"))
    scores = refractory_scores(ccg, sizes.where("length > 0"), "k", bins, width)
    base = F.max(F.greatest("q00", "q01"))
    stats = scores.groupBy("k").agg((F.min("q") / F.when(base > 0, base)).alias("_q"), F.min("r").alias("_r"))
    w = Window.partitionBy(unit).orderBy(F.desc("level"))
    tests = sizes.join(stats, "k", "left").select(f"k.{unit}", "k.level", F.col("n_a").alias("n"), "_q", "_r")
    tests = tests.withColumn("_q0", F.first("_q").over(w)).withColumn("_k", F.row_number().over(w))
    allowed = F.when((F.col("_k") > 1) & (F.col("_q0") < most / 2), F.least(F.lit(most / 2), F.greatest(F.lit(most / 10), 2 * F.col("_q0")))).otherwise(most)
    bad = ~F.coalesce((F.col("_q") <= allowed) & (F.col("_r") <= chance), F.lit(False))
    fine = tests.withColumn("_bad", F.sum(bad.cast("int")).over(w.rowsBetween(UP, 0))).where("_bad = 0")
    best = fine.groupBy(unit).agg(F.min(F.struct("level", "n")).alias("b"))
    return df.select(unit).distinct().join(best, unit, "left").select(unit, F.col("b.level").alias("cutoff"), F.coalesce("b.n", F.lit(0)).alias("n"), F.col("b").isNotNull().alias("good"))


#: Trains of eight users together with a dead time of an hour; events below 20 are kept though they come sooner, as contamination.
TRAINS = (
    f"{EV}, gapped AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id // 8 ORDER BY t, event_id) AS gap FROM ev), "
    f"trains AS (SELECT user_id // 8 AS unit, t, value AS amplitude FROM gapped WHERE gap IS NULL OR gap >= {HOUR} OR value < 20)"
)


def _trains(spark, sf) -> DataFrame:
    rows = events(spark, sf).select(F.expr("user_id div 8").alias("unit"), "t", F.col("event_id").alias("spike"), F.col("value").alias("amplitude"))
    gapped = carried(rows, ["unit"], "t", CHUNK, ["spike"], lag={"_before": F.col("t")})
    return gapped.where(F.col("_before").isNull() | (F.col("t") - F.col("_before") >= HOUR) | (F.col("amplitude") < 20)).select("unit", "t", "amplitude")


@BOOK.add(
    "g17_contamination_cutoff",
    f"WITH {TRAINS}, x AS (SELECT unit, level, t FROM trains JOIN (SELECT unnest([80.0, 60.0, 40.0, 20.0, 10.0]::DOUBLE[]) AS level) l ON amplitude >= level), n AS (SELECT unit, level, count(*) AS n, max(t) - min(t) AS length FROM x GROUP BY 1, 2), "
    f"p AS (SELECT a.unit, a.level, sign(b.t - a.t) * ((abs(b.t - a.t) + {WIDTH // 2}) // {WIDTH}) AS bin FROM x a JOIN x b ON a.unit = b.unit AND a.level = b.level AND abs(a.t - b.t) <= {BINS * WIDTH}), c AS (SELECT unit, level, bin, count(*) AS c FROM p GROUP BY ALL), "
    f"ccg AS (SELECT n.unit, n.level, n.n, n.length, b.bin, coalesce(c, 0) AS c FROM n CROSS JOIN (SELECT unnest(range(-{BINS}, {BINS + 1})) AS bin) b LEFT JOIN c ON c.unit = n.unit AND c.level = n.level AND c.bin = b.bin WHERE length > 0), "
    f"s AS (SELECT unit, level, n, length, avg(c) FILTER (bin BETWEEN {1 - BINS} AND {-(BINS // 2) - 1} OR bin BETWEEN {BINS // 2} AND {BINS - 1}) AS o, greatest(avg(c) FILTER (bin BETWEEN -50 AND -10), avg(c) FILTER (bin BETWEEN 11 AND 49)) AS s FROM ccg GROUP BY ALL), "
    "k AS (SELECT unit, level, i, sum(c) FILTER (abs(bin) <= i AND bin <> 0) AS c FROM ccg, (SELECT unnest(range(1, 11)) AS i) GROUP BY ALL), "
    "z AS (SELECT unit, level, c / (2.0 * i) AS q, nullif(greatest(o, s.s), 0) AS base, (c / 2.0 - greatest(o, s.s) * i) / sqrt(nullif(greatest(o, s.s) * i, 0)) AS z FROM k JOIN s USING (unit, level)), "
    f"g AS (SELECT unit, level, min(q) / max(base) AS q, min({phi_sql('z')}) AS r FROM z GROUP BY 1, 2), "
    "t AS (SELECT n.unit, n.level, n, q, r, first_value(q) OVER w AS q0, row_number() OVER w AS k FROM n LEFT JOIN g USING (unit, level) WINDOW w AS (PARTITION BY n.unit ORDER BY n.level DESC)), "
    "b AS (SELECT *, sum((NOT coalesce(q <= CASE WHEN k > 1 AND q0 < 0.05 THEN least(0.05, greatest(0.01, 2 * q0)) ELSE 0.1 END AND r <= 0.05, false))::INT) OVER (PARTITION BY unit ORDER BY level DESC) AS bad FROM t), "
    "f AS (SELECT unit, min(level) AS cutoff, arg_min(n, level) AS n FROM b WHERE bad = 0 GROUP BY unit) "
    "SELECT u.unit, cutoff, coalesce(n, 0) AS n, cutoff IS NOT NULL AS good FROM (SELECT DISTINCT unit FROM trains) u LEFT JOIN f USING (unit)",
)
def _g17(spark, sf):
    return contamination_cutoff(_trains(spark, sf), "unit", "t", "amplitude", [80.0, 60.0, 40.0, 20.0, 10.0], BINS, WIDTH)


def template_similarity(df: DataFrame, key: str, vector: str, block: int = 1 << 20) -> DataFrame:
    """(a, b, similarity), a < b: cosine of every two templates; those of no length have none.

    Templates are counted first and sent to the tasks in blocks of at most about
    `block` numbers, so each pair is made once, in one of the blocks.
    """
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    sized = df.select(F.col(key).alias("k"), F.col(vector).alias("v"), F.sqrt(dot(F.col(vector), F.col(vector))).alias("s"))
    stats = sized.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, found = max(1, -(-stats["n"] * (stats["d"] or 1) // block)), None
    for k in range(n):
        listed = sized.where(F.pmod(F.xxhash64("k"), F.lit(n)) == k).agg(F.collect_list(F.struct("k", "v", "s")).alias("_l"))
        rows = sized.join(F.broadcast(listed), F.lit(True)).select(F.col("k").alias("a"), "v", "s", F.explode(F.filter("_l", lambda x: x["k"] > F.col("k"))).alias("_b"))
        part = rows.select("a", F.col("_b.k").alias("b"), F.when((F.col("s") > 0) & (F.col("_b.s") > 0), dot(F.col("v"), F.col("_b.v")) / (F.col("s") * F.col("_b.s"))).alias("similarity"))
        found = part if found is None else found.union(part)
    return found


SIM = f"{VEC}, sim AS (SELECT p.label AS a, q.label AS b, sum(p.c * q.c) / (sqrt(sum(p.c * p.c)) * sqrt(sum(q.c * q.c))) AS similarity FROM centres p JOIN centres q ON p.k = q.k AND p.label < q.label GROUP BY 1, 2)"


def templates(spark, sf) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return centres(rows, "label", "embedding")


@BOOK.add("g19_template_similarity", f"WITH {SIM} SELECT a, b, round(similarity, 4) AS similarity FROM sim")
def _g19(spark, sf):
    return template_similarity(templates(spark, sf), "label", "embedding").withColumn("similarity", F.round("similarity", 4))


def unit_spread(energy: DataFrame, unit: str, place: str, value: str, floor: float = 0.1) -> DataFrame:
    """(unit, centre, spread): energy below floor of the unit's largest is zero; weighted centre and root mean square distance from it."""
    top = F.max(value).over(Window.partitionBy(unit))
    w = F.when(F.col(value) >= floor * top, F.col(value)).otherwise(0.0)
    weighed = energy.withColumn("_w", w)
    stats = weighed.groupBy(unit).agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col(place)).alias("wx"), F.sum(F.col("_w") * F.col(place) * F.col(place)).alias("wxx"))
    centre = F.col("wx") / F.col("w")
    return stats.select(unit, centre.alias("centre"), F.sqrt(F.greatest(F.lit(0.0), F.col("wxx") / F.col("w") - centre * centre)).alias("spread"))


@BOOK.add(
    "g20_good_units_spread",
    f"WITH {SPIKES}, e AS (SELECT unit % 20 AS unit, spike % 32 AS place, sum(amplitude * amplitude) AS e FROM spikes GROUP BY 1, 2), w AS (SELECT unit, place, CASE WHEN e >= 0.1 * max(e) OVER (PARTITION BY unit) THEN e ELSE 0 END AS w FROM e) "
    "SELECT unit, round(sum(w * place) / sum(w), 4) AS centre, round(sqrt(greatest(0, sum(w * place * place) / sum(w) - pow(sum(w * place) / sum(w), 2))), 4) AS spread FROM w GROUP BY unit",
)
def _g20(spark, sf):
    rows = spikes(spark, sf)
    energy = rows.groupBy((F.col("unit") % 20).alias("unit"), (F.col("spike") % 32).alias("place")).agg(F.sum(F.col("amplitude") * F.col("amplitude")).alias("e"))
    return unit_spread(energy, "unit", "place", "e").select("unit", F.round("centre", 4).alias("centre"), F.round("spread", 4).alias("spread"))


def good_units(energy: DataFrame, flagged: DataFrame, unit: str, x: str, y: str, value: str, most: float = 100.0, floor: float = 0.1) -> DataFrame:
    """(unit, x, y, distance, good): centre of a unit's energy over places, mean distance from it weighted by energy, and whether that is below most and the unit is flagged; energy below floor of the unit's largest is zero."""
    top = energy.groupBy(unit).agg(F.max(value).alias("_top"))
    weighed = energy.join(top, unit).where(F.col(value) >= floor * F.col("_top"))
    centre = weighed.groupBy(unit).agg(*((F.sum(F.col(c) * F.col(value)) / F.sum(value)).alias(f"_{k}") for k, c in (("x", x), ("y", y))))
    far = F.sqrt((F.col(x) - F.col("_x")) ** 2 + (F.col(y) - F.col("_y")) ** 2)
    spread = weighed.join(centre, unit).groupBy(unit, "_x", "_y").agg((F.sum(far * F.col(value)) / F.sum(value)).alias("distance"))
    known = flagged.select(unit).distinct().withColumn("_flag", F.lit(True))
    return spread.join(known, unit, "left").select(unit, F.col("_x").alias("x"), F.col("_y").alias("y"), "distance", (F.coalesce("_flag", F.lit(False)) & (F.col("distance") < most)).alias("good"))


@BOOK.add(
    "g20b_good_units",
    f"WITH {SPIKES}, e AS (SELECT unit, (spike % 32) % 8 AS x, (spike % 32) // 8 AS y, sum(amplitude * amplitude) AS e FROM spikes GROUP BY ALL), w AS (SELECT * FROM (SELECT *, max(e) OVER (PARTITION BY unit) AS m FROM e) WHERE e >= 0.1 * m), "
    "c AS (SELECT unit, sum(x * e) / sum(e) AS cx, sum(y * e) / sum(e) AS cy FROM w GROUP BY unit), d AS (SELECT w.unit, cx, cy, sum(sqrt(pow(x - cx, 2) + pow(y - cy, 2)) * e) / sum(e) AS d FROM w JOIN c USING (unit) GROUP BY ALL), f AS (SELECT unit FROM spikes GROUP BY unit HAVING count(*) >= 60) "
    "SELECT unit, round(cx, 4) AS x, round(cy, 4) AS y, round(d, 4) AS distance, d < 2.3 AND unit IN (SELECT unit FROM f) AS good FROM d",
)
def _g20b(spark, sf):
    rows = spikes(spark, sf)
    place = F.col("spike") % 32
    energy = rows.groupBy("unit", (place % 8).alias("x"), F.floor(place / 8).alias("y")).agg(F.sum(F.col("amplitude") * F.col("amplitude")).alias("e"))
    flagged = rows.groupBy("unit").agg(F.count("*").alias("n")).where("n >= 60")
    return good_units(energy, flagged, "unit", "x", "y", "e", 2.3).select("unit", *(F.round(c, 4).alias(c) for c in ("x", "y", "distance")), "good")


def ks_normality(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, gap): the largest distance between a feature's empirical distribution and the normal one of its mean and deviation."""
    stats = df.groupBy(key).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.count("*").alias("_n"))
    w = Window.partitionBy(key).orderBy(value)
    rows = df.join(stats.where("_s > 0"), key).select(key, normal_cdf((F.col(value) - F.col("_m")) / F.col("_s")).alias("_c"), F.count("*").over(w.rangeBetween(UP, 0)).alias("_to"), (F.rank().over(w) - 1).alias("_from"), "_n")
    return rows.groupBy(key).agg(F.max(F.greatest(F.abs(F.col("_to") / F.col("_n") - F.col("_c")), F.abs(F.col("_from") / F.col("_n") - F.col("_c")))).alias("gap"))


def features(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.posexplode("embedding").alias("k", "v")).withColumn("v", F.col("v").cast("double"))


def ks_sql(rows: str) -> str:
    """The (k, gap) of rows (k, v) in SQL."""
    return f"""m AS (SELECT k, avg(v) AS m, stddev_samp(v) AS s, count(*) AS n FROM {rows} GROUP BY k),
    c AS (SELECT r.k, n, {phi_sql("((v - m) / s)")} AS c, count(*) OVER (PARTITION BY r.k ORDER BY v RANGE UNBOUNDED PRECEDING) AS hi, rank() OVER (PARTITION BY r.k ORDER BY v) - 1 AS lo FROM {rows} r JOIN m ON m.k = r.k WHERE s > 0),
    gaps AS (SELECT k, max(greatest(abs(hi / n - c), abs(lo / n - c))) AS gap FROM c GROUP BY k)"""


FEATURES = "feat AS (SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS k, unnest(embedding)::DOUBLE AS v FROM embeddings)"


@BOOK.add("g22_ks_normality", f"WITH {FEATURES}, {ks_sql('feat')} SELECT k, round(gap, 6) AS gap FROM gaps")
def _g22(spark, sf):
    return ks_normality(features(spark, sf), "k", "v").withColumn("gap", F.round("gap", 6))


def select_features(df: DataFrame, key: str, value: str, top: int, sd: float = 3.0) -> DataFrame:
    """(key, gap, rank): the features least like a normal distribution after values beyond sd deviations are left out."""
    stats = df.groupBy(key).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    inside = df.join(stats, key).where(F.abs(F.col(value) - F.col("_m")) <= sd * F.col("_s")).select(key, value)
    ranked = ks_normality(inside, key, value).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("gap"), key)))
    return ranked.where(F.col("rank") <= top)


@BOOK.add(
    "g23_select_features",
    f"WITH {FEATURES}, e AS (SELECT k, avg(v) AS a, stddev_samp(v) AS d FROM feat GROUP BY k), inside AS (SELECT feat.k, v FROM feat JOIN e ON e.k = feat.k WHERE abs(v - a) <= 3 * d), {ks_sql('inside')} SELECT k, round(gap, 6) AS gap, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (ORDER BY gap DESC, k) AS rank FROM gaps) WHERE rank <= 10",
)
def _g23(spark, sf):
    return select_features(features(spark, sf), "k", "v", 10).withColumn("gap", F.round("gap", 6))


def knee(gaps: list[float], most: int, least: int, reach: int = 10) -> int:
    """How many of the largest gaps are to be kept: those from the knee on, where the rise over `reach` gaps is above their even share for three gaps in turn; between least and most."""
    a = sorted(gaps)[-most:]
    n = len(a)
    steep = [i for i in range(n - reach + 1) if a[-1] > 0 and (a[i + reach - 1] - a[i]) / a[-1] * n / reach >= 1]
    if len(steep) < 2:
        return least
    step = [y - x for x, y in zip(steep, steep[1:])]
    even = [step[k] == 1 if k in (0, len(step) - 1) else step[k - 1] + step[k] + step[k + 1] == 3 for k in range(len(step))]
    at = next((k for k in range(1, len(step)) if even[k]), None)
    return least if at is None else max(least, min(most, most - (steep[at - 1] + 1 + reach // 2) + 1))


def knee_features(df: DataFrame, key: str, value: str, most: int, least: int, sd: float = 3.0) -> DataFrame:
    """(key, gap, rank) of the features least like a normal distribution, as many as the knee of their gaps says; values beyond sd deviations are left out, and a feature of ten values or fewer counts as normal. What is looked at in one row are the `most` largest gaps."""
    stats = df.groupBy(key).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    inside = df.join(stats, key).where(F.abs(F.col(value) - F.col("_m")) < sd * F.col("_s")).select(key, value)
    sizes = inside.groupBy(key).agg(F.count("*").alias("_n"))
    gaps = df.select(key).distinct().join(ks_normality(inside, key, value), key, "left").join(sizes, key, "left").select(key, F.when(F.col("_n") > 10, F.col("gap")).otherwise(0.0).alias("gap"))
    top = gaps.orderBy(F.desc("gap"), key).limit(most)
    listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("gap")).alias("gap"), F.col(key).alias("k")))).alias("l"))
    inputs = F.udf(lambda rows: knee([-r["gap"] for r in rows], most, least), "int")
    ranked = listed.select(inputs("l").alias("_inputs"), F.posexplode("l").alias("_r", "x")).where("_r < _inputs")
    return ranked.select(F.col("x.k").alias(key), (-F.col("x.gap")).alias("gap"), (F.col("_r") + 1).alias("rank"))


@BOOK.add("g23b_knee_features")
def _g23b(spark, sf):
    return knee_features(features(spark, sf), "k", "v", 40, 10).withColumn("gap", F.round("gap", 6))


def trajectory_rmse(a: DataFrame, b: DataFrame, keys: list[str], frame: str, axes: list[str]) -> DataFrame:
    """(keys, error, normalised, velocity_error, velocity_normalised): mean Euclid error over frames, and over the range of the first trajectory's first axis; the same of the steps between neighbouring frames."""
    other = b.select(*keys, frame, *(F.col(x).alias(f"_{x}") for x in axes))
    d = F.sqrt(sum(((F.col(x) - F.col(f"_{x}")) ** 2 for x in axes), F.lit(0.0)))
    w = Window.partitionBy(*keys).orderBy(frame)
    step = lambda c: F.when(F.col(frame) - F.lag(frame).over(w) == 1, F.col(c) - F.lag(c).over(w))
    rows = a.join(other, [*keys, frame]).select("*", step(axes[0]).alias("_v"), F.sqrt(sum(((step(x) - step(f"_{x}")) ** 2 for x in axes), F.lit(0.0))).alias("_d"))
    range_of = lambda c: F.max(c) - F.min(c)
    stats = rows.groupBy(*keys).agg(F.avg(d).alias("error"), range_of(axes[0]).alias("_r"), F.avg("_d").alias("velocity_error"), range_of("_v").alias("_s"))
    over = lambda c, r: F.when(F.col(r) > 0, F.col(c) / F.col(r))
    return stats.select(*keys, "error", over("error", "_r").alias("normalised"), "velocity_error", over("velocity_error", "_s").alias("velocity_normalised"))


TRAJ = f"{POSE}, traj AS (SELECT a.event, a.frame, a.y AS ay, a.z AS az, b.y AS by_, b.z AS bz FROM pose a JOIN pose b USING (event, frame) WHERE a.marker = 'click' AND b.marker = 'view')"


def two_trajectories(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = pose(spark, sf)
    return tuple(rows.where(F.col("marker") == m).select("event", "frame", "y", "z") for m in ("click", "view"))


@BOOK.add("g24_trajectory_rmse", f"WITH {TRAJ} SELECT event, round(avg(sqrt(pow(ay - by_, 2) + pow(az - bz, 2))), 4) AS error, CASE WHEN max(ay) > min(ay) THEN round(avg(sqrt(pow(ay - by_, 2) + pow(az - bz, 2))) / (max(ay) - min(ay)), 4) END AS normalised, round(avg(sqrt(pow(va - vb, 2) + pow(wa - wb, 2))), 4) AS velocity_error, CASE WHEN max(va) > min(va) THEN round(avg(sqrt(pow(va - vb, 2) + pow(wa - wb, 2))) / (max(va) - min(va)), 4) END AS velocity_normalised FROM (SELECT *, CASE WHEN frame - lag(frame) OVER w = 1 THEN ay - lag(ay) OVER w END AS va, by_ - lag(by_) OVER w AS vb, az - lag(az) OVER w AS wa, bz - lag(bz) OVER w AS wb FROM traj WINDOW w AS (PARTITION BY event ORDER BY frame)) GROUP BY event")
def _g24(spark, sf):
    return trajectory_rmse(*two_trajectories(spark, sf), ["event"], "frame", ["y", "z"]).select("event", *(F.round(c, 4).alias(c) for c in ("error", "normalised", "velocity_error", "velocity_normalised")))


def weighted_stats(df: DataFrame, value: str, weight: str, subsets: dict[str, Column], trials: int, scale: Column) -> DataFrame:
    """(subset, n, mean, sd, se, normalised): weighted mean, deviation, deviation over the root of trials, and weighted mean of value / scale, of overlapping subsets, each row counted once per subset it belongs to, in one pass."""
    tags = F.filter(F.array(*(F.when(c, name) for name, c in subsets.items())), lambda x: x.isNotNull())
    w, x = F.col(weight), F.col(value)
    sums = df.withColumn("subset", F.explode(tags)).groupBy("subset").agg(F.count("*").alias("n"), F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * x * x).alias("wxx"), F.sum(w * x / scale).alias("wxs"))
    mean = F.col("wx") / F.col("w")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("wxx") / F.col("w") - mean * mean))
    return sums.select("subset", "n", mean.alias("mean"), sd.alias("sd"), (sd / trials**0.5).alias("se"), (F.col("wxs") / F.col("w")).alias("normalised"))


@BOOK.add(
    "g25_weighted_stats",
    f"WITH {POSE}, s AS (SELECT unnest(list_filter(['all', CASE WHEN event % 2 = 0 THEN 'even' END, CASE WHEN marker = 'click' THEN 'click' END, CASE WHEN error <= 40 THEN 'good' END], lambda x: x IS NOT NULL)) AS subset, y, score + 0.01 AS w, r FROM pose JOIN (SELECT marker, nullif(max(y) - min(y), 0) AS r FROM pose GROUP BY marker) USING (marker)) "
    "SELECT subset, count(*) AS n, round(sum(w * y) / sum(w), 4) AS mean, round(sqrt(greatest(0, sum(w * y * y) / sum(w) - pow(sum(w * y) / sum(w), 2))), 4) AS sd, round(sqrt(greatest(0, sum(w * y * y) / sum(w) - pow(sum(w * y) / sum(w), 2))) / sqrt(17), 4) AS se, round(sum(w * y / r) / sum(w), 4) AS normalised FROM s GROUP BY subset",
)
def _g25(spark, sf):
    spread = F.max("y") - F.min("y")
    rows = pose(spark, sf).withColumn("w", F.col("score") + 0.01)
    rows = rows.join(rows.groupBy("marker").agg(F.when(spread > 0, spread).alias("r")), "marker")
    subsets = {"all": F.lit(True), "even": F.col("event") % 2 == 0, "click": F.col("marker") == "click", "good": F.col("error") <= 40}
    return weighted_stats(rows, "y", "w", subsets, 17, F.col("r")).select("subset", "n", *(F.round(c, 4).alias(c) for c in ("mean", "sd", "se", "normalised")))


def percent_tracked(df: DataFrame, keys: list[str], good: Column, found: Column) -> DataFrame:
    """(keys, reference, percent): share of good reference rows that were found."""
    return df.groupBy(*keys).agg(F.count_if(good).alias("reference"), F.count_if(good & found).alias("_f")).select(*keys, "reference", F.when(F.col("reference") > 0, 100 * F.col("_f") / F.col("reference")).alias("percent"))


@BOOK.add("g26_percent_tracked", f"WITH {POSE} SELECT event, marker, count(*) FILTER (ncams >= 2) AS reference, CASE WHEN count(*) FILTER (ncams >= 2) > 0 THEN round(100.0 * count(*) FILTER (ncams >= 2 AND error <= 40) / count(*) FILTER (ncams >= 2), 4) END AS percent FROM pose GROUP BY 1, 2")
def _g26(spark, sf):
    return percent_tracked(pose(spark, sf), ["event", "marker"], F.col("ncams") >= 2, F.col("error") <= 40).withColumn("percent", F.round("percent", 4))


def tracked_averages(df: DataFrame, part: str, trajectory: str, good: Column, found: Column) -> DataFrame:
    """(level, key, percent): percent tracked of each part over its trajectories and of each trajectory over its parts, weighted by the number of matching rows."""
    each = df.groupBy(part, trajectory).agg(F.count_if(good).alias("_r"), F.count_if(good & found).alias("_m")).where("_r > 0")
    share = F.sum(100 * F.col("_m") / F.col("_r") * F.col("_m")) / F.when(F.sum("_m") > 0, F.sum("_m"))
    levels = [each.groupBy(F.lit(name).alias("level"), F.col(c).cast("string").alias("key")).agg(share.alias("percent")) for name, c in (("part", part), ("trajectory", trajectory))]
    return levels[0].unionByName(levels[1])


@BOOK.add(
    "g26b_tracked_averages",
    f"WITH {POSE}, e AS (SELECT event, marker, count(*) FILTER (ncams >= 2) AS r, count(*) FILTER (ncams >= 2 AND error <= 40) AS m FROM pose GROUP BY 1, 2 HAVING count(*) FILTER (ncams >= 2) > 0) "
    "SELECT 'part' AS level, marker AS key, round(sum(100.0 * m / r * m) / nullif(sum(m), 0), 4) AS percent FROM e GROUP BY marker UNION ALL SELECT 'trajectory', event::VARCHAR, round(sum(100.0 * m / r * m) / nullif(sum(m), 0), 4) FROM e GROUP BY event",
)
def _g26b(spark, sf):
    return tracked_averages(pose(spark, sf), "marker", "event", F.col("ncams") >= 2, F.col("error") <= 40).withColumn("percent", F.round("percent", 4))


def drift_histogram(df: DataFrame, batch: Column, depth: Column, amplitude: str, step: float = 0.25) -> DataFrame:
    """(batch, depth, level, weight): events per batch, depth and step of log10 amplitude, as log2(1 + n)."""
    level = F.floor(F.log10(amplitude) / step)
    n = df.where(F.col(amplitude) > 0).groupBy(batch.alias("batch"), depth.alias("depth"), level.alias("level")).agg(F.count("*").alias("n"))
    return n.select("batch", "depth", "level", F.log2(1 + F.col("n")).alias("weight"))


DRIFT = f"{SPIKES}, drift AS (SELECT t // {72 * HOUR} AS batch, unit % 16 AS depth, floor(log10(amplitude) / 0.25)::BIGINT AS level, log2(1 + count(*)) AS weight FROM spikes WHERE amplitude > 0 GROUP BY 1, 2, 3)"


def drift(spark, sf) -> DataFrame:
    return drift_histogram(spikes(spark, sf), F.expr(f"t div {72 * HOUR}"), F.col("unit") % 16, "amplitude")


@BOOK.add("g27_drift_histogram", f"WITH {DRIFT} SELECT batch, depth, level, round(weight, 5) AS weight FROM drift")
def _g27(spark, sf):
    return drift(spark, sf).withColumn("weight", F.round("weight", 5))


def drift_shift(hist: DataFrame, depths: int, most: int = 15, rounds: int = 10) -> DataFrame:
    """(batch, shift, fit): how far each batch's histogram must move along its depths 0..depths-1, in a circle, to lie over the others.

    Batches are first held against one in the middle, then against their mean as they
    lie, and moved by the shift -most..most of the largest covariance (of equal ones
    the smallest); shifts add up over rounds, and the last round only measures. The
    histogram and the shifts are written; a round reads the cells once for all shifts,
    against a target of at most a cell for each depth and level. Rounds end early when
    no batch moves.
    """
    cells = written(hist.select("batch", F.pmod("depth", F.lit(depths)).alias("depth"), "level", "weight"), "drift")
    batches = cells.select("batch").distinct()
    n = batches.count()
    middle = batches.orderBy("batch").limit(max(1, min(300, n // 2))).agg(F.max("batch")).first()[0]
    shifts = written(batches.select("batch", F.lit(0).cast("long").alias("shift")), "shifts")
    target, near = cells.where(F.col("batch") == F.lit(middle)), F.pmod(F.col("depth") + F.col("shift"), F.lit(depths))
    for k in range(rounds):
        goal = target.groupBy("depth", "level").agg(F.sum("weight").alias("_w"))
        mean = target.groupBy("level").agg((F.sum("weight") / depths).alias("_m"))
        placed = cells.join(shifts, "batch").select("batch", near.alias("depth"), "level", "weight")
        moved = placed.withColumn("by", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("depth", F.pmod(F.col("depth") + F.col("by"), F.lit(depths)))
        covered = moved.join(goal, ["depth", "level"], "left").join(mean, "level", "left")
        # the mean over depths is taken off the target; taking it off the batch as well changes nothing
        fit = covered.groupBy("batch", "by").agg(F.round(F.sum(F.col("weight") * (F.coalesce("_w", F.lit(0.0)) - F.coalesce("_m", F.lit(0.0)))), 6).alias("fit"))
        best = fit.groupBy("batch").agg(F.max(F.struct("fit", (-F.abs("by")).alias("near"), (-F.col("by")).alias("first"))).alias("b"))
        step = F.lit(0) if k == rounds - 1 else -F.col("b.first")
        done = F.col("b.fit") if k < rounds - 1 else F.col("_f")
        held = best if k < rounds - 1 else best.join(fit.where("by = 0").select("batch", F.col("fit").alias("_f")), "batch")
        result = written(shifts.join(held, "batch").select("batch", (F.col("shift") + step).cast("long").alias("shift"), step.alias("step"), done.alias("fit")), "shifts")
        if k > 0 and result.where("step <> 0").isEmpty():
            break
        shifts = result.select("batch", "shift")
        target = cells.join(shifts, "batch").select(near.alias("depth"), "level", (F.col("weight") / n).alias("weight"))
    return result.select("batch", "shift", "fit")


def _drift_rounds_sql(depths: int, most: int, rounds: int) -> str:
    out = ["cells AS (SELECT batch, depth, level, weight FROM drift)", "nb AS (SELECT count(DISTINCT batch) AS n FROM cells)", "sh0 AS (SELECT DISTINCT batch, 0::BIGINT AS shift FROM cells)", "tg0 AS (SELECT depth, level, weight AS w FROM cells WHERE batch = (SELECT max(batch) FROM (SELECT DISTINCT batch FROM cells ORDER BY batch LIMIT (SELECT greatest(1, least(300, n // 2)) FROM nb))))"]
    pm = lambda x: f"((({x}) % {depths}) + {depths}) % {depths}"
    for k in range(rounds):
        out.append(f"mn{k} AS (SELECT level, sum(w) / {depths} AS m FROM tg{k} GROUP BY level)")
        out.append(f"ft{k} AS MATERIALIZED (SELECT batch, s, round(sum(weight * (coalesce(w, 0) - coalesce(m, 0))), 6) AS fit FROM (SELECT c.batch, s, level, weight, {pm('depth + shift + s')} AS depth FROM cells c JOIN sh{k} USING (batch), range(-{most}, {most + 1}) r(s)) x LEFT JOIN tg{k} USING (depth, level) LEFT JOIN mn{k} USING (level) GROUP BY batch, s)")
        if k < rounds - 1:
            out.append(f"sh{k + 1} AS MATERIALIZED (SELECT batch, shift + arg_max(s, (fit, -abs(s), -s))::BIGINT AS shift FROM ft{k} JOIN sh{k} USING (batch) GROUP BY batch, shift)")
            out.append(f"tg{k + 1} AS MATERIALIZED (SELECT {pm('depth + shift')} AS depth, level, sum(weight / n) AS w FROM cells JOIN sh{k + 1} USING (batch), nb GROUP BY 1, 2)")
    return ", ".join(out)


@BOOK.add("g28_drift_shift", f"WITH {DRIFT}, {_drift_rounds_sql(16, 15, 10)} SELECT batch, shift, fit FROM sh9 JOIN ft9 USING (batch) WHERE s = 0")
def _g28(spark, sf):
    return drift_shift(drift(spark, sf), 16)


def sessions_audit(counts: DataFrame, event: str) -> DataFrame:
    """(event, cams, least, most, agree): whether every camera of the event has as many frames."""
    stats = counts.groupBy(event).agg(F.count("n").alias("cams"), F.min("n").alias("least"), F.max("n").alias("most"), F.count_if(F.col("n").isNull()).alias("_m"))
    return stats.select(event, "cams", "least", "most", ((F.col("least") == F.col("most")) & (F.col("_m") == 0)).alias("agree"))


@BOOK.add("g29_sessions_audit", f"WITH {FC} SELECT event, count(*) FILTER (k > 0) AS cams, min(nullif(k, 0)) AS least, max(k) AS most, min(nullif(k, 0)) = max(k) AND count(*) FILTER (k = 0) = 0 AS agree FROM counts GROUP BY event")
def _g29(spark, sf):
    return sessions_audit(event_frame_counts(odd_frames(spark, sf), "event", "cam"), "event")


def series_audit(counts: DataFrame, series: DataFrame, dropped: DataFrame, dropouts: DataFrame, event: str, group: str) -> DataFrame:
    """(event, timestamps, cams, match, dropped, dropouts): whether every camera has a frame for each timestamp of the event's series, its dropped frames, and the dropout intervals of its group that touch it.

    counts: (event, cam, n); series: (event, group, timestamps, start, stop); dropped:
    (event, dropped); dropouts: (group, start_time, stop_time), held against the events
    of the group alone.
    """
    cams = counts.groupBy(event).agg(F.count("n").alias("cams"), F.min(F.coalesce("n", F.lit(0))).alias("_lo"), F.max(F.coalesce("n", F.lit(0))).alias("_hi"))
    touched = series.select(event, group, "start", "stop").join(dropouts, group).where("start_time <= stop and stop_time >= start").groupBy(event).agg(F.count("*").alias("dropouts"))
    rows = series.join(cams, event).join(dropped, event, "left").join(touched, event, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(event, "timestamps", "cams", ((F.col("_lo") == F.col("timestamps")) & (F.col("_hi") == F.col("timestamps"))).alias("match"), zero("dropped"), zero("dropouts"))


@BOOK.add(
    "g29b_series_audit",
    f"WITH {GAPS}, {DROPOUT[len(EV) + 2:]}, s AS (SELECT event, max(frame_no) AS timestamps, min(t) AS start, max(t) AS stop FROM frames GROUP BY event), "
    "c AS (SELECT event, count(DISTINCT cam) AS cams, min(n) AS lo, max(n) AS hi FROM (SELECT event, cam, count(*) AS n FROM frames GROUP BY 1, 2) GROUP BY event), g AS (SELECT event, sum(last_missing - first_missing + 1)::BIGINT AS dropped FROM gaps GROUP BY event), "
    "d AS (SELECT event, count(*) AS dropouts FROM s JOIN dropout ON grp = event % 10 AND start_time <= stop AND stop_time >= start GROUP BY event) "
    "SELECT s.event, timestamps, cams, lo = timestamps AND hi = timestamps AND cams = (SELECT count(DISTINCT cam) FROM frames) AS match, coalesce(dropped, 0) AS dropped, coalesce(dropouts, 0) AS dropouts FROM s JOIN c USING (event) LEFT JOIN g USING (event) LEFT JOIN d USING (event)",
)
def _g29b(spark, sf):
    rows = frames(spark, sf)
    series = rows.groupBy("event").agg(F.max("frame_no").alias("timestamps"), F.min("t").alias("start"), F.max("t").alias("stop")).withColumn("grp", F.col("event") % 10)
    missing = frame_gaps(rows, "event", "cam", "frame_no", chunk=20).groupBy("event").agg(F.sum(F.col("last_missing") - F.col("first_missing") + 1).alias("dropped"))
    return series_audit(event_frame_counts(rows, "event", "cam"), series, missing, dropouts(spark, sf).select("grp", "start_time", "stop_time"), "event", "grp")


def percentile_bounds(df: DataFrame, keys: list[str], value: str, low: float, high: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(low), F.lit(high))).alias("_p")).select(*keys, F.get("_p", F.lit(0)).alias("low"), F.get("_p", F.lit(1)).alias("high"))


@BOOK.add("g30_percentile_bounds", f"WITH {POSE} SELECT marker, round(quantile_cont(y, 0.05), 6) AS low, round(quantile_cont(y, 0.95), 6) AS high FROM pose GROUP BY marker")
def _g30(spark, sf):
    return percentile_bounds(pose(spark, sf), ["marker"], "y", 0.05, 0.95).select("marker", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


def reach_sample_total(reaches: DataFrame, keys: list[str], fps: float) -> DataFrame:
    """(keys, samples): windows of 0.5 s that fit the reaches in steps of 0.03 s, summed."""
    return reaches.groupBy(*keys).agg(F.sum(((F.col("stop") - F.col("start")) / fps - 0.5) / 0.03).alias("samples"))


@BOOK.add("g31_reach_sample_total", f"WITH {REACH} SELECT marker, round(sum(((stop - start) / 2.0 - 0.5) / 0.03), 4)::DOUBLE AS samples FROM reaches GROUP BY marker")
def _g31(spark, sf):
    return reach_sample_total(_d29(spark, sf), ["marker"], 2.0).withColumn("samples", F.round("samples", 4))


def quality_gate(units: DataFrame, most_isi: float, least_snr: float) -> DataFrame:
    """Units that pass both gates are `good`, others `mua`."""
    return units.withColumn("quality", F.when((F.col("isi_violation_rate") <= most_isi) & (F.col("snr") >= least_snr), "good").otherwise("mua"))


@BOOK.add(
    "g32_quality_gate",
    f"WITH {_RATES}, m AS (SELECT unit, quantile_cont(amplitude, 0.5) AS m FROM spikes GROUP BY unit), d AS (SELECT unit, avg(abs(amplitude)) AS a, quantile_cont(abs(amplitude - m), 0.5) AS d FROM spikes JOIN m USING (unit) GROUP BY unit) "
    f"SELECT unit, CASE WHEN (violations / (2.0 * n * {HOUR})) / (n / nullif(rates.d, 0)) <= 1.0 AND a / (nullif(d.d, 0) / 0.6745) >= 1.2 THEN 'good' ELSE 'mua' END AS quality FROM rates JOIN d USING (unit)",
)
def _g32(spark, sf):
    rows = spikes(spark, sf)
    units = unit_rates(rows, ["unit"], "t", HOUR).join(snr(rows, ["unit"], "amplitude"), "unit")
    return quality_gate(units, 1.0, 1.2).select("unit", "quality")


def auto_labels(units: DataFrame, consensus: DataFrame, unit: str, most_isi: float, least_snr: float) -> DataFrame:
    """(unit, quality) of the units that pass both gates: `good` if they are among the consensus units, else `mua`; others are left out."""
    passed = units.where((F.col("isi_violation_rate") <= most_isi) & (F.col("snr") >= least_snr))
    found = consensus.select(unit).distinct().withColumn("_c", F.lit(True))
    return passed.join(found, unit, "left").select(unit, F.when(F.col("_c"), "good").otherwise("mua").alias("quality"))


@BOOK.add(
    "g32b_auto_labels",
    f"WITH {_RATES}, m AS (SELECT unit, quantile_cont(amplitude, 0.5) AS m FROM spikes GROUP BY unit), d AS (SELECT unit, avg(abs(amplitude)) AS a, quantile_cont(abs(amplitude - m), 0.5) AS d FROM spikes JOIN m USING (unit) GROUP BY unit), c AS (SELECT unit FROM spikes GROUP BY unit HAVING count(*) >= 66) "
    f"SELECT unit, CASE WHEN unit IN (SELECT unit FROM c) THEN 'good' ELSE 'mua' END AS quality FROM rates JOIN d USING (unit) WHERE (violations / (2.0 * n * {HOUR})) / (n / nullif(rates.d, 0)) <= 1.0 AND a / (nullif(d.d, 0) / 0.6745) >= 1.2",
)
def _g32b(spark, sf):
    rows = spikes(spark, sf)
    units = unit_rates(rows, ["unit"], "t", HOUR, CHUNK).join(snr(rows, ["unit"], "amplitude"), "unit")
    return auto_labels(units, rows.groupBy("unit").agg(F.count("*").alias("n")).where("n >= 66"), "unit", 1.0, 1.2)


def rms_noise(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """df with `scaled`: value over its channel's deviation, by one aggregate joined back, so a channel isn't one window."""
    sd = df.groupBy(*keys).agg(F.stddev_pop(value).alias("_s"))
    return df.join(sd, keys).withColumn("scaled", F.when(F.col("_s") > 0, F.col(value) / F.col("_s"))).drop("_s")


@BOOK.add("g33_rms_noise_sigma", f"WITH {SIGNAL}, s AS (SELECT channel, stddev_pop(v) AS s FROM signal GROUP BY channel) SELECT channel, i, CASE WHEN s > 0 THEN round(v / s, 4) END AS scaled FROM signal JOIN s USING (channel)")
def _g33(spark, sf):
    return rms_noise(signal(spark, sf), ["channel"], "v").select("channel", "i", F.round("scaled", 4).alias("scaled"))


def count_mismatches(counts: DataFrame, pulses: DataFrame, event: str, free: Column | None = None) -> DataFrame:
    """Events whose camera counts and pulse count aren't all equal; of free runs those whose cameras agree and have at least as many frames as pulses are fine. free: a condition on pulses' columns."""
    stats = counts.groupBy(event).agg(F.min(F.coalesce("n", F.lit(0))).alias("least"), F.max(F.coalesce("n", F.lit(0))).alias("most"))
    fine = F.lit(False) if free is None else F.coalesce(free, F.lit(False)) & (F.col("least") == F.col("most")) & (F.col("most") >= F.col("pulses"))
    return stats.join(pulses, event).where(((F.col("least") != F.col("most")) | (F.col("pulses") != F.col("most"))) & ~fine)


@BOOK.add("g34_count_mismatches", f"WITH {FC}, p AS (SELECT user_id // 4 AS event, count(*) AS pulses FROM ev GROUP BY 1) SELECT event, min(k) AS least, max(k) AS most, pulses FROM counts JOIN p USING (event) GROUP BY event, pulses HAVING min(k) <> max(k) OR pulses <> max(k)")
def _g34(spark, sf):
    pulses = spikes(spark, sf).groupBy(F.expr("unit div 4").alias("event")).agg(F.count("*").alias("pulses"))
    return count_mismatches(event_frame_counts(odd_frames(spark, sf), "event", "cam"), pulses, "event")


def cluster_average(df: DataFrame, cluster: str, value: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.avg(value).alias("mean"))


@BOOK.add("g35_cluster_average", f"WITH {SPIKES} SELECT unit, round(avg(amplitude), 4) AS mean FROM spikes GROUP BY unit")
def _g35(spark, sf):
    return cluster_average(spikes(spark, sf), "unit", "amplitude").withColumn("mean", F.round("mean", 4))


@BOOK.add(
    "g34b_free_runs",
    f"WITH {FRAMES}, c AS (SELECT event, cam, count(*) // 4 AS k FROM frames GROUP BY 1, 2), p AS (SELECT user_id // 4 AS event, count(*) // 24 AS pulses, avg(value) > 50 AS free FROM ev GROUP BY 1), s AS (SELECT event, min(k) AS least, max(k) AS most FROM c GROUP BY event) "
    "SELECT event, least, most, pulses, free FROM s JOIN p USING (event) WHERE (least <> most OR pulses <> most) AND NOT (free AND least = most AND most >= pulses)",
)
def _g34b(spark, sf):
    pulses = spikes(spark, sf).groupBy(F.expr("unit div 4").alias("event")).agg(F.expr("count(*) div 24").alias("pulses"), (F.avg("amplitude") > 50).alias("free"))
    counts = event_frame_counts(frames(spark, sf), "event", "cam").withColumn("n", F.expr("n div 4"))
    return count_mismatches(counts, pulses, "event", F.col("free"))


def triage_templates(similar: DataFrame, rates: DataFrame, key: str, least_n: int, most_similar: float, spread: float) -> DataFrame:
    """(key, n, amplitude) of templates with at least least_n events that are not the rarer of a pair more similar than most_similar whose amplitudes overlap: they are less than four spreads apart. rates: (key, n, amplitude)."""
    kept = rates.where(F.col("n") >= least_n)
    n = lambda k: kept.select(F.col(key).alias(k), F.col("n").alias(f"n{k}"), F.col("amplitude").alias(f"m{k}"))
    pairs = similar.where(F.col("similarity") > most_similar).join(n("a"), "a").join(n("b"), "b").where((F.abs(F.col("ma") - F.col("mb")) < 4 * spread) & (F.col("na") != F.col("nb")))
    return kept.join(pairs.select(F.when(F.col("na") < F.col("nb"), F.col("a")).otherwise(F.col("b")).alias(key)), key, "left_anti")


@BOOK.add(
    "g36_triage_templates",
    f"WITH {SIM}, n AS (SELECT label, count(*) AS n, avg(list_max(embedding)) AS amplitude FROM embeddings GROUP BY label HAVING count(*) >= 5) "
    "SELECT label, n, round(amplitude, 5) AS amplitude FROM n WHERE label NOT IN (SELECT CASE WHEN x.n < y.n THEN a ELSE b END FROM sim JOIN n x ON x.label = a JOIN n y ON y.label = b WHERE similarity > 0.2 AND x.n <> y.n AND abs(x.amplitude - y.amplitude) < 4 * 0.002)",
)
def _g36(spark, sf):
    sizes = spark.read.parquet(f"{sf}/embeddings.parquet").groupBy("label").agg(F.count("*").alias("n"), F.avg(F.array_max("embedding")).alias("amplitude"))
    return triage_templates(template_similarity(templates(spark, sf), "label", "embedding"), sizes, "label", 5, 0.2, 0.002).withColumn("amplitude", F.round("amplitude", 5))


def cluster_summary(df: DataFrame, channel: str, cluster: str, time: str, refractory: int, width: int, bins: int) -> DataFrame:
    """(channel, cluster, n, short, isi): events per class, intervals below refractory, and a histogram of the intervals below bins * width."""
    gap = F.col(time) - F.lag(time).over(Window.partitionBy(channel, cluster).orderBy(time))
    at = F.floor(F.col("_g") / width)
    counts = df.withColumn("_g", gap).groupBy(channel, cluster, F.when(at < bins, at).alias("_b")).agg(F.count("*").alias("_n"), F.count_if(F.col("_g") < refractory).alias("_s"))
    held = F.map_from_entries(F.collect_list(F.when(F.col("_b").isNotNull(), F.struct("_b", "_n"))))
    isi = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")), lambda k: F.coalesce(F.try_element_at("_h", k), F.lit(0).cast("long")))
    return counts.groupBy(channel, cluster).agg(F.sum("_n").alias("n"), F.sum("_s").alias("short"), held.alias("_h")).select(channel, cluster, "n", "short", isi.alias("isi"))


@BOOK.add("g37_cluster_summary", f"WITH {SPIKES}, g AS (SELECT unit, spike % 4 AS cluster, t - lag(t) OVER (PARTITION BY unit, spike % 4 ORDER BY t) AS g FROM spikes) SELECT unit, cluster, count(*)::BIGINT AS n, count(*) FILTER (g < {6 * HOUR}) AS short, list_transform(range(0, 20), lambda k: len(list_filter(list(g), lambda x: x // {4 * HOUR} = k))) AS isi FROM g GROUP BY 1, 2")
def _g37(spark, sf):
    return cluster_summary(spikes(spark, sf).withColumn("cluster", F.col("spike") % 4), "unit", "cluster", "t", 6 * HOUR, 4 * HOUR, 20)


#: Metric registry: name -> function of (events, keys, time or value column).
METRICS = {"firing_rate": unit_rates, "isi_violation_rate": unit_rates, "snr": snr}
