"""Grids, order, top-k and set operations (inventory group H)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtrace.functions.few import with_each
from longtrace.operators.sequence import EVENTS, HOUR, segments
from longtrace.plans.standins import ELECTRODES, FRAMES, SIGNAL, SPIKES, Book, electrodes, frames, signal, spikes
from longtrace.session import remove, written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def bin_grid(ranges: DataFrame, start: str, stop: str, width: int) -> DataFrame:
    """ranges with one row per whole bin (`bin`, `bin_start`), empty ones included."""
    last = F.floor((F.col(stop) - F.col(start)) / width) - 1
    rows = ranges.where(last >= 0).withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return rows.withColumn("bin_start", F.col(start) + F.col("bin") * width)


@BOOK.add("h1_bin_grid", f"WITH {EVENTS}, b AS (SELECT unit, event, start, unnest(range(0, (stop - start) // {HOUR})) AS bin FROM segments) SELECT unit, event, bin, start + bin * {HOUR} AS bin_start FROM b")
def _h1(spark, sf):
    return bin_grid(segments(spark, sf), "start", "stop", HOUR).select("unit", "event", "bin", "bin_start")


def event_grid(df: DataFrame, left: str, right: str) -> DataFrame:
    """All pairs of the values of two columns; the right ones are meant to be few."""
    return with_each(df.select(left).distinct(), df.select(right).distinct())


@BOOK.add("h2_event_grid", f"WITH {FRAMES} SELECT e.event, c.cam FROM (SELECT DISTINCT event FROM frames) e CROSS JOIN (SELECT DISTINCT cam FROM frames) c")
def _h2(spark, sf):
    return event_grid(frames(spark, sf), "event", "cam")


def natural_order(df: DataFrame, name: str) -> DataFrame:
    """df with `session`, `event` from names like `s2_e010` and `rank`, the numeric order of both."""
    part = lambda k: F.regexp_extract(name, r"s(\d+)_e(\d+)", k).cast("long")
    keyed = df.withColumns({"session": part(1), "event": part(2)})
    return keyed.withColumn("rank", F.row_number().over(Window.partitionBy("session").orderBy("event", name)))


@BOOK.add("h3_natural_event_order", f"WITH {EVENTS} SELECT 's' || unit || '_e' || event AS name, unit AS session, event, row_number() OVER (PARTITION BY unit ORDER BY event)::INTEGER AS rank FROM segments")
def _h3(spark, sf):
    names = segments(spark, sf).select(F.concat(F.lit("s"), F.col("unit").cast("string"), F.lit("_e"), F.col("event").cast("string")).alias("name"))
    return natural_order(names, "name")


def first_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key in order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


@BOOK.add("h4_first_n_spikes", f"WITH {SPIKES} SELECT unit, t FROM (SELECT unit, t, row_number() OVER (PARTITION BY unit ORDER BY t) AS k FROM spikes) WHERE k <= 5")
def _h4(spark, sf):
    return first_n(spikes(spark, sf).select("unit", "t"), ["unit"], ["t"], 5)


@BOOK.add("h5_top_k_mean", f"WITH {SPIKES} SELECT unit, round(avg(amplitude), 4) AS mean FROM (SELECT unit, amplitude, row_number() OVER (PARTITION BY unit ORDER BY amplitude DESC, spike) AS k FROM spikes) WHERE k <= 10 GROUP BY unit")
def _h5(spark, sf):
    """Mean of the ten largest values of each key."""
    return first_n(spikes(spark, sf), ["unit"], [F.desc("amplitude"), "spike"], 10).groupBy("unit").agg(F.round(F.avg("amplitude"), 4).alias("mean"))


def order_by_count(df: DataFrame, key: str) -> DataFrame:
    """(key, n, rank) from the key with the fewest rows on."""
    return df.groupBy(key).agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(Window.orderBy("n", key)))


@BOOK.add("h6_order_by_count", f"WITH {SPIKES}, c AS (SELECT unit, count(*) AS n FROM spikes GROUP BY unit) SELECT unit, n, row_number() OVER (ORDER BY n, unit)::INTEGER AS rank FROM c")
def _h6(spark, sf):
    return order_by_count(spikes(spark, sf), "unit")


def set_members(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, place): every value of either side and whether it is in a only, b only or both; one full join."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(True)), b.select(key).distinct().withColumn("_b", F.lit(True))
    return left.join(right, key, "full").select(key, F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "a").otherwise("b").alias("place"))


@BOOK.add("h7_index_sets", f"WITH {SPIKES}, a AS (SELECT DISTINCT spike FROM spikes WHERE amplitude > 40), b AS (SELECT DISTINCT spike FROM spikes WHERE unit % 2 = 0) SELECT spike, CASE WHEN spike IN (SELECT spike FROM a) THEN CASE WHEN spike IN (SELECT spike FROM b) THEN 'both' ELSE 'a' END ELSE 'b' END AS place FROM (SELECT spike FROM a UNION SELECT spike FROM b)")
def _h7(spark, sf):
    rows = spikes(spark, sf)
    return set_members(rows.where("amplitude > 40"), rows.where("unit % 2 = 0"), "spike")


def stack(*tables: DataFrame) -> DataFrame:
    """All rows of tables that may lack each other's columns."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


@BOOK.add("h8_stack_tables", f"WITH {SPIKES}, {ELECTRODES} SELECT unit, t, NULL::VARCHAR AS label FROM spikes WHERE amplitude > 100 UNION ALL SELECT channel, NULL, label FROM electrodes")
def _h8(spark, sf):
    return stack(spikes(spark, sf).where("amplitude > 100").select("unit", "t"), electrodes(spark, sf).select(F.col("channel").alias("unit"), "label"))


def split_sessions(df: DataFrame, start: str, borders: list[int]) -> DataFrame:
    """df with `session`: how many borders lie at or before start."""
    number: Column = sum(((F.col(start) >= b).cast("int") for b in borders), F.lit(0))
    return df.withColumn("session", number)


@BOOK.add("h9_split_sessions", f"WITH {EVENTS} SELECT unit, event, ((start >= {240 * HOUR})::INT + (start >= {480 * HOUR})::INT)::INTEGER AS session FROM segments")
def _h9(spark, sf):
    return split_sessions(segments(spark, sf), "start", [240 * HOUR, 480 * HOUR]).select("unit", "event", "session")


def reference_camera(counts: DataFrame, key: str, cam: str, n: str) -> DataFrame:
    """(key, cam): the camera with most frames, ties: the last by name."""
    return counts.groupBy(key).agg(F.max(F.struct(n, cam)).alias("m")).select(key, F.col(f"m.{cam}").alias(cam))


@BOOK.add("h10_reference_camera", f"WITH {FRAMES}, c AS (SELECT event, cam, count(*) AS n FROM frames GROUP BY 1, 2) SELECT event, arg_max(cam, (n, cam)) AS cam FROM c GROUP BY event")
def _h10(spark, sf):
    return reference_camera(frames(spark, sf).groupBy("event", "cam").agg(F.count("*").alias("n")), "event", "cam", "n")


def channel_order_swap(counts: DataFrame, group: str, channel: str, n: str) -> DataFrame:
    """counts with `position` within the group, from the channel with the fewest events on."""
    return counts.withColumn("position", F.row_number().over(Window.partitionBy(group).orderBy(n, channel)))


@BOOK.add("h11_channel_order_swap", f"WITH {EVENTS}, c AS (SELECT unit % 10 AS grp, unit, count(*) AS n FROM segments GROUP BY unit) SELECT grp, unit, n, row_number() OVER (PARTITION BY grp ORDER BY n, unit)::INTEGER AS position FROM c")
def _h11(spark, sf):
    counts = segments(spark, sf).groupBy("unit").agg(F.count("*").alias("n")).withColumn("grp", F.col("unit") % 10)
    return channel_order_swap(counts, "grp", "unit", "n")


def nearest_channels(sites: DataFrame, key: str, x: str, y: str, k: int, most: int = 64) -> DataFrame:
    """(key, other, distance, rank): the k closest sites of each site, itself first, ties by key; sites without a place are left out.

    Places are looked at once, and of a place's sites the k smallest are enough for all.
    Cells are made so small that none holds more than `most` places. A place looks at
    its cell and the eight around it; if its k closest are nearer than a cell is wide,
    it is done, else it goes on with cells twice as wide, until a cell holds all.
    """
    placed = sites.select(key, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x is not null and _y is not null")
    listed = written(first_n(placed, ["_x", "_y"], [key], k), "sites")
    low_x, high_x, low_y, high_y = listed.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y")).first()
    wide = max(high_x - low_x, high_y - low_y) * 1.001 or 1.0 if low_x is not None else 1.0
    cell = lambda c, low, w: F.floor((F.col(c) - F.lit(low or 0.0)) / w)
    cells = lambda df, w: df.withColumns({"_cx": cell("_x", low_x, w), "_cy": cell("_y", low_y, w)})
    width, places = wide, listed.select("_x", "_y").distinct()
    # cells of 2 ** -40 of all are as small as doubles can tell
    while width > wide / 2**40 and (cells(places, width).groupBy("_cx", "_cy").count().agg(F.max("count")).first()[0] or 0) > most:
        width /= 2
    todo, found = written(places, "places"), []
    around = lambda c: F.explode(F.array(F.col(c) - 1, c, F.col(c) + 1))
    while True:
        beside = cells(todo, width).withColumn("_cx", around("_cx")).withColumn("_cy", around("_cy"))
        other = cells(listed, width).select("_cx", "_cy", F.col("_x").alias("_ox"), F.col("_y").alias("_oy"), F.col(key).alias("other"))
        met = beside.join(other, ["_cx", "_cy"]).withColumn("d", F.sqrt((F.col("_ox") - F.col("_x")) ** 2 + (F.col("_oy") - F.col("_y")) ** 2))
        rank = Window.partitionBy("_x", "_y").orderBy("d", "other")
        near = met.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).groupBy("_x", "_y").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "d"))).alias("_near"))
        done = (F.size("_near") == k) & (F.element_at("_near", -1)["d"] < width * (1 - 1e-9))
        now = written(near.withColumn("_done", F.lit(True) if width >= wide else done), "nearest")
        found.append(now.where("_done").drop("_done"))
        before, todo = todo, written(now.where("not _done").select("_x", "_y"), "places")
        remove(before)
        if todo.isEmpty():
            break
        width *= 2
    told = reduce(DataFrame.union, found)
    return placed.join(told, ["_x", "_y"]).select(key, F.inline("_near")).select(key, "other", F.round("d", 5).alias("distance"), "rank")


@BOOK.add("h12_nearest_channels", f"WITH {ELECTRODES}, d AS (SELECT a.channel, b.channel AS other, sqrt(pow(a.ex - b.ex, 2) + pow(a.ey - b.ey, 2)) AS d FROM electrodes a CROSS JOIN electrodes b) SELECT * FROM (SELECT channel, other, round(d, 5) AS distance, row_number() OVER (PARTITION BY channel ORDER BY d, other)::INTEGER AS rank FROM d) WHERE rank <= 4")
def _h12(spark, sf):
    return nearest_channels(electrodes(spark, sf), "channel", "ex", "ey", 4)


def strided_preview(df: DataFrame, index: str, first: int, last: int, stride: int) -> DataFrame:
    return df.where(F.col(index).between(first, last) & ((F.col(index) - first) % stride == 0))


@BOOK.add("h13_strided_preview", f"WITH {SIGNAL} SELECT channel, i, v FROM signal WHERE i BETWEEN 2 AND 100 AND (i - 2) % 7 = 0")
def _h13(spark, sf):
    return strided_preview(signal(spark, sf), "i", 2, 100, 7).select("channel", "i", "v")
