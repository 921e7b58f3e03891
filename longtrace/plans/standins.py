"""The canonical tables (spikes, signal, pose, frames, electrodes) as read from the driver's star schema, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
HOUR = 3600 * SECOND


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t: microseconds since 2024-01-01."""
    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)")
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", t.alias("t"))


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("user_id").alias("unit"), "t", F.col("event_id").alias("spike"), F.col("value").alias("amplitude"))


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("t", "event_id")
    return events(spark, sf_dir).select(F.col("user_id").alias("channel"), (F.row_number().over(order) - 1).cast("long").alias("i"), "t", F.col("value").alias("v"))


def pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (event, marker, frame); marker: the event type, event: four users together, so that an event is as long at any table size."""
    order = Window.partitionBy(F.expr("user_id div 4"), "event_type").orderBy("t", "event_id")
    return events(spark, sf_dir).select(
        F.expr("user_id div 4").alias("event"),
        F.col("event_type").alias("marker"),
        (F.row_number().over(order) - 1).cast("long").alias("frame"),
        F.col("value").alias("x"),
        (F.expr("(t div 1000) % 977") / 8).alias("y"),
        ((F.col("event_id") % 101) / 4).alias("z"),
        F.col("value").alias("error"),
        (F.col("event_id") % 5).alias("ncams"),
        ((F.col("event_id") * 7 % 100) / 100).alias("score"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of cameras (the event types): numbers from 1 with holes where the value is low."""
    order = Window.partitionBy(F.expr("user_id div 4"), "event_type").orderBy("t", "event_id")
    rows = events(spark, sf_dir).select(F.expr("user_id div 4").alias("event"), F.col("event_type").alias("cam"), F.row_number().over(order).cast("long").alias("frame_no"), "t", F.col("event_id").alias("id"), F.col("value").alias("v"))
    return rows.where("v > 7.5")


def electrodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return s.select(
        key.alias("channel"),
        F.concat(F.when(key % 4 == 0, "ainp").otherwise("elec"), key.cast("string"), F.lit("-"), (key % 2 + 1).cast("string")).alias("label"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.lit(0.25)).cast("double").alias("gain"),
        F.lit(0.5).alias("channel_conversion"),
        (key % 10).alias("ex"),
        F.expr("s_suppkey div 10").alias("ey"),
        F.col("s_acctbal").alias("imp"),
    )


EV = "ev AS (SELECT event_id, user_id, event_type, value, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) AS t FROM events)"
SPIKES = f"{EV}, spikes AS (SELECT user_id AS unit, t, event_id AS spike, value AS amplitude FROM ev)"
SIGNAL = f"{EV}, signal AS (SELECT user_id AS channel, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, t, value AS v FROM ev)"
POSE = (
    f"{EV}, pose AS (SELECT user_id // 4 AS event, event_type AS marker, row_number() OVER (PARTITION BY user_id // 4, event_type ORDER BY t, event_id) - 1 AS frame, value AS x, "
    "((t // 1000) % 977) / 8.0 AS y, (event_id % 101) / 4.0 AS z, value AS error, event_id % 5 AS ncams, (event_id * 7 % 100) / 100.0 AS score FROM ev)"
)
FRAMES = f"{EV}, frames AS (SELECT * FROM (SELECT user_id // 4 AS event, event_type AS cam, row_number() OVER (PARTITION BY user_id // 4, event_type ORDER BY t, event_id) AS frame_no, t, event_id AS id, value AS v FROM ev) WHERE v > 7.5)"
ELECTRODES = (
    "electrodes AS (SELECT s_suppkey AS channel, (CASE WHEN s_suppkey % 4 = 0 THEN 'ainp' ELSE 'elec' END) || s_suppkey || '-' || (s_suppkey % 2 + 1) AS label, "
    "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 0.25::DOUBLE END AS gain, 0.5::DOUBLE AS channel_conversion, s_suppkey % 10 AS ex, s_suppkey // 10 AS ey, s_acctbal AS imp FROM supplier)"
)


class Book:
    """Collects a module's queries and their SQL."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def put(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return put
