"""Bins and events over streams, closed by a watermark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.plans.standins import Book
from longtrace.session import shared_folder

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def binned(stream: DataFrame, keys: list[str], time: str, width: str, late: str) -> DataFrame:
    """(keys, bin_start, n): events per tumbling bin; a bin is given out once no event later than `late` can fall into it."""
    bins = stream.withWatermark(time, late).groupBy(*keys, F.window(time, width).alias("_w")).agg(F.count("*").alias("n"))
    return bins.select(*keys, F.col("_w.start").alias("bin_start"), "n")


def segmented(stream: DataFrame, keys: list[str], time: str, gap: str, late: str) -> DataFrame:
    """(keys, start, stop, n): runs of events at most gap apart; state is one open session per key."""
    runs = stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("_s")).agg(F.min(time).alias("start"), F.max(time).alias("stop"), F.count("*").alias("n"))
    return runs.select(*keys, "start", "stop", "n")


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what its source has now into a new table of the shared folder, exactly once, and read it."""
    spark = stream.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{path}/table").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files; ts as a timestamp of the session's zone."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.select("user_id", F.col("ts").cast("timestamp").alias("ts"))


_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@BOOK.add("s1_stream_bins", f"SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS bin_start, count(*) AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= {_CLOSED}")
def _s1(spark, sf):
    rows = run_to_table(binned(event_stream(spark, sf), ["user_id"], "ts", "1 day", "1 hour"), "bins")
    return rows.withColumn("bin_start", F.col("bin_start").cast("timestamp_ntz"))


@BOOK.add(
    "s2_stream_segments",
    f"WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM m) "
    f"SELECT user_id, min(ts) AS start, max(ts) AS stop, count(*) AS n FROM g GROUP BY user_id, g HAVING max(ts) + INTERVAL 6 HOUR <= {_CLOSED}",
)
def _s2(spark, sf):
    rows = run_to_table(segmented(event_stream(spark, sf), ["user_id"], "ts", "6 hours", "1 hour"), "segments")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})
