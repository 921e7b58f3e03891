"""Writers (inventory group B): appends are idempotent, keyed by an anti join with what is stored."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def append_new(df: DataFrame, path: str, keys: list[str], together: list[str] | None = None) -> None:
    """Append the rows whose key isn't stored yet; a second run appends nothing. Rows equal in `together` stand together in one file, in order, and a file holds many such."""
    old = stored(df.sparkSession, path)
    rows = df.dropDuplicates(keys)
    if old is not None:
        rows = rows.join(old.select(*keys).distinct(), keys, "left_anti")
    if together:
        rows = rows.repartition(*together).sortWithinPartitions(*together, *(k for k in keys if k not in together))
    rows.write.mode("append").parquet(path)


def write_intervals(df: DataFrame, path: str) -> None:
    """Interval rows, once per session and start_time."""
    append_new(df, path, ["session_id", "start_time"])


def write_frame_times(df: DataFrame, path: str) -> None:
    """Frame times, once per series; a stored series is skipped whole."""
    series = ["session_id", "exp_name", "video_session", "event_no"]
    append_new(df, path, [*series, "frame_idx"], series)


def write_nested_results(df: DataFrame, path: str, keys: list[str]) -> None:
    """All other columns as one struct `result` per key row."""
    rest = [c for c in df.columns if c not in keys]
    df.select(*keys, F.struct(*rest).alias("result")).write.mode("overwrite").parquet(path)


def write_processed_copy(tables: dict[str, DataFrame], folder: str, left_out: tuple[str, ...] = ("signal", "signal_wide", "nev_spikes")) -> list[str]:
    """Every table but the raw ones to folder/<name>; returns the names written."""
    names = [n for n in tables if n not in left_out]
    for n in names:
        tables[n].write.mode("overwrite").parquet(f"{folder}/{n}")
    return names


def pose_wide(long: DataFrame, keys: list[str], frame: str, marker: str, fields: list[str], markers: list[str]) -> DataFrame:
    """One row per frame with `<marker>_<field>` columns."""
    return long.groupBy(*keys, frame).agg(*(F.max(F.when(F.col(marker) == m, F.col(f))).alias(f"{m}_{f}") for m in markers for f in fields))


def write_pose_wide(cleaned: DataFrame, original: DataFrame, path: str, keys: list[str], frame: str, marker: str, markers: list[str]) -> None:
    """The original wide table with x, y and z replaced; its other columns and their order stay."""
    new = pose_wide(cleaned, keys, frame, marker, ["x", "y", "z"], markers)
    swapped = {f"{m}_{f}" for m in markers for f in "xyz"}
    joined = original.alias("o").join(new.alias("n"), [*keys, frame], "left")
    joined.select(*(F.col(f"n.{c}") if c in swapped else F.col(c) if c in (*keys, frame) else F.col(f"o.{c}") for c in original.columns)).write.mode("overwrite").option("header", True).csv(path)


def write_matched_points(first: DataFrame, second: DataFrame, path: str, frame: str, marker: str, markers: list[str]) -> None:
    """Two cameras' points as one wide CSV, four columns a point, likelihoods left out, NULL as NaN."""
    sides = []
    for k, side in enumerate((first, second), 1):
        wide = side.groupBy(frame).agg(*(F.max(F.when(F.col(marker) == m, F.col(a))).alias(f"{m}_cam{k}_{a.upper()}") for m in markers for a in "xy"))
        sides.append(wide)
    columns = [f"{m}_cam{k}_{a}" for m in markers for k in (1, 2) for a in "XY"]
    sides[0].join(sides[1], frame, "full").select(frame, *columns).write.mode("overwrite").option("header", True).option("nullValue", "NaN").csv(path)


def save_subset(df: DataFrame, path: str, channel: str, wanted: list[int] | None, index: str, samples_per_file: int, folders: bool = True) -> None:
    """Some channels (None: all), split in parts of samples_per_file: one folder per channel and part, or without folders, for many channels, each part in one piece and in order within a file that holds many."""
    rows = (df if wanted is None else df.where(F.col(channel).isin(wanted))).withColumn("part", F.floor(F.col(index) / samples_per_file))
    writer = rows.repartition(channel, "part").sortWithinPartitions(channel, "part", index).write.mode("overwrite")
    (writer.partitionBy(channel, "part") if folders else writer).parquet(path)


def write_electrodes(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
