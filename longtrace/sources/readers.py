"""Readers of text and table files (inventory group A)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers that a pose file has for each marker, in this order.
POSE_FIELDS = ("x", "y", "z", "error", "ncams", "score")


def read_pose3d_csv(spark: SparkSession, paths: str | list[str], trailing: int = 13, event_pattern: str = r"_e(\d+)", event_column: str | None = None) -> DataFrame:
    """(event, frame, marker, x, y, z, error, ncams, score) from one wide CSV per event, or wide CSVs of many events.

    A file has the six POSE_FIELDS of every marker as `<marker>_x` and so on, then
    `trailing` columns of metadata, the frame number (`fnum`) among them; the event
    is the number that event_pattern finds in the file's name, or the metadata column event_column.
    """
    wide = spark.read.option("recursiveFileLookup", "true").csv(paths, header=True)
    markers = [c.removesuffix("_error") for c in wide.columns[: len(wide.columns) - trailing] if c.endswith("_error")]
    cell = lambda m, f: F.col(f"`{m}_{f}`").cast("double").alias(f)
    rows = F.array(*(F.struct(F.lit(m).alias("marker"), *(cell(m, f) for f in POSE_FIELDS)) for m in markers))
    event = (F.col(event_column) if event_column else F.regexp_extract(F.input_file_name(), event_pattern, 1)).cast("int")
    long = wide.select(event.alias("event"), F.col("fnum").cast("long").alias("frame"), F.inline(rows))
    return long.withColumn("ncams", F.col("ncams").cast("int"))


FRAME_NAME = r"([^/_]+)_(\d{8})_([^/_]+)_session(\d+)_cam(\d+)_event(\d+)_frame(\d+)_(\d+)_(\d{4}-\d{2})\.\w+$"


def frame_keys(path: Column) -> dict[str, Column]:
    """Keys held in a frame file's name: subject_date_experiment_session1_cam2_event3_frame4_<ns>_<HHMM-SS>.ext."""
    part = lambda k: F.regexp_extract(path, FRAME_NAME, k)
    number = {"session": (4, "int"), "cam": (5, "int"), "event_no": (6, "int"), "frame_no": (7, "int"), "ts_ns": (8, "long")}
    return {"subj": part(1), "date": part(2), "exp": part(3), **{n: part(k).cast(t) for n, (k, t) in number.items()}, "start_hhmmss": part(9)}


def list_frames(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per image file, its keys from its name; the files' contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length").withColumns(frame_keys(F.col("path")))


def parse_drop_records(lines: DataFrame, text: str, keys: list[str], n_frames: str) -> DataFrame:
    """(keys, frame_idx) from comma lists of dropped frame numbers (from 1, empty last item); numbers beyond the frames are ignored."""
    items = lines.select(*keys, n_frames, F.explode(F.split(text, ",")).alias("_i")).where("trim(_i) <> ''")
    return items.select(*keys, (F.trim("_i").cast("long") - 1).alias("frame_idx"), n_frames).where(F.col("frame_idx").between(0, F.col(n_frames) - 1)).drop(n_frames)


def read_drop_records(spark: SparkSession, paths: str | list[str], counts: DataFrame) -> DataFrame:
    """(session, event, cam, frame_idx) of text files named ..._s<session>_e<event>_cam<cam>...; counts: (session, event, cam, n_frames)."""
    part = lambda p: F.regexp_extract(F.input_file_name(), p, 1).cast("int")
    lines = spark.read.text(paths).select(part(r"_s(\d+)").alias("session"), part(r"_e(\d+)").alias("event"), part(r"_cam(\d+)").alias("cam"), "value")
    return parse_drop_records(lines.join(counts, ["session", "event", "cam"]), "value", ["session", "event", "cam"], "n_frames")


def read_electrode_map(spark: SparkSession, path: str, skip: int = 13) -> DataFrame:
    """(col, row, bank, elec, label) of a tab-separated map file; its first `skip` lines, `//` marks and empty rows go."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("_k", "_l")).where(F.col("_k") >= skip)
    cells = F.split(F.trim(F.regexp_replace("_l", "//", "")), r"\t")
    rows = lines.where("trim(_l) <> ''").select(*(F.get(cells, F.lit(k)).alias(n) for k, n in enumerate(("col", "row", "bank", "elec", "label"))))
    return rows.where("bank is not null and trim(bank) <> ''").select(*(F.col(c).cast("int").alias(c) for c in ("col", "row")), "bank", F.col("elec").cast("int").alias("elec"), F.trim("label").alias("label")).orderBy("bank", "elec")


def read_impedances(spark: SparkSession, path: str, skip: int = 7) -> DataFrame:
    """(label, imp) of a tab-separated file; `<=` marks and blanks go."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("_k", "_l")).where((F.col("_k") >= skip) & (F.trim("_l") != ""))
    cells = F.split("_l", r"\t")
    return lines.select(F.trim(F.get(cells, F.lit(0))).alias("label"), F.regexp_replace(F.trim(F.get(cells, F.lit(1))), "<=", "").cast("double").alias("imp"))


def cluster_spikes(info: DataFrame, arrays: DataFrame) -> DataFrame:
    """(cluster_id, quality, t): curated clusters joined to spikes held as two parallel arrays, spike_clusters and spike_times."""
    spikes = arrays.select(F.explode(F.arrays_zip("spike_clusters", "spike_times")).alias("s")).select(F.col("s.spike_clusters").alias("cluster_id"), F.col("s.spike_times").alias("t"))
    return spikes.join(info, "cluster_id").select("cluster_id", "quality", "t")


def read_cluster_info(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, quality) of a curated sorter's table; its group column names the quality."""
    return spark.read.csv(path, sep="\t", header=True).select(F.col("cluster_id").cast("long"), F.col("group").alias("quality"))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """(trial, first_pulse, last_pulse) of a JSON-lines trial table."""
    return spark.read.schema("trial long, first_pulse long, last_pulse long").json(path)


def read_nested_results(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """(keys, item number, item fields) of an array of structs."""
    return df.select(*keys, F.posexplode(column).alias("item", "_x")).select(*keys, "item", "_x.*")


def merge_metadata(source: Column, override: Column) -> Column:
    """Two maps joined key by key; the override wins where it has a value."""
    return F.map_zip_with(source, override, lambda k, a, b: F.coalesce(b, a))


def read_xma_points(spark: SparkSession, path: str, cams: int = 2) -> DataFrame:
    """(frame, point, cam, x, y) of a wide CSV with `<point>_cam<k>_X` and `_Y` columns; the spellings of NaN become NULL."""
    wide = spark.read.csv(path, header=True)
    points = list(dict.fromkeys(c.rsplit("_cam", 1)[0] for c in wide.columns if c.endswith("_X")))
    number = lambda c: F.nullif(F.when(F.lower(F.trim(f"`{c}`")).isin("", "nan", "na", "null"), None).otherwise(F.col(f"`{c}`")).cast("double"), F.lit(float("nan")))
    cells = F.array(*(F.struct(F.lit(p).alias("point"), F.lit(k).alias("cam"), number(f"{p}_cam{k}_X").alias("x"), number(f"{p}_cam{k}_Y").alias("y")) for p in points for k in range(1, cams + 1)))
    lined = wide.withColumn("frame", F.monotonically_increasing_id()) if "frame" not in wide.columns else wide.withColumn("frame", F.col("frame").cast("long"))
    return lined.select("frame", F.inline(cells))
