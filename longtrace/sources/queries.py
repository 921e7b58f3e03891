"""Readers and sinks run on files that Spark writes from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.operators.sequence import DROPOUT, GAPS, dropouts, frame_gaps
from longtrace.plans.standins import ELECTRODES, FRAMES, HOUR, POSE, SIGNAL, SPIKES, Book, electrodes, frames, pose, read, signal, spikes
from longtrace.session import shared_folder
from longtrace.sources import readers, recording, sinks

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def markers(df: DataFrame) -> list[str]:
    """The marker names, a few per rig."""
    return sorted(r[0] for r in df.select("marker").distinct().collect())


@BOOK.add("a1_read_pose3d_csv", f"WITH {POSE} SELECT event::INTEGER AS event, marker, frame, x, y, ncams::INTEGER AS ncams FROM pose")
def _a1(spark, sf):
    rows, path = pose(spark, sf), place(spark, "pose")
    names = markers(rows)
    wide = sinks.pose_wide(rows, ["event"], "frame", "marker", list(readers.POSE_FIELDS), names)
    ordered = wide.select(*(f"{m}_{f}" for m in names for f in readers.POSE_FIELDS), F.col("frame").alias("fnum"), "event")
    ordered.write.option("header", True).csv(path)
    back = readers.read_pose3d_csv(spark, path, trailing=2, event_column="event")
    return back.where("x is not null").select("event", "marker", "frame", "x", "y", "ncams")


@BOOK.add("a3_read_drop_records", f"WITH {GAPS}, n AS (SELECT event, max(frame_no) - 2 AS n FROM frames GROUP BY event), x AS (SELECT event, cam, unnest(range(first_missing, last_missing + 1)) - 1 AS frame_idx FROM gaps) SELECT x.event, cam, frame_idx FROM x JOIN n USING (event) WHERE frame_idx < n")
def _a3(spark, sf):
    rows, path = frames(spark, sf), place(spark, "drops")
    missing = frame_gaps(rows, "event", "cam", "frame_no").select("event", "cam", F.explode(F.sequence("first_missing", "last_missing")).alias("f"))
    text = missing.groupBy("event", "cam").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda x: x.cast("string")), ","), F.lit(",")).alias("value"))
    text.write.option("sep", "\t").csv(path)
    counts = rows.groupBy("event").agg((F.max("frame_no") - 2).alias("n_frames"))
    lines = spark.read.schema("event long, cam string, value string").option("sep", "\t").csv(path).join(counts, "event")
    return readers.parse_drop_records(lines, "value", ["event", "cam"], "n_frames")


@BOOK.add("a6_read_cluster_info", f"WITH {SPIKES} SELECT unit AS cluster_id, CASE WHEN unit % 3 = 0 THEN 'mua' ELSE 'good' END AS quality, t FROM spikes")
def _a6(spark, sf):
    rows, path = spikes(spark, sf), place(spark, "clusters")
    info = rows.select(F.col("unit").alias("cluster_id"), F.when(F.col("unit") % 3 == 0, "mua").otherwise("good").alias("group")).distinct()
    info.write.option("header", True).option("sep", "\t").csv(path)
    arrays = rows.groupBy(F.expr(f"t div {24 * HOUR}").alias("day")).agg(F.collect_list(F.struct("unit", "t")).alias("s")).select(F.col("s.unit").alias("spike_clusters"), F.col("s.t").alias("spike_times"))
    return readers.cluster_spikes(readers.read_cluster_info(spark, path), arrays)


@BOOK.add("a10_read_nested_results", f"WITH {POSE} SELECT event, marker, frame, y FROM pose")
def _a10(spark, sf):
    path = place(spark, "nested")
    pose(spark, sf).groupBy("event", "marker").agg(F.array_sort(F.collect_list(F.struct("frame", "y"))).alias("items")).write.parquet(path)
    return readers.read_nested_results(spark.read.parquet(path), "items", ["event", "marker"]).drop("item")


@BOOK.add("a11_read_metadata", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'own' ELSE props->>'k' END AS k, event_type AS kind FROM events")
def _a11(spark, sf):
    rows = read(spark, sf, "events")
    own = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), F.lit("own"), F.lit("kind"), F.col("event_type"))).otherwise(F.create_map(F.lit("kind"), F.col("event_type")))
    merged = readers.merge_metadata(F.from_json("props", "map<string,string>"), own)
    return rows.select("event_id", merged["k"].alias("k"), merged["kind"].alias("kind"))


@BOOK.add("a12_read_xma_points", f"WITH {POSE}, p AS (SELECT *, event * 1000000 + frame AS at FROM pose) SELECT p.at AS frame, marker AS point, 1 AS cam, y AS x, z AS y FROM p UNION ALL SELECT p.at, marker, 2, x, z FROM p")
def _a12(spark, sf):
    rows, path = pose(spark, sf), place(spark, "points")
    side = lambda c: rows.select((F.col("event") * 1_000_000 + F.col("frame")).alias("frame"), "marker", F.col(c).alias("x"), F.col("z").alias("y"))
    sinks.write_matched_points(side("y"), side("x"), path, "frame", "marker", markers(rows))
    return readers.read_xma_points(spark, path).where("x is not null").select("frame", "point", "cam", "x", "y")


@BOOK.add("b1_write_intervals", f"WITH {DROPOUT} SELECT grp::VARCHAR AS session_id, start_time::BIGINT AS start_time, stop_time::BIGINT AS stop_time FROM dropout")
def _b1(spark, sf):
    path = place(spark, "intervals")
    rows = dropouts(spark, sf).select(F.col("grp").cast("string").alias("session_id"), "start_time", "stop_time")
    sinks.write_intervals(rows.where("start_time % 2 = 0"), path)
    sinks.write_intervals(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@BOOK.add("b2_write_frame_times", f"WITH {FRAMES} SELECT 's' || event AS session_id, cam AS exp_name, 0 AS video_session, event::INTEGER AS event_no, frame_no AS frame_idx, t FROM frames")
def _b2(spark, sf):
    path = place(spark, "frame_times")
    rows = frames(spark, sf).select(F.concat(F.lit("s"), F.col("event").cast("string")).alias("session_id"), F.col("cam").alias("exp_name"), F.lit(0).alias("video_session"), F.col("event").cast("int").alias("event_no"), F.col("frame_no").alias("frame_idx"), "t")
    for _ in range(2):
        sinks.write_frame_times(rows, path)
    return spark.read.parquet(path).select(*rows.columns)


@BOOK.add("b5_write_pose_wide", f"WITH {POSE} SELECT event, frame, marker, y, z FROM pose")
def _b5(spark, sf):
    rows, path = pose(spark, sf), place(spark, "wide")
    names = markers(rows)
    sinks.pose_wide(rows, ["event"], "frame", "marker", ["y", "z"], names).write.parquet(path)
    cells = F.array(*(F.struct(F.lit(m).alias("marker"), F.col(f"{m}_y").alias("y"), F.col(f"{m}_z").alias("z")) for m in names))
    return spark.read.parquet(path).select("event", "frame", F.inline(cells)).where("y is not null")


@BOOK.add("b5b_pose_put_back", f"WITH {POSE} SELECT event, frame, marker, x / 2 AS x, y / 4 AS y, z, ncams FROM pose")
def _b5b(spark, sf):
    """The original wide table, untouched but for x, y and z."""
    rows, path = pose(spark, sf), place(spark, "wide")
    names = markers(rows)
    original = sinks.pose_wide(rows, ["event"], "frame", "marker", ["x", "y", "z", "ncams"], names)
    cleaned = rows.select("event", "frame", "marker", (F.col("x") / 2).alias("x"), (F.col("y") / 4).alias("y"), "z")
    sinks.write_pose_wide(cleaned, original, path, ["event"], "frame", "marker", names)
    back = spark.read.option("header", True).csv(path)
    cell = lambda m, f, kind: F.col(f"{m}_{f}").cast(kind).alias(f)
    cells = F.array(*(F.struct(F.lit(m).alias("marker"), *(cell(m, f, "double") for f in "xyz"), cell(m, "ncams", "long")) for m in names))
    return back.select(F.col("event").cast("long").alias("event"), F.col("frame").cast("long").alias("frame"), F.inline(cells)).where("ncams is not null")


@BOOK.add("e17b_written_split", f"WITH {SIGNAL} SELECT channel, i // 1024 AS part, i, v FROM signal")
def _e17b(spark, sf):
    rows, path = signal(spark, sf), place(spark, "split")
    sinks.save_subset(rows.select("channel", "i", "v"), path, "channel", None, "i", 1024, folders=False)
    return spark.read.parquet(path).select(F.col("channel").cast("long").alias("channel"), F.col("part").cast("long").alias("part"), "i", "v")


@BOOK.add("b7_save_subset", f"WITH {SIGNAL} SELECT channel, i // 20 AS part, count(*) AS n, round(sum(v), 4) AS total FROM signal WHERE channel IN (1, 2, 3, 5, 8, 13) GROUP BY 1, 2")
def _b7(spark, sf):
    path = place(spark, "subset")
    sinks.save_subset(signal(spark, sf), path, "channel", [1, 2, 3, 5, 8, 13], "i", 20)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("channel").cast("long").alias("channel"), F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n"), F.round(F.sum("v"), 4).alias("total"))


@BOOK.add("b8_write_electrode_dim", f"WITH {ELECTRODES} SELECT channel, label, gain FROM electrodes")
def _b8(spark, sf):
    path = place(spark, "electrodes")
    sinks.write_electrodes(electrodes(spark, sf), path)
    return spark.read.schema("channel long, label string, gain double").json(path)


@BOOK.add(
    "a7_scan_samples",
    f"WITH {SIGNAL}, k AS (SELECT channel // 4 AS recording, channel % 4 AS channel_id, i, round(v)::BIGINT AS v FROM signal WHERE v > 7.5), n AS (SELECT recording, max(i) AS m FROM k GROUP BY 1) "
    "SELECT g.recording, g.channel_id::INTEGER AS channel_id, g.i AS sample_idx, coalesce(k.v, 0)::INTEGER AS v FROM (SELECT recording, c AS channel_id, unnest(range(0, m + 1)) AS i FROM n, range(0, 4) r(c)) g LEFT JOIN k ON k.recording = g.recording AND k.channel_id = g.channel_id AND k.i = g.i",
)
def _a7(spark, sf):
    loud = signal(spark, sf).where("v > 7.5").select(F.expr("channel div 4").alias("recording"), (F.col("channel") % 4).alias("channel"), "i", F.round("v").alias("v"))
    files = recording.write_recordings(loud, place(spark, "recordings"), "recording", "channel", "i", "v", 4).collect()
    scanned = recording.scan_samples(spark, [r.path for r in files], 32, 4, split_bytes=1 << 10)
    return scanned.select(F.regexp_extract("path", r"(\d+)\.rec$", 1).cast("long").alias("recording"), "channel_id", "sample_idx", F.col("v").cast("int").alias("v"))


@BOOK.add("a8_scan_packets", f"WITH {SPIKES} SELECT unit // 100 AS recording, t // 1000000 AS timestamp, (unit % 10000 + 1)::INTEGER AS electrode, spike % 7 AS unit_class FROM spikes")
def _a8(spark, sf):
    rows = spikes(spark, sf).select(F.expr("unit div 100").alias("recording"), F.expr("t div 1000000").alias("at"), (F.col("unit") % 10000 + 1).alias("id"), F.unhex(F.lpad(F.hex(F.col("spike") % 7), 2, "0")).alias("payload"))
    files = recording.write_packets(rows, place(spark, "packets"), "recording", "at", "id", "payload", 12).collect()
    found = recording.packet_tables(recording.scan_packets(spark, [r.path for r in files], 8, 12, split_bytes=1 << 12))["spikes"]
    return found.select(F.regexp_extract("path", r"(\d+)\.ev$", 1).cast("long").alias("recording"), "timestamp", "electrode", "unit_class")


def _text(lines, path: str, head: int) -> None:
    """Lines (k, value) as one file behind `head` lines of its own."""
    more = lines.sparkSession.range(head).select((F.col("id") - head).alias("k"), F.lit("head").alias("value"))
    more.unionByName(lines).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)


@BOOK.add("a4_read_electrode_map", f"WITH {ELECTRODES} SELECT (channel % 7)::INTEGER AS col, (channel // 7)::INTEGER AS row, chr((65 + channel % 4)::INTEGER) AS bank, (channel // 4)::INTEGER AS elec, label FROM electrodes")
def _a4(spark, sf):
    path, k = place(spark, "map"), F.col("channel")
    cells = F.concat_ws("\t", (k % 7).cast("string"), F.expr("string(channel div 7)"), F.char(65 + k % 4), F.expr("string(channel div 4)"), "label")
    _text(electrodes(spark, sf).select(k.alias("k"), F.concat(F.when(k % 3 == 0, "//").otherwise(""), cells).alias("value")), path, 13)
    return readers.read_electrode_map(spark, path)


@BOOK.add("a5_read_impedances", f"WITH {ELECTRODES} SELECT label, imp FROM electrodes")
def _a5(spark, sf):
    path = place(spark, "impedances")
    _text(electrodes(spark, sf).select(F.col("channel").alias("k"), F.concat(F.lit(" "), "label", F.lit(" \t "), F.when(F.col("imp") < 0, "<=").otherwise(""), F.col("imp").cast("string")).alias("value")), path, 7)
    return readers.read_impedances(spark, path)


@BOOK.add("a9_read_trials", f"WITH {SPIKES} SELECT unit AS trial, min(spike) AS first_pulse, max(spike) AS last_pulse FROM spikes GROUP BY unit")
def _a9(spark, sf):
    path = place(spark, "trials")
    spikes(spark, sf).groupBy(F.col("unit").alias("trial")).agg(F.min("spike").alias("first_pulse"), F.max("spike").alias("last_pulse")).write.json(path)
    return readers.read_trials(spark, path)


@BOOK.add("b3_write_nested_results", f"WITH {SPIKES} SELECT unit, count(*) AS n, round(sum(amplitude), 4) AS total FROM spikes GROUP BY unit")
def _b3(spark, sf):
    path = place(spark, "nested")
    sinks.write_nested_results(spikes(spark, sf).groupBy("unit").agg(F.count("*").alias("n"), F.sum("amplitude").alias("total")), path, ["unit"])
    return spark.read.parquet(path).select("unit", "result.n", F.round("result.total", 4).alias("total"))


@BOOK.add("b4_write_processed_copy", f"WITH {SPIKES} SELECT unit, t, spike FROM spikes")
def _b4(spark, sf):
    folder = place(spark, "copy")
    names = sinks.write_processed_copy({"signal": signal(spark, sf), "units": spikes(spark, sf)}, folder)
    return spark.read.parquet(*(f"{folder}/{n}" for n in names)).select("unit", "t", "spike")


@BOOK.add("b6_write_matched_points", f"WITH {POSE}, p AS (SELECT event * 1000000 + frame AS frame, marker AS point, y, z FROM pose), f AS (SELECT frame, point FROM (SELECT DISTINCT frame FROM p), (SELECT DISTINCT point FROM p)) SELECT frame, point, cam::INTEGER AS cam, CASE cam WHEN 1 THEN y ELSE z END AS x, CASE cam WHEN 1 THEN z ELSE y END AS y FROM f LEFT JOIN p USING (frame, point), range(1, 3) c(cam)")
def _b6(spark, sf):
    rows, path = pose(spark, sf).select((F.col("event") * 1_000_000 + F.col("frame")).alias("frame"), "marker", "y", "z"), place(spark, "matched")
    side = lambda x, y: rows.select("frame", "marker", F.col(x).alias("x"), F.col(y).alias("y"))
    sinks.write_matched_points(side("y", "z"), side("z", "y"), path, "frame", "marker", markers(rows))
    return readers.read_xma_points(spark, path)


_CAMS = ["cart", "click", "error", "purchase", "signup", "view"]


@BOOK.add(
    "a2_list_frames",
    f"WITH {FRAMES} SELECT event::INTEGER AS event_no, list_position([{', '.join(repr(c) for c in _CAMS)}], cam)::INTEGER AS cam, max(frame_no)::INTEGER AS frame_no, arg_max(t, frame_no) AS ts_ns, count(*) AS length FROM frames GROUP BY event, cam",
)
def _a2(spark, sf):
    """A file for the last frame of each event and camera, as long as the camera has frames."""
    folder = place(spark, "images")
    last = frames(spark, sf).groupBy("event", "cam").agg(F.max("frame_no").alias("n"), F.max_by("t", "frame_no").alias("t"), F.count("*").alias("size"))
    number = F.array_position(F.array(*map(F.lit, _CAMS)), F.col("cam"))
    name = F.format_string("subj_20240101_walk_session1_cam%d_event%d_frame%d_%d_1200-00.jpg", number, "event", "n", "t")
    last.select(F.concat(F.lit(f"{folder}/"), name).alias("path"), "size").mapInPandas(recording.write_files, "path string").write.format("noop").mode("overwrite").save()
    return readers.list_frames(spark, folder, "*.jpg").select("event_no", "cam", "frame_no", "ts_ns", "length")
