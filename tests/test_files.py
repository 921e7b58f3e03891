import numpy as np
import pytest
from pyspark.sql import functions as F

from longtrace.operators.sequence import linear_fill
from longtrace.plans import standins
from longtrace.sources import readers, recording, sinks

SF = "/root/testdata/sf0.001"


def test_pose_csv_round_trip(spark, tmp_path):
    long = standins.pose(spark, SF).where("event = 3 and marker in ('click', 'view')")
    markers = ["click", "view"]
    wide = sinks.pose_wide(long, ["event"], "frame", "marker", list(readers.POSE_FIELDS), markers).drop("event").withColumnRenamed("frame", "fnum")
    wide = wide.select(*(f"{m}_{f}" for m in markers for f in readers.POSE_FIELDS), "fnum")
    wide.coalesce(1).write.option("header", True).csv(str(tmp_path / "trial_e003"))
    back = readers.read_pose3d_csv(spark, str(tmp_path / "trial_e003"), trailing=1)
    got = {tuple(r) for r in back.where("x is not null").select("event", "marker", "frame", "x", "y", "z").collect()}
    assert got == {tuple(r) for r in long.select("event", "marker", "frame", "x", "y", "z").collect()}


def test_frames_and_drops(spark, tmp_path):
    for cam in (1, 2):
        (tmp_path / f"subj_20230101_moths_session2_cam{cam}_event7_frame12_123456789_1501-59.jpg").write_bytes(b"x")
    rows = readers.list_frames(spark, str(tmp_path), "*.jpg").orderBy("cam").collect()
    assert [(r.subj, r.exp, r.session, r.cam, r.event_no, r.frame_no, r.ts_ns, r.start_hhmmss) for r in rows] == [("subj", "moths", 2, c, 7, 12, 123456789, "1501-59") for c in (1, 2)]
    (tmp_path / "d_s1_e2_cam3.txt").write_text("2,4,9,")
    counts = spark.createDataFrame([(1, 2, 3, 5)], "session int, event int, cam int, n_frames long")
    assert sorted(r.frame_idx for r in readers.read_drop_records(spark, str(tmp_path / "d_s1_e2_cam3.txt"), counts).collect()) == [1, 3]


def test_small_tables(spark, tmp_path):
    (tmp_path / "m.cmp").write_text("\n".join(["head"] * 13 + ["//1\t2\tB\t5\telec5", "0\t0\tA\t3\telec3", "\t\t\t\t"]))
    assert [(r.bank, r.elec, r.label) for r in readers.read_electrode_map(spark, str(tmp_path / "m.cmp")).collect()] == [("A", 3, "elec3"), ("B", 5, "elec5")]
    (tmp_path / "i.txt").write_text("\n".join(["head"] * 7 + ["elec3 \t <=12.5", "elec5\t7"]))
    assert sorted(tuple(r) for r in readers.read_impedances(spark, str(tmp_path / "i.txt")).collect()) == [("elec3", 12.5), ("elec5", 7.0)]
    (tmp_path / "c.tsv").write_text("cluster_id\tgroup\n1\tgood\n2\tmua\n")
    arrays = spark.createDataFrame([([1, 2, 1, 9], [0.1, 0.2, 0.3, 0.4])], "spike_clusters array<long>, spike_times array<double>")
    assert sorted(tuple(r) for r in readers.cluster_spikes(readers.read_cluster_info(spark, str(tmp_path / "c.tsv")), arrays).collect()) == [(1, "good", 0.1), (1, "good", 0.3), (2, "mua", 0.2)]
    (tmp_path / "t.json").write_text('{"trial": 1, "first_pulse": 2, "last_pulse": 5}\n')
    assert tuple(readers.read_trials(spark, str(tmp_path / "t.json")).first()) == (1, 2, 5)
    (tmp_path / "x.csv").write_text("p_cam1_X,p_cam1_Y,p_cam2_X,p_cam2_Y\n1,2,NaN,nan\n3,4, ,6\n")
    got = sorted((tuple(r)[1:] for r in readers.read_xma_points(spark, str(tmp_path / "x.csv")).collect()), key=str)
    assert got == sorted([("p", 1, 1.0, 2.0), ("p", 2, None, None), ("p", 1, 3.0, 4.0), ("p", 2, None, 6.0)], key=str)
    maps = spark.range(1).select(readers.merge_metadata(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3"))).alias("m"))
    assert maps.first().m == {"a": "1", "b": "3"}


def test_recording_scan(spark, tmp_path):
    rnd = np.random.default_rng(1)
    one, two = rnd.integers(-99, 99, (1000, 4)).astype("<i2"), rnd.integers(-99, 99, (3, 4)).astype("<i2")
    head = lambda t, n: b"\1" + np.array([t, n], "<u4").tobytes()
    path = tmp_path / "a.bin"
    path.write_bytes(b"h" * 32 + head(0, 1000) + one.tobytes() + head(1500, 3) + two.tobytes())
    for split in (64, 1 << 20):
        rows = recording.scan_samples(spark, str(path), 32, 4, pick=[2, 0], start=10, stop=1502, every=5, split_bytes=split)
        want = {(c, i, int(one[i, c]) if i < 1000 else 0) for c in (0, 2) for i in range(10, 1502, 5)}  # the tiny packet is shorter than the stride
        want = {x for x in want if x[1] < 1000}
        assert {tuple(r)[1:] for r in rows.collect()} == want
    assert recording.scan_samples(spark, str(path), 32, 4, fill=False).where("sample_idx >= 1500").count() == 12
    filled = recording.scan_samples(spark, str(path), 32, 4, start=990)
    assert filled.count() == 4 * 513 and filled.where("sample_idx between 1000 and 1499 and v <> 0").isEmpty()


def test_recording_pauses_restarts_and_ranges(spark, tmp_path):
    rnd = np.random.default_rng(2)
    head = lambda t, n: b"\1" + np.array([t, n], "<u4").tobytes()
    parts = [(20, 400), (500, 2), (600, 300), (100, 50), (155, 1), (200, 800)]
    data = [rnd.integers(1, 99, (n, 2)).astype("<i2") for _, n in parts]
    path = str(tmp_path / "r.bin")
    with open(path, "wb") as f:
        f.write(b"h" * 16 + b"".join(head(3 * t, n) + x.tobytes() for (t, n), x in zip(parts, data, strict=True)))
    want = np.zeros((1000, 2), int)  # from the packet at 100 on, which goes back in time; the one of one sample is below the stride
    want[100:150], want[200:1000] = data[3], data[5]
    for split in (40, 1 << 20):
        rows = recording.scan_samples(spark, path, 16, 2, every=2, split_bytes=split, period=3)
        assert {tuple(r)[1:] for r in rows.collect()} == {(c, i, int(want[i, c])) for i in range(0, 1000, 2) for c in (0, 1)}
    options = {"path": path, "header_bytes": "16", "channels": "2", "period": "3", "split_bytes": "400"}
    read = lambda spans: sum(4 * s.rows for s in spans if s.offset is not None)
    whole = recording.SampleReader(options)
    assert read(whole.partitions()) == 4 * 851
    assert read(recording.SampleReader({**options, "start": "140", "stop": "210"}).partitions()) == 4 * 21
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = recording.scan_samples(spark, path, 16, 2, period=3).where("sample_idx >= 140 and sample_idx < 210 and channel_id = 1")
        assert {tuple(r)[2:] for r in some.collect()} == {(i, int(want[i, 1])) for i in range(140, 155)} | {(155, int(data[4][0, 1]))} | {(i, int(want[i, 1])) for i in range(156, 210)}
        asked = recording.AskedSampleReader(options)
        left = asked.pushFilters([recording.GreaterThanOrEqual(("sample_idx",), 140), recording.LessThan(("sample_idx",), 210), recording.In(("channel_id",), (1, 7)), recording.EqualTo(("v",), 3)])
        assert [type(x) for x in left] == [recording.EqualTo] and asked.pick == [1] and read(asked.partitions()) == 4 * 21
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_event_packets(spark, tmp_path):
    packet = lambda t, k, body: np.array([t], "<u4").tobytes() + np.array([k], "<u2").tobytes() + body.ljust(10, b"\0")
    path = tmp_path / "b.bin"
    path.write_bytes(b"h" * 8 + packet(5, 3, b"\2") + packet(9, 0, b"\1\0\x34\x12") + packet(11, 3, b"\0"))
    tables = recording.packet_tables(recording.scan_packets(spark, str(path), 8, 16, split_bytes=16))
    assert sorted(tuple(r)[1:] for r in tables["spikes"].collect()) == [(5, 3, 2), (11, 3, 0)]
    assert [tuple(r)[1:] for r in tables["digital"].collect()] == [(9, 1, 0x1234)]
    bare = recording.scan_packets(spark, str(path), 8, 16, electrodes=[3], waveforms=False)
    assert sorted((r.packet_id, len(r.payload)) for r in bare.collect()) == [(0, 10), (3, 2), (3, 2)]
    assert recording.scan_packets(spark, str(path), 8, 16, electrodes=[4]).count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1.0, 2.0), ("s", 3.0, 4.0)], "session_id string, start_time double, stop_time double")
    path = str(tmp_path / "i")
    for _ in range(2):
        sinks.write_intervals(rows, path)
    sinks.write_intervals(rows.withColumn("start_time", F.col("start_time") + 2), path)
    assert sorted(r.start_time for r in spark.read.parquet(path).collect()) == [1.0, 3.0, 5.0]
    signal = standins.signal(spark, SF).select("channel", "i", "v")
    some = [r.channel for r in signal.select("channel").distinct().limit(2).collect()]
    sinks.save_subset(signal, str(tmp_path / "sub"), "channel", some, "i", 10)
    assert spark.read.parquet(str(tmp_path / "sub")).count() == signal.where(F.col("channel").isin(some)).count()
    assert sinks.write_processed_copy({"signal": signal, "units": rows}, str(tmp_path / "copy")) == ["units"]
    sinks.write_nested_results(rows, str(tmp_path / "n"), ["session_id"])
    assert spark.read.parquet(str(tmp_path / "n")).select("result.stop_time").count() == 2
    pts = spark.createDataFrame([(1, "a", 1.0, 2.0)], "frame long, marker string, x double, y double")
    sinks.write_matched_points(pts, pts.where("frame = 9"), str(tmp_path / "m"), "frame", "marker", ["a"])
    assert readers.read_xma_points(spark, str(tmp_path / "m")).where("cam = 2 and x is null").count() == 1


def test_fill_fixture(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, None), (1, 3, 4.0), (1, 4, None)], "k long, f long, x double")
    got = [r.filled for r in linear_fill(rows, ["k"], "f", "x").orderBy("f").collect()]
    assert got == [1.0, pytest.approx(2.0), pytest.approx(3.0), 4.0, None]
