"""Values that only larger tables show: long event numbers, ties between windows, layouts of written files."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from longtrace.operators import grid, merging, units
from longtrace.operators.joins import spike_pairs
from longtrace.operators.scalar import parse_series_name, series_name
from longtrace.operators.trajectories import on_lines
from longtrace.sources import queries, recording, sinks


def test_series_names_of_long_event_numbers(spark):
    rows = spark.createDataFrame([("view", 2, 7), ("view", 1, 1234)], "m string, s long, e long")
    named = rows.select("e", series_name(rows.m, rows.s, rows.e, "timestamps").alias("name"))
    assert dict(named.collect()) == {7: "view_s_2_e_007_timestamps", 1234: "view_s_1_e_123_timestamps"}
    parts = parse_series_name(named["name"])
    assert {tuple(r) for r in named.select(parts["experiment"], parts["session"], parts["event"]).collect()} == {("view", 2, 7), ("view", 1, 123)}


def test_windows_that_begin_together(spark):
    rows = spark.createDataFrame([(1, f, float(f * f)) for f in range(12)], "k long, f long, y double")
    for windows in itertools.permutations([(1, 2, 5), (1, 2, 9), (1, 2, 7)]):
        found = spark.createDataFrame(windows, "k long, first long, last long").coalesce(1)
        lined = dict(on_lines(rows, found, ["k"], "f", ["y"], "first").select("f", "line_y").collect())
        # slopes of y = f * f from 2 to 5, 7 and 9
        assert lined == {f: None if not 2 <= f <= 9 else 4.0 + (f - 2) * (7 if f <= 5 else 9 if f <= 7 else 11) for f in range(12)}


def plain_agreement(truth, test, most, gain):
    """The greedy union with every unit's matches as a set."""
    out = []
    for key in sorted({k for k, _ in truth}):
        at = [t for k, t in truth if k == key]
        own = {u: [t for k, v, t in test if (k, v) == (key, u)] for u in {v for k, v, _ in test if k == key}}
        near = {u: {t for t in at if any(abs(t - x) <= most for x in ts)} for u, ts in own.items()}
        good = {u: len({x for x in ts if any(abs(t - x) <= most for t in at)}) for u, ts in own.items()}
        covered, b, n, best = set(), 0, 0, float("-inf")
        for k in itertools.count(1):
            scores = {u: round(1 - ((1 - len(covered | near[u]) / len(at)) + (1 - (b + good[u]) / (n + len(own[u])))), 9) for u in own if good[u]}
            top = max(scores, key=lambda u: (scores[u], -u), default=None)
            if top is None or scores[top] <= best + gain:
                break
            out.append((key, top, k, scores[top]))
            best, covered, b, n = scores[top], covered | near[top], b + good[top], n + len(own[top])
            del own[top]
    return out


@pytest.mark.parametrize("most", [0, 4, 500])
def test_agreement_without_pairs_of_events(spark, monkeypatch, most):
    rng, sizes = random.Random(most), []
    truth = [(k, rng.randint(0, 900)) for k in (1, 2) for _ in range(100)]
    test = [(k, u, rng.randint(-40, 940)) for k in (1, 2) for u in range(6) for _ in range(rng.randint(1, 40))]
    write = units.written

    def written(df, name):
        table = write(df, name)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(units, "written", written)
    found = units.merge_by_agreement(spark.createDataFrame(truth, "g int, t long"), spark.createDataFrame(test, "g int, u int, t long"), "g", "t", "u", most, 0.0)
    assert sorted(map(tuple, found.select("g", "u", "round", "score").collect())) == sorted(plain_agreement(truth, test, most, 0.0))
    assert max(sizes) <= len(test)


@pytest.mark.parametrize("bins, width", [(60, 7), (5, 10), (12, 1)])
def test_refractory_counts_without_pairs(spark, bins, width):
    rng = random.Random(bins)
    rows = [(k, rng.randint(-300, 2000)) for k in (1, 2) for _ in range(150)]
    a, b = spark.createDataFrame(rows[::2], "k int, t long"), spark.createDataFrame([*rows[1::2], (3, 0)], "k int, t long")
    wanted = merging.refractory_sums(spike_pairs(a, b, ["k"], "t", bins * width), ["k"], bins, width)
    found = merging.refractory_counts(a.union(spark.createDataFrame([(3, bins * width + 1)], a.schema)), b, ["k"], "t", bins, width)
    assert "t_b" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_nearest_channels_in_cells(spark):
    rng = random.Random(3)
    crowd = [(rng.randint(0, 3) / 4096, rng.randint(0, 3) / 4096) for _ in range(40)]
    places = [*crowd, *((rng.randint(0, 30) / 2, rng.randint(0, 9) / 2) for _ in range(60)), (9000.0, -40.0), (9000.0, -41.0)]
    sites = [(k, x, y) for k, (x, y) in enumerate(places)]
    plain = []
    for k, x, y in sites:
        near = sorted((((a - x) ** 2 + (b - y) ** 2) ** 0.5, other) for other, a, b in sites)[:4]
        plain += [(k, other, round(d, 5), r + 1) for r, (d, other) in enumerate(near)]
    df = spark.createDataFrame(sites, "k long, x double, y double")
    found = grid.nearest_channels(df, "k", "x", "y", 4, 8)
    assert sorted(map(tuple, found.collect())) == sorted(plain)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    assert grid.nearest_channels(df.limit(2), "k", "x", "y", 4).count() == 4
    assert grid.nearest_channels(df.limit(0), "k", "x", "y", 4).count() == 0


def test_frame_times_in_few_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{e}", c, 0, e, f, 10 * f) for e in range(60) for c in "ab" for f in range(5)], "session_id string, exp_name string, video_session int, event_no int, frame_idx long, t long").repartition(6)
    path = str(tmp_path / "times")
    for part in (rows.where("frame_idx < 3"), rows, rows):
        sinks.write_frame_times(part, path)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert len(list(tmp_path.rglob("*.parquet"))) <= 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    series = back.select("session_id", "exp_name", "event_no", F.input_file_name().alias("file")).where("frame_idx < 3").distinct()
    assert series.count() == 120


def test_few_files_for_poses_and_drop_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "place", lambda spark, name: str(tmp_path / name))
    assert queries.QUERIES["a1_read_pose3d_csv"](spark, "/root/testdata/sf0.001").count() == 1000
    assert 0 < len(list(tmp_path.rglob("pose/**/*.csv"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries.QUERIES["a3_read_drop_records"](spark, "/root/testdata/sf0.001")
    assert 0 < len([p for p in (tmp_path / "drops").rglob("part-*")]) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_many_small_recordings_are_few_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(r, c, i, r + i) for r in range(100) for c in (0, 1) for i in (0, 1, 2, 9, 10)], "r int, c int, i int, v int")
    paths = [x.path for x in recording.write_recordings(rows, str(tmp_path / "rec"), "r", "c", "i", "v", 2).collect()]
    scanned = recording.scan_samples(spark, paths, 32, 2, split_bytes=1 << 10)
    assert scanned.rdd.getNumPartitions() <= 3 and scanned.count() == 100 * 2 * 11
    assert scanned.agg(F.sum("v")).first()[0] == 2 * sum(r + i for r in range(100) for i in (0, 1, 2, 9, 10))
    packets = spark.createDataFrame([(r, t, t % 3 + 1, bytes([r, 7])) for r in range(40) for t in range(5)], "r int, t long, k int, p binary")
    paths = [x.path for x in recording.write_packets(packets, str(tmp_path / "ev"), "r", "t", "k", "p", 12).collect()]
    found = recording.scan_packets(spark, paths, 8, 12, split_bytes=24)
    assert found.rdd.getNumPartitions() <= 3
    assert sorted((r.timestamp, r.packet_id, bytes(r.payload)) for r in found.collect()) == sorted((t, t % 3 + 1, bytes([r, 7, 0, 0, 0, 0])) for r in range(40) for t in range(5))


def test_split_of_many_channels_in_few_files(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(c, i, float(i)) for c in range(50) for i in range(30)], "channel long, i long, v double").repartition(5)
    sinks.save_subset(rows, str(tmp_path), "channel", None, "i", 10, folders=False)
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = []
    for f in files:
        told = [(r.channel, r.part, r.i) for r in spark.read.parquet(str(f)).collect()]
        assert told == sorted(told)
        seen += sorted({x[:2] for x in told})
    assert len(seen) == 150 == len(set(seen))
