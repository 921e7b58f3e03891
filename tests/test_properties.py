"""Small fixtures, property tests against plain loops, chunk invariance and plan shapes."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtrace.functions.islands import islands
from longtrace.operators import aggregates, geometry, grid, identity, joins, scalar, sequence, signals, trajectories, units
from longtrace.plans import standins

SF = "/root/testdata/sf0.001"


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_onsets_and_events_fixture(spark):
    rows = table(spark, [(1, i, 5.0) for i in (2, 3, 4, 8, 9, 100, 101)] + [(1, 50, 0.0)], "c long, i long, v double")
    for chunk in (3, 7, 1000):
        assert sorted(r.i for r in sequence.pulse_onsets(rows, ["c"], "i", "v", 1, chunk).collect()) == [2, 8, 100]
        got = sequence.segment_events(rows.where("v > 1"), ["c"], "i", 25, chunk)
        assert sorted((r.start, r.stop) for r in got.collect()) == [(2, 9), (100, 101)]


def test_dropout_fixtures(spark):
    rows = lambda ts: table(spark, [(1, t) for t in ts], "k long, t long")
    got = lambda ts: sorted(tuple(r)[1:] for r in sequence.dropout_intervals(rows(ts), ["k"], "t", 0, 6, 1, chunk=2).collect())
    assert got([0, 1, 4]) == [(2, 4, 2), (5, 6, 1)]
    assert got([0, 1, 2, 3, 4, 6]) == []


def test_duplicate_spikes_fixture(spark):
    rows = table(spark, [(1, 0, "good"), (1, 100, "good"), (1, 300, "good"), (1, 10000, "good"), (2, 0, "mua"), (2, 100, "mua")], "u long, t long, q string")
    got = sequence.drop_duplicate_spikes(rows, ["u"], "t", 150, F.col("q") == "good")
    assert sorted((r.u, r.t) for r in got.collect()) == [(1, 100), (1, 300), (1, 10000), (2, 0), (2, 100)]


def test_chunks_fixture(spark):
    rows = table(spark, [(1, i, c == "1") for i, c in enumerate("1110011110000110111")], "k long, f long, ok boolean")
    got = sequence.clean_chunks(rows, ["k"], "f", F.col("ok"), 3, 3)
    assert sorted((r.first, r.last) for r in got.collect()) == [(0, 8), (16, 18)]


def test_frame_gap_fixture(spark):
    rows = table(spark, [(1, "a", n, n) for n in (2, 3, 6)] + [(1, "b", n, n) for n in range(1, 9)], "e long, c string, n long, t long")
    made = sequence.fill_dropped_frames(rows, "e", "c", "n", "t", 1).where("c = 'a'")
    assert sorted((r.n, r.source) for r in made.collect()) == [(1, 2), (4, 3), (5, 3), (7, 6), (8, 6)]


def test_frame_number_and_overlap_fixtures(spark):
    rows = table(spark, [(1, n, t) for n, t in ((1, 0), (2, 10), (3, 40), (4, 50))], "k long, n long, t long")
    assert [r.repaired for r in sequence.repair_frame_numbers(rows, ["k"], "n", "t", 10).orderBy("t").collect()] == [1, 2, 5, 6]
    rows = table(spark, [(1, 0, 10), (1, 10, 12), (1, 15, 20)], "k long, a long, b long")
    assert sorted((r.a, r.b) for r in sequence.merge_overlaps(rows, ["k"], "a", "b").collect()) == [(0, 12), (15, 20)]


def test_scalar_fixtures(spark):
    ids = spark.range(5)
    assert [r[0] for r in ids.select(scalar.shift_removed_channels(F.col("id"), [2, 5])).collect()] == [0, 1, 3, 4, 6]
    clock = spark.createDataFrame([("1501-59",), ("1502-00",)], "c string").select(scalar.clock_to_seconds(F.col("c")).alias("s")).collect()
    assert clock[1].s - clock[0].s == 1
    assert spark.range(1).select(scalar.parse_channel_from_unit(F.lit("ch12#0")).alias("c")).first().c == 11
    low = spark.createDataFrame([(0.74, 9.0), (0.75, 9.0)], "p double, x double").select(scalar.low_conf_to_origin(F.col("x"), F.col("p")).alias("x"))
    assert [r.x for r in low.collect()] == [0.0, 9.0]


def test_unit_fixtures(spark):
    rows = table(spark, [(1, 0), (1, 1000), (1, 1_000_000)], "u long, t long")
    rate = aggregates.unit_rates(rows, ["u"], "t", 1500).first()
    assert rate.violations == 1 and rate.isi_violation_rate * 1e0 == pytest.approx(37.037037, rel=1e-6)
    pairs = joins.spike_pairs(table(spark, [(1, 0), (1, 10)], "p long, t long"), table(spark, [(1, 1), (1, 200)], "p long, t long"), ["p"], "t", 5)
    assert [(r.bin, r.n) for r in aggregates.cross_correlogram(pairs, "p", 5, 1).where("n > 0").collect()] == [(1, 1)]


def test_stitch_fixture(spark):
    rows = table(spark, [(1, 0, 10, 3), (1, 20, 25, 2)], "c long, start long, stop long, n long")
    got = identity.stitch_fragments(rows, ["c"], 5, 50).orderBy("start").collect()
    assert [(r.whole, r.offset) for r in got] == [(1, 0), (1, 4)]


@pytest.mark.parametrize("seed", [1, 2])
def test_islands_match_a_loop(spark, seed):
    rnd = random.Random(seed)
    rows = [(k, t) for k in range(4) for t in sorted(rnd.sample(range(400), 80))]

    def loop(gap):
        out = []
        for k in range(4):
            run = None
            for t in [t for j, t in rows if j == k]:
                if run and t - run[2] <= gap:
                    run[2], run[3] = t, run[3] + 1
                else:
                    run = [k, t, t, 1]
                    out.append(run)
        return sorted(map(tuple, out))

    df = table(spark, rows, "k long, t long")
    for gap, chunk in ((1, None), (5, 7), (5, 64), (12, 5), (12, 10**6)):
        assert sorted(tuple(r) for r in islands(df, ["k"], "t", gap, chunk).collect()) == loop(gap)


def test_spikes_match_a_loop(spark):
    rnd = np.random.default_rng(4)
    v = rnd.normal(0, 10, 600)

    def loop(threshold, dead):
        at, out, free = 0, [], -1
        above = np.flatnonzero(np.abs(v) > threshold)
        while at < len(above):
            i = above[at]
            if i < free:
                at += 1
                continue
            near = above[(above >= i) & (above < i + max(1, dead // 2))]
            peak = near[np.argmax(np.abs(v[near]))]
            out.append(int(peak))
            free = peak + dead
            at += len(near)
        return out

    df = table(spark, [(1, i, float(x)) for i, x in enumerate(v)], "c long, i long, v double")
    for threshold, dead in ((22, 8), (3, 8), (3, 25)):  # the last two: dense crossings, islands longer than a chunk
        want = loop(threshold, dead)
        for chunk in (16, 64, 1_000):
            assert sorted(r.i for r in units.detect_spikes(df, ["c"], "i", "v", threshold, 1e9, dead, chunk).collect()) == want


def test_stencil_and_filter_do_not_depend_on_chunk(spark):
    rnd = np.random.default_rng(6)
    df = table(spark, [(k, i, float(x)) for k in range(2) for i, x in enumerate(rnd.normal(size=300))], "k long, i long, v double")
    out = [[r.smooth for r in sequence.gaussian_smooth(df, ["k"], "i", "v", chunk=c).orderBy("k", "i").collect()] for c in (20, 77, 10**6)]
    assert np.allclose(out[0], out[1]) and np.allclose(out[0], out[2])
    b, a = signals.butterworth(2, 50, 200, 1000)
    out = [[r.filtered for r in signals.bandpass(df, ["k"], "i", "v", b, a, c, 150).orderBy("k", "i").collect()] for c in (100, 10**6)]
    assert np.allclose(out[0], out[1], atol=1e-6)
    w = np.exp(-2j * np.pi * np.array([10, 100, 400]) / 1000)
    gain = np.abs(np.polyval(b[::-1], w) / np.polyval(a[::-1], w))
    assert gain[1] > 0.9 and gain[0] < 0.1 and gain[2] < 0.2


def test_savgol_keeps_cubics(spark):
    df = table(spark, [(1, i, float(i**3 - 4 * i)) for i in range(20)] + [(1, i, float(i)) for i in (30, 31)], "k long, f long, x double")
    got = {r.f: r.smooth for r in trajectories.savgol_smooth(df, ["k"], "f", "x", 7).collect()}
    assert all(got[i] == pytest.approx(i**3 - 4 * i, abs=1e-6) for i in range(20)) and got[30] == 30


def test_nearest_channels(spark):
    sites = table(spark, [(k, float(k), 0.0) for k in range(5)], "k long, x double, y double")
    assert {(r.k, r.other) for r in grid.nearest_channels(sites, "k", "x", "y", 2).where("rank = 2").collect()} == {(0, 1), (1, 0), (2, 1), (3, 2), (4, 3)}


def test_band_joins_have_no_nested_loop(spark):
    for name, module in (("f1_frames_in_event", joins), ("f15_spike_pair_band_join", joins), ("f16_near_duplicates", joins), ("f25_break_to_frame", joins), ("e13_isolated_peaks", signals)):
        plan = module.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_scans_are_pruned(spark):
    plan = standins.spikes(spark, SF).select("unit", "t")._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "event_type" not in plan


def test_library_stands_without_llm(tmp_path):
    root = Path(__file__).resolve().parents[1]
    for p in root.iterdir():
        if p.name not in {"corpus_pipeline.py", "longtrace", ".git"}:
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "longtrace").mkdir()
    for p in (root / "longtrace").iterdir():
        if p.name != "llm":
            (tmp_path / "longtrace" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def slow_peaks(x, height, distance, prominence):
    """Peaks by their definition, each against all others and the whole series."""
    tops = []
    for i in range(1, len(x) - 1):
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j + 1 < len(x) and x[j + 1] < x[i] and x[i] >= height:
            tops.append((i + j) // 2)
    kept = []
    for p in sorted(tops, key=lambda p: (-x[p], p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        lows = []
        for step in (-1, 1):
            low, q = x[p], p
            while 0 <= q < len(x) and x[q] <= x[p]:
                low, q = min(low, x[q]), q + step
            lows.append(low)
        if x[p] - max(lows) >= prominence:
            out.append(p)
    return out


def test_bandpass_matches_a_plain_loop(spark):
    """Many series of different lengths, filtered together, against one at a time."""
    rnd = np.random.default_rng(9)
    series = {k: rnd.normal(size=n) for k, n in enumerate((1, 5, 40, 41, 300))}
    b, a = signals.butterworth(2, 50, 200, 1000)

    def once(x):
        out = []
        for i in range(len(x)):
            out.append(sum(b[j] * x[i - j] for j in range(len(b)) if i >= j) - sum(a[j] * out[i - j] for j in range(1, len(a)) if i >= j))
        return out

    df = table(spark, [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)], "k long, i long, v double")
    got = {(r.k, r.i): r.filtered for r in signals.bandpass(df, ["k"], "i", "v", b, a, 4096, 512).collect()}
    want = {(k, i): v for k, x in series.items() for i, v in enumerate(once(once(x)[::-1])[::-1])}
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(want[key], abs=1e-9) for key in want)


def test_reach_segments_match_a_plain_loop(spark):
    rnd = np.random.default_rng(10)
    y, s = rnd.uniform(40, 90, 150), rnd.uniform(0, 40, 150)
    up = lambda x, level: [(i, 1 if x[i + 1] > level else -1) for i in range(len(x) - 1) if (x[i + 1] > level) != (x[i] > level)]
    ys, ss = up(y, 60), up(s, 15)
    want = set()
    for i, way in ys:
        if way == 1:
            rise = [j for j, w in ss if w == 1 and j <= i]
            falls = [i2 for i2, w in ys if w == -1 and i2 > i]
            ends = [j for j, w in ss if w == -1 and falls and j >= falls[0]]
            if rise and ends:
                held = tuple(p for p in slow_peaks(y, 70, 1, 0) if rise[-1] <= p < ends[0])
                if held:
                    want.add((rise[-1], ends[0], held))
    df = table(spark, [(1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, s, strict=True))], "k long, f long, y double, s double")
    got = {(r.start, r.stop, tuple(r.peaks)) for r in trajectories.reach_segments(df, ["k"], "f", "y", "s", 60, 15, 70).collect()}
    assert got == want and want


def test_whitened_vectors_are_uncorrelated(spark):
    rnd = np.random.default_rng(11)
    rows = rnd.normal(size=(400, 4)) @ rnd.normal(size=(4, 4))
    df = table(spark, [(i, [float(v) for v in r]) for i, r in enumerate(rows)], "k long, v array<double>")
    white = np.array([r.white for r in signals.whiten(df, "k", "v", 4, ridge=0.0).collect()])
    assert np.allclose(white.T @ white / len(white), np.eye(4), atol=1e-6)


def test_local_whitening(spark):
    rnd = np.random.default_rng(15)
    x = rnd.normal(size=(300, 5)) @ rnd.normal(size=(5, 5))
    df = table(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)], "k long, v array<double>").repartition(3)
    sites = table(spark, [(k, float(k * k), 0.0) for k in range(5)], "channel int, x double, y double")
    dense = {r.k: r.white for r in signals.whiten(df, "k", "v", 5).collect()}
    local = {r.k: r.white for r in signals.whiten_local(df, "k", "v", grid.nearest_channels(sites, "channel", "x", "y", 5), 5).collect()}
    assert all(local[k] == pytest.approx(dense[k], abs=1e-6) for k in dense)
    got = np.array([r.white for r in signals.whiten_local(df, "k", "v", grid.nearest_channels(sites, "channel", "x", "y", 3), 5).orderBy("k").collect()])
    cov = x.T @ x / len(x)
    for j in range(5):
        near = sorted(range(5), key=lambda k: (abs(k * k - j * j), k))[:3]
        d, e = np.linalg.eigh(cov[np.ix_(near, near)])
        assert got[:, j] == pytest.approx(x[:, near] @ (e @ np.diag(1 / np.sqrt(d + 1e-6)) @ e.T)[:, 0], abs=1e-6)


def test_rigid_body_pose_finds_the_turn(spark):
    rnd = np.random.default_rng(12)
    base = rnd.normal(size=(3, 3))
    rows = []
    for f in range(6):
        q, _ = np.linalg.qr(rnd.normal(size=(3, 3)))
        turn = np.eye(3) if f == 0 else q * np.sign(np.linalg.det(q))
        rows += [(1, f, m, *map(float, turn @ p + f)) for m, p in zip("abc", base, strict=True)]
        last = turn
    got = geometry.rigid_body_pose(table(spark, rows, "e long, f long, m string, x double, y double, z double"), ["e"], "f", "m", ["a", "b", "c"]).orderBy("f").collect()
    assert len(got) == 6 and all(r.rmse < 1e-9 for r in got)
    assert np.allclose(np.array(got[-1].rotation).reshape(3, 3), last)


def test_bimodal_split_finds_two_groups(spark):
    rnd = np.random.default_rng(13)
    rows = [(1, float(v)) for v in np.concatenate([rnd.normal(0, 1, 500), rnd.normal(10, 1, 300)])] + [(2, float(v)) for v in rnd.normal(0, 1, 800)]
    got = {r.u: r for r in units.bimodal_split(table(spark, rows, "u long, v double"), "u", "v", 30, 3.0).collect()}
    assert got[1].split and abs(got[1].low_mean) < 0.3 and abs(got[1].high_mean - 10) < 0.3 and 2 < got[1].threshold < 8
    assert not got[2].split


def test_principal_components_match_numpy(spark):
    rnd = np.random.default_rng(14)
    rows = rnd.normal(size=(200, 5)) @ rnd.normal(size=(5, 5))
    df = table(spark, [(i, [float(v) for v in r]) for i, r in enumerate(rows)], "k long, v array<double>")
    got = np.array([r.features for r in units.pca_features(df, "k", "v", 2).orderBy("k").collect()])
    _, vectors = np.linalg.eigh(np.cov(rows.T))
    for c in range(2):
        load = vectors[:, -1 - c]
        assert np.allclose(got[:, c], rows @ (load * np.sign(load[np.abs(load).argmax()])), atol=1e-8)
