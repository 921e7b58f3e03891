"""Trajectory cleaning against plain loops."""

import numpy as np
import pandas as pd
import pytest

from longtrace.operators import trajectories
from tests.test_properties import slow_peaks, table


def plain_fix(xs, error, height, distance, window, deviation, most):
    """Slices around error peaks, one after the other, as arrays."""
    e = pd.Series(error).interpolate().to_numpy()
    mid, n = np.nanmedian(error), len(e)
    slices = []
    for p in slow_peaks(np.nan_to_num(e, nan=-1e9), height, distance, 0):
        if slices and p < slices[-1][1]:
            continue

        def nearest(back):
            w = window
            while True:
                if back and p - w < 0 or not back and w > window and p + w > n:
                    return None
                part = range(p - 1, p - w - 1, -1) if back else range(p, min(n, p + w))
                for m in (1, 2, 3, 4):
                    for k in part:
                        if e[k] < m * mid:
                            return k
                w += 10

        a, b = nearest(True), nearest(False)
        if a is not None and b is not None:
            slices.append((a, b + 1))
    out = [x.copy() for x in xs]
    for a, b in slices:
        lines = [np.linspace(x[a], x[b - 1], b - a) for x in xs]
        off = np.sqrt(sum((x[a:b] - line) ** 2 for x, line in zip(xs, lines))).mean()
        if not np.isnan(off) and (off > deviation or e[a:b].max() > most):
            for o, line in zip(out, lines):
                o[a:b] = line
    return out, slices


@pytest.mark.parametrize("chunk", [8, 50, 1000])
def test_jumps_are_fixed_as_by_a_loop(spark, chunk):
    rows, want, widened = [], {}, 0
    for k in range(6):
        rnd = np.random.default_rng(k)
        n = 160
        error = rnd.gamma(2, 3, n)
        for at in rnd.integers(5, n - 5, 7):
            size = rnd.integers(1, 25)
            error[at : at + size] += rnd.uniform(20, 60) * np.hanning(size + 2)[1:-1][: n - at]
        error[rnd.integers(1, n, 6)] = np.nan
        xs = [np.cumsum(rnd.normal(0, 1, n)) + 30 * (error > 25), np.cumsum(rnd.normal(0, 2, n))]
        if k == 5:
            xs[0][rnd.integers(0, n, 5)] = np.nan
        fixed, slices = plain_fix(xs, error, 25, 8, 6, 4.0, 60)
        widened += sum(b - a > 14 for a, b in slices)
        for i in range(n):
            rows.append((k, i, *(None if np.isnan(x[i]) else float(x[i]) for x in (*xs, error))))
            want[k, i] = [x[i] for x in fixed]
    df = table(spark, rows, "k long, f long, x double, y double, e double")
    got = {(r.k, r.f): (r.fixed_x, r.fixed_y) for r in trajectories.fix_jumps(df, ["k"], "f", ["x", "y"], "e", 25, 8, 6, 4.0, 60, chunk).collect()}
    assert widened and got.keys() == want.keys()
    for key, pair in got.items():
        assert [np.nan if v is None else v for v in pair] == pytest.approx(want[key], abs=1e-9, nan_ok=True), key


def test_peaks_within_a_window(spark):
    rnd = np.random.default_rng(4)
    x = np.round(np.cumsum(rnd.normal(0, 2, 150)) + rnd.normal(0, 2, 150), 1)
    df = table(spark, [("a", i, float(v)) for i, v in enumerate(x)], "k string, f long, x double")
    for wlen in (4, 15, 31):
        want = []
        for p in slow_peaks(x, -100, 3, 0):
            sides = []
            for step in (-1, 1):
                low, q = x[p], p
                while 0 <= q < len(x) and abs(q - p) <= wlen // 2 and x[q] <= x[p]:
                    low, q = min(low, x[q]), q + step
                sides.append(low)
            if x[p] - max(sides) >= 2:
                want.append(p)
        assert sorted(r.f for r in trajectories.find_peaks(df, ["k"], "f", "x", -100, 3, 2, 16, wlen).collect()) == want


def test_smoothing_doesnt_depend_on_chunks(spark):
    rnd = np.random.default_rng(6)
    rows = [(k, int(f), None if rnd.random() < 0.05 else float(rnd.normal())) for k in ("a", None) for f in np.flatnonzero(rnd.random(220) > 0.03)]
    df = table(spark, rows, "k string, f long, x double")
    results = [sorted((str(r.k), r.f, r.smooth) for r in trajectories.savgol_smooth(df, ["k"], "f", "x", 7, chunk=c).collect()) for c in (5, 16, 10_000)]
    assert str(results[0]) == str(results[1]) == str(results[2])


def test_a_long_trajectory_in_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = table(spark, [(k, i, float(i)) for k, n in ((None, 30), (1, 5), (2, 40), (3, 1)) for i in range(n)], "k long, f long, x double")
        got = trajectories.per_trajectory(df, ["k"], "f", ["x"], {"s": trajectories.T.DoubleType()}, lambda p: {"s": p["x"].cumsum()})
        assert sorted((str(r.k), r.f, r.s) for r in got.collect()) == sorted((str(k), i, i * (i + 1) / 2) for k, n in ((None, 30), (1, 5), (2, 40), (3, 1)) for i in range(n))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_gaps_and_slices_by_hand(spark):
    df = table(spark, [(1, i, None if i in (0, 3, 4, 8, 9, 10, 14) else float(i * i)) for i in range(15)], "k long, f long, x double")
    for chunk in (3, 100):
        got = [r.filled for r in trajectories.fill_gaps(df, ["k"], "f", "x", 4, chunk).orderBy("f").collect()]
        want = [None if i in (0, 8, 9, 10, 14) else float(i * i) for i in range(15)]
        want[3], want[4] = 4 + 21 / 3, 4 + 2 * 21 / 3
        assert got == pytest.approx(want)
    x = [(1, i, float(i), 1.0 if i % 2 else 2.0) for i in range(30)]
    rows = table(spark, x, "k long, f long, x double, e double")
    manual = table(spark, [(1, 5, 6), (1, 28, 29)], "k long, first long, last long")
    kept = {r.f: r.kept for r in trajectories.trim_tail(rows, ["k"], "f", rows.f < 12, rows.f < 28, 0.25, 2, 5, 2, manual, 7).collect()}
    # unchanged frames end at 12 and the end is frame 27: below a quarter from frame 8 on, as the cubic smooths it
    share = [(12 - f) / (27 - f) if f < 12 else 0.0 for f in range(27)]
    fit, powers = trajectories.savgol_fit(5, 3)
    smooth = [float((powers @ (fit @ np.array(share[:5])))[f]) if f < 2 else float((powers @ (fit @ np.array(share[-5:])))[f - 22]) if f > 24 else float(fit[0] @ np.array(share[f - 2 : f + 3])) for f in range(27)]
    cut = min(f for f in range(27) if smooth[f] < 0.25 and smooth[f] < 0.25 * max(smooth[2:25]))
    assert kept == {f: f < cut and f not in (5, 6) for f in range(30)}
