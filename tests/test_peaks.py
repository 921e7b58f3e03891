"""Chunked peaks against their definition, for any chunk."""

import numpy as np
import pytest

from longtrace.functions import peaks
from tests.test_properties import slow_peaks, table


def series():
    rnd = np.random.default_rng(21)
    yield "steps", rnd.integers(0, 12, 160).astype(float)
    yield "flat", np.repeat(rnd.integers(0, 6, 30), rnd.integers(1, 14, 30)).astype(float)
    yield "rising", np.arange(150) + 4.0 * (np.arange(150) % 2)
    yield "falling", 200 - np.arange(150) + 4.0 * (np.arange(150) % 2)
    yield "hills", 20 * np.sin(np.arange(200) / 9) + rnd.normal(0, 3, 200)
    yield "one", np.array([3.0])
    yield "same", np.full(40, 7.0)


@pytest.mark.parametrize("chunk", [1, 5, 32, 1000])
@pytest.mark.parametrize("limits", [(2, 1, 0.0), (4, 3, 2.0), (-50, 12, 5.0)])
def test_any_chunk(spark, chunk, limits):
    height, distance, prominence = limits
    df = table(spark, [(k, i, float(v)) for k, x in series() for i, v in enumerate(x)], "k string, f long, x double")
    got = sorted((r.k, r.f) for r in peaks.find_peaks(df, ["k"], "f", "x", height, distance, prominence, chunk).collect())
    assert got == sorted((k, p) for k, x in series() for p in slow_peaks(x, height, distance, prominence))


def test_what_rounds_leave_is_walked(spark):
    x = np.arange(150) + 4.0 * (np.arange(150) % 2)
    df = table(spark, [("a", i, float(v)) for i, v in enumerate(x)], "k string, f long, x double")
    tops = peaks.local_maxima(df, ["k"], "f", "x", 0, 16)
    got = sorted(r.f for r in peaks.thinned(tops, ["k"], "f", "x", 7, 16, rounds=1).collect())
    assert got == slow_peaks(x, 0, 7, 0)


def test_missing_values_are_no_peaks_and_end_a_side(spark):
    x = [1.0, 5.0, None, 4.0, 1.0, 6.0, 2.0, float("nan"), 0.0]
    df = table(spark, [("a", i, v) for i, v in enumerate(x)], "k string, f long, x double")
    for chunk in (2, 100):
        tops = peaks.local_maxima(df, ["k"], "f", "x", 0, chunk)
        assert [r.f for r in tops.collect()] == [5]
        assert [(r.f, r.rise) for r in peaks.prominences(df, tops, ["k"], "f", "x", chunk).collect()] == [(5, 4.0)]
    assert peaks.find_peaks(df.limit(0), ["k"], "f", "x", 0, 3, 1.0).collect() == []
