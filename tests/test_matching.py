"""Counts with surplus and lost pulses, and units of several sorters."""

import random

from pyspark.sql import functions as F

from longtrace.operators import matching


def planted(seed, surplus):
    """Video counts, and the same as pulses with noise and surplus events at known places."""
    rng = random.Random(seed)
    video = [rng.randint(200, 5000) for _ in range(60)]
    pulses = [(c + rng.randint(-8, 8), k) for k, c in enumerate(video)]
    for at in sorted(rng.sample(range(1, 58), surplus)):
        i = next(j for j, (_, k) in enumerate(pulses) if k == at)
        pulses[i:i] = [(rng.randint(6000, 9000), None)] * rng.randint(1, 3)
    return video, pulses


def test_surplus_pulses_are_dropped(spark):
    rows_p, rows_v, want = [], [], {}
    for seed in range(6):
        video, pulses = planted(seed, seed)
        rows_v += [(seed, k, c) for k, c in enumerate(video)]
        rows_p += [(seed, 10 + i, c) for i, (c, _) in enumerate(pulses)]
        want |= {(seed, 10 + i): k for i, (_, k) in enumerate(pulses)}
    p, v = spark.createDataFrame(rows_p, "k long, n long, c long"), spark.createDataFrame(rows_v, "k long, n long, c long")
    got = {(r.k, r.n): r.video for r in matching.count_align(p, v, ["k"], "n", "c").collect()}
    assert got == want


def test_lost_pulses_shift_the_list(spark):
    rng = random.Random(5)
    video = [rng.randint(100, 900) for _ in range(20)]
    p = spark.createDataFrame([(1, k, c) for k, c in enumerate(video[3:])], "k long, n long, c long")
    v = spark.createDataFrame([(1, k, c) for k, c in enumerate(video)], "k long, n long, c long")
    assert {r.n: r.video for r in matching.count_align(p, v, ["k"], "n", "c").collect()} == {k: k + 3 for k in range(17)}
    assert matching.count_align(p.limit(0), v, ["k"], "n", "c").collect() == []


def test_free_runs_allow_a_share(spark):
    p = spark.createDataFrame([("free", 0, 1150), ("free", 1, 500), ("free", 2, 90), ("own", 0, 1150), ("own", 1, 1000), ("own", 2, 500)], "k string, n long, c long")
    v = spark.createDataFrame([("free", 0, 1000), ("free", 1, 500), ("own", 0, 1000), ("own", 1, 500)], "k string, n long, c long")
    got = {(r.k, r.n): r.video for r in matching.count_align(p, v, ["k"], "n", "c", free=F.col("k") == "free").collect()}
    assert got == {("free", 0): 0, ("free", 1): 1, ("free", 2): None, ("own", 0): None, ("own", 1): 0, ("own", 2): 1}


def test_groups_need_enough_sorters(spark):
    rng = random.Random(3)
    rows = []
    for unit in range(5):
        train = sorted(rng.sample(range(0, 200_000, 40), 120))
        for k, sorter in enumerate("abcd"[: 2 + unit % 3]):
            rows += [(sorter, 10 * unit + k, t + rng.randint(-3, 3)) for t in train if rng.random() < 0.95]
    df = spark.createDataFrame(rows, "s string, u long, t long")
    links = {(r.sorter_a, r.a, r.sorter_b, r.b) for r in matching.sorter_agreement(df, "s", "u", "t", 8, 0.6).collect()}
    assert links == {("abcd"[i], 10 * u + i, "abcd"[j], 10 * u + j) for u in range(5) for i in range(2 + u % 3) for j in range(i + 1, 2 + u % 3)}
    got = {(r.sorter, r.unit, r.group_unit, r.n) for r in matching.consensus_units(df, "s", "u", "t", 8, 0.6, 3).collect()}
    assert got == {("abcd"[k], 10 * u + k, 10 * u, 2 + u % 3) for u in range(5) if u % 3 for k in range(2 + u % 3)}


def slow_agreement(rows, most, least):
    """All pairs of units of two sorters, every event against every other."""
    trains = {}
    for s, u, t in rows:
        trains.setdefault((s, u), []).append(t)
    out = set()
    for a, x in trains.items():
        for b, y in trains.items():
            m = len({t for t in x if any(abs(t - v) <= most for v in y)}) if a[0] < b[0] else 0
            if m and m / (len(x) + len(y) - m) >= least:
                out.add((*a, *b, m, round(m / (len(x) + len(y) - m), 9)))
    return out


def test_agreement_equals_all_pairs(spark):
    """Trains of differing length and density, with bursts, repeated times and equal trains, at several thresholds."""
    rng = random.Random(11)
    rows = []
    for unit in range(40):
        train = sorted(rng.sample(range(0, 4000 if unit % 4 else 400), rng.choice([1, 2, 3, 5, 9, 30, 60])))
        for k, sorter in enumerate("abc"):
            for copy in range(1 + unit % 3 // 2):
                jitter = 0 if unit % 5 == 0 else 4
                rows += [(sorter, 100 * unit + 10 * k + copy, t + rng.randint(-jitter, jitter)) for t in train if rng.random() < 0.95 or unit % 5 == 0]
    rows += [("a", 9000, 5), ("a", 9000, 5), ("b", 9001, 6), ("c", 9002, 4000), ("c", 9003, 4003)]
    df = spark.createDataFrame(rows, "s string, u long, t long")
    for most, least in ((4, 0.75), (4, 0.6), (8, 0.5), (2, 0.3), (4, 0.95)):
        got = [(r.sorter_a, r.a, r.sorter_b, r.b, r.matched, round(r.score, 9)) for r in matching.sorter_agreement(df, "s", "u", "t", most, least).collect()]
        assert len(got) == len(set(got)) and set(got) == slow_agreement(rows, most, least)


def test_few_pairs_are_proposed(spark, monkeypatch):
    """Units active in the same stretches aren't all brought together, and equal trains once."""
    rng = random.Random(2)
    rows = [(s, u, t) for s in "ab" for u in range(60) for t in rng.sample(range(0, 20_000, 20), 100)]
    rows += [("a", 100 + k, t) for k in range(5) for t in range(7, 20_000, 200)] + [("b", 200 + k, t) for k in range(5) for t in range(9, 20_000, 200)]
    seen, kept = {}, matching.written
    monkeypatch.setattr(matching, "written", lambda df, name: seen.setdefault(name, kept(df, name)))
    df = spark.createDataFrame(rows, "s string, u long, t long")
    got = {(r.a, r.b) for r in matching.sorter_agreement(df, "s", "u", "t", 4, 0.75).collect()}
    assert got == {(100 + i, 200 + j) for i in range(5) for j in range(5)}
    assert [tuple(r) for r in seen["possible"].select("a", "b").collect()] == [(100, 200)]


def test_shifts_are_not_rows(spark):
    """Shifts are tried within a key's list, holes in the numbers included; no row is made of each."""
    rng = random.Random(8)
    video = {k: rng.randint(1, 9) for k in range(3, 90) if k % 7}
    pulses = {k: rng.randint(1, 9) for k in range(0, 60) if k % 5}
    cost = [sum(abs(c - video.get(k + s, 0)) for k, c in pulses.items()) for s in range(31)]
    p = spark.createDataFrame([(1, k, c) for k, c in pulses.items()] + [(2, 0, 1), (None, 0, 1)], "k long, n long, c long")
    v = spark.createDataFrame([(1, k, c) for k, c in video.items()] + [(3, 0, 1), (None, 0, 1), (None, 1, 1)], "k long, n long, c long")
    got = matching.count_align(p, v, ["k"], "n", "c", most=30)
    assert {(r.k, r.n): r.video for r in got.collect()} == {(1, k): k + cost.index(min(cost)) for k in pulses}
    assert "Generate" not in got._jdf.queryExecution().toString()
