"""Merging of units: by agreement, and by similarity with a refractory veto."""

import math
import random

from longtrace.operators import merging, units


def test_merging_ends_when_no_key_improves(spark):
    truth = [(key, 1000 * j) for key in (1, 2) for j in range(50)]
    parts = [(1, j % 5, 1000 * j) for j in range(50)] + [(2, 0, 1000 * j) for j in range(50)] + [(2, 1, 1000 * j) for j in range(50)]
    found = units.merge_by_agreement(spark.createDataFrame(truth, "grp int, t long"), spark.createDataFrame(parts, "grp int, unit int, t long"), "grp", "t", "unit", 10, 0.01)
    got = sorted((r.grp, r["round"], r.unit, round(r.score, 6)) for r in found.collect())
    assert got == [(1, k + 1, k, round((k + 1) / 5, 6)) for k in range(5)] + [(2, 1, 0, 1.0)]


def trains(seed, units, length=4000):
    """Events of units, three from each of a few trains with a dead time."""
    rng, rows = random.Random(seed), []
    for source in range(0, units, 3):
        t = rng.randint(0, 30)
        while t < length:
            rows.append((source + min(rng.randint(0, 5) // 2, rng.randint(0, 2)), t))
            t += 6 + int(rng.expovariate(0.12))
    return rows


def plain_merges(rows, similarity, bins, width, least, most_q, most_r):
    """The walk with events read again for every pair."""
    of = {}
    for u, t in rows:
        of.setdefault(u, []).append(t)
    size, out = {u: len(x) for u, x in of.items()}, []
    for j in sorted(of, key=lambda u: (len(of[u]), u)):
        for k in sorted((u for u in of if u != j and size[u] > len(of[j]) and similarity.get((min(j, u), max(j, u)), -9) >= least), key=lambda u: (-similarity[min(j, u), max(j, u)], u)):
            n = dict.fromkeys(range(-bins, bins + 1), 0)
            for a in of[j]:
                for b in of[k]:
                    at = (1 if b > a else -1) * ((abs(b - a) + width // 2) // width)
                    if abs(at) <= bins and abs(b - a) < bins * width + width // 2:
                        n[at] += 1
            mean = lambda bs, n=n: sum(n[b] for b in bs) / len(bs)
            outer = mean([b for b in n if 1 - bins <= b <= -(bins // 2) - 1 or bins // 2 <= b <= bins - 1])
            base = max(outer, mean([b for b in n if -50 <= b <= -10]), mean([b for b in n if 11 <= b <= 49]))
            if base <= 0:
                continue
            near = [sum(c for b, c in n.items() if 0 < abs(b) <= i) for i in range(1, 11)]
            q = min(c / (2 * i) for i, c in enumerate(near, 1)) / base
            r = min(0.5 * (1 + math.erf((c / 2 - base * i) / math.sqrt(2 * base * i))) for i, c in enumerate(near, 1))
            if q < most_q and r < most_r:
                out.append((j, k, round(q, 9), round(r, 9)))
                of[k] = of[k] + of[j]
                size[k] = len(of[k])
                of[j] = []
                break
    return out


def test_merged_units_equal_a_plain_loop(spark):
    chains = 0
    for seed in range(4):
        rng, units = random.Random(seed), 9
        rows = trains(seed, units)
        similarity = {(a, b): rng.uniform(0.3, 1) for a in range(units) for b in range(a + 1, units)}
        df = spark.createDataFrame([("s", u, t) for u, t in rows], "session string, unit long, t long")
        alike = spark.createDataFrame([("s", a, b, x) for (a, b), x in similarity.items()], "session string, a long, b long, similarity double")
        found = merging.merge_units(df, alike, ["session"], "unit", "t", 60, 1, 0.5, 0.2, 0.05)
        got = [(r.unit, r.into, round(r.q, 9), round(r.r, 9)) for r in found.collect()]
        want = plain_merges(rows, similarity, 60, 1, 0.5, 0.2, 0.05)
        assert sorted(got) == sorted(want)
        chains += any(into in {u for u, *_ in want} for _, into, *_ in want)
        ends = {r.unit: r.final for r in merging.final_units(found, ["session"]).collect()}
        follow = {u: k for u, k, *_ in want}
        for u in follow:
            end = u
            while end in follow:
                end = follow[end]
            assert ends[u] == end
    assert chains


def test_a_veto_keeps_overlapping_units_apart(spark):
    rng = random.Random(1)
    free = [("s", u, rng.randint(0, 5000)) for u in (0, 1) for _ in range(300 + 50 * u)]
    shared = [("s", 2 + (k % 3 == 0), 12 * k + rng.randint(0, 3)) for k in range(420)]
    df = spark.createDataFrame(free + shared, "session string, unit long, t long")
    alike = spark.createDataFrame([("s", 0, 1, 0.9), ("s", 2, 3, 0.9), ("s", 1, 2, 0.2)], "session string, a long, b long, similarity double")
    assert [(r.unit, r.into) for r in merging.merge_units(df, alike, ["session"], "unit", "t", 60, 1).collect()] == [(3, 2)]
    assert merging.merge_units(df, alike.limit(0), ["session"], "unit", "t", 60, 1).collect() == []
