"""Class templates, assignment in blocks, and drift rounds."""

from collections import Counter

import numpy as np
import pytest

from longtrace.operators import aggregates, classes

D = 3


@pytest.fixture(scope="module")
def points(spark):
    rnd = np.random.default_rng(2)
    rows = [(k, "abcde"[k % 5] if k % 7 else None, (rnd.normal(0, 1, D) * [1, 2, 0.5] + 3 * (k % 5)).tolist()) for k in range(200)] + [(900, "a", None), (901, "lone", [1.0, 2.0, 3.0])]
    return rows, spark.createDataFrame(rows, "k long, label string, x array<double>").cache()


def known(rows):
    return [(name, np.array(x)) for _, name, x in rows if name is not None and x is not None]


def test_templates_equal_numpy(points):
    rows, df = points
    made = {r.label: r for r in classes.class_templates(df, "label", "x").collect()}
    of = {n: np.array([x for m, x in known(rows) if m == n]) for n in {m for m, _ in known(rows)}}
    assert made.keys() == of.keys()
    for name, x in of.items():
        r = made[name]
        assert r.n == len(x) and r["mean"] == pytest.approx(x.mean(0)) and r.sd == pytest.approx(x.std(0), abs=1e-7) and r.distance_sd == pytest.approx(np.sqrt(x.var(0).sum()), abs=1e-7)
        if name == "lone":
            assert r.inverse is None and r.logdet is None
        else:
            assert np.array(r.inverse).reshape(D, D) == pytest.approx(np.linalg.inv(np.cov(x.T))) and r.logdet == pytest.approx(np.linalg.slogdet(np.cov(x.T))[1])
    flat = df.sparkSession.createDataFrame([("s", [1.0, 2.0]), ("s", [2.0, 4.0]), ("s", [3.0, 6.0])], "label string, x array<double>")
    assert classes.class_templates(flat, "label", "x").first().inverse is None
    assert classes.class_templates(flat, "label", "x", ridge=0.1).first().inverse is not None
    assert classes.class_templates(flat.limit(0), "label", "x").collect() == []


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_blocks_dont_matter(points, block):
    rows, df = points
    x, names = np.array([v for _, v in known(rows)]), [n for n, _ in known(rows)]
    made = classes.class_templates(df, "label", "x")
    typical = classes.typical_distances(df, "label", "x", made, D)
    groups = {n: x[[m == n for m in names]] for n in set(names)}
    fit = {n: (g.mean(0), np.linalg.inv(np.cov(g.T)), np.linalg.slogdet(np.cov(g.T))[1]) for n, g in groups.items() if n != "lone"}
    form = lambda p, n: (p - fit[n][0]) @ fit[n][1] @ (p - fit[n][0])
    usual = {n: np.sqrt(np.mean([form(p, n) for p in groups[n]])) for n in fit}
    spread = np.sqrt(x.var(0).sum())
    queries = df.where("x is not null")
    got = {how: {r.k: r.cluster for r in q.collect()} for how, q in (
        ("centre", classes.by_centre(queries, "x", made, D, 0.9, block)),
        ("ml", classes.by_likelihood(queries, "x", made, D, block)),
        ("mahal", classes.by_mahalanobis(queries, "x", made, typical, D, 0.8, block)),
        ("nn", classes.by_neighbours(queries, "x", df, "label", "x", 5, 4, 0.3, max(block, 150))),
    )}
    for k, _, v in rows:
        if v is None:
            continue
        p = np.array(v)
        inside = [(np.linalg.norm(p - g.mean(0)), n) for n, g in groups.items() if np.linalg.norm(p - g.mean(0)) < 0.9 * np.sqrt(g.var(0).sum())]
        assert got["centre"][k] == (min(inside)[1] if inside else None)
        assert got["ml"][k] == min((form(p, n) + fit[n][2], n) for n in fit)[1]
        d, n = min((form(p, n), n) for n in fit)
        assert got["mahal"][k] == (n if np.sqrt(d) < 0.8 * usual[n] else None)
        near = sorted((np.linalg.norm(p - y), m) for y, m in zip(x, names, strict=True) if np.linalg.norm(p - y) < 0.3 * spread)[:5]
        votes = sorted((-c, m) for m, c in Counter(m for _, m in near).items())
        assert got["nn"][k] == (votes[0][1] if votes and -votes[0][0] >= 4 else None)


@pytest.mark.parametrize("block", [9, 1 << 20])
def test_equal_points_are_compared_once(spark, monkeypatch, block):
    rnd = np.random.default_rng(4)
    vectors = rnd.normal(0, 1, (12, D)).tolist()
    rows = [(k, "abc"[k % 3] if k % 4 else None, vectors[k % 12]) for k in range(600)] + [(900, "a", None), (901, None, None)]
    df = spark.createDataFrame(rows, "k long, label string, x array<double>")
    seen, kept = {}, classes.written
    monkeypatch.setattr(classes, "written", lambda df, name: seen.setdefault(name, kept(df, name)) if name == "classified" else kept(df, name))
    got = {r.k: (r.cluster, r.votes) for r in classes.by_neighbours(df, "x", df, "label", "x", 60, 30, 1.5, block).collect()}
    x, names = np.array([v for _, v in known(rows)]), [n for n, _ in known(rows)]
    spread = np.sqrt(x.var(0).sum())
    for k, _, v in rows:
        near = sorted((d, m) for d, m in zip(np.linalg.norm(x - np.array(v), axis=1).round(9), names, strict=True) if d < 1.5 * spread)[:60] if v else []
        n, best = min(((-c, m) for m, c in Counter(m for _, m in near).items()), default=(0, None))
        assert got[k] == (best if -n >= 30 else None, -n)
    assert len(got) == len(rows) and seen["classified"].count() == len({(m, tuple(v)) for _, m, v in rows if m and v})


def test_planted_drift_is_recovered(spark):
    rnd = np.random.default_rng(7)
    shape = rnd.gamma(1, 2, (40, 6)) * (rnd.random((40, 6)) < 0.4)
    drift = [int(s) for s in np.clip(np.cumsum(rnd.integers(-2, 3, 24)), -7, 7)]
    rows = [(b, int((d + s) % 40), a, float(shape[d, a] * rnd.uniform(0.8, 1.2))) for b, s in enumerate(drift) for d in range(40) for a in range(6) if shape[d, a] > 0]
    got = {r.batch: r.shift for r in aggregates.drift_shift(spark.createDataFrame(rows, "batch long, depth int, level long, weight double"), 40).collect()}
    assert len({got[b] + s for b, s in enumerate(drift)}) == 1
