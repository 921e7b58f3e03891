"""Units split along an axis that none of their items shows."""

import numpy as np

from longtrace.operators import splitting


def test_planted_groups(spark):
    rnd = np.random.default_rng(3)
    d, rows, truth = 4, [], {}
    turn = np.linalg.qr(rnd.normal(size=(d, d)))[0]

    def unit(name, apart, times):
        side = rnd.random(len(times)) < 0.35
        # the groups lie apart along the last turned item; along the first two all are wide
        x = rnd.normal(0, 1, (len(times), d)) * [3, 2, 1, 1] + np.outer(side, [0, 0, 0, apart])
        x = (x + [3, -2, 1, 4]) @ turn.T
        for t, v, s in zip(times, x, side, strict=True):
            rows.append((name, int(t), v.tolist()))
            truth[name, int(t)] = bool(s)

    free = lambda n: np.unique(rnd.integers(0, 60_000, n))
    unit("apart", 9.0, free(900))
    unit("one", 0.0, free(900))
    unit("dead time", 9.0, np.cumsum(12 + rnd.exponential(20, 1500).astype(int)))
    unit("few", 9.0, free(100))
    df = spark.createDataFrame(rows, "u string, t long, x array<double>").repartition(5)
    verdicts, told = splitting.split_units(df, "u", "t", "x", 60, 1)
    got = {r.unit: r for r in verdicts.collect()}
    assert got.keys() == {"apart", "one", "dead time"}
    assert [got[u].split for u in ("apart", "one", "dead time")] == [True, False, False]
    assert got["dead time"].q < 0.25 and got["dead time"].r < 0.05 and min(got["dead time"].sure_low, got["dead time"].sure_high) > 0.9
    for u in ("apart", "dead time"):
        sides = [(r.side == 0) == truth[u, r.t] for r in told.where(told.u == u).collect()]
        assert max(np.mean(sides), 1 - np.mean(sides)) > 0.98
    assert splitting.split_units(df.limit(0), "u", "t", "x", 60, 1)[0].collect() == []
