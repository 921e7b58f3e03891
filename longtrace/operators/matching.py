"""Lists matched along their order, and units across sorters (inventory F12's walk and F19)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtrace.functions.carry import carried
from longtrace.functions.groups import connected_groups
from longtrace.operators.sequence import EVENTS, segment_events, segments
from longtrace.plans.standins import EV, HOUR, Book, events, spikes
from longtrace.session import written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def walked(pulses: list[int], video: list[int], tolerance: float, share: float | None, reach: int) -> list[int | None]:
    """For each pulse count the place of its video count, None for one that is dropped, where pulses are at least as many.

    Counts are walked side by side. Where they differ by more than the tolerance (a
    share of the video count, if given), the nearest count of those up to reach
    before and reach - 1 behind is taken instead, and all pulses between are dropped;
    at the last video count only if it is the larger one. What is left over behind
    the last goes too.
    """
    moved, gone = 0, set()
    for k, count in enumerate(video):
        at = k + moved
        if at >= len(pulses):
            break
        if abs(pulses[at] - count) > (tolerance if share is None else share * count):
            if k + 1 == len(video) and pulses[at] > count:
                continue
            low = max(0, at - reach)
            near = [abs(x - count) for x in pulses[low : at + reach]]
            shift = near.index(min(near)) - (at - low)
            gone.update(range(at, at + shift) if shift > 0 else range(at + shift, at))
            moved += shift
        elif k + 1 == len(video):
            gone.update(range(at + 1, len(pulses)))
    kept = [i for i in range(len(pulses)) if i not in gone][: len(video)]
    place = {i: k for k, i in enumerate(kept)}
    return [place.get(i) for i in range(len(pulses))]


def least_shift(pulses: np.ndarray, counts: np.ndarray, video: np.ndarray, others: np.ndarray, most: int) -> int:
    """The shift 0..most of the numbers of pulses along those of video (sorted) with the least sum of absolute differences of counts, of equal ones the smallest; a number that video lacks counts 0."""
    costs = []
    for shift in range(most + 1):
        at = np.minimum(np.searchsorted(video, pulses + shift), len(video) - 1)
        costs.append(np.abs(counts - np.where(video[at] == pulses + shift, others[at], 0)).sum())
    return int(np.argmin(costs))


def count_align(pulses: DataFrame, video: DataFrame, keys: list[str], number: str, count: str, tolerance: float = 10, free: Column | None = None, share: float = 0.2, reach: int = 10, most: int = 64) -> DataFrame:
    """(keys, number, video): the video event of each pulse event, NULL where the pulse is dropped.

    Events of a key are taken in order of number. With fewer pulses than video events
    all pulses are moved by the shift of least cost (least_shift, up to `most`); else
    the lists are walked (walked). free: rows of keys in free runs, whose tolerance is
    `share` of the video count. A key's list holds a count for each event, not samples,
    and is one group.
    """
    flag = F.lit(False) if free is None else F.coalesce(free, F.lit(False))
    kinds = {f.name: f.dataType.simpleString() for f in pulses.schema}
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    left = pulses.where(known).select(*keys, F.col(number).cast("long").alias("_i"), F.col(count).cast("long").alias("_c"), flag.alias("_free"))
    right = video.where(known).select(*keys, F.col(number).cast("long").alias("_i"), F.col(count).cast("long").alias("_c"))

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = dict(zip(keys, key, strict=True))
        if a.empty or b.empty:
            return pd.DataFrame({**dict.fromkeys(keys, []), number: [], "video": []})
        a, b = a.sort_values("_i"), b.sort_values("_i")
        if len(a) < len(b):
            return pd.DataFrame({**names, number: a["_i"], "video": a["_i"] + least_shift(a["_i"].to_numpy(), a["_c"].to_numpy(), b["_i"].to_numpy(), b["_c"].to_numpy(), most)})
        at = walked(a["_c"].tolist(), b["_c"].tolist(), tolerance, share if a["_free"].any() else None, reach)
        found = b["_i"].tolist()
        return pd.DataFrame({**names, number: a["_i"], "video": pd.array([None if k is None else found[k] for k in at], "Int64")})

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {number} long, video long"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


#: Pulses: the segments of all events; video: those of the events above 20, so that counts differ and some segments are lost.
_LISTS = (
    f"{EVENTS}, pls AS (SELECT unit, event - 1 AS event, n FROM segments), hi AS (SELECT unit, t, spike, CASE WHEN t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike) <= {6 * HOUR} THEN 0 ELSE 1 END AS new FROM spikes WHERE amplitude > 20), "
    "vid AS (SELECT unit, g - 1 AS event, count(*) AS n FROM (SELECT unit, sum(new) OVER (PARTITION BY unit ORDER BY t, spike) AS g FROM hi) GROUP BY unit, g), "
    "p AS (SELECT unit, list(n::BIGINT ORDER BY event) AS p FROM pls GROUP BY unit), v AS (SELECT unit, list(n::BIGINT ORDER BY event) AS c FROM vid GROUP BY unit), both_ AS (SELECT unit, p, c FROM p JOIN v USING (unit))"
)


@BOOK.add(
    "f12b_count_walk",
    f"WITH RECURSIVE {_LISTS}, st AS (SELECT unit, 0::BIGINT AS k, 0::BIGINT AS moved, []::BIGINT[] AS gone FROM both_ WHERE len(p) >= len(c) UNION ALL "
    "SELECT unit, k + 1, moved + coalesce(shift, 0), CASE WHEN shift IS NOT NULL THEN list_concat(gone, CASE WHEN shift > 0 THEN range(pos, pos + shift) ELSE range(pos + shift, pos) END) WHEN NOT far AND k + 1 = len(c) THEN list_concat(gone, range(pos + 1, len(p)::BIGINT)) ELSE gone END "
    "FROM (SELECT *, CASE WHEN far AND NOT (k + 1 = len(c) AND p[pos + 1] > c[k + 1]) THEN list_position(near, list_min(near)) - 1 - (pos - greatest(0, pos - 10)) END AS shift "
    "FROM (SELECT s.*, p, c, k + moved AS pos, abs(p[k + moved + 1] - c[k + 1]) > 1 AS far, list_transform(p[greatest(0, k + moved - 10) + 1:k + moved + 10], lambda x: abs(x - c[k + 1])) AS near FROM st s JOIN both_ USING (unit) WHERE k < len(c) AND k + moved < len(p)))), "
    "fin AS (SELECT unit, arg_max(gone, k) AS gone FROM st GROUP BY unit), "
    "kept AS (SELECT unit, i, row_number() OVER (PARTITION BY unit ORDER BY i) - 1 AS place FROM (SELECT unit, gone, unnest(range(0, len(p)::BIGINT)) AS i FROM both_ JOIN fin USING (unit)) WHERE NOT list_contains(gone, i)), "
    "walk AS (SELECT unit, i AS event, CASE WHEN place < len(c) THEN place END AS video FROM (SELECT unit, c, unnest(range(0, len(p)::BIGINT)) AS i FROM both_ JOIN fin USING (unit)) LEFT JOIN kept USING (unit, i)), "
    "cost AS (SELECT unit, s, sum(abs(p[i + 1] - coalesce(c[i + s + 1], 0))) AS cost FROM both_, range(0, 65) t(s), range(0, 4000) r(i) WHERE len(p) < len(c) AND i < len(p) GROUP BY unit, s), best AS (SELECT unit, arg_min(s, (cost, s)) AS shift FROM cost GROUP BY unit) "
    "SELECT unit, event::BIGINT AS event, video::BIGINT AS video FROM walk UNION ALL SELECT unit, i::BIGINT, (i + shift)::BIGINT FROM (SELECT unit, unnest(range(0, len(p)::BIGINT)) AS i, shift FROM both_ JOIN best USING (unit))",
)
def _f12b(spark, sf):
    from_zero = lambda df: df.select("unit", (F.col("event") - 1).alias("event"), "n")
    loud = spikes(spark, sf).where("amplitude > 20")
    video = segment_events(loud, ["unit"], "t", 6 * HOUR, chunk=48 * HOUR)
    return count_align(from_zero(segments(spark, sf)), from_zero(video), ["unit"], "event", "n", tolerance=1)


#: Pairs of times meet in cells of so many reaches a side.
CELL = 16
#: A unit's events are walked in stretches of so many reaches.
STRETCH = 1 << 20


def same_trains(df: DataFrame, sorter: str, unit: str, time: str) -> tuple[DataFrame, DataFrame]:
    """(s, u, t) events of one unit for each train of a sorter, the smallest that has it, and (s, u, unit) of all units; trains are told apart by size, ends and sums of two hashes."""
    t = F.col(time)
    sums = [F.sum(F.xxhash64(t, F.lit(k)).cast("decimal(20,0)")).alias(f"_h{k}") for k in range(2)]
    read = df.groupBy(F.col(sorter).alias("s"), F.col(unit).alias("unit")).agg(F.count("*").alias("_n"), F.count(t).alias("_k"), F.min(t).alias("_min"), F.max(t).alias("_max"), *sums)
    read = read.where("s is not null and unit is not null")
    alike = F.struct(*(c for c in read.columns if c not in ("s", "unit")))
    units = read.select("s", "unit", F.md5(F.to_json(alike)).alias("train"))
    units = written(units.join(units.groupBy("s", "train").agg(F.min("unit").alias("u")), ["s", "train"]).select("s", "u", "unit"), "units")
    rows = df.select(F.col(sorter).alias("s"), F.col(unit).alias("u"), t.alias("t"))
    return written(rows.join(units.where("u = unit").select("s", "u"), ["s", "u"], "left_semi"), "trains"), units


def agreeing_trains(rows: DataFrame, most: int, least: float) -> DataFrame:
    """(sorter_a, a, sorter_b, b, matched, score) of the events (s, u, t); see sorter_agreement.

    Units may agree by so many events that neighbours of a are matched by neighbours of
    b: of a's n events (m matched, x at most twice `most` behind the one before)
    3 m - n_a - n_b - 1 - 2 x pairs of neighbours are, as an event that isn't matched
    spoils two pairs and one of b between others one. Pairs of neighbours meet in cells
    of both their times; units that share so many pairs have their events brought
    together. Where least is so low, or a's events so few or so dense, that no pair
    need be left, events are counted by unit and stretch of time: a's in stretches
    where b has any, or next to such, bound what can match, and likewise b's.
    """
    share = least / (1 + least)
    named = lambda d, x: d.select(F.col("s").alias(f"sorter_{x}"), F.col("u").alias(x), *[c if c == "k" else F.col(c).alias(f"{c}_{x}") for c in d.columns if c not in ("s", "u")])
    both = ["sorter_a", "a", "sorter_b", "b"]
    times = carried(rows.where("t is not null").distinct(), ["s", "u"], "t", STRETCH * (most + 1), lag={"p": F.col("t")})
    times = written(times, "neighbours")
    sized = rows.groupBy("s", "u").agg(F.count("*").alias("n")).join(times.groupBy("s", "u").agg(F.count_if(F.col("t") - F.col("p") <= 2 * most).alias("x")), ["s", "u"])
    # n_b is least * n_a - (1 + least) * x or more, as so many events of b must be matched
    sized = written(sized.withColumn("sure", (2 * least - 1) * (F.col("n") - F.col("x")) - 2 * (1 + F.col("x")) >= 1e-9), "sizes")

    pairs = times.where("p is not null").join(sized, ["s", "u"])
    of = lambda c: F.floor(F.col(c) / (CELL * (most + 1)))
    around = lambda c: F.explode(F.sequence(F.floor((F.col(c) - most) / (CELL * (most + 1))), F.floor((F.col(c) + most) / (CELL * (most + 1)))))
    left = named(pairs.where("sure").drop("sure"), "a").withColumn("kp", of("p_a")).withColumn("kt", of("t_a"))
    right = named(pairs.drop("sure", "x"), "b").withColumn("kp", around("p_b")).withColumn("kt", around("t_b"))
    sizes_allow = share * (F.col("n_a") + F.col("n_b")) <= F.col("n_a") + 1e-9  # no more than n_a can match
    near = (F.abs(F.col("p_a") - F.col("p_b")) <= most) & (F.abs(F.col("t_a") - F.col("t_b")) <= most)
    shared = left.join(right, ["kp", "kt"]).where((F.col("sorter_a") < F.col("sorter_b")) & sizes_allow & near).groupBy(*both, "n_a", "n_b", "x_a").agg(F.count("*").alias("_pairs"))
    possible = shared.where((3 * share - 1) * (F.col("n_a") + F.col("n_b")) - 1 - 2 * F.col("x_a") <= F.col("_pairs") + 1e-9).select(*both, "n_a", "n_b")

    stretch = F.floor(F.col("t") / (most + 1))
    if not sized.where("not sure").isEmpty():
        counts = written(rows.groupBy("s", "u", stretch.alias("k")).agg(F.count("*").alias("c")).join(sized.select("s", "u", "n", "sure"), ["s", "u"]), "counts")
        ring = counts.select("s", "u", "n", "sure", F.explode(F.array(F.col("k") - 1, "k", F.col("k") + 1)).alias("k")).distinct()
        met = named(counts.where("not sure").drop("sure"), "a").join(named(ring.drop("sure"), "b"), "k").where((F.col("sorter_a") < F.col("sorter_b")) & sizes_allow)
        bound = met.groupBy(*both, "n_a", "n_b").agg(F.sum("c_a").alias("_m"))
        # matched / (n_a + n_b - matched) >= least needs so many matches; an event of b may match several of a
        possible = possible.union(bound.where(F.col("_m") >= share * (F.col("n_a") + F.col("n_b"))).select(*both, "n_a", "n_b"))

    possible = written(possible, "possible")
    events = rows.select("s", "u", "t", stretch.alias("k"))
    left = named(events, "a").join(possible, ["sorter_a", "a"])
    right = named(events, "b").withColumn("k", F.explode(F.array(F.col("k") - 1, "k", F.col("k") + 1)))
    met = left.join(right, ["sorter_b", "b", "k"]).where(F.abs(F.col("t_a") - F.col("t_b")) <= most)
    matched = met.groupBy(*both, "n_a", "n_b", "t_a").agg(F.lit(1).alias("_x")).groupBy(*both, "n_a", "n_b").agg(F.count("*").alias("matched"))
    scored = matched.withColumn("score", F.col("matched") / (F.col("n_a") + F.col("n_b") - F.col("matched")))
    return scored.where(F.col("score") >= least).select(*both, "matched", "score")


def sorter_agreement(df: DataFrame, sorter: str, unit: str, time: str, most: int, least: float) -> DataFrame:
    """(sorter_a, a, sorter_b, b, matched, score): units of two sorters that agree by at least `least`; sorter_a < sorter_b.

    matched counts a's events with one of b at most `most` away, score is matched over
    all events of both. Of a sorter's units with the same events one is compared, and
    its links hold for all.
    """
    rows, units = same_trains(df, sorter, unit, time)
    links = written(agreeing_trains(rows, most, least), "links")
    for x in ("a", "b"):
        links = links.join(units.select(F.col("s").alias(f"sorter_{x}"), F.col("u").alias(x), F.col("unit").alias(f"_{x}")), [f"sorter_{x}", x])
    return links.select("sorter_a", F.col("_a").alias("a"), "sorter_b", F.col("_b").alias("b"), "matched", "score")


def consensus_units(df: DataFrame, sorter: str, unit: str, time: str, most: int, least: float = 0.5, sorters: int = 2) -> DataFrame:
    """(sorter, unit, group_sorter, group_unit, n): units in connected groups of agreeing units that hold at least `sorters` sorters; a group is named by its smallest (sorter, unit).

    Of a sorter's units with the same events the smallest is linked; the others follow it.
    """
    rows, units = same_trains(df, sorter, unit, time)
    links = agreeing_trains(rows, most, least)
    node = lambda x: F.struct(F.col(f"sorter_{x}").alias("sorter"), F.col(x).alias("unit"))
    groups = connected_groups(links.select(node("a").alias("x"), node("b").alias("y")), "x", "y")
    n = groups.groupBy("root").agg(F.count_distinct("node.sorter").alias("n")).where(F.col("n") >= sorters)
    named = groups.join(n, "root").select(F.col("node.sorter").alias("s"), F.col("node.unit").alias("u"), F.col("root.sorter").alias("group_sorter"), F.col("root.unit").alias("group_unit"), "n")
    return named.join(units, ["s", "u"]).select(F.col("s").alias("sorter"), "unit", "group_sorter", "group_unit", "n")


#: Three sorters of the same trains: loud events, quiet events, and all of them a second late; units of the third are named from 1000000 on.
SORTED = (
    f"{EV}, srt AS (SELECT 'a' AS sorter, user_id AS unit, t FROM ev WHERE value > 12 UNION ALL SELECT 'b', user_id, t FROM ev WHERE value < 60 UNION ALL SELECT 'c', user_id + 1000000, t + 1000000 FROM ev), sn AS (SELECT sorter, unit, count(*) AS n FROM srt GROUP BY ALL), "
    "lnk AS (SELECT x.sorter AS sa, x.unit AS a, y.sorter AS sb, y.unit AS b, count(DISTINCT x.t) AS m FROM srt x JOIN srt y ON x.sorter < y.sorter AND abs(x.t - y.t) <= 2000000 GROUP BY ALL), "
    "agr AS (SELECT l.*, m / (p.n + q.n - m) AS score FROM lnk l JOIN sn p ON p.sorter = sa AND p.unit = a JOIN sn q ON q.sorter = sb AND q.unit = b WHERE m / (p.n + q.n - m) >= 0.75)"
)


def sorted_trains(spark, sf) -> DataFrame:
    ev = events(spark, sf).select("user_id", "t", "value")
    pick = lambda name, where, unit="user_id", late=0: ev.where(where).select(F.lit(name).alias("sorter"), F.expr(unit).alias("unit"), (F.col("t") + late).alias("t"))
    return pick("a", "value > 12").union(pick("b", "value < 60")).union(pick("c", "true", "user_id + 1000000", 1_000_000))


@BOOK.add("f19b_sorter_agreement", f"WITH {SORTED} SELECT sa AS sorter_a, a, sb AS sorter_b, b, m AS matched, round(score, 6) AS score FROM agr")
def _f19b(spark, sf):
    return sorter_agreement(sorted_trains(spark, sf), "sorter", "unit", "t", 2_000_000, 0.75).withColumn("score", F.round("score", 6))


@BOOK.add(
    "f19_consensus_units",
    f"WITH RECURSIVE {SORTED}, e AS (SELECT sa AS s, a AS u, sb AS s2, b AS u2 FROM agr UNION ALL SELECT sb, b, sa, a FROM agr), r AS (SELECT DISTINCT s, u, s AS s2, u AS u2 FROM e UNION SELECT r.s, r.u, e.s2, e.u2 FROM r JOIN e ON e.s = r.s2 AND e.u = r.u2), "
    "g AS (SELECT s, u, min((s2, u2)) AS root FROM r GROUP BY s, u), n AS (SELECT root, count(DISTINCT s) AS n FROM g GROUP BY root) SELECT s AS sorter, u AS unit, root[1] AS group_sorter, root[2] AS group_unit, n FROM g JOIN n USING (root) WHERE n >= 3",
)
def _f19(spark, sf):
    return consensus_units(sorted_trains(spark, sf), "sorter", "unit", "t", 2_000_000, 0.75, 3)
