"""Merging of units with a refractory veto (inventory G18): correlograms as sums that add up when units merge."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtrace.functions.carry import carried
from longtrace.functions.groups import connected_groups
from longtrace.plans.standins import EV, HOUR, Book, events

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
#: Bins of zero whose surroundings are tested, from 1 to so many either way.
WIDTHS = 10


def place_similarity(df: DataFrame, keys: list[str], unit: str, place: str, value: str) -> DataFrame:
    """(keys, a, b, similarity), a < b: cosine of the templates of every two units of a key.

    df has a row for each unit and place where its template isn't zero, so units
    meet where they have a place in common; others have no row.
    """
    norms = df.groupBy(*keys, unit).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_norm"))
    rows = df.join(norms, [*keys, unit]).where("_norm > 0").select(*keys, place, F.col(unit).alias("a"), (F.col(value) / F.col("_norm")).alias("_x"))
    other = rows.withColumnsRenamed({"a": "b", "_x": "_y"})
    return rows.join(other, [*keys, place]).where("a < b").groupBy(*keys, "a", "b").agg(F.sum(F.col("_x") * F.col("_y")).alias("similarity"))


def merge_candidates(similar: DataFrame, sizes: DataFrame, keys: list[str], unit: str, least: float = 0.5) -> DataFrame:
    """(keys, unit, into, similarity): for every unit the most similar one with more events, if its similarity is at least `least`."""
    n = lambda k: sizes.select(*keys, F.col(unit).alias(k), F.col("n").alias(f"n_{k}"))
    flipped = similar.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), "similarity")
    rows = similar.select(*keys, "a", "b", "similarity").union(flipped).where(F.col("similarity") >= least).join(n("a"), [*keys, "a"]).join(n("b"), [*keys, "b"])
    best = rows.where("n_b > n_a").groupBy(*keys, "a").agg(F.max_by(F.struct("b", "similarity"), F.struct("similarity", "b")).alias("_m"))
    return best.select(*keys, F.col("a").alias("unit"), F.col("_m.b").alias("into"), F.col("_m.similarity").alias("similarity"))


def ranges(bins: int) -> dict[str, list[range]]:
    """The bins of a correlogram of -bins..bins whose means are compared: its outer halves, the shoulder before zero and the one after it."""
    inside = lambda a, b: range(max(a, -bins), min(b, bins) + 1)
    return {"outer": [inside(1 - bins, -(bins // 2) - 1), inside(bins // 2, bins - 1)], "left": [inside(-50, -10)], "right": [inside(11, 49)]}


def refractory_sums(pairs: DataFrame, keys: list[str], bins: int, width: int) -> DataFrame:
    """(keys, sums) of pairs (keys, t_a, t_b): the counts that the scores of their correlogram need.

    sums: of the outer halves and the shoulders, of the same seen from b, and of the
    1 to WIDTHS bins either way of zero. All are counts of pairs, so those of merged
    units are the sums of their parts'.
    """
    d = F.col("t_b") - F.col("t_a")
    bin_ = (F.signum(d) * F.floor((F.abs(d) + width // 2) / width)).cast("long")
    held = lambda b, rs: sum((F.count_if(b.between(r.start, r.stop - 1)) for r in rs), F.lit(0).cast("long"))
    sides = [held(s * bin_, rs) for s in (1, -1) for rs in ranges(bins).values()]
    near = [F.count_if((F.abs(bin_) <= i) & (bin_ != 0)) for i in range(1, WIDTHS + 1)]
    return pairs.groupBy(*keys).agg(F.array(*sides, *near).alias("sums"))


def refractory_counts(a: DataFrame, b: DataFrame, keys: list[str], time: str, bins: int, width: int) -> DataFrame:
    """(keys, sums) as refractory_sums gives them for all pairs of a's and b's events at most bins * width apart, without making pairs.

    Times are whole numbers. All counts are of distances in ranges, so of each event of
    a it is only asked how many of b lie up to each range's ends: both sides are dealt
    to stretches of time, b's to the ones beside too, and looked up in order. Events of
    one time are counted first.
    """
    most = bins * width
    reach = lambda k: k * width - width // 2
    low = lambda k: max(-most, reach(k) if k > 0 else -(reach(1 - k) - 1))
    high = lambda k: min(most, reach(k + 1) - 1 if k >= 0 else -reach(-k))
    spans = lambda rs, s: [(low(r.start), high(r.stop - 1)) if s > 0 else (low(1 - r.stop), high(-r.start)) for r in rs if len(r)]
    held = [spans(rs, s) for s in (1, -1) for rs in ranges(bins).values()]
    held += [[(low(-i), high(-1)), (low(1), high(i))] for i in range(1, WIDTHS + 1)]
    held = [[(x, y) for x, y in parts if x <= y] for parts in [*held, [(-most, most)]]]
    edges = sorted({e for parts in held for x, y in parts for e in (x, y + 1)})
    place = {e: k for k, e in enumerate(edges)}
    times = lambda df: df.groupBy(*keys, F.col(time).alias("t")).agg(F.count("*").alias("n")).withColumn("_k", F.floor(F.col("t") / (most + 1)))
    left = times(a)
    right = times(b).withColumn("_k", F.explode(F.array(F.col("_k") - 1, "_k", F.col("_k") + 1)))

    def run(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        y = y.sort_values("t")
        t, before = y["t"].to_numpy(), np.concatenate([[0], np.cumsum(y["n"].to_numpy())])
        at, n = x["t"].to_numpy(), x["n"].to_numpy()
        below = [int((before[np.searchsorted(t, at + e)] * n).sum()) for e in edges]
        found = [sum(below[place[hi + 1]] - below[place[lo]] for lo, hi in parts) for parts in held]
        return pd.DataFrame([(*key[: len(keys)], found)], columns=[*keys, "c"])

    kinds = {f.name: f.dataType.simpleString() for f in a.schema}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", c array<long>"
    counts = left.groupBy(*keys, "_k").cogroup(right.groupBy(*keys, "_k")).applyInPandas(run, schema)
    total = lambda k: F.sum(F.get("c", F.lit(k)))
    return counts.groupBy(*keys).agg(F.array(*map(total, range(len(held) - 1))).alias("sums"), total(len(held) - 1).alias("_all")).where("_all > 0").drop("_all")


def least_scores(sums: np.ndarray, bins: int, flipped: bool = False) -> tuple[float, float]:
    """(Q, R) of one pair's sums: the least rate next to zero over the larger baseline, and the least chance of so few there; without a baseline infinite."""
    size = [sum(len(r) for r in rs) for rs in ranges(bins).values()]
    base = max(s / n for s, n in zip(sums[3:6] if flipped else sums[:3], size, strict=True) if n)
    if base <= 0:
        return math.inf, math.inf
    i = np.arange(1, WIDTHS + 1)
    near, lam = sums[6:], base * i
    chance = min(0.5 * (1 + math.erf(x)) for x in (near / 2 - lam) / np.sqrt(2 * lam))
    return float((near / (2 * i)).min() / base), chance


def walked(pairs: pd.DataFrame, bins: int, least: float, most_q: float, most_r: float) -> list[tuple]:
    """[(unit, into, similarity, q, r)] of one group's pairs (a, b, similarity, sums, n_a, n_b), in order.

    Units are taken from the fewest events on. Each is held against the more frequent
    ones, from the most similar on; it is merged into the first one that shows no
    event next to its own, whose counts then grow by its.
    """
    counts = dict(zip(pairs["a"], pairs["n_a"], strict=True)) | dict(zip(pairs["b"], pairs["n_b"], strict=True))
    names = sorted(counts)
    number = {u: k for k, u in enumerate(names)}
    m, n = len(names), np.array([counts[u] for u in names], np.int64)
    similarity, sums = np.full((m, m), -np.inf), np.zeros((m, m, 6 + WIDTHS), np.int64)
    for a, b, x, s in zip(pairs["a"], pairs["b"], pairs["similarity"], pairs["sums"], strict=True):
        i, j = number[a], number[b]
        if x is not None and not math.isnan(x):
            similarity[i, j] = similarity[j, i] = x
        if s is not None:
            sums[i, j] = s
            sums[j, i] = np.concatenate([s[3:6], s[:3], s[6:]])
    out = []
    for j in sorted(range(m), key=lambda k: (n[k], k)):
        larger = [k for k in range(m) if n[k] > n[j] and similarity[j, k] >= least]
        for k in sorted(larger, key=lambda k: (-similarity[j, k], k)):
            q, r = least_scores(sums[j, k], bins)
            if q < most_q and r < most_r:
                out.append((names[j], names[k], float(similarity[j, k]), q, r))
                sums[k] += sums[j]
                sums[:, k] += sums[:, j]
                n[k] += n[j]
                break
    return out


def merge_units(df: DataFrame, similar: DataFrame, keys: list[str], unit: str, time: str, bins: int = 500, width: int = 1000, least: float = 0.5, most_q: float = 0.2, most_r: float = 0.05) -> DataFrame:
    """(keys, unit, into, similarity, q, r): the merges of df's units, for similar (keys, a, b, similarity).

    Only units that similarities of at least `least` connect can ever meet. The events
    of such a group are paired by time buckets and counted (refractory_sums), once:
    what merged units would give is added up from these counts. The walk over a group
    then holds one record of 16 counts for each pair of its units, however many events
    they have; a group's units must be few enough for that. `into` may itself be
    merged later (final_units follows the chain). Keys and units without nulls.
    """
    alike = similar.where(F.col("similarity") >= least)
    node = lambda u: F.struct(*keys, F.col(u).alias("unit"))
    roots = connected_groups(alike.select(node("a").alias("x"), node("b").alias("y")), "x", "y")
    member = roots.select(*(F.col(f"node.{k}").alias(k) for k in keys), F.col("node.unit").alias(unit), F.col("root.unit").alias("_root"))
    rows = df.join(member, [*keys, unit])
    sizes = rows.groupBy(*keys, "_root", unit).agg(F.count("*").alias("n"))
    most = bins * width + width // 2
    bucket = lambda c: F.floor(F.col(c) / (most + 1))
    left = rows.select(*keys, "_root", F.col(unit).alias("a"), F.col(time).alias("t_a")).withColumn("_k", bucket("t_a"))
    right = rows.select(*keys, "_root", F.col(unit).alias("b"), F.col(time).alias("t_b")).withColumn("_k", F.explode(F.array(bucket("t_b") - 1, bucket("t_b"), bucket("t_b") + 1)))
    met = left.join(right, [*keys, "_root", "_k"]).where((F.col("a") < F.col("b")) & (F.abs(F.col("t_a") - F.col("t_b")) < most))
    counted = refractory_sums(met, [*keys, "a", "b"], bins, width)
    n = lambda c: sizes.select(*keys, F.col("_root"), F.col(unit).alias(c), F.col("n").alias(f"n_{c}"))
    pairs = similar.select(*keys, "a", "b", "similarity").join(counted, [*keys, "a", "b"], "full")
    pairs = pairs.join(n("a"), [*keys, "a"]).join(n("b").drop("_root"), [*keys, "b"])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = walked(pdf, bins, least, most_q, most_r)
        return pd.DataFrame([(*key[: len(keys)], *x) for x in found], columns=[*keys, "unit", "into", "similarity", "q", "r"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", unit {kinds[unit]}, into {kinds[unit]}, similarity double, q double, r double"
    return pairs.groupBy(*keys, "_root").applyInPandas(run, schema)


def final_units(merges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, unit, final): the unit that each merged one ends in. A unit is merged once, so chains are followed by doubling."""
    now = merges.select(*keys, "unit", F.col("into").alias("final"))
    while True:
        step = now.select(*keys, F.col("unit").alias("final"), F.col("final").alias("_next"))
        after = now.join(step, [*keys, "final"], "left").select(*keys, "unit", F.coalesce("_next", "final").alias("final"), F.col("_next").isNotNull().alias("_moved"))
        if after.where("_moved").isEmpty():
            return now
        now = after.drop("_moved")


#: Trains with a refractory period: events of eight users together less those within an hour of the one before; units: their types.
UNITS = (
    f"{EV}, gapped AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id // 8 ORDER BY t, event_id) AS gap FROM ev), "
    f"units AS (SELECT user_id // 8 AS session, event_type AS unit, t, value AS amplitude FROM gapped WHERE gap IS NULL OR gap >= {HOUR}), "
    f"tpl AS (SELECT session, unit, (t // {HOUR}) % 24 AS place, sum(amplitude) AS x FROM units GROUP BY ALL), norms AS (SELECT session, unit, sqrt(sum(x * x)) AS n FROM tpl GROUP BY ALL), "
    "sim AS (SELECT p.session, p.unit AS a, q.unit AS b, sum(p.x * q.x) / (any_value(m.n) * any_value(o.n)) AS similarity FROM tpl p JOIN tpl q ON p.session = q.session AND p.place = q.place AND p.unit < q.unit "
    "JOIN norms m ON m.session = p.session AND m.unit = p.unit JOIN norms o ON o.session = q.session AND o.unit = q.unit WHERE m.n > 0 AND o.n > 0 GROUP BY ALL)"
)
WIDTH, BINS = HOUR // 3, 60


def refractory_units(spark, sf) -> DataFrame:
    rows = events(spark, sf).select(F.expr("user_id div 8").alias("session"), F.col("event_type").alias("unit"), "t", F.col("event_id").alias("spike"), F.col("value").alias("amplitude"))
    gapped = carried(rows, ["session"], "t", 24 * HOUR, ties=["spike"], lag={"_before": F.col("t")})
    return gapped.where((F.col("t") - F.col("_before") >= HOUR) | F.col("_before").isNull()).drop("_before", "spike")


def unit_similarity(units: DataFrame, place: Column) -> DataFrame:
    return place_similarity(units.groupBy("session", "unit", place.alias("place")).agg(F.sum("amplitude").alias("x")), ["session"], "unit", "place", "x")


def _similar(units: DataFrame) -> DataFrame:
    return unit_similarity(units, F.expr(f"(t div {HOUR}) % 24"))


@BOOK.add(
    "g18_merge_candidates",
    f"WITH {UNITS}, n AS (SELECT session, unit, count(*) AS n FROM units GROUP BY ALL), s AS (SELECT session, a, b, similarity FROM sim UNION ALL SELECT session, b, a, similarity FROM sim), "
    "r AS (SELECT s.* FROM s JOIN n x ON x.session = s.session AND x.unit = a JOIN n y ON y.session = s.session AND y.unit = b WHERE similarity >= 0.5 AND y.n > x.n) "
    "SELECT session, a AS unit, arg_max(b, similarity) AS into, round(max(similarity), 4) AS similarity FROM r GROUP BY session, a",
)
def _g18(spark, sf):
    units = refractory_units(spark, sf)
    sizes = units.groupBy("session", "unit").agg(F.count("*").alias("n"))
    return merge_candidates(_similar(units), sizes, ["session"], "unit", 0.5).withColumn("similarity", F.round("similarity", 4))


@BOOK.add("g18b_merge_units")
def _g18b(spark, sf):
    units = refractory_units(spark, sf)
    return merge_units(units, _similar(units), ["session"], "unit", "t", BINS, WIDTH)
