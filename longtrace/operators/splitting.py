"""Splitting of units along a pursued axis (inventory K8): two normal distributions, with a refractory veto."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtrace.operators.classes import partial_moments
from longtrace.operators.merging import BINS, WIDTH, least_scores, refractory_counts
from longtrace.plans.standins import Book, events
from longtrace.session import remove, written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
#: Projections are counted in so many steps over REACH deviations either way; steps of fitting between two passes over the events.
STEPS, REACH, FITS = 256, 6.0, 20

_FIT = "n long, mean array<double>, axis array<double>, scale double, mu array<double>, var array<double>, p double"


def responsibilities(x: np.ndarray, mu: np.ndarray, var: np.ndarray, p: float) -> np.ndarray:
    """(n, 2): how likely each x is of either distribution."""
    share = np.array([p, 1 - p])
    log = np.log(np.maximum(share, 1e-300)) - 0.5 * np.log(var) - (x[:, None] - mu) ** 2 / (2 * var)
    odds = np.exp(log - log.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def fitted(x: np.ndarray, c: np.ndarray, mu: np.ndarray, var: np.ndarray, p: float, floor: float) -> tuple[np.ndarray, np.ndarray, float]:
    """mu, var and p after FITS steps on values x that come c times."""
    for _ in range(FITS):
        r = responsibilities(x, mu, var, p) * c[:, None]
        n = np.maximum(r.sum(0), 1e-12)
        p, mu = float(n[0] / n.sum()), (r * x[:, None]).sum(0) / n
        var = np.maximum((r * (x[:, None] - mu) ** 2).sum(0) / n, floor)
    return mu, var, p


def axes(df: DataFrame, unit: str, vector: str, rounds: int, least: int) -> DataFrame:
    """(unit, n, mean, axis, scale, mu, var, p) of the pursued fit of each unit of at least `least` events.

    The axis starts as the first principal one. A pass over the events counts, for each
    unit and step of the projection, events, sums of vectors and of their products: for
    the weights depend on the projection alone, that is all that fitting and the next
    axis need. A task adds up its own rows first; a unit's sums are one small group.
    """
    kind = df.schema[unit].dataType.simpleString()
    rows = df.select(F.col(unit).alias("unit"), F.col(vector).cast("array<double>").alias("v")).where("unit is not null and v is not null")

    def begun(pdf: pd.DataFrame) -> pd.DataFrame:
        n, s, q = int(pdf["n"].sum()), pdf["s"].sum(), pdf["q"].sum()
        mean = s / n
        cov = q.reshape(len(s), len(s)) / n - np.outer(mean, mean)
        size, vectors = np.linalg.eigh(cov)
        axis = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
        return pd.DataFrame([(pdf["label"].iloc[0], n, mean, axis, float(np.sqrt(max(size[-1], 0.0))), np.zeros(0), np.zeros(0), np.nan)], columns=["unit", "n", "mean", "axis", "scale", "mu", "var", "p"])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for name, g in pdf.groupby("unit"):
                mean, axis, scale = np.array(g["mean"].iloc[0]), np.array(g["axis"].iloc[0]), g["scale"].iloc[0]
                v = np.stack(g["v"].to_list()) - mean
                at = np.clip(((v @ axis) / (REACH * scale) + 1) * STEPS / 2, 0, STEPS - 1).astype(int)
                d = v.shape[1]
                n, s, q = held.setdefault(name, (np.zeros(STEPS), np.zeros((STEPS, d)), np.zeros((STEPS, d, d))))
                order = np.argsort(at, kind="stable")
                used, start = np.unique(at[order], return_index=True)
                n[used] += np.diff([*start, len(order)])
                s[used] += np.add.reduceat(v[order], start, axis=0)
                q[used] += np.add.reduceat(v[order][:, :, None] * v[order][:, None, :], start, axis=0)
        yield pd.DataFrame([(name, n, s.reshape(-1), q.reshape(-1)) for name, (n, s, q) in held.items()], columns=["unit", "c", "s", "q"])

    def pursued(last: bool):
        def run(pdf: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf) or not len(fit):
                return fit.iloc[:0]
            row = fit.iloc[0]
            c, axis, scale = pdf["c"].sum(), np.array(row["axis"]), row["scale"]
            d = len(axis)
            s, q = pdf["s"].sum().reshape(STEPS, d), pdf["q"].sum().reshape(STEPS, d, d)
            at = np.flatnonzero(c)
            x, c, s, q = (s[at] @ axis) / c[at], c[at], s[at], q[at]
            if np.isnan(row["p"]):
                high = x > 0
                two = [np.average(x[m], weights=c[m]) if m.any() else 0.0 for m in (high, ~high)]
                spread = [np.average((x[m] - t) ** 2, weights=c[m]) if m.any() else 1.0 for m, t in zip((high, ~high), two, strict=True)]
                mu, var, p = np.array(two), np.maximum(spread, 1e-6 * scale**2), float(c[high].sum() / c.sum())
            else:
                mu, var, p = np.array(row["mu"]), np.array(row["var"]), row["p"]
            mu, var, p = fitted(x, c, mu, var, p, 1e-6 * scale**2)
            if not last:
                r = responsibilities(x, mu, var, p)
                products = np.einsum("k,kij->ij", (r / var).sum(1), q)
                aim = np.linalg.solve(products + 1e-9 * np.trace(products) * np.eye(d), ((r * mu / var).sum(1)[:, None] * s).sum(0))
                if np.linalg.norm(aim) > 0:
                    axis = aim / np.linalg.norm(aim)
                    scale = float(np.sqrt(max(axis @ q.sum(0) @ axis / c.sum(), 1e-12)))
            return pd.DataFrame([(row["unit"], row["n"], row["mean"], axis, scale, mu, var, p)], columns=["unit", "n", "mean", "axis", "scale", "mu", "var", "p"])

        return run

    schema = f"unit {kind}, {_FIT}"
    fits = partial_moments(rows, "unit", "v").groupBy("label").applyInPandas(begun, schema)
    fits = written(fits.where((F.col("n") >= least) & (F.col("scale") > 0)), "axes")
    for k in range(rounds):
        seen = rows.join(fits.select("unit", "mean", "axis", "scale"), "unit")
        parts = seen.mapInPandas(sums, f"unit {kind}, c array<double>, s array<double>, q array<double>")
        after = written(parts.groupBy("unit").cogroup(fits.groupBy("unit")).applyInPandas(pursued(k == rounds - 1), schema), "axes")
        remove(fits)
        fits = after
    return fits


def sided(df: DataFrame, fits: DataFrame, unit: str, vector: str) -> DataFrame:
    """df with `side` (0 or 1, the likelier distribution) and `sure` (how likely)."""
    rows = df.join(fits.select(F.col("unit").alias(unit), F.col("mean").alias("_mean"), F.col("axis").alias("_axis"), F.col("mu").alias("_mu"), F.col("var").alias("_var"), F.col("p").alias("_p")), unit)
    x = F.aggregate(F.zip_with(F.zip_with(F.col(vector).cast("array<double>"), "_mean", lambda a, b: a - b), "_axis", lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y)
    rows = rows.withColumn("_x", x)
    log = lambda k, share: F.log(share) - 0.5 * F.log(F.get("_var", F.lit(k))) - (F.col("_x") - F.get("_mu", F.lit(k))) ** 2 / (2 * F.get("_var", F.lit(k)))
    odds = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), log(0, F.col("_p")) - log(1, 1 - F.col("_p"))))
    first = 1 / (1 + F.exp(-odds))
    return rows.withColumn("side", F.when(first > 0.5, 0).otherwise(1)).withColumn("sure", F.greatest(first, 1 - first)).drop("_mean", "_axis", "_mu", "_var", "_p", "_x")


def split_units(df: DataFrame, unit: str, time: str, vector: str, bins: int = 500, width: int = 1000, least: int = 300, rounds: int = 12, sure: float = 0.9, share: float = 0.05, alike: float = 0.9, near: float = 0.2, most_q: float = 0.25, most_r: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """(verdicts, events): for each unit of at least `least` events (unit, n, n_low, sure_low, sure_high, correlation, gap, q, r, split), and df's events of these with `side`.

    A unit is split if both sides are told with a mean certainty above sure and hold
    more than share of its events, unless their events keep a refractory period with
    each other (Q below most_q and R below most_r of their correlogram), or their mean
    vectors correlate above alike and differ in length by less than near.
    """
    fits = axes(df, unit, vector, rounds, least)
    told = written(sided(df, fits, unit, vector), "sides")
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    item = told.select(unit, "side", F.posexplode(F.col(vector).cast("array<double>")).alias("k", "x")).groupBy(unit, "side", "k").agg(F.avg("x").alias("m"))
    means = item.groupBy(unit, "k").agg(F.max(F.when(F.col("side") == 0, F.col("m"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("m"))).alias("b"))
    shape = means.groupBy(unit).agg(F.corr("a", "b").alias("correlation"), size(F.collect_list("a")).alias("_a"), size(F.collect_list("b")).alias("_b"))
    stats = told.groupBy(unit).agg(F.count("*").alias("n"), F.count_if(F.col("side") == 0).alias("n_low"), F.avg(F.when(F.col("side") == 0, F.col("sure"))).alias("sure_low"), F.avg(F.when(F.col("side") == 1, F.col("sure"))).alias("sure_high"))
    sides = [told.where(F.col("side") == k).select(unit, time) for k in (0, 1)]
    counted = refractory_counts(*sides, [unit], time, bins, width)

    @F.pandas_udf("q double, r double")
    def scored(sums: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([least_scores(np.asarray(x), bins) for x in sums], columns=["q", "r"])

    scores = counted.select(unit, scored("sums").alias("s")).select(unit, "s.q", "s.r")
    rows = stats.join(shape, unit).join(scores, unit, "left")
    gap = 2 * F.abs(F.col("_a") - F.col("_b")) / (F.col("_a") + F.col("_b"))
    kept = F.coalesce((F.col("q") < most_q) & (F.col("r") < most_r), F.lit(False)) | F.coalesce((F.col("correlation") > alike) & (gap < near), F.lit(False))
    good = (F.least("sure_low", "sure_high") > sure) & (F.least("n_low", F.col("n") - F.col("n_low")) > share * F.col("n"))
    verdicts = rows.select(F.col(unit).alias("unit"), "n", "n_low", "sure_low", "sure_high", "correlation", gap.alias("gap"), "q", "r", (F.coalesce(good, F.lit(False)) & ~kept).alias("split"))
    return verdicts, told


@BOOK.add("k8b_split_units")
def _k8b(spark, sf):
    rows = events(spark, sf).select((F.col("user_id") % 10).alias("unit"), "t", F.array(F.col("value"), F.expr("(t div 1000) % 977 / 8.0"), F.log1p("value") * 10).alias("x"))
    return split_units(rows, "unit", "t", "x", BINS, WIDTH, 30, 6)[0]
