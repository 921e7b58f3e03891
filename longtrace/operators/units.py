"""Spike detection and waveform features (inventory group K), and greedy merging (F18)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longtrace.functions.carry import carried
from longtrace.functions.islands import band_join, islands
from longtrace.operators.signals import SNIP, snippets, snips
from longtrace.plans.standins import HOUR, SIGNAL, SPIKES, Book, signal, spikes
from longtrace.session import remove, written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def detect_spikes(df: DataFrame, keys: list[str], index: str, value: str, threshold: float, artifact: float, dead: int, chunk: int) -> DataFrame:
    """(keys, index): peaks of |value| above threshold and below artifact, at least dead samples behind the peak before.

    A crossing starts a search for the peak over dead // 2 samples; the next search
    starts at the first crossing dead or more samples behind that peak. Only samples
    beyond threshold leave the scan. A crossing that is dead or more samples behind
    the one before is free for certain, so islands of crossings closer than that are
    walked apart, in order, holding one open search: an island may be as long as a
    channel. The result doesn't depend on chunk.
    """
    crossings = df.where(F.abs(F.col(value)) > threshold).select(*keys, index, F.abs(F.col(value)).alias("_v"))
    runs = islands(crossings.select(*keys, index), keys, index, dead - 1, chunk).drop("n")
    rows = band_join(crossings, runs, keys, index, "first", "last", chunk).select(*keys, "first", index, "_v")
    ordered = rows.repartition(*keys, "first").sortWithinPartitions(*keys, "first", index)
    fields = [*(rows.schema[k] for k in keys), T.StructField(index, T.LongType())]
    reach = max(1, dead // 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        island, begun, free, best = None, None, None, (0.0, 0)
        for pdf in batches:
            out: list[tuple] = []
            names = [pdf[c].tolist() for c in (*keys, "first")]
            for *now, i, v in zip(*names, pdf[index].tolist(), pdf["_v"].tolist(), strict=True):
                if now == island and begun is not None and i < begun + reach:
                    best = (v, i) if v > best[0] else best
                    continue
                if begun is not None:
                    if best[0] < artifact:
                        out.append((*island[:-1], best[1]))
                    free, begun = best[1] + dead, None
                if now != island or i >= free:
                    island, begun, best = now, i, (v, i)
            yield pd.DataFrame(out, columns=[*keys, index])
        if begun is not None and best[0] < artifact:
            yield pd.DataFrame([(*island[:-1], best[1])], columns=[*keys, index])

    return ordered.mapInPandas(run, T.StructType(fields))


@BOOK.add("k1_detect_spikes")
def _k1(spark, sf):
    return detect_spikes(signal(spark, sf), ["channel"], "i", "v", 60, 400, 4, 64)


def polytrode_detect(df: DataFrame, keys: list[str], channel: str, time: str, dead: int, chunk: int = HOUR) -> DataFrame:
    """(keys, time, channel): crossings of all channels of a probe without the earlier of two neighbours closer than dead."""
    near = carried(df.select(*keys, time, channel), keys, time, chunk, [channel], lead={"_a": F.col(time)})
    return near.where(F.col("_a").isNull() | (F.col("_a") - F.col(time) >= dead)).drop("_a")


@BOOK.add("k2_polytrode_detect", f"WITH {SPIKES}, x AS (SELECT unit // 4 AS probe, unit, t FROM spikes WHERE amplitude > 40), l AS (SELECT *, lead(t) OVER (PARTITION BY probe ORDER BY t, unit) - t AS a FROM x) SELECT probe, t, unit FROM l WHERE a IS NULL OR a >= {2 * HOUR}")
def _k2(spark, sf):
    rows = spikes(spark, sf).where("amplitude > 40").select(F.expr("unit div 4").alias("probe"), "unit", "t")
    return polytrode_detect(rows, ["probe"], "unit", "t", 2 * HOUR, 240 * HOUR)


def joined_snippets(found: DataFrame, samples: DataFrame, keys: list[str], channel: str, at: str, index: str, value: str, before: int, after: int, chunk: int = 1 << 16) -> DataFrame:
    """(keys, at, snippet): the snippets of all channels of a probe about each event, one behind the other in order of the channels; events near an end of any channel are left out. A probe's channels are those with samples."""
    channels = samples.select(*keys, channel).distinct()
    n = channels.groupBy(*keys).agg(F.count("*").alias("_n"))
    each = snippets(found.select(*keys, at).distinct().join(channels, keys), samples, [*keys, channel], at, index, value, before, after, chunk)
    both = each.groupBy(*keys, at).agg(F.array_sort(F.collect_list(F.struct(F.col(channel).alias("c"), F.col("snippet").alias("s")))).alias("_l")).join(n, keys)
    return both.where(F.size("_l") == F.col("_n")).select(*keys, at, F.flatten(F.transform("_l", lambda x: x["s"])).alias("snippet"))


_PROBE = f"{SIGNAL}, smp AS (SELECT channel // 4 AS probe, channel, i, v FROM signal), hit AS (SELECT probe, i, channel FROM smp WHERE v > 70), dl AS (SELECT *, lead(i) OVER (PARTITION BY probe ORDER BY i, channel) - i AS a FROM hit), ev2 AS (SELECT DISTINCT probe, i FROM dl WHERE a IS NULL OR a >= 2), chs AS (SELECT DISTINCT probe, channel FROM smp)"


@BOOK.add(
    "k2b_joined_snippets",
    f"WITH {_PROBE}, each AS (SELECT e.probe, e.i AS idx, s.channel, list(s.v ORDER BY s.i) AS snip FROM ev2 e JOIN smp s ON s.probe = e.probe AND s.i BETWEEN e.i - 2 AND e.i + 1 GROUP BY 1, 2, 3 HAVING count(*) = 4) "
    'SELECT probe, idx AS "at", flatten(list(snip ORDER BY channel)) AS snippet FROM each GROUP BY probe, idx HAVING count(*) = (SELECT count(*) FROM chs WHERE chs.probe = each.probe)',
)
def _k2b(spark, sf):
    rows = signal(spark, sf).select(F.expr("channel div 4").alias("probe"), "channel", "i", "v")
    found = polytrode_detect(rows.where("v > 70"), ["probe"], "channel", "i", 2, 32)
    return joined_snippets(found.select("probe", F.col("i").alias("at")), rows, ["probe"], "channel", "at", "i", "v", 2, 2, 32)


def align_snippet(snippet: Column, centre: int, reach: int, length: int) -> Column:
    """length items about the least item within reach of centre (counted from 0), NULL if they don't fit."""
    near = F.slice(snippet, centre - reach + 1, 2 * reach + 1)
    low = F.array_position(near, F.array_min(near)) - 1 + centre - reach
    first = (low - length // 2).cast("int")
    return F.when((first >= 0) & (first + length <= F.size(snippet)), F.slice(snippet, F.greatest(first, F.lit(0)) + 1, F.lit(length)))


@BOOK.add(
    "k3_align_snippet",
    f"WITH {SNIP}, p AS (SELECT channel, snip.at, snippet, list_position(snippet[3:5], list_min(snippet[3:5])) + 1 AS low FROM snip) SELECT channel, p.at, CASE WHEN low - 2 >= 0 AND low + 2 <= 8 THEN round(list_sum(snippet[low - 1:low + 2]), 4) END AS total FROM p",
)
def _k3(spark, sf):
    aligned = align_snippet(F.col("snippet"), 3, 1, 4)
    return snips(spark, sf).select("channel", "at", F.round(F.aggregate(aligned, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


def spline_matrix(n: int, factor: int) -> np.ndarray:
    """Rows: weights of n equally spaced values in the natural cubic spline at every 1/factor step."""
    a, b = np.eye(n), np.zeros((n, n))
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = 1, 4, 1
        b[i, i - 1 : i + 2] = 6, -12, 6
    curve = np.linalg.solve(a, b)
    out = []
    for t in np.arange(0, (n - 1) * factor + 1) / factor:
        k = min(int(t), n - 2)
        u = t - k
        e0, e1 = np.eye(n)[k], np.eye(n)[k + 1]
        out.append((1 - u) * e0 + u * e1 + ((1 - u) ** 3 - (1 - u)) / 6 * curve[k] + (u**3 - u) / 6 * curve[k + 1])
    return np.array(out)


def interp_snippet(df: DataFrame, keys: list[str], snippet: str, length: int, factor: int) -> DataFrame:
    """(keys, low, shift): value and place (in steps of 1/factor) of the least item of the cubic spline through each snippet; a batch is one matrix product."""
    m = spline_matrix(length, factor)
    fields = [*(df.schema[k] for k in keys), T.StructField("low", T.DoubleType()), T.StructField("shift", T.LongType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                fine = np.stack(pdf[snippet].to_list()) @ m.T
                yield pdf[keys].assign(low=fine.min(1), shift=fine.argmin(1))

    return df.select(*keys, snippet).mapInPandas(run, T.StructType(fields))


@BOOK.add("k4_interp_snippet")
def _k4(spark, sf):
    return interp_snippet(snips(spark, sf), ["channel", "at"], "snippet", 8, 4).withColumn("low", F.round("low", 5))


def recentred(df: DataFrame, keys: list[str], snippet: str, length: int, factor: int, centre: int, reach: int, before: int, after: int) -> DataFrame:
    """(keys, snippet): before items up to, and after items from, the least item of the cubic spline within reach of centre, taken from the spline at the snippet's own step; snippets that don't reach so far are left out."""
    m = spline_matrix(length, factor)
    fields = [*(df.schema[k] for k in keys), T.StructField("snippet", T.ArrayType(T.DoubleType()))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            fine = np.stack(pdf[snippet].to_list()) @ m.T
            first = max(0, (centre - reach) * factor)
            low = first + fine[:, first : (centre + reach) * factor + 1].argmin(1)
            at = low[:, None] + factor * np.arange(-before, after)
            ok = (at[:, 0] >= 0) & (at[:, -1] < fine.shape[1])
            yield pdf.loc[ok, keys].assign(snippet=list(np.take_along_axis(fine[ok], at[ok], 1)))

    return df.select(*keys, snippet).mapInPandas(run, T.StructType(fields))


@BOOK.add("k4b_recentred_snippet")
def _k4b(spark, sf):
    found = recentred(snips(spark, sf), ["channel", "at"], "snippet", 8, 4, 3, 2, 2, 3)
    return found.select("channel", "at", F.transform("snippet", lambda x: F.round(x, 5)).alias("snippet"))



def haar_features(vector: Column, length: int, levels: int) -> Column:
    """Haar coefficients: differences of every level, finest first, then the last averages; length is divisible by 2 ** levels."""
    now, out = vector, []
    for _ in range(levels):
        length //= 2
        pair = lambda s, n=length, v=now: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (F.get(v, 2 * i) + s * F.get(v, 2 * i + 1)) / F.lit(2**0.5))
        out.append(pair(-1))
        now = pair(1)
    return F.concat(*out, now)


@BOOK.add(
    "k5_haar_features",
    "WITH x AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS v FROM embeddings), a AS (SELECT vec_id, list_transform(range(1, 33), lambda i: (v[2 * i - 1] - v[2 * i]) / sqrt(2)) AS d1, list_transform(range(1, 33), lambda i: (v[2 * i - 1] + v[2 * i]) / sqrt(2)) AS s1 FROM x), "
    "b AS (SELECT *, list_transform(range(1, 17), lambda i: (s1[2 * i - 1] - s1[2 * i]) / sqrt(2)) AS d2, list_transform(range(1, 17), lambda i: (s1[2 * i - 1] + s1[2 * i]) / sqrt(2)) AS s2 FROM a) SELECT vec_id, unnest(range(0, 64))::INTEGER AS k, round(unnest(list_concat(list_concat(d1, d2), s2)), 4) AS w FROM b",
)
def _k5(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return rows.select("vec_id", F.posexplode(haar_features(F.col("v"), 64, 2)).alias("k", "w")).withColumn("w", F.round("w", 4))


def pca_features(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(key, features): first k principal components, each turned so that its largest loading is positive."""
    rows = df.select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    load = model.pc.toArray()
    sign = [float(np.sign(load[np.abs(load[:, c]).argmax(), c])) for c in range(k)]
    p = vector_to_array("_p")
    return model.transform(rows).select(key, F.array(*(F.get(p, F.lit(c)) * s for c, s in enumerate(sign))).alias("features"))


@BOOK.add("k6_pca_features")
def _k6(spark, sf):
    return pca_features(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding", 5).select("vec_id", F.transform("features", lambda x: F.round(x, 4)).alias("features"))


def isolated(df: DataFrame, keys: list[str], at: str, apart: int, chunk: int = 1 << 20) -> DataFrame:
    """The events with no other of their key within apart."""
    near = carried(df, keys, at, chunk, lag={"_p": F.col(at)}, lead={"_n": F.col(at)})
    lone = lambda gap: gap.isNull() | (gap > apart)
    return near.where(lone(F.col(at) - F.col("_p")) & lone(F.col("_n") - F.col(at))).drop("_p", "_n")


def snippet_components(df: DataFrame, snippet: str, size: int, k: int, centre: int) -> np.ndarray:
    """(size, k): the first components of the snippets' products, not centred; the first points down at `centre`, the others up at their largest item. Tasks sum their own rows; size x size numbers come to the driver."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[snippet].to_list()).astype(float)
                total += x.T @ x
        yield pd.DataFrame({"q": [total.reshape(-1)]})

    parts = df.select(snippet).mapInPandas(sums, "q array<double>").select(F.posexplode("q").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    total = np.zeros(size * size)
    for r in parts:
        total[r.i] = r.x
    pc = np.linalg.eigh(total.reshape(size, size))[1][:, ::-1][:, :k]
    sign = np.sign(pc[np.abs(pc).argmax(0), np.arange(k)])
    sign[0] = -np.sign(pc[centre, 0]) or 1.0
    return pc * sign


def projected(df: DataFrame, keys: list[str], snippet: str, components: np.ndarray) -> DataFrame:
    """(keys, features) of snippets on the columns of components."""
    dot = lambda c: F.aggregate(F.zip_with(snippet, F.array(*map(F.lit, c.tolist())), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    return df.select(*keys, F.array(*(dot(c) for c in components.T)).alias("features"))


@BOOK.add("k6b_isolated_components")
def _k6b(spark, sf):
    rows = snips(spark, sf)
    found = projected(rows, ["channel", "at"], "snippet", snippet_components(isolated(rows, ["channel"], "at", 4, 64), "snippet", 8, 3, 3))
    return found.select("channel", "at", F.transform("features", lambda x: F.round(x, 4)).alias("features"))


@BOOK.add("k7_waveform_features", f"WITH {SNIP} SELECT channel, snip.at, unnest(range(0, 8))::INTEGER AS k, unnest(snippet) AS v FROM snip")
def _k7(spark, sf):
    """The raw samples as features."""
    return snips(spark, sf).select("channel", "at", F.posexplode("snippet").alias("k", "v"))


def bimodal_split(df: DataFrame, unit: str, value: str, least: int, apart: float, bins: int = 256, rounds: int = 40) -> DataFrame:
    """(unit, n, low_mean, high_mean, threshold, split): two normal distributions fitted to a unit's values; split if both hold a tenth and the means differ by more than apart pooled deviations.

    The fit runs on a histogram of bins steps per unit, counted by Spark, so a unit
    costs one small group however many events it has.
    """
    ends = df.groupBy(unit).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("n")).where((F.col("n") >= least) & (F.col("_hi") > F.col("_lo")))
    step = (F.col("_hi") - F.col("_lo")) / bins
    cut = df.join(ends, unit).withColumn("_b", F.least(F.floor((F.col(value) - F.col("_lo")) / step), F.lit(bins - 1)))
    hist = cut.groupBy(unit, "n", (F.col("_lo") + (F.col("_b") + 0.5) * step).alias("x")).agg(F.count("*").alias("c"))
    fields = [hist.schema[unit], T.StructField("n", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("low_mean", "high_mean", "threshold")), T.StructField("split", T.BooleanType())]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        x, c = pdf["x"].to_numpy(), pdf["c"].to_numpy(float)
        c = c / c.sum()
        mid = (x * c).sum()
        sd = max(1e-9, np.sqrt(((x - mid) ** 2 * c).sum()))
        m, s, p = np.array([mid - sd, mid + sd]), np.array([sd, sd]), np.array([0.5, 0.5])
        for _ in range(rounds):
            d = p * np.exp(-0.5 * ((x[:, None] - m) / s) ** 2) / s + 1e-300
            r = d / d.sum(1, keepdims=True) * c[:, None]
            p = r.sum(0)
            m = (r * x[:, None]).sum(0) / p
            s = np.maximum(np.sqrt((r * (x[:, None] - m) ** 2).sum(0) / p), 1e-3 * sd)
        a, b = np.argsort(m)
        between = x[(x >= m[a]) & (x <= m[b])]
        d = p * np.exp(-0.5 * ((between[:, None] - m) / s) ** 2) / s
        cross = float(between[np.abs(d[:, 0] - d[:, 1]).argmin()]) if len(between) else float(mid)
        far = (m[b] - m[a]) / np.sqrt((s**2).mean())
        return pd.DataFrame({unit: [pdf[unit].iloc[0]], "n": [pdf["n"].iloc[0]], "low_mean": [m[a]], "high_mean": [m[b]], "threshold": [cross], "split": [bool(far > apart and p.min() > 0.1)]})

    return hist.groupBy(unit).applyInPandas(run, T.StructType(fields))


@BOOK.add("k8_bimodal_split")
def _k8(spark, sf):
    found = bimodal_split(spikes(spark, sf).withColumn("grp", F.col("unit") % 10), "grp", "amplitude", 30, 1.0)
    return found.select("grp", "n", *(F.round(c, 3).alias(c) for c in ("low_mean", "high_mean", "threshold")), "split")


def ranks(points: DataFrame, marks: DataFrame, key: str, at: str, chunk: int) -> DataFrame:
    """marks with `rank`: how many points of its key lie before the mark (`at`); a point and a mark at the same place don't count."""
    both = marks.withColumns({"_at": 2 * F.col(at), "_one": F.lit(0)}).unionByName(points.select(key, (2 * F.col(at) + 1).alias("_at"), F.lit(1).alias("_one")), allowMissingColumns=True)
    return carried(both, [key], "_at", 2 * chunk, total={"rank": F.col("_one")}).where("_one = 0").drop("_at", "_one")


def covered_spans(truth: DataFrame, test: DataFrame, key: str, time: str, unit: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(key, unit, _lo, _hi): the runs of a key's truth times, by number, that have an event of the unit at most `most` away; (key, unit, _mb): how many times of the unit have such a truth event.

    A unit's times with less than twice `most` between them reach over one stretch, whose
    ends are looked up among the truth times: no pair of events is made.
    """
    points = truth.select(key, F.col(time).alias("_t")).distinct()
    own = test.select(key, unit, time).distinct()
    chunk = 64 * (most + 1)
    ends = lambda df, low, high: df.select(*df.columns, F.inline(F.array(F.struct((F.col(low) - most).alias("_t"), F.lit(0).alias("_side")), F.struct((F.col(high) + most + 1).alias("_t"), F.lit(1).alias("_side")))))
    side = lambda k: F.max(F.when(F.col("_side") == k, F.col("rank")))
    found = lambda df, by, low, high: ranks(points, ends(df, low, high), key, "_t", chunk).groupBy(*by).agg(side(0).alias("_lo"), side(1).alias("_hi")).where("_hi > _lo")
    runs = islands(own, [key, unit], time, 2 * most + 1, chunk).drop("n")
    spans = found(runs, [key, unit, "first", "last"], "first", "last").select(key, unit, "_lo", "_hi")
    return spans, found(own, [key, unit, time], time, time).groupBy(key, unit).agg(F.count("*").alias("_mb"))


def less_covered(spans: DataFrame, taken: DataFrame, key: str, chunk: int = 1 << 16) -> DataFrame:
    """spans without the numbers in `taken` (key, _lo, _hi; disjoint), the numbers left being counted anew, so that a span stays one; spans without any go."""
    cuts = carried(taken, [key], "_lo", chunk, total={"_sum": F.col("_hi") - F.col("_lo")})
    cuts = cuts.select(key, F.col("_lo").alias("_at"), F.struct("_lo", "_hi", (F.col("_sum") - F.col("_hi") + F.col("_lo")).alias("before")).alias("_cut"))
    columns = [c for c in spans.columns if c not in ("_lo", "_hi")]
    ends = spans.withColumn("_id", F.struct("_lo", "_hi")).select(*columns, "_id", F.inline(F.array(F.struct(F.col("_lo").alias("_at"), F.lit(0).alias("_side")), F.struct(F.col("_hi").alias("_at"), F.lit(1).alias("_side")))))
    seen = carried(ends.unionByName(cuts, allowMissingColumns=True), [key], "_at", chunk, before={"_last": F.col("_cut")}).where("_cut is null")
    moved = F.col("_at") - F.coalesce(F.col("_last.before") + F.least("_at", "_last._hi") - F.col("_last._lo"), F.lit(0))
    side = lambda k: F.max(F.when(F.col("_side") == k, moved))
    return seen.groupBy(*columns, "_id").agg(side(0).alias("_lo"), side(1).alias("_hi")).where("_hi > _lo").select(*columns, "_lo", "_hi")


def merge_by_agreement(truth: DataFrame, test: DataFrame, key: str, time: str, unit: str, most: int, gain: float, rounds: int = 1000) -> DataFrame:
    """(key, unit, round, score): per key, test units are added to the union one by one, the best first, while the score 1 - (miss + false positives) grows by more than gain.

    What a unit covers is kept as spans of numbers of the truth times, at most one for
    each of its events. A round adds up, for each open unit, the truth events that only
    it would add; the spans of the chosen one are then taken out of all others, which
    are written anew, and only sums of a row for each key go on. The loop ends when no
    key improves; more than `rounds` raise.
    """
    hits, own = covered_spans(truth, test, key, time, unit, most)
    hits = written(hits, "agreement_hits")
    sizes = written(test.groupBy(key, unit).agg(F.count("*").alias("_nu")).join(own, [key, unit], "left").na.fill(0, ["_mb"]), "agreement_sizes")
    zero = F.lit(0).cast("long")
    state = truth.groupBy(key).agg(F.count("*").alias("_nt")).select(key, "_nt", zero.alias("_a"), zero.alias("_b"), zero.alias("_n"), F.lit(float("-inf")).alias("_best"))
    open_units, result = sizes, None
    for k in range(1, rounds + 1):
        added = hits.groupBy(key, unit).agg(F.sum(F.col("_hi") - F.col("_lo")).alias("_new"))
        rows = open_units.join(state, key).join(added, [key, unit], "left").na.fill(0, ["_new"])
        a, b, n = F.col("_a") + F.col("_new"), F.col("_b") + F.col("_mb"), F.col("_n") + F.col("_nu")
        scored = rows.where("_mb > 0").select(key, unit, "_nt", a.alias("_a"), b.alias("_b"), n.alias("_n"), "_best", F.round(1 - ((1 - a / F.col("_nt")) + (1 - b / n)), 9).alias("score"))
        best = scored.groupBy(key).agg(F.max_by(F.struct(*(c for c in scored.columns if c != key)), F.struct("score", -F.col(unit))).alias("b")).select(key, "b.*")
        better = written(best.where(F.col("score") > F.col("_best") + gain).withColumn("round", F.lit(k)), "agreement")
        if better.isEmpty():
            return better.select(key, unit, "round", "score") if result is None else result
        told = better.select(key, unit, "round", "score")
        result = told if result is None else result.unionByName(told)
        chosen = hits.join(better.select(key, unit), [key, unit], "left_semi").select(key, "_lo", "_hi")
        rest = hits.join(better.select(key), key, "left_semi").join(better.select(key, unit), [key, unit], "left_anti")
        before, hits = hits, written(less_covered(rest, chosen, key).select(key, unit, "_lo", "_hi"), "agreement_hits")
        remove(before)
        # a key that doesn't improve has no row any more
        open_units = sizes.join(result.select(key, unit), [key, unit], "left_anti")
        state = better.select(key, "_nt", "_a", "_b", "_n", F.col("score").alias("_best"))
    raise RuntimeError(f"keys still improve after {rounds} rounds")


@BOOK.add("f18_merge_by_agreement")
def _f18(spark, sf):
    rows = spikes(spark, sf).select((F.col("unit") % 5).alias("grp"), "unit", "t")
    return merge_by_agreement(rows.where("unit % 10 < 5").select("grp", "t"), rows.where("unit % 10 >= 5"), "grp", "t", "unit", 6 * HOUR, 0.01).withColumn("score", F.round("score", 6))

