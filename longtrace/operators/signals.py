"""Preparation of continuous signals (inventory group E)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longtrace.functions.carry import carried
from longtrace.operators.grid import nearest_channels
from longtrace.plans.standins import ELECTRODES, HOUR, SIGNAL, SPIKES, Book, electrodes, signal, spikes

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql


def select_channels(df: DataFrame, channel: str, wanted: DataFrame) -> DataFrame:
    return df.join(wanted.select(channel).distinct(), channel, "left_semi")


def unknown_channels(df: DataFrame, channel: str, wanted: DataFrame) -> DataFrame:
    """Asked for but not in the recording."""
    return wanted.select(channel).distinct().join(df.select(channel).distinct(), channel, "left_anti")


@BOOK.add("e1_select_channels", f"WITH {SIGNAL} SELECT channel, i, v FROM signal WHERE channel IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)")
def _e1(spark, sf):
    wanted = spark.read.parquet(f"{sf}/supplier.parquet").where("s_acctbal > 1000").select(F.col("s_suppkey").alias("channel"))
    return select_channels(signal(spark, sf), "channel", wanted).select("channel", "i", "v")


def time_slice(df: DataFrame, index: str, start: float, stop: float, rate: float) -> DataFrame:
    """Samples from round(start * rate) to before round(stop * rate): a plain range on the index, pushed to the scan."""
    return df.where((F.col(index) >= round(start * rate)) & (F.col(index) < round(stop * rate)))


@BOOK.add("e2_time_slice", f"WITH {SIGNAL} SELECT channel, i, v FROM signal WHERE i >= 5 AND i < 40")
def _e2(spark, sf):
    return time_slice(signal(spark, sf), "i", 0.5, 4.0, 10).select("channel", "i", "v")


def decimate(df: DataFrame, index: str, every: int, first: str | None = None) -> DataFrame:
    """Every n-th sample counted from its packet's first one; no filter."""
    return df.where((F.col(index) - (F.col(first) if first else 0)) % every == 0)


@BOOK.add("e3_decimate", f"WITH {SIGNAL} SELECT channel, i, v FROM signal WHERE i % 5 = 0")
def _e3(spark, sf):
    return decimate(signal(spark, sf), "i", 5).select("channel", "i", "v")


def pad_pauses(df: DataFrame, keys: list[str], index: str, value: str, chunk: int = 1 << 20) -> DataFrame:
    """(keys, index, value) with zeros for missing samples between a key's first and last: only the gaps are listed."""
    near = carried(df.select(*keys, F.col(index).alias("_i")), keys, "_i", chunk, lead={"_a": F.col("_i")})
    holes = near.where("_a > _i + 1").select(*keys, F.explode(F.sequence(F.col("_i") + 1, F.col("_a") - 1)).alias(index), F.lit(0.0).alias(value))
    return df.select(*keys, index, value).unionByName(holes)


@BOOK.add("e4_pad_pauses", f"WITH {SIGNAL}, k AS (SELECT channel, i, v FROM signal WHERE v > 7.5), r AS (SELECT channel, unnest(range(min(i), max(i) + 1)) AS i FROM k GROUP BY channel) SELECT r.channel, r.i, coalesce(v, 0.0) AS v FROM r LEFT JOIN k USING (channel, i)")
def _e4(spark, sf):
    return pad_pauses(signal(spark, sf).where("v > 7.5"), ["channel"], "i", "v", chunk=16)


def concat_segments(df: DataFrame, keys: list[str], segment: str, start: str, index: str) -> DataFrame:
    """df with `at`: sample numbers over all segments of a key in order of their start; segment ids and their real starts stay."""
    sizes = df.groupBy(*keys, segment).agg(F.min(start).alias("_s"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_s", segment).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*keys, segment, F.coalesce(before, F.lit(0)).alias("_o"))
    return df.join(offsets, [*keys, segment]).withColumn("at", F.col("_o") + F.col(index)).drop("_o")


@BOOK.add(
    "e5_concat_segments",
    f"WITH {SIGNAL}, s AS (SELECT channel, t // {240 * HOUR} AS segment, t, row_number() OVER (PARTITION BY channel, t // {240 * HOUR} ORDER BY i) - 1 AS k FROM signal), z AS (SELECT channel, segment, count(*) AS n FROM s GROUP BY 1, 2), o AS (SELECT channel, segment, coalesce(sum(n) OVER (PARTITION BY channel ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM z) SELECT channel, segment, k, (o + k)::BIGINT AS at FROM s JOIN o USING (channel, segment)",
)
def _e5(spark, sf):
    rows = signal(spark, sf).withColumn("segment", F.expr(f"t div {240 * HOUR}"))
    rows = rows.withColumn("k", (F.row_number().over(Window.partitionBy("channel", "segment").orderBy("i")) - 1).cast("long"))
    return concat_segments(rows, ["channel"], "segment", "t", "k").select("channel", "segment", "k", "at")


def int_scale(df: DataFrame, headers: DataFrame, channel: str, value: str) -> DataFrame:
    """value times (max_analog - min_analog) / (max_digital - min_digital) of its channel's header."""
    factor = (F.col("max_analog") - F.col("min_analog")) / (F.col("max_digital") - F.col("min_digital"))
    return df.join(headers, channel).withColumn("scaled", F.col(value) * factor)


@BOOK.add("e6_int_scale_by_header", f"WITH {SIGNAL}, {ELECTRODES} SELECT s.channel, i, round(v * (5000.0 + channel) / 65535.0, 6) AS scaled FROM signal s JOIN electrodes USING (channel)")
def _e6(spark, sf):
    headers = electrodes(spark, sf).select("channel", (F.col("channel") + 2500.0).alias("max_analog"), F.lit(-2500.0).alias("min_analog"), F.lit(32767).alias("max_digital"), F.lit(-32768).alias("min_digital"))
    return int_scale(signal(spark, sf), headers, "channel", "v").select("channel", "i", F.round("scaled", 6).alias("scaled"))


def common_median_reference(df: DataFrame, index: str, value: str) -> DataFrame:
    """df with `referenced`: value less the median over channels at the same sample."""
    mid = df.groupBy(index).agg(F.percentile(value, F.lit(0.5)).alias("_m"))
    return df.join(mid, index).withColumn("referenced", F.col(value) - F.col("_m")).drop("_m")


@BOOK.add("e7_common_median_reference", f"WITH {SIGNAL}, m AS (SELECT i, quantile_cont(v, 0.5) AS m FROM signal GROUP BY i) SELECT channel, i, round(v - m, 4) AS referenced FROM signal JOIN m USING (i)")
def _e7(spark, sf):
    return common_median_reference(signal(spark, sf), "i", "v").select("channel", "i", F.round("referenced", 4).alias("referenced"))


def demean_channel(df: DataFrame, keys: list[str], index: str, value: str, batch: int) -> DataFrame:
    """df with `centred`: value less its key's mean over the batch of samples."""
    w = Window.partitionBy(*keys, F.floor(F.col(index) / batch))
    return df.withColumn("centred", F.col(value) - F.avg(value).over(w))


@BOOK.add("e8_demean_channel", f"WITH {SIGNAL} SELECT channel, i, round(v - avg(v) OVER (PARTITION BY channel, i // 64), 9) AS centred FROM signal")
def _e8(spark, sf):
    return demean_channel(signal(spark, sf), ["channel"], "i", "v", 64).select("channel", "i", F.round("centred", 9).alias("centred"))


#: Samples filtered together, about.
GROUP = 1 << 18


def butterworth(order: int, low: float, high: float, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(b, a) of a digital band-pass: the analog prototype's poles moved to the band and mapped by the bilinear rule."""
    warp = lambda f: 2 * rate * np.tan(np.pi * f / rate)
    w1, w2 = warp(low), warp(high)
    centre, width = np.sqrt(w1 * w2), w2 - w1
    poles = np.exp(1j * np.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    half = poles * width / 2
    analog = np.concatenate([half + np.sqrt(half**2 - centre**2), half - np.sqrt(half**2 - centre**2)])
    z = (2 * rate + analog) / (2 * rate - analog)
    gain = (width**order) * (2 * rate) ** order / np.prod(2 * rate - analog)
    b = np.real(gain) * np.poly(np.concatenate([np.ones(order), -np.ones(order)]))
    return b, np.real(np.poly(z))


def filtered(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The recursion of b over a along the last axis, for many series at once."""
    out, state = np.zeros_like(x, dtype=float), np.zeros((*x.shape[:-1], len(b) - 1))
    for k in range(x.shape[-1]):
        y = b[0] * x[..., k] + state[..., 0]
        state[..., :-1] = state[..., 1:]
        state[..., -1] = 0
        state += b[1:] * x[..., k, None] - a[1:] * y[..., None]
        out[..., k] = y
    return out


def both_ways(series: list[np.ndarray], b: np.ndarray, a: np.ndarray, cells: int = 1 << 21) -> list[np.ndarray]:
    """Forward and backward recursion of many series at once: those of like length are stacked, padded behind their ends, which nothing before sees."""
    out: list = [None] * len(series)
    order = sorted(range(len(series)), key=lambda k: len(series[k]))
    while order:
        widest = len(series[order[-1]])
        part, order = order[-max(1, cells // widest) :], order[: -max(1, cells // widest)]
        x = np.zeros((len(part), widest))
        turned = lambda y: [y[r, : len(series[k])][::-1] for r, k in enumerate(part)]
        for rows in (lambda: [series[k] for k in part], lambda: turned(x)):
            new = np.zeros_like(x)
            for r, row in enumerate(rows()):
                new[r, : len(row)] = row
            x = filtered(new, b, a)
        for k, row in zip(part, turned(x), strict=True):
            out[k] = row
    return out


def bandpass(df: DataFrame, keys: list[str], index: str, value: str, b: np.ndarray, a: np.ndarray, chunk: int, halo: int) -> DataFrame:
    """(keys, index, filtered): forward and backward recursion over chunks of a key, each with halo samples from both neighbours; what decays within halo doesn't depend on chunk.

    Chunks are dealt by hash into groups of some GROUP samples, whatever their
    number, and filtered together.
    """
    ends = df.groupBy(*keys).agg(F.floor(F.min(index) / chunk).alias("_lo"), F.floor(F.max(index) / chunk).alias("_hi"), F.count("*").alias("_n"))
    total = ends.agg(F.sum("_n")).first()[0] or 0
    groups = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // GROUP))
    near = F.sequence(F.greatest("_lo", F.floor((F.col(index) - halo) / chunk)), F.least("_hi", F.floor((F.col(index) + halo) / chunk)))
    spread = df.join(ends, keys).select(*keys, index, F.col(value).alias("v"), F.explode(near).alias("_c"))
    spread = spread.withColumn("_g", F.pmod(F.xxhash64(*keys, "_c"), F.lit(groups)))
    fields = [*(spread.schema[k] for k in keys), T.StructField(index, T.LongType()), T.StructField("filtered", T.DoubleType())]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*keys, "_c", index], ignore_index=True)
        new = np.flatnonzero((pdf[[*keys, "_c"]] != pdf[[*keys, "_c"]].shift()).any(axis=1))
        pdf["filtered"] = np.concatenate(both_ways(np.split(pdf["v"].to_numpy(float), new[1:]), b, a))
        return pdf[pdf[index] // chunk == pdf["_c"]][[*keys, index, "filtered"]]

    return spread.groupBy("_g").applyInPandas(run, T.StructType(fields))


@BOOK.add("e9_bandpass")
def _e9(spark, sf):
    b, a = butterworth(2, 50, 200, 1000)
    return bandpass(signal(spark, sf), ["channel"], "i", "v", b, a, 4096, 512).withColumn("filtered", F.round("filtered", 6))


@BOOK.add("e10_resample_lfp")
def _e10(spark, sf):
    """Low band, then every tenth sample."""
    b, a = butterworth(2, 5, 40, 1000)
    return decimate(bandpass(signal(spark, sf), ["channel"], "i", "v", b, a, 4096, 1024), "i", 10).withColumn("filtered", F.round("filtered", 6))


def local_minima(df: DataFrame, keys: list[str], index: str, value: str, reach: int, threshold: float, chunk: int = 1 << 16) -> DataFrame:
    """Rows that are the least within reach samples either way and below threshold; by chunks of a key with reach samples of their neighbours."""
    near = F.sequence(F.floor((F.col(index) - reach) / chunk), F.floor((F.col(index) + reach) / chunk))
    w = Window.partitionBy(*keys, "_c").orderBy(index).rangeBetween(-reach, reach)
    lows = df.withColumn("_c", F.explode(near)).withColumn("_low", F.min(value).over(w))
    return lows.where((F.col("_c") == F.floor(F.col(index) / chunk)) & (F.col(value) == F.col("_low")) & (F.col(value) < threshold)).drop("_low", "_c")


MINIMA = f"{SIGNAL}, minima AS (SELECT channel, i, v FROM (SELECT *, min(v) OVER (PARTITION BY channel ORDER BY i RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS l FROM signal) WHERE v = l AND v < 10)"


def minima(spark, sf) -> DataFrame:
    return local_minima(signal(spark, sf).select("channel", "i", "v"), ["channel"], "i", "v", 3, 10)


def bad_channels(crossings: DataFrame, channels: DataFrame, channel: str, seconds: float, least_rate: float) -> DataFrame:
    """Channels with fewer crossings a second than least_rate."""
    counts = crossings.groupBy(channel).agg(F.count("*").alias("n"))
    return channels.join(counts, channel, "left").select(channel, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") / seconds < least_rate)


@BOOK.add("e11_bad_channels", f"WITH {MINIMA}, n AS (SELECT channel, count(*) AS n FROM minima GROUP BY 1) SELECT c.channel, coalesce(n, 0) AS n FROM (SELECT DISTINCT channel FROM signal) c LEFT JOIN n USING (channel) WHERE coalesce(n, 0) / 100.0 < 0.06")
def _e11(spark, sf):
    return bad_channels(minima(spark, sf), signal(spark, sf).select("channel").distinct(), "channel", 100.0, 0.06)


@BOOK.add("e12_local_minima", f"WITH {MINIMA} SELECT * FROM minima")
def _e12(spark, sf):
    return minima(spark, sf)


def isolated_peaks(peaks: DataFrame, channel: str, index: str, value: str, near_channels: int, near: int) -> DataFrame:
    """Peaks without a lower one (ties: smaller channel, then earlier) within near samples on near channels; listed per bucket of time, so an equi join."""
    a = peaks.withColumn("_b", F.floor(F.col(index) / (near + 1)))
    b = a.select(F.col(channel).alias("_c2"), F.col(index).alias("_i2"), F.col(value).alias("_v2"), F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)).alias("_b2"))
    close = (F.abs(F.col(channel) - F.col("_c2")) <= near_channels) & (F.abs(F.col(index) - F.col("_i2")) <= near)
    return a.join(b, (F.col("_b") == F.col("_b2")) & close & (F.struct("_v2", "_c2", "_i2") < F.struct(value, channel, index)), "left_anti").drop("_b")


@BOOK.add("e13_isolated_peaks", f"WITH {MINIMA} SELECT * FROM minima a WHERE NOT EXISTS (SELECT 1 FROM minima b WHERE abs(a.channel - b.channel) <= 2 AND abs(a.i - b.i) <= 4 AND (b.v, b.channel, b.i) < (a.v, a.channel, a.i))")
def _e13(spark, sf):
    return isolated_peaks(minima(spark, sf), "channel", "i", "v", 2, 4)


def channel_covariance(vectors: DataFrame, vector: str, size: int) -> DataFrame:
    """(i, j, c), i <= j: mean product of two items over all rows, by map-side sums per pair."""
    items = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.struct(i.alias("i"), F.transform(F.slice(vector, i + 1, F.lit(size) - i), lambda x: x.cast("double") * F.get(vector, i).cast("double")).alias("p")))
    rows = vectors.select(F.inline(items)).select("i", F.posexplode("p").alias("k", "x"))
    return rows.groupBy("i", (F.col("i") + F.col("k")).alias("j")).agg(F.avg("x").alias("c"))


@BOOK.add("e14_channel_covariance", "WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings) SELECT a.k::INTEGER AS i, b.k::INTEGER AS j, CASE WHEN abs(avg(a.v * b.v)) < 0.000005 THEN 0 ELSE round(avg(a.v * b.v), 5) END AS c FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.k <= b.k GROUP BY 1, 2")
def _e14(spark, sf):
    return channel_covariance(spark.read.parquet(f"{sf}/embeddings.parquet"), "embedding", 64).withColumn("c", F.when(F.abs("c") < 0.000005, 0.0).otherwise(F.round("c", 5)))


def whiten(vectors: DataFrame, key: str, vector: str, size: int, ridge: float = 1e-6) -> DataFrame:
    """(key, white): vectors times E (D + ridge)^-1/2 E' of their covariance. Only the size x size matrix comes to the driver."""
    c = np.zeros((size, size))
    for r in channel_covariance(vectors, vector, size).collect():
        c[r.i, r.j] = c[r.j, r.i] = r.c
    d, e = np.linalg.eigh(c)
    m = e @ np.diag(1 / np.sqrt(np.maximum(d, 0) + ridge)) @ e.T

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "white": list(np.stack(pdf[vector].to_list()).astype(float) @ m)}) if len(pdf) else pd.DataFrame({key: pdf[key], "white": []})

    return vectors.select(key, vector).mapInPandas(run, T.StructType([vectors.schema[key], T.StructField("white", T.ArrayType(T.DoubleType()))]))


@BOOK.add("e15_whiten")
def _e15(spark, sf):
    white = whiten(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding", 64)
    return white.select("vec_id", F.transform("white", lambda x: F.round(x, 4)).alias("white"))


def whiten_local(vectors: DataFrame, key: str, vector: str, neighbours: DataFrame, size: int, ridge: float = 1e-6) -> DataFrame:
    """(key, white): each channel by its own filter over its nearest channels, the first column of E (D + ridge)^-1/2 E' of their mean products.

    neighbours: (channel, other, rank), ranks from 1, the channel itself first. Only
    pairs of channels that are neighbours of one channel are summed, task by task;
    each channel's small eigenproblem is a group of its own. The filters, a number for
    each channel and neighbour, go to every task; size^2 of them at most.
    """
    near = neighbours.select("channel", "other", "rank")
    pairs = near.join(near.withColumnsRenamed({"other": "_o", "rank": "_r"}), "channel").select("channel", F.col("other").alias("i"), F.col("_o").alias("j"), "rank", F.col("_r").alias("other_rank"))
    wanted = pairs.where("i <= j").select("i", "j").distinct().toPandas()
    first, second = wanted["i"].to_numpy(int), wanted["j"].to_numpy(int)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, two = 0, np.zeros(len(first))
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vector].to_list()).astype(float)
                n, two = n + len(x), two + (x[:, first] * x[:, second]).sum(0)
        yield pd.DataFrame({"i": first, "j": second, "n": n, "q": two})

    total = vectors.select(vector).mapInPandas(sums, "i int, j int, n long, q double").groupBy("i", "j").agg((F.sum("q") / F.sum("n")).alias("c"))
    cov = total.select("i", "j", "c")
    both = cov.union(cov.where("i <> j").select("j", "i", "c"))
    rows = pairs.join(both, ["i", "j"])

    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["rank"].max())
        c = np.zeros((n, n))
        c[pdf["rank"] - 1, pdf["other_rank"] - 1] = pdf["c"]
        d, e = np.linalg.eigh(c)
        column = (e @ np.diag(1 / np.sqrt(np.maximum(d, 0) + ridge)) @ e.T)[:, 0]
        others = pdf.drop_duplicates("rank").set_index("rank")["i"]
        return pd.DataFrame({"channel": pdf["channel"].iloc[0], "other": others.loc[range(1, n + 1)].to_numpy(), "w": column})

    filters = rows.groupBy("channel").applyInPandas(solved, "channel int, other int, w double").toPandas()
    m = np.zeros((size, size))
    m[filters["other"].to_numpy(int), filters["channel"].to_numpy(int)] = filters["w"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "white": list(np.stack(pdf[vector].to_list()).astype(float) @ m) if len(pdf) else []})

    return vectors.select(key, vector).mapInPandas(run, T.StructType([vectors.schema[key], T.StructField("white", T.ArrayType(T.DoubleType()))]))


@BOOK.add("e15b_whiten_local")
def _e15b(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    sites = spark.range(64).select(F.col("id").cast("int").alias("channel"), (F.col("id") % 8).cast("double").alias("x"), F.expr("id div 8").cast("double").alias("y"))
    white = whiten_local(rows, "vec_id", "embedding", nearest_channels(sites, "channel", "x", "y", 9), 64)
    return white.select("vec_id", F.transform("white", lambda x: F.round(x, 4)).alias("white"))


def snippets(events: DataFrame, samples: DataFrame, keys: list[str], at: str, index: str, value: str, before: int, after: int, chunk: int = 1 << 16) -> DataFrame:
    """(keys, at, snippet): the before + after samples from at - before on, where all are there; events are listed per chunk they touch, an equi join."""
    spread = events.select(*keys, at).withColumn("_c", F.explode(F.sequence(F.floor((F.col(at) - before) / chunk), F.floor((F.col(at) + after - 1) / chunk))))
    rows = samples.select(*keys, F.col(index).alias("_i"), F.col(value).alias("_v"), F.floor(F.col(index) / chunk).alias("_c"))
    inside = spread.join(rows, [*keys, "_c"]).where((F.col("_i") >= F.col(at) - before) & (F.col("_i") < F.col(at) + after))
    lists = inside.groupBy(*keys, at).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("s"))
    return lists.where(F.size("s") == before + after).select(*keys, at, F.transform("s", lambda x: x["_v"]).alias("snippet"))


SNIP = f"{MINIMA}, snip AS (SELECT m.channel, m.i AS at, list(s.v ORDER BY s.i) AS snippet FROM minima m JOIN signal s ON s.channel = m.channel AND s.i >= m.i - 3 AND s.i < m.i + 5 GROUP BY 1, 2 HAVING count(*) = 8)"


def snips(spark, sf) -> DataFrame:
    return snippets(minima(spark, sf).withColumnRenamed("i", "at"), signal(spark, sf), ["channel"], "at", "i", "v", 3, 5, 32)


@BOOK.add("e16_snippets", f"WITH {SNIP} SELECT channel, snip.at, round(list_sum(snippet), 4) AS total, snippet[4] AS centre FROM snip")
def _e16(spark, sf):
    return snips(spark, sf).select("channel", "at", F.round(F.aggregate("snippet", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.get("snippet", F.lit(3)).alias("centre"))


@BOOK.add("e17_split_by_channel", f"WITH {SPIKES} SELECT unit, t // {120 * HOUR} AS part, count(*) AS n FROM spikes GROUP BY 1, 2")
def _e17(spark, sf):
    """Rows of each output of a split by channel and long segment (written by sinks.save_subset)."""
    return spikes(spark, sf).groupBy("unit", F.expr(f"t div {120 * HOUR}").alias("part")).agg(F.count("*").alias("n"))
