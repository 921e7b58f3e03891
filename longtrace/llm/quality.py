"""Quality classifier: a factorisation machine over hashed words, text structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.llm.lines import free_name

#: Hashed words have 2 ** WORD_BITS places; structure and metadata places follow.
WORD_BITS = 15
#: Each structure statistic falls into one of so many steps, by its fixed edges.
EDGES = {
    "words": [1, 5, 20, 50, 100, 300, 1000, 3000],
    "word_length": [2, 3, 4, 5, 6, 7, 8, 10],
    "upper": [0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7, 0.9],
    "symbols": [0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4],
    "digits": [0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.6],
    "distinct": [0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9],
    "repeats": [0.001, 0.01, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8],
    "short_words": [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.45, 0.7],
    "line_length": [10, 20, 40, 80, 160, 320, 640, 1280],
    "double_lines": [0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
    "double_triples": [0.001, 0.01, 0.03, 0.07, 0.15, 0.3, 0.5, 0.8],
    "listed_chars": [1, 30, 100, 300, 1000, 3000, 10000, 30000],  # metadata: the table's own character count
}
STEPS = 9
PLACES = (1 << WORD_BITS) + STEPS * len(EDGES)
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?")
_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"


def _share(raw: bytes, chars: bytes) -> float:
    return (len(raw) - len(raw.translate(None, chars))) / max(1, len(raw))


def features(text: str | None, listed: int | None, cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one text, in order of place. cache: word -> place, kept between calls."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    if len(cache) > 1 << 20:
        cache.clear()
    ids = np.empty(n, np.int64)
    for i, w in enumerate(words):
        if (p := cache.get(w)) is None:
            p = cache[w] = crc32(w) & ((1 << WORD_BITS) - 1)
        ids[i] = p
    place, count = np.unique(ids, return_counts=True)
    value = 1 + np.log(count) if n else count.astype(float)
    value = value / max(1e-9, np.sqrt((value**2).sum()))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = (ids[:-2] << 2 * WORD_BITS) | (ids[1:-1] << WORD_BITS) | ids[2:] if n > 2 else ids[:0]
    stats = [
        n,
        sum(map(len, words)) / max(1, n),
        _share(raw, _UPPER),
        _share(raw, _SYMBOLS),
        _share(raw, _DIGITS),
        len(place) / max(1, n),
        float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0,
        sum(len(w) < 3 for w in words) / max(1, n),
        sum(map(len, lines)) / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(np.unique(triples)) / max(1, len(triples)),
        listed or 0,
    ]
    dense = (1 << WORD_BITS) + np.array([STEPS * k + int(np.searchsorted(e, x, side="right")) for k, (e, x) in enumerate(zip(EDGES.values(), stats, strict=True))])
    return np.concatenate([place, dense]), np.concatenate([value, np.full(len(dense), 0.5)])


@dataclass
class Machine:
    """score = 1 / (1 + exp(-(bias + w.x + sum over pairs of <v_i, v_j> x_i x_j)))."""

    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, place: np.ndarray, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of many texts laid end to end; all pairs in linear time: (sum)^2 - sum of squares."""
        xv = self.v[place] * value[:, None]
        total = np.add.reduceat(xv, start)
        return self.bias + np.add.reduceat(self.w[place] * value, start) + 0.5 * ((total**2).sum(1) - np.add.reduceat((xv**2).sum(1), start))

    def score(self, place: np.ndarray, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(place, value, start), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rank: int = 8, epochs: int = 12, batch: int = 128, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Log-loss fit by adaptive gradient steps; no rows or one label only: the label's smoothed rate for all."""
    rnd = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows], float)
    good = (y.sum() + 1) / (len(y) + 2)
    m = Machine(float(np.log(good / (1 - good))), np.zeros(PLACES), rnd.normal(0, 0.05, (PLACES, rank)))
    if not len(y) or y.min() == y.max():
        m.v[:] = 0
        return m
    g_b, g_w, g_v = 1e-6, np.full(PLACES, 1e-6), np.full((PLACES, rank), 1e-6)
    for epoch in range(epochs):
        step = rate / (1 + 0.3 * epoch)
        order = rnd.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            size = [len(r[0]) for r in part]
            place, value, start = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part]), np.cumsum([0, *size[:-1]])
            err = m.score(place, value, start) - y[order[at : at + batch]]
            e = np.repeat(err, size)
            xv = m.v[place] * value[:, None]
            total = np.repeat(np.add.reduceat(xv, start), size, axis=0)
            used, back = np.unique(place, return_inverse=True)
            d_w, d_v = np.zeros(len(used)), np.zeros((len(used), m.v.shape[1]))
            np.add.at(d_w, back, e * value / len(part))
            np.add.at(d_v, back, (e * value / len(part))[:, None] * (total - xv))
            d_w += decay * m.w[used]
            d_v += decay * m.v[used]
            g_w[used] += d_w**2
            g_v[used] += d_v**2
            g_b += err.mean() ** 2
            m.w[used] -= step * d_w / np.sqrt(g_w[used])
            m.v[used] -= step * d_v / np.sqrt(g_v[used])
            m.bias -= step * err.mean() / np.sqrt(g_b)
    return m


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for judging: crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", size_col: str = "n_chars", max_rows: int = 12_000, max_bytes: int = 256 << 20) -> Machine:
    """Fit on the labelled rows that are not held out.

    max_rows and max_bytes bound the fit: with more labelled rows, or more bytes of
    features (each text's are bounded from its length), those are used whose id's
    hash falls below the matching share, so about that many. Only their features
    come to the driver. Rows with a null id or label teach nothing; repeated rows
    count as often as they come; without labelled rows, or with one label only, all
    get one score.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(~held_out("doc_id"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{size_col}`").cast("long").alias("size"))
    most = 8 * (F.least(F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1, F.lit(1 << WORD_BITS)) + len(EDGES))
    n, size = rows.select("doc_id", most.alias("most")).join(known, "doc_id").agg(F.count("*"), F.sum("most")).first()
    share = min(1.0, max_rows / max(n, 1), max_bytes / max(size or 0, 1))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        cache: dict[bytes, int] = {}
        for b in batches:
            for text, size, y in zip(*b.columns, strict=True):
                place, value = features(text.as_py(), size.as_py(), cache)
                yield pa.RecordBatch.from_arrays([pa.array([place.astype("<i4").tobytes()], pa.binary()), pa.array([value.astype("<f4").tobytes()], pa.binary()), pa.array([y.as_py()], pa.int32())], ["place", "value", "y"])

    found = rows.join(F.broadcast(known) if n <= 10 * max_rows else known, "doc_id").select("text", "size", "y").mapInArrow(run, "place binary, value binary, y int").toArrow()
    data = sorted(zip(*(found.column(c).to_pylist() for c in ("place", "value", "y")), strict=True))
    return fit([(np.frombuffer(p, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float), y) for p, v, y in data])


def scores(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, score), a row for each row of docs.

    Null, empty and wordless texts are scored by their structure alone, a null
    size_col as 0; a very long text is read whole; repeated rows and null ids stay;
    an empty table gives an empty result. If the id or a kept column is called
    score, this one is called _score.
    """
    names = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for b in batches:
            out = np.zeros(b.num_rows)
            for at in range(0, b.num_rows, 256):
                rows = [features(t.as_py(), s.as_py(), cache) for t, s in zip(b.column(0)[at : at + 256], b.column(1)[at : at + 256], strict=True)]
                start = np.cumsum([0, *(len(r[0]) for r in rows[:-1])])
                out[at : at + 256] = machine.score(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), start)
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(out)], [*b.schema.names[2:], "score"])

    picked = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{size_col}`").cast("long").alias("size"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[2:]) + ", score double"
    return picked.mapInArrow(run, schema).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)), F.col("score").alias(free_name("score", names)))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; learns from labels that are not held out, text and character count only."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return scores(docs, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
