"""Vector code compression: product codes by Lloyd rounds in whole numbers, with norm-of-sum bounds before exact rescans."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.session import remove, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: A vector keeps one lower bound for each of so many runs of codebook entries.
GROUPS = 16
#: A table of so many labels at most is sent to every task; beyond it only labels of over LARGE rows, and over one row in LARGE_SHARE of all.
BROADCAST_LABELS, LARGE, LARGE_SHARE = 200_000, 10_000, 50_000
_FAR = np.iinfo(np.int64).max


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows: in doubles where these hold them, else in long integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if x.shape[1] * (2 * most) ** 2 < 1 << 52 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _lowered(d2: np.ndarray) -> np.ndarray:
    """Square roots rounded towards zero to single precision."""
    return np.maximum(np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


class Bounds:
    """What is known of one part of a batch of vectors.

    code: the entry assigned; near: its exact squared distance in round near_at;
    low: for each group of entries, less than the distance in round low_at to all
    of its entries but the assigned one.
    """

    def __init__(self, code: np.ndarray, near: np.ndarray, near_at: np.ndarray, low: np.ndarray, low_at: np.ndarray):
        self.code, self.near, self.near_at, self.low, self.low_at = code, near, near_at, low, low_at


def starts_of(entries: int, groups: int) -> np.ndarray:
    return np.unique(np.arange(groups) * entries // groups)


def scanned(x: np.ndarray, book: np.ndarray, groups: int, now: int) -> Bounds:
    """All distances of round `now`; ties go to the lower entry."""
    d2, rows = squared(x, book), np.arange(len(x))
    code = d2.argmin(1)
    near = d2[rows, code]
    d2[rows, code] = _FAR
    low = _lowered(np.minimum.reduceat(d2, starts_of(len(book), groups), axis=1))
    return Bounds(code, near, np.full(len(x), now), low, np.full(low.shape, now))


def rescanned(x: np.ndarray, books: list[np.ndarray], known: Bounds, groups: int) -> tuple[Bounds, int]:
    """The assignment to the last of books, and how many distances it took.

    books are the part's codebooks of all rounds so far. A bound of round t holds
    now after the net displacement of entries from round t to now: the norm of the
    sum of their moves, not the sum of the moves' norms. Vectors whose upper bound
    is below all lower bounds stay; of the others the assigned entry is measured
    first, then the groups that may still hold a nearer entry.
    """
    book, now = books[-1], len(books) - 1
    starts = starts_of(len(book), groups)
    ends = [*starts[1:], len(book)]
    moved = np.stack([np.sqrt(((book - old).astype(np.float64) ** 2).sum(1)) for old in books])
    most = np.maximum.reduceat(moved, starts, axis=1)
    code, near, near_at = known.code.copy(), known.near.copy(), known.near_at.copy()
    reach = known.low - most[known.low_at, np.arange(len(starts))] - 1e-3
    up = np.sqrt(near.astype(np.float64)) + moved[near_at, code]
    loose = np.flatnonzero((reach <= up[:, None]).any(1))
    difference = (x[loose] - book[code[loose]]).astype(np.int64)
    near[loose], near_at[loose] = (difference * difference).sum(1), now
    taken = len(loose)
    up[loose] = np.sqrt(near[loose].astype(np.float64))
    todo = np.zeros(reach.shape, bool)
    todo[loose] = reach[loose] <= up[loose, None]
    first = np.full(reach.shape, _FAR)
    first_code, second = np.zeros(reach.shape, np.int64), first.copy()
    best, best_code = near.copy(), code.copy()
    for g, (a, b) in enumerate(zip(starts, ends, strict=True)):
        rows = np.flatnonzero(todo[:, g])
        if not len(rows):
            continue
        d2 = squared(x[rows], book[a:b])
        taken += d2.size
        at = d2.argmin(1)
        m = d2[np.arange(len(rows)), at]
        d2[np.arange(len(rows)), at] = _FAR
        first[rows, g], first_code[rows, g], second[rows, g] = m, a + at, d2.min(1)
        better = (m < best[rows]) | ((m == best[rows]) & (a + at < best_code[rows]))
        best[rows[better]], best_code[rows[better]] = m[better], (a + at)[better]
    low, low_at = known.low.copy(), known.low_at.copy()
    low[todo] = _lowered(np.where(first_code == best_code[:, None], second, first)[todo])
    low_at[todo] = now
    changed = np.flatnonzero(best_code != code)
    group = np.searchsorted(starts, code[changed], side="right") - 1
    left = ~todo[changed, group]
    rows, group = changed[left], group[left]
    low[rows, group] = np.minimum(np.maximum(reach[rows, group], 0).astype(np.float32), _lowered(near[rows]))
    low_at[rows, group] = now
    return Bounds(best_code, best, near_at, low, low_at), taken


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.reshape(-1), kind))


def _bytes(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values, np.uint8))])


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width).astype(np.int64)


STATE = "code binary, near array<long>, near_at binary, low array<float>, low_at binary"


def assigned(state: DataFrame, books: list[np.ndarray], groups: int) -> DataFrame:
    """state with the assignment to the last of books, an array (part, entry, place in part) each; a state without bounds is scanned in full."""
    parts, entries, width = books[-1].shape
    n_groups, now, fresh = len(starts_of(entries, groups)), len(books) - 1, "code" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(b)
            x = _rows(b.column(2), parts * width).reshape(n, parts, width).astype(np.int64)
            done = []
            if not fresh:
                code, near, near_at = _unpacked(b.column(3), parts), _rows(b.column(4), parts), _unpacked(b.column(5), parts)
                low, low_at = _rows(b.column(6), parts * n_groups).reshape(n, parts, n_groups), _unpacked(b.column(7), parts * n_groups).reshape(n, parts, n_groups)
            for p in range(parts):
                if fresh:
                    done.append(scanned(x[:, p], books[-1][p], groups, now))
                else:
                    known = Bounds(code[:, p], near[:, p], near_at[:, p], low[:, p], low_at[:, p])
                    done.append(rescanned(x[:, p], [book[p] for book in books], known, groups)[0])
            joined = lambda name: np.stack([getattr(d, name) for d in done], 1).reshape(n, -1)
            cols = [b.column(0), b.column(1), b.column(2), _bytes(joined("code")), _list(joined("near"), pa.int64()), _bytes(joined("near_at")), _list(joined("low"), pa.float32()), _bytes(joined("low_at"))]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "v", "code", "near", "near_at", "low", "low_at"])

    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, v array<long>, {STATE}")


def replaced(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook of floored means of the parts assigned to each entry; unused entries stay.

    Each task sums its own rows first, so a row for each entry and task at most is
    shuffled and one number for each component comes to the driver.
    """
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            x = _rows(b.column(0), parts * width).reshape(len(b), parts, width).astype(np.int64)
            code = _unpacked(b.column(1), parts)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, begun = np.unique(code[order, p], return_index=True)
                if len(used):
                    sums[p, used, :width] += np.add.reduceat(x[order, p], begun, axis=0)
                    sums[p, used, width] += np.diff([*begun, len(order)])
        p, e = np.nonzero(sums[:, :, width])
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), _list(sums[p, e], pa.int64())], ["part", "entry", "sums"])

    by_task = state.select("v", "code").mapInArrow(run, "part int, entry int, sums array<long>")
    total = by_task.select("part", "entry", F.posexplode("sums").alias("k", "x")).groupBy("part", "entry", "k").agg(F.sum("x").alias("x"))
    sums = np.zeros((parts, entries, width + 1), np.int64)
    for r in total.collect():
        sums[r.part, r.entry, r.k] = r.x
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), book)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v): the rows whose vector is complete and finite, components as floor(scale * x)."""
    x = F.col(f"`{vector_col}`")
    fine = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y.cast("double")) & (F.abs(y.cast("double")) < float("inf")))
    kept = vectors.where(x.isNotNull() & fine)
    return kept.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.transform(x, lambda y: F.floor(y.cast("double") * scale)).alias("w"))


def _checked(parts: int, size: int, limit: int) -> Column:
    """w, or an error for a vector of another length or with components beyond limit."""
    wrong = F.raise_error(F.concat(F.lit(f"vectors must have {size} components, each within {limit} after scaling; one has "), F.size("w"))).cast("array<long>")
    good = (F.size("w") == size) & F.forall("w", lambda y: F.abs(y) <= limit)
    return F.when(good, F.transform("w", lambda y: y.cast("long"))).otherwise(wrong).alias("v")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error, the errors of its label's rows together; null labels are one. No label goes through one task."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")).withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums.drop("n")), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    sums = written(sums, "label_errors")
    most = max(LARGE, coded.count() // LARGE_SHARE)
    same = F.col("label").eqNullSafe(F.col("of"))
    large, small = F.broadcast(sums.where(F.col("n") > most).drop("n")), sums.where(F.col("n") <= most).drop("n")
    rest = coded.join(large, same, "left_anti")
    return coded.join(large, same).unionByName(rest.join(small, same)).drop("of")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, groups: int = GROUPS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) for each kept row, and the codebooks (part, entry, place in part).

    code: a byte for each of `parts` consecutive parts of the vector, the entry
    nearest to it (squared distance of whole numbers, ties to the lower entry);
    error: these distances together. Codebooks start as the parts of the `entries`
    smallest rows by (vec_id, vector), nulls last, and are replaced by floored means
    in each of `rounds` rounds. The codebooks of all rounds, at most entries *
    components * (rounds + 1) numbers, are what the driver holds; vectors and their
    bounds are written once a round and the round before is removed.

    Rows whose vector is null or holds null or non-finite components are dropped.
    Vectors must be of one length, a multiple of parts, and their scaled components
    within 2^29 / sqrt(length of a part); others raise an error. Null and
    repeated ids and labels stay as rows; with fewer rows than entries there are
    fewer entries; an empty table gives an empty result; other columns aren't read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of one byte holds 1 to 256 entries")
    rows = whole_numbers(vectors, id_col, vector_col, label_col, scale)
    seeds = [r.w for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "w").limit(entries).select("w").collect()]
    size = len(seeds[0]) if seeds else parts
    if size % parts or not size:
        raise ValueError(f"vectors of {size} components can't be cut into {parts} equal parts")
    limit = isqrt((1 << 60) // (size // parts)) // 2
    state = rows.select("vec_id", "label", _checked(parts, size, limit))
    if not seeds:
        empty = state.where("false")
        return empty.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), np.zeros((parts, 0, 1), np.int64)
    if any(len(s) != size or max(map(abs, s)) > limit for s in seeds):
        raise ValueError(f"vectors must have {size} components, each within {limit} after scaling")
    books = [np.array(seeds, np.int64).reshape(len(seeds), parts, size // parts).transpose(1, 0, 2)]
    before = None
    for r in range(rounds + 1):
        state = written(assigned(state, books, groups), f"codes{r}")
        if before is not None:
            remove(before)
        before = state
        if r < rounds:
            books.append(replaced(state, books[-1]))
    # near is exact for the last codebook only where it was measured in the last round
    coded = final_errors(state, books[-1])
    return with_label_errors(coded), books[-1]


def final_errors(state: DataFrame, book: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of the assignment in state to book."""
    parts, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b.column(2), parts * width).reshape(len(b), parts, width).astype(np.int64)
            code = _unpacked(b.column(3), parts)
            difference = x - np.stack([book[p, code[:, p]] for p in range(parts)], 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array((difference * difference).sum((1, 2)), pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.select("vec_id", "label", "v", "code").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")


def codebooks_digest(book: np.ndarray) -> str:
    return sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256"))


def _rounds_sql(rounds: int) -> str:
    out = []
    for r in range(rounds + 1):
        out.append(
            f"a{r} AS (SELECT x.i, x.p, min((xx - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT * 256 + j) AS m FROM x JOIN c{r} ON x.p = c{r}.p GROUP BY x.i, x.p)"
        )
        if r < rounds:
            out.append(
                f"n{r} AS (SELECT p, j, list(y ORDER BY k) AS c FROM (SELECT x.p, m % 256 AS j, k, floor(sum(x[k]) / count(*)) AS y FROM x JOIN a{r} ON x.i = a{r}.i AND x.p = a{r}.p, range(1, 17) t(k) GROUP BY ALL) GROUP BY p, j)"
            )
            out.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.p, c{r}.j, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} ON c{r}.p = n{r}.p AND c{r}.j = n{r}.j)")
    return ",\n".join(out)


OP12_SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i, vec_id, label, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), x AS MATERIALIZED (SELECT i, p, v[p * 16 + 1:p * 16 + 16] AS x, list_dot_product(v[p * 16 + 1:p * 16 + 16], v[p * 16 + 1:p * 16 + 16]) AS xx FROM k, range(4) t(p)),
c0 AS (SELECT p, i AS j, x AS c FROM x WHERE i < 256),
{_rounds_sql(ROUNDS)},
e AS (SELECT i, sum(m // 256)::BIGINT AS error, string_agg(printf('%02x', (m % 256)::INT), '' ORDER BY p) AS code FROM a{ROUNDS} GROUP BY i),
h AS (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, j, k)) AS codebooks_sha256 FROM (SELECT p, j, k, c[k] AS y FROM c{ROUNDS}, range(1, 17) t(k)))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN e USING (i), h
"""
