"""Exact-substring dedup: difference-cover suffix sorting of the text that can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A bucket of the first or second shuffle is meant to hold what so many bytes of text give.
BUCKET_BYTES = 4 << 20
#: Suffixes of so many bytes of blocks are sorted at once, or of one minimiser's blocks.
SORT_BYTES = 1 << 20
#: Bytes of the grams whose hashes are minimised.
GRAM = 32
_RUN = np.dtype([("v", "<u8"), ("key", "<i8"), ("start", "<u4"), ("size", "<u2"), ("kind", "u1")])
_BLOCK = np.dtype([("v", "<u8"), ("key", "<i8"), ("doc", "<i8"), ("start", "<u4"), ("size", "<u2"), ("done", "u1"), ("bytes", "<u4")])
_MOST = np.iinfo(np.uint16).max


def _sliding(pick: np.ufunc, values: np.ndarray, need: int) -> np.ndarray:
    """pick over every need neighbours."""
    size = 1
    while 2 * size <= need:
        values, size = pick(values[:-size], values[size:]), 2 * size
    return pick(values[: len(values) - (need - size)], values[need - size :])


def window_minima(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of width bytes the least hash of the GRAM-byte strings in it: equal windows have equal minima. And the hashes."""
    with np.errstate(over="ignore"):
        h, factor, size = raw.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
        while size < GRAM:
            h, factor, size = h[:-size] * factor + h[size:], factor * factor, 2 * size
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
    return _sliding(np.minimum, h, width - GRAM + 1), h


def runs(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, first window, number of windows, whether the minimum occurs twice within width) of the maximal runs of windows with one minimum; runs over _MOST windows are cut."""
    low, h = window_minima(raw, width)
    need = len(h) - len(low) + 1
    edge = np.zeros(need - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, low, edge]), need) == h)
    near = (h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) < need)
    twice = np.unique(h[chosen[1:][near]])
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    size = np.diff(np.append(start, len(low)))
    if size.max() > _MOST:
        parts = -(-size // _MOST)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, size = np.repeat(start, parts) + k * _MOST, np.minimum(np.repeat(size, parts) - k * _MOST, _MOST)
    return low[start], start, size, np.isin(low[start], twice) if len(twice) else np.zeros(len(start), bool)


def _ranks(*columns: np.ndarray) -> np.ndarray:
    """Order-preserving names, from 1, of tuples of non-negative numbers."""
    key, span = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        most = int(c.max(initial=0)) + 1
        if span * most >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            span = int(key.max(initial=0)) + 1
        key, span = key * most + c, span * most
    return np.unique(key, return_inverse=True)[1] + 1


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix numbers of text (positive numbers) such that those with equal first `depth` items stand together, in order.

    Difference cover {1, 2} modulo 3: the triples at sampled suffixes are sorted and
    named, the string of names is solved in turn, the remaining suffixes are sorted
    by first item and the rank of the next, and both lists are merged. The
    recursion ends when names are all different or each stands for depth items.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    ones, twos = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    name = _ranks(s[sample], s[sample + 1], s[sample + 2])
    if name.max() == len(sample) or depth <= 3:
        order = np.argsort(name, kind="stable")
    else:  # a zero between the halves keeps their suffixes apart
        inner = np.concatenate([name[: len(ones)] + 1, [1], name[len(ones) :] + 1])
        order = suffix_order(inner, -(-depth // 3))
        order = order[order != len(ones)]
        order = np.where(order > len(ones), order - 1, order)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(s[rest] * (n + 3) + rank[rest + 1], kind="stable")]
    first = sample[order]
    m1, m2 = first[first % 3 == 1], first[first % 3 == 2]
    pair = lambda i: s[i] * (n + 3) + rank[i + 1]
    two = _ranks(np.concatenate([s[m2], s[rest]]), np.concatenate([s[m2 + 1], s[rest + 1]]), np.concatenate([rank[m2 + 2], rank[rest + 2]]))
    before = np.searchsorted(pair(m1), pair(rest)) + np.searchsorted(two[: len(m2)], two[len(m2) :])
    out = np.empty(n, np.int64)
    at = np.maximum.accumulate(before) + np.arange(len(rest))
    free = np.ones(n, bool)
    free[at] = False
    out[at], out[free] = rest, first
    return out


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    w = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        w = (w[:-size] << np.uint64(8 * size)) | w[size:]
    return w[: len(raw)]


def repeated_windows(raw: np.ndarray, place: np.ndarray, width: int, rank: np.ndarray) -> np.ndarray:
    """Which windows (starting at place in raw, all within it) equal one of smaller rank; raw holds blocks, each ended by a zero item after adding 1."""
    order = suffix_order(raw, width)
    at = np.full(len(raw), -1, np.int64)
    at[place] = np.arange(len(place))
    order = order[at[order] >= 0]
    word = _words((raw - 1).astype(np.uint8))
    left, right = order[:-1], order[1:]
    same = np.arange(len(left))
    for k in [*range(0, width - 7, 8), width - 8]:
        same = same[word[left[same] + k] == word[right[same] + k]]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    group = np.cumsum(new) - 1
    ranks = rank[at[order]]
    least = np.minimum.reduceat(ranks, np.flatnonzero(new)) if len(order) else ranks
    out = np.zeros(len(place), bool)
    out[at[order]] = ranks > least[group]
    return out


def _pairs_ranked(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of (doc, start), equal for equal pairs."""
    return _ranks(np.unique(doc, return_inverse=True)[1], start)


def _packed(spans: np.ndarray, **keys: np.ndarray) -> pa.Table:
    """(keys, spans): each key's rows of spans as bytes."""
    order = np.lexsort(list(keys.values()))
    keys, spans = {k: x[order] for k, x in keys.items()}, np.ascontiguousarray(spans[order])
    new = np.logical_or.reduce([np.concatenate([[True], x[1:] != x[:-1]]) for x in keys.values()]) if len(spans) else np.zeros(0, bool)
    cut = np.flatnonzero(new)
    return pa.table({**{k: pa.array(x[cut], pa.int64()) for k, x in keys.items()}, "spans": pa.array([x.tobytes() for x in np.split(spans, cut[1:])] if len(spans) else [], pa.binary())})


def candidates(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """(key, spans): runs of windows whose minimum another window of the table has too.

    docs: (key, text). A batch of documents sends each minimum once, whatever its
    number there; runs with a minimum that the batch itself repeats travel as known
    (kind 2; the one sent for all of them has kind 1).
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                if len(raw) >= width:
                    v, start, size, twice = runs(raw, width)
                    part = np.zeros(len(v), _RUN)
                    part["v"], part["key"], part["start"], part["size"], part["kind"] = v, key, start, size, twice
                    parts.append(part)
            if not parts:
                continue
            rows = np.concatenate(parts)
            _, first, back, count = np.unique(rows["v"], return_index=True, return_inverse=True, return_counts=True)
            np.maximum.at(count, back, 2 * rows["kind"])
            known = count[back] > 1
            one = rows[first].copy()
            one["kind"] = count > 1
            rows = rows[known]
            rows["kind"] = 2
            to = np.concatenate([one["v"] % np.uint64(buckets), rows["key"].view(np.uint64) % np.uint64(buckets)]).astype(np.int64)
            rows = np.concatenate([one, rows])
            order = np.argsort(to, kind="stable")
            to, rows = to[order], rows[order]
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            split = np.split(rows, cut[1:])
            yield pa.RecordBatch.from_arrays([pa.array(to[cut]), *(pa.array([np.ascontiguousarray(x[f]).tobytes() for x in split], pa.binary()) for f in _RUN.names)], ["bucket", *_RUN.names])

    def meet(table: pa.Table) -> pa.Table:
        col = {f: np.frombuffer(b"".join(table.column(f).to_pylist()), _RUN[f]) for f in _RUN.names}
        known = col["kind"] == 2
        one = np.flatnonzero(~known)
        _, back, count = np.unique(col["v"][one], return_inverse=True, return_counts=True)
        found = np.concatenate([np.flatnonzero(known), one[(count[back] > 1) & (col["kind"][one] == 0)]])
        spans = np.zeros(len(found), _SPAN)
        for f in _SPAN.names:
            spans[f] = col[f][found]
        return _packed(spans, key=col["key"][found])

    schema = "bucket long, " + ", ".join(f"{f} binary" for f in _RUN.names)
    return docs.mapInArrow(send, schema).groupBy("bucket").applyInArrow(meet, "key long, spans binary")


_SPAN = np.dtype([("v", "<u8"), ("start", "<u4"), ("size", "<u2")])
_GONE = np.dtype([("start", "<u4"), ("size", "<u4")])


def repeats(found: DataFrame, width: int, buckets: int) -> DataFrame:
    """(key, doc, spans): runs of windows that equal an earlier one.

    found: (key, doc, text, spans as a list of bytes). Rows of one key but different
    documents get each other's spans: bytes are compared, so these mark nothing wrong. Blocks (the bytes under a run)
    that a batch holds more than once are sent once, the earliest; the same is done
    where they meet. What is left is sorted by suffix_order and neighbours compared.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            meta, raws = [], []
            for key, doc, text, packs in zip(*(batch.column(k) for k in range(4)), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                spans = np.unique(np.frombuffer(b"".join(packs.as_py()), _SPAN))
                spans = spans[spans["start"] + spans["size"].astype(np.int64) + width - 1 <= len(raw)]
                part = np.zeros(len(spans), _BLOCK)
                for f in _SPAN.names:
                    part[f] = spans[f]
                part["key"], part["doc"] = key.as_py(), doc.as_py()
                meta.append(part)
                raws += [raw[a : a + n + width - 1] for a, n in zip(spans["start"].tolist(), spans["size"].tolist(), strict=True)]
            if not raws:
                continue
            rows = np.concatenate(meta)
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(r, len(number)) for r in raws), np.int64, len(raws))
            place = _pairs_ranked(rows["doc"], rows["start"])
            least = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(least, ids, place)
            first = np.full(len(number), len(raws))
            np.minimum.at(first, ids, np.where(place == least[ids], np.arange(len(raws)), len(raws)))
            rows["done"] = place > least[ids]
            rows["bytes"] = 0
            rows["bytes"][first] = [len(raws[i]) for i in first.tolist()]
            use = np.flatnonzero((rows["done"] == 1) | (rows["bytes"] > 0))
            to = np.where(rows["done"][use] == 1, rows["key"][use].view(np.uint64) % np.uint64(buckets), rows["v"][use] % np.uint64(buckets)).astype(np.int64)
            use = use[order := np.argsort(to, kind="stable")]
            to = to[order]
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            cols = [[], []]
            for part in np.split(use, cut[1:]):
                cols[0].append(rows[part].tobytes())
                cols[1].append(squeeze.compress(b"".join(raws[i] for i in part[rows["bytes"][part] > 0].tolist())))
            yield pa.RecordBatch.from_arrays([pa.array(to[cut]), *(pa.array(c, pa.binary()) for c in cols)], ["bucket", "meta", "raw"])

    def meet(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x, _BLOCK) for x in table.column("meta").to_pylist()])
        loose = zstandard.ZstdDecompressor()
        raw = b"".join(loose.decompress(x) for x in table.column("raw").to_pylist())
        done = rows["done"] == 1
        owners, spans = [rows[["key", "doc"]][done]], [_gone(rows["start"][done], rows["size"][done])]
        held = rows[~done]
        end = np.cumsum(held["bytes"], dtype=np.int64)
        order = np.argsort(held["v"], kind="stable")
        held, begin = held[order], (end - held["bytes"])[order]
        border = np.flatnonzero(np.concatenate([held["v"][1:] != held["v"][:-1], [True]])) + 1
        full = np.cumsum(held["bytes"].astype(np.int64))
        low = 0
        while low < len(held):
            base = full[low - 1] if low else 0
            k = max(np.searchsorted(full[border - 1], base + SORT_BYTES, side="right") - 1, np.searchsorted(border, low, side="right"))
            part = slice(low, int(border[k]))
            for x, y in _sorted_part(held[part], [raw[a : a + n] for a, n in zip(begin[part].tolist(), held["bytes"][part].tolist(), strict=True)], width):
                owners.append(x)
                spans.append(y)
            low = part.stop
        owner = np.concatenate(owners)
        return _packed(np.concatenate(spans), key=owner["key"], doc=owner["doc"])

    return found.mapInArrow(send, "bucket long, meta binary, raw binary").groupBy("bucket").applyInArrow(meet, "key long, doc long, spans binary")


def _gone(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), _GONE)
    out["start"], out["size"] = start, size
    return out


def _sorted_part(rows: np.ndarray, raws: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Repeated runs of whole groups of blocks: blocks equal to an earlier one, then windows by suffix order."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(r, len(number)) for r in raws), np.int64, len(raws))
    place = _pairs_ranked(rows["doc"], rows["start"])
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, ids, place)
    later = place > least[ids]
    yield rows[["key", "doc"]][later], _gone(rows["start"][later], rows["size"][later])
    kept = np.flatnonzero(~later)
    if not len(kept):
        return
    rows = rows[kept]
    size, windows = rows["bytes"].astype(np.int64), rows["size"].astype(np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(raws[i] for i in kept.tolist()) + b"\0", np.uint8).astype(np.int64) + 1
    row = np.repeat(np.arange(len(rows)), windows)
    step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = rows["start"][row] + step
    hit = np.flatnonzero(repeated_windows(text, begin[row] + step, width, _pairs_ranked(rows["doc"][row], start)))
    if len(hit):
        new = np.flatnonzero(np.concatenate([[True], (row[hit][1:] != row[hit][:-1]) | (np.diff(hit) != 1)]))
        yield rows[["key", "doc"]][row[hit[new]]], _gone(start[hit[new]], np.diff(np.append(new, len(hit))))


def without_substrings(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary), a row for each row of docs.

    A byte is removed if a string of width bytes that covers it also starts earlier:
    in a document of smaller id, or at an earlier place of the same document.
    Overlaps count, strings don't cross documents and are judged on the input.
    `kept` is what remains; it need not be valid UTF-8.

    Equal strings have equal gram minima, so only runs of windows whose minimum
    occurs elsewhere are looked at, and all strings that can be equal meet in one
    bucket; equal blocks are reduced to the earliest before and after they meet, so
    that many copies of a text cost one. In a bucket the suffixes of the blocks are
    sorted by the difference-cover algorithm, groups of minima by groups of minima,
    and neighbours with width equal bytes form a class whose earliest start stays.

    Documents are dealt by a hash of id and text once; both joins read that exchange,
    and a document takes spans of its own id only, so documents of one hash don't mix.

    Null and empty texts have no bytes; a null id comes after all others; rows of
    one id are ordered by start only, so equal rows don't remove each other; an
    empty table gives an empty result; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))
    owner = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    listed = lambda df, *cols: df.groupBy(F.col("key").alias("k")).agg(F.collect_list(*cols).alias("spans"))
    found = rows.join(listed(candidates(rows.select("key", "text"), width, buckets), "spans"), F.col("key") == F.col("k")).select("key", owner.alias("doc"), "text", "spans")
    gone = listed(repeats(found, width, buckets), F.struct("doc", "spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc, text, packs in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
                raw, doc = text.as_py().encode("utf-8", "surrogatepass"), doc.as_py()
                spans = np.frombuffer(b"".join(p["spans"] for p in packs.as_py() or [] if p["doc"] == doc), _GONE)
                mark = np.zeros(len(raw) + 1, np.int64)
                np.add.at(mark, spans["start"], 1)
                np.add.at(mark, spans["start"] + spans["size"] + np.uint32(width - 1), -1)
                off = np.cumsum(mark[:-1]) > 0
                kept = raw if not len(spans) else np.frombuffer(raw, np.uint8)[~off].tobytes()
                edges = int(off[:1].sum() + (off[1:] & ~off[:-1]).sum())
                for c, x in zip(out, (len(raw), int(off.sum()), edges, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(gone, F.col("key") == F.col("k"), "left").select("doc_id", owner.alias("doc"), "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
