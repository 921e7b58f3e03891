"""Benchmark decontamination with a document-partitioned positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.session import written

#: A shard of the index holds whole documents of about so many words.
SHARD_WORDS = 2_000_000
#: Test texts are sent to the tasks in blocks of at most so many bytes.
BLOCK_BYTES = 4 << 20
#: A test item's text is cut into pieces of so many words (and the next window's overlap).
PIECE_WORDS = 4096
#: Distinct test terms of at most so many bytes thin the index; beyond that it holds every word.
TERM_BYTES = 16 << 20
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _pack(positions: np.ndarray) -> tuple[int, bytes]:
    gaps = np.diff(positions, prepend=0)
    kind = next(k for k in ("<u1", "<u2", "<u4") if gaps.max() <= np.iinfo(k).max)
    return int(kind[-1]), gaps.astype(kind).tobytes()


def _unpack(width: int, packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, f"<u{width}"), dtype=np.int64)


class Phrases:
    """The windows of a block of pieces of test items, as term numbers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.terms: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, piece in items:
            ids = tuple(self.terms.setdefault(w, len(self.terms)) for w in piece.split(b" "))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(ids[i : i + window], set()).add(item)
        self.windows = list(found.items())


def index(docs: DataFrame, gap: int, terms: list[bytes] | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The postings of terms (None: of every word): (shard, term, width, postings), and a directory row (term null) for each shard.

    docs: (key, text). A shard is a run of whole documents laid end to end with gap
    empty positions between them. The directory has each document's key, number of
    words and place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        fixed = None if terms is None else {t: i for i, t in enumerate(terms)}

        def fresh() -> tuple[dict[bytes, int], list]:
            return {} if fixed is None else fixed, [[], [], [], [], 0]  # keys, lengths, places, arrays of (position, term), next place

        def flush(number: dict[bytes, int], state: list, key_type: pa.DataType) -> pa.RecordBatch:
            keys, lengths, places, hits, _ = state
            at = np.concatenate([h[0] for h in hits])
            term = np.concatenate([h[1] for h in hits])
            order = np.argsort(term, kind="stable")
            found, start = np.unique(term[order], return_index=True)
            lists = [_pack(x) for x in np.split(at[order], start[1:])] if len(found) else []
            names = list(number) if fixed is None else terms
            n = len(found) + 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + seq] * n, pa.int64()),
                    pa.array([None, *(names[t] for t in found)], pa.binary()),
                    pa.array([None, *(x[0] for x in lists)], pa.int32()),
                    pa.array([None, *(x[1] for x in lists)], pa.binary()),
                    pa.array([keys] + [None] * (n - 1), pa.list_(key_type)),
                    pa.array([lengths] + [None] * (n - 1), pa.list_(pa.int64())),
                    pa.array([places] + [None] * (n - 1), pa.list_(pa.int64())),
                ],
                ["shard", "term", "width", "postings", "keys", "lengths", "places"],
            )

        number, state = fresh()
        for batch in batches:
            key_type = batch.column(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ws = words(text.as_py())
                nums = np.fromiter((number.setdefault(w, len(number)) for w in ws) if fixed is None else (fixed.get(w, -1) for w in ws), np.int32, len(ws))
                at = np.flatnonzero(nums >= 0)
                state[0].append(key.as_py())
                state[1].append(len(ws))
                state[2].append(state[4])
                state[3].append((at + state[4], nums[at]))
                state[4] += len(ws) + gap
                if state[4] >= shard_words:
                    yield flush(number, state, key_type)
                    number, state = fresh()
                    seq += 1
        if state[0]:
            yield flush(number, state, key_type)

    schema = f"shard long, term binary, width int, postings binary, keys array<{docs.schema["key"].dataType.simpleString()}>, lengths array<long>, places array<long>"
    return docs.mapInArrow(run, schema)


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    return (at < len(ordered)) & (ordered[np.minimum(at, len(ordered) - 1)] == values)


def exact_starts(phrase: tuple, lists: dict[int, np.ndarray]) -> np.ndarray:
    """Starts of phrase: offset-adjusted lists intersected from the rarest term on."""
    order = sorted(range(len(phrase)), key=lambda k: len(lists[phrase[k]]))
    starts = lists[phrase[order[0]]] - order[0]
    for k in order[1:]:
        if not len(starts):
            break
        starts = starts[_is_in(starts + k, lists[phrase[k]])]
    return starts


def near_spans(phrase: tuple, lists: dict[int, np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) where the terms follow in order with at most slop other words between them, each next term taken as early as it comes."""
    starts = at = lists[phrase[0]]
    for term in phrase[1:]:
        nxt = np.searchsorted(lists[term], at, side="right")
        ok = nxt < len(lists[term])
        starts, at = starts[ok], lists[term][nxt[ok]]
        ok = at - starts < len(phrase) + slop
        starts, at = starts[ok], at[ok]
    return starts, at + 1


def search(postings: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """(shard, place, doc, items, hits): the items that each document has windows of, and the hit word places."""

    def run(table: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        names, lists, place, length = table.column("term").to_pylist(), {}, None, None
        for k, term in enumerate(names):
            if term is None:
                place = np.array(table.column("places")[k].as_py(), np.int64)
                length = np.array(table.column("lengths")[k].as_py(), np.int64)
            elif (t := phrases.terms.get(term)) is not None:
                lists[t] = _unpack(table.column("width")[k].as_py(), table.column("postings")[k].as_py())
        hits: dict[int, tuple[set, list]] = {}
        for phrase, items in phrases.windows:
            if any(t not in lists for t in phrase):
                continue
            if slop:
                starts, ends = near_spans(phrase, lists, slop)
            else:
                starts = exact_starts(phrase, lists)
                ends = starts + len(phrase)
            if not len(starts):
                continue
            doc = np.searchsorted(place, starts, side="right") - 1
            ok = ends <= place[doc] + length[doc]
            for d, s, e in zip(doc[ok].tolist(), starts[ok].tolist(), ends[ok].tolist(), strict=True):
                entry = hits.setdefault(d, (set(), []))
                entry[0].update(items)
                entry[1].append((s, e))
        for d, (items, spans) in sorted(hits.items()):
            mark = np.zeros(int(length[d]) + 1, np.int64)
            s = np.array(spans) - place[d]
            np.add.at(mark, s[:, 0], 1)
            np.add.at(mark, s[:, 1], -1)
            for col, x in zip(out, (table.column("shard")[0].as_py(), d, sorted(items), np.flatnonzero(np.cumsum(mark) > 0)), strict=True):
                col.append(x)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.int32()))], ["shard", "doc", "items", "hits"])

    return postings.groupBy("shard").applyInArrow(run, "shard long, doc int, items array<string>, hits array<int>")


def pieces_of(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, piece): the words of every test item, blank-joined, in pieces of PIECE_WORDS and window - 1 more; equal rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                ws = words(text.as_py())
                cut = [b" ".join(ws[k : k + PIECE_WORDS + window - 1]) for k in range(0, max(1, len(ws) - window + 1), PIECE_WORDS)] if ws else []
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(cut), pa.string()), pa.array(cut, pa.binary())], ["item", "piece"])

    picked = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("None")).alias("item"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(run, "item string, piece binary").distinct()


def blocks(pieces: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The pieces in blocks that were each measured to hold at most block_bytes (or one piece)."""
    size = F.octet_length("piece") + F.octet_length("item") + 16
    total, largest = pieces.agg(F.sum(size), F.max(size)).first()
    n = max(1, -(-(total or 0) // block_bytes))
    while True:
        number = F.pmod(F.xxhash64("item", "piece"), F.lit(n))
        sizes = {r.b: r.s for r in pieces.groupBy(number.alias("b")).agg(F.sum(size).alias("s")).collect()}
        if max(sizes.values(), default=0) <= max(block_bytes, largest or 0):
            return [pieces.where(number == k) for k in sorted(sizes)] or [pieces]
        n *= 2


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS, term_bytes: int = TERM_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, hits, contaminated), a row for each row of docs.

    A window is `window` consecutive words of a test item (a shorter item is one
    window; one without words has none). slop 0: exact phrases; more: the window's
    words in order with up to slop other words between. hits: the word places
    within any occurrence; items: the item ids found, as strings in order.

    The documents are read once, into one index of the test terms' postings in the
    shared folder (of every word, where the distinct test terms are beyond
    term_bytes), with window + slop + 1 empty positions between documents whatever
    the test items are. The test items are cut into pieces, the pieces into
    blocks of a measured size, and the index is searched block by block; hits meet
    by the index's own document places. A shard of documents intersects its own
    lists, so a word or passage that a third of the documents hold stays spread.

    Null texts have no words; null ids are kept, of any type; a null item id counts
    as "None"; repeated rows are judged one by one; a very long text is a shard of
    its own; other columns aren't read, whatever their names; an empty table gives
    an empty result and without test items nothing is hit.
    """
    tests = written(pieces_of(benchmark, item_col, item_text_col, window), "pieces")
    terms = tests.select(F.explode(F.split(F.col("piece").cast("string"), " ")).alias("term")).distinct()
    few = (terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0) <= term_bytes
    known = sorted(r.term.encode("utf-8", "surrogatepass") for r in terms.collect()) if few else None
    keyed = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").alias("text"))
    stored = written(index(keyed, window + slop + 1, known, shard_words), "postings")
    parts = blocks(tests, block_bytes)
    found = []
    for block in parts:
        hits = search(stored, Phrases([tuple(r) for r in block.collect()], window), slop)
        found.append(hits if len(parts) == 1 else written(hits, "hits"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    hits = hits.groupBy("shard", "doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"))
    directory = stored.where("term is null").select("shard", F.posexplode(F.arrays_zip("keys", "lengths")).alias("doc", "x")).select("shard", "doc", F.col("x.keys").alias("doc_id"), F.col("x.lengths").alias("n_words"))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    return directory.join(hits, ["shard", "doc"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits")).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        empty(F.col("items"), "array<string>").alias("items"),
        empty(F.col("hits"), "array<int>").alias("hits"),
        F.col("hits").isNotNull().alias("contaminated"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tests = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, tests).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.p = bw.p AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
