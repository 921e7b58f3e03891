"""Line dedup: content-defined chunks of lines, repeated multi-line chunks removed."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.session import written

#: A chunk ends after a line where the rolling hash of the last two lines leaves 0 modulo DIVISOR.
DIVISOR = 3
FACTOR = 31
#: A chunk can be removed if so many of its lines have more than white space.
MIN_LINES = 2


def chunks(text: str | None, divisor: int = DIVISOR) -> list[list[bytes]]:
    """The lines of text, in chunks: a border follows a line where FACTOR * h(line before) + h(line) leaves 0 modulo divisor; h: 48 bits of MD5."""
    if text is None:
        return []
    out, now, before = [], [], None
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        h = int.from_bytes(md5(line, usedforsecurity=False).digest()[:6], "big")
        now.append(line)
        if before is not None and (FACTOR * before + h) % divisor == 0:
            out.append(now)
            now = []
        before = h
    return out + [now] if now else out


def multi_line(chunk: list[bytes], min_lines: int) -> bool:
    return len(chunk) >= min_lines and sum(not x.isspace() and bool(x) for x in chunk) >= min_lines


def text_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart: id and text digest."""
    return F.struct(F.col(f"`{id_col}`").alias("id"), F.md5(F.col(f"`{text_col}`").cast("binary")).alias("text"))


def free_name(name: str, taken: list[str]) -> str:
    """name, behind as many underscores as keep it apart from the names taken."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, divisor: int, min_lines: int, whole: bool) -> DataFrame:
    """(id, text, place, hash) of every chunk that can be removed; text: the text's digest, hash: 128 bits. whole: and its bytes as `chunk`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column(2)):
                for place, chunk in enumerate(chunks(text.as_py(), divisor)):
                    if multi_line(chunk, min_lines):
                        raw = b"\n".join(chunk)
                        rows.append((i, place, xxhash.xxh3_128_digest(raw), raw if whole else None))
            at = pa.array([r[0] for r in rows], pa.int64())
            cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())]
            if whole:
                cols.append(pa.array([r[3] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, ["id", "text", "place", "hash", "chunk"][: len(cols)])

    keyed = docs.select(text_key(id_col, text_col).alias("k"), F.col(f"`{text_col}`").alias("body")).select("k.id", "k.text", "body")
    id_type = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {id_type}, text string, place int, hash binary" + ", chunk binary" * whole)


#: Chunks found over HOT times, and over one in HOT_SHARE of all occurrences, are few enough to be broadcast.
HOT, HOT_SHARE = 10_000, 50_000


def repeated_places(docs: DataFrame, id_col: str, text_col: str, divisor: int, min_lines: int) -> DataFrame:
    """(id, text, place) of the chunks whose bytes occur earlier.

    Bytes meet in an aggregate over (hash, bytes), which Spark starts within each
    task, so a chunk that stands everywhere is sent once by a task; only its count
    and first place come out. Occurrences without bytes, written once, are then held
    against these firsts: the HOT_SHARE commonest at most by broadcast, the others
    by a join. Chunks of one hash but different bytes (none is known for 128 bits)
    stay.
    """
    small = written(chunk_rows(docs, id_col, text_col, divisor, min_lines, whole=False), "chunks")
    place = F.struct("id", "text", "place")
    by_bytes = chunk_rows(docs, id_col, text_col, divisor, min_lines, whole=True).groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    by_hash = by_bytes.groupBy("hash").agg(F.min("first").alias("first"), F.max("n").alias("n"), F.count("*").alias("kinds"))
    firsts = written(by_hash.where("n > 1 and kinds = 1").select("hash", "first", "n"), "firsts")
    often = max(HOT, small.count() // HOT_SHARE)
    hot = F.broadcast(firsts.where(F.col("n") > often).select("hash", "first"))
    cold = small.join(hot, "hash", "left_anti").join(firsts.where(F.col("n") <= often).select("hash", "first"), "hash")
    return cold.unionByName(small.join(hot, "hash")).where(~place.eqNullSafe(F.col("first"))).select("id", "text", "place")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """docs, same columns, text without the multi-line chunks that occur earlier; and n_lines, n_removed_lines, n_removed_chunks.

    Every text is cut at line ends (\\n) into chunks whose borders depend on the two
    lines before them only, so equal passages are cut alike wherever they stand. Of
    equal chunks with min_lines or more lines with words, over the whole table, the
    first stays: smallest id, then text digest, then place.

    Ids may be of any type that sorts. Null texts stay null and have no lines; empty
    texts have one empty line; null ids come first; rows equal in id and text count
    as one and keep the same lines; a very long text is handled whole, in one task;
    an empty table gives an empty result. A counter whose name docs has already gets
    an underscore before it; other columns stay as they are, whatever their names.
    """
    gone = repeated_places(docs, id_col, text_col, divisor, min_lines).groupBy(F.struct("id", "text").alias("k")).agg(F.collect_set("place").alias("gone"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_key(id_col, text_col).alias("key"))
    joined = rows.join(gone, F.col("key").eqNullSafe(F.col("k")), "left")

    @F.pandas_udf("text string, n_lines long, n_removed_lines long, n_removed_chunks long")
    def cut(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
        out = []
        for t, g in zip(text, gone, strict=True):
            lost = set() if g is None else set(g)
            cs = chunks(t, divisor)
            kept = [c for k, c in enumerate(cs) if k not in lost]
            n, left = sum(map(len, cs)), sum(map(len, kept))
            out.append((None if t is None else t if not lost else b"\n".join(x for c in kept for x in c).decode("utf-8", "surrogatepass"), n, n - left, len(lost)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed_lines", "n_removed_chunks"])

    done = joined.select("row", cut(F.col("row").getField(text_col), F.col("gone")).alias("cut"))
    same = [(F.col("cut.text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return done.select(*same, *(F.col(f"cut.{c}").alias(free_name(c, docs.columns)) for c in ("n_lines", "n_removed_lines", "n_removed_chunks")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
h AS (SELECT *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 12))::BIGINT) AS h FROM d),
e AS (SELECT doc_id, text, l, list_filter(range(1, len(l) + 1), lambda i: i = len(l) OR (i > 1 AND (h[i - 1] * 31 + h[i]) % 3 = 0)) AS ends FROM h),
k AS (SELECT doc_id, text, l, ends, unnest(range(1, len(ends) + 1)) AS place FROM e),
c AS (SELECT doc_id, text, place, l[(CASE WHEN place = 1 THEN 0 ELSE ends[place - 1] END) + 1:ends[place]] AS chunk FROM k),
r AS (
  SELECT *, len(list_filter(chunk, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) >= 2
    AND row_number() OVER (PARTITION BY array_to_string(chunk, chr(10)) ORDER BY doc_id, place) > 1 AS gone FROM c
)
SELECT doc_id, sum(len(chunk))::BIGINT AS n_lines, coalesce(sum(len(chunk)) FILTER (gone), 0)::BIGINT AS n_removed_lines,
       count(*) FILTER (gone) AS n_removed_chunks,
       sha256(coalesce(string_agg(array_to_string(chunk, chr(10)), chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
