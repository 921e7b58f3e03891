"""Near copies by exact Jaccard similarity of word shingles: SimHash fingerprints in a trie link first, MinHash bands propose what lies further apart."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtrace.llm import simhash
from longtrace.llm.components import components
from longtrace.session import written

#: Words of a shingle and least similarity of a near copy.
SHINGLE, SIMILARITY = 5, (4, 5)
#: Fingerprints of so many differing bits at most are linked by the trie.
BITS = 2
#: A pair of similarity s shares none of the bands with chance (1 - s ** ROWS) ** BANDS: 1.2e-7 at 0.8.
BANDS, ROWS = 40, 5
#: Documents of each band that all others of the band are compared with before any other pairs.
HUBS = 3
#: Bands of at most so many documents are compared as pairs; others in parts of about so many documents.
SMALL, PART = 16, 1024
#: Shingles permuted at once.
CHUNK = 1 << 12
_FACTORS, _SHIFTS = (np.random.default_rng(42).integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64) | np.uint64(1))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of word shingles (A-Z lower-cased, ASCII white space); a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    total = max(1, len(words) - size + 1)
    grams = (b" ".join(words[i : i + size]) for i in range(total))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, total))


def key_of(hashes: np.ndarray) -> int:
    """Signed digest of a shingle set; 0 for the empty set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64)) if len(hashes) else 0


def fingerprint(hashes: np.ndarray) -> int:
    """Signed SimHash of a shingle set; 0 for the empty set."""
    found = simhash.majority((hashes[k : k + CHUNK] for k in range(0, len(hashes), CHUNK)), len(hashes))
    return int(np.uint64(found).view(np.int64))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed long for each band of the set's MinHash signature; none for the empty set."""
    if not len(hashes):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        low = np.minimum(low, (hashes[None, start : start + CHUNK] * _FACTORS + _SHIFTS).min(axis=1))
    found = np.fromiter((xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(low.reshape(BANDS, ROWS))), np.uint64, BANDS)
    return found.view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of SIMILARITY or more, in whole numbers."""
    above, below = SIMILARITY
    if below * min(len(a), len(b)) < above * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return below * shared >= above * (len(both) - shared)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column(2)]
        made = [pa.array([of(s) for s in sets], kind) for of, kind in ((key_of, pa.int64()), (fingerprint, pa.int64()), (bands, pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "digest", "key", "fp", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([key_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "hashes"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hold = [similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
        yield batch.select(["u", "v"]).filter(pa.array(hold, pa.bool_()))


def sets_of(docs: DataFrame, nodes: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, hashes): the shingle sets of keys, made anew from one document of each of these keys alone."""
    ids = nodes.join(keys, "key", "left_semi").select("least.doc_id", "least.digest").distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("own"), F.col(f"`{text_col}`").alias("text"))
    same = F.col("own").eqNullSafe(F.col("doc_id")) & F.md5(F.col("text").cast("binary")).eqNullSafe(F.col("digest"))
    read = texts.join(ids, same, "left_semi").select("text").mapInArrow(_sets, "key long, hashes binary")
    return written(read.dropDuplicates(["key"]), "sets")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The (u, v) of pairs whose shingle sets are similar."""
    sets = sets_of(docs, nodes, pairs.select(F.col("u").alias("key")).union(pairs.select("v")).distinct(), id_col, text_col)
    both = pairs.join(sets.select(F.col("key").alias("u"), F.col("hashes").alias("a")), "u").join(sets.select(F.col("key").alias("v"), F.col("hashes").alias("b")), "v")
    return written(both.select("u", "v", "a", "b").mapInArrow(_verify, "u long, v long"), "similar")


def compare(keys: np.ndarray, roots: np.ndarray, home: np.ndarray, probe: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links from each probe to one similar home document of every other root."""
    at = np.flatnonzero(home)
    size = np.array([len(x) for x in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(size)
    held = number[np.repeat(home, size)]
    starts = np.cumsum(size[at]) - size[at]
    found, mark = [], np.zeros(number.max() + 1, np.int32)
    for i in np.flatnonzero(probe):
        own = number[ends[i] - size[i] : ends[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[held], starts)
        mark[own] = 0
        hit = at[(SIMILARITY[1] * shared >= SIMILARITY[0] * (size[i] + size[at] - shared)) & (roots[at] != roots[i])]
        found += [(int(keys[i]), int(keys[hit[k]])) for k in np.unique(roots[hit], return_index=True)[1]]
    return found


def _compare(table: pa.Table) -> pa.Table:
    keys, roots, home, probe = (table.column(c).to_numpy() for c in ("key", "root", "home", "probe"))
    found = compare(keys, roots, home.astype(bool), probe.astype(bool), [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")])
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def across(docs: DataFrame, nodes: DataFrame, placed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links within large bands between documents that are not of one root yet.

    The documents of a band's commonest root needn't meet each other; all others
    go to every part of the band, so a band's parts are compared apart.
    """
    parts = F.ceil(F.col("n") / PART).cast("int")
    own = F.pmod(F.xxhash64("key"), parts).cast("int")
    few = F.col("root") != F.col("top")
    rows = placed.where(F.col("n") > SMALL).select("band", "key", "root", few.alias("probe"), own.alias("own"), F.explode(F.when(few, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(own))).alias("part"))
    rows = written(rows.select("band", "part", "key", "root", "probe", (F.col("own") == F.col("part")).alias("home")), "parts")
    sets = sets_of(docs, nodes, rows.select("key").distinct(), id_col, text_col)
    met = rows.join(sets, "key").select("band", "part", "key", "root", "home", "probe", "hashes")
    return written(met.groupBy("band", "part").applyInArrow(_compare, "u long, v long"), "across")


def close_fingerprints(nodes: DataFrame) -> DataFrame:
    """(u, v): keys of equal fingerprints and of such that the trie links at BITS or fewer differing bits, enough to span them; the wordless key stays out."""
    worded = nodes.where("key <> 0").select("key", "fp")
    named = written(worded.groupBy("fp").agg(F.min("key").alias("name")), "fingerprints")
    equal = worded.join(named, "fp").where("key <> name").select("name", "key")
    of = lambda x: named.select(F.col("fp").alias(x), F.col("name").alias(f"key_{x}"))
    close = simhash.links(named.select("fp"), BITS).join(of("u"), "u").join(of("v"), "v").select("key_u", "key_v")
    return written(equal.union(close).toDF("a", "b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "close")


def links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Similar pairs (u, v) of keys enough to span the components of all similar pairs that share a band or lie BITS apart.

    Close fingerprints are linked first. All documents of a band are then compared with
    its HUBS documents, but for those that fingerprints have joined; then only those
    meet that these links leave in different components.
    """
    told = verified(docs, nodes, close_fingerprints(nodes), id_col, text_col)
    tied = nodes.join(components(told), F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("tied"), F.explode("bands").alias("band"))
    posts = written(tied, "posts")
    hubs = posts.groupBy("band").agg(*(F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("h"), "key", "tied")).alias(f"hub{i}") for i in range(HUBS)), F.count("*").alias("n")).where("n > 1")
    hubs = hubs.select("band", F.explode(F.array_distinct(F.array(*(F.struct(F.col(f"hub{i}.key").alias("key"), F.col(f"hub{i}.tied").alias("tied")) for i in range(HUBS))))).alias("hub"))
    star = posts.join(hubs, "band").where("tied <> hub.tied").select(F.least("key", "hub.key").alias("u"), F.greatest("key", "hub.key").alias("v"))
    star = written(star.distinct(), "star")
    near = written(told.union(verified(docs, nodes, star, id_col, text_col)), "near")
    placed = posts.join(components(near), F.col("key") == F.col("node"), "left").select("band", "key", F.coalesce("root", "key").alias("root"))
    roots = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    split = roots.groupBy("band").agg(F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1 and n > 2")
    left = written(placed.join(split.drop("roots"), "band"), "open")
    small = left.where(F.col("n") <= SMALL)
    cross = small.alias("x").join(small.alias("y"), "band").where("x.key < y.key and x.root <> y.root").select(F.col("x.key").alias("u"), F.col("y.key").alias("v")).distinct()
    more = verified(docs, nodes, written(cross.join(star, ["u", "v"], "left_anti"), "cross"), id_col, text_col)
    return near.union(more).union(across(docs, nodes, left, id_col, text_col))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, component_id, first), one row per row of docs: documents linked by similar shingle sets.

    digest: the text's MD5, null for a null text. component_id is the smallest
    doc_id reachable; first tells the rows with the smallest doc_id and then digest
    of their component. Null, empty and wordless texts are one component; a very
    long text is sketched in blocks of shingles. Repeated rows and ties stay; a null
    doc_id keeps its row and comes after all others, so component_id is null only
    where all are. An empty table gives an empty result; other columns aren't read.
    """
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.md5(F.col(f"`{text_col}`").cast("binary")).alias("digest"), F.col(f"`{text_col}`").alias("text"))
    rows = written(picked.mapInArrow(_sketch, "doc_id long, digest string, key long, fp long, bands array<long>"), "sketches")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    nodes = written(rows.groupBy("key").agg(F.min(place).alias("least"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "nodes")
    rooted = components(links(docs, nodes, id_col, text_col))
    member = nodes.join(rooted, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    smallest = member.groupBy("root").agg(F.min("least").alias("head"))
    classes = written(member.join(smallest, "root").select("key", "head"), "classes")
    return rows.join(classes, "key").select("doc_id", "digest", F.col("head.doc_id").alias("component_id"), place.eqNullSafe(F.col("head")).alias("first"))
