"""SimHash near-duplicates: a binary-trie self-join of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.llm.components import components
from longtrace.session import written

#: Leaves are counted at this depth first, and STEP bits further below nodes that are too heavy.
TOP, STEP = 12, 4
#: Two trie nodes of at most so many leaves in all meet in one task; more only where the trie would have over 2 ** SHARE nodes.
UNIT_KEYS, SHARE = 1 << 13, 13
#: Frontier rows handled at once within a unit of work.
CHUNK = 1 << 19
#: Node pairs with at most so many leaf pairs are compared leaf by leaf.
BUCKET = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, block: int = 1 << 16) -> int:
    """64-bit SimHash of word shingles (A-Z lower-cased, words split at ASCII white space)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, total = iter([b" ".join(words)]), 1
    else:
        grams, total = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(seed))
    return majority((np.fromiter(hashes, np.uint64, min(block, total - start)) for start in range(0, total, block)), total)


def majority(blocks: Iterable[np.ndarray], total: int) -> int:
    """The bits set in over half of all `total` hashes, which come in blocks."""
    set_bits = np.zeros(64, np.int64)
    for h in blocks:
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long; a null or wordless text gets 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


@dataclass
class Trie:
    """The heavy upper part of the binary trie over all fingerprints: a leaf here is a node with few enough leaves below it."""

    depth: np.ndarray
    low: np.ndarray  # least key below the node
    child: np.ndarray  # number of the first of two children that stand together; -1: a leaf
    n: np.ndarray  # a node without keys has no pair

    def high(self, node: np.ndarray) -> np.ndarray:
        free = np.minimum(64 - self.depth[node], 63).astype(np.uint64)
        size = np.where(self.depth[node] == 0, ~np.uint64(0), (np.uint64(1) << free) - np.uint64(1))
        return self.low[node] + size


def upper_trie(cells: np.ndarray, half: int) -> Trie:
    """cells: rows (depth, least key, n) of nodes that hold all keys, disjoint, by key; nodes with over half keys are split as far as cells tell."""
    low, n = cells["low"], cells["n"].astype(float)
    below = np.concatenate([[0.0], np.cumsum(n)])
    depth, first, last, keys = (np.zeros(1, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    last[0] = len(cells)
    out: list[list[np.ndarray]] = [[], [], [], []]
    number = 0
    while len(depth):
        total = below[last] - below[first]
        split = (total > half) & ((last - first > 1) | (cells["depth"][np.minimum(first, len(cells) - 1)] > depth)) & (depth < 64)
        child = np.full(len(depth), -1, np.int64)
        child[split] = number + len(depth) + 2 * np.arange(split.sum())
        for col, x in zip(out, (depth, keys, child, total), strict=True):
            col.append(x)
        number += len(depth)
        middle = keys[split] | (np.uint64(1) << (63 - depth[split]).astype(np.uint64))
        at = np.searchsorted(low, middle)
        pair = lambda x, y: np.stack([x, y], 1).ravel()
        keys, first, last, depth = pair(keys[split], middle), pair(first[split], np.clip(at, first[split], last[split])), pair(np.clip(at, first[split], last[split]), last[split]), np.repeat(depth[split] + 1, 2)
    return Trie(*(np.concatenate(x) for x in out))


def unit_pairs(trie: Trie, max_bits: int) -> np.ndarray:
    """Walk the upper trie with itself from the root down: rows (node a, node b), both leaves of it.

    A pair is dropped once the prefixes that both have differ in more than max_bits
    bits or a side has no keys. A leaf waits while the other side goes down.
    """
    a = b = diff = np.zeros(1, np.int64)
    units = []
    while len(a):
        live = (trie.n[a] > 0) & (trie.n[b] > 0) & (diff <= max_bits)
        a, b, diff = a[live], b[live], diff[live]
        leaf_a, leaf_b = trie.child[a] < 0, trie.child[b] < 0
        done = leaf_a & leaf_b
        units.append(np.stack([a[done], b[done]], 1))
        both, one, two = ~leaf_a & ~leaf_b, ~leaf_a & leaf_b, leaf_a & ~leaf_b
        same = a == b
        parts = [(trie.child[a[both]] + i, trie.child[b[both]] + j, diff[both] + (i ^ j), ~(same[both] & (i > j))) for i in (0, 1) for j in (0, 1)]
        parts += [(trie.child[a[one]] + i, b[one], diff[one], np.ones(one.sum(), bool)) for i in (0, 1)]
        parts += [(a[two], trie.child[b[two]] + i, diff[two], np.ones(two.sum(), bool)) for i in (0, 1)]
        keep = np.concatenate([p[3] for p in parts])
        a, b, diff = (np.concatenate([p[k] for p in parts])[keep] for k in range(3))
    return np.concatenate(units)


def _roots(n: int, u: np.ndarray, v: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Least-index component labels of n nodes under links u-v, from labels start."""
    label = start
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while (new != (jump := new[new])).any():
            new = jump
        if (new == label).all():
            return label
        label = new


def _spread(lo_a, n_a, lo_b, n_b):
    """All index pairs of many small blocks, without a loop."""
    size = n_a * n_b
    k = np.repeat(np.arange(len(size)), size)
    r = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
    return lo_a[k] + r // n_b[k], lo_b[k] + r % n_b[k]


def trie_join(keys: np.ndarray, a: tuple[int, int], b: tuple[int, int], depth: int, max_bits: int) -> np.ndarray:
    """Least-index label of every key after linking keys of node a to keys of node b.

    keys: sorted distinct uint64; a, b: index ranges of two nodes, depth: that of
    the upper one.
    Node pairs are taken from a stack in chunks and split bit by bit; differing
    bits are summed and pairs beyond max_bits pruned. A pair whose keys already
    form one component is dropped, so a dense group costs no all-pairs output.
    """
    label = np.arange(len(keys))
    one = np.uint64(1)

    def halves(lo, hi, bit):
        head = (keys[lo] >> (bit + one)) << one
        return np.searchsorted(keys, (head | one) << bit).clip(lo, hi)

    diff0 = 0 if a == b else (int(keys[a[0]] >> np.uint64(64 - depth)) ^ int(keys[b[0]] >> np.uint64(64 - depth))).bit_count() if depth else 0
    stack = [(depth, np.array([[a[0], a[1], b[0], b[1], diff0]]))]
    while stack:
        d, front = stack.pop()
        if len(front) > CHUNK:
            stack.append((d, front[CHUNK:]))
            front = front[:CHUNK]
        lo_a, hi_a, lo_b, hi_b, diff = front.T
        n_a, n_b = hi_a - lo_a, hi_b - lo_b
        small = (n_a * n_b <= BUCKET) | (d == 64)
        if small.any():
            i, j = _spread(lo_a[small], n_a[small], lo_b[small], n_b[small])
            near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= max_bits)
            near &= label[i] != label[j]
            if near.any():
                label = _roots(len(keys), i[near], j[near], label)
        front = front[~small]
        if not len(front):
            continue
        edge = np.flatnonzero(np.diff(label))
        run = np.searchsorted(edge, front[:, [0, 2]])  # keys between two label changes have one label
        end = np.searchsorted(edge, front[:, [1, 3]] - 1)
        joined = (run == end).all(1) & (label[front[:, 0]] == label[front[:, 2]])
        front = front[~joined]
        if not len(front):
            continue
        bit = np.uint64(63 - d)
        lo_a, hi_a, lo_b, hi_b, diff = front.T
        mid_a, mid_b = halves(lo_a, hi_a, bit), halves(lo_b, hi_b, bit)
        same = (lo_a == lo_b) & (hi_a == hi_b)
        parts = []
        for x in (0, 1):
            for y in (0, 1):
                la, ha = (lo_a, mid_a) if x == 0 else (mid_a, hi_a)
                lb, hb = (lo_b, mid_b) if y == 0 else (mid_b, hi_b)
                ok = (la < ha) & (lb < hb) & (diff + (x ^ y) <= max_bits) & ~(same & (x > y))
                parts.append(np.stack([la, ha, lb, hb, diff + (x ^ y)], 1)[ok])
        stack.append((d + 1, np.concatenate(parts)))
    return label


_CELL = np.dtype([("depth", "<i8"), ("low", "<u8"), ("n", "<i8")])


def counted_cells(nodes: DataFrame, half_of: Callable[[int], int]) -> tuple[np.ndarray, int]:
    """Disjoint trie nodes with their leaf counts, none with over half_of(all leaves) unless it is one key; and that half.

    Counting goes STEP bits further below heavy nodes only, of which there are at
    most 2 ** (SHARE + 1) at any depth, whatever the table's size.
    """
    spark = nodes.sparkSession
    found, depth, half, heavy = [], TOP, 0, None
    while True:
        prefix = F.shiftrightunsigned("fp", 64 - depth)
        rows = nodes if heavy is None else nodes.join(F.broadcast(spark.createDataFrame([(x,) for x in heavy], "up long")), F.shiftrightunsigned("fp", 64 - depth + STEP) == F.col("up"), "left_semi")
        got = [(r.p, r.n) for r in rows.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")).collect()]
        if heavy is None:
            half = half_of(sum(n for _, n in got))
        full = [(p, n) for p, n in got if n > half and depth < 64]
        found += [(depth, (p % (1 << depth)) << (64 - depth), n) for p, n in got if n <= half or depth == 64]
        if not full:
            cells = np.array(found, _CELL)
            return cells[np.argsort(cells["low"])], half
        heavy, depth = [p for p, _ in full], depth + STEP


def links(nodes: DataFrame, max_bits: int = 2, unit_keys: int = UNIT_KEYS) -> DataFrame:
    """(u, v): a spanning set of the links between distinct fingerprints (signed longs) that differ in at most max_bits bits.

    nodes: one column fp, distinct, without nulls. Leaf counts of the upper trie
    (at most about 2 ** (SHARE + 1 + STEP) numbers a depth, however large the table;
    heavy prefixes are counted deeper) go to every task, which derives the same
    units of work once, as pairs of nodes. Fingerprints are sorted by range and
    sent, packed, with the bounds of their unit's nodes, so that a unit needs to
    know nothing of the others.
    """
    spark = nodes.sparkSession
    cells, half = counted_cells(nodes, lambda n: max(unit_keys, n >> SHARE) // 2)
    if cells["n"].sum() < 2:
        return spark.createDataFrame([], "u long, v long")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = upper_trie(cells, half)
        units = unit_pairs(trie, max_bits)
        leaves = np.unique(units)
        low, high = trie.low[leaves], trie.high(leaves)
        order = np.argsort(low)
        leaves, low, high = leaves[order], low[order], high[order]
        sides = [np.argsort(units[:, k], kind="stable") for k in (0, 1)]
        ordered = [units[s, k] for k, s in enumerate(sides)]
        for batch in batches:
            keys = np.sort(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            lo, hi = np.searchsorted(keys, low), np.searchsorted(keys, high, side="right")
            for leaf, i, j in zip(leaves[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                mine = np.unique(np.concatenate([s[np.searchsorted(o, leaf) : np.searchsorted(o, leaf, side="right")] for s, o in zip(sides, ordered, strict=True)]))
                packed = keys[i:j].tobytes()
                for k in range(0, len(mine), 4096):
                    part = mine[k : k + 4096]
                    a, b = units[part].T
                    cols = [pa.array(part), *(pa.array(x.astype(np.int64)) for x in (trie.depth[a], trie.depth[b], trie.low[a].view(np.int64), trie.low[b].view(np.int64))), pa.array([packed] * len(part), pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, ["unit", "depth_a", "depth_b", "low_a", "low_b", "keys"])

    def join(table: pa.Table) -> pa.Table:
        depth_a, depth_b, low_a, low_b = (table.column(c)[0].as_py() for c in ("depth_a", "depth_b", "low_a", "low_b"))
        keys = np.unique(np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64))
        ends = []
        for depth, low in ((depth_a, low_a % (1 << 64)), (depth_b, low_b % (1 << 64))):
            ends.append((int(np.searchsorted(keys, np.uint64(low))), int(np.searchsorted(keys, np.uint64(low + (1 << (64 - depth)) - 1), side="right"))))
        signed = keys.view(np.int64)
        if any(lo == hi for lo, hi in ends):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        label = trie_join(keys, ends[0], ends[1], min(depth_a, depth_b), max_bits)
        other = np.flatnonzero(label != np.arange(len(keys)))
        return pa.table({"u": pa.array(signed[other]), "v": pa.array(signed[label[other]])})

    sorted_keys = nodes.select("fp").repartitionByRange("fp").sortWithinPartitions("fp")
    sent = sorted_keys.mapInArrow(send, "unit long, depth_a long, depth_b long, low_a long, low_b long, keys binary")
    return sent.groupBy("unit").applyInArrow(join, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of docs.

    Fingerprints within max_bits bits are linked; component_id is the smallest
    doc_id reachable. Null, empty and wordless texts share fingerprint zero.
    A very long text is hashed in blocks of shingles. Repeated rows and ties stay
    as they are; a null doc_id keeps its row and is never a
    component's smallest id unless all are null (then component_id is null). An
    empty table gives an empty result. Other columns of docs, whatever their names,
    are not read.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    rooted = components(links(nodes.select("fp"), max_bits))
    member = nodes.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(member.join(smallest, "root").select(F.col("fp").alias("key"), "component_id"), "classes")
    return rows.join(classes, F.col("fp") == F.col("key")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
