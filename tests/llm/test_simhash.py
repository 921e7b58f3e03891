import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from longtrace.llm import simhash
from longtrace.llm.components import components


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def slow_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_slow():
    for t in [None, "", " \n", "A b", "É É b C", "One two three", "a b c d e f a b c " * 30, "x y z\x1fw v"]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)
    assert simhash.fingerprint("a b c d e " * 50, block=7) == slow_fingerprint("a b c d e " * 50)


def test_trie_links_match_brute_force(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = {0, 2**64 - 1, 1, 3, 7}
    for b in base:
        for _ in range(30):
            x = b
            for _ in range(rnd.randrange(5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    want = [fps[i] for i in slow_components(fps)]
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for unit_keys in (1 << 13, 8):
        got = {r.node: r.root for r in components(simhash.links(nodes, 2, unit_keys)).collect()}
        groups = {}
        for x, w in zip(signed, want, strict=True):
            groups.setdefault(w, set()).add(got.get(x, x))
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)


def uniform_cells(n, top=12, hot=None):
    """Leaf counts as counted_cells gives them: n keys under each 12-bit prefix, and, if asked, `hot` under one 16-bit prefix."""
    rows = [(top, p << (64 - top), n) for p in range(1 << top) if hot is None or p != 5]
    if hot is not None:
        rows += [(30, (5 << 52) | (k << 34), hot >> 14) for k in range(1 << 14)]
    cells = np.array(rows, simhash._CELL)
    return cells[np.argsort(cells["low"])]


def units_of(cells, half):
    trie = simhash.upper_trie(cells, half)
    return trie, simhash.unit_pairs(trie, 2)


def test_units_stay_spread_at_any_size():
    """60,000 and 200,000 keys under each of 65,536 nodes: billions of fingerprints."""
    for leaf in (60_000, 200_000):
        total = leaf << 16
        cells = np.array([(16, p << 48, leaf) for p in range(1 << 16)], simhash._CELL)
        half = max(simhash.UNIT_KEYS, total >> simhash.SHARE) // 2
        trie, units = units_of(cells, half)
        assert 1 << 13 <= (trie.child < 0).sum() <= 1 << 15 and len(units) < 2_000_000
        assert trie.n[units].max() <= half


def test_a_hot_prefix_is_split_deeper():
    cells = uniform_cells(2_000, hot=1 << 26)
    trie, units = units_of(cells, 1 << 13)
    assert trie.n[units].max() <= 1 << 13
    inside = (trie.low[units] >> np.uint64(52)) == 5
    assert inside.all(1).sum() >= 1 << 13


def test_pruned_units_hold_all_close_pairs():
    rnd = random.Random(11)
    keys = sorted({rnd.getrandbits(64) for _ in range(300)} | {(0xABCD << 48) | rnd.getrandbits(20) for _ in range(300)})
    counts = {}
    for k in keys:
        depth = 30 if k >> 48 == 0xABCD else 12
        counts[depth, k >> (64 - depth) << (64 - depth)] = counts.get((depth, k >> (64 - depth) << (64 - depth)), 0) + 1
    cells = np.array([(d, low, n) for (d, low), n in counts.items()], simhash._CELL)
    trie, units = units_of(cells[np.argsort(cells["low"])], 8)
    leaf = {}
    for node in np.unique(units):
        for k in keys:
            if trie.low[node] <= np.uint64(k) <= trie.high(np.array([node]))[0]:
                leaf.setdefault(k, node)
    pairs = {tuple(sorted(u)) for u in units.tolist()}
    assert all(tuple(sorted((int(leaf[x]), int(leaf[y])))) in pairs for x in keys for y in keys if (x ^ y).bit_count() <= 2)


def test_edge_cases(spark):
    rows = [(5, None, "x"), (3, "", "x"), (9, "a b c d", "x"), (9, "a b c d", "y"), (None, "a b c d", "z"), (1, "word " * 20000, "q"), (None, "lonely text here now", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit(1))
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert len(got) == 7
    assert {(r[0], r[2]) for r in got} >= {(5, 3), (3, 3), (9, 9), (None, 9), (None, None), (1, 1)}
    assert {r[1] for r in got if r[0] in (5, 3)} == {"0" * 16}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [slow_fingerprint(t) for _, t in texts]
    want = {(d, f"{f:016x}", texts[c][0]) for (d, _), f, c in zip(texts, fps, slow_components(fps), strict=True)}
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == want
