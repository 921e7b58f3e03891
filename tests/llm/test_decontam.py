import random
import re

import duckdb

from longtrace.llm import decontam

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(t):
    return W.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def slow(docs, items, n=10):
    out = []
    for d, t in docs:
        ws, hit, found = slow_words(t), set(), set()
        for i, it in items:
            iw = slow_words(it)
            for k in range(max(1, len(iw) - n + 1) if iw else 0):
                p = iw[k : k + n]
                for s in range(len(ws) - len(p) + 1):
                    if ws[s : s + len(p)] == p:
                        hit |= set(range(s, s + len(p)))
                        found.add(str(i))
        out.append((d, len(ws), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


DOCS = [(1, "x A-b c d e f g h i j k l y"), (1, "x A-b c d e f g h i j k l y"), (None, "é, ü é ü"), (2, None), (3, ""), (4, "a b c d e f g h i"), (5, "short ones " * 3000), (6, "!!! ..."), (7, "a b c d e f g h i j " * 40)]
ITEMS = [(1, "a b c d e f g h i j k l"), (2, "É é"), (3, "ü é"), (4, None), (5, ""), (6, "short ones"), (10, "a b c d e f g h i j k l"), (11, "b c d e f g h i j k")]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame([(d, t, "x") for d, t in DOCS], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = slow(DOCS, ITEMS)
    for kw in ({}, {"shard_words": 20}, {"block_bytes": 120}, {"block_bytes": 120, "shard_words": 20}, {"block_bytes": 120, "shard_words": 40, "term_bytes": 10}):
        got = decontam.contamination(docs, items, **kw).select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
        assert sorted((tuple(r) for r in got), key=str) == want
    assert decontam.contamination(docs.limit(0), items).count() == 0
    assert decontam.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def slow_near(docs, items, n, slop):
    """Windows in order with at most slop other words between, each next term as early as it comes."""
    out = []
    for d, t in docs:
        ws, hit, found = slow_words(t), set(), set()
        for i, it in items:
            iw = slow_words(it)
            for k in range(max(1, len(iw) - n + 1) if iw else 0):
                p = iw[k : k + n]
                for s in range(len(ws)):
                    at = s if ws[s] == p[0] else None
                    for w in p[1:]:
                        at = next((x for x in range(at + 1, len(ws)) if ws[x] == w), None) if at is not None else None
                    if at is not None and at - s < len(p) + slop:
                        hit |= set(range(s, at + 1))
                        found.add(str(i))
        out.append((d, len(ws), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


def test_many_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE_WORDS", 5)
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abcdef") for _ in range(n))
    rows = [(d, text(rnd.choice([0, 3, 12, 40]))) for d in range(40)]
    tests = [(i, text(rnd.choice([1, 2, 4, 9]))) for i in range(12)] + [(None, "a b")]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    for slop in (0, 2):
        want = slow_near(rows, tests, 4, slop)
        assert any(r[-1] for r in want) and not all(r[-1] for r in want)
        for kw in ({}, {"block_bytes": 200, "shard_words": 30}, {"block_bytes": 200, "shard_words": 30, "term_bytes": 1}):
            got = decontam.contamination(docs, items, window=4, slop=slop, **kw).select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
            assert sorted((tuple(r) for r in got), key=str) == want


def test_blocks_are_bounded_as_measured(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(9000 if i == 0 else 30))) for i in range(30)], "item_id long, text string")
    pieces = decontam.pieces_of(items, "item_id", "text", 10)
    size = lambda df: df.selectExpr("sum(octet_length(piece) + octet_length(item) + 16)").first()[0] or 0
    parts = decontam.blocks(pieces, 50_000)
    assert len(parts) > 2 and all(size(p) <= 50_000 for p in parts) and sum(p.count() for p in parts) == pieces.count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three"), (2, "one x two y three"), (3, "three two one"), (4, "one two"), (5, "three")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = lambda slop: {r.doc_id for r in decontam.contamination(docs, items, slop=slop).where("contaminated").collect()}
    assert (got(0), got(1), got(2)) == (set(), {1}, {1, 2})


def test_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{path}/{t}.parquet'")
    want = sorted(con.sql(f"select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ({decontam.OP5_SQL})").fetchall())
    got = sorted(tuple(r) for r in decontam.op5_decontamination(spark, path).collect())
    assert got == want and any(r[-1] for r in got)
