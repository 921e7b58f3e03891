import hashlib
import random

import numpy as np
import pytest

from longtrace.llm import suffixes


def slow(docs, width=100):
    seen, out = {}, []
    order = sorted((float("inf") if d is None else d, k) for k, (d, _) in enumerate(docs))
    for d, k in order:
        raw = (docs[k][1] or "").encode()
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            seen[w] = min(seen.get(w, (d, p)), (d, p))
    for d, k in order:
        raw = (docs[k][1] or "").encode()
        off = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if seen[raw[p : p + width]] < (d, p):
                off[p : p + width] = b"\1" * width
        spans = sum(off[i] and not (i and off[i - 1]) for i in range(len(raw)))
        kept = bytes(b for b, o in zip(raw, off, strict=True) if not o)
        out.append((docs[k][0], len(raw), sum(off), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_order():
    rnd = random.Random(1)
    for _ in range(300):
        n, k = rnd.randrange(1, 200), rnd.choice([1, 2, 4, 200])
        text = np.array([rnd.randrange(1, k + 1) for _ in range(n)])
        assert suffixes.suffix_order(text, 10**6).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
        for depth in (1, 3, 7, 20):
            order = suffixes.suffix_order(text, depth)
            heads = [text[i : i + depth].tolist() for i in order]
            assert sorted(order.tolist()) == list(range(n)) and heads == sorted(heads)


def test_window_minima():
    raw = np.frombuffer(random.Random(2).randbytes(300), np.uint8)
    twice = np.concatenate([raw, raw])
    a, b = suffixes.window_minima(raw, 100)[0], suffixes.window_minima(twice, 100)[0]
    assert len(a) == 201 and (b[:201] == a).all() and (b[300:] == a).all()
    v, start, size, near = suffixes.runs(np.zeros(200_000, np.uint8), 100)
    assert near.all() and not suffixes.runs(raw, 100)[3].any()
    assert size.sum() == 200_000 - 99 and (start == np.cumsum(size) - size).all() and len(set(v.tolist())) == 1


@pytest.mark.parametrize("bucket_bytes", [1 << 22, 4000])
def test_against_brute_force(spark, bucket_bytes, monkeypatch):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = [prose(rnd.randrange(30)) for _ in range(3)]
        for s in rnd.sample(shared, 2):
            cut = rnd.randrange(60)
            parts.insert(rnd.randrange(3), s[cut:] if rnd.random() < 0.5 else s)
        rows.append((d, " ".join(parts)))
    rows += [(100 + k, rows[3][1]) for k in range(30)] + [(200 + k, rows[7][1][:k] + "X" + rows[7][1][k + 1 :]) for k in range(0, 200, 7)]
    rows += [(300, "ab " * 700), (301, "b a" * 300), (302, "x" * 99), (303, "x" * 100), (304, "x" * 101), (305, None), (306, ""), (None, rows[0][1]), (None, rows[0][1]), (5, rows[5][1]), (6, rows[2][1])]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, key string").repartition(5)
    monkeypatch.setattr(suffixes, "SORT_BYTES", 2000)
    got = sorted((tuple(r) for r in suffixes.without_substrings(docs, bucket_bytes=bucket_bytes).drop("kept").collect()), key=str)
    assert got == slow(rows)
    assert suffixes.without_substrings(docs.limit(0)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = slow([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in suffixes.op3_suffix_array(spark, "/root/testdata/sf0.001").collect()), key=str) == want


def test_one_hash_for_all_rows(spark, monkeypatch):
    """Documents whose ids and texts hash alike keep their own spans."""
    rnd = random.Random(8)
    shared = rnd.randbytes(90).hex()
    rows = [(d, rnd.randbytes(rnd.randrange(150)).hex() + shared + rnd.randbytes(9).hex() * (d % 3)) for d in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffixes.F, "xxhash64", lambda *columns: suffixes.F.lit(7).cast("long"))
    assert sorted((tuple(r) for r in suffixes.without_substrings(docs).drop("kept").collect()), key=str) == slow(rows)
