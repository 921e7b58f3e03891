"""The pipeline against plain versions of its stages that share no code with them but the trained machine's weights."""

import hashlib
import math
from zlib import crc32

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from longtrace.llm import quality
from tests.llm.test_decontam import slow as slow_decontam

PATH = "/root/testdata/sf0.001"
SPACE = b" \t\n\x0b\x0c\r"


def slow_words(raw):
    out, now = [], b""
    for k in range(len(raw)):
        c = raw[k : k + 1]
        if c in [bytes([x]) for x in SPACE]:
            out, now = out + [now] * bool(now), b""
        else:
            now += c
    return out + [now] * bool(now)


def slow_score(text, n_chars, machine):
    """The machine's score with every pair of features multiplied out."""
    raw = (text or "").encode()
    ws = [w.lower() for w in raw.split()]
    n, bits = len(ws), quality.WORD_BITS
    ids = [crc32(w) % 2**bits for w in ws]
    counts = {}
    for i in ids:
        counts[i] = counts.get(i, 0) + 1
    values = {i: 1 + math.log(c) for i, c in counts.items()}
    norm = max(1e-9, math.sqrt(sum(v * v for v in values.values())))
    x = {i: v / norm for i, v in values.items()}
    share = lambda ok: sum(map(ok, raw)) / max(1, len(raw))
    odd = lambda b: 33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?"
    lines = [line for line in raw.split(b"\n") if line.strip()]
    triples = list(zip(ids, ids[1:], ids[2:], strict=False))
    stats = [n, sum(map(len, ws)) / max(1, n), share(lambda b: 65 <= b <= 90), share(odd), share(lambda b: 48 <= b <= 57), len(counts) / max(1, n)]
    stats += [sum(a == b for a, b in zip(ids, ids[1:], strict=False)) / (n - 1) if n > 1 else 0, sum(len(w) < 3 for w in ws) / max(1, n), sum(map(len, lines)) / max(1, len(lines))]
    stats += [1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(triples)) / max(1, len(triples)), n_chars or 0]
    for k, (edges, s) in enumerate(zip(quality.EDGES.values(), stats, strict=True)):
        x[2**bits + quality.STEPS * k + sum(e <= s for e in edges)] = 0.5
    places = sorted(x)
    raw_score = machine.bias + sum(machine.w[p] * x[p] for p in places)
    v = {p: machine.v[p].tolist() for p in places}
    for i, p in enumerate(places):
        for q in places[i + 1 :]:
            raw_score += sum(a * b for a, b in zip(v[p], v[q], strict=True)) * x[p] * x[q]
    return 1 / (1 + math.exp(-raw_score))


def slow_chunks(text):
    h = lambda line: int(hashlib.md5(line).hexdigest()[:12], 16)
    lines = text.encode().split(b"\n")
    out, now = [], []
    for k, line in enumerate(lines):
        now.append(line)
        if k and (31 * h(lines[k - 1]) + h(line)) % 3 == 0:
            out, now = [*out, now], []
    return [*out, now] if now else out


def slow_line_dedup(texts):
    """Of {id: text}: chunks of two or more lines with words go if they stand earlier."""
    seen, out = set(), {}
    for d in sorted(texts):
        kept = []
        for chunk in slow_chunks(texts[d]):
            raw = b"\n".join(chunk)
            if not (sum(bool(slow_words(x)) for x in chunk) >= 2 and raw in seen):
                kept += chunk
            seen.add(raw)
        out[d] = b"\n".join(kept).decode()
    return out


def slow_near(texts):
    """The smallest id of every group of five-word Jaccard similarity 0.8 or more."""
    sets = {}
    for d, t in texts.items():
        ws = [w.lower() for w in t.encode().split()]
        sets[d] = frozenset(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else frozenset()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            union = len(sets[a] | sets[b])
            if not union or 5 * len(sets[a] & sets[b]) >= 4 * union:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [d for d in ids if root(d) == d]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    machine = quality.train(docs, spark.read.parquet(f"{PATH}/labels.parquet"))
    rows = sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect())
    short = [r for r in rows if len(r[1]) < 3000][:30]
    told = {r.doc_id: r.score for r in quality.scores(docs, machine).collect()}
    assert all(told[d] == pytest.approx(slow_score(t, n, machine), abs=1e-4) for d, t, n in short)
    texts = {d: t for d, t, _ in rows if told[d] >= corpus_pipeline.MIN_SCORE}
    cut = slow_line_dedup(texts)
    left = slow_near(cut)
    items = [tuple(r) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    clean = [d for d, *_, hit in slow_decontam([(d, cut[d]) for d in left], items) if not hit]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((d, len(sp.encode(cut[d])), sha(",".join(map(str, sp.encode(cut[d])))), sha(sp.decode(sp.encode(cut[d]))), sp.encode(cut[d])) for d in clean)
    got = corpus_pipeline.run(spark, PATH).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect()
    assert sorted(tuple(r) for r in got) == want
    assert len(rows) > len(texts) > len(left) > len(want) > 0


ODD = [(None, None, None, None, None), (None, "", "en", "s", 0), (3, None, "en", "s", None), (3, None, "en", "s", None), (10**6, "word " * 30000, "en", "s", 150000), (777, "two rows of one id", "en", "a", 18), (777, "two rows of one id", "en", "b", 18)]
CLASHING = ("score", "n_lines", "_id", "_row", "_text", "_key", "row", "key", "id", "first", "component_id", "hits", "c0", "text2")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_columns_and_edges(spark, name, stage):
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(20)
    rows = docs.unionByName(spark.createDataFrame(ODD, docs.schema))
    more = rows.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("source"), F.lit("none"))) for c in CLASHING})
    out = stage(spark, more, PATH)
    assert stage(spark, more.limit(0), PATH).count() == 0
    if name == "sentencepiece":
        assert out.count() == more.count()
        return
    assert out.columns == more.columns
    got = out.collect()
    assert 0 < len(got) <= more.count()
    assert all(r[c] == f"{c} of {r.source if r.source is not None else 'none'}" for r in got for c in CLASHING)
    if name == "simhash_dedup":
        assert [r.source for r in got if r.doc_id == 777] == ["a"] and sum(not r.text for r in got) == 1
