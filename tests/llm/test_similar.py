import random

import corpus_pipeline
from longtrace.llm import similar

PATH = "/root/testdata/sf0.001"


def slow_shingles(text, size=5):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def slow_first(rows):
    """Ids that are the smallest of their component under pairs of Jaccard 0.8 or more."""
    sets = [(i, slow_shingles(t)) for i, t in sorted(rows)]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted(i for i in root if find(i) == i)


def edited():
    """Texts of 200 words, each with copies that differ in 1 to 6 words, a chain, and one group of 120 copies of a hub."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for edits in (1, 2, 3, 4, 5, 6) * 5:
        text = rng.choices(words, k=200)
        copy = list(text)
        for at in rng.sample(range(200), edits):
            copy[at] = "x"
        texts += [text, copy]
    for _ in range(10):
        texts.append(texts[-1][6:] + rng.choices(words, k=6))
    hub = rng.choices(words, k=300)
    for _ in range(120):
        copy = list(hub)
        for at in rng.sample(range(300), 4):
            copy[at] = rng.choice(words)
        texts.append(copy)
    texts += [["a", "b"], ["A", "b"], ["a", "c"], [], []]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, PATH).collect())


def test_stage_against_brute_force_jaccard(spark):
    rows = edited()
    assert kept(spark, rows) == slow_first(rows)
    given = [tuple(r) for r in spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "text").collect()]
    assert kept(spark, given) == slow_first(given)


def test_large_bands_in_parts(spark, monkeypatch):
    monkeypatch.setattr(similar, "HUBS", 1)
    monkeypatch.setattr(similar, "SMALL", 3)
    monkeypatch.setattr(similar, "PART", 16)
    rows = edited()
    assert kept(spark, rows) == slow_first(rows)


def test_border_is_in_whole_numbers():
    a = similar.shingles(" ".join(f"a{i}" for i in range(13)))
    assert len(a) == 9 and similar.similar(a[:8], a[:9]) and similar.similar(a[:4], a[:5]) and not similar.similar(a[:7], a[:9])


def test_fingerprints_link_first(spark):
    """Edited copies whose fingerprints are two bits apart are found by the trie, before any band."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(20):
        text = rng.choices(words, k=600)
        texts += [text, [*text[:-1], "x"], rng.choices(words, k=600)]
    sets = {similar.key_of(s): s for s in (similar.shingles(" ".join(t)) for t in texts)}
    fps = {k: similar.fingerprint(s) for k, s in sets.items()}
    for k, s in sets.items():
        assert fps[k] % 2**64 == sum((2 * sum(int(h) >> b & 1 for h in s) > len(s)) << b for b in range(64))
    want = {(u, v) for u in sets for v in sets if u < v and ((fps[u] ^ fps[v]) % 2**64).bit_count() <= 2}
    assert len(want) > 5 and all(similar.similar(sets[u], sets[v]) for u, v in want)
    nodes = spark.createDataFrame([(k, fp) for k, fp in fps.items()] + [(0, 0)], "key long, fp long")
    assert {tuple(r) for r in similar.close_fingerprints(nodes).collect()} == want
