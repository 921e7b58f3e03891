import random

import duckdb

from longtrace.llm import rules


def test_repeated_words():
    assert rules.repeated_words(b"a b c a b c".split()) == 6
    assert rules.repeated_words(b"a a a a".split()) == 4
    assert rules.repeated_words(b"a b c x b c d".split()) == 0
    assert rules.repeated_words([]) == 0
    assert rules.measures("é #a\n \n é #a\n é #a")[:4] == (6, 9, 3, 1)
    assert rules.measures(None) == (0, 0, 0, 0, 0)


def test_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/documents.parquet'")
    names = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"
    want = sorted(con.sql(f"select {names} from ({rules.OP10_SQL})").fetchall())
    got = sorted(tuple(r) for r in rules.op10_quality_rules(spark, path).select(*names.split(", ")).collect())
    assert got == want


GOOD, BAD = " ".join(f"w{i}" for i in range(80)), "spam " * 80


def test_host_verdicts_and_edges(spark):
    rows = [(i, GOOD, f"fine{i % 9}.example", 1) for i in range(900)] + [(1000 + i, BAD if i % 10 else GOOD, "bad.example", 1) for i in range(300)]
    rows += [(None, None, None, 1), (2000, "", "fine1.example", 1), (2001, GOOD, "new.example", 1), (2002, "long " + GOOD * 3000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rates int")
    got = rules.host_rules(docs)
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert got.count() == len(rows)
    assert set(range(900)) <= kept and not any(i in kept for i in range(1000, 1300)) and 2001 in kept
    assert got.where("not kept and not base_failed and host_rejected").count() == 30
    assert rules.host_rules(docs.limit(0)).count() == 0


def test_shuffled_verdicts_equal_broadcast_ones(spark, monkeypatch):
    rows = [(i, GOOD if i % 7 else BAD, f"h{i % 50}" if i % 3 else "bad", 1) for i in range(600)] + [(1000 + i, BAD, "bad", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, x int")
    want = sorted(str(tuple(r)) for r in rules.host_rules(docs).collect())
    monkeypatch.setattr(rules, "BROADCAST_HOSTS", 0)
    monkeypatch.setattr(rules, "LARGE", 100)
    assert sorted(str(tuple(r)) for r in rules.host_rules(docs).collect()) == want


def test_one_document_hosts_are_shrunk(spark):
    """Hosts of one document tell nothing of hosts: each stays at the mean, whatever its one document does."""
    docs = spark.createDataFrame([(i, BAD if i % 5 == 0 else GOOD, f"host{i}") for i in range(500)], "doc_id long, text string, source string")
    got = rules.host_rules(docs).collect()
    assert not any(r.host_rejected for r in got)
    assert all(abs(r.host_rates["repeats"] - 0.2) < 0.001 for r in got)


def test_prior_matches_plain_moments(spark):
    rnd = random.Random(4)
    rows, judged = [], []
    for h in range(40):
        p = rnd.betavariate(2, 6)
        for _ in range(rnd.randrange(5, 60)):
            bad = rnd.random() < p
            rows.append((len(rows), BAD if bad else GOOD, f"host{h}"))
            judged.append((f"host{h}", bad))
    hosts = {}
    for h, bad in judged:
        n, f = hosts.get(h, (0, 0))
        hosts[h] = (n + 1, f + bad)
    n, k = len(rows), len(hosts)
    m = sum(f for _, f in hosts.values()) / n
    s = sum(x * (f / x - m) ** 2 for x, f in hosts.values())
    w = (s / (m * (1 - m)) - (k - 1)) / (n - sum(x * x for x, _ in hosts.values()) / n - (k - 1))
    strength = 1 / w - 1
    assert 2 < strength < 20  # drawn from a prior of strength 8
    got = rules.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("doc_id", "host_rates.repeats").collect()
    for d, rate in got:
        x, f = hosts[rows[d][2]]
        assert abs(rate - (f + m * strength) / (x + strength)) < 1e-9
