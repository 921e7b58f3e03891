import duckdb
from pyspark.sql import functions as F

from longtrace.llm import lines


def test_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}"
        con = duckdb.connect()
        con.sql(f"create or replace view documents as select * from '{path}/documents.parquet'")
        names = "doc_id, n_lines, n_removed_lines, n_removed_chunks, kept_sha256"
        want = sorted(con.sql(f"select {names} from ({lines.OP2_SQL})").fetchall())
        got = sorted(tuple(r) for r in lines.op2_line_dedup(spark, path).collect())
        assert got == want and sum(r[3] for r in got) > 0


def test_shifted_passages_and_edges(spark):
    passage = "\n".join(f"shared line number {k} of the passage" for k in range(30))
    own = lambda d, n: "\n".join(f"own {d} line {k}" for k in range(n))
    rows = [(d, own(d, d) + "\n" + passage + "\n" + own(d + 100, 3), "s", "x") for d in range(1, 6)]
    rows += [(50, None, "s", "x"), (51, "", "s", "x"), (None, passage, "s", "x"), (52, "\n" * 50, "s", "x"), (53, "\n" * 50, "s", "x"), (54, own(9, 20000), "s", "x"), (55, own(7, 9), "s", "x"), (55, own(7, 9), "s", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, chunk string")
    got = lines.without_repeats(docs)
    assert got.columns[:4] == docs.columns and got.count() == len(rows)
    out = {r.doc_id: r for r in got.collect()}
    assert out[None].n_removed_lines == 0 and all(out[d].n_removed_lines >= 20 for d in range(1, 6))
    assert all(own(d, d) in out[d].text and own(d + 100, 3) in out[d].text for d in range(1, 6))
    assert out[50].text is None and out[50].n_lines == 0 and out[51].text == "" and out[53].n_removed_lines == 0
    assert out[55].text == own(7, 9) and out[54].text == own(9, 20000)
    assert lines.without_repeats(docs.limit(0)).count() == 0
    assert lines.without_repeats(docs.withColumn("text", F.lit("a\nb"))).where("n_removed_lines = 2").count() == 12


def test_ids_of_text_names_and_hot_chunks(spark, monkeypatch):
    """Empty-string ids; columns named as the counters; the same result whether hot chunks are broadcast or not."""
    shared = "\n".join(f"shared line {k}" for k in range(40))
    rows = [("" if d == 0 else None if d == 1 else f"id{d}", f"own {d} a\nown {d} b\n{shared}\nown {d} c\nown {d} d", d, "x") for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_lines long, `a b` string").repartition(7)
    got = sorted((str(r.doc_id), r.text, r.n_lines, r["_n_lines"], r.n_removed_chunks) for r in lines.without_repeats(docs).collect())
    assert [r[2] for r in got] == [d for _, d in sorted((str(x[0]), x[2]) for x in rows)]
    assert sum(r[4] == 0 for r in got) == 1 and next(r for r in got if r[4] == 0)[0] == "None"
    monkeypatch.setattr(lines, "HOT", 5)
    assert sorted((str(r.doc_id), r.text, r.n_lines, r["_n_lines"], r.n_removed_chunks) for r in lines.without_repeats(docs.repartition(3)).collect()) == got
