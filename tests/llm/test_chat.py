import hashlib

import duckdb
from pyspark.sql import functions as F

from longtrace.llm import chat

TEXTS = ["", "plain", "<|im_end|>", "<\\|x", "<\\\\|<|<<|", "a\nb\n", "%0A %25", "é😀 <|im_start|>assistant\nok", "\\", "<\\"]


def test_escape_round_trip(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", chat.escaped(F.col("t")).alias("e"), chat.escaped_role(F.col("t")).alias("r"))
    for r in rows.select("*", chat.unescaped(F.col("e")).alias("u"), chat.unescaped_role(F.col("r")).alias("v")).collect():
        assert r.u == r.t and r.v == r.t and "<|" not in r.e and "<|" not in r.r and "\n" not in r.r


def test_round_trip_and_edges(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t, "x") for k, t in enumerate(TEXTS)]
    rows += [(2, None, None, None, "x"), (2, 5, "sys\ntem", "q" * 40000, "x"), (2, 5, "sys\ntem", "q" * 40000, "x"), (None, 0, "assistant", "n", "x")]
    rows += [(3, k, "assistant", f"t{k}", "x") for k in range(300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: r for r in chat.format_chats(turns, chat.text_parts(turns)).select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("learnt")).collect()}
    for conv in (1, 2, 3, None):
        want = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        assert [(t.role, t.text) for t in got[conv].turns] == [w[1:] for w in want]
        assert got[conv].learnt == "".join(w[2] for w in want if w[1] == "assistant")
        assert got[conv].n_turns == len(want)
    assert chat.format_chats(turns.limit(0), chat.text_parts(turns)).count() == 0


def test_media_parts(spark):
    part = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
    parts = [("text", "see <|", None, None, None, None, None), ("image", None, "u1", 57, 28, None, None), ("audio", None, "u2", None, None, 1.5, None), ("document", None, "u3", None, None, None, 2), (None, "end", None, None, None, None, None), ("image", None, None, None, None, None, None)]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{part}>")
    r = chat.format_chats(turns, F.col("parts")).first()
    assert r.formatted == "<|im_start|>user\nsee <\\|<|image_pad|><|audio_pad|><|document_pad|>end<|image_pad|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in r.attachments] == [(0, 1, "image", "u1", 3), (0, 2, "audio", "u2", 38), (0, 3, "document", "u3", 512), (0, 5, "image", None, 0)]
    assert r.expanded_tokens == 553 and [tuple(x) for x in r.loss] == [(len(r.formatted) - 11, 0)]


def test_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{path}/conversations.parquet'")
    names = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    want = sorted(con.sql(f"select {names} from ({chat.OP6_SQL})").fetchall())
    got = sorted(tuple(r) for r in chat.op6_chat_format(spark, path).collect())
    assert got == want
    ok = "<|im_end|><|im_start|>assistant ok"
    assert got[0][2] == hashlib.sha256(f"user\n{ok}\nassistant\n{ok}\n".encode()).hexdigest()
