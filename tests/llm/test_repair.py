"""Conversation repair against a search over all edits, cut in pieces of any size."""

import heapq
import itertools
import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from longtrace.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(roles, faults):
    """(cost, audit, names) by a best-first search over (cost, audit); a None name is the row's own."""
    queue = [(0, "", 0, (), False)]
    while queue:
        cost, audit, row, names, _ = heapq.heappop(queue)
        initials = "".join(n[:1] for n in names)
        body = initials[1:] if initials[:1] == "s" else initials
        if body != ("ua" * len(body))[: len(body)]:
            continue
        if row == len(roles) and (not initials or body and len(body) % 2 == 0):
            return cost, audit, names
        if row < len(roles):
            stays = 5 * (faults[row] == "t")
            heapq.heappush(queue, (cost + 2, audit + "D", row + 1, names, False))
            if faults[row] not in "bd":
                heapq.heappush(queue, (cost + stays, audit + "K", row + 1, (*names, roles[row] or "?"), False))
                for r in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 1 + stays, audit + "R", row + 1, (*names, r), False))
        if len(audit) < 3 * len(roles) + 3:
            for r in ("user", "assistant"):
                heapq.heappush(queue, (cost + 5, audit + "I", row, (*names, r), False))


def told(rows):
    """The figures of one conversation's rows [(turn, role, text)]."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], __import__("hashlib").md5(r[2].encode()).hexdigest()))
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    faults = ""
    for k, (_, role, text) in enumerate(rows):
        bare = text.strip(WHITE)
        faults += "b" if not bare else "d" if (role, text) in [(r, t) for _, r, t in rows[:k]] else "t" if bare[-1] not in ".!?" else "-"
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
    cost, audit, names = cheapest(roles, faults)
    known = [t for t, _, _ in rows if t is not None]
    out, row, place = [], 0, 0
    for letter in audit:
        if letter in "KR":
            out.append(f"{names[place]}:{texts[row]}")
        elif letter == "I":
            out.append(f"{names[place]}:")
        place += letter != "D"
        row += letter != "I"
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest())


def compared(spark, rows, partitions="3", **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("there", F.lit(True)).withColumn("piece", F.lit("x"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted((tuple(r) for r in repair.summaries(repair.repair(df, **kw)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    groups = {}
    for c, turn, role, text in rows:
        groups.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == sorted(((c, *told(x)) for c, x in groups.items()), key=str)
    return got


def made(seed, conversations, most=7):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why", "", " \n", "Yes.\t", "ok?", "cut off", None, "é…", "?"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, ""]
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            yield (c, rng.choice([t, t, t + 1, None]), rng.choice(roles), rng.choice(texts))


def test_each_symbol_string_has_the_least_edits():
    names = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
    rng = random.Random(4)
    every = ["".join(x) for n in range(3) for x in itertools.product("012345678", repeat=n)]
    for symbols in every + ["".join(rng.choice("012345678") for _ in range(rng.randint(3, 7))) for _ in range(150)]:
        roles = [names[int(s) % 4] for s in symbols]
        faults = "".join("b" if s == "8" else "t" if s in "4567" else "-" for s in symbols)
        cost, audit, kept = cheapest(roles, faults)
        assert repair.traced(symbols, 0, repair.START, True)[0] == audit, symbols
        assert repair.edits_cost(audit, faults) == cost
        assert repair.edited(roles, ["x"] * len(roles), audit, repair.START)[0] == list(kept)


def test_blocks_equal_single_steps():
    t, rng = repair.tables(), random.Random(9)
    assert len(t.vectors) < 64
    for _ in range(50):
        symbols = "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 30)))
        onto = repair.onto(symbols)
        for v, costs in enumerate(t.vectors):
            for s in reversed(symbols):
                costs = repair.before(int(s), costs)
            assert t.vectors[onto[v]] == tuple(c - min(costs) for c in costs)


@pytest.mark.parametrize("piece_rows", [1, 2, 1000])
def test_conversations_in_pieces(spark, piece_rows):
    rows = list(made(piece_rows, 40)) + [(None, 0, "user", "Hi."), (None, None, None, None), (None, 2, "user", "Hi.")]
    compared(spark, rows, piece_rows=piece_rows)


def test_one_conversation_as_the_whole_table(spark):
    rng = random.Random(2)
    rows = [(7, k, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", "", f"{k}!"])) for k in range(60)]
    rows = [r for k, r in enumerate(rows) if k < 12 or r[3] not in ("A.", "b")]
    expected = [compared(spark, rows[:14], partitions=p, piece_rows=n)[0] for p, n in (("1", 1000), ("5", 3))]
    assert expected[0] == expected[1]
    df = spark.createDataFrame(rows, SCHEMA)
    results = []
    for n in (1, 4, 7, 1000):
        results.append(repair.summaries(repair.repair(df, piece_rows=n)).collect())
    results.append(repair.summaries(repair.repair(df, piece_chars=5)).collect())
    assert all(r == results[0] for r in results)
    alike = spark.createDataFrame([(1, 1, "user", "Same.")] * 500, SCHEMA)
    one = repair.summaries(repair.repair(alike, piece_rows=16)).collect()
    assert len(one) == 1 and one[0].duplicate == 499 and one[0].audit == "D" * 500 and one[0].cost == 1000


def test_damage_and_absent_rows(spark):
    rows = list(made(77, 60))
    df = spark.createDataFrame(rows, SCHEMA)
    hurt, there = repair.damaged(df)
    got = sorted((tuple(r) for r in repair.summaries(repair.repair(hurt, present=there)).collect()), key=str)
    groups = {}
    for c, turn, role, text in rows:
        kept = groups.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else text.translate({33: None, 46: None, 63: None}) if harm == 2 else text
        kept += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    assert got == sorted(((c, *told(x)) for c, x in groups.items()), key=str)
    none = repair.summaries(repair.repair(df, present=F.lit(False))).collect()
    assert {tuple(r)[1:] for r in none} == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())} and len(none) == len(groups)
    assert repair.summaries(repair.repair(df.limit(0))).collect() == []
