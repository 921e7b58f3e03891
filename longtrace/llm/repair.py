"""Conversation structure repair: cheapest edits to alternating turns, by block tables of normalised cost vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from longtrace.session import written

#: Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States by the last role put out: nothing yet, system, user, assistant. What may follow, by an insertion or another role, is user but after a user.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols of rows: the initial (s, u, a, any other), 4 more if truncated; 8: must be deleted; 9: no row.
INITIALS = {"s": 0, "u": 1, "a": 2}
GONE, NONE = 8, 9
#: Symbols in a block.
BLOCK = 4
#: A piece of a conversation has so many rows and characters at most (or one row).
PIECE_ROWS, PIECE_CHARS = 1024, 4 << 20
WHITE = " \t\n\x0b\x0c\r"


def keeps(symbol: int, state: int) -> int | None:
    """The state after a row is kept as it is; None if its role can't stand there."""
    initial = symbol % 4
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def with_insertions(costs: list[int]) -> tuple[int, ...]:
    while True:
        least = [min(c, INSERT + costs[AFTER[q]]) for q, c in enumerate(costs)]
        if least == costs:
            return tuple(costs)
        costs = least


def before(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The costs to the end from each state before a row, given those after it."""
    if symbol == NONE:
        return costs
    out = [DELETE + c for c in costs]
    if symbol != GONE:
        stays = TRUNCATED * (symbol >= 4)
        for q in range(4):
            kept = keeps(symbol, q)
            out[q] = min(out[q], REROLE + stays + costs[AFTER[q]], *([stays + costs[kept]] if kept is not None else []))
    return with_insertions(out)


class Tables:
    """What one symbol and one block do to every normalised cost vector that can come up.

    A cost vector, less its smallest entry, is one of a few dozen, since an
    insertion or two lead from each state to the next: `vectors`, the one of the end
    first. step[block][vector] is the number of the vector before the block.
    """

    def __init__(self, block: int = BLOCK):
        end = with_insertions([0, 1000, 1000, 0])
        self.vectors, number, todo = [end], {end: 0}, [end]
        single: list[list[int]] = []
        while todo:
            v = todo.pop(0)
            single.append([])
            for symbol in range(10):
                w = before(symbol, v)
                w = tuple(x - min(w) for x in w)
                if w not in number:
                    number[w] = len(self.vectors)
                    self.vectors.append(w)
                    todo.append(w)
                single[-1].append(number[w])
        one = np.array(single, np.uint8).T
        step = one
        for _ in range(block - 1):
            step = one[:, step].reshape(-1, one.shape[1])
        self.block, self.array, self.step = block, step, [row.tobytes() for row in step]


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: str) -> list[str]:
    """The symbols in blocks; the first is filled up in front."""
    filled = str(NONE) * (-len(symbols) % BLOCK) + symbols
    return [filled[k : k + BLOCK] for k in range(0, len(filled), BLOCK)]


def end_vectors(blocks: list[str], end: int) -> list[int]:
    """The vector behind each block, by one lookup a block from the last to the first."""
    step, out = tables().step, [end] * len(blocks)
    for k in range(len(blocks) - 1, 0, -1):
        out[k - 1] = step[int(blocks[k])][out[k]]
    return out


def onto(symbols: str) -> bytes:
    """For each vector behind the symbols, the one before them."""
    t = tables()
    v = np.arange(len(t.vectors))
    for b in reversed(blocks_of(symbols)):
        v = t.array[int(b)][v]
    return v.astype(np.uint8).tobytes()


@lru_cache(1 << 16)
def expanded(block: str, end: int, state: int) -> tuple[str, int]:
    """(edits, state after the block): costs are worked out backward through the block, then the first letter in order is taken that keeps the least cost."""
    costs = [tables().vectors[end]]
    for symbol in reversed(block):
        costs.append(before(int(symbol), costs[-1]))
    costs.reverse()
    out = []
    for k, digit in enumerate(block):
        symbol = int(digit)
        while symbol != NONE:
            now, then = costs[k], costs[k + 1]
            stays = TRUNCATED * (4 <= symbol < GONE)
            kept = keeps(symbol, state) if symbol < GONE else None
            if now[state] == DELETE + then[state]:
                out.append("D")
            elif now[state] == INSERT + now[AFTER[state]]:
                out.append("I")
                state = AFTER[state]
                continue
            elif kept is not None and now[state] == stays + then[kept]:
                out.append("K")
                state = kept
            else:
                out.append("R")
                state = AFTER[state]
            break
    return "".join(out), state


def traced(symbols: str, end: int, state: int, last: bool) -> tuple[str, int]:
    """(edits, state after them) of symbols from state, with vector `end` behind them; last: the conversation ends there."""
    blocks, out = blocks_of(symbols), []
    for block, v in zip(blocks, end_vectors(blocks, end), strict=True):
        letters, state = expanded(block, v, state)
        out.append(letters)
    while last and state in (SYSTEM, USER):
        out.append("I")
        state = AFTER[state]
    return "".join(out), state


def faults_of(roles: list[str], texts: list[str]) -> str:
    """A letter for each row: its first fault, blank, duplicate or truncated, or "-"."""
    seen, out = set(), []
    for row in zip(roles, texts, strict=True):
        bare = row[1].strip(WHITE)
        out.append("b" if not bare else "d" if row in seen else "-" if bare[-1] in ".!?" else "t")
        seen.add(row)
    return "".join(out)


def symbols_of(roles: list[str], faults: str) -> str:
    return "".join(str(GONE) if f in "bd" else str(INITIALS.get(r[:1], 3) + 4 * (f == "t")) for r, f in zip(roles, faults, strict=True))


def edited(roles: list[str], texts: list[str], audit: str, state: int) -> tuple[list[str], list[str]]:
    """The rows that the edits leave, from state."""
    row, out_roles, out_texts = 0, [], []
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            state = (SYSTEM, USER, ASSISTANT)[INITIALS[roles[row][:1]]]
        else:
            state = AFTER[state]
        out_roles.append(roles[row] if letter == "K" else NAMES[state])
        out_texts.append("" if letter == "I" else texts[row])
        row += letter != "I"
    return out_roles, out_texts


def edits_cost(audit: str, faults: str) -> int:
    row, cost = 0, 0
    for letter in audit:
        cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter]
        if letter != "I":
            cost += TRUNCATED * (letter != "D" and faults[row] == "t")
            row += 1
    return cost


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


FIGURES = ["first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated", "illegal", "cost"]
COLUMNS = ["conv_id", "piece", "whole", *FIGURES, "audit", "roles", "texts"]


def _schema(conv: str) -> str:
    return f"conv_id {conv}, piece long, whole boolean, " + ", ".join(f"{x} long" for x in FIGURES) + ", audit string, roles array<string>, texts array<string>"


def _record(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    kinds = [conv, pa.int64(), pa.bool_(), *[pa.int64()] * len(FIGURES), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], COLUMNS)


def _piece(conv, number: int, whole: bool, turns: list, roles: list[str], texts: list[str]) -> tuple:
    """A row of pieces: repaired if whole, else as it came, with its faults as audit."""
    faults = faults_of(roles, texts)
    known = [t for t in turns if t is not None]
    span = (known[0], known[-1], len(set(known))) if known else (None, None, 0)
    pairs = illegal_pairs([r[:1] for r in roles])
    audit, cost = faults, None
    if whole:
        audit, _ = traced(symbols_of(roles, faults), 0, START, True)
        cost = edits_cost(audit, faults)
        roles, texts = edited(roles, texts, audit, START)
    return (conv, number, whole, *span, faults.count("b"), faults.count("d"), faults.count("t"), pairs, cost, audit, roles, texts)


def cut(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Pieces of sorted rows (conv_id, turn, role, text, present): a conversation that surely ends within the task is one, repaired at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, conv_type = TaskContext.get().partitionId() << 32, 0, [], None
        conv, begun, edge, turns, roles, texts, chars = None, False, True, [], [], [], 0

        def close(whole: bool) -> None:
            nonlocal number, turns, roles, texts, chars
            out.append(_piece(conv, part + number, whole, turns, roles, texts))
            number, turns, roles, texts, chars = number + 1, [], [], [], 0

        held = 0
        for batch in batches:
            conv_type = batch.column(0).type
            for c, turn, role, text, present in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if begun and c != conv:
                    held += chars
                    close(not edge)
                    edge = False
                conv, begun = c, True
                if not present:
                    continue
                if len(roles) >= piece_rows or chars and chars + len(text) > piece_chars:
                    held += chars
                    close(False)
                    edge = True
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                chars += len(text)
                if held >= piece_chars or len(out) >= 4096:
                    yield _record(out, conv_type)
                    out.clear()
                    held = 0
        if begun:
            close(False)
        if out:
            yield _record(out, conv_type)

    return rows.mapInArrow(run, _schema(rows.schema["conv_id"].dataType.simpleString()))


def _walk(df: DataFrame, schema: str, step: Callable, descending: bool = False) -> DataFrame:
    """Pieces of each conversation in order, one at a time: step(state or None, row) -> (state, output row); only the state is held."""
    order = F.col("piece").desc() if descending else F.col("piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, begun = None, None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                state = state if begun and row["conv_id"] == conv else None
                conv, begun = row["conv_id"], True
                state, got = step(state, row)
                out.append(got)
            yield pa.RecordBatch.from_pylist(out, arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, schema)


def joined(pieces: DataFrame) -> DataFrame:
    """The pieces of conversations that may go on in another piece, repaired as one conversation each.

    Rows seen in an earlier piece are found by (conversation, digest of role and
    text). Then, of each piece: what it does to every cost vector (any order); the
    vector behind it (pieces walked from the last, one lookup each); the state it
    leads to from each state (any order); the state before it (pieces walked from
    the first); its edits (any order). No task holds more than one piece at a time.
    """
    conv = pieces.schema["conv_id"].dataType.simpleString()

    @F.udf("array<binary>")
    def digests(roles: list[str], texts: list[str], faults: str) -> list:
        return [None if f in "bd" else md5(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass")).digest() for r, t, f in zip(roles, texts, faults, strict=True)]

    @F.udf("string")
    def marked(faults: str, again: list[int] | None) -> str:
        lost = set(again or ())
        return "".join("d" if k in lost else f for k, f in enumerate(faults))

    symbols = F.udf(symbols_of, "string")
    moves = F.udf(onto, "binary")

    keys = pieces.select("conv_id", "piece", F.posexplode(digests("roles", "texts", "audit")).alias("k", "key")).where("key is not null")
    met = keys.groupBy("conv_id", "key").agg(F.min("piece").alias("first"), F.collect_list(F.struct("piece", "k")).alias("at"))
    again = met.where("size(at) > 1").select("first", F.inline("at")).where("piece > first").groupBy("piece").agg(F.collect_list("k").alias("again"))
    faulty = pieces.join(again, "piece", "left").withColumn("faults", marked("audit", "again")).drop("again", "audit")
    found = written(faulty.withColumn("symbols", symbols("roles", "faults")), "pieces")

    def behind(v: int | None, row: dict) -> tuple:
        end = 0 if v is None else v
        return row["onto"][end], {"piece": row["piece"], "end": end, "last": v is None}

    ends = written(_walk(found.select("conv_id", "piece", moves("symbols").alias("onto")), "piece long, end int, last boolean", behind, descending=True), "ends")
    narrow = found.select("conv_id", "piece", "symbols", "first_turn", "last_turn", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"))

    @F.udf("array<int>")
    def leads(symbols: str, end: int) -> list[int]:
        return [traced(symbols, end, q, False)[1] for q in range(4)]

    edge = narrow.join(ends, "piece").select("conv_id", "piece", leads("symbols", "end").alias("leads"), "first_turn", "last_turn", F.get("initials", F.lit(0)).alias("head"), F.element_at(F.when(F.size("initials") > 0, F.col("initials")), -1).alias("tail"))

    def reached(state: tuple | None, row: dict) -> tuple:
        q, tail, turn = state or (START, None, None)
        got = {"piece": row["piece"], "state": q, "more_illegal": int(tail is not None and row["head"] is not None and tail + row["head"] not in ("su", "ua", "au")), "same_turn": int(turn is not None and row["first_turn"] == turn)}
        tail = row["tail"] if row["head"] is not None else tail
        return (row["leads"][q], tail, row["last_turn"] if row["last_turn"] is not None else turn), got

    states = _walk(edge, "piece long, state int, more_illegal long, same_turn long", reached)

    @F.udf("audit string, cost long, roles array<string>, texts array<string>")
    def done(symbols: str, end: int, state: int, last: bool, faults: str, roles: list[str], texts: list[str]) -> tuple:
        audit, _ = traced(symbols, end, state, last)
        return (audit, edits_cost(audit, faults), *edited(roles, texts, audit, state))

    count = lambda letter: (F.length("faults") - F.length(F.replace("faults", F.lit(letter), F.lit("")))).cast("long").alias({"b": "blank", "d": "duplicate", "t": "truncated"}[letter])
    whole = found.join(ends.join(states, "piece"), "piece").withColumn("done", done("symbols", "end", "state", "last", "faults", "roles", "texts"))
    return whole.select(
        F.col("conv_id").cast(conv), "piece", F.lit(False).alias("whole"), "first_turn", "last_turn", (F.col("n_turns") - F.col("same_turn")).alias("n_turns"),
        *map(count, "bdt"), (F.col("illegal") + F.col("more_illegal")).alias("illegal"), "done.cost", "done.audit", "done.roles", "done.texts",
    )


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The repaired conversations in pieces: (conv_id, piece, whole, first_turn, last_turn, n_turns, blank, duplicate, truncated, illegal, cost, audit, roles, texts).

    Rows are taken by turn (nulls first), then role and text digest. A row is blank
    (only white space), a duplicate (role and text seen earlier in the conversation)
    or truncated (the last character that isn't white space is not one of .!?). The
    edits Keep (0), Rerole to user or assistant (1), Delete (2; blank rows and
    duplicates must go) and Insert an empty user or assistant row (5) lead to
    nothing or to an optional system row and pairs of user and assistant, at the
    least cost, a truncated row that stays counting 5 more; of equal costs the audit,
    the edits' initials, is the smallest in ASCII. roles and texts are the repaired
    rows. Pieces of one conversation are in order of `piece`; audit, roles and texts
    put together, counts and costs added up are the conversation's.

    All rows are dealt out in sorted runs, so a conversation of any size is spread
    over tasks; one that ends within a task is repaired there by one lookup in the
    block tables for BLOCK rows, the pieces of others are joined (see joined).

    present: rows for which it is false only say that their conversation is there.
    Null roles and texts count as one blank; a null conv_id is a conversation; rows
    of one turn, role and text are alike, so repeated rows are duplicates; a piece
    has at most piece_rows rows and piece_chars characters (or one row); an empty
    table gives an empty result; other columns aren't read, whatever their names.
    """
    there = F.lit(True) if present is None else present
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"), F.coalesce(there, F.lit(False)).alias("present"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.md5(F.col("text").cast("binary"))]
    # rows alike in all of these may still be many: their place in the input deals them out
    dealt = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    pieces = written(cut(dealt, piece_rows, piece_chars), "cut")
    return pieces.where("whole").unionByName(joined(pieces.where("not whole")))


def summaries(pieces: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each conversation of repair's pieces.

    The digest is of role:text of all repaired rows, newline-joined; the pieces of
    one conversation pass through one task for it, one at a time.
    """
    conv = pieces.schema["conv_id"].dataType.simpleString()
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0).cast("long")).alias("gaps")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole = pieces.where("whole").select("conv_id", gaps, *sums, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parts = pieces.where("not whole").select("conv_id", "piece", "first_turn", "last_turn", "n_turns", *sums, "audit", F.when(F.size("roles") > 0, lines).alias("lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv_type = None, None

        def told() -> pa.RecordBatch:
            key, first, last, n, counts, audit, digest, _ = now
            cells = [key, 0 if first is None else last - first + 1 - n, *counts, "".join(audit), digest.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(cells, [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()], strict=True)], ["conv_id", "gaps", *sums, "audit", "repaired_sha256"])

        for batch in batches:
            conv_type = batch.column(0).type
            for row in batch.to_pylist():
                if now is None or now[0] != row["conv_id"]:
                    if now is not None:
                        yield told()
                    now = [row["conv_id"], None, None, 0, [0] * len(sums), [], sha256(), False]
                if row["first_turn"] is not None:
                    now[1] = row["first_turn"] if now[1] is None else now[1]
                    now[2] = row["last_turn"]
                now[3] += row["n_turns"]
                now[4] = [a + row[s] for a, s in zip(now[4], sums, strict=True)]
                now[5].append(row["audit"])
                if row["lines"] is not None:
                    now[6].update(("\n" * now[7] + row["lines"]).encode("utf-8", "surrogatepass"))
                    now[7] = True
        if now is not None:
            yield told()

    schema = f"conv_id {conv}, gaps long, " + ", ".join(f"{s} long" for s in sums) + ", audit string, repaired_sha256 string"
    streamed = parts.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)
    return whole.unionByName(streamed)


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """Conversation rows, damaged by a digest of conversation and turn, and whether each is still there."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20).alias("harm"))
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    hurt = rows.select("conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (harm != 0).alias("there"), F.explode(F.when(harm == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return hurt, F.col("there")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, there = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return summaries(repair(rows, present=there))


OP13_SQL = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY n) AS t FROM range(256) r(n)),
conv AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
raw AS (
  SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, t, coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s
  FROM conversations c JOIN conv ON c.conv_id IS NOT DISTINCT FROM conv.conv_id, crc
), h AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm FROM raw
), hurt AS (
  SELECT g, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) FROM h WHERE harm <> 0)
), placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM hurt),
r AS (
  SELECT g, turn, role, text, pos, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY pos) || left(role, 1) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '-' END AS fault
  FROM placed
), k AS (
  SELECT *, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS stays, CASE WHEN fault IN ('b', 'd') THEN 1000000 ELSE 0 END AS gone,
         CASE WHEN i = 's' THEN 0 ELSE 1000000 END AS is_s, CASE WHEN i = 'u' THEN 0 ELSE 1000000 END AS is_u, CASE WHEN i = 'a' THEN 0 ELSE 1000000 END AS is_a FROM r
), size AS (SELECT g, (count(*) FILTER (pos IS NOT NULL))::BIGINT AS n FROM conv LEFT JOIN r USING (g) GROUP BY g),
v AS (
  SELECT g, n + 1 AS pos, 0::BIGINT AS c0, 10::BIGINT AS c1, 5::BIGINT AS c2, 0::BIGINT AS c3 FROM size
  UNION ALL
  SELECT g, pos, least(o0, 5 + o2, 10 + o3), least(o1, 5 + o2, 10 + o3), least(o2, 5 + o3), least(o3, 5 + o2)
  FROM (
    SELECT k.g, k.pos, least(2 + c0, 1 + stays + gone + c2, stays + gone + is_s + c1, stays + gone + is_u + c2) AS o0, least(2 + c1, 1 + stays + gone + c2, stays + gone + is_u + c2) AS o1,
           least(2 + c2, 1 + stays + gone + c3, stays + gone + is_a + c3) AS o2, least(2 + c3, 1 + stays + gone + c2, stays + gone + is_u + c2) AS o3
    FROM v JOIN k ON v.g = k.g AND k.pos = v.pos - 1
  )
), w AS (
  SELECT v.g, v.pos, n, [v.c0, v.c1, v.c2, v.c3] AS c, [nxt.c0, nxt.c1, nxt.c2, nxt.c3] AS d, role, text, stays, gone, is_s, is_u, is_a
  FROM v JOIN size ON v.g = size.g LEFT JOIN v AS nxt ON v.g = nxt.g AND nxt.pos = v.pos + 1 LEFT JOIN k ON v.g = k.g AND v.pos = k.pos
), tr AS (
  SELECT g, 1::BIGINT AS pos, 1 AS q, '' AS audit, []::VARCHAR[] AS rows, false AS done FROM size
  UNION ALL
  SELECT g, CASE WHEN e IN ('I', '') THEN pos ELSE pos + 1 END,
         CASE WHEN e IN ('D', '') THEN q WHEN e = 'K' AND is_s = 0 THEN 2 WHEN q = 3 THEN 4 ELSE 3 END, audit || e,
         CASE WHEN e IN ('D', '') THEN rows ELSE list_append(rows, CASE WHEN e = 'K' THEN role WHEN q = 3 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END, e = ''
  FROM (
    SELECT tr.*, role, text, is_s,
           CASE WHEN tr.pos > n THEN CASE WHEN q IN (1, 4) THEN '' ELSE 'I' END
                WHEN c[q] = 2 + d[q] THEN 'D' WHEN c[q] = 5 + c[CASE WHEN q = 3 THEN 4 ELSE 3 END] THEN 'I'
                WHEN (q = 1 AND is_s = 0 AND c[q] = stays + gone + d[2]) OR (q <> 3 AND is_u = 0 AND c[q] = stays + gone + d[3]) OR (q = 3 AND is_a = 0 AND c[q] = stays + gone + d[4]) THEN 'K' ELSE 'R' END AS e
    FROM tr JOIN w ON tr.g = w.g AND tr.pos = w.pos WHERE NOT done
  )
), f AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       v.c0 AS cost, audit, sha256(array_to_string(rows, chr(10))) AS repaired_sha256
FROM conv JOIN tr ON conv.g = tr.g AND done JOIN v ON conv.g = v.g AND v.pos = 1 LEFT JOIN f ON conv.g = f.g
"""
