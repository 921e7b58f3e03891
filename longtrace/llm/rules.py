"""Quality rules: document rules, and host verdicts from shrunken failure rates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.session import written

SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words within a window of `width` words that is found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key, span = ids[:n], len(number)
    for k in range(1, width):
        if span * len(number) >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            span = n
        key, span = key * len(number) + ids[k : n + k], span * len(number)
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    hit = np.zeros(len(words), bool)
    for k in range(width):
        hit[k : n + k] |= twice
    return int(hit.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text or "") - sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def document_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([measures(t.as_py()) for t in b.column(2)], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(got[:, k]) for k in range(5))], ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    picked = docs.select(F.col(id_col).cast("long"), F.coalesce(F.concat(F.lit("h:"), F.col(host_col)), F.lit("none")), F.col(text_col))
    return picked.mapInArrow(run, "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


#: Rules whose failures are counted by host: name -> whether a document fails it. The first two fail the document itself.
RULES = {
    "short": "n_words < {min_words}",
    "repeats": "100 * n_repeat_words > {max_repeat_percent} * n_words",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "dup_lines": "n_dup_lines >= 5",
}
#: A table of so many hosts at most is sent to every task.
BROADCAST_HOSTS = 200_000
#: Beyond that only hosts of over LARGE documents, and over one in LARGE_SHARE of all, which are LARGE_SHARE at most; the rest is shuffled.
LARGE, LARGE_SHARE = 10_000, 50_000
#: The prior counts as so many documents at most: hosts that differ by chance alone are taken as equal.
MOST_STRENGTH = 10_000.0
#: A host is rejected if its rate of a rule is above the mean by more than EXCESS, SIGMAS standard deviations of its own rate allowed for.
EXCESS, SIGMAS = 0.25, 2.0


def host_verdicts(judged: DataFrame) -> DataFrame:
    """(host, n, rates, rejected): a host's failures of each rule, shrunk to the mean of all documents.

    The beta prior of a rule comes from beta-binomial moments weighted by the
    hosts' documents: the correlation within hosts is the spread of host rates
    beyond what chance gives hosts of these sizes, so many one-document hosts tell
    nothing of it and leave the prior at MOST_STRENGTH. Only the rules' sums come to
    the driver.
    """
    hosts = written(judged.groupBy("host").agg(F.count("*").alias("n"), *(F.sum(F.col(f"fails_{r}").cast("long")).alias(f"f_{r}") for r in RULES)), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("k"), *(F.sum(f"f_{r}").alias(f"f_{r}") for r in RULES)).first()
    n, k = total.n or 0, total.k
    means = {r: (total[f"f_{r}"] or 0) / max(n, 1) for r in RULES}
    spreads = hosts.agg(*(F.sum(F.col("n") * (F.col(f"f_{r}") / F.col("n") - means[r]) ** 2).alias(r) for r in RULES)).first()
    free = n - (total.nn or 0) / max(n, 1) - (k - 1)
    rates, bad = [], F.lit(False)
    for r, m in means.items():
        within = ((spreads[r] or 0.0) / (m * (1 - m)) - (k - 1)) / free if free > 0 and 0 < m < 1 else 0.0
        strength = min(MOST_STRENGTH, max(0.0, 1 / within - 1)) if within > 0 else MOST_STRENGTH
        rate = (F.col(f"f_{r}") + m * strength) / (F.col("n") + strength)
        rates.append(rate.alias(r))
        bad = bad | (rate - SIGMAS * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1)) > m + EXCESS)
    return hosts.select("host", "n", F.struct(*rates).alias("rates"), bad.alias("rejected"))


def with_verdicts(judged: DataFrame) -> DataFrame:
    """judged with its host's rates and rejected; a hot host never goes through one task."""
    found = host_verdicts(judged)
    told = found.drop("n")
    if found.count() <= BROADCAST_HOSTS:
        return judged.join(F.broadcast(told), "host")
    most = max(LARGE, judged.count() // LARGE_SHARE)
    large = F.broadcast(found.where(F.col("n") > most).drop("n"))
    small = judged.join(large.select("host"), "host", "left_anti").join(found.where(F.col("n") <= most).drop("n"), "host")
    return judged.join(large, "host").unionByName(small)


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rates, host_rejected, kept), a row for each row of docs.

    A document fails the base rules with fewer than min_words words or more than
    max_repeat_percent percent of its words in repeated three-word windows. It is
    kept if it passes and its host isn't rejected (host_verdicts). Null and empty
    texts have no words and fail; documents without a host form one host; a very
    long text is measured whole; null ids, ties and repeated rows are kept as rows;
    an empty table gives an empty result; other columns aren't read.
    """
    measured = document_measures(docs, id_col, text_col, host_col)
    fails = {r: F.expr(rule.format(min_words=min_words, max_repeat_percent=max_repeat_percent)) for r, rule in RULES.items()}
    judged = written(measured.withColumns({f"fails_{r}": f for r, f in fails.items()} | {"base_failed": fails["short"] | fails["repeats"]}), "measures")
    rated = with_verdicts(judged)
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rates").alias("host_rates"), F.col("rejected").alias("host_rejected"), (~F.col("base_failed") & ~F.col("rejected")).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("host_rates", "host_rejected")


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2)
), rep AS (
  SELECT doc_id, count(DISTINCT k) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS l FROM t) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT t.doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)
), j AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats, 100 * n_symbols > 5 * word_chars AS symbols, n_dup_lines >= 5 AS dup_lines FROM m
), l AS (
  SELECT source, u.rule AS rule, u.failed::BIGINT AS failed
  FROM (SELECT source, unnest([{'rule': 'short', 'failed': short}, {'rule': 'repeats', 'failed': repeats}, {'rule': 'symbols', 'failed': symbols}, {'rule': 'dup_lines', 'failed': dup_lines}]) AS u FROM j)
), h AS (SELECT source, rule, count(*)::DOUBLE AS n, sum(failed)::DOUBLE AS f FROM l GROUP BY source, rule),
p AS (SELECT rule, sum(f) / sum(n) AS m, sum(n) AS n, sum(n * n) AS nn, count(*) AS k FROM h GROUP BY rule),
x AS (
  SELECT p.rule, p.m, CASE WHEN p.n - p.nn / p.n - (p.k - 1) > 0 AND p.m > 0 AND p.m < 1
    THEN (sum(h.n * (h.f / h.n - p.m) ** 2) / (p.m * (1 - p.m)) - (p.k - 1)) / (p.n - p.nn / p.n - (p.k - 1)) ELSE 0 END AS w
  FROM h JOIN p ON h.rule = p.rule GROUP BY p.rule, p.m, p.n, p.nn, p.k
),
s AS (SELECT rule, m, CASE WHEN w > 0 THEN least(10000, greatest(0, 1 / w - 1)) ELSE 10000 END AS strength FROM x),
r AS (SELECT source, m, n + strength AS size, (f + m * strength) / (n + strength) AS rate FROM h JOIN s ON h.rule = s.rule),
v AS (SELECT source, bool_or(rate - 2 * sqrt(rate * (1 - rate) / (size + 1)) > m + 0.25) AS rejected FROM r GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed, NOT (short OR repeats) AND NOT rejected AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""
