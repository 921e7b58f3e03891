"""License scans: word k-grams joined to templates, votes by offset diagonal, neighbouring diagonals merged, spans verified."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from longtrace.llm.lines import text_key
from longtrace.session import written

#: Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
#: Notices that are found though some of their words differ, and their labels.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Words in a gram; a shorter template is one gram.
GRAM = 3
#: Diagonals at most so many words apart are one span.
SHIFT = 3
#: A span counts if so much of its template stands in it, over at most STRETCH times the template's words.
MIN_SHARE, STRETCH = 0.75, 2.0
#: So many template grams at most are sent to the tasks at once; more go in blocks.
BLOCK_GRAMS = 200_000


#: A run of digits, ASCII letters and non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def word_list(text: Column) -> Column:
    """The words as they are written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lowered(word: Column) -> Column:
    """A word with A-Z in lower case."""
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rolling(hashes: Column, n: Column, width: int) -> Column:
    """A hash of each `width` consecutive word hashes, in order."""
    one = lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(width)))
    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), one)).otherwise(F.array().cast("array<long>"))


def template_table(spark: SparkSession, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """(label, text, exact) of the phrases and notices."""
    rows = [F.struct(F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(exact).alias("exact")) for texts, exact in ((phrases, True), (notices, False)) for label, text in texts]
    return spark.range(1).select(F.inline(F.array(*rows)))


def template_grams(templates: DataFrame, gram: int) -> DataFrame:
    """(template, label, exact, size, k, j, gram, hash): each template's grams and their places; template: a hash of the row."""
    t = templates.select(F.xxhash64("label", "text", "exact").alias("template"), "label", "exact", F.transform(word_list(F.col("text")), lowered).alias("w")).distinct()
    t = t.where(F.size("w") > 0).withColumn("size", F.size("w")).withColumn("k", F.least(F.size("w"), F.lit(gram)))
    at = t.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))).alias("j"))
    at = at.withColumn("gram", F.slice("w", F.col("j") + 1, F.col("k"))).drop("w")
    hashed = F.transform("gram", lambda x: F.xxhash64(F.lower(x)))
    by_width = F.coalesce(*(F.when(F.col("k") == k, F.xxhash64(*(F.get(hashed, F.lit(j)) for j in range(k)))) for k in range(1, gram + 1)))
    return at.withColumn("hash", by_width)


def votes(docs: DataFrame, templates: DataFrame, id_col: str, text_col: str, gram: int, block_grams: int) -> DataFrame:
    """(id, digest, template, label, exact, size, k, diagonal, js): the template places that each diagonal of a document and template has grams at.

    Every rolling gram of every document meets the templates' grams by hash and is
    then compared word by word. A diagonal is a document place less a template
    place. Templates beyond block_grams grams are joined block by block.
    """
    grams = template_grams(templates, gram)
    counts = {r.k: r.n for r in grams.groupBy("k").agg(F.count("*").alias("n")).collect()}
    widths = sorted(counts)
    key = text_key(id_col, text_col)
    listed = docs.select(key.alias("key"), word_list(F.col(f"`{text_col}`")).alias("w")).withColumn("n", F.size("w"))
    # lower() also changes some letters that aren't A-Z; the comparison of words doesn't
    listed = listed.withColumn("h", F.transform("w", lambda x: F.xxhash64(F.lower(x))))
    listed = listed.withColumn("all", F.flatten(F.array(*(rolling(F.col("h"), F.col("n"), k) for k in widths))) if widths else F.array().cast("array<long>"))
    # outer: an inner explode has Spark compute the array once more to see whether it is empty
    spread = listed.select("key", "w", "n", F.posexplode_outer("all").alias("p", "hash"))
    at, begun = F.lit(None).cast("int"), F.lit(0)
    for k in widths:
        end = begun + F.greatest(F.col("n") - (k - 1), F.lit(0))
        here = (F.col("p") >= begun) & (F.col("p") < end)
        at = F.when(here, F.col("p") - begun).otherwise(at)
        begun = end
    n_blocks = max(1, -(-sum(counts.values()) // block_grams))
    found = None
    for block in range(n_blocks):
        part = grams.where(F.pmod(F.xxhash64("template", "j"), F.lit(n_blocks)) == block)
        joined = spread.join(F.broadcast(part), "hash").withColumn("i", at)
        # word by word, not with transform(): that would be left out of the generated code, and the words be copied for each gram
        same = F.lit(True)
        for j in range(gram):
            same = same & ((F.col("k") <= j) | (lowered(F.get("w", F.col("i") + j)) == F.get("gram", F.lit(j))))
        hits = joined.where(same).select("key.id", F.col("key.text").alias("digest"), "template", "label", "exact", "size", "k", (F.col("i") - F.col("j")).alias("diagonal"), "j")
        found = hits if found is None else found.union(hits)
    return found.groupBy("id", "digest", "template", "label", "exact", "size", "k", "diagonal").agg(F.collect_set("j").alias("js"))


def license_spans(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, shift: int = SHIFT, min_share: float = MIN_SHARE, stretch: float = STRETCH, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """(id, digest, template, label, exact, first, last, share): the spans of words, `last` included, in which a template stands.

    exact templates (phrases) need all their words on one diagonal. Of the others,
    diagonals at most `shift` words from the next one are merged, so a word put in
    or left out does not end a span; a span counts if at least min_share of the
    template's words stand in it, over at most stretch times their number.
    """
    found = written(votes(docs, template_table(docs.sparkSession) if templates is None else templates, id_col, text_col, gram, block_grams), "votes")
    keys = ["id", "digest", "template", "label", "exact", "size", "k"]
    whole = found.where(F.col("exact") & (F.size("js") == F.col("size") - F.col("k") + 1))
    phrases = whole.select("id", "digest", "template", "label", "exact", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("size") - 1).alias("last"), F.lit(1.0).alias("share"))
    order = Window.partitionBy("id", "digest", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > shift, F.lit(True))
    marked = found.where(~F.col("exact")).withColumn("apart", apart.cast("long"))
    banded = marked.withColumn("band", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    span = banded.groupBy(*keys, "band").agg(
        F.array_distinct(F.flatten(F.collect_list("js"))).alias("js"),
        F.min(F.col("diagonal") + F.array_min("js")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("js") + F.col("k") - 1).alias("last"),
    )
    covered = F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + F.col("k") - 1))))
    span = span.withColumn("share", F.size(covered) / F.col("size"))
    kept = span.where((F.col("share") >= min_share) & (F.col("last") - F.col("first") + 1 <= stretch * F.col("size")))
    return phrases.union(kept.select("id", "digest", "template", "label", "exact", "first", "last", "share"))


def license_scan(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row for each row of docs.

    n_base counts the places of exact templates, first_word and last_word are their
    smallest and largest start (null if there is none), base_labels their labels,
    labels those of the verified spans too; both are distinct, sorted and
    comma-joined, empty if there is none. score is the largest share of a template
    found, 0 without one. options: those of license_spans.

    Null and empty texts have no words and no labels; a very long text is cut into
    grams in one task, and what is found of it is dealt by document and template;
    null ids are kept, of any type; repeated rows share what is found; an empty
    table gives an empty result and an empty template table no labels; other
    columns aren't read, whatever their names.
    """
    spans = license_spans(docs, templates, id_col, text_col, **options)
    base = F.when(F.col("exact"), F.col("first"))
    found = spans.groupBy(F.struct("id", F.col("digest").alias("text")).alias("found")).agg(
        F.count(base).alias("n_base"),
        F.min(base).cast("long").alias("first_word"),
        F.max(base).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_key(id_col, text_col).alias("key"), F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    joined = rows.join(found, F.col("key").eqNullSafe(F.col("found")), "left")
    joined_labels = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return joined.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word", joined_labels("base_labels").alias("base_labels"), joined_labels("labels").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_VALUES = ", ".join(f"('{label}', '{text}', {exact})" for texts, exact in ((PHRASES, "true"), (NOTICES, "false")) for label, text in texts)
_WORDS = r"regexp_extract_all(translate(coalesce(%s, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH tv(label, x, exact) AS (VALUES {_VALUES}),
t AS (SELECT row_number() OVER () AS template, label, exact, w, len(w) AS size, least(3, len(w)) AS k FROM (SELECT label, exact, {_WORDS % "x"} AS w FROM tv)),
tg AS (SELECT template, label, exact, size, k, j, array_to_string(w[j + 1:j + k], ' ') AS g FROM (SELECT *, unnest(range(0, size - k + 1)) AS j FROM t)),
d AS (SELECT doc_id, {_WORDS % "text"} AS w FROM documents),
dg AS (
  SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)
), hit AS (SELECT doc_id, template, label, exact, size, tg.k AS k, i - j AS diagonal, i, j FROM dg JOIN tg ON dg.g = tg.g AND dg.k = tg.k),
base AS (
  SELECT doc_id, label, diagonal FROM hit WHERE exact GROUP BY doc_id, template, label, size, k, diagonal HAVING count(*) = size - k + 1
), mark AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS band
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 3 THEN 0 ELSE 1 END AS apart
        FROM (SELECT DISTINCT doc_id, template, diagonal FROM hit WHERE NOT exact))
), cov AS (
  SELECT doc_id, template, label, size, band, i, k, unnest(range(j, j + k)) AS place FROM hit JOIN mark USING (doc_id, template, diagonal)
), span AS (
  SELECT doc_id, label, count(DISTINCT place) / size AS share FROM cov GROUP BY doc_id, template, label, size, band
  HAVING count(DISTINCT place) / size >= 0.75 AND max(i + k) - min(i) <= 2 * size
), b AS (
  SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM base GROUP BY doc_id
), l AS (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM (SELECT doc_id, label, 1.0::DOUBLE AS share FROM base UNION ALL SELECT doc_id, label, share FROM span) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""
