"""Five corpus stages over documents, each written as Parquet and read again.

All stages take documents with any further columns, whatever their names, and
return the same columns. Null and empty texts, null ids, ties, repeated rows and
empty tables have the result that each stage's docstring states; very long texts
are handled whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtrace.llm import decontam, lines, pieces, quality, similar
from longtrace.session import written

#: Documents scored lower are rejected.
MIN_SCORE = 0.5


def _nested(docs: DataFrame) -> DataFrame:
    """(row, key) of docs: whole rows, told apart by id and text digest, out of the way of other columns."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), lines.text_key("doc_id", "text").alias("key"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, trained on the given labels, scores at MIN_SCORE or more.

    Every row is judged by itself, so repeated rows share their fate; null and empty
    texts are judged by their structure alone, which labels of such texts decide.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = tuple(c for c in docs.columns if c != "doc_id")
    scored = quality.scores(docs, quality.train(docs, labels), keep=rest)
    score = lines.free_name("score", docs.columns)
    return scored.where(F.col(score) >= MIN_SCORE).select(*(F.col(f"`{c}`") for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without multi-line chunks that occur earlier; n_chars follows the text.

    Null texts stay null, and so does their n_chars; rows equal in id and text keep
    the same lines; a text may become empty, and the document stays.
    """
    cut = lines.without_repeats(docs).select(*(F.col(f"`{c}`") for c in docs.columns))
    return cut.withColumn("n_chars", F.char_length("text").cast("long"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word Jaccard 0.8 or more) one document.

    It is the one of smallest id, then text digest; null ids come last. Of rows equal
    in id and text the one stays whose other columns come first as JSON. Null, empty
    and wordless texts are one group.
    """
    first = similar.near_copies(docs).where("first").select("doc_id", "digest").distinct()
    same = F.col("key.id").cast("long").eqNullSafe(F.col("doc_id")) & F.col("key.text").eqNullSafe(F.col("digest"))
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    one = F.min_by("row", F.to_json(F.struct(*rest)) if rest else F.lit(0))
    return _nested(docs).join(first, same, "left_semi").groupBy("key").agg(one.alias("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item.

    Rows are told apart by id and text digest; null and empty texts have no words
    and stay.
    """
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _nested(docs)
    keyed = rows.select("key", F.col("row").getField("text").alias("text"))
    hit = decontam.contamination(keyed, tests, id_col="key").where("contaminated").select(F.col("doc_id.id").alias("id"), F.col("doc_id.text").alias("digest")).distinct()
    same = F.col("key.id").eqNullSafe(F.col("id")) & F.col("key.text").eqNullSafe(F.col("digest"))
    return rows.join(hit, same, "left_anti").select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of ids, spans and decoded text; null and empty texts have no tokens."""
    import public_tokenizers

    return pieces.round_trip(docs, pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model")), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: A trained model and a tokenizer can't be told in SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
