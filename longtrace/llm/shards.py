"""Sharding by a two-pass external shuffle: seeded scatter into buckets, then Fisher-Yates in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from longtrace.llm.lines import free_name
from longtrace.session import written

#: A bucket is meant to hold so many bytes and so many records: it is shuffled in one task's memory.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 1024
#: Rows equal in id and text are scattered by their number if there are more of them than this share of a bucket's rows.
HOT_SHARE = 0.25
#: Running sums over bucket counts are taken within blocks of so many buckets.
BLOCK = 4096


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def scattered(rows: DataFrame, buckets: int, seed: int, most: float) -> DataFrame:
    """Pass one: (bucket, record, size, order) of rows (record, size, key, order): every record to a bucket by a seeded hash of its key.

    Keys that over `most` rows share are numbered first: their rows, counted as
    whole records within each task before they meet, take part in the hash by their
    number, so that no bucket grows with the copies of one row.
    """
    to = lambda *more: F.pmod(F.xxhash64(F.lit(seed), "key", *more), F.lit(buckets)).alias("bucket")
    plain = rows.select(to(), "record", "size", "order")
    crowded = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key")
    if crowded.isEmpty():
        return plain
    crowded = written(crowded, "crowded")  # at most rows / most keys
    rest = rows.join(crowded, "key", "left_anti").select(to(), "record", "size", "order")
    copies = rows.join(crowded, "key", "left_semi").groupBy("key", "record", "size", "order").agg(F.count("*").alias("n"))
    numbered = copies.select("key", "record", "size", "order", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return rest.unionByName(numbered.select(to("copy", "order"), "record", "size", F.struct(F.xxhash64("order", "copy").alias("a"), F.col("order.b").alias("b")).alias("order")))


def fisher_yates(rows: Column, seed: Column) -> Column:
    """rows in random order: for k = 0, 1, ... the k-th place takes over what a place drawn from 0..k holds, and that one takes the k-th row.

    The draws are hashes of seed and k, so the order depends on them and on rows
    alone, not on tasks, partitions or attempts.
    """

    def draws(last: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(k.alias("k"), F.pmod(F.xxhash64(seed, k), k + 1).cast("int").alias("j")))

    def step(order: Column, d: Column) -> Column:
        swapped = F.concat(F.slice(order, F.lit(1), d["j"]), F.array(d["k"]), F.slice(order, d["j"] + 2, d["k"]), F.array(F.get(order, d["j"])))
        return F.when(d["j"] == d["k"], F.concat(order, F.array(d["k"]))).otherwise(swapped)

    def mixed(rows: Column) -> Column:
        order = F.aggregate(draws(F.size(rows) - 1), F.array().cast("array<int>"), step)
        return F.when(F.size(rows) == 0, rows).otherwise(F.transform(order, lambda i: F.get(rows, i)))

    return F.get(F.transform(F.array(rows), mixed), F.lit(0))  # as a lambda's variable rows is worked out once


def starts_of(counts: DataFrame) -> DataFrame:
    """(bucket, start): records in smaller buckets; running sums within blocks of buckets, then over blocks."""
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    before = lambda key: Window.partitionBy(*key).orderBy("block" if not key else "bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(before([])), F.lit(0)).alias("from"))
    inner = blocks.select("bucket", "block", F.coalesce(F.sum("n").over(before(["block"])), F.lit(0)).alias("within"))
    return inner.join(totals, "block").select("bucket", (F.col("from") + F.col("within")).alias("start"))


def sharded(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 20, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(record, size, shard, slot): docs' rows, whole, as `record`, in one random order dealt over n_shards.

    Records are scattered uniformly over buckets by a seeded hash of id and text;
    the number of buckets follows from the table's bytes and rows, so that one fits
    a task. Each bucket is put in hash order and shuffled by Fisher-Yates, seeded by
    its number, so a record's place depends on the table and the seed alone, not on
    partitions or attempts. The order over all records is bucket by bucket: shard
    and slot of a record are its place in it modulo and divided by n_shards, so the
    shards' record counts differ by one at most and slots have no gaps. Where a
    bucket starts is the running sum of the buckets' row counts, a small table
    joined to whole buckets; records cross the network once.

    Rows equal in id and text share a bucket unless they are many; then each is
    scattered by its number. Rows equal in all columns are the same in any order.
    Null ids and texts hash as such and stay; a very long text is one record; an
    empty table gives no rows; other columns ride along in `record`, whatever their
    names (map columns take no part in the order).
    """
    total, n = docs.agg(F.sum(record_bytes(F.col(f"`{text_col}`"))), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes), -(-n // bucket_rows))
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(F.xxhash64(F.lit(seed + 1), *hashable).alias("a"), F.xxhash64(F.lit(seed + 2), *hashable).alias("b"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"), record_bytes(F.col(f"`{text_col}`")).alias("size"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"), order.alias("order"))
    placed = scattered(rows, buckets, seed, max(16.0, HOT_SHARE * n / buckets))
    starts = starts_of(placed.groupBy("bucket").agg(F.count("*").alias("n"))).withColumnRenamed("bucket", "b")
    full = placed.repartition(min(buckets, 1 << 17), "bucket").groupBy("bucket").agg(F.collect_list(F.struct("order", "size", "record")).alias("rows"))
    first = lambda x, y: F.when(x["order"] < y["order"], -1).when(x["order"] > y["order"], 1).otherwise(0)
    mixed = full.join(starts, F.col("bucket") == F.col("b")).select("start", F.posexplode(fisher_yates(F.array_sort("rows", first), F.struct(F.lit(seed), F.col("bucket")))).alias("place", "x"))
    at = F.col("start") + F.col("place")
    return mixed.select("x.record", "x.size", F.pmod(at, F.lit(n_shards)).cast("int").alias("shard"), F.expr(f"(start + place) div {n_shards}").alias("slot"))


def write_shards(rows: DataFrame, path: str, file_rows: int = 100_000) -> None:
    """One folder per shard; files of file_rows records at most, each in slot order.

    Adds the columns shard and slot, behind underscores where the records have such.
    """
    taken = rows.schema["record"].dataType.names
    shard, slot = free_name("shard", taken), free_name("slot", taken)
    part = F.expr(f"slot div {file_rows}")
    flat = rows.repartition("shard", part).sortWithinPartitions("shard", "slot").select("record.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    flat.write.option("maxRecordsPerFile", file_rows).partitionBy(shard).parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
    return rows.select(F.col("record.doc_id").alias("doc_id"), "size", F.crc32(F.coalesce("record.text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
