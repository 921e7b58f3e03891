"""Carried windows: any chunk gives what one window over the key gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from longtrace.functions.carry import carried
from longtrace.functions.few import with_each
from longtrace.functions.groups import connected_groups
from longtrace.operators import aggregates, grid

UP, DOWN = Window.unboundedPreceding, Window.unboundedFollowing


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(k, t, i, rng.choice([None, rng.randint(-9, 9)])) for k in ("a", "b", "c") for i, t in enumerate(sorted(rng.randint(0, 400) for _ in range({"a": 120, "b": 3, "c": 1}[k])))]
    return spark.createDataFrame(data, "k string, t long, i long, v long").cache()


def both(rows, chunk):
    v = F.col("v")
    got = carried(rows, ["k"], "t", chunk, ["i"], lag={"l": v, "lt": F.col("t")}, lead={"n": v}, total={"s": v, "one": F.lit(1)}, top={"m": v}, before={"b": v}, after={"a": v})
    w = Window.partitionBy("k").orderBy("t", "i")
    want = rows.select(
        "k", "t", "i", "v", F.lag("v").over(w).alias("l"), F.lag("t").over(w).alias("lt"), F.lead("v").over(w).alias("n"),
        F.sum(F.coalesce("v", F.lit(0))).over(w.rowsBetween(UP, 0)).alias("s"), F.row_number().over(w).cast("long").alias("one"), F.max("v").over(w.rowsBetween(UP, -1)).alias("m"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(UP, 0)).alias("b"), F.first("v", ignorenulls=True).over(w.rowsBetween(0, DOWN)).alias("a"),
    )
    return got, want


@pytest.mark.parametrize("chunk", [1, 7, 50, 1000])
def test_any_chunk(rows, chunk):
    got, want = both(rows, chunk)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_one_key_is_many_tasks(spark):
    one = spark.range(5000).select(F.lit("x").alias("k"), F.col("id").alias("t"), (F.col("id") * 7 % 101).alias("v"))
    got = carried(one, ["k"], "t", 100, lag={"l": F.col("v")}, total={"s": F.col("v")})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        most = got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert most < 2500
    assert got.agg(F.sum("s")).first()[0] == sum(s for s in __import__("itertools").accumulate(i * 7 % 101 for i in range(5000)))


def test_empty(rows):
    assert both(rows.limit(0), 7)[0].collect() == []


def test_connected_groups(spark):
    rng = random.Random(8)
    links = [(k, k + 1) for k in range(100, 160)] + [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(25)] + [(7, 7), (None, 3)]
    root = {x: x for ab in links for x in ab if None not in ab}
    for _ in root:
        for a, b in links:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = connected_groups(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, got.collect())) == root
    assert connected_groups(spark.createDataFrame([], "a string, b string")).collect() == []


@pytest.mark.parametrize("most", [1, 3, 100])
def test_with_each_row(spark, most):
    left, few = spark.range(20).withColumnRenamed("id", "a"), spark.range(7).select(F.col("id").alias("b"), (F.col("id") * 2).alias("c"))
    got = with_each(left, few, most)
    assert sorted(map(tuple, got.collect())) == [(a, b, 2 * b) for a in range(20) for b in range(7)]
    assert ("BroadcastNestedLoopJoin" in got._jdf.queryExecution().executedPlan().toString()) == (most > 7)
    assert with_each(left, few.limit(0), most).collect() == [] and with_each(left.limit(0), few, most).collect() == []


def test_templates_and_sites_in_blocks(spark):
    rng = random.Random(5)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(4)] if k else [0.0] * 4, rng.randint(0, 5), rng.randint(0, 5)) for k in range(12)]
    df = spark.createDataFrame(rows, "k long, v array<double>, x int, y int")
    told = lambda d: sorted(tuple(r) for r in d.collect())
    assert told(aggregates.template_similarity(df, "k", "v", 9).fillna(9)) == told(aggregates.template_similarity(df, "k", "v").fillna(9))
    near = told(grid.nearest_channels(df, "k", "x", "y", 5, 2))
    assert near == told(grid.nearest_channels(df, "k", "x", "y", 5)) and len(near) == 60
