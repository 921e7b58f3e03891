import numpy as np
from pyspark.sql import functions as F

from longtrace.llm import quality


def test_sum_of_squares_identity():
    rnd = np.random.default_rng(0)
    m = quality.Machine(0.3, rnd.normal(size=quality.PLACES), rnd.normal(size=(quality.PLACES, 4)))
    place, value = rnd.choice(quality.PLACES, 9, replace=False), rnd.normal(size=9)
    slow = 0.3 + (m.w[place] * value).sum() + sum(m.v[place[i]] @ m.v[place[j]] * value[i] * value[j] for i in range(9) for j in range(i))
    assert np.allclose(m.raw(place, value, np.array([0])), slow)


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    got = quality.op9_quality_classifier(spark, path)
    judged = got.where("held_out").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").select("score", "predicted", "quality").toPandas()
    good, bad = judged[judged.quality == 1].score, judged[judged.quality == 0].score
    auc = np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])
    print("auc", auc, "accuracy", (judged.predicted == judged.quality).mean(), "kept good", (good >= 0.5).mean(), "kept bad", (bad >= 0.5).mean())
    assert auc > 0.9
    assert (good >= 0.5).mean() > 0.97


def test_edges(spark):
    rows = [(1, "good words here", 15, 3.0), (1, "good words here", 15, 3.0), (2, None, None, 1.0), (3, "", 0, 1.0), (None, "x " * 50000, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, quality int")
    m = quality.train(docs, labels)
    got = quality.scores(docs, m)
    assert got.count() == 5 and got.where("score between 0 and 1").count() == 5
    assert quality.scores(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0
    assert docs.select(quality.held_out()).where(F.col("coalesce(((crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3) = 1), false)").isNull()).count() == 0
