"""Templates of classes and the four ways to assign points to them (inventory F14 and G21)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtrace.plans.standins import Book
from longtrace.session import written

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
#: So many numbers of templates are sent to every task at once; more go block by block.
BLOCK_NUMBERS = 1 << 20
#: The same for classified points; distances from some points to all of a block are a table of at most so many numbers.
NEIGHBOUR_NUMBERS = TABLE = 1 << 22


def against(points: DataFrame, classes: DataFrame, key: str, numbers: int, found: Callable[[Column], Column], block: int = BLOCK_NUMBERS) -> DataFrame:
    """points with `best`: the least of found(class) over all classes, a struct that sorts. numbers: how many a class holds.

    Classes are counted first; blocks of at most about `block` numbers are sent to
    every task as one row each, and the least so far goes on from block to block.
    """
    n = max(1, -(-classes.count() * numbers // block))
    rows = points.withColumn("best", F.lit(None))
    for k in range(n):
        listed = classes.where(F.pmod(F.xxhash64(key), F.lit(n)) == k).agg(F.collect_list(F.struct(*classes.columns)).alias("_classes"))
        here = F.array_min(F.transform("_classes", found))
        rows = rows.join(F.broadcast(listed), F.lit(True)).withColumn("best", here if k == 0 else F.least("best", here)).drop("_classes")
    return rows


def partial_moments(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, n, s, q): rows, sums and sums of products of the vectors of each class, a row for each class and task."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for name, x in pdf.groupby("label")["v"]:
                x = np.stack(x.to_list()).astype(float)
                n, s, q = held.get(name, (0, 0.0, 0.0))
                held[name] = (n + len(x), s + x.sum(0), q + x.T @ x)
        yield pd.DataFrame([(name, n, s, q.reshape(-1)) for name, (n, s, q) in held.items()], columns=["label", "n", "s", "q"])

    kind = df.schema[label].dataType.simpleString()
    rows = df.select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")).where("label is not null and v is not null")
    return rows.mapInPandas(sums, f"label {kind}, n long, s array<double>, q array<double>")


def class_templates(df: DataFrame, label: str, vector: str, ridge: float = 0.0) -> DataFrame:
    """(label, n, mean, sd, distance_sd, inverse, logdet) of each class's vectors.

    sd: of each item; distance_sd: the root of the items' variances together, the
    spread of distances from the mean; inverse and logdet: of the covariance (n - 1),
    row by row, with ridge added to its diagonal, NULL where it can't be inverted. Each
    task first sums its own rows' products, so a class takes a row from each task.
    Vectors are of one length; rows without a label or vector are left out.
    """
    kind = df.schema[label].dataType.simpleString()

    def finished(pdf: pd.DataFrame) -> pd.DataFrame:
        n, s, q = int(pdf["n"].sum()), pdf["s"].sum(), pdf["q"].sum()
        d, mean = len(s), s / n
        spread = np.maximum(q.reshape(d, d) - n * np.outer(mean, mean), -np.inf)
        var = np.maximum(np.diag(spread), 0) / n
        inverse = logdet = None
        if n > 1:
            cov = spread / (n - 1) + ridge * np.eye(d)
            sign, size = np.linalg.slogdet(cov)
            if sign > 0 and np.linalg.cond(cov) < 1e12:
                inverse, logdet = np.linalg.inv(cov).reshape(-1), float(size)
        return pd.DataFrame([(pdf["label"].iloc[0], n, mean, np.sqrt(var), float(np.sqrt(var.sum())), inverse, logdet)], columns=["label", "n", "mean", "sd", "distance_sd", "inverse", "logdet"])

    return partial_moments(df, label, vector).groupBy("label").applyInPandas(finished, f"label {kind}, n long, mean array<double>, sd array<double>, distance_sd double, inverse array<double>, logdet double")


def _difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: p - q)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)


def _form(d: Column, inverse: Column, size: int) -> Column:
    """d' inverse d."""
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.get(d, i) * _dot(F.slice(inverse, i * size + 1, F.lit(size)), d)), F.lit(0.0), lambda s, x: s + x)


def by_centre(points: DataFrame, vector: str, templates: DataFrame, size: int, sdnum: float, block: int = BLOCK_NUMBERS) -> DataFrame:
    """points with `cluster`, the class of the nearest mean among those within sdnum of their distance_sd, NULL if there is none, and `distance`."""
    x = F.col(vector)

    def found(c: Column) -> Column:
        far = F.sqrt(_dot(_difference(x, c["mean"]), _difference(x, c["mean"])))
        return F.when(far < sdnum * c["distance_sd"], F.struct(far.alias("distance"), c["label"].alias("label")))

    return _told(against(points, templates.select("label", "mean", "distance_sd"), "label", size, found, block), "distance")


def by_mahalanobis(points: DataFrame, vector: str, templates: DataFrame, typical: DataFrame, size: int, sdnum: float, block: int = BLOCK_NUMBERS) -> DataFrame:
    """points with `cluster`, the class of the least Mahalanobis distance, NULL if that isn't below sdnum times the class's typical one, and `distance` (its square); typical: (label, typical)."""
    x = F.col(vector)
    form = lambda c: _form(_difference(x, c["mean"]), c["inverse"], size)
    classes = templates.where("inverse is not null").join(typical, "label").select("label", "mean", "inverse", "typical")
    best = against(points, classes, "label", size * size, lambda c: F.struct(form(c).alias("distance"), c["label"].alias("label"), c["typical"].alias("typical")), block)
    near = F.sqrt("best.distance") < sdnum * F.col("best.typical")
    return best.select(*points.columns, F.when(near, F.col("best.label")).alias("cluster"), F.col("best.distance").alias("distance"))


def typical_distances(df: DataFrame, label: str, vector: str, templates: DataFrame, size: int) -> DataFrame:
    """(label, typical): the root of the mean squared Mahalanobis distance of a class's own points."""
    own = df.select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")).join(templates.where("inverse is not null").select("label", "mean", "inverse"), "label")
    return own.groupBy("label").agg(F.sqrt(F.avg(_form(_difference(F.col("v"), F.col("mean")), F.col("inverse"), size))).alias("typical"))


def by_likelihood(points: DataFrame, vector: str, templates: DataFrame, size: int, block: int = BLOCK_NUMBERS) -> DataFrame:
    """points with `cluster`, the class whose normal distribution is likeliest to give the point, and `distance`, its squared distance and log determinant together."""
    x = F.col(vector)
    cost = lambda c: _form(_difference(x, c["mean"]), c["inverse"], size) + c["logdet"]
    classes = templates.where("inverse is not null").select("label", "mean", "inverse", "logdet")
    return _told(against(points, classes, "label", size * size, lambda c: F.struct(cost(c).alias("distance"), c["label"].alias("label")), block), "distance")


def _told(best: DataFrame, name: str) -> DataFrame:
    return best.select(*(c for c in best.columns if c != "best"), F.col("best.label").alias("cluster"), F.col(f"best.{name}").alias(name))


def by_neighbours(points: DataFrame, vector: str, classified: DataFrame, label: str, class_vector: str, k: int, k_min: int, sdnum: float, block: int = NEIGHBOUR_NUMBERS) -> DataFrame:
    """points with `cluster`: the commonest class (of equally common ones the smallest) of the k nearest classified points, if k_min of these have it, else NULL; `votes` are those that have it.

    Neighbours lie within sdnum times the spread of all classified points (the root of
    their items' variances together). Points with equal vectors are judged once, and of
    equal classified points k at most are kept. These are taken in blocks of at most
    `block` numbers, each sent to all tasks; a point carries its k nearest from block to
    block, so no task holds more than a block.
    """
    kind = classified.schema[label].dataType.simpleString()
    rows = classified.select(F.col(label).alias("label"), F.col(class_vector).cast("array<double>").alias("v")).where("label is not null and v is not null")
    moments = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("var"), F.count("*").alias("n")).agg(F.sum("var").alias("var"), F.count("*").alias("d")).first()
    radius = sdnum * float(np.sqrt(moments["var"] or 0.0))
    distinct = written(rows.groupBy("label", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times")), "classified")
    n = max(1, -(-distinct.count() * (moments["d"] or 1) // block))
    numbered = written(distinct.withColumn("_b", F.pmod(F.xxhash64("v", "label"), F.lit(n))), "blocks")
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: few bytes are much work here
    state = points.select(F.col(vector).cast("array<double>").alias("_v")).repartition(tasks, "_v").distinct().withColumn("_near", F.array().cast(f"array<struct<d:double,label:{kind}>>"))

    def nearer(names: list, times: list, x: np.ndarray) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # [v, 1] [-2 x, |x|^2] is the squared distance but for |v|^2, up to a rounding far below `slack`
            norms = (x**2).sum(1)
            wide = np.concatenate([-2 * x, norms[:, None]], 1).T
            for b in batches:
                old = b.column(1).to_pylist()
                held = np.flatnonzero(b.column(0).is_valid()).tolist()
                if not held:
                    yield b
                    continue
                points = np.array(b.column(0).take(pa.array(held, pa.int64())).flatten(), float).reshape(len(held), -1)
                step = max(1, TABLE // len(x))
                for start in range(0, len(held), step):
                    p = points[start : start + step]
                    size = (p**2).sum(1)
                    slack = 1e-10 * (size + norms.max())
                    worst = np.array([min(radius, old[i][-1]["d"] if len(old[i]) == k else radius) for i in held[start : start + step]])
                    far = np.concatenate([p, np.ones((len(p), 1))], 1) @ wide
                    limit = worst**2 - size + slack
                    if len(x) > k:  # the k nearest of some are no nearer than those of all
                        some = far[:, : max(k, len(x) // 16)]
                        limit = np.minimum(limit, np.partition(some, k - 1, axis=1)[:, k - 1] + 2 * slack)
                    row, col = np.nonzero(far <= limit[:, None])
                    ends = np.searchsorted(row, np.arange(len(p) + 1))
                    for j in np.unique(row).tolist():
                        near = col[ends[j] : ends[j + 1]]
                        exact = np.sqrt(((x[near] - p[j]) ** 2).sum(1))
                        new = [{"d": float(d), "label": names[c]} for c, d in zip(near.tolist(), exact.tolist(), strict=True) if d < radius for _ in range(times[c])]
                        i = held[start + j]
                        old[i] = sorted([*old[i], *new], key=lambda r: (r["d"], r["label"]))[:k]
                yield b.set_column(1, "_near", pa.array(old, b.schema.field(1).type))

        return run

    for i in range(n):
        part = numbered.where(F.col("_b") == i).select("label", "times", "v").toArrow()
        if not part.num_rows:
            continue
        x = np.array(part.column("v").combine_chunks().flatten(), float).reshape(part.num_rows, -1)
        state = state.mapInArrow(nearer(part.column("label").to_pylist(), part.column("times").to_pylist(), x), state.schema)
        if i % 8 == 7:
            state = written(state, "neighbours")
    state = points.join(state, F.col(vector).cast("array<double>").eqNullSafe(F.col("_v")), "left")
    labels = F.transform("_near", lambda r: r["label"])
    counts = F.transform(F.array_sort(F.array_distinct(labels)), lambda c: F.struct((-F.size(F.filter(labels, lambda y: y == c))).alias("n"), c.alias("label")))
    best = F.array_min(counts)
    return state.select(*points.columns, F.when(-best["n"] >= k_min, best["label"]).alias("cluster"), F.coalesce(-best["n"], F.lit(0)).alias("votes"))


def labelled(spark, sf, size: int | None = None) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", (F.slice(x, 1, size) if size else x).alias("x"))


_X = "x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings)"
_T = "t AS (SELECT label, k, avg(v) AS mean, stddev_pop(v) AS sd, var_pop(v) AS var FROM x GROUP BY 1, 2), s AS (SELECT label, sqrt(sum(var)) AS distance_sd FROM t GROUP BY 1)"


@BOOK.add("g21_template_build", f"WITH {_X}, {_T} SELECT label, k::INTEGER AS k, round(mean, 4) AS mean, round(sd, 4) AS sd, round(distance_sd, 4) AS distance_sd FROM t JOIN s USING (label)")
def _g21(spark, sf):
    made = class_templates(labelled(spark, sf), "label", "x")
    rows = made.select("label", "distance_sd", F.posexplode(F.arrays_zip("mean", "sd")).alias("k", "p"))
    return rows.select("label", "k", F.round("p.mean", 4).alias("mean"), F.round("p.sd", 4).alias("sd"), F.round("distance_sd", 4).alias("distance_sd"))


#: Two items a point, so that SQL can invert their covariance.
_G = (
    "p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings), m AS (SELECT label, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c FROM p GROUP BY label), "
    "g AS (SELECT label, ma, mb, vb / (va * vb - c * c) AS ia, va / (va * vb - c * c) AS ib, -c / (va * vb - c * c) AS ic, ln(va * vb - c * c) AS logdet FROM m), "
    "q AS (SELECT vec_id, p.label AS own, g.label, (a - ma) * (a - ma) * ia + (b - mb) * (b - mb) * ib + 2 * (a - ma) * (b - mb) * ic AS d, logdet FROM p, g)"
)


@BOOK.add("g21b_gaussian_fit", f"WITH {_G} SELECT label, round(ma, 4) AS mean_a, round(mb, 4) AS mean_b, round(ia, 2) AS inverse_a, round(ic, 2) AS inverse_ab, round(ib, 2) AS inverse_b, round(logdet, 4) AS logdet FROM g")
def _g21b(spark, sf):
    made, r = class_templates(labelled(spark, sf, 2), "label", "x"), F.round
    at = lambda c, i: F.get(c, F.lit(i))
    return made.select("label", r(at("mean", 0), 4).alias("mean_a"), r(at("mean", 1), 4).alias("mean_b"), r(at("inverse", 0), 2).alias("inverse_a"), r(at("inverse", 1), 2).alias("inverse_ab"), r(at("inverse", 3), 2).alias("inverse_b"), r("logdet", 4).alias("logdet"))


@BOOK.add(
    "f14_nearest_cluster_assign",
    f"WITH {_X}, {_T}, d AS (SELECT vec_id, t.label, sqrt(sum((v - mean) * (v - mean))) AS d FROM x JOIN t USING (k) GROUP BY vec_id, t.label), b AS (SELECT vec_id, min(d.d) AS d, arg_min(d.label, d.d) AS l FROM d JOIN s ON s.label = d.label AND d.d < 1.05 * distance_sd GROUP BY vec_id) "
    "SELECT vec_id, l AS cluster, round(d, 4) AS distance FROM embeddings LEFT JOIN b USING (vec_id)",
)
def _f14(spark, sf):
    rows = labelled(spark, sf)
    return by_centre(rows, "x", class_templates(rows, "label", "x"), 64, 1.05).select("vec_id", "cluster", F.round("distance", 4).alias("distance"))


@BOOK.add("f14b_likelihood_assign", f"WITH {_G} SELECT vec_id, arg_min(label, (d + logdet, label)) AS cluster, round(min(d + logdet), 4) AS distance FROM q GROUP BY vec_id")
def _f14b(spark, sf):
    rows = labelled(spark, sf, 2)
    return by_likelihood(rows, "x", class_templates(rows, "label", "x"), 2).select("vec_id", "cluster", F.round("distance", 4).alias("distance"))


@BOOK.add(
    "f14c_mahalanobis_assign",
    f"WITH {_G}, y AS (SELECT label, sqrt(avg(d)) AS typical FROM q WHERE own = label GROUP BY label), b AS (SELECT vec_id, min(d) AS d, arg_min(label, (d, label)) AS label FROM q GROUP BY vec_id) SELECT vec_id, CASE WHEN sqrt(d) < 0.3 * typical THEN label END AS cluster, round(d, 4) AS distance FROM b JOIN y USING (label)",
)
def _f14c(spark, sf):
    rows = labelled(spark, sf, 2)
    made = class_templates(rows, "label", "x")
    return by_mahalanobis(rows, "x", made, typical_distances(rows, "label", "x", made, 2), 2, 0.3).select("vec_id", "cluster", F.round("distance", 4).alias("distance"))


@BOOK.add(
    "f14d_neighbour_assign",
    "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), x AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS k FROM e), s AS (SELECT sqrt(sum(var)) AS sd FROM (SELECT var_pop(x) AS var FROM x GROUP BY k)), "
    "d AS (SELECT a.vec_id, b.label, list_distance(a.v, b.v) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.label) AS r FROM e a, e b, s WHERE b.label IS NOT NULL AND list_distance(a.v, b.v) < 1.2 * sd), "
    "c AS (SELECT vec_id, label, count(*) AS n FROM d WHERE r <= 10 GROUP BY 1, 2), w AS (SELECT vec_id, max(n) AS n, arg_min(label, (-n, label)) AS label FROM c GROUP BY vec_id) SELECT vec_id, CASE WHEN n >= 4 THEN w.label END AS cluster, coalesce(n, 0)::INTEGER AS votes FROM e LEFT JOIN w USING (vec_id)",
)
def _f14d(spark, sf):
    rows = labelled(spark, sf)
    return by_neighbours(rows.select("vec_id", "x"), "x", rows, "label", "x", 10, 4, 1.2).select("vec_id", "cluster", "votes")
