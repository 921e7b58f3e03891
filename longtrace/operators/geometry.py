"""Points and poses from several views (inventory group J): one batched solve per Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longtrace.operators.scalar import vector_angle
from longtrace.plans.standins import POSE, Book, pose

BOOK = Book()
QUERIES, SQL = BOOK.queries, BOOK.sql
POINT = [T.StructField(c, T.DoubleType()) for c in ("x", "y", "z", "reprojection")]


def triangulate(views: DataFrame, keys: list[str], cam: str, u: str, v: str, cameras: dict[int, np.ndarray]) -> DataFrame:
    """(keys, x, y, z, reprojection) of points seen by two cameras or more.

    cameras: 3 x 4 projection matrices. Each view gives two rows of a homogeneous
    system; the last right singular vector is the point. reprojection is the mean
    pixel distance of its images from the views. Views are gathered per point and
    all points of a batch are solved at once; a missing view weighs nothing.
    """
    names = sorted(cameras)
    matrices = np.stack([cameras[c] for c in names])
    seen = views.where(F.col(cam).isin(names) & F.col(u).isNotNull() & F.col(v).isNotNull())
    lists = seen.groupBy(*keys).agg(F.collect_list(F.struct(F.col(cam).cast("long").alias("c"), F.col(u).cast("double").alias("u"), F.col(v).cast("double").alias("v"))).alias("_v")).where(F.size("_v") >= 2)
    place = {c: k for k, c in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            uv = np.full((len(pdf), len(names), 2), np.nan)
            for i, row in enumerate(pdf["_v"]):
                for s in row:
                    uv[i, place[s["c"]]] = s["u"], s["v"]
            known = ~np.isnan(uv[..., 0])
            p = matrices[None]
            rows = np.concatenate([uv[..., 0, None] * p[:, :, 2] - p[:, :, 0], uv[..., 1, None] * p[:, :, 2] - p[:, :, 1]], axis=1)
            point = np.linalg.svd(np.nan_to_num(rows))[2][:, -1] if len(pdf) else np.zeros((0, 4))
            with np.errstate(all="ignore"):
                point = point / point[:, 3:]
                image = np.einsum("cij,nj->nci", matrices, point)
                off = np.linalg.norm(image[..., :2] / image[..., 2:] - uv, axis=2)
            mean = np.where(known, np.nan_to_num(off), 0).sum(1) / np.maximum(known.sum(1), 1)
            yield pdf[keys].assign(x=point[:, 0], y=point[:, 1], z=point[:, 2], reprojection=mean)

    return lists.mapInPandas(run, T.StructType([*(lists.schema[k] for k in keys), *POINT]))


def stand_in_cameras() -> dict[int, np.ndarray]:
    """Three pinhole cameras about the stand-in's volume."""
    out = {}
    for k, (turn, shift) in enumerate(((0.0, (0, 0, 400)), (0.4, (-30, 5, 420)), (-0.3, (20, -8, 380)))):
        c, s = np.cos(turn), np.sin(turn)
        out[k] = np.array([[500, 0, 320], [0, 500, 240], [0, 0, 1]]) @ np.hstack([np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]]), np.array(shift)[:, None]])
    return out


def stand_in_views(spark, sf) -> DataFrame:
    """The pose table as seen by the cameras; a camera misses what is too far to its side."""
    rows = pose(spark, sf).select("event", "marker", "frame", (F.col("x") / 8).alias("x"), "y", "z")
    cams = []
    for k, p in stand_in_cameras().items():
        d = [sum((F.col(c) * float(a) for c, a in zip("xyz", row[:3], strict=True)), F.lit(float(row[3]))) for row in p]
        cams.append(F.struct(F.lit(k).alias("cam"), (d[0] / d[2]).alias("u"), (d[1] / d[2]).alias("v")))
    views = rows.select("event", "marker", "frame", F.inline(F.array(*cams)))
    return views.where("abs(u - 320) < 33")


@BOOK.add("j1_triangulate")
def _j1(spark, sf):
    found = triangulate(stand_in_views(spark, sf), ["event", "marker", "frame"], "cam", "u", "v", stand_in_cameras())
    return found.select("event", "marker", "frame", *(F.round(c, 4).alias(c) for c in ("x", "y", "z", "reprojection")))


def rigid_body_pose(df: DataFrame, keys: list[str], frame: str, marker: str, markers: list[str]) -> DataFrame:
    """(keys, frame, rotation (nine numbers by rows), translation, rmse, normal): the least-squares turn and shift of the markers from the key's first complete frame; frames that lack a marker are left out.

    normal is the unit normal of the plane through the first three markers.
    """
    point = F.array(*(F.col(c).cast("double") for c in "xyz"))
    rows = df.where(F.col(marker).isin(markers) & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    sets = rows.groupBy(*keys, frame).agg(F.map_from_entries(F.collect_list(F.struct(marker, point.alias("p")))).alias("_m")).where(F.size("_m") == len(markers))
    flat = sets.select(*keys, frame, F.flatten(F.array(*(F.col("_m")[m] for m in markers))).alias("_p"))
    first = flat.groupBy(*keys).agg(F.min_by("_p", frame).alias("_r"))
    out = [T.StructField("rotation", T.ArrayType(T.DoubleType())), T.StructField("translation", T.ArrayType(T.DoubleType())), T.StructField("rmse", T.DoubleType()), T.StructField("normal", T.ArrayType(T.DoubleType()))]
    joined = flat.join(first, keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            p, r = (np.stack(pdf[c].to_list()).reshape(len(pdf), len(markers), 3) for c in ("_p", "_r"))
            mp, mr = p.mean(1, keepdims=True), r.mean(1, keepdims=True)
            u, _, vt = np.linalg.svd(np.einsum("nki,nkj->nij", r - mr, p - mp))
            sign = np.linalg.det(np.einsum("nij,njk->nik", u, vt))
            vt[:, 2] *= np.sign(sign)[:, None]
            turn = np.einsum("nij,njk->nki", u, vt)
            shift = mp[:, 0] - np.einsum("nij,nj->ni", turn, mr[:, 0])
            off = np.einsum("nij,nkj->nki", turn, r) + shift[:, None] - p
            normal = np.cross(p[:, 1] - p[:, 0], p[:, 2] - p[:, 0])
            size = np.linalg.norm(normal, axis=1, keepdims=True)
            yield pdf[[*keys, frame]].assign(rotation=list(turn.reshape(len(pdf), 9)), translation=list(shift), rmse=np.sqrt((off**2).sum(2).mean(1)), normal=list(normal / np.where(size > 0, size, 1)))

    return joined.mapInPandas(run, T.StructType([*(joined.schema[k] for k in keys), joined.schema[frame], *out]))


def body(spark, sf) -> DataFrame:
    return rigid_body_pose(pose(spark, sf), ["event"], "frame", "marker", ["click", "view", "signup"])


@BOOK.add("j2_rigid_body_pose")
def _j2(spark, sf):
    cut = lambda c: F.transform(c, lambda x: F.round(x, 4)).alias(c)
    return body(spark, sf).select("event", "frame", cut("rotation"), cut("translation"), F.round("rmse", 4).alias("rmse"))


_MARKS = ", ".join(f"max({c}) FILTER (marker = '{m}') AS {c}{k}" for k, m in enumerate(("click", "view", "signup")) for c in "xyz")


@BOOK.add(
    "j3_relative_orientation",
    f"WITH {POSE}, m AS (SELECT event, frame, {_MARKS} FROM pose WHERE marker IN ('click', 'view', 'signup') GROUP BY event, frame HAVING count(*) = 3), "
    "n AS (SELECT event, frame, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS a, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS b, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS c FROM m), "
    "l AS (SELECT event, frame, a / d AS a, b / d AS b, c / d AS c FROM (SELECT *, CASE WHEN a * a + b * b + c * c > 0 THEN sqrt(a * a + b * b + c * c) ELSE 1 END AS d FROM n)), "
    "f AS (SELECT event, arg_min(a, frame) AS p, arg_min(b, frame) AS q, arg_min(c, frame) AS r FROM l GROUP BY event) "
    "SELECT event, frame, CASE WHEN (a * a + b * b + c * c) * (p * p + q * q + r * r) > 0 THEN round(acos(greatest(-1.0, least(1.0, (a * p + b * q + c * r) / (sqrt(a * a + b * b + c * c) * sqrt(p * p + q * q + r * r))))), 4) END AS angle FROM l JOIN f USING (event)",
)
def _j3(spark, sf):
    """Angle between each frame's marker plane and the first one's."""
    rows = body(spark, sf)
    first = rows.groupBy("event").agg(F.min_by("normal", "frame").alias("n0"))
    item = lambda c: [F.get(c, F.lit(k)) for k in range(3)]
    return rows.join(first, "event").select("event", "frame", F.round(vector_angle(item("normal"), item("n0")), 4).alias("angle"))
