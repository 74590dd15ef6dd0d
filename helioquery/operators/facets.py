"""Roof facets: robust planes of each roof's pixels, obstructions above them, insolation on them, and how well they fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules
from . import scoring
from .raster import self_consistency

FIT = "building_id long, plane_id int, n_planes int, tilt_deg double, aspect_deg double, inlier_ratio double, n_px long, a double, b double, c double, inlier_xy array<struct<x:double,y:double>>, low_confidence boolean, superstructure_frac double"
SINGLE = "building_id long, tilt_deg double, aspect_deg double, inlier_ratio double, n_px long, low_confidence boolean"
TRIALS = 100
#: Slopes below this are level, so that rounding noise does not tell a level plane's aspect.
LEVEL = 1e-9


def consensus(x: np.ndarray, z: np.ndarray, trials: int = TRIALS) -> np.ndarray | None:
    """Inliers of the plane through three drawn points that has most of them; of equals the one that lies closest.

    Draws depend on the number of points alone, so equal roofs are fitted alike wherever they run.
    """
    picks = np.random.default_rng(0).integers(0, len(z), (2 * trials, 3))
    picks = picks[(picks[:, 0] != picks[:, 1]) & (picks[:, 1] != picks[:, 2]) & (picks[:, 0] != picks[:, 2])][:trials]
    m = np.concatenate([x[picks], np.ones((len(picks), 3, 1))], axis=2)
    ok = np.abs(np.linalg.det(m)) > LEVEL
    if not ok.any():
        return None
    coef = np.linalg.solve(m[ok], z[picks[ok]][:, :, None])[:, :, 0]
    off = np.abs(coef[:, :2] @ x.T + coef[:, 2:] - z)
    hits = off <= K.RESIDUAL_M
    count = hits.sum(axis=1)
    best = np.flatnonzero(count == count.max())
    return hits[best[np.argmin(np.where(hits[best], off[best] ** 2, 0).sum(axis=1))]]


def refit(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Least-squares (a, b, c) of z = ax + by + c about the points' centre."""
    mid = x.mean(axis=0)
    (a, b, c), *_ = np.linalg.lstsq(np.column_stack([x - mid, np.ones(len(x))]), z, rcond=None)
    a, b = (0.0 if abs(v) < LEVEL else float(v) for v in (a, b))
    return np.array([a, b, c - a * mid[0] - b * mid[1]])


def peel(x: np.ndarray, z: np.ndarray, most: int = K.MAX_PLANES) -> list[tuple[np.ndarray, np.ndarray]]:
    """(coefficients, member indices) of successive planes, largest first; of equal sizes the earlier fit."""
    left, found = np.arange(len(z)), []
    while len(left) >= K.MIN_PX and len(found) < most:
        hits = consensus(x[left] - x.mean(axis=0), z[left])
        if hits is None or hits.sum() < K.MIN_PLANE_PX:
            break
        found.append((refit(x[left[hits]], z[left[hits]]), left[hits]))
        left = left[~hits]
    return sorted(found, key=lambda f: -len(f[1]))


def split_superstructures(planes: list, x: np.ndarray, z: np.ndarray) -> tuple[list, list]:
    """(kept, dropped): later planes of few pixels whose median stands above the dominant plane are roof clutter."""
    kept, dropped = [], []
    for n, plane in enumerate(planes):
        own, (a, b, c) = plane[1], planes[0][0]
        above = np.median(z[own] - x[own] @ (a, b) - c) > K.RESIDUAL_M
        (dropped if n and len(own) < K.SUPERSTRUCTURE_MAX_PX and above else kept).append(plane)
    return kept, dropped


def _angles(a: float, b: float) -> tuple[float, float]:
    return float(np.degrees(np.arctan(np.hypot(a, b)))), 180.0 if a == b == 0 else float(np.degrees(np.arctan2(-a, -b)) % 360)


def _facets(key: int, x: np.ndarray, z: np.ndarray, most: int) -> list[tuple]:
    planes = peel(x, z, most)
    kept, dropped = split_superstructures(planes, x, z)
    if not kept:
        return [(key, 0, 1, None, None, None, len(z), None, None, None, [], True, 0.0)]
    total = len(z)
    low = sum(len(own) for _, own in planes) / total < 0.5 or total < 20
    clutter = sum(len(own) for _, own in dropped) / total
    return [(key, n, len(kept), *_angles(a, b), len(own) / total, len(own), a, b, c, [{"x": px, "y": py} for px, py in x[own].tolist()], low, clutter) for n, ((a, b, c), own) in enumerate(kept)]


def _one_plane(key: int, x: np.ndarray, z: np.ndarray, most: int) -> list[tuple]:
    hits = consensus(x - x.mean(axis=0), z) if len(z) >= K.MIN_PX else None
    if hits is None:
        return [(key, None, None, None, len(z), True)]
    a, b, _ = refit(x[hits], z[hits])
    ratio = float(hits.mean())
    return [(key, *_angles(a, b), ratio, len(z), ratio < 0.5 or len(z) < 20)]


def fit_planes(points: DataFrame, method: str = "multiplane", max_planes: int = K.MAX_PLANES) -> DataFrame:
    """Planes of each building from its pixels (building_id, x, y, z).

    ``multiplane``: a row of each facet, plane 0 the largest, the members with it; a building that no plane fits keeps
    one placeholder row. ``ransac``: one plane a building. Other methods are not built. Buildings are sorted runs within
    a partition, so a Python call holds many roofs; pixels are shuffled once, by building.
    """
    known = {"multiplane": (_facets, FIT), "ransac": (_one_plane, SINGLE)}
    if method not in known:
        raise NotImplementedError(f"fit_planes(method={method!r}): only {', '.join(known)} are built")
    fit, schema = known[method]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = pd.concat([rest, frame]) if rest is not None else frame
            last = frame["building_id"].iloc[-1]
            whole = (frame["building_id"] != last).to_numpy()
            rest = frame[~whole]
            if whole.any():
                yield fitted(frame[whole])
        if rest is not None:
            yield fitted(rest)

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        keys, first = np.unique(frame["building_id"].to_numpy(), return_index=True)
        x, z = frame[["x", "y"]].to_numpy(float), frame["z"].to_numpy(float)
        parts = zip(keys.tolist(), np.split(x, first[1:]), np.split(z, first[1:]))
        return pd.DataFrame([row for key, own, height in parts for row in fit(key, own, height, max_planes)], columns=names)

    seen = points.where("z is not null").select("building_id", F.col("x").cast("double"), F.col("y").cast("double"), F.col("z").cast("double"))
    return seen.repartition("building_id").sortWithinPartitions("building_id", "x", "y", "z").mapInPandas(run, schema)


def membership(points: DataFrame, planes: DataFrame, tau: float = K.OBSTRUCTION_TAU_M) -> DataFrame:
    """Each pixel with its nearest plane (the first of equals), its height above it and whether that makes it an obstruction.

    Pixels of a building without a plane have plane -1, no height and are none.
    """
    each = planes.where("a is not null").groupBy("building_id").agg(F.collect_list(F.struct("plane_id", "a", "b", "c")).alias("__planes"))  # at most MAX_PLANES

    def off(p: Column) -> Column:
        return F.col("z") - (p["a"] * F.col("x") + p["b"] * F.col("y") + p["c"])

    near = F.array_min(F.transform("__planes", lambda p: F.struct(F.abs(off(p)).alias("d"), p["plane_id"].alias("plane_id"), off(p).alias("off"))))
    out = points.select("building_id", "x", "y", "z").join(each, "building_id", "left").withColumn("__near", near)
    return out.select("building_id", "x", "y", "z", F.coalesce("__near.plane_id", F.lit(-1)).alias("plane_id"), F.col("__near.off").alias("off"), F.coalesce(F.col("__near.off") > tau, F.lit(False)).alias("is_obstruction"))


def detect_obstructions(planes: DataFrame, members: DataFrame, pixel_area: float) -> DataFrame:
    """planes with plane_area_m2 and obstruction_area_m2; a building without a plane has all its pixels' area and no obstruction."""
    counts = members.groupBy("building_id", F.greatest("plane_id", F.lit(0)).alias("plane_id")).agg((F.count("*") * pixel_area).alias("plane_area_m2"), (F.count_if("is_obstruction") * pixel_area).alias("obstruction_area_m2"))
    return planes.join(counts, ["building_id", "plane_id"], "left").fillna(0.0, ["plane_area_m2", "obstruction_area_m2"])


def plane_poa(planes: DataFrame, insolation: DataFrame, origin: tuple[float, float], res: float) -> DataFrame:
    """planes with the mean insolation of their members' cells (r, c, kwh_m2); cells outside or without a value don't count."""
    px = planes.select("building_id", "plane_id", F.explode("inlier_xy").alias("p"))
    px = px.select("building_id", "plane_id", F.floor((F.col("p.y") - origin[1]) / res).cast("int").alias("r"), F.floor((F.col("p.x") - origin[0]) / res).cast("int").alias("c"))
    mean = px.join(insolation, ["r", "c"]).groupBy("building_id", "plane_id").agg(F.avg("kwh_m2").alias("poa_clear_sky_kwh_m2"))
    return planes.join(mean, ["building_id", "plane_id"], "left")


def usable_facets(points: DataFrame, insolation: DataFrame, origin: tuple[float, float], res: float, max_planes: int = K.MAX_PLANES) -> DataFrame:
    """Pixels to planes with areas, obstructions, insolation, usable area and yields: the whole chain before the collapse."""
    planes = fit_planes(points, max_planes=max_planes)
    area = points.where("z is not null").groupBy("building_id").agg((F.count("*") * res * res).alias("footprint_area_m2"))
    planes = detect_obstructions(planes, membership(points, planes), res * res).join(area, "building_id")
    return scoring.plane_yields(scoring.usable_planes(plane_poa(planes, insolation, origin, res)))


def score_roofs(points: DataFrame, insolation: DataFrame, origin: tuple[float, float], res: float) -> DataFrame:
    """Pixels to scored buildings."""
    return scoring.collapse(usable_facets(points, insolation, origin, res))


def stacked(points: DataFrame, insolation: DataFrame, origin: tuple[float, float], res: float) -> DataFrame:
    """The facets of each method one below the other: the same chain with its own cap on facets."""
    parts = [usable_facets(points, insolation, origin, res, most).drop("inlier_xy").withColumn("method", F.lit(name)) for name, most in K.METHODS.items()]
    return parts[0].unionByName(parts[1])


def compare_consistency(points: DataFrame) -> DataFrame:
    """For each roof how well several facets and one plane reconstruct its pixels, from the same fitter."""
    out = None
    for name, most in K.METHODS.items():
        planes = fit_planes(points, max_planes=most)
        kept = planes.groupBy("building_id").agg(F.count("a").cast("int").alias("n_planes"))
        found = self_consistency(membership(points, planes)).select("building_id", F.col("rmse").alias(f"rmse_{name}"), F.col("pct_within").alias(f"pct_within_{name}"))
        out = kept.join(found, "building_id", "left") if out is None else out.join(found, "building_id", "left")
    return out.withColumn("rmse_improvement", F.col("rmse_ransac") - F.col("rmse_multiplane"))


def tile_consistency(points: DataFrame, roofs: DataFrame) -> DataFrame:
    """The comparison with tile, city-wide id, roof class and archetype of ``roofs`` (building_id, tile_row, tile_col, roof_class)."""
    out = compare_consistency(points).join(roofs.select("building_id", "tile_row", "tile_col", "roof_class"), "building_id")
    return out.withColumns({"roof_id": rules.city_id(F.col("tile_row"), F.col("tile_col"), F.col("building_id")), "roof_type": rules.fitted_type(F.col("n_planes"), F.col("roof_class"))})


def summarize_consistency(per_roof: DataFrame) -> DataFrame:
    """Counts and quantiles by archetype, unfittable roofs a bin of their own, and over all; bins without roofs too."""
    spark, fit = per_roof.sparkSession, F.col("rmse_multiplane").isNotNull()
    bins = spark.createDataFrame([(t,) for t in (*K.ROOF_TYPES, "unfittable", "all")], "roof_type string")
    metrics = {f"{c}_{name}": F.percentile(c, F.lit(q)) for c, name, q in (("rmse_multiplane", "median", 0.5), ("rmse_ransac", "median", 0.5), ("rmse_improvement", "median", 0.5), ("rmse_improvement", "p90", 0.9), ("pct_within_multiplane", "median", 0.5), ("pct_within_ransac", "median", 0.5))}
    each = per_roof.withColumn("roof_type", F.explode(F.array("roof_type", F.lit("all"))))
    found = each.groupBy("roof_type").agg(F.count("*").alias("n_roofs"), F.count_if(~fit).alias("n_unfittable"), *(v.alias(k) for k, v in metrics.items()))
    return bins.join(found, "roof_type", "left").fillna(0, ["n_roofs", "n_unfittable"])
