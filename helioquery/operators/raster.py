"""Rasters as long pixel tables (r, c, value): gradients, hillshade, zonal means, overviews, robust planes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions import rules, shapes


def annual_insolation(daily: DataFrame, days: tuple[int, ...] = K.DAYS_IN_MONTH) -> DataFrame:
    """kWh per year of each pixel from a mean day of each month; NULL if a month is missing."""
    weight = F.element_at(F.array(*map(F.lit, days)), F.col("month"))
    out = daily.groupBy("pixel").agg((F.sum(F.col("wh") * weight) / 1000).alias("s"), F.count("wh").alias("n"))
    return out.select("pixel", F.when(F.col("n") == len(days), F.col("s")).alias("kwh_m2"))


def gradient(pixels: DataFrame, res: float, tile: list[str] | None = None) -> DataFrame:
    """Add gx and gy: central differences, one-sided at the grid's edge, NULL beside missing pixels."""

    def along(line: str, order: str) -> Column:
        w = Window.partitionBy(*(tile or []), line).orderBy(order)
        before, after = F.lag("z").over(w), F.lead("z").over(w)
        first, last = F.lag(order).over(w).isNull(), F.lead(order).over(w).isNull()
        inner = F.when(first & last, F.lit(None)).when(first, (after - F.col("z")) / res).when(last, (F.col("z") - before) / res).otherwise((after - before) / (2 * res))
        return F.when(F.col("z").isNotNull(), inner)

    return pixels.withColumns({"gx": along("r", "c"), "gy": along("c", "r")})


def slope_aspect(pixels: DataFrame, res: float) -> DataFrame:
    """Slope and downhill aspect in degrees, aspect NULL where level; rows run south."""
    out = gradient(pixels, res)
    slope, aspect = rules.tilt_aspect(F.col("gx"), -F.col("gy"))
    return out.withColumns({"slope": slope, "aspect": F.when(F.hypot("gx", "gy") > 0, aspect)})


def hillshade(pixels: DataFrame, res: float, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """Lambert shade 0 to 255, the cosine between the sun and the surface normal; NULL where a gradient is."""
    out = gradient(pixels, res)
    az, alt = np.radians(azimuth), np.radians(altitude)
    east, north, up = np.sin(az) * np.cos(alt), np.cos(az) * np.cos(alt), np.sin(alt)
    lit = (-F.col("gx") * east + F.col("gy") * north + up) / F.sqrt(1 + F.col("gx") ** 2 + F.col("gy") ** 2)
    return out.withColumn("shade", F.when(lit.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(255.0), 255 * lit))))


def zonal_mean(zones: DataFrame, pixels: DataFrame) -> DataFrame:
    """Mean of the pixels in each zone's cell box, NULL if none has a value; the box is exploded to cells and equi-joined."""
    cells = zones.select("zone", F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select("zone", "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    return cells.join(pixels, ["r", "c"], "left").groupBy("zone").agg(F.avg("z").alias("mean"), F.count("z").alias("n_px"))


def footprint_pixels(footprints: DataFrame, pixels: DataFrame, origin: tuple[float, float], res: float, key: str = "zone") -> DataFrame:
    """(key, r, c, z) of the pixels whose centre lies in each footprint (rings); a footprint that covers none keeps one row of NULLs.

    Candidate cells come from the footprint's bounds by arithmetic, so pixels meet them by an equi-join.
    """
    cell = lambda v, o: F.floor((v - o) / res).cast("int")
    at = {k: v for k, v in shapes.bounds(F.col("rings")).items()}
    cells = footprints.select(key, "rings", F.explode(F.sequence(cell(at["miny"], origin[1]), cell(at["maxy"], origin[1]))).alias("r"), cell(at["minx"], origin[0]).alias("c0"), cell(at["maxx"], origin[0]).alias("c1"))
    cells = cells.select(key, "rings", "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    inside = shapes.holds(F.col("rings"), origin[0] + (F.col("c") + 0.5) * res, origin[1] + (F.col("r") + 0.5) * res)
    found = cells.where(inside).select(key, "r", "c").join(pixels, ["r", "c"])
    return footprints.select(key).join(found.select(key, "r", "c", "z"), key, "left")


def footprint_means(footprints: DataFrame, pixels: DataFrame, origin: tuple[float, float], res: float, key: str = "zone") -> DataFrame:
    """Mean of each footprint's pixels, NULL if none has a value."""
    return footprint_pixels(footprints, pixels, origin, res, key).groupBy(key).agg(F.avg("z").alias("mean"), F.count("z").alias("n_px"))


def clip_raster(pixels: DataFrame, rings: Column, origin: tuple[float, float], res: float) -> DataFrame:
    """Pixels of the bounds of a polygon; those whose centre lies outside are NULL."""
    x, y, at = origin[0] + (F.col("c") + 0.5) * res, origin[1] + (F.col("r") + 0.5) * res, shapes.bounds(rings)
    inside = x.between(at["minx"], at["maxx"]) & y.between(at["miny"], at["maxy"])
    return pixels.where(inside).withColumn("z", F.when(shapes.holds(rings, x, y), F.col("z")))


def masked(pixels: DataFrame, zones: DataFrame) -> DataFrame:
    """Pixels outside every zone become NULL."""
    cells = zones.select(F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select("r", F.explode(F.sequence("c0", "c1")).alias("c")).distinct()
    return pixels.join(cells.withColumn("__in", F.lit(True)), ["r", "c"], "left").withColumn("z", F.when(F.col("__in"), F.col("z"))).drop("__in")


def overviews(pixels: DataFrame, levels: int) -> DataFrame:
    """Averages over blocks of 2^k pixels for each level k."""
    out = pixels.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
    block = lambda c: F.floor(F.col(c) / F.pow(F.lit(2), "level")).cast("int")
    return out.groupBy("level", block("r").alias("r"), block("c").alias("c")).agg(F.avg("z").alias("z"))


def lsq_planes(points: DataFrame, key: str = "building_id") -> DataFrame:
    """Least-squares plane of each group by centred normal equations; NULL where they are singular."""
    p = points.groupBy(key).agg(F.count("*").alias("n"), *(F.avg(c).alias("m" + c) for c in "xyz"), *(F.covar_pop(a, b).alias(a + b) for a, b in ("xx", "yy", "xy", "xz", "yz")))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    det = F.when(det > F.col("xx") * F.col("yy") * 1e-9, det)
    a, b = (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / det, (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / det
    return p.select(key, "n", a.alias("a"), b.alias("b"), (F.col("mz") - a * F.col("mx") - b * F.col("my")).alias("c"))


def residuals(points: DataFrame, planes: DataFrame) -> DataFrame:
    """Signed distance in height of each point to its building's nearest plane; ties go to the first plane."""
    off = F.col("z") - (F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c"))
    each = points.join(planes, "building_id", "left").withColumn("off", off)
    return each.groupBy("building_id", "x", "y", "z").agg(F.min_by(F.struct("plane_id", "off"), F.struct(F.abs("off"), "plane_id")).alias("best")).select("building_id", "x", "y", "z", "best.plane_id", "best.off")


def self_consistency(df: DataFrame, key: str = "building_id", tolerance: float = K.RESIDUAL_M) -> DataFrame:
    return df.groupBy(key).agg(F.sqrt(F.avg(F.col("off") * F.col("off"))).alias("rmse"), (100 * F.avg((F.abs("off") <= tolerance).cast("double"))).alias("pct_within"), F.count("off").alias("n"))
