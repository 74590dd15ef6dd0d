"""Maps: mosaics, resampling, colours and legends, heights above ground, tile assignment, features as GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions import rules, shapes
from .raster import clip_raster, hillshade, masked, slope_aspect

#: Colours (red, green, blue) at the low end, the middle and the high end.
STOPS = ((28, 44, 110), (60, 150, 140), (250, 225, 90))
STEPS = 256


def mosaic(layers: DataFrame, order: str = "ord") -> DataFrame:
    """One value a cell: that of the first layer that has one; NULL where none has."""
    return layers.groupBy("r", "c").agg(F.min_by("z", F.when(F.col("z").isNotNull(), F.col(order))).alias("z"))


def resample(pixels: DataFrame, targets: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bilinear values at fractional places (fr, fc) of the source grid, over those of four neighbours that have a value.

    The neighbours are exploded and equi-joined on their cell, so no source tile is gathered; sums are combined before
    they are shuffled. NULL where no neighbour of any weight has a value.
    """
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))).alias("n")
    up, left = F.floor("fr"), F.floor("fc")
    share = lambda at, low, side: F.when(F.col(f"n.{side}") == 0, 1 - (F.col(at) - low)).otherwise(F.col(at) - low)
    each = targets.select(*key, "fr", "fc", corner).select(*key, (up + F.col("n.i")).alias("__r"), (left + F.col("n.j")).alias("__c"), (share("fr", up, "i") * share("fc", left, "j")).alias("w"))
    source = pixels.select(F.col("r").cast("long").alias("__r"), F.col("c").cast("long").alias("__c"), F.col("z").alias("__z"))
    joined = each.join(source, ["__r", "__c"], "left")
    total = F.sum(F.when(F.col("__z").isNotNull(), F.col("w")))
    return joined.groupBy(*key).agg(F.try_divide(F.sum(F.col("w") * F.col("__z")), total).alias("z"))


def step_of(value: Column, low: float, high: float) -> Column:
    """The colour step 0 to 255 of a value, clamped at both ends."""
    return F.least(F.lit(STEPS - 1), F.greatest(F.lit(0), F.floor((value - low) / (high - low) * STEPS))).cast("int")


def colour(step: Column) -> dict[str, Column]:
    """red, green and blue of a step, straight lines between the stops."""
    half = STEPS // 2
    low, mid, high = STOPS
    return {name: F.rint(F.when(step < half, low[k] + (mid[k] - low[k]) * step / half).otherwise(mid[k] + (high[k] - mid[k]) * (step - half) / (half - 1))).cast("int") for k, name in enumerate(("red", "green", "blue"))}


def coloured(pixels: DataFrame, low: float, high: float) -> DataFrame:
    """red, green, blue and alpha of each pixel; a missing value is clear."""
    rgb = colour(step_of(F.col("z"), low, high))
    none = F.col("z").isNull()
    return pixels.withColumns({**{k: F.when(none, 0).otherwise(v) for k, v in rgb.items()}, "alpha": F.when(none, 0).otherwise(255)})


def legend(ranges: DataFrame, stops: int) -> DataFrame:
    """(low, high) ranges as ``stops`` evenly spaced values with their colours as #rrggbb."""
    each = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(stops - 1))).alias("i"))
    step = F.floor(F.col("i") * (STEPS - 1) / (stops - 1)).cast("int")
    pair = lambda v: F.lower(F.lpad(F.hex(v), 2, "0"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("i") / (stops - 1)
    return each.select("i", value.alias("value"), F.concat(F.lit("#"), *map(pair, colour(step).values())).alias("colour"))


def heights(surface: DataFrame, terrain: DataFrame, zones: DataFrame) -> DataFrame:
    """Median and 90th percentile of surface above terrain in each zone's cell box; cells without both don't count."""
    cells = zones.select("zone", F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select("zone", "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    above = surface.join(terrain.select("r", "c", F.col("z").alias("__ground")), ["r", "c"]).withColumn("height", F.col("z") - F.col("__ground"))
    found = cells.join(above.select("r", "c", "height"), ["r", "c"], "left")
    return found.groupBy("zone").agg(F.count("height").alias("n_px"), F.median("height").alias("median"), F.percentile("height", F.lit(0.9)).alias("p90"))


def map_tiles(points: DataFrame, key: str, zooms: tuple[int, int] = (13, 16), most: int | None = None) -> DataFrame:
    """(zoom, tile_x, tile_y) of each point (lon, lat) at every zoom; ``most`` keeps the smallest keys of a dense tile.

    The limit is the published feature; it is applied within tasks before the rows of a tile meet.
    """
    each = points.select(key, "lon", "lat", F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1]))).alias("zoom"))
    n, phi = F.pow(F.lit(2.0), "zoom"), F.radians("lat")
    x, y = (F.col("lon") + 180) / 360 * n, (1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / F.pi()) / 2 * n
    out = each.select(key, "zoom", F.floor(x).cast("int").alias("tile_x"), F.floor(y).cast("int").alias("tile_y"))
    if most is None:
        return out
    tile = Window.partitionBy("zoom", "tile_x", "tile_y").orderBy(key)
    return out.withColumn("__n", F.row_number().over(tile)).where(F.col("__n") <= most).drop("__n")


def polygon_features(rows: DataFrame, properties: list[str], step: float = 1e-6) -> DataFrame:
    """One GeoJSON feature a row of its projected polygon (rings), in degrees snapped to ``step``; missing properties are left out."""
    rings = F.transform(shapes.snapped(shapes.unprojected(F.col("rings")), step), lambda ring: F.transform(ring, lambda p: F.array(F.round(p["x"], 6), F.round(p["y"], 6))))
    shape = F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), shape.alias("geometry"))).alias("feature"))


def write_features(features: DataFrame, path: str) -> None:
    """One feature a line; readers of line-delimited GeoJSON take the folder."""
    features.write.mode("overwrite").text(path)


def warp(pixels: DataFrame, targets: DataFrame, source: tuple[float, float], res: float) -> DataFrame:
    """Bilinear values at the centres (i, j, lon, lat) of another grid, from pixels of the working projection.

    :param source: (x, y) of the lower left corner of pixel (0, 0).
    """
    x, y = rules.transverse_mercator(F.col("lon"), F.col("lat"))
    return resample(pixels, targets.select("i", "j", ((y - source[1]) / res - 0.5).alias("fr"), ((x - source[0]) / res - 0.5).alias("fc")), ["i", "j"])


def build_surface(items: DataFrame, layers: DataFrame, targets: DataFrame, rings: Column, source: tuple[float, float], res: float, target: tuple[float, float], target_res: float) -> DataFrame:
    """The surface over a study area in one plan: first valid layer a cell, warped to the target grid, cut to the polygon.

    :param items: catalogue items of the area (href, ord); :param layers: their pixels (href, r, c, z).
    """
    one = mosaic(layers.join(F.broadcast(items.select("href", "ord")), "href"))  # the items of one area
    return clip_raster(warp(one, targets, source, res).withColumnsRenamed({"i": "r", "j": "c"}), rings, target, target_res)


def window(pixels: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """The pixels of a window of rows and columns, which may reach past the grid: cells outside are NULL."""
    rows = pixels.sparkSession.range(r0, r1 + 1).select(F.col("id").cast("int").alias("r"), F.explode(F.sequence(F.lit(c0), F.lit(c1))).alias("c"))
    return rows.join(pixels.where(F.col("r").between(r0, r1) & F.col("c").between(c0, c1)), ["r", "c"], "left")


def page_layers(surface: DataFrame, insolation: DataFrame, footprints: DataFrame, res: float) -> dict[str, DataFrame]:
    """The page's four raster layers, coloured: hillshade of all, insolation, slope and aspect within footprints (zones of cells).

    Insolation is stretched over its 2nd to 98th percentile; aspect is grey where the roof is level.
    """
    steep = masked(slope_aspect(surface, res).select("r", "c", F.col("slope").alias("z")), footprints)
    facing = masked(slope_aspect(surface, res).select("r", "c", F.col("aspect").alias("z")), footprints)
    sun = masked(insolation, footprints)
    low, high = sun.agg(F.percentile("z", F.lit(0.02)), F.percentile("z", F.lit(0.98))).first()
    level = steep.where(F.col("z") <= K.FLAT_THRESHOLD_DEG).select("r", "c", F.lit(True).alias("__level"))
    aspect = coloured(facing, 0.0, 360.0).join(level, ["r", "c"], "left")
    grey = {k: F.when(F.col("__level"), v).otherwise(F.col(k)) for k, v in (("red", 160), ("green", 160), ("blue", 160), ("alpha", 255))}
    shade = hillshade(surface, res).select("r", "c", F.col("shade").alias("z"))
    return {"hillshade": coloured(shade, 0.0, 255.0), "insolation": coloured(sun, low or 0.0, high or 1.0), "slope": coloured(steep, 0.0, 60.0), "aspect": aspect.withColumns(grey).drop("__level")}


def features(rows: DataFrame, ring: Column, *properties: str) -> DataFrame:
    """One GeoJSON feature a row, its polygon a closed ring of (x, y)."""
    line = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(line).alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), shape.alias("geometry"))).alias("feature"))
