"""Runs: scoring plans over all tiles at once, validity keys, and partitioned results that resume."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import areas, facets, scoring


def validity_key(stage: str, version: str, upstream: str | None = None, **settings) -> str:
    """A stable key of a stage's settings and of the stage before; lists of days count as sets."""
    settings = {k: sorted(v) if k == "day_range" and v else v for k, v in settings.items()}
    text = json.dumps({"stage": stage, "version": version, "upstream": upstream, **settings}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def score_city(planes: DataFrame, places: DataFrame) -> DataFrame:
    """All buildings with their tile and the city-wide rank; a tile is a partition key, not a loop."""
    return areas.with_tile(scoring.score_buildings(planes).join(places.select("building_id", "x", "y"), "building_id"))


def score_study_area(points: DataFrame, insolation: DataFrame, origin: tuple[float, float], res: float, method: str = "multiplane") -> DataFrame:
    """Scored buildings of a study area by either method: facets collapsed to buildings, or one plane and a fixed share of the footprint."""
    if method == "multiplane":
        return facets.score_roofs(points, insolation, origin, res)
    cells = points.select("building_id", F.floor((F.col("y") - origin[1]) / res).cast("int").alias("r"), F.floor((F.col("x") - origin[0]) / res).cast("int").alias("c"))
    sun = cells.join(insolation, ["r", "c"], "left").groupBy("building_id").agg(F.avg("kwh_m2").alias("poa_clear_sky_kwh_m2"), (F.count("*") * res * res).alias("footprint_area_m2"))
    return scoring.footprint_yield(facets.fit_planes(points, method).join(sun, "building_id"))


def aggregate_city(buildings: DataFrame, tracts: DataFrame, people: DataFrame, burden: DataFrame) -> DataFrame:
    """Tracts that have buildings, with sums, potentials and the equity quadrant, back on their geometry."""
    out = areas.classify_equity(areas.attach_equity(areas.tract_rollup(buildings, tracts), people, burden))
    shape = [c for c in ("rings", "minx", "miny", "maxx", "maxy") if c in tracts.columns]
    return out.join(tracts.select("GEOID", *shape), "GEOID")


def pending(tiles: DataFrame, manifest: DataFrame, stamp: str) -> DataFrame:
    """Tiles whose result under this key isn't there yet."""
    return areas.done_tiles(tiles, manifest, stamp).where(~F.col("is_current")).drop("is_current")


def write_city(scored: DataFrame, path: str) -> None:
    """Replace the partitions of the tiles at hand and leave the others."""
    scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_row", "tile_col").parquet(path)
