"""Tracts: spatial roll-up, equity joins, quadrants, tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions import rules, shapes

CELL_M = 1000.0


def assign_tracts(points: DataFrame, tracts: DataFrame, key: str = "building_id") -> DataFrame:
    """(key, GEOID): the tract that holds each point, edges included; the smallest GEOID where several do.

    Tracts are polygons (``rings``, with minx to maxy their bounds) or, without that column, boxes. Both sides are binned on a grid, so the join is an equi-join on cells at any number of tracts.
    """
    cell = lambda c: F.floor(c / CELL_M).cast("int")
    bins = tracts.withColumn("gx", F.explode(F.sequence(cell(F.col("minx")), cell(F.col("maxx"))))).withColumn("gy", F.explode(F.sequence(cell(F.col("miny")), cell(F.col("maxy")))))
    at = points.select(key, F.col("x").alias("__x"), F.col("y").alias("__y"), cell(F.col("x")).alias("gx"), cell(F.col("y")).alias("gy"))
    rings = F.col("rings") if "rings" in tracts.columns else shapes.box(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy")))
    inside = F.col("__x").between(F.col("minx"), F.col("maxx")) & F.col("__y").between(F.col("miny"), F.col("maxy"))
    hits = at.join(bins, ["gx", "gy"]).where(inside & shapes.holds(rings, F.col("__x"), F.col("__y")))
    return hits.groupBy(key).agg(F.min("GEOID").alias("GEOID"))


def tract_rollup(buildings: DataFrame, tracts: DataFrame) -> DataFrame:
    """Sums, counts, median suitability and usable share of each tract that has buildings."""
    placed = buildings.join(assign_tracts(buildings, tracts), "building_id")
    sums = [F.sum(c).alias(c) for c in ("usable_area_m2", "capacity_kw", "annual_energy_kwh", "annual_co2_kg")]
    out = placed.groupBy("GEOID").agg(*sums, F.count("*").alias("n_buildings"), F.count_if("usable").alias("n_usable"), F.median("suitability").alias("median_suitability"))
    return out.withColumn("pct_usable", F.col("n_usable") * 100 / F.col("n_buildings"))


def energy_burden(strata: DataFrame, costs: tuple[str, ...] = ("cost",)) -> DataFrame:
    """Cost over income of each tract, NULL without income; a cost that a stratum lacks leaves its others standing."""
    out = strata.groupBy(rules.geoid(F.col("FIP")).alias("GEOID")).agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in costs), F.sum("income").alias("income"))
    total = sum((F.col(c) for c in costs[1:]), F.col(costs[0]))
    return out.select("GEOID", F.try_divide(total, F.when(F.col("income") > 0, F.col("income"))).alias("energy_burden"))


def attach_equity(tracts: DataFrame, people: DataFrame, burden: DataFrame) -> DataFrame:
    out = tracts.join(people, "GEOID", "left").join(burden, "GEOID", "left")
    per = lambda c: F.try_divide("annual_energy_kwh", F.nullif(F.col(c), F.lit(0.0)))
    out = out.withColumns({"potential_per_household": per("households"), "potential_per_capita": per("population")})
    return out.withColumn("equity_data_missing", F.col("potential_per_household").isNull() | F.col("energy_burden").isNull())


def classify_equity(df: DataFrame) -> DataFrame:
    """Median-split quadrants over complete rows; ties count as high; the two medians are one broadcast row."""
    whole = ~F.col("equity_data_missing")
    medians = df.agg(F.median(F.when(whole, F.col("potential_per_household"))).alias("__p"), F.median(F.when(whole, F.col("energy_burden"))).alias("__b"))
    out = df.join(F.broadcast(medians))
    side = lambda c, m: F.when(F.col(c) >= F.col(m), "high").otherwise("low")
    name = F.when(~whole, "unknown").otherwise(F.concat(side("potential_per_household", "__p"), F.lit("_potential_"), side("energy_burden", "__b"), F.lit("_burden")))
    return out.withColumn("equity_class", name).withColumn("is_priority", F.col("equity_class") == "high_potential_high_burden").drop("__p", "__b")


def with_tile(points: DataFrame) -> DataFrame:
    """Tile of each point; a point on an edge belongs to the higher cell."""
    index = lambda c, origin: F.floor((F.col(c) - origin) / K.TILE_SIZE_M).cast("int")
    return points.withColumns({"tile_col": index("x", K.GRID_ORIGIN[0]), "tile_row": index("y", K.GRID_ORIGIN[1])})


def tile_grid(boxes: DataFrame) -> DataFrame:
    """Every grid cell that a box touches, with its core bounds."""
    lo = lambda c, o: F.ceil((F.col(c) - o) / K.TILE_SIZE_M).cast("int") - 1
    hi = lambda c, o: F.floor((F.col(c) - o) / K.TILE_SIZE_M).cast("int")
    (ox, oy), size = K.GRID_ORIGIN, K.TILE_SIZE_M
    out = boxes.select(F.explode(F.sequence(lo("minx", ox), hi("maxx", ox))).alias("tile_col"), "miny", "maxy")
    out = out.select("tile_col", F.explode(F.sequence(lo("miny", oy), hi("maxy", oy))).alias("tile_row")).distinct()
    return out.select("tile_row", "tile_col", (F.col("tile_col") * size + ox).alias("minx"), (F.col("tile_row") * size + oy).alias("miny"))


def tile_records(tiles: DataFrame) -> DataFrame:
    """tiles with the bounds of their core and of their buffered square."""
    (ox, oy), size, wide = K.GRID_ORIGIN, K.TILE_SIZE_M, K.TILE_BUFFER_M
    core = {"minx": F.col("tile_col") * size + ox, "miny": F.col("tile_row") * size + oy, "maxx": (F.col("tile_col") + 1) * size + ox, "maxy": (F.col("tile_row") + 1) * size + oy}
    return tiles.withColumns({**core, **{"buffered_" + k: v + (-wide if k.startswith("min") else wide) for k, v in core.items()}})


def with_shape(features: DataFrame) -> DataFrame:
    """features (rings) with their area, centroid, bounds and interior point, worked out once."""
    rings = F.col("rings")
    (cx, cy), (rx, ry) = shapes.centroid(rings), shapes.interior_point(rings)
    return features.withColumns({"area_m2": shapes.area(rings), "cx": cx, "cy": cy, "rep_x": rx, "rep_y": ry, **shapes.bounds(rings)})


def core_footprints(footprints: DataFrame, core: Column, by: str = "rep") -> DataFrame:
    """Whole footprints whose interior point (or, ``by="centroid"``, centroid) lies strictly inside the rings ``core``."""
    x, y = ("rep_x", "rep_y") if by == "rep" else ("cx", "cy")
    return footprints.where(shapes.holds(core, F.col(x), F.col(y), boundary_in=False))


def quadkeys_of(boxes: DataFrame, zoom: int) -> DataFrame:
    """boxes (west, south, east, north in degrees) with the key of each tile that they touch."""
    x0, y0 = rules.web_tile(F.col("west"), F.col("north"), zoom)
    x1, y1 = rules.web_tile(F.col("east"), F.col("south"), zoom)
    out = boxes.withColumn("__x", F.explode(F.sequence(x0, x1))).withColumn("__y", F.explode(F.sequence(y0, y1)))
    return out.withColumn("quadkey", rules.quadkey_of(F.col("__x"), F.col("__y"), zoom)).drop("__x", "__y")


def clip_to_box(features: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """One-ring features cut to a box; those outside go."""
    out = features.withColumn("__ring", F.get("rings", F.lit(0)))
    for axis, at, above in (("x", minx, True), ("x", maxx, False), ("y", miny, True), ("y", maxy, False)):
        out = out.withColumn("__ring", shapes.cut_side(F.col("__ring"), axis, F.lit(float(at)), above))
    return out.where("size(__ring) > 3").withColumn("rings", F.array("__ring")).drop("__ring")


def halo(points: DataFrame) -> DataFrame:
    """Each point in its own tile and in those within whose buffer it lies."""
    near = lambda c, o: F.sequence(F.floor((F.col(c) - o - K.TILE_BUFFER_M) / K.TILE_SIZE_M).cast("int"), F.floor((F.col(c) - o + K.TILE_BUFFER_M) / K.TILE_SIZE_M).cast("int"))
    return points.withColumn("tile_col", F.explode(near("x", K.GRID_ORIGIN[0]))).withColumn("tile_row", F.explode(near("y", K.GRID_ORIGIN[1])))


def merge_tiles(*tiles: DataFrame, empty: DataFrame | None = None) -> DataFrame:
    """Union of tile results by name, absent columns NULL; tiles of another CRS are refused. No tile at all gives ``empty``, a frame of the results' schema."""
    if not tiles:
        if empty is None:
            raise ValueError("no tiles, and no empty frame that tells their schema")
        return empty.limit(0)
    crs = {f.metadata.get("crs") for t in tiles for f in t.schema if f.name == "rings"} - {None}
    if len(crs) > 1:
        raise ValueError(f"tiles differ in CRS: {sorted(crs)}")
    out = tiles[0]
    for t in tiles[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def stratified_sample(df: DataFrame, strata: list[str], key: str, per: int, seed: str = "0") -> DataFrame:
    """At most ``per`` rows of each stratum, drawn by a keyed hash, so independent of order and partitions."""
    draw = F.md5(F.concat(F.lit(seed + "|"), F.col(key).cast("string")))
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*strata).orderBy(draw, key))).where(F.col("__n") <= per).drop("__n")


def done_tiles(tiles: DataFrame, manifest: DataFrame, stamp: str) -> DataFrame:
    """Flag the tiles whose manifest entry is done under the same key."""
    current = manifest.where((F.col("status") == "done") & (F.col("stamp") == stamp)).select("tile_row", "tile_col", F.lit(True).alias("__done"))
    return tiles.join(current, ["tile_row", "tile_col"], "left").withColumn("is_current", F.coalesce("__done", F.lit(False))).drop("__done")


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100, whole)
