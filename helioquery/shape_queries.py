"""Registered queries over polygons that are no boxes, with SQL that knows them in closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixtures import fixture
from .functions import rules, shapes
from .operators import areas, raster
from .queries import query, r6


def diamonds(spark, sf):
    """Outer rings counter-clockwise, holes clockwise."""
    p = lambda dx, dy: F.struct((F.col("mx") + dx).alias("x"), (F.col("my") + dy).alias("y"))
    a, b, o = F.col("a"), F.col("b"), F.lit(0.0)
    outer = F.array(p(a, o), p(o, b), p(-a, o), p(o, -b), p(a, o))
    hole = F.array(*(p(F.lit(x), F.lit(y)) for x, y in ((-100.0, -300.0), (-100.0, 300.0), (500.0, 300.0), (500.0, -300.0), (-100.0, -300.0))))
    return fixture(spark, sf, "diamonds").withColumn("rings", F.array(outer, hole))


SHAPES = "select GEOID, 2 * a * b - 360000 as area_m2, round(mx - 72000000 / (2 * a * b - 360000), 5) as cx, my as cy, mx - a as minx, my - b as miny, mx + a as maxx, my + b as maxy, round(mx - (a * (1 - 150 / b) + 100) / 2, 5) as rep_x, my + 150 as rep_y from diamonds"


def shaped(spark, sf):
    return areas.with_shape(diamonds(spark, sf))


@query(SHAPES, "diamonds")
def q_polygon_measures(spark, sf):
    return r6(r6(shaped(spark, sf).select("GEOID", "area_m2", "cx", "cy", "minx", "miny", "maxx", "maxy", "rep_x", "rep_y"), "cx", "rep_x", digits=5), "cy", "rep_y")


INSIDE = "(abs(x - mx) * b + abs(y - my) * a {lt} a * b and not (x - mx {gt} -100 and x - mx {lt2} 500 and abs(y - my) {lt2} 300))"


@query(f"select building_id, min(GEOID) as GEOID from buildings join diamonds on {INSIDE.format(lt='<=', gt='>', lt2='<')} group by 1", "buildings", "diamonds")
def q_polygon_join(spark, sf):
    return areas.assign_tracts(fixture(spark, sf, "buildings"), shaped(spark, sf))


@query(f" select building_id, GEOID, {INSIDE.format(lt='<', gt='>=', lt2='<=')} as strict from buildings join diamonds on {INSIDE.format(lt='<=', gt='>', lt2='<')}", "buildings", "diamonds")
def q_polygon_boundary(spark, sf):
    both = fixture(spark, sf, "buildings").select("building_id", "x", "y").join(areas.assign_tracts(fixture(spark, sf, "buildings"), shaped(spark, sf)), "building_id")
    return both.join(diamonds(spark, sf), "GEOID").select("building_id", "GEOID", shapes.holds(F.col("rings"), F.col("x"), F.col("y"), False).alias("strict"))


DISTANCE = "sqrt(pow(greatest(abs(x - 325000) - 2000, 0), 2) + pow(greatest(abs(y - 4301000) - 3000, 0), 2))"


@query(f"select building_id, abs(x - 325000) < 2000 and abs(y - 4301000) < 3000 as core, {DISTANCE} <= 300 as buffered from buildings", "buildings")
def q_study_area(spark, sf):
    ring = shapes.box(*(F.lit(float(v)) for v in (323000, 4298000, 327000, 4304000)))
    x, y = F.col("x"), F.col("y")
    return fixture(spark, sf, "buildings").select("building_id", shapes.holds(ring, x, y, False).alias("core"), shapes.near(ring, x, y, 300.0).alias("buffered"))


@query("select GEOID from diamonds where mx - (a * (1 - 150 / b) + 100) / 2 between 320000.001 and 329999.999 and my + 150 between 4300000.001 and 4309999.999", "diamonds")
def q_core_by_point(spark, sf):
    core = shapes.box(*(F.lit(float(v)) for v in (320000, 4300000, 330000, 4310000)))
    return areas.core_footprints(shaped(spark, sf), core).select("GEOID")


@query("select GEOID from diamonds where mx - 72000000 / (2 * a * b - 360000) between 320970 and 329999 and my between 4300000.001 and 4309999.999", "diamonds")
def q_core_by_centroid(spark, sf):
    core = shapes.box(*(F.lit(float(v)) for v in (320970, 4300000, 330000, 4310000)))
    return areas.core_footprints(shaped(spark, sf), core, "centroid").select("GEOID")


@query("select GEOID, round(2 * a * b - pow(greatest(0, mx + a - 333000), 2) * b / a, 4) as area_m2 from diamonds where mx <= 333000 and my + b <= 4317000 and my - b >= 4295000", "diamonds")
def q_clip_to_box(spark, sf):
    cut = areas.clip_to_box(diamonds(spark, sf).withColumn("rings", F.slice("rings", 1, 1)), 310000, 4290000, 333000, 4330000)
    return r6(cut.where("mx <= 333000 and my + b <= 4317000 and my - b >= 4295000").select("GEOID", shapes.area(F.col("rings")).alias("area_m2")), "area_m2", digits=4)


ROOFS = ", roofs as (select n_nationkey as zone, n_nationkey % 7 * 2 + 7 as qx, n_nationkey % 15 * 4 + 9 as qy from nation), hits as (select zone, r, c, z from roofs left join pixels on abs(c * 2 + 1 - qx) + abs(r * 2 + 1 - qy) <= 5)"


def roofs(spark, sf):
    k = F.col("n_nationkey")
    qx, qy = (k % 7 * 2 + 7).cast("double"), (k % 15 * 4 + 9).cast("double")
    p = lambda dx, dy: F.struct((qx + dx).alias("x"), (qy + dy).alias("y"))
    return spark.read.parquet(f"{sf}/nation.parquet").select(k.alias("zone"), F.array(F.array(p(5, 0), p(0, 5), p(-5, 0), p(0, -5), p(5, 0))).alias("rings"))


@query(ROOFS + " select zone, r, c, z from hits", "pixels")
def q_footprint_pixels(spark, sf):
    return raster.footprint_pixels(roofs(spark, sf), fixture(spark, sf, "pixels"), (0.0, 0.0), 2.0)


@query(ROOFS + " select zone, round(avg(z), 6) as mean, count(z) as n_px from hits group by 1", "pixels")
def q_footprint_means(spark, sf):
    return r6(raster.footprint_means(roofs(spark, sf), fixture(spark, sf, "pixels"), (0.0, 0.0), 2.0), "mean")


@query("select r, c, case when abs(c * 2 + 1 - 9) + abs(r * 2 + 1 - 20) <= 8 then z end as z from pixels where c * 2 + 1 between 1 and 17 and r * 2 + 1 between 12 and 28", "pixels")
def q_clip_raster(spark, sf):
    p = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    rings = F.array(F.array(p(17, 20), p(9, 28), p(1, 20), p(9, 12), p(17, 20)))
    return raster.clip_raster(fixture(spark, sf, "pixels"), rings, (0.0, 0.0), 2.0).select("r", "c", "z")


@query("select distinct tile_row, tile_col, 315000e0 + tile_col * 2000 as minx, 4295000e0 + tile_row * 2000 as miny, 317000e0 + tile_col * 2000 as maxx, 4297000e0 + tile_row * 2000 as maxy, 314700e0 + tile_col * 2000 as buffered_minx, 4294700e0 + tile_row * 2000 as buffered_miny, 317300e0 + tile_col * 2000 as buffered_maxx, 4297300e0 + tile_row * 2000 as buffered_maxy from (select cast(floor((y - 4295000) / 2000) as int) as tile_row, cast(floor((x - 315000) / 2000) as int) as tile_col from buildings)", "buildings")
def q_tile_records(spark, sf):
    tiles = areas.with_tile(fixture(spark, sf, "buildings")).select("tile_row", "tile_col").distinct()
    return areas.tile_records(tiles)


@query("select c_custkey, cast(round_even(c_acctbal / 0.25e0, 0) * 0.25e0 as double) as x from customer")
def q_snapped(spark, sf):
    ring = F.array(F.array(F.struct(F.col("c_acctbal").cast("double").alias("x"), F.lit(0.0).alias("y"))))
    out = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", shapes.snapped(ring, 0.25).alias("r"))
    return out.select("c_custkey", F.get(F.get("r", F.lit(0)), F.lit(0))["x"].alias("x"))


@query("select building_id, case when n_planes % 3 = 0 then 'unfittable' when tilt_deg < 10 then case when n_planes % 3 + 1 > 2 then 'complex' else 'flat' end else case when n_planes % 3 + 1 > 2 then 'hip' else 'gable' end end as roof_type, (footprint_area_m2 / 400 < 0.5e0 or n_planes * 10 < 20) as low_confidence from buildings", "buildings")
def q_fit_flags(spark, sf):
    left = F.col("n_planes") % 3
    planes = F.when(left == 0, 0).otherwise(left + 1)
    kind = rules.fitted_type(planes, rules.roof_class(F.col("tilt_deg"), F.col("aspect_deg")))
    return fixture(spark, sf, "buildings").select("building_id", kind.alias("roof_type"), rules.low_confidence(F.col("footprint_area_m2") / 400, F.col("n_planes") * 10).alias("low_confidence"))
