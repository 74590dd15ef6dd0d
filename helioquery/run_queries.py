"""Registered queries of benchmark figures, catalogues, tile covers and composed raster plans, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixtures import fixture
from .functions import rules
from .operators import areas, benchmarks, checks, facets, maps, raster
from .queries import CLASS, QUADRANT, ZONES, built, equity, query, r6, views, zones
from .roof_queries import TRUTH, px
from .shape_queries import diamonds
from .sources import readers

SHARE = f"case when ({CLASS}) = 'pitched_north_facing' then 0e0 else 0.7e0 end"


@query(f"select building_id, {CLASS} as roof_class, {SHARE} as utilization_fraction, footprint_area_m2 * {SHARE} as usable_area_m2 from buildings", "buildings")
def q_utilization(spark, sf):
    return benchmarks.utilization(fixture(spark, sf, "buildings")).select("building_id", "roof_class", "utilization_fraction", "usable_area_m2")


@query(f", c as (select {CLASS} as roof_class, footprint_area_m2 as f, footprint_area_m2 * {SHARE} as u from buildings) select roof_class, count(*) as n, round(100 * sum(u) / sum(f), 6) as utilization_pct from (select * from c union all select 'all', f, u from c) group by 1", "buildings")
def q_utilization_summary(spark, sf):
    return r6(benchmarks.utilization_summary(fixture(spark, sf, "buildings")), "utilization_pct")


@query(views("select round(median(annual_energy_kwh) filter (where usable_area_m2 > 0) / 1000, 6) as median_energy_mwh, round(median(annual_energy_kwh) filter (where usable_area_m2 > 0 and footprint_area_m2 between 80 and 250) / 1000, 6) as house_energy_mwh, round(median(annual_energy_kwh / capacity_kw) filter (where usable_area_m2 > 0), 6) as median_specific_yield, round(0.16e0, 6) as conversion_factor, round(avg(case when poa_real_kwh_m2 >= 800 then 1e0 else 0e0 end), 6) as share_sunny from built"), "planes")
def q_intensive(spark, sf):
    out = benchmarks.intensive(built(spark, sf))
    return r6(out, *out.columns)


EXTERNAL = "case when poa_clear_sky_kwh_m2 * 0.75e0 >= 800 and tilt_deg <= 45 and (tilt_deg <= 10 or (aspect_deg > 22.5e0 and aspect_deg < 337.5e0)) and footprint_area_m2 >= 30 then footprint_area_m2 * poa_clear_sky_kwh_m2 * 0.75e0 * 0.216e0 * 0.83e0 else 0e0 end"


@query(f", t as (select sum(footprint_area_m2 * 100) / 1000 as o, sum({EXTERNAL}) / 1000 as e from buildings) select round(o, 4) as ours_mwh, round(e, 4) as external_mwh, round(o / 29000, 6) as ours_to_published, round(e / 29000, 6) as external_to_published, round(o / e, 6) as ours_to_external from t", "buildings")
def q_three_ways(spark, sf):
    b = fixture(spark, sf, "buildings")
    rows = b.join(checks.external_method(b), "building_id").withColumn("annual_energy_kwh", F.col("footprint_area_m2") * 100)
    out = benchmarks.three_ways(rows, 29000.0)
    return r6(r6(out, "ours_to_published", "external_to_published", "ours_to_external"), "ours_mwh", "external_mwh", digits=4)


@query(TRUTH + ", f as (select kind, round(tilt_deg, 6) as t, inlier_ratio as i, case when a is not null then 72 end as n, a is null or kind = 2 as low from facets where plane_id = 0) select count(*) as n_roofs, count(t) as n_fitted, round(median(t), 6) as median_tilt_deg, round(median(i), 6) as median_inlier_ratio, median(n) as median_n_px, round(100e0 * count(*) filter (where t < 10) / count(t), 6) as pct_flat, round(100e0 * count(*) filter (where low and t is not null) / count(t), 6) as pct_low_confidence from f", "roof_px")
def q_fit_quality(spark, sf):
    out = benchmarks.fit_quality(facets.fit_planes(px(spark, sf), "ransac"))
    return r6(out, "median_tilt_deg", "median_inlier_ratio", "pct_flat", "pct_low_confidence")


@query(", g as (select *, n_planes * 0.2e0 as ratio, n_planes * 8 as px from buildings) select cast(floor(aspect_deg / 22.5e0) as int) as bin, sum(footprint_area_m2) as area from g where tilt_deg >= 10 and n_planes >= 3 group by 1", "buildings")
def q_gated_rose(spark, sf):
    b = fixture(spark, sf, "buildings")
    fits = b.select("tilt_deg", "aspect_deg", (F.col("n_planes") * 0.2 + 0.01).alias("inlier_ratio"), (F.col("n_planes") * 8).alias("n_px"), F.col("footprint_area_m2").alias("area_m2"))
    return benchmarks.gated_rose(fits)


@query("select building_id, round(footprint_area_m2 * 0.34e0, 6) as usable_area_m2, round(footprint_area_m2 * 0.068e0, 6) as capacity_kw, round(footprint_area_m2 * 79.56e0, 6) as annual_energy_kwh, round(footprint_area_m2 * 27.846e0, 6) as annual_co2_kg from buildings", "buildings")
def q_sketch_chain(spark, sf):
    out = benchmarks.sketch_chain(fixture(spark, sf, "buildings")).select("building_id", "usable_area_m2", "capacity_kw", "annual_energy_kwh", "annual_co2_kg")
    return r6(out, "usable_area_m2", "capacity_kw", "annual_energy_kwh", "annual_co2_kg")


@query(views("select count(*) as n_roofs, count(*) filter (where usable) as n_usable, count(*) filter (where low_confidence) as n_low_confidence, round(100e0 * avg(cast(low_confidence as int)), 6) as pct_low_confidence, round(sum(capacity_kw), 2) as capacity_kw, round(sum(annual_energy_kwh) / 1000, 2) as energy_mwh, round(sum(annual_energy_kwh) * 0.35e0 / 1000, 2) as co2_t, round(median(annual_energy_kwh) filter (where usable) / 1000, 6) as median_energy_mwh, round(median(density) filter (where usable), 6) as median_density, round(sum(annual_energy_kwh) / sum(capacity_kw), 4) as specific_yield, abs(sum(annual_energy_kwh) / sum(capacity_kw) / 1150 - 1) <= 0.15 as passes from built"), "planes")
def q_run_headline(spark, sf):
    out = r6(benchmarks.run_headline(built(spark, sf)), "pct_low_confidence", "median_energy_mwh", "median_density")
    return r6(r6(out, "capacity_kw", "energy_mwh", "co2_t", digits=2), "specific_yield", digits=4)


@query(QUADRANT + " select count(*) as n_tracts, sum(kwh) / 1000 as energy_mwh, count(*) filter (where equity_class = 'high_potential_high_burden') as n_priority, count(*) filter (where equity_class = 'unknown') as n_unknown, round(min(pph) filter (where equity_class <> 'unknown'), 6) as least_potential, round(max(pph) filter (where equity_class <> 'unknown'), 6) as most_potential from z join q using (GEOID)", "buildings", "tracts", "strata")
def q_tract_headline(spark, sf):
    return r6(benchmarks.tract_headline(areas.classify_equity(equity(spark, sf))), "least_potential", "most_potential")


@query("select list_aggregate(list_transform(q, lambda v: cast(v as varchar)), 'string_agg', ',') as breaks, list_aggregate(['a', 'b', 'c', 'd', 'e'][1:len(q) + 1], 'string_agg', ',') as colours from (select list_sort(list_distinct([quantile_cont(v, 0.2), quantile_cont(v, 0.4), quantile_cont(v, 0.6), quantile_cont(v, 0.8)])) as q from (select cast(o_orderkey % 3 + 1 as double) as v from orders where o_orderkey % 7 <> 0))")
def q_ramp(spark, sf):
    k = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.when(k % 7 != 0, (k % 3 + 1).cast("double")).when(k % 2 == 0, F.lit(float("inf"))).alias("v"))
    return benchmarks.ramp(o, "v", list("abcde")).select(F.array_join("breaks", ",").alias("breaks"), F.array_join("colours", ",").alias("colours"))


BOXES = "boxes as (select n_nationkey, -77.5e0 + n_nationkey % 5 * 0.4e0 as west, 38.2e0 + cast(floor(n_nationkey / 5) as int) * 0.4e0 as south, -76.6e0 + n_nationkey % 5 * 0.4e0 as east, 39.1e0 + cast(floor(n_nationkey / 5) as int) * 0.4e0 as north from nation)"
TILE_Y = "cast(floor((1 - ln(tan(radians({lat})) + 1 / cos(radians({lat}))) / pi()) / 2 * 512) as int)"
KEY = "list_aggregate(list_transform(range(8, -1, -1), lambda i: cast(((x >> i) & 1) + 2 * ((y >> i) & 1) as varchar)), 'string_agg', '')"


def boxes(spark, sf):
    k = F.col("n_nationkey")
    row = F.floor(k / 5)
    return spark.read.parquet(f"{sf}/nation.parquet").select(k, (k % 5 * 0.4 - 77.5).alias("west"), (row * 0.4 + 38.2).alias("south"), (k % 5 * 0.4 - 76.6).alias("east"), (row * 0.4 + 39.1).alias("north"))


@query(f"with {BOXES}, t as (select n_nationkey, unnest(range(cast(floor((west + 180) / 360 * 512) as int), cast(floor((east + 180) / 360 * 512) as int) + 1)) as x, {TILE_Y.format(lat='north')} as y0, {TILE_Y.format(lat='south')} as y1 from boxes), u as (select n_nationkey, x, unnest(range(y0, y1 + 1)) as y from t) select n_nationkey, {KEY} as quadkey from u")
def q_quadkeys_of_box(spark, sf):
    return areas.quadkeys_of(boxes(spark, sf), 9).select("n_nationkey", "quadkey")


@query(f"with {BOXES} select n_nationkey from boxes where west <= -76.0 and east >= -77.0 and south <= 39.0 and north >= 38.5 and n_nationkey % 3 <> 0")
def q_catalogue_items(spark, sf):
    items = boxes(spark, sf).toDF("n_nationkey", "minx", "miny", "maxx", "maxy").withColumn("quadkey", (F.col("n_nationkey") % 3).cast("string"))
    return readers.catalogue_items(items, -77.0, 38.5, -76.0, 39.0, ["1", "2"]).select("n_nationkey")


@query("select distinct cast(c_custkey % 40 as int) as tile_row, cast(c_nationkey as int) as tile_col from customer where c_custkey % 3 = 0")
def q_tile_names(spark, sf):
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "roofs").when(k % 3 == 1, "dsm").otherwise("roofs_old")
    files = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("s3://x/tile_"), k % 40, F.lit("_"), F.col("c_nationkey"), F.lit("_"), kind, F.lit(".parquet")).alias("path"))
    return readers.tile_names(files)


@query(", w as (select cast(a as int) as r, cast(b as int) as c from range(-2, 12) t(a), range(3, 13) u(b)) select w.r, w.c, z from w left join pixels p on w.r = p.r and w.c = p.c", "pixels")
def q_window(spark, sf):
    return maps.window(fixture(spark, sf, "pixels"), -2, 11, 3, 12)


@query(ZONES + ", s as (select r, c, 800e0 + (r * 7 + c * 3) % 50 * 4 as v from pixels), m as (select r, c, case when exists (select 1 from zones where r between r0 and r1 and c between c0 and c1) then v end as z from s), q as (select quantile_cont(z, 0.02) as low, quantile_cont(z, 0.98) as high from m), k as (select r, c, z, least(255, greatest(0, floor((z - low) / (high - low) * 256))) as k from m, q) select r, c, z, case when z is null then 0 else cast(round_even(case when k < 128 then 28 + 32 * k / 128e0 else 60 + 190 * (k - 128) / 127e0 end, 0) as int) end as red, case when z is null then 0 else 255 end as alpha from k", "pixels")
def q_page_layer_insolation(spark, sf):
    p = fixture(spark, sf, "pixels")
    sun = p.select("r", "c", (((F.col("r") * 7 + F.col("c") * 3) % 50 * 4) + 800.0).alias("z"))
    return maps.page_layers(p, sun, zones(spark, sf), 2.0)["insolation"].select("r", "c", "z", "red", "alpha")


@query("select r, c, round(z, 6) as z from pixels where z is not null", "pixels")
def q_warp_identity(spark, sf):
    """Target centres are the pixels' own centres in degrees, so bilinear weights fall on one pixel each and its value comes back."""
    p = fixture(spark, sf, "pixels")
    lon, lat = rules.transverse_mercator_inverse((F.col("c") + 0.5) * 2 + 320000.0, (F.col("r") + 0.5) * 2 + 4300000.0)
    out = maps.warp(p, p.where("z is not null").select(F.col("r").alias("i"), F.col("c").alias("j"), lon.alias("lon"), lat.alias("lat")), (320000.0, 4300000.0), 2.0)
    return r6(out.toDF("r", "c", "z").withColumn("z", F.round(F.col("z") * 16, 2) / 16), "z")


@query("select GEOID, round(mx + a, 4) as maxx, round(my + b, 4) as maxy, round(2 * a * b - 360000, 1) as area_m2 from diamonds", "diamonds")
def q_reproject_polygons(spark, sf):
    """To degrees and back: bounds and area stay what they were."""
    from .functions import shapes

    there = diamonds(spark, sf).withColumn("rings", shapes.unprojected(F.col("rings")))
    back = readers.tract_geometries(there)
    at = shapes.bounds(F.col("rings"))
    return r6(r6(back.select("GEOID", at["maxx"].alias("maxx"), at["maxy"].alias("maxy"), shapes.area(F.col("rings")).alias("area_m2")), "maxx", "maxy", digits=4), "area_m2", digits=1)
