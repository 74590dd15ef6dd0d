"""The registered queries of the scoring engine, each with the SQL that an independent engine runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import fixture, with_views
from .functions import rules
from .operators import areas, checks, maps, raster, scoring, solar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable:
    def add(f: Callable) -> Callable:
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(sql, *views)
        return f

    return add


def r6(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


CLASS = "case when tilt_deg < 10 then 'flat' when aspect_deg between 90 and 270 then 'pitched_sun_facing' else 'pitched_north_facing' end"
REASON = f"case when tilt_deg is null then 'no_plane_fit' when tilt_deg > 45 then 'too_steep' when ({CLASS}) = 'pitched_north_facing' then 'north_facing' when poa_clear_sky_kwh_m2 < 800 then 'low_insolation' end"
UP = f"""u as (select *, {CLASS} as roof_class, {REASON} as reason from planes),
a as (select *, case when reason is null then greatest(0, plane_area_m2 - obstruction_area_m2) * 0.85e0 * (case when roof_class = 'flat' then 0.5e0 else 1e0 end) else 0e0 end as usable_area_m2 from u),
y as (select *, usable_area_m2 * 0.2e0 as capacity_kw, case when usable_area_m2 = 0 then 0e0 else usable_area_m2 * poa_clear_sky_kwh_m2 * 0.75e0 * 0.2e0 * 0.8e0 end as kwh from a)"""
RANK = "case when {ok} then (rank() over (partition by {ok} order by {v}) + (count(*) over (partition by {ok}, {v}) - 1) / 2e0) * 100e0 / count(*) over (partition by {ok}) else 0e0 end"
BUILT = f""", {UP},
g as (select building_id, min(n_planes) as n_planes, bool_or(reason is null) as any_ok, bool_or(low_confidence) as low_confidence, min(superstructure_frac) as superstructure_frac, min(footprint_area_m2) as footprint_area_m2, sum(usable_area_m2) as ua, sum(capacity_kw) as kw, sum(kwh) as kwh,
  arg_min({{'p': plane_id, 't': tilt_deg, 'a': aspect_deg, 'c': roof_class, 'r': reason, 'v': poa_clear_sky_kwh_m2 * 0.75e0}}, case when reason is null then -usable_area_m2 * 1000 - 1000 + plane_id else plane_id end) as top from y group by building_id),
s as (select *, any_ok and ua < 30 as small from g),
b as (select building_id, n_planes, any_ok and not small as usable, case when small then 'too_small' when any_ok then null else top.r end as unsuitable_reason, top.p as dominant_plane,
  top.t as tilt_deg, top.a as aspect_deg, top.c as roof_class, case when small then 0e0 else ua end as usable_area_m2, case when small then 0e0 else kw end as capacity_kw,
  case when small then 0e0 else kwh end as annual_energy_kwh, case when small then 0e0 else kwh end / nullif(footprint_area_m2, 0) as density, low_confidence, superstructure_frac, footprint_area_m2, top.v as poa_real_kwh_m2 from s),
built as (select *, {RANK.format(ok="(usable_area_m2 > 0 and density is not null)", v="round(density, 9)")} as suitability from b)"""


def views(sql: str) -> str:
    return BUILT + "\n" + sql


def built(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_buildings(fixture(spark, sf, "planes"))


BUILT_COLUMNS = ("building_id", "n_planes", "low_confidence", "superstructure_frac", "footprint_area_m2", "usable", "unsuitable_reason", "dominant_plane", "roof_class")
BUILT_SQL = f"select {', '.join(BUILT_COLUMNS)}, round(tilt_deg, 6) as tilt_deg, round(aspect_deg, 4) as aspect_deg, round(poa_real_kwh_m2, 6) as poa_real_kwh_m2, round(usable_area_m2, 6) as usable_area_m2, round(capacity_kw, 6) as capacity_kw, round(annual_energy_kwh + 1e-5, 3) as annual_energy_kwh, round(density + 1e-9, 6) as energy_density_kwh_m2, round(suitability, 6) as suitability from built"


def built_rows(df: DataFrame) -> DataFrame:
    names = ("tilt_deg", "aspect_deg", "poa_real_kwh_m2", "usable_area_m2", "capacity_kw", "annual_energy_kwh", "energy_density_kwh_m2", "suitability")
    past = {"annual_energy_kwh": F.col("annual_energy_kwh") + 1e-5, "energy_density_kwh_m2": F.col("energy_density_kwh_m2") + 1e-9}  # past exact halves
    df = df.withColumns(past).select(*BUILT_COLUMNS, *names)
    return r6(r6(r6(df, "tilt_deg", "poa_real_kwh_m2", "usable_area_m2", "capacity_kw", "energy_density_kwh_m2", "suitability"), "aspect_deg", digits=4), "annual_energy_kwh", digits=3)


@query(views(BUILT_SQL), "planes")
def q_score_buildings(spark, sf):
    return built_rows(built(spark, sf))


@query(f"select building_id, plane_id, {CLASS} as roof_class, {REASON} as unsuitable_reason, ({REASON}) is null as usable from planes", "planes")
def q_roof_class(spark, sf):
    return scoring.classified(fixture(spark, sf, "planes")).select("building_id", "plane_id", "roof_class", "unsuitable_reason", "usable")


@query(f"select building_id, {CLASS} as roof_class, case when ({REASON}) is null and footprint_area_m2 * 0.7e0 < 30 then 'too_small' else {REASON} end as unsuitable_reason, round(case when ({REASON}) is null and footprint_area_m2 * 0.7e0 >= 30 then footprint_area_m2 * 0.7e0 else 0e0 end, 6) as usable_area_m2 from buildings", "buildings")
def q_usable_area_footprint(spark, sf):
    return r6(scoring.usable_footprints(fixture(spark, sf, "buildings")).select("building_id", "roof_class", "unsuitable_reason", "usable_area_m2"), "usable_area_m2")


@query(f", {UP} select building_id, plane_id, round(usable_area_m2, 6) as usable_area_m2 from y", "planes")
def q_usable_area_plane(spark, sf):
    return r6(scoring.usable_planes(fixture(spark, sf, "planes")).select("building_id", "plane_id", "usable_area_m2"), "usable_area_m2")


@query(f", {UP} select building_id, plane_id, round(capacity_kw, 6) as capacity_kw, round(kwh, 4) as annual_energy_kwh, round(kwh * 0.35e0, 4) as annual_co2_kg from y", "planes")
def q_plane_yields(spark, sf):
    out = scoring.plane_yields(scoring.usable_planes(fixture(spark, sf, "planes")))
    return r6(r6(out.select("building_id", "plane_id", "capacity_kw", "annual_energy_kwh", "annual_co2_kg"), "capacity_kw"), "annual_energy_kwh", "annual_co2_kg", digits=4)


@query(f", f as (select *, case when ({REASON}) is null and footprint_area_m2 * 0.7e0 >= 30 then footprint_area_m2 * 0.7e0 else 0e0 end as ua from buildings) select building_id, round(ua * 0.2e0, 6) as capacity_kw, round(ua * poa_clear_sky_kwh_m2 * 0.75e0 * 0.2e0 * 0.8e0, 4) as annual_energy_kwh from f", "buildings")
def q_footprint_yield(spark, sf):
    out = scoring.footprint_yield(fixture(spark, sf, "buildings")).select("building_id", "capacity_kw", "annual_energy_kwh")
    return r6(r6(out, "capacity_kw"), "annual_energy_kwh", digits=4)


@query(views("select " + ", ".join(f"count(*) filter (where unsuitable_reason = '{r}') as {r}" for r in ("no_plane_fit", "too_steep", "north_facing", "low_insolation", "too_small")) + ", count(*) filter (where usable) as suitable from built"), "planes")
def q_reason_counts(spark, sf):
    return checks.reason_counts(built(spark, sf))


@query(f"select building_id, round({RANK.format(ok='usable', v='energy_density')}, 6) as suitability from buildings", "buildings")
def q_suitability_rank(spark, sf):
    return r6(scoring.percentile_rank(fixture(spark, sf, "buildings"), "energy_density", F.col("usable")).select("building_id", "suitability"), "suitability")


@query(f"select building_id, round({RANK.format(ok='usable', v='energy_density')}, 6) as suitability from buildings", "buildings")
def q_city_rerank(spark, sf):
    tiled = areas.with_tile(fixture(spark, sf, "buildings"))
    merged = areas.merge_tiles(*(tiled.where(F.pmod("tile_row", F.lit(2)) == k) for k in (0, 1)))
    return r6(scoring.percentile_rank(merged, "energy_density", F.col("usable")).select("building_id", "suitability"), "suitability")


PLACED = ", placed as (select b.building_id, min(t.GEOID) as GEOID from buildings b join tracts t on b.x between t.minx and t.maxx and b.y between t.miny and t.maxy group by 1)"


@query(PLACED + " select GEOID, count(*) as n_buildings, count(*) filter (where usable) as n_usable, median(energy_density) as median_suitability, sum(footprint_area_m2) as usable_area_m2, sum(footprint_area_m2) * 2 as capacity_kw, sum(poa_clear_sky_kwh_m2) as annual_energy_kwh, sum(aspect_deg) as annual_co2_kg, count(*) filter (where usable) * 100e0 / count(*) as pct_usable from placed join buildings using (building_id) group by 1", "buildings", "tracts")
def q_tract_rollup(spark, sf):
    b = fixture(spark, sf, "buildings").withColumnsRenamed({"energy_density": "suitability", "footprint_area_m2": "usable_area_m2"})
    b = b.withColumns({"capacity_kw": F.col("usable_area_m2") * 2, "annual_energy_kwh": F.col("poa_clear_sky_kwh_m2"), "annual_co2_kg": F.col("aspect_deg")})
    out = areas.tract_rollup(b, fixture(spark, sf, "tracts"))
    return out.withColumn("pct_usable", F.col("pct_usable").cast("double"))


BURDEN = "burden as (select FIP as GEOID, sum(cost) / case when sum(income) > 0 then sum(income) end as energy_burden from strata group by 1)"
EQUITY = f"{PLACED}, {BURDEN}, e as (select GEOID, sum(footprint_area_m2 * 100) as kwh from placed join buildings using (building_id) group by 1), q as (select e.GEOID, kwh, kwh / nullif(households, 0) as pph, kwh / nullif(population, 0) as ppc, energy_burden from e left join tracts t on e.GEOID = t.GEOID left join burden b on e.GEOID = b.GEOID)"


def equity(spark, sf):
    b, t = fixture(spark, sf, "buildings"), fixture(spark, sf, "tracts")
    e = b.join(areas.assign_tracts(b, t), "building_id").groupBy("GEOID").agg(F.sum(F.col("footprint_area_m2") * 100).alias("annual_energy_kwh"))
    return areas.attach_equity(e, t.select("GEOID", "households", "population"), areas.energy_burden(fixture(spark, sf, "strata")))


@query(EQUITY + " select GEOID, round(pph, 6) as potential_per_household, round(ppc, 6) as potential_per_capita, round(energy_burden, 6) as energy_burden, (pph is null or energy_burden is null) as equity_data_missing from q", "buildings", "tracts", "strata")
def q_tract_equity(spark, sf):
    return r6(equity(spark, sf).drop("annual_energy_kwh", "households", "population"), "potential_per_household", "potential_per_capita", "energy_burden")


QUADRANT = EQUITY + ", m as (select median(pph) as p, median(energy_burden) as b from q where pph is not null and energy_burden is not null), z as (select GEOID, case when pph is null or energy_burden is null then 'unknown' else case when pph >= p then 'high' else 'low' end || '_potential_' || case when energy_burden >= b then 'high' else 'low' end || '_burden' end as equity_class from q, m)"


@query(QUADRANT + " select GEOID, equity_class, equity_class = 'high_potential_high_burden' as is_priority from z", "buildings", "tracts", "strata")
def q_equity_quadrant(spark, sf):
    return areas.classify_equity(equity(spark, sf)).select("GEOID", "equity_class", "is_priority")


@query(QUADRANT + " select equity_class, count(*) as n from z group by 1", "buildings", "tracts", "strata")
def q_class_counts(spark, sf):
    return areas.classify_equity(equity(spark, sf)).groupBy("equity_class").agg(F.count("*").alias("n"))


@query(", c as (select FIP as GEOID, sum(income) as income, coalesce(sum(cost), 0) as a, coalesce(sum(gas), 0) as b, coalesce(sum(fuel), 0) as c from strata group by 1) select GEOID, round(case when income > 0 then (a + b + c) / income end, 9) as energy_burden from c", "strata")
def q_energy_burden(spark, sf):
    return r6(areas.energy_burden(fixture(spark, sf, "strata"), ("cost", "gas", "fuel")), "energy_burden", digits=9)


@query("select lpad(cast(n_nationkey as varchar), 2, '0') || '001' || lpad(cast(n_regionkey as varchar), 6, '0') as GEOID, cast(n_nationkey * 10 as double) as population, case when n_nationkey % 3 = 0 then null else cast(n_nationkey as double) end as households, case when n_nationkey % 4 <> 0 then 1000e0 + n_nationkey end as median_income from nation")
def q_acs_parse(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    row = F.concat(F.lit('["x","'), (F.col("n_nationkey") * 10).cast("string"), F.lit('","'), F.when(F.col("n_nationkey") % 3 == 0, "-666666666").otherwise(F.col("n_nationkey").cast("string")), F.lit('","'), F.when(F.col("n_nationkey") % 4 == 0, "n/a").otherwise((F.col("n_nationkey") + 1000).cast("string")), F.lit('","'), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit('","001","'), F.lpad(F.col("n_regionkey").cast("string"), 6, "0"), F.lit('"]'))
    head = F.lit('[["NAME","B01003_001E","B25003_001E","B19013_001E","state","county","tract"],')
    return checks.census_rows(n.select(F.concat(head, row, F.lit("]")).alias("body")))


@query("select c_custkey, lpad(cast(c_custkey * 7919 as varchar), 11, '0') as GEOID from customer")
def q_geoid_normalise(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", rules.geoid(F.col("c_custkey") * 7919).alias("GEOID"))


TILE = "cast(floor((y - 4295000) / 2000) as int) as tile_row, cast(floor((x - 315000) / 2000) as int) as tile_col"


@query(f"select building_id, {TILE} from buildings", "buildings")
def q_tile_index(spark, sf):
    return areas.with_tile(fixture(spark, sf, "buildings")).select("building_id", "tile_row", "tile_col")


@query("select distinct cast(r as int) as tile_row, cast(c as int) as tile_col, cast(315000 + c * 2000 as double) as minx, cast(4295000 + r * 2000 as double) as miny from tracts, range(-1, 20) a(r), range(-1, 20) b(c) where 315000 + c * 2000 <= maxx and 317000 + c * 2000 >= minx and 4295000 + r * 2000 <= maxy and 4297000 + r * 2000 >= miny", "tracts")
def q_tile_grid(spark, sf):
    return areas.tile_grid(fixture(spark, sf, "tracts"))


@query("select count(*) as n, count(*) as n_by_tile from buildings", "buildings")
def q_tile_conservation(spark, sf):
    tiles = areas.with_tile(fixture(spark, sf, "buildings")).groupBy("tile_row", "tile_col").count()
    return tiles.agg(F.sum("count").alias("n_by_tile")).join(fixture(spark, sf, "buildings").agg(F.count("*").alias("n")))


@query("select building_id, cast(r as int) as tile_row, cast(c as int) as tile_col from buildings, range(-1, 20) a(r), range(-1, 20) b(c) where x >= 315000 + c * 2000 - 300 and x < 317000 + c * 2000 + 300 + (case when (x - 315000 - 300) % 2000 = 0 then 1 else 0 end) and y >= 4295000 + r * 2000 - 300 and y < 4297000 + r * 2000 + 300 + (case when (y - 4295000 - 300) % 2000 = 0 then 0 else 0 end) and x - 300 < 317000 + c * 2000 and y - 300 < 4297000 + r * 2000", "buildings")
def q_halo_replicate(spark, sf):
    return areas.halo(fixture(spark, sf, "buildings")).select("building_id", "tile_row", "tile_col")


@query("""select c_custkey, list_aggregate(list_transform(range(8, -1, -1), lambda i: cast(((x >> i) & 1) + 2 * ((y >> i) & 1) as varchar)), 'string_agg', '') as quadkey from
 (select c_custkey, cast(floor((lon + 180) / 360 * 512) as int) as x, cast(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 512) as int) as y from
 (select c_custkey, -77.5e0 + (c_custkey % 100) * 0.011e0 as lon, 38.5e0 + (c_custkey % 37) * 0.021e0 as lat from customer))""")
def q_quadkey_cover(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return c.select("c_custkey", rules.quadkey(F.col("c_custkey") % 100 * 0.011 - 77.5, F.col("c_custkey") % 37 * 0.021 + 38.5, 9).alias("quadkey"))


@query("select pixel, round(case when count(wh) = 12 then sum(wh * [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month]) / 1000 end, 4) as kwh_m2 from daily group by 1", "daily")
def q_annual_insolation(spark, sf):
    return r6(raster.annual_insolation(fixture(spark, sf, "daily")), "kwh_m2", digits=4)


ZONES = ", zones as (select n_nationkey as zone, n_nationkey % 15 as r0, n_nationkey % 15 + 3 as r1, n_nationkey % 7 as c0, n_nationkey % 7 + 4 as c1 from nation)"


def zones(spark, sf):
    k = F.col("n_nationkey")
    return spark.read.parquet(f"{sf}/nation.parquet").select(k.alias("zone"), (k % 15).alias("r0"), (k % 15 + 3).alias("r1"), (k % 7).alias("c0"), (k % 7 + 4).alias("c1"))


@query(ZONES + " select zone, round(avg(z), 6) as mean, count(z) as n_px from zones left join pixels on r between r0 and r1 and c between c0 and c1 group by 1", "pixels")
def q_zonal_mean(spark, sf):
    return r6(raster.zonal_mean(zones(spark, sf), fixture(spark, sf, "pixels")), "mean")


@query(ZONES + " select r, c, case when exists (select 1 from zones where r between r0 and r1 and c between c0 and c1) then z end as z from pixels", "pixels")
def q_mask_to_footprints(spark, sf):
    return raster.masked(fixture(spark, sf, "pixels"), zones(spark, sf)).select("r", "c", "z")


GRAD = """, e as (select *, lag(z) over wr as zl, lead(z) over wr as zn, lag(c) over wr is null as f1, lead(c) over wr is null as l1, lag(z) over wc as zu, lead(z) over wc as zd, lag(r) over wc is null as f2, lead(r) over wc is null as l2
 from pixels window wr as (partition by r order by c), wc as (partition by c order by r)),
d as (select r, c, case when z is not null then case when f1 and l1 then null when f1 then (zn - z) / 2 when l1 then (z - zl) / 2 else (zn - zl) / 4 end end as gx,
 case when z is not null then case when f2 and l2 then null when f2 then (zd - z) / 2 when l2 then (z - zu) / 2 else (zd - zu) / 4 end end as gy from e)"""


@query(GRAD + " select r, c, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) as slope, round(case when gx <> 0 or gy <> 0 then (case when degrees(atan2(-gx, gy)) < 0 then degrees(atan2(-gx, gy)) + 360 else degrees(atan2(-gx, gy)) end) end, 6) as aspect from d", "pixels")
def q_surface_slope_aspect(spark, sf):
    return r6(raster.slope_aspect(fixture(spark, sf, "pixels"), 2.0).select("r", "c", "slope", "aspect"), "slope", "aspect")


@query(GRAD + " select r, c, round(greatest(0, least(255, 255 * (-gx * sin(radians(315)) * cos(radians(45)) + gy * cos(radians(315)) * cos(radians(45)) + sin(radians(45))) / sqrt(1 + gx * gx + gy * gy))) + gx * 0 + gy * 0, 6) as shade from d", "pixels")
def q_hillshade(spark, sf):
    return r6(raster.hillshade(fixture(spark, sf, "pixels"), 2.0).select("r", "c", "shade"), "shade")


@query("select quantile_cont(z, 0.02) as p2, quantile_cont(z, 0.98) as p98 from pixels", "pixels")
def q_percentile_stretch(spark, sf):
    return fixture(spark, sf, "pixels").agg(F.percentile("z", F.lit(0.02)).alias("p2"), F.percentile("z", F.lit(0.98)).alias("p98"))


@query("select cast(k as int) as level, cast(floor(r / pow(2, k)) as int) as r, cast(floor(c / pow(2, k)) as int) as c, round(avg(z), 6) as z from pixels, range(1, 4) t(k) group by k, floor(r / pow(2, k)), floor(c / pow(2, k))", "pixels")
def q_overview_pyramid(spark, sf):
    return r6(raster.overviews(fixture(spark, sf, "pixels"), 3), "z")


LSQ = ", m as (select building_id, count(*) as n, avg(x) as mx, avg(y) as my, avg(z) as mz, covar_pop(x, x) as xx, covar_pop(y, y) as yy, covar_pop(x, y) as xy, covar_pop(x, z) as xz, covar_pop(y, z) as yz from cloud group by 1), l as (select *, case when xx * yy - xy * xy > 1e-9 * xx * yy then xx * yy - xy * xy end as det from m), p as (select building_id, n, (xz * yy - yz * xy) / det as a, (yz * xx - xz * xy) / det as b, mz - (xz * yy - yz * xy) / det * mx - (yz * xx - xz * xy) / det * my as c from l)"


@query(LSQ + " select building_id, n, round(a + 1e-6, 3) as a, round(b + 1e-6, 3) as b, round(c + 1e-6, 3) as c from p", "cloud")
def q_lsq_plane(spark, sf):
    return r6(raster.lsq_planes(fixture(spark, sf, "cloud")).withColumns({k: F.col(k) + 1e-6 for k in "abc"}), "a", "b", "c", digits=3)  # past exact halves


@query(LSQ + " select building_id, round(sqrt(avg(pow(z - a * x - b * y - c, 2))), 4) as rmse, round(100 * avg(case when abs(z - a * x - b * y - c) <= 0.5e0 then 1e0 when a is not null then 0e0 end), 4) as pct_within, count(a) as n from cloud join p using (building_id) where n <> 3 group by 1", "cloud")
def q_self_consistency(spark, sf):
    """Groups of three points lie on their plane up to rounding noise; the tolerance is not asked of those."""
    planes = raster.lsq_planes(fixture(spark, sf, "cloud")).where("n <> 3").select("building_id", "a", "b", "c")
    off = fixture(spark, sf, "cloud").join(planes, "building_id").withColumn("off", F.col("z") - F.col("a") * F.col("x") - F.col("b") * F.col("y") - F.col("c"))
    return r6(raster.self_consistency(off), "rmse", "pct_within", digits=4)


@query("""select building_id, x, y, z, arg_min(plane_id, k) as plane_id, round(arg_min(off, k), 6) as off from
 (select building_id, x, y, z, p.plane_id, z - (p.a * x + p.c) as off, abs(z - (p.a * x + p.c)) * 1000000 + p.plane_id * 0.0001e0 as k from cloud, (values (0, 0.5e0, 10e0), (1, 1e0, 20e0)) p(plane_id, a, c)) group by building_id, x, y, z""", "cloud")
def q_residuals(spark, sf):
    cloud = fixture(spark, sf, "cloud").drop("plane_id")
    two = cloud.select("building_id").distinct().join(F.broadcast(spark.createDataFrame([(0, 0.5, 0.0, 10.0), (1, 1.0, 0.0, 20.0)], "plane_id int, a double, b double, c double")))
    return r6(raster.residuals(cloud, two), "off")


#: Facets and class to archetype, as a table: one or two planes, three or more.
TYPE = f"(case when ({CLASS}) = 'flat' then ['flat', 'complex'] else ['gable', 'hip'] end)[1 + cast(n_planes > 2 as int)]"


@query(f"select building_id, {TYPE} as roof_type from buildings", "buildings")
def q_roof_type(spark, sf):
    return fixture(spark, sf, "buildings").select("building_id", rules.roof_type(F.col("n_planes"), rules.roof_class(F.col("tilt_deg"), F.col("aspect_deg"))).alias("roof_type"))


@query(", s as (select *, case when n_planes >= 3 then 'complex' else 'simple' end as kind from spots where tilt_deg is not null and footprint_area_m2 >= 50), o as (select *, row_number() over (partition by area, kind order by md5('7|' || cast(id as varchar)), id) as n from s) select id, area, kind from o where n <= 2", "spots")
def q_spot_sample(spark, sf):
    s = fixture(spark, sf, "spots").where("tilt_deg is not null and footprint_area_m2 >= 50").withColumn("kind", F.when(F.col("n_planes") >= 3, "complex").otherwise("simple"))
    return areas.stratified_sample(s, ["area", "kind"], "id", 2, "7").select("id", "area", "kind")


PARSED = ", m as (select *, case when lower(trim(has_obstruction)) in ('y', 'yes', 'true', '1') then true when lower(trim(has_obstruction)) in ('n', 'no', 'false', '0') then false end as said, upper(trim(coalesce(notes, ''))) like 'EXCLUDE%' as ex from marks), k as (select *, model_planes - least(label_planes, 4) as diff, case when said is null then null when said and found then 'hit' when said then 'miss' when found then 'false_positive' else 'true_negative' end as outcome from m where not ex)"


@query(PARSED + " select building_id, said as obstruction, ex as is_excluded from m", "marks")
def q_label_parse(spark, sf):
    return checks.parsed_labels(fixture(spark, sf, "marks")).select("building_id", "obstruction", "is_excluded")


@query(PARSED + " select building_id, diff as plane_diff, abs(diff) <= 1 as agree_1, outcome as obstruction_outcome from k", "marks")
def q_label_compare(spark, sf):
    return checks.compared(fixture(spark, sf, "marks")).select("building_id", "plane_diff", "agree_1", "obstruction_outcome")


@query(PARSED + " select count(*) as n, count(*) filter (where diff = 0) as n_exact, count(*) filter (where abs(diff) <= 1) as n_within_1, " + ", ".join(f"count(*) filter (where outcome = '{o}') as n_{o}" for o in ("hit", "miss", "false_positive", "true_negative")) + " from k", "marks")
def q_spot_summary(spark, sf):
    return checks.spot_summary(checks.compared(fixture(spark, sf, "marks")))


@query("select o_custkey as building_id, 'duplicate' as problem from orders group by 1 having count(*) > 1 union all select distinct o_custkey, 'unknown' from orders where o_custkey not in (select c_custkey from customer where c_custkey % 2 = 0)")
def q_label_problems(spark, sf):
    labels = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("building_id"))
    known = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("building_id"))
    return checks.duplicate_labels(labels, known)


@query("select o_orderkey, round_even(o_totalprice / 7, 1) as rounded from orders")
def q_half_even(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", rules.rounded(F.col("o_totalprice") / 7, 1).alias("rounded"))


@query(views("select count(*) as n_roofs, count(*) filter (where usable) as n_usable, round(sum(capacity_kw), 2) as kw, round(sum(annual_energy_kwh), 2) as kwh, round(median(case when usable then annual_energy_kwh end), 4) as median_kwh, round(sum(annual_energy_kwh) / sum(capacity_kw), 4) as specific_yield, abs(sum(annual_energy_kwh) / sum(capacity_kw) - 1150) / 1150 <= 0.15 as passes from built"), "planes")
def q_headline(spark, sf):
    return r6(r6(checks.headline(built(spark, sf)), "kw", "kwh", digits=2), "median_kwh", "specific_yield", digits=4)


@query("select cast(i - 1 as int) as i, q[i] as at from (select q, unnest(range(1, len(q) + 1)) as i from (select list_sort(list_distinct(quantile_cont(energy_density, [0.2, 0.4, 0.6, 0.8]))) as q from buildings))", "buildings")
def q_quantile_breaks(spark, sf):
    return checks.quantile_breaks(fixture(spark, sf, "buildings"), "energy_density")


@query("select cast(floor(aspect_deg / 22.5e0) as int) as bin, sum(plane_area_m2) as area from planes where tilt_deg >= 10 group by 1", "planes")
def q_aspect_rose(spark, sf):
    return checks.aspect_rose(fixture(spark, sf, "planes"))


@query("select building_id, round(case when poa_clear_sky_kwh_m2 * 0.75e0 >= 800 and tilt_deg <= 45 and (tilt_deg <= 10 or (aspect_deg > 22.5e0 and aspect_deg < 337.5e0)) and footprint_area_m2 >= 30 then footprint_area_m2 * poa_clear_sky_kwh_m2 * 0.75e0 * 0.216e0 * 0.83e0 else 0e0 end, 4) as external_kwh from buildings", "buildings")
def q_external_method(spark, sf):
    return r6(checks.external_method(fixture(spark, sf, "buildings")), "external_kwh", digits=4)


@query("select cast(r as int) as tile_row, cast(c as int) as tile_col, (r + c) % 3 = 0 as is_current from range(0, 12) a(r), range(0, 10) b(c)")
def q_manifest_resume(spark, sf):
    tiles = spark.range(120).select((F.col("id") / 10).cast("int").alias("tile_row"), (F.col("id") % 10).cast("int").alias("tile_col"))
    k = F.col("tile_row") + F.col("tile_col")
    manifest = tiles.select("tile_row", "tile_col", F.when(k % 3 == 2, "failed").otherwise("done").alias("status"), F.when(k % 3 == 1, "old").otherwise("key").alias("stamp"))
    return areas.done_tiles(tiles, manifest, "key")


@query("select count(*) as n, count(tilt_deg) as n_tilt from (select building_id, tilt_deg from buildings union all select building_id, null from buildings where n_planes = 1)", "buildings")
def q_merge_tiles(spark, sf):
    b = fixture(spark, sf, "buildings")
    return areas.merge_tiles(b, b.where("n_planes = 1").drop("tilt_deg")).agg(F.count("*").alias("n"), F.count("tilt_deg").alias("n_tilt"))


@query(", e as (select z, 'h' as kind, r as i, c as j, 1 as d from pixels union all select z, 'h', r + 1, c, -1 from pixels union all select z, 'v', r, c, 1 from pixels union all select z, 'v', r, c + 1, -1 from pixels) select z, kind, i, j, cast(sum(d) as bigint) as d from e group by 1, 2, 3, 4 having sum(d) <> 0", "pixels")
def q_pixel_union_edges(spark, sf):
    return checks.pixel_edges(fixture(spark, sf, "pixels"), "z")


@query("select GEOID, (maxx - minx) * (maxy - miny) as area, round((minx + maxx) / 2, 4) as cx, round((miny + maxy) / 2, 4) as cy from tracts", "tracts")
def q_polygon_area_centroid(spark, sf):
    t = fixture(spark, sf, "tracts")
    # about a local origin, so that products of coordinates stay exact
    ring = rules.box_ring(F.lit(0.0), F.lit(0.0), F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    cx, cy = rules.ring_centroid(ring)
    return r6(t.select("GEOID", rules.ring_area(ring).alias("area"), (F.col("minx") + cx).alias("cx"), (F.col("miny") + cy).alias("cy")), "cx", "cy", digits=4)


@query("select building_id, x between 319000 and 323000 and y between 4300000 and 4310000 as inclusive, x > 319000 and x < 323000 and y > 4300000 and y < 4310000 as strict from buildings", "buildings")
def q_point_in_polygon(spark, sf):
    ring = rules.box_ring(*(F.lit(float(v)) for v in (319000, 4300000, 323000, 4310000)))
    inside = lambda b: rules.point_in_ring(F.col("x"), F.col("y"), ring, b)
    return fixture(spark, sf, "buildings").select("building_id", inside(True).alias("inclusive"), inside(False).alias("strict"))


@query()
def q_crs_forward(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    x, y = rules.transverse_mercator(F.col("c_custkey") % 100 * 0.01 - 77.5, F.col("c_custkey") % 37 * 0.02 + 38.5)
    return c.select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(views("select building_id, roof_class, unsuitable_reason, usable, round_even(tilt_deg, 1) as tilt_deg, round_even(aspect_deg, 0) as aspect_deg from built"), "planes")
def q_roof_web(spark, sf):
    return checks.roof_web(built(spark, sf)).select("building_id", "roof_class", "unsuitable_reason", "usable", "tilt_deg", "aspect_deg")


@query("select building_id, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][cast(round(aspect_deg / 45) as int) % 8 + 1] as point from buildings", "buildings")
def q_compass(spark, sf):
    return fixture(spark, sf, "buildings").select("building_id", rules.compass(F.col("aspect_deg")).alias("point"))


@query()
def q_irradiance_day(spark, sf):
    return solar.irradiance(fixture(spark, sf, "pixels"), res=2.0)


@query()
def q_shading_loss(spark, sf):
    return solar.shading_loss(solar.irradiance(fixture(spark, sf, "pixels"), res=2.0))


@query(", l as (select r, c, z, 1 as ord from pixels union all select r, c, case when c % 3 = 0 then null else z + 1 end, 0 from pixels where r % 2 = 0) select r, c, arg_min(z, ord) filter (where z is not null) as z from l group by 1, 2", "pixels")
def q_mosaic(spark, sf):
    p = fixture(spark, sf, "pixels")
    first = p.where("r % 2 = 0").select("r", "c", F.when(F.col("c") % 3 != 0, F.col("z") + 1).alias("z"), F.lit(0).alias("ord"))
    return maps.mosaic(p.withColumn("ord", F.lit(1)).unionByName(first))


@query(""", t as (select r as i, c as j, r * 0.75e0 + 0.25e0 as fr, c * 0.6e0 + 0.1e0 as fc from pixels),
n as (select i, j, floor(fr) + dr as r, floor(fc) + dc as c, (case dr when 0 then 1 - (fr - floor(fr)) else fr - floor(fr) end) * (case dc when 0 then 1 - (fc - floor(fc)) else fc - floor(fc) end) as w
 from t, (values (0), (1)) a(dr), (values (0), (1)) b(dc))
select i, j, round(sum(w * z) / nullif(sum(w) filter (where z is not null), 0), 6) as z from n left join pixels p on n.r = p.r and n.c = p.c group by 1, 2""", "pixels")
def q_resample_bilinear(spark, sf):
    p = fixture(spark, sf, "pixels")
    places = p.select(F.col("r").alias("i"), F.col("c").alias("j"), (F.col("r") * 0.75 + 0.25).alias("fr"), (F.col("c") * 0.6 + 0.1).alias("fc"))
    return r6(maps.resample(p, places, ["i", "j"]), "z")


def _rgb(step: str, name: int) -> str:
    low, mid, high = (s[name] for s in maps.STOPS)
    return f"cast(round_even(case when {step} < 128 then {low} + {mid - low} * {step} / 128e0 else {mid} + {high - mid} * ({step} - 128) / 127e0 end, 0) as int)"


@query(f", s as (select r, c, z, least(255, greatest(0, floor((z - 300) / 2 * 256))) as k from pixels) select r, c, {', '.join(f'case when z is null then 0 else {_rgb("k", i)} end as {n}' for i, n in enumerate(('red', 'green', 'blue')))}, case when z is null then 0 else 255 end as alpha from s", "pixels")
def q_colour_map(spark, sf):
    return maps.coloured(fixture(spark, sf, "pixels"), 300.0, 302.0).drop("z")


@query(f", b as (select min(z) as low, max(z) as high from pixels), s as (select cast(i as int) as i, low + (high - low) * i / 4e0 as value, floor(i * 255 / 4e0) as k from b, range(5) t(i)) select i, round(value, 6) as value, '#' || lower({' || '.join(f'lpad(to_hex({_rgb("k", i)}), 2, {chr(39)}0{chr(39)})' for i in range(3))}) as colour from s", "pixels")
def q_legend_stops(spark, sf):
    ends = fixture(spark, sf, "pixels").agg(F.min("z").alias("low"), F.max("z").alias("high"))
    return r6(maps.legend(ends, 5), "value")


@query(ZONES + " select zone, count(z) as n_px, round(median(z - 290 - r % 4 * 0.5e0), 6) as median, round(quantile_cont(z - 290 - r % 4 * 0.5e0, 0.9), 6) as p90 from zones left join pixels on r between r0 and r1 and c between c0 and c1 group by 1", "pixels")
def q_height_above_ground(spark, sf):
    p = fixture(spark, sf, "pixels")
    return r6(maps.heights(p, p.select("r", "c", (290 + F.col("r") % 4 * 0.5).alias("z")), zones(spark, sf)), "median", "p90")


POINTS = "points as (select c_custkey, -77.5e0 + (c_custkey % 100) * 0.011e0 as lon, 38.5e0 + (c_custkey % 37) * 0.021e0 as lat from customer)"
TILES = "tiles as (select c_custkey, cast(z as int) as zoom, cast(floor((lon + 180) / 360 * pow(2, z)) as int) as tile_x, cast(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * pow(2, z)) as int) as tile_y from points, range(13, 17) t(z))"


def tiled_points(spark, sf, most=None):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    at = c.select("c_custkey", (F.col("c_custkey") % 100 * 0.011 - 77.5).alias("lon"), (F.col("c_custkey") % 37 * 0.021 + 38.5).alias("lat"))
    return maps.map_tiles(at, "c_custkey", most=most)


@query(f"with {POINTS}, {TILES} select c_custkey, zoom, tile_x, tile_y from (select *, row_number() over (partition by zoom, tile_x, tile_y order by c_custkey) as k from tiles) where k <= 2")
def q_map_tiles(spark, sf):
    return tiled_points(spark, sf, 2)


@query(f"with {POINTS}, {TILES} select min(zoom) as min_zoom, max(zoom) as max_zoom, count(distinct struct_pack(zoom, tile_x, tile_y)) as n_tiles from tiles")
def q_zoom_range(spark, sf):
    return tiled_points(spark, sf).agg(F.min("zoom").alias("min_zoom"), F.max("zoom").alias("max_zoom"), F.countDistinct("zoom", "tile_x", "tile_y").alias("n_tiles"))


@query("""select '{"type":"Feature","properties":{"GEOID":"' || GEOID || '"},"geometry":{"type":"Polygon","coordinates":[[[' || minx || ',' || miny || '],[' || maxx || ',' || miny || '],[' || maxx || ',' || maxy || '],[' || minx || ',' || maxy || '],[' || minx || ',' || miny || ']]]}}' as feature from tracts""", "tracts")
def q_geojson(spark, sf):
    return maps.features(fixture(spark, sf, "tracts"), rules.box_ring(*map(F.col, ("minx", "miny", "maxx", "maxy"))), "GEOID")


@query("select c_custkey, round(-77.5e0 + (c_custkey % 100) * 0.01e0, 8) as lon, round(38.5e0 + (c_custkey % 37) * 0.02e0, 8) as lat from customer")
def q_crs_inverse(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    x, y = rules.transverse_mercator(F.col("c_custkey") % 100 * 0.01 - 77.5, F.col("c_custkey") % 37 * 0.02 + 38.5)
    lon, lat = rules.transverse_mercator_inverse(F.col("x"), F.col("y"))
    return c.select("c_custkey", x.alias("x"), y.alias("y")).select("c_custkey", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))
