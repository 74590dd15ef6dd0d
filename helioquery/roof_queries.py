"""Registered queries of the fitting chain, over roofs whose facets are known, each with SQL that states them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixtures import fixture
from .operators import facets
from .queries import BUILT_SQL, CLASS, UP, built_rows, query, r6, views

ORIGIN, RES = (0.0, 0.0), 2.0
#: Facets of each kind of roof: slope along x, and the height at the roof's corner pixel.
TRUTH = """, truth as (select * from (values (0, 0, 1, 72, 0e0, 100e0), (1, 0, 2, 40, 0.5e0, 100e0), (1, 1, 2, 32, -0.5e0, 109e0), (2, 0, 3, 32, 0.75e0, 100e0),
  (2, 1, 3, 24, 0e0, 98e0), (2, 2, 3, 16, -2.25e0, 122.5e0), (3, 0, 1, 60, 0e0, 100e0), (4, 0, 1, 5, null, null)) t(kind, plane_id, n_planes, n_px, a, z0)),
facets as (select c_custkey as building_id, plane_id, n_planes, degrees(atan(abs(a))) as tilt_deg, case when a > 0 then 270e0 when a < 0 then 90e0 when a = 0 then 180e0 end as aspect_deg,
  case when a is not null then n_px / 72e0 end as inlier_ratio, n_px, a, case when a is not null then 0e0 end as b, z0 - a * (c_custkey % 100 * 40 + 1) as c, kind = 4 as low_confidence,
  case when kind = 3 then 12 / 72e0 else 0e0 end as superstructure_frac, kind from truth join customer on c_custkey % 5 = kind)"""
AREAS = """, areas as (select building_id, greatest(facet, 0) as plane_id, count(*) * 4e0 as plane_area_m2, count(*) filter (where block) * 4e0 as obstruction_area_m2 from roof_px group by 1, 2),
poa as (select building_id, facet as plane_id, avg(kwh_m2) as poa_clear_sky_kwh_m2 from roof_px join sun on r = floor(y / 2) and c = floor(x / 2) where not block and facet >= 0 group by 1, 2),
planes as (select building_id, plane_id, cast(n_planes as int) as n_planes, tilt_deg, aspect_deg, poa_clear_sky_kwh_m2, plane_area_m2, obstruction_area_m2, low_confidence, superstructure_frac,
  case when kind = 4 then 20e0 else 288e0 end as footprint_area_m2 from facets left join areas using (building_id, plane_id) left join poa using (building_id, plane_id))"""


def px(spark, sf):
    return fixture(spark, sf, "roof_px").select("building_id", "x", "y", "z")


@query(TRUTH + " select building_id, plane_id, n_planes, round(tilt_deg, 6) as tilt_deg, round(aspect_deg, 4) as aspect_deg, round(inlier_ratio, 9) as inlier_ratio, n_px, round(a, 6) as a, round(b, 6) as b, round(c, 4) as c, low_confidence, round(superstructure_frac, 9) as superstructure_frac from facets", "roof_px")
def q_fit_planes(spark, sf):
    out = facets.fit_planes(px(spark, sf)).drop("inlier_xy")
    return r6(r6(r6(out, "tilt_deg", "a", "b"), "inlier_ratio", "superstructure_frac", digits=9), "aspect_deg", "c", digits=4)


@query("select building_id, facet as plane_id, x, y from roof_px where facet >= 0 and not block", "roof_px")
def q_facet_members(spark, sf):
    return facets.fit_planes(px(spark, sf)).select("building_id", "plane_id", F.inline("inlier_xy"))


@query(TRUTH + " select building_id, round(tilt_deg, 6) as tilt_deg, round(aspect_deg, 4) as aspect_deg, round(inlier_ratio, 9) as inlier_ratio, case when kind = 4 then 5 else 72 end as n_px, kind = 4 or kind = 2 as low_confidence from facets where plane_id = 0", "roof_px")
def q_fit_single_plane(spark, sf):
    return r6(r6(r6(facets.fit_planes(px(spark, sf), "ransac"), "tilt_deg"), "inlier_ratio", digits=9), "aspect_deg", digits=4)


@query("select building_id, x, y, z, facet as plane_id, block as is_obstruction from roof_px", "roof_px")
def q_pixel_membership(spark, sf):
    points = px(spark, sf)
    return facets.membership(points, facets.fit_planes(points)).drop("off")


@query(TRUTH + AREAS + " select building_id, plane_id, plane_area_m2, obstruction_area_m2 from planes", "roof_px", "sun")
def q_detect_obstructions(spark, sf):
    points = px(spark, sf)
    planes = facets.fit_planes(points)
    return facets.detect_obstructions(planes, facets.membership(points, planes), RES * RES).select("building_id", "plane_id", "plane_area_m2", "obstruction_area_m2")


@query(TRUTH + AREAS + " select building_id, plane_id, round(poa_clear_sky_kwh_m2, 6) as poa_clear_sky_kwh_m2 from planes", "roof_px", "sun")
def q_plane_poa(spark, sf):
    out = facets.plane_poa(facets.fit_planes(px(spark, sf)), fixture(spark, sf, "sun"), ORIGIN, RES)
    return r6(out.select("building_id", "plane_id", "poa_clear_sky_kwh_m2"), "poa_clear_sky_kwh_m2")


@query(TRUTH + AREAS + views(BUILT_SQL), "roof_px", "sun")
def q_score_roofs(spark, sf):
    return built_rows(facets.score_roofs(px(spark, sf), fixture(spark, sf, "sun"), ORIGIN, RES))


CONSISTENCY = """, e as (select building_id, kind, count(*) as n, case kind when 4 then 0 when 1 then 2 when 2 then 3 else 1 end as n_planes,
  sqrt(avg(case when block then 9e0 else 0e0 end)) as multi, 100 * avg(case when block then 0e0 else 1e0 end) as within_multi,
  sqrt(avg(pow(case kind when 1 then case when facet = 1 then z - 100 - (x - 1 - building_id % 100 * 40) * 0.5e0 else 0 end
     when 2 then case when facet > 0 then z - 100 - (x - 1 - building_id % 100 * 40) * 0.75e0 else 0 end when 3 then case when block then 3 else 0 end else 0 end, 2))) as single,
  100 * avg(case when facet > 0 or block then 0e0 else 1e0 end) as within_single from roof_px group by 1, 2),
k as (select building_id, kind, cast(n_planes as int) as n_planes, case when kind <> 4 then multi end as rmse_multiplane, case when kind <> 4 then within_multi end as pct_within_multiplane,
  case when kind <> 4 then single end as rmse_ransac, case when kind <> 4 then within_single end as pct_within_ransac, case when kind <> 4 then single - multi end as rmse_improvement from e)"""
METRICS = ("rmse_multiplane", "pct_within_multiplane", "rmse_ransac", "pct_within_ransac", "rmse_improvement")


@query(CONSISTENCY + " select building_id, n_planes, " + ", ".join(f"round({m}, 6) as {m}" for m in METRICS) + " from k", "roof_px")
def q_compare_consistency(spark, sf):
    return r6(facets.compare_consistency(px(spark, sf)), *METRICS)


TYPED = CONSISTENCY + ", o as (select *, case when kind = 4 then 'unfittable' when n_planes >= 3 and building_id % 3 = 0 then 'complex' when n_planes >= 3 then 'hip' when building_id % 3 = 0 then 'flat' else 'gable' end as roof_type from k)"


def typed(spark, sf):
    points = px(spark, sf)
    key = F.col("building_id")
    roofs = points.select("building_id").distinct().select(key, (key % 7).cast("int").alias("tile_row"), (key % 11).cast("int").alias("tile_col"), F.when(key % 3 == 0, "flat").otherwise("pitched_sun_facing").alias("roof_class"))
    return facets.tile_consistency(points, roofs)


@query(TYPED + " select building_id, building_id % 7 || '_' || building_id % 11 || '_' || building_id as roof_id, cast(building_id % 7 as int) as tile_row, cast(building_id % 11 as int) as tile_col, n_planes, roof_type, round(rmse_improvement, 6) as rmse_improvement from o", "roof_px")
def q_tile_consistency(spark, sf):
    return r6(typed(spark, sf).select("building_id", "roof_id", "tile_row", "tile_col", "n_planes", "roof_type", "rmse_improvement"), "rmse_improvement")


SUMMARY = {"rmse_multiplane_median": ("rmse_multiplane", 0.5), "rmse_ransac_median": ("rmse_ransac", 0.5), "rmse_improvement_median": ("rmse_improvement", 0.5), "rmse_improvement_p90": ("rmse_improvement", 0.9), "pct_within_multiplane_median": ("pct_within_multiplane", 0.5), "pct_within_ransac_median": ("pct_within_ransac", 0.5)}


@query(TYPED + ", b as (select * from (values ('flat'), ('gable'), ('hip'), ('complex'), ('unfittable'), ('all')) v(bin)) select bin as roof_type, count(building_id) as n_roofs, count(*) filter (where building_id is not null and rmse_multiplane is null) as n_unfittable, " + ", ".join(f"round(quantile_cont({c}, {q}), 6) as {k}" for k, (c, q) in SUMMARY.items()) + " from b left join o on bin = roof_type or bin = 'all' group by 1", "roof_px")
def q_summarize_consistency(spark, sf):
    return r6(facets.summarize_consistency(typed(spark, sf)), *SUMMARY)
