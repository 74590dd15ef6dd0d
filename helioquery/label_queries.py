"""Registered queries of the spot check and of publishing, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fixtures import fixture
from .operators import facets, labels, publish
from .queries import TYPE, built, equity, areas, query, r6, views, QUADRANT
from .roof_queries import AREAS, ORIGIN, RES, TRUTH, px

#: Labels of the known roofs, and what each method makes of them.
LABELS = """, labels as (select cast(c_custkey as varchar) as building_id, case c_custkey % 6 when 0 then '1' when 1 then '2.0' when 2 then '6' when 3 then '3' when 4 then '1' else '2' end as n_major_planes,
  case when c_custkey % 4 < 2 then ' Yes' else 'n' end as has_obstruction, case when c_custkey % 13 = 0 then ' exclude (shed)' when c_custkey % 13 = 1 then 'ok' end as notes from customer)"""


def hand_labels(spark, sf):
    k, row = F.col("c_custkey"), spark.read.parquet(f"{sf}/customer.parquet")
    planes = F.element_at(F.array(*map(F.lit, ("1", "2.0", "6", "3", "1", "2"))), (k % 6 + 1).cast("int"))
    notes = F.when(k % 13 == 0, " exclude (shed)").when(k % 13 == 1, "ok")
    return row.select(k.cast("string").alias("building_id"), planes.alias("n_major_planes"), F.when(k % 4 < 2, " Yes").otherwise("n").alias("has_obstruction"), notes.alias("notes"))


#: What each method fits is known, so the comparison is stated from the truth: (kind, method, facets, obstruction) and the area of the smallest facets.
COMPARED = LABELS + """, m as (select * from (values (0, 'multiplane', 1, false), (1, 'multiplane', 2, false), (2, 'multiplane', 3, false), (3, 'multiplane', 1, true), (4, 'multiplane', 0, false),
  (0, 'ransac', 1, false), (1, 'ransac', 1, false), (2, 'ransac', 1, false), (3, 'ransac', 1, true), (4, 'ransac', 0, false)) t(kind, method, n, seen)),
w as (select l.building_id, method, kind, cast(try_cast(n_major_planes as double) as int) as label_planes, lower(trim(has_obstruction)) = 'yes' as said, n as model_planes, seen as found
  from labels l join m on try_cast(l.building_id as bigint) % 5 = kind where not starts_with(upper(trim(coalesce(notes, ''))), 'EXCLUDE')),
c as (select *, least(label_planes, 4) as capped, model_planes - least(label_planes, 4) as diff from w),
f as (select *, said and diff > 0 as flagged from c)"""


def scored(spark, sf):
    rows = facets.stacked(px(spark, sf), fixture(spark, sf, "sun"), ORIGIN, RES)
    return rows.select("building_id", "method", "n_planes", "tilt_deg").where("plane_id = 0"), rows, rows.select("building_id", "method", "obstruction_area_m2")


def comparison(spark, sf):
    return labels.compare_labels(hand_labels(spark, sf), *scored(spark, sf))


FOUND = "building_id, method, label_planes, capped as label_planes_capped, model_planes, diff as plane_diff, abs(diff) <= 1 as plane_agree, diff = 0 as plane_exact, abs(model_planes - label_planes) <= 1 as plane_agree_raw, said as label_obstruction, found as model_obstruction, ['true_negative', 'false_positive', 'miss', 'hit'][1 + 2 * cast(said as int) + cast(found as int)] as obstruction_outcome, flagged as large_planar_obstruction, case when flagged then diff else 0 end as extra_planes"


@query(COMPARED + f" select {FOUND} from f", "roof_px")
def q_compare_labels(spark, sf):
    return comparison(spark, sf).drop("escaped_usable_m2")


#: Facets of the spot check in order of size, each with its usable area: the surplus are the first ones.
ESCAPED = TRUTH + AREAS + """, usable as (select building_id, plane_id, plane_area_m2, case when tilt_deg is null or tilt_deg > 45 or poa_clear_sky_kwh_m2 < 800 then 0e0
    else greatest(0, plane_area_m2 - obstruction_area_m2) * 0.85e0 * case when tilt_deg < 10 then 0.5e0 else 1e0 end end as ua, row_number() over (partition by building_id order by plane_area_m2, plane_id) as k from planes)"""


@query(ESCAPED + COMPARED + " select f.building_id, f.method, round(sum(ua), 6) as escaped_usable_m2 from f join usable u on try_cast(f.building_id as bigint) = u.building_id and k <= diff where flagged and f.method = 'multiplane' group by 1, 2", "roof_px", "sun")
def q_escaped_area(spark, sf):
    out = comparison(spark, sf).where("large_planar_obstruction and method = 'multiplane'")
    return r6(out.select("building_id", "method", "escaped_usable_m2"), "escaped_usable_m2")


@query(COMPARED + """ select v.method, count(f.building_id) as n_roofs, count(*) filter (where abs(diff) <= 1) as plane_agree, round(100e0 * avg(cast(abs(diff) <= 1 as int)), 6) as plane_agree_pct, count(*) filter (where diff = 0) as plane_exact, round(100e0 * avg(cast(diff = 0 as int)), 6) as plane_exact_pct,
  count(*) filter (where abs(model_planes - label_planes) <= 1) as plane_agree_raw, round(100e0 * avg(cast(abs(model_planes - label_planes) <= 1 as int)), 6) as plane_agree_raw_pct, count(*) filter (where said and found) as obstruction_hits, count(*) filter (where said and not found) as obstruction_misses,
  count(*) filter (where not said and found) as obstruction_false_positives, count(*) filter (where not said and not found) as obstruction_true_negatives, count(*) filter (where flagged) as large_planar_obstructions from (values ('multiplane'), ('ransac')) v(method) left join f using (method) group by 1""", "roof_px")
def q_summarize_spot_check(spark, sf):
    return r6(labels.summarize_spot_check(comparison(spark, sf)).drop("escaped_usable_m2"), "plane_agree_pct", "plane_exact_pct", "plane_agree_raw_pct")


@query("""with l as (select trim(s_name) as id, case when s_suppkey % 5 = 0 then ' ' when s_suppkey % 5 = 1 then '2.5' when s_suppkey % 5 = 2 then '0' else '3' end as p, case when s_suppkey % 3 = 0 then 'perhaps' else 'NO ' end as o from supplier where s_suppkey % 4 <> 0),
  e as (select * from l union all select * from l where right(id, 1) = '7')
 select id as building_id, 'duplicate' as problem from e group by 1 having count(*) > 1 union all select distinct id, 'unknown' from e where right(id, 1) = '3'
 union all select id, 'n_major_planes' from e where p <> '3' union all select id, 'has_obstruction' from e where o <> 'NO '""")
def q_label_faults(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").withColumn("k", F.col("s_suppkey"))
    planes = F.when(F.col("k") % 5 == 0, " ").when(F.col("k") % 5 == 1, "2.5").when(F.col("k") % 5 == 2, "0").otherwise("3")
    rows = s.select(F.concat(F.lit(" "), "s_name").alias("building_id"), planes.alias("n_major_planes"), F.when(F.col("k") % 3 == 0, "perhaps").otherwise("NO ").alias("has_obstruction"), F.when(F.col("k") % 4 == 0, "EXCLUDE").alias("notes"))
    twice = rows.union(rows.where(F.col("building_id").endswith("7")))
    return labels.label_faults(twice, s.where(~F.col("s_name").endswith("3")).select(F.trim("s_name").alias("building_id")))


@query(f""", s as (select *, case when x < 325000 and y < 4308000 then 'south' when x < 332000 then 'west' end as area, {TYPE} as roof_type, cast(floor((y - 4295000) / 2000) as int) as tile_row, cast(floor((x - 315000) / 2000) as int) as tile_col from buildings),
  o as (select *, tile_row || '_' || tile_col || '_' || building_id as id from s where area is not null and footprint_area_m2 >= 50),
  n as (select *, row_number() over (partition by area, roof_type order by md5('20|' || id), id) as k from o) select id as building_id, area, roof_type, tile_row, tile_col, building_id as tile_building_id, n_planes, footprint_area_m2 from n where k <= 3""", "buildings")
def q_spot_check_sample(spark, sf):
    from .functions import rules

    b = fixture(spark, sf, "buildings").withColumn("roof_class", rules.roof_class(F.col("tilt_deg"), F.col("aspect_deg")))
    inside = {"south": (F.col("x") < 325000) & (F.col("y") < 4308000), "west": F.col("x") < 332000}
    return labels.spot_sample(b, inside).drop("roof_class", "x", "y")


WEB = ", ".join(f"round_even({c}, {d}) as {c}" for c, d in {"capacity_kw": 1, "aspect_deg": 0, "footprint_area_m2": 0, "tilt_deg": 1}.items())


@query(views(f"select building_id, usable, unsuitable_reason, roof_class, low_confidence, {WEB}, cast(n_planes as double) as n_planes from built"), "planes")
def q_roofs_to_web(spark, sf):
    out = publish.roofs_to_web(built(spark, sf))
    return out.drop("suitability", "usable_area_m2", "annual_energy_kwh", "poa_real_kwh_m2")  # sums of other orders fall on either side of a half; score_buildings compares them


@query(QUADRANT + " select GEOID, equity_class, equity_class = 'high_potential_high_burden' as is_priority, round(pph, 6) as potential_per_household, round(energy_burden, 6) as energy_burden from z join q using (GEOID)", "buildings", "tracts", "strata")
def q_tracts_to_web(spark, sf):
    return r6(publish.tracts_to_web(areas.classify_equity(equity(spark, sf))), "potential_per_household", "energy_burden")


@query(views("select building_id, usable, unsuitable_reason, round_even(tilt_deg, 1) as tilt_deg, round_even(aspect_deg, 0) as aspect_deg, n_planes from built"), "planes")
def q_buildings_to_web(spark, sf):
    return publish.buildings_to_web(built(spark, sf)).select("building_id", "usable", "unsuitable_reason", "tilt_deg", "aspect_deg", "n_planes")


FACETS = TRUTH + AREAS + views("select building_id, plane_id, round_even(round(tilt_deg, 9), 1) as tilt_deg, round_even(u.aspect_deg, 0) as aspect_deg, round_even(round(poa_clear_sky_kwh_m2, 9), 0) as poa_kwh_m2, f.n_px * 4e0 as area_m2, u.reason, b.unsuitable_reason as building_reason from u join facets f using (building_id, plane_id) join built b using (building_id) where f.a is not null").replace("round(tilt_deg, 9)", "round(u.tilt_deg, 9)")


def web_facets(spark, sf):
    rows = facets.usable_facets(px(spark, sf), fixture(spark, sf, "sun"), ORIGIN, RES)
    return publish.facets_to_web(rows, facets.scoring.collapse(rows), RES * RES)


@query(FACETS, "roof_px", "sun")
def q_facets_to_web(spark, sf):
    return web_facets(spark, sf)


@query(FACETS.replace(" where f.a is not null", " where f.a is not null and (coalesce(u.reason, '') in ('too_steep', 'low_insolation') or b.unsuitable_reason = 'too_small')"), "roof_px", "sun")
def q_struck_out(spark, sf):
    return publish.struck_out(web_facets(spark, sf), ("too_steep", "low_insolation"))


@query(TRUTH + AREAS + " select building_id, plane_id, obstruction_area_m2 as area_m2 from planes where obstruction_area_m2 > 0", "roof_px", "sun")
def q_obstructions_to_web(spark, sf):
    return publish.obstructions_to_web(facets.usable_facets(px(spark, sf), fixture(spark, sf, "sun"), ORIGIN, RES))


REASONS = ("no_plane_fit", "too_steep", "north_facing", "low_insolation", "too_small")


@query(TRUTH + AREAS + views("select count(*) as n_buildings, count(*) filter (where usable) as n_suitable, " + ", ".join(f"count(*) filter (where not usable and unsuitable_reason = '{r}') as buildings_{r}" for r in REASONS) + ", round(sum(annual_energy_kwh) / 1000, 4) as total_energy_mwh, round(median(annual_energy_kwh) filter (where usable) / 1000, 6) as median_energy_mwh, round(sum(annual_energy_kwh) / sum(capacity_kw), 6) as specific_yield_kwh_kwp, (select count(*) from facets where a is not null) as n_planes, " + ", ".join(f"(select count(*) from u join facets f using (building_id, plane_id) where f.a is not null and reason = '{r}') as planes_{r}" for r in REASONS[1:4]) + " from built"), "roof_px", "sun")
def q_page_stats(spark, sf):
    rows = facets.usable_facets(px(spark, sf), fixture(spark, sf, "sun"), ORIGIN, RES)
    return r6(r6(publish.page_stats(facets.scoring.collapse(rows), rows), "median_energy_mwh", "specific_yield_kwh_kwp"), "total_energy_mwh", digits=4)


MANIFEST = "manifest as (select cast(floor(c_custkey / 50) as int) as tile_row, cast(c_custkey % 50 as int) as tile_col, case when c_custkey % 17 = 0 then 'failed' when c_custkey % 5 = 1 then 'running' else 'done' end as status, case when c_custkey % 17 <> 0 then c_custkey % 3 end as n_roofs, case when c_custkey % 17 = 0 then repeat(c_name, 9) end as error from customer)"


def manifest(spark, sf):
    k = F.col("c_custkey")
    status = F.when(k % 17 == 0, "failed").when(k % 5 == 1, "running").otherwise("done")
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.floor(k / 50).cast("int").alias("tile_row"), (k % 50).cast("int").alias("tile_col"), status.alias("status"), F.when(k % 17 != 0, k % 3).alias("n_roofs"), F.when(k % 17 == 0, F.repeat("c_name", 9)).alias("error"))


@query(f", {MANIFEST} select count(*) filter (where status = 'done') as n_done, count(*) filter (where status = 'done' and n_roofs > 0) as n_with_roofs, count(*) filter (where status = 'done' and n_roofs = 0) as n_empty, count(*) filter (where status = 'failed') as n_failed, (select count(*) from buildings) as n_city, (select sum(footprint_area_m2) / 1000 from buildings) as capacity_mw, (select sum(poa_clear_sky_kwh_m2) / 1000 from buildings) as energy_mwh from manifest", "buildings")
def q_run_log(spark, sf):
    b = fixture(spark, sf, "buildings")
    return publish.run_log(manifest(spark, sf), b.select(F.col("footprint_area_m2").alias("capacity_kw"), F.col("poa_clear_sky_kwh_m2").alias("annual_energy_kwh")))


@query(f"with {MANIFEST} select tile_row, tile_col, left(error, 100) as error from manifest where status = 'failed' order by tile_row, tile_col limit 5")
def q_first_failures(spark, sf):
    return publish.first_failures(manifest(spark, sf))


@query("with s as (select c_acctbal as v, row_number() over (order by c_acctbal) - 1 as i, count(*) over () as n from customer) select v as cap from s where i = floor((n - 1) * 0.95e0)")
def q_ramp_cap(spark, sf):
    return publish.ramp_cap(spark.read.parquet(f"{sf}/customer.parquet"), "c_acctbal")


@query("select building_id, coalesce(['#a', '#b', '#c'][1 + cast(aspect_deg >= 100 as int) + cast(aspect_deg >= 200 as int)], '#cccccc') as colour, coalesce(case n_planes when 1 then 'too steep' when 2 then 'faces north' when 3 then 'too little usable area' end, '–') as label, ['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'][1 + cast(floor(aspect_deg / 22.5e0 + 0.5e0) as int) % 16] as point from buildings where usable", "buildings")
def q_map_popup(spark, sf):
    from .functions import rules

    b = publish.map_layer(fixture(spark, sf, "buildings"), "usable")
    reason = F.element_at(F.create_map(*(F.lit(x) for x in (1, "too_steep", 2, "north_facing", 3, "too_small"))), F.col("n_planes"))
    return b.select("building_id", publish.step_colour(F.col("aspect_deg"), [100, 200], ["#a", "#b", "#c"]).alias("colour"), publish.reason_label(reason).alias("label"), rules.compass(F.col("aspect_deg"), 16).alias("point"))
