"""Roofs, tracts and rasters derived from the general tables by arithmetic that is exact in any SQL engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_I, _J = (", ".join(f"({k})" for k in range(n)) for n in (9, 8))

VIEWS = {
    # roofs of 9 x 8 pixels of 2 m whose facets are known: level, two slopes, two slopes with a strip between, level with a block, five pixels
    "roof_px": f"""select c_custkey as building_id, kind, cast(c_custkey % 100 * 40 + 2 * i + 1 as double) as x, cast(floor(c_custkey / 100) * 40 + 2 * j + 1 as double) as y,
        case when kind = 1 then case when i < 5 then 100e0 + i else 109e0 - i end
             when kind = 2 then case when i < 4 then 100e0 + 1.5e0 * i when i < 7 then 98e0 else 122.5e0 - 4.5e0 * i end
             when kind = 3 and block then 103e0 else 100e0 end as z,
        case when kind = 1 and i >= 5 or kind = 2 and i between 4 and 6 then 1 when kind = 2 and i >= 7 then 2 when kind = 4 then -1 else 0 end as facet, kind = 3 and block as block
        from (select c_custkey, c_custkey % 5 as kind, i, j, i between 2 and 4 and j between 2 and 5 as block from {{customer}} cross join (values {_I}) a(i) cross join (values {_J}) b(j)) t
        where kind <> 4 or i < 5 and j = 0""",
    "sun": f"""select distinct cast(floor(c_custkey / 100) * 20 + j as int) as r, cast(c_custkey % 100 * 20 + i as int) as c,
        case when (c_custkey + i + j) % 29 <> 0 then cast(700 + (c_custkey * 7 + i * 13 + j * 3) % 40 * 10 as double) end as kwh_m2
        from {{customer}} cross join (values {_I}) a(i) cross join (values {_J}) b(j)""",
    "planes": """select l_orderkey as building_id, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as int) as plane_id,
        case when l_partkey % 25 = 0 then null else l_quantity end as tilt_deg, cast((l_suppkey * 37 + l_partkey * 11) % 360 as double) as aspect_deg,
        cast(700 + (l_partkey % 100) * 10 as double) as poa_clear_sky_kwh_m2, cast(round(l_extendedprice / 500) * 4 as double) as plane_area_m2,
        cast((l_partkey % 6) * 4 as double) as obstruction_area_m2, cast(count(*) over (partition by l_orderkey) as int) as n_planes,
        l_orderkey % 9 = 0 as low_confidence, cast(l_orderkey % 5 as double) / 8 as superstructure_frac, cast(60 + l_orderkey % 200 as double) as footprint_area_m2 from {lineitem}""",
    "buildings": """select o_orderkey as building_id, cast(315000 + ((o_orderkey * 7919) % 2001) * 10 as double) as x, cast(4295000 + ((o_custkey * 104729) % 2501) * 10 as double) as y,
        cast(o_orderkey % 90 as double) as tilt_deg, cast((o_custkey * 13) % 360 as double) as aspect_deg, cast(600 + (o_custkey % 90) * 10 as double) as poa_clear_sky_kwh_m2,
        cast(20 + o_custkey % 300 as double) as footprint_area_m2, o_orderkey % 4 <> 0 as usable, cast(o_orderkey % 120 as double) as energy_density,
        cast(o_orderkey % 5 + 1 as int) as n_planes from {orders}""",
    "tracts": """select lpad(cast(11001000000 + n_nationkey * 100 as varchar(20)), 11, '0') as GEOID, cast(315000 + (n_nationkey % 5) * 4000 as double) as minx,
        cast(4295000 + cast(floor(n_nationkey / 5) as int) * 5000 as double) as miny, cast(319000 + (n_nationkey % 5) * 4000 as double) as maxx,
        cast(4300000 + cast(floor(n_nationkey / 5) as int) * 5000 as double) as maxy, cast(n_nationkey * 100 % 700 as double) as households,
        cast(1000 + n_nationkey * 10 as double) as population from {nation}""",
    # diamonds with a square hole beside the middle
    "diamonds": """select lpad(cast(11001000000 + n_nationkey * 100 as varchar(20)), 11, '0') as GEOID, cast(317000 + (n_nationkey % 5) * 4000 as double) as mx,
        cast(4297500 + cast(floor(n_nationkey / 5) as int) * 5000 as double) as my, cast(1200 + n_nationkey % 4 * 200 as double) as a, cast(2000 + n_nationkey % 3 * 100 as double) as b from {nation}""",
    "daily": """select o_custkey % 200 as pixel, cast(month(o_orderdate) as int) as month, avg(o_totalprice) as wh from {orders} group by 1, 2""",
    "pixels": """select cast(floor((p_partkey - 1) / 10) as int) as r, cast((p_partkey - 1) % 10 as int) as c, case when p_partkey % 53 = 0 then null
        else 300 + ((p_partkey * 37) % 11) * 0.25e0 end as z from {part}""",
    "cloud": """select l_orderkey as building_id, l_quantity as x, cast(l_suppkey as double) as y, round(l_extendedprice) / 1000 as z,
        cast(l_partkey % 3 as int) as plane_id from {lineitem}""",
    "strata": """select lpad(cast(11001000000 + c_nationkey * 100 as varchar(20)), 11, '0') as FIP, case when c_nationkey % 12 = 0 then 0e0 else 10 * greatest(c_acctbal, 0) end as income,
        abs(c_acctbal) as cost, case when c_custkey % 4 <> 0 then abs(c_acctbal) / 2 end as gas, case when c_nationkey <> 3 then 100e0 end as fuel from {customer}""",
    "spots": """select s_suppkey as id, case when s_suppkey % 7 = 0 then null else cast(s_suppkey % 30 as double) end as tilt_deg, cast(30 + s_suppkey % 90 as double) as footprint_area_m2,
        cast(s_suppkey % 4 as int) + 1 as n_planes, n_name as area from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "marks": """select l.doc_id as building_id, cast(1 + l.doc_id % 6 as int) as label_planes, cast(1 + d.n_chars % 4 as int) as model_planes,
        case l.doc_id % 7 when 0 then 'y' when 1 then ' NO ' when 2 then 'True' when 3 then '0' when 4 then 'maybe' when 5 then 't' else null end as has_obstruction,
        case when l.doc_id % 11 = 0 then ' exclude: trees' when l.doc_id % 11 = 1 then null else 'ok' end as notes, l.quality = 1 as found from {labels} l join {documents} d on l.doc_id = d.doc_id""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the parquet tables of a data folder."""
    used = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
    return spark.sql(VIEWS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_views(sql: str, *names: str) -> str:
    """The same views as common table expressions before an oracle's SQL."""
    return sql if not names else "with " + ",\n".join(f"{n} as ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n])})" for n in names) + "\n" + sql
