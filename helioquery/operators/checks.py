"""Validation: label parsing and comparison, summaries, benchmark gates, publishing relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules


def parsed_labels(labels: DataFrame) -> DataFrame:
    return labels.withColumns({"obstruction": rules.parsed_flag(F.col("has_obstruction")), "is_excluded": rules.excluded(F.col("notes"))})


def compared(labels: DataFrame) -> DataFrame:
    """Facet counts against labels (clamped at the most that a fit gives) and the four obstruction outcomes."""
    out = parsed_labels(labels).where(~F.col("is_excluded"))
    want = F.least("label_planes", F.lit(K.MAX_PLANES))
    diff = F.col("model_planes") - want
    hit, said = F.col("found"), F.col("obstruction")
    return out.withColumns({"plane_diff": diff, "agree_exact": diff == 0, "agree_1": F.abs(diff) <= K.PLANE_TOLERANCE, "obstruction_outcome": rules.outcome(said, hit)})


def spot_summary(comparison: DataFrame) -> DataFrame:
    out = [F.count("*").alias("n"), F.count_if("agree_exact").alias("n_exact"), F.count_if("agree_1").alias("n_within_1")]
    return comparison.agg(*out, *(F.count_if(F.col("obstruction_outcome") == o).alias("n_" + o) for o in ("hit", "miss", "false_positive", "true_negative")))


def duplicate_labels(labels: DataFrame, known: DataFrame) -> DataFrame:
    """Ids labelled twice, and ids that no building has."""
    twice = labels.groupBy("building_id").count().where("count > 1").select("building_id", F.lit("duplicate").alias("problem"))
    return twice.union(labels.join(known, "building_id", "left_anti").select("building_id", F.lit("unknown")).distinct())


def reason_counts(df: DataFrame) -> DataFrame:
    """Rows by reason over the fixed domain, zero where none."""
    return df.agg(*(F.count_if(F.col("unsuitable_reason") == r).alias(r) for r in K.REASONS), F.count_if("usable").alias("suitable"))


def headline(buildings: DataFrame) -> DataFrame:
    good = F.col("usable")
    out = buildings.agg(F.count("*").alias("n_roofs"), F.count_if("usable").alias("n_usable"), F.sum("capacity_kw").alias("kw"), F.sum("annual_energy_kwh").alias("kwh"), F.median(F.when(good, F.col("annual_energy_kwh"))).alias("median_kwh"))
    out = out.withColumn("specific_yield", F.try_divide("kwh", "kw"))
    return out.withColumn("passes", rules.within_tolerance(F.col("specific_yield")))


def quantile_breaks(df: DataFrame, value: str) -> DataFrame:
    """Distinct 20, 40, 60 and 80 % quantiles of the finite values."""
    return df.agg(F.array_distinct(F.percentile(value, F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8))))).alias("b")).select(F.posexplode("b").alias("i", "at"))


def aspect_rose(planes: DataFrame, bins: int = 16) -> DataFrame:
    """Area by aspect bin of pitched planes."""
    width = 360 / bins
    pitched = planes.where(F.col("tilt_deg") >= K.FLAT_THRESHOLD_DEG)
    return pitched.groupBy(F.floor(F.col("aspect_deg") / width).cast("int").alias("bin")).agg(F.sum("plane_area_m2").alias("area"))


def roof_web(buildings: DataFrame) -> DataFrame:
    """The published columns, rounded half to even."""
    digits = {"tilt_deg": 1, "aspect_deg": 0, "usable_area_m2": 1, "capacity_kw": 2, "annual_energy_kwh": 0, "suitability": 1}
    return buildings.select("building_id", "roof_class", "unsuitable_reason", "usable", *(rules.rounded(F.col(c), d).alias(c) for c, d in digits.items()))


def external_method(roofs: DataFrame) -> DataFrame:
    """Another published rule on the same roofs: own cutoffs, fixed module and performance shares."""
    real = F.col("poa_clear_sky_kwh_m2") * K.REAL_SKY
    flat, south = F.col("tilt_deg") <= 10, (F.col("aspect_deg") > 22.5) & (F.col("aspect_deg") < 337.5)
    ok = (real >= 800) & (F.col("tilt_deg") <= 45) & (flat | south) & (F.col("footprint_area_m2") >= 30)
    return roofs.select("building_id", F.when(ok, F.col("footprint_area_m2") * real * 0.216 * 0.83).otherwise(0.0).alias("external_kwh"))


def census_rows(body: DataFrame, column: str = "body") -> DataFrame:
    """An array-of-arrays JSON with a header row as a table: numbers by header name, negatives NULL, GEOID joined."""
    rows = body.select(F.from_json(column, "array<array<string>>").alias("a"))
    head = F.element_at("a", 1)
    each = rows.select(head.alias("h"), F.explode(F.slice("a", F.lit(2), F.size("a") - 1)).alias("row"))
    pick = lambda name: F.element_at("row", F.array_position("h", F.lit(name)).cast("int"))
    number = lambda name: F.when(pick(name).try_cast("double") >= 0, pick(name).try_cast("double"))
    out = {"population": "B01003_001E", "households": "B25003_001E", "median_income": "B19013_001E"}
    return each.select(F.concat(pick("state"), pick("county"), pick("tract")).alias("GEOID"), *(number(v).alias(k) for k, v in out.items()))


def pixel_edges(pixels: DataFrame, by: str) -> DataFrame:
    """Boundary edges of each group's pixel union: edges of two neighbours cancel."""
    r, c = F.col("r"), F.col("c")
    edge = lambda kind, i, j, d: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(d).alias("d"))
    four = F.array(edge("h", r, c, 1), edge("h", r + 1, c, -1), edge("v", r, c, 1), edge("v", r, c + 1, -1))
    each = pixels.select(by, F.inline(four))
    return each.groupBy(by, "kind", "i", "j").agg(F.sum("d").alias("d")).where("d <> 0")
