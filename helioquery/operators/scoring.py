"""From planes to buildings: usable area, yields, collapse, percentile rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions import rules


def classified(df: DataFrame) -> DataFrame:
    """Add roof_class, unsuitable_reason and usable."""
    tilt, aspect, poa = F.col("tilt_deg"), F.col("aspect_deg"), F.col("poa_clear_sky_kwh_m2")
    reason = rules.unsuitable_reason(tilt, aspect, poa)
    return df.withColumns({"roof_class": rules.roof_class(tilt, aspect), "unsuitable_reason": reason, "usable": reason.isNull()})


def usable_footprints(roofs: DataFrame) -> DataFrame:
    """Fixed share of the footprint where the rules pass, then the area gate; no row is dropped."""
    area = F.when(F.col("unsuitable_reason").isNull(), F.col("footprint_area_m2") * K.UTILIZATION).otherwise(0.0)
    out = classified(roofs).withColumn("__area", area)
    small = F.col("unsuitable_reason").isNull() & (F.col("__area") < K.MIN_USABLE_M2)
    out = out.withColumn("unsuitable_reason", F.when(small, "too_small").otherwise(F.col("unsuitable_reason")))
    usable = F.col("unsuitable_reason").isNull()
    return out.withColumns({"usable": usable, "usable_area_m2": F.when(usable, F.col("__area")).otherwise(0.0)}).drop("__area")


def usable_planes(planes: DataFrame) -> DataFrame:
    """Net of obstructions and setback; flat planes at the ground-coverage ratio; no gate."""
    out = classified(planes)
    net = F.greatest(F.lit(0.0), F.col("plane_area_m2") - F.col("obstruction_area_m2")) * K.SETBACK
    net = net * F.when(F.col("roof_class") == "flat", K.FLAT_GCR).otherwise(1.0)
    return out.withColumn("usable_area_m2", F.when(F.col("usable"), net).otherwise(0.0))


def plane_yields(planes: DataFrame) -> DataFrame:
    """Yields of each plane; no area, no yield, whatever the insolation."""
    made = rules.pv_yield(F.col("usable_area_m2"), F.col("poa_clear_sky_kwh_m2"))
    none = F.col("usable_area_m2") == 0
    return planes.withColumns({k: v if k == "poa_real_kwh_m2" else F.when(none, 0.0).otherwise(v) for k, v in made.items()})


def _bucket(value: Column) -> Column:
    """A whole number that grows with the value, 64 to an octave; Java's logarithm never turns an order round."""
    steps = lambda v: F.floor(F.log2(v) * 64).cast("long") + 100_000
    return F.when(value > 0, steps(value)).when(value < 0, -steps(-value)).otherwise(F.lit(0).cast("long"))


def percentile_rank(df: DataFrame, value: str, eligible: Column, name: str = "suitability") -> DataFrame:
    """100 * average rank / n among eligible rows, 0 for the others.

    Values are counted first, so ties are one row, and ranked within buckets that follow from the values alone: no job runs
    while the plan is made, and no task orders more than the distinct values of a bucket. A bucket's offset comes from the
    totals of the buckets, of which there are at most some 130,000 however many rows there are.
    """
    ranked = df.where(eligible & F.col(value).isNotNull())
    counts = ranked.groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n")).withColumn("__b", _bucket(F.col("__v")))
    inside = F.sum("__n").over(Window.partitionBy("__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1))
    totals = counts.groupBy("__b").agg(F.sum("__n").alias("__t"))
    offsets = totals.select("__b", F.coalesce(F.sum("__t").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__o"), F.sum("__t").over(Window.partitionBy(F.lit(1))).alias("__all"))
    ranks = counts.withColumn("__i", F.coalesce(inside, F.lit(0))).join(F.broadcast(offsets), "__b")
    share = (F.col("__o") + F.col("__i") + (F.col("__n") + 1) / 2) * 100 / F.col("__all")
    ranks = ranks.select(F.col("__v"), share.alias("__rank"))
    joined = df.join(ranks, df[value] == ranks["__v"], "left")
    return joined.withColumn(name, F.when(eligible, F.coalesce("__rank", F.lit(0.0))).otherwise(0.0)).drop("__v", "__rank")


def collapse(planes: DataFrame) -> DataFrame:
    """One row per building from its planes: sums, the dominant plane, the area gate, then energy density and rank.

    Dominant is the largest usable plane; where none is usable it is plane 0 and tells the reason. Density is energy over
    the footprint's area; it is ranked to nine decimals, so that the order of summation bears on no tie.
    """
    order = F.struct(F.when(F.col("usable"), 0).otherwise(1), F.when(F.col("usable"), -F.col("usable_area_m2")).otherwise(0.0), "plane_id")
    top = F.min_by(F.struct("plane_id", "tilt_deg", "aspect_deg", "roof_class", "unsuitable_reason", "poa_real_kwh_m2"), order).alias("top")
    sums = [F.sum(c).alias(c) for c in ("usable_area_m2", "capacity_kw", "annual_energy_kwh", "annual_co2_kg")]
    same = [F.min_by(c, "plane_id").alias(c) for c in ("n_planes", "low_confidence", "superstructure_frac", "footprint_area_m2")]
    out = planes.groupBy("building_id").agg(*same, F.bool_or("usable").alias("usable"), top, *sums)
    small = F.col("usable") & (F.col("usable_area_m2") < K.MIN_USABLE_M2)
    out = out.withColumn("__small", small)
    reason = F.when(F.col("__small"), "too_small").when(F.col("usable"), F.lit(None).cast("string")).otherwise(F.col("top.unsuitable_reason"))
    out = out.withColumns({"unsuitable_reason": reason, "dominant_plane": F.col("top.plane_id"), "tilt_deg": F.col("top.tilt_deg"), "aspect_deg": F.col("top.aspect_deg"), "roof_class": F.col("top.roof_class"), "poa_real_kwh_m2": F.col("top.poa_real_kwh_m2")})
    out = out.withColumns({c: F.when(F.col("__small"), 0.0).otherwise(F.col(c)) for c in ("usable_area_m2", "capacity_kw", "annual_energy_kwh", "annual_co2_kg")})
    density = F.try_divide("annual_energy_kwh", "footprint_area_m2")
    out = out.withColumns({"usable": F.col("usable") & ~F.col("__small"), "energy_density_kwh_m2": density, "__density": F.round(density, 9)})
    return percentile_rank(out.drop("top", "__small"), "__density", F.col("usable_area_m2") > 0).drop("__density")


def score_buildings(planes: DataFrame) -> DataFrame:
    return collapse(plane_yields(usable_planes(planes)))


def footprint_yield(roofs: DataFrame) -> DataFrame:
    """Footprint path: yields without the zero guard, density and rank."""
    out = usable_footprints(roofs)
    out = out.withColumns(rules.pv_yield(F.col("usable_area_m2"), F.col("poa_clear_sky_kwh_m2")))
    out = out.withColumn("energy_density", F.try_divide("annual_energy_kwh", "footprint_area_m2"))
    return percentile_rank(out, "energy_density", F.col("usable_area_m2") > 0)
