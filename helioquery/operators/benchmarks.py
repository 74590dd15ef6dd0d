"""Figures of a run held against published ones: headlines, shares, medians, totals three ways, fit quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules

#: Roofs of a single house, by footprint in square metres.
HOUSE_M2 = (80.0, 250.0)
#: Gates of the aspect rose.
ROSE_INLIERS, ROSE_PIXELS = 0.6, 20


def utilization(roofs: DataFrame) -> DataFrame:
    """The older rule without cutoffs: a fixed share of the footprint for level and sun-facing roofs, nothing for others."""
    kind = rules.roof_class(F.col("tilt_deg"), F.col("aspect_deg"))
    share = F.when(kind.isin("flat", "pitched_sun_facing"), K.UTILIZATION).otherwise(0.0)
    return roofs.withColumns({"roof_class": kind, "utilization_fraction": share, "usable_area_m2": F.col("footprint_area_m2") * share})


def utilization_summary(roofs: DataFrame) -> DataFrame:
    """(roof_class, n, utilization_pct), and all classes together under ``all``."""
    each = utilization(roofs).withColumn("roof_class", F.explode(F.array("roof_class", F.lit("all"))))
    return each.groupBy("roof_class").agg(F.count("*").alias("n"), F.try_divide(100 * F.sum("usable_area_m2"), F.sum("footprint_area_m2")).alias("utilization_pct"))


def intensive(roofs: DataFrame) -> DataFrame:
    """One row: medians of energy over usable roofs and over those of a house's size, of specific yield, the conversion factor, the share of sunny roofs."""
    usable, size = F.col("usable_area_m2") > 0, F.col("footprint_area_m2").between(*HOUSE_M2)
    known = roofs.where("poa_real_kwh_m2 is not null")
    return known.agg(
        (F.median(F.when(usable, F.col("annual_energy_kwh"))) / 1000).alias("median_energy_mwh"), (F.median(F.when(usable & size, F.col("annual_energy_kwh"))) / 1000).alias("house_energy_mwh"),
        F.median(F.when(usable, F.try_divide("annual_energy_kwh", "capacity_kw"))).alias("median_specific_yield"), F.lit(K.MODULE_EFF * K.PERFORMANCE_RATIO).alias("conversion_factor"),
        F.avg((F.col("poa_real_kwh_m2") >= K.MIN_INSOLATION).cast("double")).alias("share_sunny"),
    )


def three_ways(roofs: DataFrame, published_mwh: float) -> DataFrame:
    """One row: total energy by our method and by the other one, and their ratios to the published total and to each other."""
    out = roofs.agg((F.sum("annual_energy_kwh") / 1000).alias("ours_mwh"), (F.sum("external_kwh") / 1000).alias("external_mwh"))
    return out.withColumns({"ours_to_published": F.col("ours_mwh") / published_mwh, "external_to_published": F.col("external_mwh") / published_mwh, "ours_to_external": F.try_divide("ours_mwh", "external_mwh")})


def fit_quality(fits: DataFrame) -> DataFrame:
    """One row over single-plane fits: how many there are, medians, shares of level and of low-confidence roofs."""
    own = F.col("tilt_deg").isNotNull()
    share = lambda c: 100 * F.avg(F.when(own, c.cast("double")))
    return fits.agg(
        F.count("*").alias("n_roofs"), F.count_if(own).alias("n_fitted"), F.median("tilt_deg").alias("median_tilt_deg"), F.median("inlier_ratio").alias("median_inlier_ratio"),
        F.median(F.when(own, F.col("n_px"))).alias("median_n_px"), share(F.col("tilt_deg") < K.FLAT_THRESHOLD_DEG).alias("pct_flat"), share(F.col("low_confidence")).alias("pct_low_confidence"),
    )


def gated_rose(fits: DataFrame, bins: int = 16) -> DataFrame:
    """Area by aspect bin of pitched roofs that are fitted well."""
    good = fits.where((F.col("tilt_deg") >= K.FLAT_THRESHOLD_DEG) & (F.col("inlier_ratio") >= ROSE_INLIERS) & (F.col("n_px") >= ROSE_PIXELS))
    return good.groupBy(F.floor(F.col("aspect_deg") * bins / 360).cast("int").alias("bin")).agg(F.sum("area_m2").alias("area"))


def sketch_chain(roofs: DataFrame, usable_share: float = 0.34, specific_yield: float = 1300.0, shading_retained: float = 0.90) -> DataFrame:
    """A roof end to end by rules of thumb: usable share, power density, a specific yield and what shading leaves of it."""
    area = F.col("footprint_area_m2") * usable_share
    energy = area * K.POWER_DENSITY * specific_yield * shading_retained
    return roofs.withColumns({"usable_area_m2": area, "capacity_kw": area * K.POWER_DENSITY, "annual_energy_kwh": energy, "annual_co2_kg": energy * K.GRID_CO2})


def run_headline(buildings: DataFrame) -> DataFrame:
    """One row: roofs, usable and low-confidence ones, totals, medians over usable roofs, specific yield and whether it passes the gate."""
    usable, power = F.col("usable"), F.sum("capacity_kw")
    out = buildings.agg(
        F.count("*").alias("n_roofs"), F.count_if(usable).alias("n_usable"), F.count_if("low_confidence").alias("n_low_confidence"), (100 * F.avg(F.col("low_confidence").cast("double"))).alias("pct_low_confidence"),
        power.alias("capacity_kw"), (F.sum("annual_energy_kwh") / 1000).alias("energy_mwh"), (F.sum("annual_co2_kg") / 1000).alias("co2_t"),
        (F.median(F.when(usable, F.col("annual_energy_kwh"))) / 1000).alias("median_energy_mwh"), F.median(F.when(usable, F.col("energy_density_kwh_m2"))).alias("median_density"), F.when(power > 0, F.sum("annual_energy_kwh") / power).alias("specific_yield"),
    )
    return out.withColumn("passes", rules.within_tolerance(F.col("specific_yield")))


def tract_headline(tracts: DataFrame) -> DataFrame:
    """One row: tracts, totals, priority and unknown ones, and the range of potential over the classified."""
    known = F.when(F.col("equity_class") != "unknown", F.col("potential_per_household"))
    return tracts.agg(F.count("*").alias("n_tracts"), (F.sum("annual_energy_kwh") / 1000).alias("energy_mwh"), F.count_if("is_priority").alias("n_priority"), F.count_if(F.col("equity_class") == "unknown").alias("n_unknown"), F.min(known).alias("least_potential"), F.max(known).alias("most_potential"))


def ramp(df: DataFrame, value: str, colours: list[str]) -> DataFrame:
    """One row: strictly ascending 20, 40, 60 and 80 % breaks of the finite values, and one colour more than breaks."""
    finite = F.when(F.abs(value) < float("inf"), F.col(value))
    breaks = F.array_distinct(F.percentile(finite, F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8)))))
    return df.agg(breaks.alias("breaks")).withColumn("colours", F.slice(F.array(*map(F.lit, colours)), F.lit(1), F.size("breaks") + 1))


def markdown(table: DataFrame) -> str:
    """A summary of a few rows as a Markdown table, numbers with fractions to one decimal."""
    def cell(v: object) -> str:
        return "" if v is None else f"{v:.1f}" if isinstance(v, float) else str(v)

    rows = [table.columns, ["---"] * len(table.columns), *([cell(v) for v in r] for r in table.collect())]
    return "\n".join("| " + " | ".join(r) + " |" for r in rows)
