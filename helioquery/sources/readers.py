"""Readers by name: footprints, rasters, census documents, city results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import rules, shapes
from ..operators.checks import census_rows

#: Cost columns of the strata, by the names that the engine gives them.
FUELS = {"electricity": "ELEP*UNITS", "gas": "GASP*UNITS", "fuel": "FULP*UNITS"}


def footprints(spark: SparkSession, source: str, path: str, quadkeys: list[str] | None = None) -> DataFrame:
    """Building footprints; a partitioned source is pruned to the quadkey folders asked for."""
    readers = {"partitioned": lambda: spark.read.parquet(path), "features": lambda: spark.read.parquet(path).where(F.col("geom_type").isin("Polygon", "MultiPolygon"))}
    if source not in readers:
        raise ValueError(f"unknown footprint source {source!r}; known: {', '.join(sorted(readers))}")
    out = readers[source]()
    return out.where(F.col("quadkey").isin(quadkeys)) if quadkeys is not None else out


def catalogue_items(items: DataFrame, minx: float, miny: float, maxx: float, maxy: float, quadkeys: list[str] | None = None) -> DataFrame:
    """Items of a catalogue (minx, miny, maxx, maxy, href) that touch a box, and, where given, carry one of the quadkeys."""
    out = items.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
    return out.where(F.col("quadkey").isin(quadkeys)) if quadkeys is not None else out


def surface_items(items: DataFrame, *box: float) -> DataFrame:
    """The items that a surface over the box is built from; none is an error."""
    out = catalogue_items(items, *box)
    if out.isEmpty():
        raise ValueError(f"no surface item touches {box}")
    return out


def tract_geometries(raw: DataFrame) -> DataFrame:
    """(GEOID, rings) in the working projection, of tracts whose rings are in degrees."""
    return raw.select(rules.geoid(F.col("GEOID")).alias("GEOID"), shapes.projected(F.col("rings")).alias("rings"))


def buildings(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A frame as it is, or a parquet table."""
    if isinstance(source, DataFrame):
        return source
    if not source.rstrip("/").endswith(".parquet"):
        raise NotImplementedError(f"buildings come as a frame or a parquet table, not as {source!r}")
    return spark.read.parquet(source)


def score_tables(spark: SparkSession, folder: str, names: tuple[str, ...] = ("planes", "obstructions", "buildings", "membership")) -> dict[str, DataFrame]:
    """The tables of a detailed score that was written before."""
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}.parquet") for n in names}


def tile_names(files: DataFrame, column: str = "path") -> DataFrame:
    """(tile_row, tile_col) of the scored tiles among file names, each once."""
    pattern = r"(?:^|/)tile_(\d+)_(\d+)_roofs\.parquet$"
    found = files.where(F.col(column).rlike(pattern))
    return found.select(*(F.regexp_extract(column, pattern, k).cast("int").alias(n) for k, n in ((1, "tile_row"), (2, "tile_col")))).distinct()


def raster(spark: SparkSession, path: str, value: str = "z") -> DataFrame:
    """A pixel table with the nodata value as NULL."""
    out = spark.read.parquet(path)
    return out.withColumn(value, F.when(~F.isnan(value) & (F.col(value) != K.NODATA), F.col(value)))


def demographics(spark: SparkSession, path: str) -> DataFrame:
    """Array-of-arrays JSON documents as one row per tract."""
    return census_rows(spark.read.text(path, wholetext=True), "value")


def energy_burden_strata(spark: SparkSession, path: str) -> DataFrame:
    """Strata rows: the key stays text; one column for the cost of each fuel in FUELS."""
    raw = spark.read.csv(path, header=True)
    number = lambda c: F.col(f"`{c}`").try_cast("double")
    return raw.select("FIP", number("HINCP*UNITS").alias("income"), *(number(c).alias(name) for name, c in FUELS.items()))


def city(spark: SparkSession, path: str, tiles: list[tuple[int, int]] | None = None) -> DataFrame:
    """City results, pruned to tiles where given."""
    out = spark.read.parquet(path)
    if tiles is None:
        return out
    return out.where(F.struct("tile_row", "tile_col").isin([F.struct(F.lit(r), F.lit(c)) for r, c in tiles]))
