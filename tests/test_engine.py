import numpy as np
import pytest

from helioquery.fixtures import fixture
from helioquery.functions import rules
from helioquery.operators import areas, facets, scoring
from helioquery.plans.city import pending, score_city, validity_key, write_city
from helioquery.sources import readers
from helioquery.streaming.tiles import score_arrivals
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_gable_has_two_facets_and_small_block_is_dropped():
    x = np.array([(i, j) for i in range(20) for j in range(40)], dtype=float)
    z = 10 - np.abs(x[:, 1] - 19.5) * 0.6
    assert len(facets.peel(x, z)) == 2 and len(facets.peel(x, z, most=1)) == 1
    x = np.array([(i, j) for i in range(20) for j in range(20)], dtype=float)
    for size, drop, want in (((4, 5), 2.0, 1), ((6, 6), 3.0, 2), ((4, 5), -2.0, 2)):
        z = np.where((x[:, 0] < size[0]) & (x[:, 1] < size[1]), drop, 0.0)
        assert len(facets.split_superstructures(facets.peel(x, z), x, z)[0]) == want


def test_rank_has_average_ties(spark):
    df = spark.createDataFrame([(10.0, 1), (10.0, 1), (20.0, 1), (99.0, 0), (None, 1)], "v double, ok int")
    got = sorted(r["suitability"] for r in scoring.percentile_rank(df, "v", F.col("ok") == 1).collect())
    assert got == [0.0, 0.0, 50.0, 50.0, 100.0]
    values = [-3.5, -3.25, -1e-9, 0.0, 1e-9, 0.5, 1.0, 1.0000000001, 7.9, 8.0, 8.1, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["suitability"] for r in scoring.percentile_rank(df, "v", F.lit(True)).collect()}
    assert [round(got[v] * 12 / 100, 6) for v in values] == list(range(1, 13))


def test_mercator_and_quadkey(spark):
    x, y = rules.transverse_mercator(F.lit(-77.03), F.lit(38.90))
    row = spark.range(1).select(x.alias("x"), y.alias("y"), rules.quadkey(F.lit(-77.03), F.lit(38.90), 9).alias("k")).first()
    assert abs(row["x"] - 323963.710) < 0.002 and abs(row["y"] - 4307638.330) < 0.002 and row["k"] == "032010032"


def test_resume_and_partitioned_results(spark, tmp_path):
    scored = score_city(fixture(spark, SF, "planes"), fixture(spark, SF, "buildings"))
    write_city(scored, str(tmp_path / "city"))
    back = readers.city(spark, str(tmp_path / "city"))
    assert back.count() == scored.count()
    tiles = back.select("tile_row", "tile_col").distinct()
    key = validity_key("scoring", "1", validity_key("surface", "1"), day_range=[2, 1])
    assert key == validity_key("scoring", "1", validity_key("surface", "1"), day_range=[1, 2]) != validity_key("scoring", "2")
    manifest = tiles.limit(3).withColumns({"status": F.lit("done"), "stamp": F.lit(key)})
    assert pending(tiles, manifest, key).count() == tiles.count() - 3
    with pytest.raises(ValueError):
        readers.footprints(spark, "nowhere", "x")


def test_stream_equals_batch(spark, tmp_path):
    planes = fixture(spark, SF, "planes")
    planes.repartition(3).write.parquet(str(tmp_path / "in"))
    score_arrivals(spark, str(tmp_path / "in"), planes.schema, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination(120)
    want = scoring.plane_yields(scoring.usable_planes(planes))
    assert spark.read.parquet(str(tmp_path / "out")).select(want.columns).exceptAll(want).isEmpty()
    assert areas.merge_tiles(planes, planes).count() == 2 * planes.count()
