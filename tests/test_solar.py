import numpy as np
import pytest

from helioquery.operators import raster, solar
from pyspark.sql import functions as F


def grid(spark, z):
    rows = [(int(r), int(c), None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(rows, "r int, c int, z double")


def block():
    z = np.zeros((24, 20))
    z[10:13, 8:12] = 8.0
    z[2, 2] = np.nan
    return z


def test_sun_stands_south_at_noon_and_low_in_winter():
    for day, height in ((172, 90 - 38.9 + 23.44), (355, 90 - 38.9 - 23.44)):
        sin_h, azimuth = max(solar.sun_path(day, 38.9, 0.01))
        assert np.degrees(np.arcsin(sin_h)) == pytest.approx(height, abs=0.2)
        assert abs(np.degrees(azimuth) % 360 - 180) < 1
    beam, diffuse = solar.beam_and_diffuse(172, 0.9)
    assert 700 < beam < 1000 and 60 < diffuse < 200


def test_block_shades_its_north_side_and_tiles_do_not_matter(spark):
    z = block()
    wide = {(r["r"], r["c"], r["day"]): (r["wh"], r["wh_unshaded"]) for r in solar.irradiance(grid(spark, z), 1.0, days=(80, 355), reach_m=6).collect()}
    cut = {(r["r"], r["c"], r["day"]): (r["wh"], r["wh_unshaded"]) for r in solar.irradiance(grid(spark, z), 1.0, days=(80, 355), reach_m=6, tile_px=7).collect()}
    assert len(wide) == z.size * 2 and wide.keys() == cut.keys()
    for key, (a, b) in wide.items():
        assert cut[key] == ((None, None) if a is None else (pytest.approx(a), pytest.approx(b)))
        assert a is None or 0 < a <= b + 1e-9 < 12_000
    for day in (80, 355):
        assert wide[7, 10, day][0] < 0.75 * wide[17, 10, day][0]  # north and south of the block
        assert wide[7, 10, day][1] == pytest.approx(wide[17, 10, day][1])
        assert wide[2, 2, day] == (None, None)


def test_horizon_equals_a_search_cell_by_cell():
    z = np.random.default_rng(5).random((9, 11)) * 5
    z[4, 4] = np.nan
    for azimuth in (0.0, 0.7, 2.5, 4.4):
        got = solar.horizon(z, azimuth, 5, 2.0)
        for r, c in np.ndindex(z.shape):
            if np.isnan(z[r, c]):
                continue
            best = 0.0
            for k in range(1, 6):
                i, j = r + round(-k * np.cos(azimuth)), c + round(k * np.sin(azimuth))
                if 0 <= i < 9 and 0 <= j < 11 and not np.isnan(z[i, j]):
                    best = max(best, (z[i, j] - z[r, c]) / (np.hypot(i - r, j - c) * 2))
            assert got[r, c] == pytest.approx(best)


def test_slopes_year_and_empty(spark):
    r = np.arange(6.0)[:, None] + np.zeros((6, 6))
    south, north, level = (solar.daily(z, 1.0, (80,), 38.9, 0, 3.0, 0.5)[1, 0, 3, 3] for z in (-r * 0.5, r * 0.5, r * 0))
    assert south > level > north
    days = solar.irradiance(grid(spark, np.zeros((3, 3))), 2.0, reach_m=10)
    year = raster.annual_insolation(days.withColumn("pixel", F.col("r") * 3 + F.col("c")))
    assert all(1500 < x["kwh_m2"] < 2600 for x in year.collect()) and year.count() == 9
    assert [x["loss_pct"] for x in solar.shading_loss(days).collect()] == [0.0] * 12
    assert solar.irradiance(grid(spark, np.zeros((3, 3))).limit(0), 2.0).count() == 0
