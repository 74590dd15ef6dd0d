"""Clear-sky irradiance of a surface with the shadows that it casts on itself, per cell and day.

The sun's path and the beam and diffuse parts follow the published European Solar Radiation Atlas model; slopes get the
isotropic share of the sky and light from the ground. Shadows need each cell's surroundings, which no relational form
gives at bearable cost: a tile with its halo is one array.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

#: Turbidity, ground reflectance and hours between two positions of the sun: defaults of the model, not of the data.
LINKE, ALBEDO, STEP_H = 3.0, 0.2, 0.5
#: Directions in which a horizon is searched.
DIRECTIONS = 64
LATITUDE = 38.9
OUT = "r int, c int, month int, day int, wh double, wh_unshaded double"


def beam_and_diffuse(day: int, sin_h: float, linke: float = LINKE) -> tuple[float, float]:
    """W/m2 at a clear sky: the beam on a plane that faces the sun, the diffuse part on a level one."""
    outside = 1367 * (1 + 0.03344 * np.cos(2 * np.pi * day / 365.25 - 0.048869))
    mass = 1 / (sin_h + 0.50572 * (np.degrees(np.arcsin(sin_h)) + 6.07995) ** -1.6364)
    thick = np.polyval([-0.00013, 0.0065, -0.1202, 1.7513, 6.6296], mass) if mass <= 20 else 10.4 + 0.718 * mass
    zenith = np.polyval([0.0003797, 0.030543, -0.015843], linke)
    a = [np.polyval(p, linke) for p in ([0.0031408, -0.061581, 0.26463], [-0.011161, 0.018945, 2.0402], [0.0085079, 0.039231, -1.3025])]
    a[0] = max(a[0], 0.0022 / zenith)
    return outside * np.exp(-0.8662 * linke * mass / thick), outside * zenith * (a[0] + a[1] * sin_h + a[2] * sin_h**2)


def sun_path(day: int, latitude: float, step_h: float = STEP_H) -> Iterator[tuple[float, float]]:
    """(sine of the height, azimuth in radians from north by east) at the middle of each step of solar time by day."""
    angle, lat = 2 * np.pi * day / 365.25, np.radians(latitude)
    tilt = np.arcsin(0.3978 * np.sin(angle - 1.4 + 0.0355 * np.sin(angle - 0.0489)))
    for hour in np.arange(step_h / 2, 24, step_h):
        turn = np.radians(15 * (hour - 12))
        sin_h = np.sin(lat) * np.sin(tilt) + np.cos(lat) * np.cos(tilt) * np.cos(turn)
        if sin_h > 0:
            yield float(sin_h), float(np.arctan2(-np.cos(tilt) * np.sin(turn), np.sin(tilt) * np.cos(lat) - np.cos(tilt) * np.sin(lat) * np.cos(turn)))


def horizon(z: np.ndarray, azimuth: float, reach: int, res: float) -> np.ndarray:
    """Tangent of the height of what stands in one direction within ``reach`` cells; missing cells hide nothing."""
    out, seen = np.zeros(z.shape), set()
    rows, cols = z.shape
    for k in range(1, reach + 1):
        dr, dc = round(-k * np.cos(azimuth)), round(k * np.sin(azimuth))
        if (dr, dc) in seen or abs(dr) >= rows or abs(dc) >= cols:
            continue
        seen.add((dr, dc))
        here = np.s_[max(0, -dr) : rows - max(0, dr), max(0, -dc) : cols - max(0, dc)]
        there = np.s_[max(0, dr) : rows - max(0, -dr), max(0, dc) : cols - max(0, -dc)]
        out[here] = np.fmax(out[here], (z[there] - z[here]) / (np.hypot(dr, dc) * res))
    return out


def daily(z: np.ndarray, res: float, days: tuple[int, ...], latitude: float, reach: int, linke: float, step_h: float) -> np.ndarray:
    """Wh/m2 by (shaded or not, day, row, column); NaN where a cell or a neighbour that its slope needs is missing."""
    slope = [np.gradient(z, res, axis=k) if z.shape[k] > 1 else np.full(z.shape, np.nan) for k in (0, 1)]
    norm = np.sqrt(1 + slope[0] ** 2 + slope[1] ** 2)
    out = np.zeros((2, len(days), *z.shape))
    beams = defaultdict(list)
    for n, day in enumerate(days):
        for sin_h, azimuth in sun_path(day, latitude, step_h):
            beam, diffuse = beam_and_diffuse(day, sin_h, linke)
            out[:, n] += step_h * (diffuse * (1 + 1 / norm) + ALBEDO * (beam * sin_h + diffuse) * (1 - 1 / norm)) / 2
            beams[round(azimuth / (2 * np.pi) * DIRECTIONS) % DIRECTIONS].append((n, sin_h, azimuth, beam))
    for direction, found in beams.items():
        hidden = horizon(z, 2 * np.pi * direction / DIRECTIONS, reach, res)
        for n, sin_h, azimuth, beam in found:
            cos_h = np.sqrt(1 - sin_h**2)
            facing = (cos_h * (slope[0] * np.cos(azimuth) - slope[1] * np.sin(azimuth)) + sin_h) / norm
            got = step_h * beam * np.maximum(facing, 0)
            out[1, n] += got
            out[0, n] += np.where(hidden * cos_h < sin_h, got, 0)
    out[:, :, np.isnan(z)] = np.nan
    return out


def irradiance(
    pixels: DataFrame, res: float, days: tuple[int, ...] = K.MID_MONTH_DAYS, latitude: float = LATITUDE, reach_m: float = K.TILE_BUFFER_M,
    tile_px: int = 256, linke: float = LINKE, step_h: float = STEP_H,
) -> DataFrame:
    """Wh/m2 of each cell on each of ``days``, with and without shadows; NULL where the slope is unknown.

    :param pixels: r, c int (rows run south), z double or NULL; one row per cell.
    :return: (r, c, month: the day's place in ``days``, day, wh, wh_unshaded).

    Cells go to their tile and to those within ``reach_m``, so a task holds one tile with its halo whatever the size
    of the grid, and results do not depend on ``tile_px``. What stands farther than ``reach_m`` casts no shadow.
    """
    reach = int(np.ceil(reach_m / res))
    halo = max(1, reach)

    def near(name: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(name) - halo) / tile_px), F.floor((F.col(name) + halo) / tile_px)))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        (tr, tc), r, c = key, frame["r"].to_numpy(int), frame["c"].to_numpy(int)
        own = frame[(r // tile_px == tr) & (c // tile_px == tc)]
        z = np.full((r.max() - r.min() + 1, c.max() - c.min() + 1), np.nan)
        z[r - r.min(), c - c.min()] = frame["z"].to_numpy(float)
        if own.empty:
            return pd.DataFrame(columns=["r", "c", "month", "day", "wh", "wh_unshaded"])
        found = daily(z, res, days, latitude, reach, linke, step_h)[:, :, own["r"].to_numpy(int) - r.min(), own["c"].to_numpy(int) - c.min()]
        many = len(own)
        return pd.DataFrame({
            "r": np.tile(own["r"].to_numpy(), len(days)), "c": np.tile(own["c"].to_numpy(), len(days)),
            "month": np.repeat(np.arange(1, len(days) + 1), many), "day": np.repeat(days, many), "wh": found[0].ravel(), "wh_unshaded": found[1].ravel(),
        })

    dealt = pixels.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("z").cast("double").alias("z")).where("r is not null and c is not null")
    dealt = dealt.withColumn("tr", near("r")).withColumn("tc", near("c"))
    return dealt.groupBy("tr", "tc").applyInPandas(run, OUT)


def shading_loss(days: DataFrame) -> DataFrame:
    """Per cent of the unshaded irradiance that shadows take, per day."""
    return days.groupBy("day").agg((100 * F.avg(F.col("wh_unshaded") - F.col("wh")) / F.avg("wh_unshaded")).alias("loss_pct"), F.count("wh").alias("n_px"))
