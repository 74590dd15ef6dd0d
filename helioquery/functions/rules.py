"""Scalar rules of roof scoring as columns. Missing numbers are NULL throughout, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def roof_class(tilt: Column, aspect: Column) -> Column:
    """flat, pitched_sun_facing or pitched_north_facing; an unknown tilt falls through to the last."""
    return F.when(tilt < K.FLAT_THRESHOLD_DEG, "flat").when(aspect.between(*K.SUN_FACING), "pitched_sun_facing").otherwise("pitched_north_facing")


def unsuitable_reason(tilt: Column, aspect: Column, poa: Column) -> Column:
    """The first rule that fails, NULL if none does; unknown insolation is no failure."""
    out = F.when(tilt.isNull(), "no_plane_fit").when(tilt > K.MAX_SLOPE_DEG, "too_steep")
    return out.when(roof_class(tilt, aspect) == "pitched_north_facing", "north_facing").when(poa < K.MIN_INSOLATION, "low_insolation")


def pv_yield(area: Column, poa: Column) -> dict[str, Column]:
    """Real-sky insolation, capacity, annual energy and avoided CO2."""
    real = poa * K.REAL_SKY
    energy = area * real * K.MODULE_EFF * K.PERFORMANCE_RATIO
    return {"poa_real_kwh_m2": real, "capacity_kw": area * K.POWER_DENSITY, "annual_energy_kwh": energy, "annual_co2_kg": energy * K.GRID_CO2}


def tilt_aspect(a: Column, b: Column) -> tuple[Column, Column]:
    """Degrees of slope and downhill direction of z = ax + by + c; a level plane faces south by convention."""
    aspect = F.pmod(F.degrees(F.atan2(-a, -b)), F.lit(360.0))
    return F.degrees(F.atan(F.hypot(a, b))), F.when((a == 0) & (b == 0), 180.0).otherwise(aspect)


def low_confidence(ratio: Column, pixels: Column) -> Column:
    return (ratio < 0.5) | (pixels < 20)


def roof_type(planes: Column, name: Column) -> Column:
    """Archetype by facet count and roof class; a roof without a plane has none, which is an error."""
    several = planes >= K.SEVERAL_PLANES
    known = F.when(name == "flat", F.when(several, "complex").otherwise("flat")).otherwise(F.when(several, "hip").otherwise("gable"))
    return F.when(planes >= 1, known).otherwise(F.raise_error(F.concat(F.lit("unfittable roof has no roof type: n_planes "), F.coalesce(planes.cast("string"), F.lit("null")))).cast("string"))


def fitted_type(planes: Column, name: Column) -> Column:
    """The archetype, or ``unfittable`` where no plane was fitted."""
    return F.when(planes == 0, "unfittable").otherwise(roof_type(planes, name))


def plane_count(text: Column) -> Column:
    """A whole number of 1 or more, as text or number; anything else NULL."""
    number = text.try_cast("double")
    return F.when((number >= 1) & (number < 1e9) & (number == F.floor(number)), number.cast("int"))


def outcome(label: Column, model: Column) -> Column:
    """Name of a (label, model) pair of flags."""
    return F.when(label & model, "hit").when(label & ~model, "miss").when(~label & model, "false_positive").when(~label & ~model, "true_negative")


def city_id(row: Column, col: Column, building: Column) -> Column:
    """Building ids are unique within a tile; this one is so in the city."""
    return F.concat_ws("_", row, col, building)


def within_tolerance(value: Column, reference: float = K.BENCHMARK_KWH_PER_KWP, tolerance: float = K.BENCHMARK_TOLERANCE) -> Column:
    return F.abs(value - reference) / reference <= tolerance


def parsed_flag(text: Column) -> Column:
    """Yes and no words as booleans, anything else NULL."""
    word = F.lower(F.trim(text))
    return F.when(word.isin("y", "yes", "true", "1"), True).when(word.isin("n", "no", "false", "0"), False)


def excluded(notes: Column) -> Column:
    return F.upper(F.trim(F.coalesce(notes, F.lit("")))).startswith("EXCLUDE")


def compass(degrees: Column, points: int = 8) -> Column:
    names = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"] if points == 8 else "N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW".split()
    return F.element_at(F.array(*map(F.lit, names)), F.pmod(F.round(degrees / (360 / points)), F.lit(points)).cast("int") + 1)


def rounded(value: Column, digits: int) -> Column:
    """Half-even rounding of the scaled value."""
    return F.rint(value * 10**digits) / 10**digits


def geoid(value: Column) -> Column:
    """Eleven digits, zero padded; longer values stay as they are."""
    text = value.cast("string")
    return F.when(F.length(text) >= 11, text).otherwise(F.lpad(text, 11, "0"))


def web_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile (x, y) of a point."""
    n, phi = 1 << zoom, F.radians(lat)
    return ((lon + 180) / 360 * n).cast("int"), ((1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / F.pi()) / 2 * n).cast("int")


def quadkey_of(x: Column, y: Column, zoom: int) -> Column:
    """Base-4 key of a tile: a digit for each zoom step."""
    bits = F.sequence(F.lit(zoom - 1), F.lit(0), F.lit(-1))
    digit = lambda v, i: v.cast("long").bitwiseAND(F.pow(F.lit(2), i).cast("long")) > 0
    return F.array_join(F.transform(bits, lambda i: (digit(x, i).cast("int") + 2 * digit(y, i).cast("int")).cast("string")), "")


def quadkey(lon: Column, lat: Column, zoom: int) -> Column:
    """Web-Mercator tile key of a point."""
    return quadkey_of(*web_tile(lon, lat, zoom), zoom)


def transverse_mercator(lon: Column, lat: Column, lon0: float = -75.0, k0: float = 0.9996, east: float = 500000.0) -> tuple[Column, Column]:
    """Easting and northing on GRS80 by the published sixth-order Krüger series (zone 18 by default)."""
    a, f = 6378137.0, 1 / 298.257222101
    n, e = f / (2 - f), (f * (2 - f)) ** 0.5
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    )
    s, d = F.sin(F.radians(lat)), F.radians(lon - lon0)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(d)), F.asinh(F.sin(d) / F.sqrt(t * t + F.cos(d) * F.cos(d)))
    x, y = eta, xi
    for j, c in enumerate(alpha, 1):
        x = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return k0 * radius * x + east, k0 * radius * y


def transverse_mercator_inverse(x: Column, y: Column, lon0: float = -75.0, k0: float = 0.9996, east: float = 500000.0) -> tuple[Column, Column]:
    """Longitude and latitude of an easting and northing, by the published inverse series of the same order."""
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360 - 81 * n**5 / 512 + 96199 * n**6 / 604800,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440 + 46 * n**5 / 105 - 1118711 * n**6 / 3870720,
        17 * n**3 / 480 - 37 * n**4 / 840 - 209 * n**5 / 4480 + 5569 * n**6 / 90720,
        4397 * n**4 / 161280 - 11 * n**5 / 504 - 830251 * n**6 / 7257600,
        4583 * n**5 / 161280 - 108847 * n**6 / 3991680,
        20648693 * n**6 / 638668800,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45 + 26 * n**5 / 45 - 2854 * n**6 / 675,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45 + 2704 * n**5 / 315 + 2323 * n**6 / 945,
        56 * n**3 / 15 - 136 * n**4 / 35 - 1262 * n**5 / 105 + 73814 * n**6 / 2835,
        4279 * n**4 / 630 - 332 * n**5 / 35 - 399572 * n**6 / 14175,
        4174 * n**5 / 315 - 144838 * n**6 / 6237,
        601676 * n**6 / 22275,
    )
    xi0, eta0 = y / (k0 * radius), (x - east) / (k0 * radius)
    xi, eta = xi0, eta0
    for j, c in enumerate(beta, 1):
        xi = xi - c * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - c * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j, c in enumerate(delta, 1):
        lat = lat + c * F.sin(2 * j * chi)
    return lon0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area of a closed ring array<struct<x,y>>."""
    parts = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)) / 2


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Area-weighted centroid of a closed ring."""
    p, q = F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1)
    cross = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    total = lambda f: F.aggregate(F.zip_with(p, q, f), F.lit(0.0), lambda s, v: s + v)
    twice = total(cross)
    return total(lambda a, b: (a["x"] + b["x"]) * cross(a, b)) / (3 * twice), total(lambda a, b: (a["y"] + b["y"]) * cross(a, b)) / (3 * twice)


def point_in_ring(x: Column, y: Column, ring: Column, boundary_in: bool = True) -> Column:
    """Crossing-number test with an explicit test of the edges, which count as ``boundary_in`` says."""
    p, q = F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1)
    edges = F.arrays_zip(p.alias("p"), q.alias("q"))

    def on(e: Column) -> Column:
        a, b = e["p"], e["q"]
        flat = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return flat & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    def crosses(e: Column) -> Column:
        a, b = e["p"], e["q"]
        side = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return ((a["y"] > y) != (b["y"] > y)) & (F.when(b["y"] > a["y"], side > 0).otherwise(side < 0))

    inside = F.size(F.filter(edges, crosses)) % 2 == 1
    edge = F.exists(edges, on)
    return (edge | inside) if boundary_in else (~edge & inside)


def box_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(minx, miny), corner(maxx, miny), corner(maxx, maxy), corner(minx, maxy), corner(minx, miny))
