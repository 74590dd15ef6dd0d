"""Polygons as arrays of closed rings of (x, y): outer rings run counter-clockwise, holes clockwise, parts stand side by side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import box_ring, transverse_mercator, transverse_mercator_inverse


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return F.array(box_ring(minx, miny, maxx, maxy))


def edges(rings: Column) -> Column:
    """All edges (p, q) of all rings."""
    def of(ring: Column) -> Column:
        return F.arrays_zip(F.slice(ring, F.lit(1), F.size(ring) - 1).alias("p"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("q"))

    return F.flatten(F.transform(rings, of))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _corner(rings: Column) -> Column:
    return F.get(F.get(rings, F.lit(0)), F.lit(0))


def _moments(rings: Column) -> tuple[Column, Column, Column]:
    """Twice the area and six times the first moments about the first corner, where products stay small."""
    at = _corner(rings)

    def cross(e: Column) -> Column:
        return (e["p"]["x"] - at["x"]) * (e["q"]["y"] - at["y"]) - (e["q"]["x"] - at["x"]) * (e["p"]["y"] - at["y"])

    twice = _sum(F.transform(edges(rings), cross))
    mx, my = (_sum(F.transform(edges(rings), lambda e: (e["p"][k] + e["q"][k] - 2 * at[k]) * cross(e))) for k in ("x", "y"))
    return twice, mx, my


def area(rings: Column) -> Column:
    return F.abs(_moments(rings)[0]) / 2


def centroid(rings: Column) -> tuple[Column, Column]:
    twice, mx, my = _moments(rings)
    at = _corner(rings)
    return at["x"] + mx / (3 * twice), at["y"] + my / (3 * twice)


def bounds(rings: Column) -> dict[str, Column]:
    points = F.flatten(rings)
    xs, ys = (F.transform(points, lambda p: p[k]) for k in ("x", "y"))
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def holds(rings: Column, x: Column, y: Column, boundary_in: bool = True) -> Column:
    """Whether the polygon holds the point, holes not; its boundary, that of holes too, counts as ``boundary_in`` says."""
    def on(e: Column) -> Column:
        a, b = e["p"], e["q"]
        flat = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return flat & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    def crosses(e: Column) -> Column:
        a, b = e["p"], e["q"]
        side = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return ((a["y"] > y) != (b["y"] > y)) & F.when(b["y"] > a["y"], side > 0).otherwise(side < 0)

    inside, edge = F.size(F.filter(edges(rings), crosses)) % 2 == 1, F.exists(edges(rings), on)
    return (edge | inside) if boundary_in else (~edge & inside)


def interior_point(rings: Column) -> tuple[Column, Column]:
    """A point inside: the middle of the widest stretch of a line half-way between the corners next to the middle height."""
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    mid = (F.array_min(ys) + F.array_max(ys)) / 2
    y = (F.array_max(F.filter(ys, lambda v: v <= mid)) + F.array_min(F.filter(ys, lambda v: v > mid))) / 2
    cut = F.filter(edges(rings), lambda e: (e["p"]["y"] > y) != (e["q"]["y"] > y))
    xs = F.array_sort(F.transform(cut, lambda e: e["p"]["x"] + (y - e["p"]["y"]) * (e["q"]["x"] - e["p"]["x"]) / (e["q"]["y"] - e["p"]["y"])))
    spans = F.transform(F.sequence(F.lit(0), F.size(xs) - 2, F.lit(2)), lambda i: F.struct((F.get(xs, i + 1) - F.get(xs, i)).alias("width"), (-i).alias("order"), ((F.get(xs, i) + F.get(xs, i + 1)) / 2).alias("x")))
    return F.array_max(spans)["x"], y


def near(rings: Column, x: Column, y: Column, distance: float) -> Column:
    """Whether the point lies in the polygon or within ``distance`` of it: a buffer as a predicate, its corners round."""
    def apart(e: Column) -> Column:
        a, dx, dy = e["p"], e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - a["x"]) * dx + (y - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))))
        return F.pow(x - a["x"] - t * dx, F.lit(2)) + F.pow(y - a["y"] - t * dy, F.lit(2))

    return holds(rings, x, y) | F.exists(edges(rings), lambda e: apart(e) <= distance * distance)


def snapped(rings: Column, step: float) -> Column:
    """Coordinates rounded to multiples of ``step``."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct((F.rint(p["x"] / step) * step).alias("x"), (F.rint(p["y"] / step) * step).alias("y"))))


def cut_side(ring: Column, axis: str, at: Column, keep_above: bool) -> Column:
    """A closed ring cut by a line parallel to an axis, closed again; empty where nothing is left."""
    sign = 1.0 if keep_above else -1.0
    rest = "y" if axis == "x" else "x"

    def corner(p: Column) -> Column:
        return F.struct(p["x"].alias("x"), p["y"].alias("y"))

    def step(e: Column) -> Column:
        p, q = e["p"], e["q"]
        t = (at - p[axis]) / (q[axis] - p[axis])
        other = p[rest] + t * (q[rest] - p[rest])
        meet = F.struct(at.cast("double").alias("x"), other.alias("y")) if axis == "x" else F.struct(other.alias("x"), at.cast("double").alias("y"))
        inside = lambda c: (c[axis] - at) * sign >= 0
        return F.when(inside(p) & inside(q), F.array(corner(q))).when(inside(p), F.array(meet)).when(inside(q), F.array(meet, corner(q))).otherwise(F.slice(F.array(corner(q)), F.lit(1), F.lit(0)))

    new = F.flatten(F.transform(edges(F.array(ring)), step))
    return F.when(F.size(new) > 0, F.concat(new, F.slice(new, F.lit(1), F.lit(1)))).otherwise(new)


def _moved(rings: Column, use) -> Column:
    def point(p: Column) -> Column:
        x, y = use(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, point))


def projected(rings: Column) -> Column:
    """Rings in degrees (longitude, latitude) as rings in the working projection."""
    return _moved(rings, transverse_mercator)


def unprojected(rings: Column) -> Column:
    """Rings in the working projection as rings in degrees."""
    return _moved(rings, transverse_mercator_inverse)
