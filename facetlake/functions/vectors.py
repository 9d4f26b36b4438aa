"""Geometry on struct<x,y,z> and array columns."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def vec(x: Column | float, y: Column | float, z: Column | float) -> Column:
    as_col = lambda v: v.cast("double") if isinstance(v, Column) else F.lit(float(v))
    return F.struct(as_col(x).alias("x"), as_col(y).alias("y"), as_col(z).alias("z"))


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def sub(a: Column, b: Column) -> Column:
    return vec(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def cross(a: Column, b: Column) -> Column:
    return vec(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    n = norm(a)
    over = F.when(n > 0, n).otherwise(F.lit(1.0))
    return vec(a["x"] / over, a["y"] / over, a["z"] / over)


def parallel(a: Column, b: Column, degrees: float = 2.0) -> Column:
    return F.abs(dot(unit(a), unit(b))) >= math.cos(math.radians(degrees))


def perpendicular(a: Column, b: Column, degrees: float = 2.0) -> Column:
    return F.abs(dot(unit(a), unit(b))) <= math.sin(math.radians(degrees))


def triangle_area(a: Column, b: Column, c: Column) -> Column:
    return norm(cross(sub(b, a), sub(c, a))) / 2


def barycentric_point(a: Column, b: Column, c: Column, r1: Column, r2: Column) -> Column:
    """The point of a triangle for two uniform numbers."""
    s = F.sqrt(r1)
    at = lambda k: (1 - s) * a[k] + s * (1 - r2) * b[k] + s * r2 * c[k]
    return vec(at("x"), at("y"), at("z"))


def hash_uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def rounded_rect_sdf(point: Column, origin: Column, u: Column, n: Column, half_u: Column, half_v: Column, corner: Column, t0: Column, t1: Column) -> Column:
    """Signed distance from an extruded rounded rectangle; v completes the frame as n x u."""
    d, v = sub(point, origin), cross(n, u)
    px, py, pz = dot(d, u), dot(d, v), dot(d, n)
    qx, qy = F.abs(px) - (half_u - corner), F.abs(py) - (half_v - corner)
    zero = F.lit(0.0)
    flat = F.sqrt(F.pow(F.greatest(qx, zero), 2) + F.pow(F.greatest(qy, zero), 2)) + F.least(F.greatest(qx, qy), zero) - corner
    along = F.greatest(t0 - pz, pz - t1)
    outside = F.sqrt(F.pow(F.greatest(flat, zero), 2) + F.pow(F.greatest(along, zero), 2))
    return outside + F.least(F.greatest(flat, along), zero)


def unproject(row: Column, col: Column, depth: Column, camera: Column, resolution: int, fov_degrees: float) -> Column:
    """The point behind a pixel's centre at a depth along the view; camera has eye, right, up and forward."""
    half = math.tan(math.radians(fov_degrees) / 2)
    x, y = ((col + 0.5) / resolution * 2 - 1) * half, (1 - (row + 0.5) / resolution * 2) * half
    at = lambda k: camera["eye"][k] + depth * (camera["forward"][k] + x * camera["right"][k] + y * camera["up"][k])
    return vec(at("x"), at("y"), at("z"))


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
