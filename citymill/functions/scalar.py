"""Scalar functions as columns: frames, angles, cameras, names, paths, small geometry.

Every function takes and returns columns, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAN, _INF = float("nan"), float("inf")


def number(text: Column) -> Column:
    """The text as a double; null where it is not a plain decimal number (nan and inf are numbers too).

    Casts also take forms such as 1.0f, 1d or 0x1p3, which other engines refuse; the last
    character and the letter x tell them without a regular expression.
    """
    low = F.lower(text)
    plain = F.substring(text, -1, 1).isin(*"0123456789.") & ~F.contains(low, F.lit("x"))
    special = F.when(low.isin("nan", "+nan", "-nan"), F.lit(_NAN)).when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(_INF)).when(low.isin("-inf", "-infinity"), F.lit(-_INF))
    return F.when(plain, text.try_cast("double")).otherwise(special)


# frames and boxes


def stored_position(cx: Column, cy: Column, cz: Column) -> Column:
    """Scene centre (z up) to the stored order of chunk metadata (y up)."""
    return F.array(cx, cz, -cy)


def scene_centre(position: Column) -> tuple[Column, Column, Column]:
    """The inverse of stored_position."""
    return position[0], -position[2], position[1]


def to_cube(value: Column, centre: Column, size: Column) -> Column:
    """A coordinate within a cube scaled to -1 .. 1; null where the size is not positive."""
    return F.when(size > 0, (value - centre) * F.lit(2.0) / size)


def rotate_y(x: Column, z: Column, degrees: float | Column) -> tuple[Column, Column]:
    """x and z after a turn about the y axis; zero degrees is an exact copy."""
    angle = F.radians(F.lit(degrees) if not isinstance(degrees, Column) else degrees)
    turned = (x * F.cos(angle) + z * F.sin(angle), z * F.cos(angle) - x * F.sin(angle))
    return (F.when(angle == 0, x).otherwise(turned[0]), F.when(angle == 0, z).otherwise(turned[1]))


def rotate_contour(contour: Column, degrees: float) -> Column:
    """rotate_y for each point of an array of structs (x, y, z)."""

    def turned(p: Column) -> Column:
        x, z = rotate_y(p["x"], p["z"], degrees)
        return F.struct(x.alias("x"), p["y"].alias("y"), z.alias("z"))

    return F.transform(contour, turned)


# angles and cameras


def clamp(value: Column, low: float | Column, high: float | Column) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.greatest(as_column(low), F.least(as_column(high), value))


def wrap_degrees(angle: Column) -> Column:
    """Into -180 (included) to 180; values within 1e-9 of zero become zero."""
    wrapped = F.pmod(angle + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    return F.when(F.abs(wrapped) < 1e-9, 0.0).otherwise(wrapped)


def ground_footprint(height: Column, fov_degrees: Column) -> Column:
    """Width on the ground that a camera sees; half the field of view is kept within 5 to 170 degrees."""
    return F.lit(2.0) * height * F.tan(F.radians(clamp(fov_degrees / 2, 5.0, 170.0)))


def vertical_fov(horizontal_degrees: Column, aspect: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(aspect * F.tan(F.radians(horizontal_degrees) / 2)))


def ceil_to(value: Column, factor: Column) -> Column:
    """The least multiple of a positive factor that is not below value."""
    return F.when(factor > 0, F.ceil(value / factor).cast("double") * factor)


def overlap_step(footprint: Column, overlap: Column) -> Column:
    """Distance between pictures: at least a tenth of the footprint; overlap is kept within 0 to 0.95."""
    return F.greatest(footprint * (F.lit(1.0) - clamp(overlap, 0.0, 0.95)), footprint * 0.1)


def nan_to_zero(value: Column) -> Column:
    return F.nanvl(value, F.lit(0.0))


def not_finite_to_one(value: Column) -> Column:
    return F.when(is_finite(value), value).otherwise(F.lit(1.0))


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


# vectors


def cross_2d(ox: Column, oy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def shoelace_area(ring: Column) -> Column:
    """Signed area of an array of structs (x, z); positive if it runs against the clock."""
    after = lambda i: F.get(ring, (i + 1) % F.size(ring))
    twice = F.transform(ring, lambda p, i: p["x"] * after(i)["z"] - after(i)["x"] * p["z"])
    return F.aggregate(twice, F.lit(0.0), lambda a, v: a + v) / 2


def in_triangle(px: Column, py: Column, corners: tuple[tuple[Column, Column], ...], eps: float = 1e-12) -> Column:
    """Whether a point is in a triangle or on its edge, by the signs of three cross products."""
    (ax, ay), (bx, by), (cx, cy) = corners
    signs = [cross_2d(px, py, ax, ay, bx, by), cross_2d(px, py, bx, by, cx, cy), cross_2d(px, py, cx, cy, ax, ay)]
    negative = (signs[0] < -eps) | (signs[1] < -eps) | (signs[2] < -eps)
    positive = (signs[0] > eps) | (signs[1] > eps) | (signs[2] > eps)
    return ~(negative & positive)


def distance(dx: Column, dy: Column, dz: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def edge_normal(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column], least: float = 1e-4) -> tuple[Column, Column, Column]:
    """The unit mean of two normals; its length counts as `least` at least."""
    mean = [(p + q) / 2 for p, q in zip(a, b, strict=True)]
    norm = F.greatest(F.lit(least), distance(*mean))
    return mean[0] / norm, mean[1] / norm, mean[2] / norm


def angle_between(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Degrees between two vectors; 0 where one has no length."""
    dot = a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    lengths = distance(*a) * distance(*b)
    return F.when(lengths > 0, F.degrees(F.acos(clamp(dot / F.when(lengths > 0, lengths), -1.0, 1.0)))).otherwise(0.0)


# names and paths


def natural_key(name: Column) -> Column:
    """All numbers of a name, in order: arrays compare as the names sort by number."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), lambda d: d.cast("decimal(38,0)"))


def index_triple(name: Column) -> Column:
    """The three numbers of a name a_b_c as an array; null if it has another form."""
    parts = F.split(name, "_")
    return F.when((F.size(parts) == 3) & F.forall(parts, lambda p: p.rlike(r"^\s*[+-]?\d+\s*$")), F.transform(parts, lambda p: F.trim(p).cast("int")))


def name_prefix(name: Column) -> Column:
    """a_b of a name with at least two parts, numbers or not."""
    parts = F.split(name, "_")
    return F.when(F.size(parts) >= 2, F.concat_ws("_", parts[0], parts[1]))


def chunk_name(i: Column, j: Column, k: Column) -> Column:
    return F.concat_ws("_", i.cast("string"), j.cast("string"), k.cast("string"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(path: Column) -> Column:
    """The base name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def object_name(path: Column) -> Column:
    """The base name up to its first dot."""
    return F.regexp_extract(base_name(path), r"^([^.]*)", 1)


def extension(path: Column) -> Column:
    """The last extension in lower case, with its dot; empty without one."""
    return F.lower(F.regexp_extract(base_name(path), r".(\.[^.]*)$", 1))


def normal_extension(text: Column) -> Column:
    """An extension as a user may write it: trimmed, with a dot, in lower case."""
    plain = F.lower(F.trim(text))
    return F.when(plain.startswith("."), plain).otherwise(F.concat(F.lit("."), plain))


def is_hidden(relative: Column) -> Column:
    return F.exists(F.split(relative, "/"), lambda p: p.startswith("."))


def numbered(prefix: Column, index: Column) -> Column:
    return F.format_string("%s_%04d", prefix, index)


def fixed(value: Column, digits: int = 6) -> Column:
    """The number with so many digits; for reports, not for comparisons between engines."""
    return F.format_string(f"%.{digits}f", value)


# options of a plan


def parse_steps(text: str) -> tuple[float, float]:
    """'a,b' as two numbers."""
    parts = [float(p) for p in text.split(",")]
    if len(parts) != 2:
        raise ValueError(f"two numbers are needed, not {text!r}")
    return parts[0], parts[1]


def positive(value: float, name: str) -> float:
    if not value > 0 or math.isinf(value):
        raise ValueError(f"{name} must be positive, not {value}")
    return value
