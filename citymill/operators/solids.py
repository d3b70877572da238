"""Solids from footprints: rings, triangulation, prisms, boxes, clipped triangles, merged meshes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])


def _cross(o: tuple, a: tuple, b: tuple) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def area_of(ring: list[tuple[float, float]]) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def cleaned(ring: list[tuple[float, float]], eps: float = 1e-9) -> list[tuple[float, float]]:
    """A ring without a closing point, points that repeat the one before, and points on a straight line.

    Removing a point can make its neighbours straight, so the search goes on until nothing changes.
    """
    near = lambda p, q: abs(p[0] - q[0]) <= eps and abs(p[1] - q[1]) <= eps
    out: list[tuple[float, float]] = []
    for p in ring:
        if not out or not near(p, out[-1]):
            out.append(p)
    while len(out) > 1 and near(out[0], out[-1]):
        out.pop()
    changed = True
    while changed and len(out) >= 3:
        changed = False
        for i in range(len(out)):
            if abs(_cross(out[i - 1], out[i], out[(i + 1) % len(out)])) <= eps:
                del out[i]
                changed = True
                break
    return out


def ear_clipped(ring: list[tuple[float, float]]) -> list[tuple[int, int, int]]:
    """Triangles, against the clock, of a simple ring as indices into it; ValueError if there is no ear."""
    if len(ring) < 3:
        raise ValueError("a ring needs three points")
    left = list(range(len(ring)))
    if area_of(ring) < 0:
        left.reverse()
    out = []
    while len(left) > 3:
        for i in range(len(left)):
            a, b, c = left[i - 1], left[i], left[(i + 1) % len(left)]
            if _cross(ring[a], ring[b], ring[c]) <= 1e-12:
                continue
            inside = lambda p: _cross(ring[a], ring[b], p) >= -1e-12 and _cross(ring[b], ring[c], p) >= -1e-12 and _cross(ring[c], ring[a], p) >= -1e-12  # noqa: B023, E731
            if not any(inside(ring[k]) for k in left if k not in (a, b, c)):
                out.append((a, b, c))
                del left[i]
                break
        else:
            raise ValueError("the ring crosses itself")
    return [*out, (left[0], left[1], left[2])]


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Convex hull against the clock, without points on its edges."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return ordered

    def half(walk: list[tuple[float, float]]) -> list[tuple[float, float]]:
        side: list[tuple[float, float]] = []
        for p in walk:
            while len(side) > 1 and _cross(side[-2], side[-1], p) <= 0:
                side.pop()
            side.append(p)
        return side[:-1]

    return half(ordered) + half(ordered[::-1])


def distinct_points(contour: Column, eps: float = 1e-6) -> Column:
    """Points of an array of structs (x, y, z) of which no earlier kept one is within eps in x and z: a fold, in order."""
    kind = "array<struct<x:double,y:double,z:double>>"
    near = lambda p: lambda q: (F.abs(p["x"] - q["x"]) <= eps) & (F.abs(p["z"] - q["z"]) <= eps)
    return F.aggregate(contour, F.array().cast(kind), lambda kept, p: F.when(F.exists(kept, near(p)), kept).otherwise(F.concat(kept, F.array(p))))


def cleaned_footprints(entries: DataFrame) -> DataFrame:
    """entries with ring (array of x, z), against the clock, and triangles (indices); error where there is none.

    entries: contour (array of structs x, y, z), height. Failures are data: error says why.
    """
    ring_kind = pa.list_(pa.struct([("x", pa.float64()), ("z", pa.float64())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings, parts, errors = [], [], []
            for contour in batch.column("contour").to_pylist():
                try:
                    if not contour:
                        raise ValueError("there is no contour")
                    ring = cleaned([(p["x"], p["z"]) for p in contour])
                    ring = ring[::-1] if len(ring) > 2 and area_of(ring) < 0 else ring
                    found, error = ear_clipped(ring), None
                except ValueError as e:
                    ring, found, error = [], [], str(e)
                rings.append([{"x": x, "z": z} for x, z in ring])
                parts.append([list(t) for t in found])
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rings, ring_kind), pa.array(parts, pa.list_(pa.list_(pa.int32()))), pa.array(errors, pa.string())], [*batch.schema.names, "ring", "triangles", "error"])

    return entries.mapInArrow(run, f"{schema}, ring array<struct<x:double,z:double>>, triangles array<array<int>>, error string")


def prism_vertices(entries: DataFrame, key: str = "mesh") -> DataFrame:
    """key, vid, x, y, z: the ring at the bottom, then again at bottom + height; the bottom is the contour's lowest level.

    entries: key, ring (array of structs x, z), bottom, height.
    """
    n = F.size("ring")
    both = F.concat(F.transform("ring", lambda p, i: F.struct(i.alias("vid"), p["x"].alias("x"), F.col("bottom").alias("y"), p["z"].alias("z"))), F.transform("ring", lambda p, i: F.struct((i + n).alias("vid"), p["x"].alias("x"), (F.col("bottom") + F.col("height")).alias("y"), p["z"].alias("z"))))
    return entries.select(key, F.explode(both).alias("v")).select(key, "v.*")


def prism_faces(entries: DataFrame, key: str = "mesh") -> DataFrame:
    """key, fid, idx of a closed prism over a cleaned ring: its triangles as floor and roof, four corners for each wall.

    The ring runs against the clock in (x, z); all faces then look outwards with y up.
    """
    return entries.where("size(triangles) > 0").select(key, F.posexplode(_prism_faces()).alias("fid", "idx"))


def _prism_faces() -> Column:
    n = F.size("ring")
    floor = F.transform("triangles", lambda t: F.array(t[0], t[1], t[2]))
    roof = F.transform("triangles", lambda t: F.array(t[2] + n, t[1] + n, t[0] + n))
    walls = F.transform("ring", lambda _, i: F.array(i, i + n, (i + 1) % n + n, (i + 1) % n))
    return F.concat(floor, roof, walls)


def prism_triangles(entries: DataFrame, key: str = "mesh") -> DataFrame:
    """key, fid, idx, ax .. cz: prism_faces as triangles with their corners; fid is that of the face and the place in its fan.

    An entry holds its whole ring, so each makes its own corners: nothing is joined or shuffled.
    """
    n = F.size("ring")
    faces = entries.where("size(triangles) > 0").select(key, "ring", "bottom", "height", F.posexplode(_prism_faces()).alias("_face", "_idx"))
    fans = F.transform(F.sequence(F.lit(2), F.size("_idx") - 1), lambda i: F.array(F.col("_idx")[0], F.get("_idx", i - 1), F.get("_idx", i)))
    parts = faces.select("*", F.posexplode(fans).alias("_part", "idx"))
    corner = [parts["idx"][k] for k in range(3)]
    place = {"x": lambda i: F.get("ring", i % n)["x"], "y": lambda i: F.when(i < n, F.col("bottom")).otherwise(F.col("bottom") + F.col("height")), "z": lambda i: F.get("ring", i % n)["z"]}
    return parts.select(key, F.concat_ws("_", "_face", "_part").alias("fid"), "idx", *[place[a](i).alias(f"{p}{a}") for p, i in zip("abc", corner, strict=True) for a in "xyz"])


def box(low: tuple[float, float, float], high: tuple[float, float, float], open_top: bool = False) -> tuple[list[tuple[float, float, float]], list[list[int]]]:
    """Vertices and outward faces of a box; without its top if open."""
    corners = [(x, y, z) for y in (low[1], high[1]) for x, z in ((low[0], low[2]), (high[0], low[2]), (high[0], high[2]), (low[0], high[2]))]
    faces = [[0, 1, 2, 3], [0, 4, 5, 1], [1, 5, 6, 2], [2, 6, 7, 3], [3, 7, 4, 0]]
    return corners, faces if open_top else [*faces, [4, 7, 6, 5]]


def merged(vertices: DataFrame, faces: DataFrame, group: str, key: str = "mesh") -> tuple[DataFrame, DataFrame]:
    """The meshes of each group as one: vertices and faces with group and numbers that run on.

    Offsets are a running sum over the meshes of a group, not over their vertices.
    """
    counts = vertices.groupBy(group, key).agg((F.max("vid") + 1).cast("long").alias("n"))
    before = Window.partitionBy(group).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")).select(group, key, "offset")
    moved = vertices.join(offsets, [group, key]).select(group, key, (F.col("vid") + F.col("offset")).alias("vid"), "x", "y", "z")
    own = faces.join(offsets, [group, key]).select(group, key, "fid", F.transform("idx", lambda i: i + F.col("offset")).alias("idx"))
    return moved, own


def clip_polygon(points: list[tuple], low: tuple, high: tuple) -> list[tuple]:
    """A convex polygon cut to a closed box, side by side."""
    for axis in range(3):
        for sign, limit in ((1, low[axis]), (-1, high[axis])):
            out = []
            for p, q in zip(points, points[1:] + points[:1], strict=True):
                dp, dq = sign * (p[axis] - limit), sign * (q[axis] - limit)
                if dp >= 0:
                    out.append(p)
                if (dp > 0) != (dq > 0) and dp != dq and dp * dq < 0:
                    t = dp / (dp - dq)
                    out.append(tuple(a + t * (b - a) for a, b in zip(p, q, strict=True)))
            points = out
            if not points:
                return []
    return points


def clip_triangles(triangles: DataFrame, low: tuple, high: tuple, key: str = "mesh") -> DataFrame:
    """Triangles (key, fid, corners ax .. cz) cut to a box, as triangles again.

    The cut is left open: no faces are added along the box's sides, unlike with solid clipping.
    """
    names = [f"{p}{a}" for p in "abc" for a in "xyz"]
    kind = triangles.select(key, "fid").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fids, out = [], [], []
            rows = np.column_stack([batch.column(n).to_numpy() for n in names]).reshape(-1, 3, 3)
            for k, f, t in zip(batch.column(key).to_pylist(), batch.column("fid").to_pylist(), rows, strict=True):
                ring = clip_polygon([tuple(p) for p in t.tolist()], low, high)
                for i in range(1, len(ring) - 1):
                    keys.append(k)
                    fids.append(f)
                    out.append([*ring[0], *ring[i], *ring[i + 1]])
            values = np.array(out, float).reshape(-1, 9)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(key).type), pa.array(fids, batch.schema.field("fid").type), *(pa.array(values[:, c]) for c in range(9))], [key, "fid", *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    return triangles.select(key, "fid", *names).mapInArrow(run, fields + "".join(f", {n} double" for n in names))


def ring_lines(entries: DataFrame, key: str = "mesh") -> DataFrame:
    """key, at, x, z, removed: points of each ring with whether they repeat the point before, the last counting as before the first."""
    points = entries.select(key, F.posexplode("contour").alias("at", "p")).select(key, "at", F.col("p.x").alias("x"), F.col("p.z").alias("z"))
    own = Window.partitionBy(key)
    order = own.orderBy("at")
    last = own.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = lambda c: F.coalesce(F.lag(c).over(order), F.last(c).over(last))
    return points.withColumn("removed", (F.abs(F.col("x") - before("x")) <= 1e-9) & (F.abs(F.col("z") - before("z")) <= 1e-9))


def ring_areas(entries: DataFrame, key: str = "mesh") -> DataFrame:
    """key, area: signed area of each contour."""
    return entries.select(key, scalar.shoelace_area(F.col("contour")).alias("area"))
