"""Sparse voxels: occupied cells as rows (mesh, ix, iy, iz), never dense arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates, scalar
from .grouping import codes_of, join_made, map_groups

TILE = 64  # columns or cells along a side of a tile
CANDIDATES = 1_000_000  # columns under triangles, or cells in their boxes, that are tested at once
FACES = 100_000  # given at once


def from_points(points: DataFrame, pitch: float, key: str = "mesh") -> DataFrame:
    """key, ix, iy, iz: cells that hold a point."""
    return points.select(key, *[F.floor(F.col(a) / F.lit(pitch)).cast("int").alias(f"i{a}") for a in "xyz"]).distinct()


def from_triangles(triangles: DataFrame, pitch: float, key: str = "mesh") -> DataFrame:
    """key, ix, iy, iz: cells that a triangle meets, by separating axes within the triangle's box.

    A triangle without nine finite coordinates meets none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = _corners_of(batch, pitch)
            low, size = _boxes(t)
            strides = np.column_stack([size[:, 1] * size[:, 2], size[:, 2], np.ones(len(t), np.int64)])
            starts = np.concatenate([[0], np.cumsum(size.prod(1))])
            for met in _met(t, low, size, starts[:-1], strides):
                own = np.searchsorted(starts, met, "right") - 1
                cells = low[own] + (met - starts[own])[:, None] // strides[own] % size[own]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(own)), *(pa.array(cells[:, c], pa.int32()) for c in range(3))], [key, "ix", "iy", "iz"])

    kind = triangles.schema[key].dataType.simpleString()
    return _placed(triangles).select(key, *_CORNERS).mapInArrow(run, f"`{key}` {kind}, ix int, iy int, iz int").distinct()


_CORNERS = [f"{p}{a}" for p in "abc" for a in "xyz"]


def _placed(triangles: DataFrame) -> DataFrame:
    """Triangles whose nine coordinates are finite."""
    return triangles.where(" AND ".join(f"abs({c}) < double('infinity')" for c in _CORNERS))


def _corners_of(rows: pa.RecordBatch | pa.Table, pitch: float) -> np.ndarray:
    """(n, 3 corners, 3 axes) in units of the pitch."""
    return np.column_stack([rows.column(c).to_numpy() for c in _CORNERS]).astype(float).reshape(-1, 3, 3) / pitch


def _boxes(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest cell of each triangle's box, and the number of cells along its sides."""
    low = np.floor(t.min(1)).astype(np.int64)
    return low, np.floor(t.max(1)).astype(np.int64) - low + 1


def _met(t: np.ndarray, low: np.ndarray, size: np.ndarray, base: np.ndarray, strides: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of the cells that each triangle meets among those of its box, by separating axes, some triangles at a time.

    t: (n, 3 corners, 3 axes) in units of the pitch; low, size: (n, 3), the box. The cell at x, y, z
    from low has the number base + (x, y, z) . strides. The nine axes across an edge and an axis of
    space see a whole line of cells alike, so they are tested once a line, and only the triangle's
    plane is tested cell by cell.
    """
    ends, at = np.cumsum(size.prod(1)), 0
    while at < len(t):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
        v, n, own = t[at:to] - low[at:to, None], size[at:to], strides[at:to]
        lines = [_lines_met(v, n, k) for k in range(3)]
        starts, of, y, z, keep = lines[0]
        of, y, z = of[keep], y[keep], z[keep]
        count = n[of, 0]
        first = np.cumsum(count) - count
        x = np.arange(count.sum()) - np.repeat(first, count)
        normal = np.cross(v[:, 1] - v[:, 0], v[:, 2] - v[:, 1])
        along, reach = (v * normal[:, None]).sum(2), 0.5 * np.abs(normal).sum(1) + 1e-12
        row = (y + 0.5) * normal[of, 1] + (z + 0.5) * normal[of, 2]
        plane = (x + 0.5) * np.repeat(normal[of, 0], count)
        keep = plane >= np.repeat((along.min(1) - reach)[of] - row, count)
        keep &= plane <= np.repeat((along.max(1) + reach)[of] - row, count)
        starts, *_, met = lines[1]
        keep &= met[np.repeat(starts[of] + z * count, count) + x]
        starts, *_, met = lines[2]
        keep &= met[np.repeat(starts[of] + y, count) + x * np.repeat(n[of, 1], count)]
        yield (np.repeat(base[at:to][of] + y * own[of, 1] + z * own[of, 2], count) + x * np.repeat(own[of, 0], count))[keep]
        at = to


def _lines_met(v: np.ndarray, size: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Lines of cells along axis k in each triangle's box: where a triangle's lines start, and of each line
    its triangle, its place on the two axes after k, and whether an axis across k and an edge keeps it."""
    p, q = (k + 1) % 3, (k + 2) % 3
    count = size[:, p] * size[:, q]
    starts = np.cumsum(count) - count
    of = np.repeat(np.arange(len(v)), count)
    place, depth = np.arange(len(of)) - np.repeat(starts, count), np.repeat(size[:, q], count)
    i = place // depth
    j = place - i * depth
    mid_i, mid_j, keep = i + 0.5, j + 0.5, np.ones(len(of), bool)
    for a, b in ((0, 1), (1, 2), (2, 0)):
        edge = v[:, b] - v[:, a]
        u, w = -edge[:, q], edge[:, p]
        along, reach = v[:, :, p] * u[:, None] + v[:, :, q] * w[:, None], 0.5 * (np.abs(u) + np.abs(w)) + 1e-12
        middle = mid_i * np.repeat(u, count) + mid_j * np.repeat(w, count)
        keep &= middle >= np.repeat(along.min(1) - reach, count)
        keep &= middle <= np.repeat(along.max(1) + reach, count)
    return starts, of, i, j, keep


def columns(voxels: DataFrame, key: str = "mesh") -> DataFrame:
    """key, ix, iz: columns with any occupied cell."""
    return voxels.select(key, "ix", "iz").distinct()


def ground_layer(voxels: DataFrame, layer: int, height: int, key: str = "mesh") -> DataFrame:
    """Occupied columns put into one layer, which is kept within 0 to height - 1."""
    return columns(voxels, key).select(key, "ix", F.lit(max(0, min(height - 1, layer))).alias("iy"), "iz")


def lines(segments: DataFrame, key: str = "mesh") -> DataFrame:
    """key, ix, iy, iz of all cells on axis-aligned segments, ends included, in either direction.

    segments: key, x1 .. z2 (int). A segment along more than one axis has error set and no cell.
    """
    moved = sum(((F.col(f"{a}1") != F.col(f"{a}2")).cast("int") for a in "xyz"), F.lit(0))
    straight = segments.where(moved <= 1)
    for a in "xyz":
        straight = straight.withColumn(f"i{a}", F.explode(F.sequence(f"{a}1", f"{a}2")))
    return straight.select(key, "ix", "iy", "iz").distinct()


def crooked(segments: DataFrame, key: str = "mesh") -> DataFrame:
    """Segments along more than one axis."""
    moved = sum(((F.col(f"{a}1") != F.col(f"{a}2")).cast("int") for a in "xyz"), F.lit(0))
    return segments.where(moved > 1).withColumn("error", F.lit("the segment is not parallel to an axis"))


def clipped(cells: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Cells moved into a grid of the given shape."""
    return cells.select(*[c for c in cells.columns if c not in ("ix", "iy", "iz")], *[F.greatest(F.lit(0), F.least(F.col(f"i{a}"), F.lit(n - 1))).alias(f"i{a}") for a, n in zip("xyz", shape, strict=True)])


def upward_hits(columns_: DataFrame, triangles: DataFrame, pitch: float, base: float, key: str = "mesh") -> DataFrame:
    """key, ix, iz, hit, forward: first triangle above the base that a vertical ray from each column's centre meets.

    Triangles are repeated for the columns under their box and meet the columns by an equi-join;
    the exact test follows. forward: the surface faces upwards, as the ray leaves the solid there.
    """
    number = lambda f, a: F.floor(f(*[F.col(f"{p}{a}") for p in "abc"]) / F.lit(pitch)).cast("int")
    dealt = triangles
    for a in "xz":
        dealt = dealt.withColumn(f"i{a}", F.explode(F.sequence(number(F.least, a), number(F.greatest, a))))
    met = columns_.select(key, "ix", "iz").join(dealt, [key, "ix", "iz"])
    px, pz = ((F.col(f"i{a}") + 0.5) * F.lit(pitch) for a in "xz")
    corner = lambda p: (F.col(f"{p}x"), F.col(f"{p}z"))
    whole = scalar.cross_2d(*corner("a"), *corner("b"), *corner("c"))
    inside = scalar.in_triangle(px, pz, (corner("a"), corner("b"), corner("c")))
    parts = [scalar.cross_2d(px, pz, *corner(q), *corner(r)) for q, r in (("b", "c"), ("c", "a"), ("a", "b"))]
    flat = F.when(F.abs(whole) > 1e-12, whole)
    y = sum((w / flat * F.col(f"{p}y") for w, p in zip(parts, "abc", strict=True)), F.lit(0.0))
    normal_y = -whole  # of (b - a) x (c - a); x and z are in the order of the floor plan
    found = met.where(inside & flat.isNotNull()).withColumn("y", y).where(F.col("y") >= base)
    first = found.groupBy(key, "ix", "iz").agg(F.min(F.struct("y", predicates.forward_hit((F.lit(0.0), normal_y, F.lit(0.0)), (0.0, 1.0, 0.0)).alias("forward"))).alias("h"))
    return first.select(key, "ix", "iz", F.col("h.y").alias("hit"), F.col("h.forward").alias("forward"))


def upward_hits_each(triangles: DataFrame, pitch: float, base: float, key: str = "mesh") -> DataFrame:
    """upward_hits of every column that a triangle of the mesh meets.

    A ray only hits where its column's centre is under a triangle, so no columns are made before:
    triangles are dealt to the tiles of TILE x TILE columns under their box, and each tile finds its hits.
    """
    names = [f"{p}{a}" for p in "abc" for a in "xyz"]
    number = lambda f, a: F.floor(f(*[F.col(f"{p}{a}") for p in "abc"]) / F.lit(pitch))
    tile = lambda f, a: F.floor(number(f, a) / TILE).cast("int")
    dealt = triangles.select(key, *names)
    for a in "xz":
        dealt = dealt.withColumn(f"t{a}", F.explode(F.sequence(tile(F.least, a), tile(F.greatest, a))))
    kind = triangles.schema[key].dataType.simpleString()

    def hits(table: pa.Table) -> pa.Table:
        of = table.column("tile").combine_chunks()
        (ax, ay, az), (bx, by, bz), (cx, cy, cz) = ([table.column(f"{p}{a}").to_numpy() for a in "xyz"] for p in "abc")
        own, low, high = codes_of(table.column("tile")).astype(np.int64), [], []
        for t, *v in (("tx", ax, bx, cx), ("tz", az, bz, cz)):
            first = of.field(t).to_numpy().astype(np.int64) * TILE
            low.append(np.maximum(first, np.floor(np.minimum.reduce(v) / pitch).astype(np.int64)))
            high.append(np.minimum(first + TILE - 1, np.floor(np.maximum.reduce(v) / pitch).astype(np.int64)))
        cross = lambda ox, oy, px, py, qx, qy: (px - ox) * (qy - oy) - (py - oy) * (qx - ox)
        whole = cross(ax, az, bx, bz, cx, cz)
        steep = np.flatnonzero(~(np.abs(whole) > 1e-12))
        size, depth = (high[0] - low[0] + 1) * (high[1] - low[1] + 1), high[1] - low[1] + 1
        size[steep] = 0
        ends, found, at = np.cumsum(size), [], 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
            t = np.repeat(np.arange(at, to), size[at:to])
            place = np.arange(len(t)) - np.repeat(ends[at:to] - size[at:to] - (ends[at - 1] if at else 0), size[at:to])
            at = to
            ix, iz = low[0][t] + place // depth[t], low[1][t] + place % depth[t]
            px, pz = (ix + 0.5) * pitch, (iz + 0.5) * pitch
            one, two, three = cross(px, pz, bx[t], bz[t], cx[t], cz[t]), cross(px, pz, cx[t], cz[t], ax[t], az[t]), cross(px, pz, ax[t], az[t], bx[t], bz[t])
            y = one / whole[t] * ay[t] + two / whole[t] * by[t] + three / whole[t] * cy[t]
            sides = np.stack([one, two, three])
            keep = np.flatnonzero(~((sides < -1e-12).any(0) & (sides > 1e-12).any(0)) & (y >= base))  # as scalar.in_triangle
            t, ix, iz, y = t[keep], ix[keep], iz[keep], y[keep]
            found.append((t, ix, iz, y))
        t, ix, iz, y = (np.concatenate(x) for x in zip(*found, strict=True))
        forward = -whole[t] > 0
        column = (own[t] * TILE + ix % TILE) * TILE + iz % TILE
        order = np.lexsort((forward, y, column))
        first = order[np.r_[True, column[order][1:] != column[order][:-1]]] if len(order) else order
        t, ix, iz, y, forward = t[first], ix[first], iz[first], y[first], forward[first]
        return pa.table([of.field(key).take(pa.array(t)), pa.array(ix, pa.int32()), pa.array(iz, pa.int32()), pa.array(y), pa.array(forward)], names=[key, "ix", "iz", "hit", "forward"])

    rows = dealt.select(F.struct(key, "tx", "tz").alias("tile"), *names)
    return map_groups(rows, "tile", hits, f"`{key}` {kind}, ix int, iz int, hit double, forward boolean", rows_at_once=20_000)


def filled_columns(hits: DataFrame, pitch: float, base_layer: int, key: str = "mesh") -> DataFrame:
    """Cells from the base layer up to each forward hit; hits name a column once, so no cell comes twice."""
    up = hits.where("forward").select(key, "ix", "iz", F.floor(F.col("hit") / F.lit(pitch)).cast("int").alias("top")).where(F.col("top") >= base_layer)
    return up.select(key, "ix", F.explode(F.sequence(F.lit(base_layer), F.col("top"))).alias("iy"), "iz")


def surface(voxels: DataFrame, pitch: float = 1.0, origin: tuple[float, float, float] = (0.0, 0.0, 0.0), key: str = "mesh") -> DataFrame:
    """key, side, corners of the outer faces of the cells, scaled and moved.

    A closed blocky surface; smooth iso-surfaces are outside what is built here.
    """
    sides = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(s).alias("step")) for a in range(3) for s in (-1, 1)]))
    around = voxels.withColumn("s", sides).select(key, "ix", "iy", "iz", "s.axis", "s.step", *[(F.col(f"i{a}") + F.when(F.col("s.axis") == k, F.col("s.step")).otherwise(0)).alias(f"n{a}") for k, a in enumerate("xyz")])
    other = voxels.select(key, *[F.col(f"i{a}").alias(f"n{a}") for a in "xyz"])
    outer = join_made(around, other, [key, "nx", "ny", "nz"], "left_anti")
    return _with_corners(outer, pitch, origin, key)


def _with_corners(outer: DataFrame, pitch: float, origin: tuple[float, float, float], key: str) -> DataFrame:
    ring = ((0, 0), (1, 0), (1, 1), (0, 1))
    corner = lambda u, v: F.struct(*[((F.col(f"i{a}") + F.when(F.col("axis") == k, F.when(F.col("step") > 0, 1).otherwise(0)).when(F.col("axis") == (k + 2) % 3, u).otherwise(v)) * F.lit(pitch) + F.lit(origin[k])).alias(a) for k, a in enumerate("xyz")])
    return outer.select(key, "axis", "step", F.array(*[corner(u, v) for u, v in ring]).alias("corners"))


def surface_of_triangles(triangles: DataFrame, pitch: float = 1.0, origin: tuple[float, float, float] = (0.0, 0.0, 0.0), key: str = "mesh", triangles_at_once: int = 5_000, cells_at_once: int = 4_000_000) -> DataFrame:
    """surface of the cells of from_triangles, without rows for the cells.

    Triangles are dealt to the tiles of TILE x TILE x TILE cells under their box and one cell more, so
    a tile knows the cells next to its own and gives the faces of its own alone. A task reads its
    tiles one after the other, about triangles_at_once triangles and grids of about cells_at_once cells
    at a time; of a tile that goes on it only holds the cells, so a tile may have any number of triangles.
    """
    tiles = [f"t{a}" for a in "xyz"]
    tile = lambda f, a, by: F.floor((F.floor(f(*[F.col(f"{p}{a}") for p in "abc"]) / F.lit(pitch)) + F.lit(by + TILE // 2)) / TILE).cast("int")
    dealt = _placed(triangles).select(key, *_CORNERS)
    for a in "xyz":
        dealt = dealt.withColumn(f"t{a}", F.explode(F.sequence(tile(F.least, a, -1), tile(F.greatest, a, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last tile read, which may go on, and its cells
        for table in _in_bulk(batches, triangles_at_once):
            keys, number = table.column(key).combine_chunks(), np.column_stack([table.column(n).to_numpy() for n in tiles]).astype(np.int64)
            codes = np.column_stack([codes_of(table.column(key)), number])
            first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(1)])
            own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
            keys, number = keys.take(pa.array(first)), number[first]
            more = np.empty((0, 3), np.int64)
            if held is not None:
                if held[0].equals(keys.slice(0, 1)) and (held[1] == number[:1]).all():
                    more = held[2]
                else:
                    yield from _faces_of_cells(*held, key)
            t = _corners_of(table, pitch)
            low, size = _boxes(t)
            start = number[own] * TILE - TILE // 2
            high = np.minimum(low + size - 1, start + TILE)
            low = np.maximum(low, start - 1)
            least, greatest = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            least[0], greatest[0] = np.minimum(least[0], more.min(0, initial=2**40)), np.maximum(greatest[0], more.max(0, initial=-(2**40)))
            ends, at, first = np.cumsum((greatest - least + 3).prod(1)), 0, np.r_[first, len(own)]
            while at < len(keys):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + cells_at_once, "right")))
                grids, some = _Grids(least[at:to], greatest[at:to]), slice(first[at], first[to])
                if at == 0:
                    grids.add(np.zeros(len(more), np.int64), more)
                for met in _met(t[some], low[some], high[some] - low[some] + 1, grids.number(own[some] - at, low[some]), grids.strides[own[some] - at]):
                    grids.held[met] = True
                whole = to - at - (to == len(keys))
                yield from _faces(grids, whole, keys.slice(at, to - at), number[at:to], key)
                at = to
            held = keys.slice(len(keys) - 1), number[-1:], grids.cells(whole, whole + 1)[2]
        if held is not None:
            yield from _faces_of_cells(*held, key)

    kind = triangles.schema[key].dataType.simpleString()
    # few triangles make many faces: a given number of parts is not joined into one task
    spark = triangles.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    outer = dealt.repartition(parts, key, *tiles).sortWithinPartitions(key, *tiles).mapInArrow(run, f"`{key}` {kind}, ix int, iy int, iz int, axis int not null, step int not null")
    return _with_corners(outer, pitch, origin, key)


class _Grids:
    """Which cells of some tiles are held: a dense grid for each tile over its cells from low to high and one more around."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.size = low - 1, high - low + 3
        self.strides = np.column_stack([self.size[:, 1] * self.size[:, 2], self.size[:, 2], np.ones(len(low), np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(self.size.prod(1))])
        self.held = np.zeros(self.starts[-1], bool)

    def number(self, tile: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return self.starts[tile] + ((cells - self.low[tile]) * self.strides[tile]).sum(1)

    def add(self, tile: np.ndarray, cells: np.ndarray) -> None:
        self.held[self.number(tile, cells)] = True

    def cells(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers, tiles and places of the cells held in the tiles from first to before end."""
        number = np.flatnonzero(self.held[self.starts[first] : self.starts[end]]) + self.starts[first]
        tile = np.repeat(np.arange(first, end), np.diff(np.searchsorted(number, self.starts[first : end + 1])))
        x, rest = np.divmod(number - self.starts[tile], self.strides[tile, 0])
        return number, tile, np.column_stack([x, *np.divmod(rest, self.strides[tile, 1])]) + self.low[tile]


def _faces(grids: _Grids, tiles: int, keys: pa.Array, number: np.ndarray, key: str) -> Iterator[pa.RecordBatch]:
    """Outer faces of the own cells of the first tiles."""
    at, tile, cells = grids.cells(0, tiles)
    start = (number * TILE - TILE // 2)[tile]
    own = np.flatnonzero(((cells >= start) & (cells < start + TILE)).all(1))
    at, tile, cells = at[own], tile[own], np.ascontiguousarray(cells[own].T)
    for axis in range(3):
        by = grids.strides[tile, axis]
        for step in (-1, 1):
            outer = np.flatnonzero(~grids.held[at + step * by])
            for k in range(0, len(outer), FACES):
                some = outer[k : k + FACES]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(tile[some])), *(pa.array(c[some], pa.int32()) for c in cells), *(pa.array(np.full(len(some), c, np.int32)) for c in (axis, step))], [key, "ix", "iy", "iz", "axis", "step"])


def _faces_of_cells(keys: pa.Array, number: np.ndarray, cells: np.ndarray, key: str) -> Iterator[pa.RecordBatch]:
    """Outer faces of one tile's own cells."""
    if len(cells):
        grids = _Grids(cells.min(0)[None], cells.max(0)[None])
        grids.add(np.zeros(len(cells), np.int64), cells)
        yield from _faces(grids, 1, keys, number, key)


def _in_bulk(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least so many rows, but for the last."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def grid_points(spark, low: tuple[float, float, float], high: tuple[float, float, float], n: int, padding: float = 0.0) -> DataFrame:
    """pid, ix, iy, iz, x, y, z of an even n x n x n grid over a box widened by padding times its diagonal."""
    diagonal = sum((b - a) ** 2 for a, b in zip(low, high, strict=True)) ** 0.5
    low, high = [a - padding * diagonal for a in low], [b + padding * diagonal for b in high]
    cell = spark.range(n**3).select(F.col("id").alias("pid"), (F.col("id") % n).cast("int").alias("ix"), (F.floor(F.col("id") / n) % n).cast("int").alias("iy"), F.floor(F.col("id") / n**2).cast("int").alias("iz"))
    step = [(b - a) / max(1, n - 1) for a, b in zip(low, high, strict=True)]
    return cell.select("*", *[(F.lit(low[k]) + F.col(f"i{a}") * F.lit(step[k])).alias(a) for k, a in enumerate("xyz")])
