"""Point clouds: turning, normalising, cropping, joining, sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from .grouping import starts_of, whole_groups

ANGLES = (0.0, 90.0, 180.0, 270.0)
LEAST_POINTS = 10


def doubles(points: DataFrame) -> DataFrame:
    return points.select(*[F.col(c).cast("double").alias(c) if c in ("x", "y", "z") else F.col(c) for c in points.columns])


def finite(points: DataFrame) -> DataFrame:
    """Points all of whose coordinates are finite."""
    return points.where(scalar.is_finite(F.col("x")) & scalar.is_finite(F.col("y")) & scalar.is_finite(F.col("z")))


def rotations(points: DataFrame, angles: tuple[float, ...] = ANGLES) -> DataFrame:
    """Each point at each angle about the y axis; angle is a column."""
    angled = points.withColumn("angle", F.explode(F.array(*map(F.lit, angles))))
    x, z = scalar.rotate_y(F.col("x"), F.col("z"), F.col("angle"))
    others = [c for c in points.columns if c not in ("x", "z")]
    return angled.select(*others, "angle", x.alias("x"), z.alias("z"))


def crop(points: DataFrame, chunks: DataFrame, limit: float = 1.5, least: int = LEAST_POINTS, cell: float = 1.0) -> DataFrame:
    """chunk, pid, x, y, z: points within +-limit of a chunk's cube scaled to -1 .. 1, of chunks with more than `least` points.

    chunks: chunk, px, py, pz, size. Both sides are cut into x and z cells of size `cell` and meet
    by an equi-join; chunks are repeated for the cells that they reach, points are not repeated.
    """
    reach = F.col("size") * F.lit(limit / 2)
    number = lambda v: F.floor(v / F.lit(cell)).cast("long")
    near = chunks.withColumn("cell_x", F.explode(F.sequence(number(F.col("px") - reach) - 1, number(F.col("px") + reach) + 1))).withColumn("cell_z", F.explode(F.sequence(number(F.col("pz") - reach) - 1, number(F.col("pz") + reach) + 1)))
    both = points.withColumn("cell_x", number(F.col("x"))).withColumn("cell_z", number(F.col("z"))).join(near, ["cell_x", "cell_z"])
    moved = both.where("size > 0").select("chunk", "pid", *[scalar.to_cube(F.col(a), F.col(f"p{a}"), F.col("size")).alias(a) for a in ("x", "y", "z")])
    inside = moved.where(" AND ".join(f"{a} BETWEEN {-limit!r}D AND {limit!r}D" for a in ("x", "y", "z")))
    enough = inside.groupBy("chunk").agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    return inside.join(enough, "chunk").drop("_n")


def union_all(*clouds: DataFrame) -> DataFrame:
    found = clouds[0]
    for more in clouds[1:]:
        found = found.unionByName(more)
    return found


def resolve_points(containers: DataFrame) -> DataFrame:
    """cloud and points of maps that hold the points under one of several names."""
    return containers.select("cloud", F.coalesce(*[F.try_element_at("content", F.lit(k)) for k in ("points", "xyz", "pos")]).alias("points"))


def farthest_points(points: DataFrame, k: int, key: str = "cloud", group_limit: int = 2_000_000) -> DataFrame:
    """key, pid, rank, x, y, z: k points of each cloud, each farthest from those before it.

    The first is the point with the smallest pid; equal distances go to the smaller pid. The
    selection is sequential within a cloud, so each cloud is one group; a cloud of more than
    group_limit points is an error rather than an overloaded task.
    """
    schema = points.select(key).schema.simpleString()[7:-1] + ", pid long, rank int, x double, y double, z double"

    def pick(table: pa.Table) -> pa.Table:
        if table.num_rows > group_limit:
            raise ValueError(f"a cloud has {table.num_rows} points; the limit is {group_limit}")
        table = table.sort_by([("pid", "ascending"), ("x", "ascending"), ("y", "ascending"), ("z", "ascending")])
        xyz = np.column_stack([table.column(a).to_numpy() for a in ("x", "y", "z")]).astype(float)
        chosen, far = [0], ((xyz - xyz[0]) ** 2).sum(1)
        far[0] = -1
        while len(chosen) < min(k, len(xyz)):
            nxt = int(far.argmax())
            chosen.append(nxt)
            far = np.minimum(far, ((xyz - xyz[nxt]) ** 2).sum(1))
            far[nxt] = -1
        taken = table.take(pa.array(chosen))
        return pa.Table.from_arrays([taken.column(key), taken.column("pid").cast(pa.int64()), pa.array(range(1, len(chosen) + 1), pa.int32()), *(pa.array(xyz[chosen, a]) for a in range(3))], [key, "pid", "rank", "x", "y", "z"])

    return points.select(key, "pid", "x", "y", "z").groupBy(key).applyInArrow(pick, schema)


def surface_sample(triangles: DataFrame, n: int, seed: int = 1, key: str = "mesh") -> DataFrame:
    """key, pid, x, y, z, nx, ny, nz: n points of each mesh, spread evenly over its area.

    triangles: key, fid and the corners ax .. cz. Sample t of n belongs to the triangle that
    holds (t + u) / n of the mesh's area, u and the place in the triangle being hashes of
    (seed, mesh, t), so that the sample is the same on every run. Each triangle makes its own
    samples from its part of the running area, so nothing but the running sum is shuffled.
    """
    u, v = ([F.col(f"{p}{a}") - F.col(f"a{a}") for a in "xyz"] for p in "bc")
    normal = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    sized = triangles.withColumn("_area", scalar.distance(*normal) / 2).where("_area > 0")
    order = Window.partitionBy(key).orderBy("fid")
    run = sized.withColumn("_to", F.sum("_area").over(order)).withColumn("_all", F.sum("_area").over(Window.partitionBy(key)))
    first = F.ceil((F.col("_to") - F.col("_area")) / F.col("_all") * n - 0.5).cast("long")
    last = F.least(F.ceil(F.col("_to") / F.col("_all") * n - 0.5).cast("long") - 1, F.lit(n - 1).cast("long"))
    placed = run.withColumn("_first", F.greatest(first, F.lit(0).cast("long"))).withColumn("_last", last).where("_first <= _last").withColumn("pid", F.explode(F.sequence("_first", "_last")))
    draw = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), key, "pid"), F.lit(1 << 40)) / float(1 << 40)
    placed = placed.withColumn("_r", F.sqrt(draw(1))).withColumn("_s", draw(2))
    point = [(F.col(f"a{a}") * (1 - F.col("_r")) + F.col(f"b{a}") * (F.col("_r") * (1 - F.col("_s"))) + F.col(f"c{a}") * (F.col("_r") * F.col("_s"))).alias(a) for a in "xyz"]
    return placed.select(key, "pid", *point, *[(c / (F.col("_area") * 2)).alias(f"n{a}") for a, c in zip("xyz", normal, strict=True)])


def jitter(points: DataFrame, sigmas: tuple[float, ...], seed: int = 1) -> DataFrame:
    """Each point once for each sigma, moved by normal noise that is a hash of (seed, pid, sigma, axis)."""
    spread = points.withColumn("sigma", F.explode(F.array(*map(F.lit, sigmas))))
    draw = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "pid", "sigma"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    noise = lambda k: F.sqrt(-2 * F.log(draw(2 * k))) * F.cos(2 * np.pi * draw(2 * k + 1)) * F.col("sigma")
    others = [c for c in points.columns if c not in ("x", "y", "z")]
    return spread.select(*others, "sigma", *[(F.col(a) + noise(k)).alias(a) for k, a in enumerate("xyz")])


def space_points(spark, n: int, half: float = 1.05, seed: int = 1) -> DataFrame:
    """pid, x, y, z: n points spread evenly in a cube of +-half."""
    draw = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(1 << 40)) / float(1 << 40) * 2 - 1) * half
    return spark.range(n).select(F.col("id").alias("pid"), *[draw(k).alias(a) for k, a in enumerate("xyz")])


def signed_distance(points: DataFrame, triangles: DataFrame, most_triangles: int = 200_000) -> DataFrame:
    """points with sdf: the distance to a closed mesh, negative inside.

    One mesh is broadcast, after a check that it has at most most_triangles triangles; points
    stay where they are. Larger meshes have to be cut into tiles first.
    """
    rows = triangles.select(*_CORNERS).limit(most_triangles + 1).toArrow()
    if rows.num_rows > most_triangles:
        raise ValueError(f"a mesh of more than {most_triangles} triangles is too large to broadcast")
    mesh = points.sparkSession.sparkContext.broadcast(_corners_of(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meshes = Meshes(mesh.value, np.array([0, len(mesh.value)]))
        for batch in batches:
            found = meshes.distances(0, _places_of(batch)) if len(mesh.value) else np.full(batch.num_rows, np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "sdf"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInArrow(run, f"{fields}, sdf double")


def signed_distance_each(points: DataFrame, triangles: DataFrame, key: str = "mesh", most_points: int = 200_000, most_triangles: int = 200_000, rows_at_once: int = 32_768) -> DataFrame:
    """key and points with sdf: the distance of every point to every closed mesh, negative inside.

    The points are broadcast, after a check that there are at most most_points; a mesh has at most
    most_triangles triangles or raises an error. Triangles are dealt to a given number of parts, as
    few of them make many rows; a task reads its meshes one after the other, prepares about 20,000
    triangles at a time and gives batches of whole meshes with about rows_at_once rows.
    """
    rows = points.limit(most_points + 1).toArrow().combine_chunks()
    if rows.num_rows > most_points:
        raise ValueError(f"more than {most_points} points are too many to broadcast")
    shared = points.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        xyz, n = _places_of(own), own.num_rows
        at_once = max(1, rows_at_once // n) if n else 1
        copies = pa.concat_tables([own] * at_once).combine_chunks()
        for table in whole_groups(batches, key, 20_000, most_triangles):
            starts = starts_of(table.column(key))
            if np.diff(starts).max() > most_triangles:
                raise ValueError(f"a mesh of more than {most_triangles} triangles is too large for a group")
            meshes, keys = Meshes(_corners_of(table), starts), table.column(key).combine_chunks().take(pa.array(starts[:-1]))
            for at in range(0, len(keys), at_once):
                some = range(at, min(at + at_once, len(keys)))
                of = keys.take(pa.array(np.repeat(np.arange(some.start, some.stop), n)))
                found = np.concatenate([meshes.distances(m, xyz) for m in some])
                yield from pa.Table.from_arrays([of, *copies.slice(0, len(found)).columns, pa.array(found)], [key, *own.column_names, "sdf"]).to_batches()

    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    parts = triangles.select(key, *_CORNERS).repartition(4 * points.sparkSession.sparkContext.defaultParallelism, key)
    return parts.sortWithinPartitions(key).mapInArrow(run, f"`{key}` {triangles.schema[key].dataType.simpleString()}{fields}, sdf double")


_CORNERS = [f"{p}{a}" for p in "abc" for a in "xyz"]


def _corners_of(rows: pa.Table) -> np.ndarray:
    return np.column_stack([rows.column(c).to_numpy() for c in _CORNERS]).astype(float).reshape(-1, 3, 3)


def _places_of(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """x, y and z as three rows."""
    return np.vstack([rows.column(a).to_numpy(zero_copy_only=False) for a in "xyz"]).astype(float)


def signed_distances(points: np.ndarray, triangles: np.ndarray) -> np.ndarray:
    """Distance of each point to the nearest triangle; the sign by the solid angle the mesh fills."""
    return Meshes(triangles, np.array([0, len(triangles)])).distances(0, points.T) if len(triangles) else np.full(len(points), np.inf)


class Meshes:
    """Triangles of whole meshes, prepared for distances.

    A mesh's nearest place lies on an edge or inside a face. Each edge, taken once, gives three
    linear functions of a point, along it and across it, and each face four, its height and the
    sides of its edges, so all of them are matrix products in coordinates about the mesh's middle.
    Where every edge is used as often in one direction as in the other, the solid angle is exactly
    0 outside the box of the mesh, and only points in the box are told by their sum of angles.
    """

    def __init__(self, triangles: np.ndarray, starts: np.ndarray):
        """triangles: (n, 3 corners, 3 axes), mesh after mesh; starts: where each mesh starts, and n."""
        count, mesh = len(starts) - 1, np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        low, high = np.minimum.reduceat(triangles.min(1), starts[:-1]), np.maximum.reduceat(triangles.max(1), starts[:-1])
        self.starts, self.middle = starts, low + (high - low) / 2
        self.corners = triangles - self.middle[mesh][:, None]
        self.reach = np.maximum(high - self.middle, self.middle - low) * (1 + 1e-9)
        # corners at the same place have one number, and an edge is a pair of them
        flat, of = triangles.reshape(-1, 3) + 0.0, np.repeat(mesh, 3)
        order = np.lexsort((*flat.T, of))
        new = (flat[order][1:] != flat[order][:-1]).any(1) | (of[order][1:] != of[order][:-1])
        number = np.empty(len(flat), np.int64)
        number[order] = np.concatenate([[0], np.cumsum(new)])
        begin, end = number, number.reshape(-1, 3)[:, [1, 2, 0]].ravel()
        _, first, which = np.unique(np.minimum(begin, end) * len(flat) + np.maximum(begin, end), return_index=True, return_inverse=True)
        one_way = np.bincount(which, np.sign(end - begin)) != 0
        self.closed = np.bincount(of[first][one_way], minlength=count) == 0
        self.edge_starts = np.searchsorted(of[first], np.arange(count + 1))
        a, b = self.corners.reshape(-1, 3)[first], self.corners[:, [1, 2, 0]].reshape(-1, 3)[first]
        self.lengths = np.linalg.norm(b - a, axis=1)
        along = np.where(self.lengths[:, None] > 0, b - a, [1.0, 0.0, 0.0]) / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        across = np.cross(along, np.eye(3)[np.abs(along).argmin(1)])
        across /= np.linalg.norm(across, axis=1)[:, None]
        self.edges = _linear([along, across, np.cross(along, across)], [a, a, a])
        a, b, c = (self.corners[:, k] for k in range(3))
        normal = np.cross(b - a, c - a)
        area = np.linalg.norm(normal, axis=1)
        wide = ~(area <= 0)
        a, b, c, normal = a[wide], b[wide], c[wide], normal[wide] / area[wide][:, None]
        self.face_starts = np.searchsorted(mesh[wide], np.arange(count + 1))
        self.faces = _linear([np.cross(normal, b - a), np.cross(normal, c - b), np.cross(normal, a - c), normal], [a, b, c, a])

    def distances(self, m: int, xyz: np.ndarray, block: int = 1024, rows: int = 32) -> np.ndarray:
        """The distance of each point (xyz: three rows) to mesh m, negative inside."""
        places = np.ones((4, xyz.shape[1]))
        np.subtract(xyz, self.middle[m][:, None], out=places[:3])
        out = np.full(places.shape[1], np.inf)
        held = np.empty((5, rows, min(block, len(out))))
        for at in range(0, len(out), block):
            place, best = places[:, at : at + block], out[at : at + block]
            for k in range(self.edge_starts[m], self.edge_starts[m + 1], rows):
                to = min(k + rows, self.edge_starts[m + 1])
                d, on = held[:3, : to - k, : len(best)], held[3, : to - k, : len(best)]
                np.matmul(self.edges[:, k:to], place, out=d)
                np.maximum(d[0], 0, out=on)
                np.minimum(on, self.lengths[k:to, None], out=on)
                d[0] -= on
                np.square(d, out=d)
                d[0] += d[1]
                d[0] += d[2]
                np.minimum(best, d[0].min(0), out=best)
            for k in range(self.face_starts[m], self.face_starts[m + 1], rows):
                to = min(k + rows, self.face_starts[m + 1])
                d, far = held[:4, : to - k, : len(best)], held[4, : to - k, : len(best)]
                np.matmul(self.faces[:, k:to], place, out=d)
                np.minimum(d[0], d[1], out=far)
                np.minimum(far, d[2], out=far)
                np.square(d[3], out=d[3])
                np.minimum(best, np.where(far < 0, np.inf, d[3]).min(0), out=best)
        np.sqrt(out, out=out)
        some = np.flatnonzero((np.abs(places[:3]) <= self.reach[m][:, None]).all(0)) if self.closed[m] else np.arange(len(out))
        for at in range(0, len(some), block):
            own = some[at : at + block]
            out[own[np.abs(self._winding(m, places[:3, own])) > 0.5]] *= -1
        return out

    def _winding(self, m: int, place: np.ndarray, rows: int = 32) -> np.ndarray:
        """The share of the full solid angle that mesh m fills, seen from each place."""
        total = np.zeros(place.shape[1])
        for at in range(self.starts[m], self.starts[m + 1], rows):
            ray = self.corners[at : min(at + rows, self.starts[m + 1])].transpose(2, 1, 0)[..., None] - place[:, None, None]
            (ax, bx, cx), (ay, by, cy), (az, bz, cz) = ray
            la, lb, lc = np.sqrt(np.einsum("xcij,xcij->cij", ray, ray))
            ab, bc, ca = np.einsum("xcij,xcij->cij", ray, ray[:, [1, 2, 0]])
            top = ax * (by * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by * cx)
            total += np.arctan2(top, la * lb * lc + ab * lc + bc * la + ca * lb).sum(0)
        return total / (2 * np.pi)


def _linear(directions: list[np.ndarray], origins: list[np.ndarray]) -> np.ndarray:
    """(len(directions), n, 4): the functions direction . (p - origin) as rows for (x, y, z, 1)."""
    return np.stack([np.column_stack([d, -(d * o).sum(1)]) for d, o in zip(directions, origins, strict=True)])


def random_subset(rows: DataFrame, n: int, key: list[str], seed: int = 1) -> DataFrame:
    """n rows without replacement: those with the smallest hash of (seed, key)."""
    return rows.withColumn("_draw", F.xxhash64(F.lit(seed), *key)).orderBy("_draw", *key).limit(n).drop("_draw")
