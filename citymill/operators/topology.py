"""Edges, components, outlines and defects of meshes. faces: mesh, fid, idx (vertex ids)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates, scalar
from .grouping import codes_of, groups_of, join_made, map_groups


def triangles(faces: DataFrame) -> DataFrame:
    """mesh, fid, part, idx: faces as fans of triangles."""
    fans = F.transform(F.sequence(F.lit(2), F.size("idx") - 1), lambda i: F.array(F.col("idx")[0], F.get("idx", i - 1), F.get("idx", i)))
    return faces.where(F.size("idx") >= 3).select("mesh", "fid", F.posexplode(fans).alias("part", "idx"))


def face_edges(faces: DataFrame) -> DataFrame:
    """mesh, fid, u, v: undirected edges of each face, u <= v."""
    ends = F.transform("idx", lambda a, i: F.struct(F.least(a, F.get("idx", (i + 1) % F.size("idx"))).alias("u"), F.greatest(a, F.get("idx", (i + 1) % F.size("idx"))).alias("v")))
    return faces.select("mesh", "fid", F.explode(ends).alias("e")).select("mesh", "fid", "e.u", "e.v")


def edge_uses(faces: DataFrame) -> DataFrame:
    """mesh, u, v, n: how many faces use an edge."""
    return face_edges(faces).groupBy("mesh", "u", "v").agg(F.count("*").alias("n"))


def watertight(faces: DataFrame) -> DataFrame:
    """mesh, edges, watertight: whether every edge is used by exactly two faces."""
    return edge_uses(faces).groupBy("mesh").agg(F.count("*").alias("edges"), F.bool_and(F.col("n") == 2).alias("watertight"))


def loose(vertices: DataFrame, lines: DataFrame, faces: DataFrame) -> DataFrame:
    """mesh, loose_points, loose_lines, has_loose: vertices of no line or face, lines that are no edge of a face.

    vertices: mesh, vid; lines: mesh, u, v.
    """
    edges = face_edges(faces).select("mesh", "u", "v").distinct()
    ends = lines.select("mesh", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    used = ends.select("mesh", F.explode(F.array("u", "v")).alias("vid")).union(faces.select("mesh", F.explode("idx").alias("vid"))).distinct()
    points = join_made(vertices.select("mesh", "vid").distinct(), used, ["mesh", "vid"], "left_anti").groupBy("mesh").agg(F.count("*").alias("loose_points"))
    wires = join_made(ends, edges, ["mesh", "u", "v"], "left_anti").groupBy("mesh").agg(F.count("*").alias("loose_lines"))
    meshes = vertices.select("mesh").distinct()
    found = join_made(join_made(meshes, points, "mesh", "left"), wires, "mesh", "left").na.fill(0, ["loose_points", "loose_lines"])
    return found.withColumn("has_loose", (F.col("loose_points") > 0) | (F.col("loose_lines") > 0))


def weld(vertices: DataFrame, digits: int = 6) -> DataFrame:
    """mesh, vid, welded: the smallest vid among vertices of a mesh at the same rounded place."""
    place = ["mesh", *[F.round(a, digits).alias(f"_{a}") for a in "xyz"]]
    keyed = vertices.select("vid", *place)
    same = Window.partitionBy("mesh", "_x", "_y", "_z")
    return keyed.select("mesh", "vid", F.min("vid").over(same).alias("welded"))


def components(faces: DataFrame) -> DataFrame:
    """mesh, vid, component: vertices linked by faces, named by their smallest vid.

    Meshes are independent; union-find runs over the edges of many meshes at once.
    """
    ends = face_edges(faces).select("mesh", F.col("u").cast("long"), F.col("v").cast("long"))
    kind = faces.select("mesh").schema.simpleString()[7:-1]

    def join(table: pa.Table) -> pa.Table:
        u, v, mesh = table.column("u").to_numpy(), table.column("v").to_numpy(), codes_of(table.column("mesh"))
        ids, first, at = np.unique(np.column_stack([np.r_[mesh, mesh], np.r_[u, v]]), axis=0, return_index=True, return_inverse=True)
        at = at.ravel()
        a, b, label = at[: len(u)], at[len(u) :], np.arange(len(ids))
        while True:
            least = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, least)
            np.minimum.at(new, b, least)
            new = new[new]
            if (new == label).all():
                break
            label = new
        own = table.column("mesh").combine_chunks().take(pa.array(first % len(u)))
        return pa.table({"mesh": own, "vid": pa.array(ids[:, 1]), "component": pa.array(ids[label, 1])})

    return map_groups(ends, "mesh", join, f"{kind}, vid long, component long")


def bottom_edges(vertices: DataFrame, faces: DataFrame, eps: float = predicates.EPS) -> DataFrame:
    """mesh, u, v: outline of the bottom: edges that one triangle of the bottom uses.

    Bottom triangles have a corner within eps of the mesh's lowest level and an area above eps
    as seen from above. vertices: mesh, vid, x, y, z.
    """
    low = vertices.groupBy("mesh").agg(F.min("y").alias("low"))
    placed = join_made(vertices, low, "mesh").select("mesh", "vid", "x", "z", predicates.near_bottom(F.col("y"), F.col("low"), eps).alias("bottom"))
    corners = join_made(triangles(faces).select("mesh", "fid", "part", F.posexplode("idx").alias("k", "vid")), placed, ["mesh", "vid"])
    flat = corners.groupBy("mesh", "fid", "part").agg(F.bool_or("bottom").alias("bottom"), F.sort_array(F.collect_list(F.struct("k", "x", "z", "vid"))).alias("c")).where("bottom")
    area = scalar.cross_2d(F.col("c")[0]["x"], F.col("c")[0]["z"], F.col("c")[1]["x"], F.col("c")[1]["z"], F.col("c")[2]["x"], F.col("c")[2]["z"])
    kept = flat.where(F.abs(area) / 2 > eps).select("mesh", F.concat_ws("_", "fid", "part").alias("fid"), F.transform("c", lambda s: s["vid"]).alias("idx"))
    return edge_uses(kept).where("n = 1").select("mesh", "u", "v")


def footprints(vertices: DataFrame, faces: DataFrame, eps: float = predicates.EPS) -> DataFrame:
    """mesh, component, height, contour: the largest outline of each component's bottom, closed, and its height."""
    parts = components(faces)
    placed = join_made(vertices, parts, ["mesh", "vid"])
    named = placed.select(F.struct("mesh", "component").alias("mesh"), "vid", "x", "y", "z")
    owner = parts.select("mesh", "vid", "component")
    own_faces = join_made(faces.withColumn("vid", F.col("idx")[0]), owner, ["mesh", "vid"]).select(F.struct("mesh", "component").alias("mesh"), "fid", "idx")
    edges = bottom_edges(named, own_faces, eps)
    height = named.groupBy("mesh").agg((F.max("y") - F.min("y")).alias("height"))
    at = lambda end: named.select("mesh", F.col("vid").alias(end), F.struct("x", "y", "z").alias(f"p{end}"))
    rows = join_made(join_made(join_made(edges, at("u"), ["mesh", "u"]), at("v"), ["mesh", "v"]), height, "mesh")
    kind = vertices.select("mesh").schema["mesh"].dataType.simpleString()
    point = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])

    def walk(rows: list[dict]) -> dict:
        place, after = {}, {}
        for r in rows:
            place[r["u"]], place[r["v"]] = r["pu"], r["pv"]
            after.setdefault(r["u"], []).append(r["v"])
            after.setdefault(r["v"], []).append(r["u"])
        rings, left = [], {frozenset((r["u"], r["v"])) for r in rows}
        while left:
            start = min(min(e) for e in left)
            ring, at_ = [start], start
            while nxt := sorted(v for v in after[at_] if frozenset((at_, v)) in left):
                left.discard(frozenset((at_, nxt[0])))
                at_ = nxt[0]
                ring.append(at_)
                if at_ == start:
                    break
            rings.append([place[v] for v in ring])
        area = lambda ring: abs(sum(p["x"] * q["z"] - q["x"] * p["z"] for p, q in zip(ring, ring[1:], strict=False)))
        return {**rows[0]["mesh"], "height": rows[0]["height"], "contour": max(rings, key=area)}

    def walks(table: pa.Table) -> pa.Table:
        own = table.schema.field("mesh").type.field("mesh").type
        found = [walk(part.to_pylist()) for part in groups_of(table, "mesh")]
        return pa.Table.from_pylist(found, schema=pa.schema([("mesh", own), ("component", pa.int64()), ("height", pa.float64()), ("contour", pa.list_(point))]))

    return map_groups(rows, "mesh", walks, f"mesh {kind}, component long, height double, contour array<struct<x:double,y:double,z:double>>")


def sharp_edges(vertices: DataFrame, faces: DataFrame, degrees: float = 15.0) -> DataFrame:
    """mesh, u, v, angle and the mean normal of edges between two triangles whose normals differ by more than degrees.

    Edges of one triangle only have no angle and are left out.
    """
    at = lambda k, p: vertices.select("mesh", F.col("vid").alias(f"v{k}"), *[F.col(a).alias(f"{p}{a}") for a in "xyz"])
    placed = triangles(faces).select("mesh", F.concat_ws("_", "fid", "part").alias("fid"), "idx", *[F.col("idx")[k].alias(f"v{k}") for k in range(3)])
    for k, p in enumerate("abc"):
        placed = join_made(placed, at(k, p), ["mesh", f"v{k}"])
    return sharp_edges_of(placed, degrees).select("mesh", "u", "v", "angle", "nx", "ny", "nz")


def sharp_edges_of(placed: DataFrame, degrees: float = 15.0) -> DataFrame:
    """sharp_edges of triangles with their corners (mesh, fid, idx, ax .. cz), with the edges' ends ux .. vz besides.

    Each edge takes its triangle's normal along, so edges are shuffled once and nothing is joined.
    """
    e, f = ([F.col(f"{p}{a}") - F.col(f"a{a}") for a in "xyz"] for p in "bc")
    normal = (e[1] * f[2] - e[2] * f[1], e[2] * f[0] - e[0] * f[2], e[0] * f[1] - e[1] * f[0])
    length = scalar.distance(*normal)
    with_normal = placed.select("*", *[F.when(length > 0, n / F.when(length > 0, length)).otherwise(0.0).alias(f"n{a}") for n, a in zip(normal, "xyz", strict=True)])
    corner = lambda p: F.struct(*[F.col(f"{p}{a}").alias(a) for a in "xyz"])
    ends = [F.struct(F.least(F.col("idx")[i], F.col("idx")[k]).alias("u"), F.greatest(F.col("idx")[i], F.col("idx")[k]).alias("v"), F.when(F.col("idx")[i] <= F.col("idx")[k], corner(p)).otherwise(corner(q)).alias("pu"), F.when(F.col("idx")[i] <= F.col("idx")[k], corner(q)).otherwise(corner(p)).alias("pv")) for i, k, p, q in ((0, 1, "a", "b"), (1, 2, "b", "c"), (2, 0, "c", "a"))]
    edges = with_normal.select("mesh", "fid", "nx", "ny", "nz", F.explode(F.array(*ends)).alias("e")).select("mesh", "fid", "nx", "ny", "nz", "e.*")
    pairs = edges.groupBy("mesh", "u", "v").agg(F.sort_array(F.collect_list(F.struct("fid", "nx", "ny", "nz"))).alias("s"), F.min("pu").alias("pu"), F.min("pv").alias("pv")).where(F.size("s") == 2)
    one, two = ([F.col("s")[k][f"n{a}"] for a in "xyz"] for k in (0, 1))
    mean = scalar.edge_normal(tuple(one), tuple(two))
    found = pairs.select("mesh", "u", "v", scalar.angle_between(tuple(one), tuple(two)).alias("angle"), *[m.alias(f"n{a}") for m, a in zip(mean, "xyz", strict=True)], *[F.col(f"p{p}.{a}").alias(f"{p}{a}") for p in "uv" for a in "xyz"])
    return found.where(F.col("angle") > degrees)


def edge_points(edges: DataFrame, m: int) -> DataFrame:
    """edges (with ends ax .. bz) with j, x, y, z: m points between the ends, at j / (m + 1)."""
    t = F.col("j") / F.lit(float(m + 1))
    ends = [f"{e}{a}" for e in "ab" for a in "xyz"]
    return edges.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(m)))).select(*[c for c in edges.columns if c not in ends], "j", *[(F.col(f"a{a}") * (1 - t) + F.col(f"b{a}") * t).alias(a) for a in "xyz"])


def sharp_samples(vertices: DataFrame, sharp: DataFrame, wanted: int, seed: int = 1) -> DataFrame:
    """mesh, x, y, z, nx, ny, nz: ends of sharp edges, then points between them, up to wanted of each mesh.

    All distinct ends come first. What is missing is spread over the edges: with more edges than
    missing points a subset by hash gets one point each, else each edge gets its share.
    """
    at = lambda end: vertices.select("mesh", F.col("vid").alias(end), *[F.col(a).alias(f"{end}{a}") for a in "xyz"])
    return samples_between(join_made(join_made(sharp, at("u"), ["mesh", "u"]), at("v"), ["mesh", "v"]), wanted, seed)


def samples_between(sharp: DataFrame, wanted: int, seed: int = 1) -> DataFrame:
    """sharp_samples of sharp edges with their ends (ux .. vz)."""
    normals = [f"n{a}" for a in "xyz"]
    placed = sharp.withColumnsRenamed({f"{end}{a}": f"{p}{a}" for end, p in (("u", "a"), ("v", "b")) for a in "xyz"})
    ends = placed.select("mesh", F.explode(F.array(*[F.struct(F.col(e).alias("vid"), *[F.col(f"{p}{a}").alias(a) for a in "xyz"], *normals) for e, p in (("u", "a"), ("v", "b"))])).alias("e")).select("mesh", "e.*")
    known = ends.groupBy("mesh", "vid").agg(F.min(F.struct("x", "y", "z", *normals)).alias("p")).select("mesh", "p.*")
    by_draw = Window.partitionBy("mesh").orderBy(F.xxhash64(F.lit(seed), "u", "v"), "u", "v")
    counts = known.groupBy("mesh").agg(F.count("*").alias("_known"))
    ranked = placed.withColumn("_at", F.row_number().over(by_draw)).withColumn("_edges", F.count("*").over(Window.partitionBy("mesh")))
    ranked = join_made(ranked, counts, "mesh")
    missing = F.greatest(F.lit(wanted) - F.col("_known"), F.lit(0))
    share = (F.floor(missing / F.col("_edges")) + F.when(F.col("_at") <= missing % F.col("_edges"), 1).otherwise(0)).cast("int")
    spread = ranked.withColumn("_m", share).where("_m > 0").withColumn("_j", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    t = F.col("_j") / (F.col("_m") + 1)
    between = spread.select("mesh", *[(F.col(f"a{a}") * (1 - t) + F.col(f"b{a}") * t).alias(a) for a in "xyz"], *normals)
    first = Window.partitionBy("mesh").orderBy("x", "y", "z")
    return known.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= wanted).drop("_r").unionByName(between)


def smooth(vertices: DataFrame, faces: DataFrame, rounds: int = 1, share: float = 0.5) -> DataFrame:
    """vertices moved towards the mean of their neighbours, some times over."""
    edges = face_edges(faces).select("mesh", "u", "v").distinct()
    both = edges.union(edges.select("mesh", F.col("v").alias("u"), F.col("u").alias("v")))
    for _ in range(rounds):
        mean = both.join(vertices.withColumnRenamed("vid", "v"), ["mesh", "v"]).groupBy("mesh", F.col("u").alias("vid")).agg(*[F.avg(a).alias(f"m{a}") for a in "xyz"])
        vertices = vertices.join(mean, ["mesh", "vid"], "left").select("mesh", "vid", *[(F.col(a) + F.lit(share) * (F.coalesce(f"m{a}", a) - F.col(a))).alias(a) for a in "xyz"])
    return vertices
