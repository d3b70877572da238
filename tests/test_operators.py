"""Golden models, algebraic properties and hand-written edge cases."""

import io
import itertools
import math
import pickle
import pickletools
import random
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from citymill.functions import scalar
from citymill.operators import clouds, flight, metrics, pairs, solids, tiling, topology, voxels
from citymill.sources import files, obj, tensors, writers
from citymill.streaming import incremental


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def test_numbers_are_read_alike(spark):
    texts = ["1", "-2.5", "+.5", "1e3", "1.0f", "1d", "1_000", "a", "nan", "-inf", "", "."]
    got = [one(spark, scalar.number(F.lit(t))) for t in texts]
    assert got[:4] == [1.0, -2.5, 0.5, 1000.0] and got[4:8] == [None] * 4
    assert math.isnan(got[8]) and got[9] == -math.inf and got[10:] == [None, None]


@pytest.mark.parametrize("angle,expected", [(-190.0, 170.0), (180.0, -180.0), (540.0, -180.0), (1e-12, 0.0), (-0.5, -0.5)])
def test_angles_wrap(spark, angle, expected):
    assert one(spark, scalar.wrap_degrees(F.lit(angle))) == pytest.approx(expected)


def test_names(spark):
    names = ["1_2", "1_2_3_4", "1_x_3", "1_2_3"]
    assert [one(spark, scalar.index_triple(F.lit(n))) for n in names] == [None, None, None, [1, 2, 3]]
    assert [one(spark, scalar.name_prefix(F.lit(n))) for n in names] == ["1_2", "1_2", "1_x", "1_2"]
    df = spark.createDataFrame([("b10",), ("b2",), ("12_building_7",)], "name string")
    assert [r.name for r in df.orderBy(scalar.natural_key(F.col("name")), "name").collect()] == ["b2", "b10", "12_building_7"]
    assert one(spark, scalar.extension(F.lit("a/.b"))) == "" and one(spark, scalar.extension(F.lit("a/c.OBJ"))) == ".obj"


def lines(spark, **contents):
    return spark.createDataFrame([(p, k, v) for p, t in contents.items() for k, v in enumerate(t.split("\n"))], "path string, line_no int, value string")


def test_mesh_text_rules(spark):
    df = lines(spark, none="vn 1 2 3\nf 1 2 3", indented="  v 1 2 3", short="v 1 2", bad="v a 2 3\nv 1 2 3", nan="v nan 1 2\nv 3 1 2")
    strict = {r.mesh: r for r in metrics.bounds(obj.strict_vertices(df).withColumnRenamed("path", "mesh")).collect()}
    assert set(strict) == {"bad", "nan"} and strict["nan"].min_x == strict["nan"].max_x == 3.0
    assert {r.path for r in obj.lenient_vertices(df).select("path").distinct().collect()} == {"indented", "nan"}
    assert {r.path: r.n for r in obj.vertex_heights(df).groupBy("path").agg(F.count("*").alias("n")).collect()} == {"bad": 2, "nan": 2}
    assert {r.path: r.has_vertices for r in obj.has_vertices(df).collect()} == {"none": False, "indented": False, "short": True, "bad": True, "nan": True}
    status = {r.path: r.status for r in obj.mesh_outcomes(df, 0.5).collect()}
    assert status["none"] == "failed" and status["bad"] == "below"


def test_faces_count_from_either_end(spark):
    df = lines(spark, m="v 0 0 0\nv 1 0 0\nv 0 1 0\nf 1/2/3 2 3\nv 5 5 5\nf -1 -2 -3")
    assert [r.idx for r in obj.faces(df).orderBy("fid").collect()] == [[0, 1, 2], [3, 2, 1]]


def test_extent_equal_to_the_threshold_does_not_qualify(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("a", 5.0, 5.0, 5.0), ("b", 0.0, 0.0, 0.0), ("b", 5.0, 6.0, 6.0), ("c", 0.0, 0.0, 0.0), ("c", 6.0, 6.0, 6.0)], "mesh string, x double, y double, z double")
    assert [r.mesh for r in metrics.above_threshold(df, 5.0).collect()] == ["c"]


def test_vertex_on_an_edge_is_in_both_tiles(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (1, 100.0, 0.0, 50.0), (1, 200.0, 0.0, 100.0)], "mesh int, x double, y double, z double")
    assert sorted((r.i, r.n) for r in tiling.mesh_stats(df).collect()) == [(0, 2), (1, 2)]


@pytest.mark.parametrize("cube", [100.0, 150.0, 40.0])
def test_range_join_equals_nested_loop(spark, cube):
    rng = random.Random(3)
    rows = [(k % 5, rng.choice([rng.uniform(0, 700), 50.0 * rng.randint(0, 14)]), rng.random(), rng.uniform(0, 350)) for k in range(800)]
    df = spark.createDataFrame(rows, "mesh int, x double, y double, z double")
    grid = [(r.i, r.j, r.cx, r.cz) for r in tiling.tile_grid(df).collect()]
    h = cube / 2
    expected = sorted((i, j, m) for i, j, cx, cz in grid for m, x, _, z in rows if cx - h <= x <= cx + h and cz - h <= z <= cz + h)
    assert sorted((r.i, r.j, r.mesh) for r in tiling.members(df, cube=cube).collect()) == expected


def test_high_mesh_drops_the_tile_before_counts(spark):
    stats = spark.createDataFrame([(0, 0, 1, 199, 1.0), (0, 0, 2, 200, 1.0), (1, 0, 3, 500, 1.0), (1, 0, 4, 1, 99.0)], "i int, j int, mesh int, n int, max_y double")
    limit = spark.createDataFrame([(50.0,)], "height_limit double")
    assert [r.mesh for r in tiling.selected(stats, limit).collect()] == [2]


@pytest.mark.parametrize("n", [0, 1, 3, 5])
def test_powerset_order_and_pairs(spark, n):
    meshes = list(range(10, 10 + n))
    tiles = spark.createDataFrame([(0, 0, meshes)], "i int, j int, meshes array<int>")
    sets = [r.building_indices for r in tiling.powerset(tiles).orderBy("k").collect()]
    assert sets == [list(c) for size in range(n + 1) for c in itertools.combinations(meshes, size)]
    chunks = tiling.powerset(tiles)
    assert pairs.state_pairs(chunks).count() == 3**n - 2**n
    assert pairs.state_pairs(chunks, with_grounds=True).count() == 2 * (3**n - 2**n)


def test_large_tiles_are_whole_or_an_error(spark):
    tiles = spark.createDataFrame([(0, 0, list(range(14))), (0, 1, [7]), (0, 2, [])], "i int, j int, meshes array<int>")
    sets = tiling.powerset(tiles)
    assert sets.count() == 2**14 + 2 + 1 and sets.where("j = 0").select("building_indices").distinct().count() == 2**14
    assert [(r.k, r.building_indices, r.ground_indices) for r in sets.where("j > 0").orderBy("j", "k").collect()] == [(0, [], [7]), (1, [7], []), (0, [], [])]
    assert [(r.j, r.n) for r in tiling.too_large(tiles, 13).collect()] == [(0, 14)]
    with pytest.raises(Exception, match="more than 13 meshes in tile 0 0"):
        tiling.powerset(tiles, 13).collect()


def test_gap_is_reported(spark):
    names = spark.createDataFrame([("3_4_0",), ("3_4_2",), ("bad",)], "name string")
    assert [tuple(r) for r in pairs.gaps(names).collect()] == [(3, 4, 1)]


def test_split_has_at_least_one(spark):
    keys = spark.createDataFrame([(i, 0) for i in range(7)], "i int, j int")
    assert {r.split: r["count"] for r in pairs.split_groups(keys, 0.01, "s").groupBy("split").count().collect()} == {"val": 1, "train": 6}
    assert pairs.split_groups(keys, 0.0, "s").where("split = 'val'").count() == 0


def test_four_quarter_turns_are_identity(spark):
    df = spark.createDataFrame([(1.5, -2.0, 3.25)], "x double, y double, z double")
    x, z = F.col("x"), F.col("z")
    for _ in range(4):
        x, z = scalar.rotate_y(x, z, 90.0)
    r = df.select(x.alias("x"), z.alias("z")).first()
    assert (r.x, r.z) == pytest.approx((1.5, 3.25), abs=1e-9)


@pytest.mark.parametrize("n,kept", [(10, 0), (11, 11)])
def test_crop_keeps_only_filled_chunks(spark, n, kept):
    points = spark.createDataFrame([(k, 0.0, 0.0, 0.01 * k) for k in range(n)] + [(99, 9.0, 9.0, 9.0)], "pid int, x double, y double, z double")
    chunks = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 2.0)], "chunk int, px double, py double, pz double, size double")
    assert clouds.crop(points, chunks, cell=0.3).count() == clouds.crop(points, chunks, cell=1.0).count() == kept


def test_farthest_points(spark):
    df = spark.createDataFrame([(1, k, float(k), 0.0, 0.0) for k in range(11)], "cloud int, pid long, x double, y double, z double")
    assert [r.pid for r in clouds.farthest_points(df, 4).orderBy("rank").collect()][:3] == [0, 10, 5]
    assert clouds.farthest_points(df, 50).count() == 11


def unit_cube(spark):
    corners, faces = solids.box((0.0, 0.0, 0.0), (1.0, 1.0, 1.0))
    v = spark.createDataFrame([(1, k, *map(float, c)) for k, c in enumerate(corners)], "mesh int, vid long, x double, y double, z double")
    f = spark.createDataFrame([(1, k, q) for k, q in enumerate(faces)], "mesh int, fid int, idx array<int>")
    return v, f


def corner_triangles(v, f):
    t = topology.triangles(f)
    out = t.select("mesh", F.concat_ws("_", "fid", "part").alias("fid"), *[F.col("idx")[k].alias(f"v{p}") for k, p in enumerate("abc")])
    for p in "abc":
        out = out.join(v.select(F.col("vid").alias(f"v{p}"), *[F.col(a).alias(f"{p}{a}") for a in "xyz"]), f"v{p}")
    return out


def test_cube_topology(spark):
    v, f = unit_cube(spark)
    assert topology.watertight(f).first().watertight and not topology.watertight(f.where("fid > 0")).first().watertight
    assert topology.sharp_edges(v, f).count() == 12
    assert {r.component for r in topology.components(f).collect()} == {0}
    foot = topology.footprints(v, f).first()
    assert foot.height == 1.0 and len(foot.contour) == 5 and foot.contour[0] == foot.contour[-1]
    assert topology.smooth(v, f).agg(F.max("x")).first()[0] < 1.0
    found = topology.loose(v.unionByName(v.where("vid = 0").withColumn("vid", F.lit(50).cast("long"))).select("mesh", "vid"), spark.createDataFrame([(1, 0, 6)], "mesh int, u long, v long"), f).first()
    assert (found.loose_points, found.loose_lines, found.has_loose) == (1, 1, True)


def test_samples_lie_on_the_surface(spark):
    t = corner_triangles(*unit_cube(spark))
    rows = clouds.surface_sample(t, 600).collect()
    assert len(rows) == 600 and len({r.pid for r in rows}) == 600
    assert all(min(abs(c) for c in (r.x, r.y, r.z, r.x - 1, r.y - 1, r.z - 1)) < 1e-9 for r in rows)
    top = sum(r.y > 1 - 1e-9 for r in rows)
    assert 80 <= top <= 120
    moved = clouds.jitter(clouds.surface_sample(t, 400), (0.01,)).agg(F.stddev("x"), F.count("*")).first()
    assert moved[1] == 400


def test_signed_distance_of_a_cube(spark):
    points = spark.createDataFrame([(0, 0.5, 0.5, 0.5), (1, 2.0, 0.5, 0.5), (2, 0.5, 0.9, 0.5), (3, 2.0, 2.0, 0.5)], "pid int, x double, y double, z double")
    got = [r.sdf for r in clouds.signed_distance(points, corner_triangles(*unit_cube(spark))).orderBy("pid").collect()]
    assert got == pytest.approx([-0.5, 1.0, -0.1, math.sqrt(2)], abs=1e-9)


@pytest.mark.parametrize("ring,triangles", [([(0, 0), (4, 0), (4, 4), (0, 4)], 2), ([(0, 0), (0, 4), (4, 4), (4, 0)], 2), ([(0, 0), (2, 0), (4, 0), (4, 4), (2, 1), (0, 4)], 3), ([(0, 0), (0, 0), (4, 0), (4, 4), (0, 0)], 1)])
def test_ears(ring, triangles):
    clean = solids.cleaned(ring)
    found = solids.ear_clipped(clean)
    assert len(found) == triangles
    assert sum(abs(solids.area_of([clean[k] for k in t])) for t in found) == pytest.approx(abs(solids.area_of(clean)))


def test_bad_rings_are_errors_as_data(spark):
    ring = lambda *p: [dict(zip("xyz", (float(x), 0.0, float(z)), strict=True)) for x, z in p]
    df = spark.createDataFrame([(0, []), (1, ring((0, 0), (1, 0), (2, 0))), (2, ring((0, 0), (1, 0), (1, 1)))], "mesh int, contour array<struct<x:double,y:double,z:double>>")
    got = {r.mesh: (r.error is None, len(r.triangles)) for r in solids.cleaned_footprints(df).collect()}
    assert got == {0: (False, 0), 1: (False, 0), 2: (True, 1)}
    assert metrics.worst_coordinate(df.select(F.lit("f").alias("path"), F.lit(0).alias("idx"), "contour").where("mesh = 0")).first()[1:] == (0.0, -1)


def test_hull_and_distinct_points(spark):
    assert solids.hull([(0, 0), (2, 0), (2, 2), (0, 2), (1, 1), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    points = [{"x": x, "y": 0.0, "z": 0.0} for x in (0.0, 1e-7, 1.0, 0.0)]
    df = spark.createDataFrame([(points,)], "c array<struct<x:double,y:double,z:double>>")
    assert [p.x for p in df.select(solids.distinct_points(F.col("c")).alias("d")).first().d] == [0.0, 1.0]


def test_clipping_keeps_the_area_inside(spark):
    t = spark.createDataFrame([(1, "a", 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 0.0, 4.0)], "mesh int, fid string, ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double")
    rows = solids.clip_triangles(t, (0, -1, 0), (1, 1, 1)).collect()
    area = sum(abs((r.bx - r.ax) * (r.cz - r.az) - (r.bz - r.az) * (r.cx - r.ax)) / 2 for r in rows)
    assert area == pytest.approx(1.0)


def test_voxel_fill_of_a_cube(spark):
    v, f = unit_cube(spark)
    v = v.select("mesh", "vid", *[(F.col(a) * 4).alias(a) for a in "xyz"])
    t = corner_triangles(v, f)
    base = spark.range(16).select(F.lit(1).alias("mesh"), (F.col("id") % 4).cast("int").alias("ix"), F.floor(F.col("id") / 4).cast("int").alias("iz"))
    hits = voxels.upward_hits(base, t, 1.0, 0.5)
    assert {(r.hit, r.forward) for r in hits.collect()} == {(4.0, True)} and hits.count() == 16
    cells = voxels.filled_columns(hits, 1.0, 0).where("iy < 4")
    assert cells.count() == 64 and voxels.surface(cells).count() == 96
    assert voxels.crooked(spark.createDataFrame([(1, 0, 0, 0, 1, 1, 0)], "mesh int, x1 int, y1 int, z1 int, x2 int, y2 int, z2 int")).count() == 1
    assert voxels.grid_points(spark, (0.0, 0.0, 0.0), (1.0, 1.0, 1.0), 3).agg(F.max("x"), F.count("*")).first()[:] == (1.0, 27)


def test_flight_turns_and_stays_inside(spark):
    path = flight.serpentine(spark, flight.Scene(0, 100, 0, 50, 0, 90), 30.0, 30.0, 40.0).orderBy("idx").collect()
    assert [r.x for r in path if r.row == 0] == [0.0, 30.0, 60.0, 90.0, 100.0] and [r.x for r in path if r.row == 1] == [100.0, 70.0, 40.0, 10.0, 0.0]
    assert all(0 <= r.z <= 90 for r in path) and path[0].yaw == 0.0
    assert flight.rig(spark.createDataFrame([("P", 0.0, 0.0, 0.0, 0.0)], "name string, x double, y double, z double, yaw double")).first().name == "P_N.png"
    with pytest.raises(ValueError):
        flight.Scene(0, 0, 0, 1, 0, 1)
    flat = flight.Scene(0.0, 500.0, 7.0, 7.0, 0.0, 320.0)  # a flat scene may be flown over
    rows = {r.row: r.z for r in flight.serpentine(spark, flat, 80.0, 40.0, 45.0).collect()}
    assert rows == {k: 2.5 + 45 * k for k in range(8)}
    assert {r.z for r in flight.serpentine(spark, flight.Scene(0, 10, 0, 1, 0, 90), 5.0, 5.0, 45.0).collect()} == {22.5, 67.5}
    assert {r.z for r in flight.serpentine(spark, flight.Scene(0, 10, 0, 1, 0, 30), 5.0, 5.0, 45.0).collect()} == {15.0}
    turned = spark.createDataFrame([("P", 0.0, 0.0, 0.0, 30.0)], "name string, x double, y double, z double, yaw double")
    assert flight.rig(turned).first().yaw == 0.0 and flight.rig(turned, with_heading=True).first().yaw == 30.0
    for along, cross in ((0.0, 1.0), (1.0, -1.0)):
        with pytest.raises(ValueError):
            flight.serpentine(spark, flat, 80.0, along, cross)
    assert spark.createDataFrame([(0, 1.0, 1.0)], "idx int, x double, z double").transform(flight.headings).first().yaw == 0.0


def test_documents_lists_and_clouds(spark, tmp_path):
    (tmp_path / "m/3_4_0").mkdir(parents=True)
    (tmp_path / "m/3_4_0/data.yaml").write_text("position: [1, 2, 3]\nsize: 50\nbuilding_indices: [1]\nextra: kept\n")
    (tmp_path / "m/3_4_1").mkdir()
    (tmp_path / "m/3_4_1/data.yaml").write_text("position: [1, 2]\n")
    rows = {r.chunk_id: r for r in files.chunk_documents(spark, str(tmp_path / "m")).collect()}
    assert rows["3_4_0"].size == 50.0 and "kept" in rows["3_4_0"].raw and rows["3_4_0"].z_offset == 0.0 and rows["3_4_1"].error
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.yaml").write_text("- {mesh_id: 1, height: 2, footprint: [[0,0,0],[1,0,0]]}\n- {name: x}\n")
    (tmp_path / "f/b.yaml").write_text("[]\n")
    assert [(r.name, len(r.contour), r.error is None) for r in files.footprint_documents(spark, str(tmp_path / "f")).orderBy("idx").collect()] == [("1", 2, True), ("x", 0, False)]
    (tmp_path / "p.yaml").write_text("- {t1: a, t2: b, condition: c}\n")
    assert files.pair_documents(spark, str(tmp_path / "p.yaml")).first().condition == "c"
    (tmp_path / "l.json").write_text('["a/b.obj", "c.obj"]')
    assert files.json_list(spark, str(tmp_path / "l.json")).count() == 2
    (tmp_path / "l.txt").write_text(" a \n\nb\n")
    assert [r.name for r in files.lines_list(spark, str(tmp_path / "l.txt")).collect()] == ["a", "b"]
    cloud = spark.createDataFrame([("c", k, float(k), 0.5, -0.25) for k in range(4)], "cloud string, pid long, x double, y double, z double")
    for binary, coloured in ((True, False), (False, False), (True, True)):
        assert writers.write_ply(cloud, str(tmp_path / "ply"), binary, coloured).collect()[0].status == "written"
        assert [tuple(r) for r in files.cloud_files(spark, str(tmp_path / "ply")).orderBy("pid").collect()] == [("c", k, float(k), 0.5, -0.25) for k in range(4)]
    for kind in ("npz", "pt"):
        assert writers.write_arrays(cloud, str(tmp_path / kind), kind).collect()[0].status == "written"
        assert [tuple(r) for r in files.cloud_files(spark, str(tmp_path / kind)).orderBy("pid").collect()] == [("c", k, float(k), 0.5, -0.25) for k in range(4)]
    wide = np.arange(12, dtype=np.float32).reshape(4, 3)
    assert (tensors.load(tensors.dump(wide)) == wide).all() and tensors.load(tensors.dump(np.zeros((0, 3)))).shape == (0, 3)
    names = [t[0].name for t in pickletools.genops(zipfile.ZipFile(io.BytesIO(tensors.dump(wide))).read("archive/data.pkl"))]
    assert names[-2:] == ["REDUCE", "STOP"] and "BINPERSID" in names
    evil = io.BytesIO()
    with zipfile.ZipFile(evil, "w") as z:
        z.writestr("a/data.pkl", b"cos\nsystem\n(X\x04\x00\x00\x00truetR.")
    with pytest.raises(pickle.UnpicklingError):
        tensors.load(evil.getvalue())
    np.savez(tmp_path / "c.npz", fps_points=np.ones((3, 3), np.float32))
    assert files.cloud_files(spark, str(tmp_path / "c.npz")).count() == 3


def test_mesh_text_round_trip(spark, tmp_path):
    v, f = unit_cube(spark)
    two = lambda df: df.withColumn("file", F.lit("city")).unionByName(df.withColumn("mesh", F.lit(2)).withColumn("file", F.lit("city")))
    writers.write_obj(writers.obj_text(two(v), two(f)), str(tmp_path)).collect()
    read = obj.read_lines(spark, str(tmp_path))
    assert obj.vertices(read).count() == 16 and topology.watertight(obj.faces(read)).first()[1:] == (24, True)
    assert {r.component for r in topology.components(obj.faces(read)).collect()} == {0, 8}


def test_reports(spark):
    df = lines(spark, a="v 0 0 0\nv 9 9 9", b="vn 1 1 1")
    report = [r.value for r in writers.threshold_report(obj.mesh_outcomes(df, 5.0), 5.0).collect()]
    assert report == ["# threshold\t5.000000", "# total_files\t2\tqualified\t1", "path\textent_x\textent_y\textent_z", "a\t9.000000\t9.000000\t9.000000"]
    assert writers.json_paths(df.select("path").distinct()).first().value == '["a","b"]'


def test_copy_plan(spark):
    source = spark.createDataFrame([("a.obj",), ("b.OBJ",), (".h/c.obj",), ("d.txt",)], "path string")
    target = spark.createDataFrame([("a.obj",)], "path string")
    assert {r.path: r.action for r in files.copy_plan(source, target, ["obj"]).collect()} == {"a.obj": "exists", "b.OBJ": "copy", ".h/c.obj": "hidden", "d.txt": "other_type"}


def test_stream_measures_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.obj").write_text("v 0 0 0\nv 9 9 9\n")

    def run():
        incremental.measure(incremental.arriving_lines(spark, str(tmp_path / "in")), 5.0, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["a.obj"]
    (tmp_path / "in/b.obj").write_text("vn 1 1 1\n")
    assert run() == run() == ["a.obj", "b.obj"]


def test_prism_faces_look_outwards(spark):
    ring = [{"x": 0.0, "z": 0.0}, {"x": 2.0, "z": 0.0}, {"x": 2.0, "z": 2.0}, {"x": 0.0, "z": 2.0}]
    entries = spark.createDataFrame([(1, ring, [[3, 0, 1], [1, 2, 3]], 0.0, 2.0)], "mesh int, ring array<struct<x:double,z:double>>, triangles array<array<int>>, bottom double, height double")
    v, f = solids.prism_vertices(entries), solids.prism_faces(entries)
    t = corner_triangles(v, f).collect()
    volume = sum(np.linalg.det([[r.ax, r.ay, r.az], [r.bx, r.by, r.bz], [r.cx, r.cy, r.cz]]) for r in t) / 6
    assert volume == pytest.approx(8.0)
    assert clouds.signed_distance(spark.createDataFrame([(0, 1.0, 1.0, 1.0)], "pid int, x double, y double, z double"), corner_triangles(v, f)).first().sdf == pytest.approx(-1.0)


def test_list_predicates(spark):
    from citymill.functions import predicates as p

    row = spark.createDataFrame([([1, 2, 9], [2, 9], [5])], "items array<int>, inside array<int>, outside array<int>").select(
        p.any_target(F.col("items"), F.col("inside")).alias("a"),
        p.any_target(F.col("items"), F.col("outside")).alias("b"),
        p.all_targets(F.col("items"), F.col("inside")).alias("c"),
        p.other_than_targets(F.col("items"), F.col("inside")).alias("d"),
        p.other_than_targets(F.col("inside"), F.col("items")).alias("e"),
        p.valid_indices(F.col("items"), F.lit(3)).alias("f"),
        p.strict_superset(F.col("items"), F.col("inside")).alias("g"),
        p.strict_superset(F.col("items"), F.col("items")).alias("h"),
    )
    assert list(row.first()) == [True, False, True, True, False, [1, 2], True, False]


def test_outputs_that_are_there_are_not_made_again(spark):
    inputs = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    outputs = spark.createDataFrame([("a", 10), ("b", 0)], "path string, length int")
    assert {r.path for r in files.todo(inputs, outputs).collect()} == {"c"}
    assert {r.path for r in files.todo(inputs, outputs, least_bytes=1).collect()} == {"b", "c"}
    paths = files.output_paths(spark.createDataFrame([("x/3_4_0/m.obj",)], "path string"), "out").first()
    assert paths[1:] == ("out/sharp/3_4_0/m.ply", "out/points/3_4_0/m.npz", "out/normal/3_4_0/m.obj")


def test_late_events_are_windowed(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    query = incremental.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path)).start()
    query.awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == events.count()


@pytest.mark.parametrize("name", ["surface_sample", "jittered_sample", "clipped_triangles", "voxel_surface", "voxel_upward_fill", "sdf_probe"])
def test_kernels_take_every_mesh(spark, tmp_path, name):
    from citymill.plans import catalog

    parts = [(k, 3 + k % 4, 900.0 + k) for k in (1, 2, 3, 50, 51, 52, 100)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    assert {r.mesh for r in catalog.QUERIES[name](spark, str(tmp_path)).select("mesh").distinct().collect()} == {k for k, _, _ in parts}


def test_distances_to_each_mesh_equal_those_to_it_alone(spark):
    corners, faces = solids.box((0.0, 0.0, 0.0), (2.0, 2.0, 2.0))
    names = ", ".join(f"{p}{a} double" for p in "abc" for a in "xyz")
    rows = [(m, *[v + 5.0 * m for k in (f[0], f[i], f[i + 1]) for v in corners[k]]) for m in range(3) for f in faces for i in (1, 2)]
    triangles = spark.createDataFrame(rows, f"mesh int, {names}")
    points = spark.createDataFrame([(0, 1.0, 1.0, 1.0), (1, 6.0, 6.0, 6.0), (2, -1.0, 1.0, 1.0)], "pid int, x double, y double, z double")
    each = {(r.mesh, r.pid): r.sdf for r in clouds.signed_distance_each(points, triangles).collect()}
    assert len(each) == 9 and each[0, 0] == pytest.approx(-1) and each[1, 1] == pytest.approx(-1) and each[0, 2] == pytest.approx(1)
    for m in range(3):
        for r in clouds.signed_distance(points, triangles.where(F.col("mesh") == m)).collect():
            assert each[m, r.pid] == pytest.approx(r.sdf)
    with pytest.raises(ValueError):
        clouds.signed_distance_each(points, triangles, most_points=2)


def plain_distances(points, triangles):
    """Each point against each triangle, straight from the definition."""
    a, b, c = (triangles[:, k][None] - points[:, None] for k in range(3))
    dot = lambda p, q: np.einsum("ijk,ijk->ij", p, q)
    la, lb, lc = (np.linalg.norm(v, axis=-1) for v in (a, b, c))
    winding = np.arctan2(dot(a, np.cross(b, c)), la * lb * lc + dot(a, b) * lc + dot(b, c) * la + dot(c, a) * lb).sum(1) / (2 * np.pi)
    n = np.cross(b - a, c - a)
    with np.errstate(divide="ignore", invalid="ignore"):
        foot = n * (dot(a, n) / dot(n, n))[..., None]
        inside = (dot(n, n) > 0) & np.logical_and.reduce([dot(np.cross(q - p, foot - p), n) >= 0 for p, q in ((a, b), (b, c), (c, a))])
    near = np.where(inside, dot(foot, foot), np.inf)
    for p, q in ((a, b), (b, c), (c, a)):
        d, length = q - p, dot(q - p, q - p)
        e = p + d * np.clip(-dot(p, d) / np.where(length > 0, length, 1), 0, 1)[..., None]
        near = np.minimum(near, dot(e, e))
    return np.where(np.abs(winding) > 0.5, -1, 1) * np.sqrt(near.min(1))


def box_triangles(low, high, open_top=False):
    corners, faces = solids.box(low, high, open_top)
    return np.array([[corners[f[0]], corners[f[i]], corners[f[i + 1]]] for f in faces for i in (1, 2)], float)


def test_distances_equal_the_definition():
    """Closed, open, doubled and degenerate meshes, far from the origin too; points on corners and edges and in the box."""
    rng = np.random.default_rng(5)
    meshes = [box_triangles((0, 0, 0), (3, 2, 5)), box_triangles((0, 0, 0), (3, 2, 5), True), box_triangles((1e4, 0, -1e4), (1e4 + 7, 4, 3 - 1e4))]
    meshes += [np.concatenate([meshes[0], meshes[0] + [2.0, 0.0, 0.0]]), np.concatenate([meshes[0]] * 2), meshes[0][:, ::-1], np.concatenate([meshes[0], [[[0, 0, 0]] * 3, [[0, 0, 0], [3, 0, 0], [1, 0, 0]]]])]
    meshes += [rng.normal(size=(n, 3, 3)) * 4 for n in (1, 2, 70, 300)]
    held = clouds.Meshes(np.concatenate(meshes), np.cumsum([0, *map(len, meshes)]))
    assert held.closed[:7].tolist() == [True, False, True, True, True, True, False]  # a triangle without area has edges of its own
    for m, t in enumerate(meshes):
        points = np.concatenate([t.reshape(-1, 3)[:40], t.mean(1)[:40], t.mean((0, 1)) + rng.normal(size=(1_500, 3)) * 4])
        want = plain_distances(points, t)
        for got in (held.distances(m, points.T), clouds.signed_distances(points, t)):
            assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-10)
            clear = np.abs(want) > 1e-6
            assert (np.sign(got) == np.sign(want))[clear].all()


def test_distances_to_a_small_mesh_take_a_fraction_of_the_definition_s_time():
    points, box = np.random.default_rng(1).uniform(-60, 60, (2_000, 3)), box_triangles((0, 0, 0), (25, 9, 25))

    def least(work):
        took = []
        for _ in range(7):
            began = time.perf_counter()
            work(points, box)
            took.append(time.perf_counter() - began)
        return min(took)

    assert least(clouds.signed_distances) * 4 < least(plain_distances)


def test_distances_of_meshes_cut_by_batches(spark):
    """Meshes over several batches, a mesh without a key, and one above the limit; the meshes are read in bulk, not one by one."""
    names = ", ".join(f"{p}{a} double" for p in "abc" for a in "xyz")
    boxes = {m: box_triangles((m or 0, 0, 0), ((m or 0) + 2, 2, 2)) for m in (None, *range(1, 30))}
    triangles = spark.createDataFrame([(m, *t.ravel().tolist()) for m, b in boxes.items() for t in b], f"mesh long, {names}")
    points = spark.createDataFrame([(k, 0.9 * k, 0.5, 0.7) for k in range(11)], "pid int, x double, y double, z double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        found = clouds.signed_distance_each(points, triangles, rows_at_once=25)
        rows = found.collect()
        with pytest.raises(Exception, match="more than 11 triangles"):
            clouds.signed_distance_each(points, triangles, most_triangles=11).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == len({(r.mesh, r.pid) for r in rows}) == 30 * 11
    places = np.array([(0.9 * k, 0.5, 0.7) for k in range(11)])
    want = {m: plain_distances(places, b) for m, b in boxes.items()}
    assert all(r.sdf == pytest.approx(want[r.mesh][r.pid]) and r.x == pytest.approx(0.9 * r.pid) for r in rows)
    assert clouds.signed_distance_each(points.where("pid < 0"), triangles).count() == 0
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()


def test_upward_hits_of_tiles_equal_those_of_columns(spark):
    """Columns over several tiles, negative ones, steep and overlapping triangles, two meshes; nothing is made distinct."""
    rng = random.Random(3)
    rows = [(m, *[rng.uniform(-90, 90) for _ in range(9)]) for m in (1, 2) for _ in range(6)] + [(1, 0.0, 1.0, 0.0, 0.0, 9.0, 0.0, 5.0, 1.0, 5.0)]
    t = spark.createDataFrame(rows, "mesh int, " + ", ".join(f"{p}{a} double" for p in "abc" for a in "xyz"))
    old = voxels.upward_hits(voxels.columns(voxels.from_triangles(t, 1.5)), t, 1.5, 0.5)
    new = voxels.upward_hits_each(t, 1.5, 0.5)
    key = lambda df: sorted((r.mesh, r.ix, r.iz, round(r.hit, 6), r.forward) for r in df.collect())
    assert key(new) == key(old) and new.count() > 64 * 64
    plan = voxels.filled_columns(new, 1.5, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan


def plain_cells(t):
    """The cells of one triangle (in units of the pitch), each cell of its box against each axis."""
    low, high = np.floor(t.min(0)).astype(int), np.floor(t.max(0)).astype(int)
    grid = np.array(list(itertools.product(*[range(a, b + 1) for a, b in zip(low, high, strict=True)])))
    v, edges = t[None] - (grid + 0.5)[:, None], [t[1] - t[0], t[2] - t[1], t[0] - t[2]]
    keep = np.ones(len(grid), bool)
    for axis in [np.cross(edges[0], edges[1]), *(np.cross(np.eye(3)[k], e) for e in edges for k in range(3))]:
        along, reach = v @ axis, 0.5 * np.abs(axis).sum() + 1e-12
        keep &= (along.min(1) <= reach) & (along.max(1) >= -reach)
    return {tuple(c) for c in grid[keep].tolist()}


def plain_faces(cells, pitch, origin):
    """Faces between a cell that is held and one that is not, as axis, step and the set of corners."""
    out = set()
    for c in cells:
        for axis, step in itertools.product(range(3), (-1, 1)):
            if tuple(v + (step if k == axis else 0) for k, v in enumerate(c)) not in cells:
                sides = [[v + (step > 0)] if k == axis else [v, v + 1] for k, v in enumerate(c)]
                out.add((axis, step, frozenset(tuple(v * pitch + o for v, o in zip(p, origin, strict=True)) for p in itertools.product(*sides))))
    return out


@pytest.mark.parametrize("at_once", [(5_000, 4_000_000), (3, 1)])
def test_surface_of_triangles_equals_the_definition(spark, at_once):
    """Meshes over several tiles and on their borders, triangles on the grid, without area or without a place, a mesh without a key; tables that cut a tile."""
    rng = np.random.default_rng(7)
    meshes = {None: box_triangles((0, 0, 0), (3, 2, 5)), "on": box_triangles((29, -35, -4), (32, -31, 4)), "cut": box_triangles((-36, 1.3, -34.5), (2.7, 4.1, 35.2))}
    meshes["a"] = np.concatenate([rng.uniform(-9, 9, (9, 3, 3)), rng.uniform(28, 36, (20, 3, 3)), [[[1, 1, 1]] * 3, [[0, 0, 0], [3, 0, 0], [1, 0, 0]]]])
    pitch, origin = 0.5, (1.0, -2.0, 0.25)
    rows = [(m, *(t * pitch).ravel().tolist()) for m, own in meshes.items() for t in own]
    lost = [(m, *row) for m in ("a", "gone") for row in ([0.0] * 8 + [None], [0.0] * 8 + [math.nan], [math.inf] + [0.0] * 8)]
    triangles = spark.createDataFrame(rows + lost, "mesh string, " + ", ".join(f"{p}{a} double" for p in "abc" for a in "xyz"))
    want = {m: set().union(*[plain_cells(t) for t in own]) for m, own in meshes.items()}
    cells = [(r.mesh, (r.ix, r.iy, r.iz)) for r in voxels.from_triangles(triangles, pitch).collect()]
    assert len(cells) == len(set(cells)) and set(cells) == {(m, c) for m, own in want.items() for c in own}
    rows = voxels.surface_of_triangles(triangles, pitch, origin, triangles_at_once=at_once[0], cells_at_once=at_once[1]).collect()
    found = [(r.mesh, r.axis, r.step, frozenset((c.x, c.y, c.z) for c in r.corners)) for r in rows]
    assert len(found) == len(set(found)) and set(found) == {(m, *f) for m, own in want.items() for f in plain_faces(own, pitch, origin)}
    keyed = triangles.where("mesh IS NOT NULL")  # a join tells cells without a key apart from each other
    asis = lambda df: sorted(df.collect())
    assert asis(voxels.surface_of_triangles(keyed, pitch, origin)) == asis(voxels.surface(voxels.from_triangles(keyed, pitch), pitch, origin))


def test_voxel_surface_makes_no_rows_of_cells(spark, sf_dir):
    """Cells were made distinct by a shuffle and met their neighbours by a join of six rows a cell."""
    from citymill.plans import catalog

    df = catalog.QUERIES["voxel_surface"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("Exchange") == 2
    prisms = solids.prism_triangles(catalog._prisms(spark, sf_dir).where("mesh < 40"))
    assert sorted(df.where("mesh < 40").collect()) == sorted(voxels.surface(voxels.from_triangles(prisms, 2.0), 2.0).collect())
