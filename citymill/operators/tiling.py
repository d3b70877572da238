"""Tiles of a scene, the meshes in them and the subsets of those meshes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates
from .grouping import join_made

MOST_IN_TILE = 30
AT_ONCE = 12  # 2 ** 12 subsets


def scene_bounds(vertices: DataFrame) -> DataFrame:
    """One row: bounds of all vertices."""
    return vertices.agg(*[f(a).alias(f"{n}_{a}") for a in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))])


def _count(axis: str, step: float) -> Column:
    if step <= 0:
        return F.lit(1).cast("long")
    return F.ceil((F.col(f"max_{axis}") - F.col(f"min_{axis}")) / F.lit(float(step))).cast("long")


def _centre(axis: str, index: Column, step: float) -> Column:
    return F.col(f"min_{axis}") + (index + F.lit(0.5)) * F.lit(float(step))


def tile_grid(vertices: DataFrame, steps: tuple[float, float] = (100.0, 100.0)) -> DataFrame:
    """i, j, cx, cz of every tile; the scene's one row of bounds is broadcast."""
    bounds = scene_bounds(vertices).withColumn("nx", _count("x", steps[0])).withColumn("nz", _count("z", steps[1])).where("nx > 0 AND nz > 0")
    rows = bounds.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1)))
    tiles = rows.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nz") - 1)))
    return tiles.select("i", "j", _centre("x", F.col("i"), steps[0]).alias("cx"), _centre("z", F.col("j"), steps[1]).alias("cz"))


def _candidates(axis: str, value: Column, step: float, cube: float) -> Column:
    """Tile numbers whose window may hold a value, one more on either side, within the grid."""
    if step <= 0:
        return F.array(F.lit(0).cast("long"))
    at = (value - F.col(f"min_{axis}")) / F.lit(float(step)) - F.lit(0.5)
    reach = F.lit(cube / 2 / step)
    low = F.greatest(F.floor(at - reach).cast("long"), F.lit(0).cast("long"))
    high = F.least(F.ceil(at + reach).cast("long"), F.col("n" + axis) - 1)
    return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<bigint>"))


def members(vertices: DataFrame, steps: tuple[float, float] = (100.0, 100.0), cube: float = 100.0) -> DataFrame:
    """i, j, mesh, x, y, z: each vertex in each tile whose closed window holds it.

    A range join without a nested loop: a vertex is repeated for the few tiles that can hold it,
    and the exact test uses the centre expression of tile_grid.
    """
    bounds = scene_bounds(vertices).withColumn("nx", _count("x", steps[0])).withColumn("nz", _count("z", steps[1]))
    near = vertices.crossJoin(F.broadcast(bounds.select("min_x", "min_z", "nx", "nz")))  # one row
    near = near.withColumn("i", F.explode(_candidates("x", F.col("x"), steps[0], cube))).withColumn("j", F.explode(_candidates("z", F.col("z"), steps[1], cube)))
    half = F.lit(cube / 2)
    cx, cz = _centre("x", F.col("i"), steps[0]), _centre("z", F.col("j"), steps[1])
    inside = (F.col("x") >= cx - half) & (F.col("x") <= cx + half) & (F.col("z") >= cz - half) & (F.col("z") <= cz + half)
    return near.where(inside).select("i", "j", "mesh", "x", "y", "z")


def mesh_stats(vertices: DataFrame, steps: tuple[float, float] = (100.0, 100.0), cube: float = 100.0) -> DataFrame:
    """i, j, mesh, n, max_y: vertices of each mesh in each tile; counts combine before the shuffle."""
    return members(vertices, steps, cube).groupBy("i", "j", "mesh").agg(F.count("*").alias("n"), F.max("y").alias("max_y"))


def height_limit(vertices: DataFrame, cube: float, z_offset: float, mode: str = "centre") -> DataFrame:
    """One row, the height above which a mesh makes its tile unusable: min_y + cube / 2 + z_offset, or min_y + cube."""
    above = cube / 2 + z_offset if mode == "centre" else cube
    return vertices.agg((F.min("y") + F.lit(above)).alias("height_limit"))


def selected(stats: DataFrame, limit: DataFrame, least: int = 200) -> DataFrame:
    """i, j, mesh, n, max_y of meshes with enough vertices, in tiles without any mesh that is too high."""
    tile = Window.partitionBy("i", "j")
    judged = stats.withColumn("tile_max", F.max("max_y").over(tile)).crossJoin(F.broadcast(limit))  # one row
    return judged.where((F.col("tile_max") <= F.col("height_limit")) & (F.col("n") >= least)).select("i", "j", "mesh", "n", "max_y")


def tile_meshes(selection: DataFrame) -> DataFrame:
    """i, j, meshes: the meshes of each tile in order."""
    return selection.groupBy("i", "j").agg(F.sort_array(F.collect_list("mesh")).alias("meshes"))


def powerset(tiles: DataFrame, most: int = MOST_IN_TILE) -> DataFrame:
    """i, j, k, building_indices, ground_indices, name: all subsets of a tile's meshes and what is left.

    Subsets are numbered by size, then in lexical order, the empty one first. As 2 ** n rows come
    of n meshes, a tile with more than `most` raises an error; too_large tells which they are.
    Subsets are made by `AT_ONCE` of a tile, so no task holds them all before they are written.
    """
    n = F.size("meshes")
    bounded = F.when(n > most, F.raise_error(F.concat(F.lit(f"more than {most} meshes in tile "), "i", F.lit(" "), "j"))).otherwise(F.col("meshes"))
    one = F.lit(1).cast("long")
    upper = F.explode(F.sequence(one - 1, F.call_function("shiftleft", one, F.greatest(n - AT_ONCE, F.lit(0))) - 1)).alias("upper")
    lower = F.explode(F.sequence(one - 1, F.call_function("shiftleft", one, F.least(n, F.lit(AT_ONCE))) - 1)).alias("lower")
    bits = (F.col("upper") * (1 << AT_ONCE) + F.col("lower")).alias("bits")
    chosen = lambda on: F.filter("meshes", lambda _, at: (F.col("bits").bitwiseAND(F.call_function("shiftleft", one, at)) != 0) == F.lit(on))
    spread = tiles.select("i", "j", bounded.alias("meshes")).select("i", "j", "meshes", upper).select("i", "j", "meshes", "upper", lower)
    sets = spread.select("i", "j", "meshes", bits).select("i", "j", chosen(True).alias("building_indices"), chosen(False).alias("ground_indices"))
    order = Window.partitionBy("i", "j").orderBy(F.size("building_indices"), "building_indices")
    numbered = sets.withColumn("k", (F.row_number().over(order) - 1).cast("long"))
    return numbered.select("i", "j", "k", "building_indices", "ground_indices", F.concat_ws("_", "i", "j", "k").alias("name"))


def too_large(tiles: DataFrame, most: int = MOST_IN_TILE) -> DataFrame:
    """i, j, n of tiles with too many meshes to enumerate their subsets."""
    return tiles.where(F.size("meshes") > most).select("i", "j", F.size("meshes").alias("n"))


def overlapping_boxes(meshes: DataFrame, tiles: DataFrame, cell: float) -> DataFrame:
    """mesh, tile pairs whose boxes (min_x .. max_z) overlap in three dimensions.

    Both sides are repeated for the x and z cells they touch; a pair is taken in the cell of the
    larger of both lower corners only, so it comes once and no distinct is needed.
    """
    eps = predicates.EPS
    number = lambda c, add=0.0: F.floor((F.col(c) + F.lit(add)) / F.lit(cell)).cast("long")

    def celled(rows: DataFrame, side: str) -> DataFrame:
        renamed = rows.select(F.col(side), *[F.col(f"{e}_{a}").alias(f"{side}_{e}_{a}") for a in ("x", "y", "z") for e in ("min", "max")])
        for a in ("x", "z"):
            renamed = renamed.withColumn(f"cell_{a}", F.explode(F.sequence(number(f"{side}_min_{a}", -eps), number(f"{side}_max_{a}", eps))))
        return renamed

    both = celled(meshes, "mesh").join(celled(tiles, "tile"), ["cell_x", "cell_z"])
    box = lambda side: {a: (F.col(f"{side}_min_{a}"), F.col(f"{side}_max_{a}")) for a in ("x", "y", "z")}
    once = reduce(lambda p, a: p & (F.col(f"cell_{a}") == F.greatest(number(f"mesh_min_{a}", -eps), number(f"tile_min_{a}", -eps))), ("x", "z"), F.lit(True))
    return both.where(predicates.boxes_overlap(box("mesh"), box("tile")) & once).select("mesh", "tile")


def models_by_position(chunks: DataFrame, models: DataFrame, column: str = "building_indices") -> DataFrame:
    """name, models: the models at the listed positions of the natural order, in the order of the list.

    chunks: name and an array of positions; models: name. Positions outside are dropped.
    """
    from ..functions import scalar

    order = Window.orderBy(scalar.natural_key(F.col("model")), "model")
    placed = models.select(F.col("name").alias("model")).withColumn("position", (F.row_number().over(order) - 1).cast("long"))
    asked = chunks.select("name", F.posexplode(column).alias("at", "position"))
    found = asked.join(placed, "position").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("at", "model"))).alias("m"))
    return chunks.select("name").join(found, "name", "left").select("name", F.coalesce(F.transform("m", lambda s: s["model"]), F.array().cast("array<string>")).alias("models"))


def models_named(models: DataFrame, names: DataFrame) -> DataFrame:
    """The models whose name is listed."""
    return models.join(names, "name", "left_semi")


def faces_in_box(faces: DataFrame, vertices: DataFrame, low: dict[str, float], high: dict[str, float], rule: str = "any") -> DataFrame:
    """Faces (mesh, fid, idx) with any or all of their vertices (mesh, vid, x, y, z) in a closed box."""
    inside = predicates.in_box({a: F.col(a) for a in low}, {a: F.lit(v) for a, v in low.items()}, {a: F.lit(v) for a, v in high.items()})
    corners = join_made(faces.select("mesh", "fid", F.explode("idx").alias("vid")), vertices.select("mesh", "vid", inside.alias("inside")), ["mesh", "vid"])
    kept = corners.groupBy("mesh", "fid").agg((F.bool_or if rule == "any" else F.bool_and)("inside").alias("kept")).where("kept").select("mesh", "fid")
    return join_made(faces, kept, ["mesh", "fid"], "left_semi")


def meshes_inside(vertices: DataFrame, low: dict[str, float], high: dict[str, float]) -> DataFrame:
    """Meshes all of whose vertices are in a closed box."""
    inside = predicates.in_box({a: F.col(a) for a in low}, {a: F.lit(v) for a, v in low.items()}, {a: F.lit(v) for a, v in high.items()})
    return vertices.groupBy("mesh").agg(F.bool_and(inside).alias("inside")).where("inside").select("mesh")


def assign_round_robin(rows: DataFrame, key: str, workers: int) -> DataFrame:
    """key, worker: rows in the order of key dealt in turn."""
    return rows.select(key, F.pmod(F.row_number().over(Window.orderBy(key)) - 1, F.lit(workers)).cast("long").alias("worker"))


def assign_balanced(rows: DataFrame, key: str, workers: int) -> DataFrame:
    """key, worker: rows in the order of key in contiguous parts whose sizes differ by one at most."""
    return rows.select(key, (F.ntile(workers).over(Window.orderBy(key)) - 1).cast("long").alias("worker"))


def assign_batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """key, batch: rows in the order of key in parts of a fixed size."""
    return rows.select(key, F.floor((F.row_number().over(Window.orderBy(key)) - 1) / size).cast("long").alias("batch"))
