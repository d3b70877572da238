"""Bounds, extents, counts and rankings of meshes, clouds and footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar

AXES = ("x", "y", "z")


def _bounds() -> list[Column]:
    """min and max of each axis; NaN is left out, as it is neither smaller nor larger than a number."""
    known = lambda a: F.when(~F.isnan(a), F.col(a))
    return [f(known(a)).alias(f"{n}_{a}") for a in AXES for n, f in (("min", F.min), ("max", F.max))]


def bounds(vertices: DataFrame, key: str = "mesh", more: tuple[Column, ...] = ()) -> DataFrame:
    """key, min and max of x, y and z, and more aggregates: one shuffle of partial results."""
    return vertices.groupBy(key).agg(*more, *_bounds())


def bounds_with_summary(vertices: DataFrame, key: str = "mesh") -> DataFrame:
    """As bounds, and a row for all together (scope 'all', key null), from the bounds of each."""
    own = bounds(vertices, key)
    total = own.agg(*[f(f"{n}_{a}").alias(f"{n}_{a}") for a in AXES for n, f in (("min", F.min), ("max", F.max))])
    kind = own.schema[key].dataType
    return own.withColumn("scope", F.lit("one")).unionByName(total.withColumn(key, F.lit(None).cast(kind)).withColumn("scope", F.lit("all")))


def world_bounds(boxes: DataFrame, matrix: list[list[float]]) -> DataFrame:
    """Bounds of boxes after a 4 x 4 matrix: those of their eight transformed corners."""
    out = []
    for row, axis in zip(matrix, AXES, strict=False):
        ends = [(F.col(f"min_{a}") * m, F.col(f"max_{a}") * m) for a, m in zip(AXES, row, strict=False)]
        out.append((sum((F.least(*e) for e in ends), F.lit(row[3]))).alias(f"min_{axis}"))
        out.append((sum((F.greatest(*e) for e in ends), F.lit(row[3]))).alias(f"max_{axis}"))
    others = [c for c in boxes.columns if not c.startswith(("min_", "max_"))]
    return boxes.select(*others, *out)


def extents(vertices: DataFrame, key: str = "mesh") -> DataFrame:
    return bounds(vertices, key).select(key, *[(F.col(f"max_{a}") - F.col(f"min_{a}")).alias(f"extent_{a}") for a in AXES])


def above_threshold(vertices: DataFrame, threshold: float, key: str = "mesh") -> DataFrame:
    """Extents of the meshes that exceed the threshold on all three axes."""
    return extents(vertices, key).where(" AND ".join(f"extent_{a} > {threshold!r}D" for a in AXES))


def height_counts(vertices: DataFrame, threshold: float, key: str = "mesh") -> DataFrame:
    """One row: meshes in total, higher than the threshold, and without a height."""
    heights = vertices.groupBy(key).agg((F.max("y") - F.min("y")).alias("height"))
    return heights.agg(F.count("*").alias("total"), F.count_if(F.col("height") > threshold).alias("exceeding"), F.count_if(F.col("height").isNull()).alias("skipped"))


def axis_maxima(points: DataFrame, threshold: float, key: str = "cloud") -> DataFrame:
    """Largest coordinate of each axis of each cloud, and whether one is above the threshold."""
    most = points.groupBy(key).agg(*[F.max(a).alias(f"max_{a}") for a in AXES])
    return most.withColumn("above", F.greatest(*[F.col(f"max_{a}") for a in AXES]) > threshold)


def worst_coordinate(footprints: DataFrame, key: str = "path") -> DataFrame:
    """For each file: the largest of |x| and |z| over all contours and the first entry that has it.

    footprints: key, idx, contour (array of structs with x and z). A file without any point has
    (0.0, -1).
    """
    reach = F.array_max(F.transform("contour", lambda p: F.greatest(F.abs(p["x"]), F.abs(p["z"]))))
    best = footprints.withColumn("reach", reach).groupBy(key).agg(F.max(F.when(F.col("reach").isNotNull(), F.struct("reach", (-F.col("idx")).alias("back")))).alias("best"))
    return best.select(key, F.coalesce("best.reach", F.lit(0.0)).alias("worst"), F.coalesce(-F.col("best.back"), F.lit(-1)).cast("long").alias("entry"))


def top_offenders(worst: DataFrame, threshold: float, k: int, key: str = "path") -> DataFrame:
    """The k files farthest above the threshold; remainder: how many more there are."""
    over = worst.where(F.col("worst") > threshold)
    total = over.agg(F.count("*").alias("n"))
    top = over.orderBy(F.desc("worst"), key).limit(k)
    return top.crossJoin(F.broadcast(total)).select(*worst.columns, F.greatest(F.col("n") - k, F.lit(0)).cast("long").alias("remainder"))


def status_counts(outcomes: DataFrame) -> DataFrame:
    """status, n of rows that carry a status."""
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def first_failures(outcomes: DataFrame, k: int = 10, key: str = "path") -> DataFrame:
    """The first k failures in the order of their paths."""
    return outcomes.where("status = 'failed'").orderBy(key).limit(k)


def bbox_text(row: DataFrame, key: str = "mesh") -> DataFrame:
    """A line for each box: x, y and z bounds with six digits."""
    pairs = [F.concat(F.lit(f"{a}: ["), scalar.fixed(F.col(f"min_{a}")), F.lit(", "), scalar.fixed(F.col(f"max_{a}")), F.lit("]")) for a in AXES]
    return row.select(key, F.concat_ws(" ", *pairs).alias("line"))
