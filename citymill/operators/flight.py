"""Camera flights over a scene: sample lines, serpentine paths, headings, rigs."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar

#: (suffix, yaw added, pitch) of each camera.
NADIR = (("N", 0.0, -90.0),)
FIVE = (*NADIR, ("F", 0.0, -45.0), ("R", 90.0, -45.0), ("B", 180.0, -45.0), ("L", -90.0, -45.0))


@dataclass(frozen=True)
class Scene:
    xmin: float
    xmax: float
    ymin: float
    ymax: float
    zmin: float
    zmax: float

    def __post_init__(self) -> None:
        for a in "xz":
            if not getattr(self, f"{a}max") > getattr(self, f"{a}min"):
                raise ValueError(f"{a}max must be above {a}min")
        if self.ymax < self.ymin:
            raise ValueError("ymax must not be below ymin")  # a scene may be flat


def line_samples(lines: DataFrame) -> DataFrame:
    """lines (start, stop, step) with position and x of each sample, in order.

    There are max(1, ceil(length / step)) steps; samples never pass the end; a line without
    length has one sample; the direction is that from start to stop.
    """
    length = F.abs(F.col("stop") - F.col("start"))
    count = F.greatest(F.lit(1), F.ceil(length / F.col("step")).cast("int"))
    places = F.when(length == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), count))
    sign = F.when(F.col("stop") >= F.col("start"), 1.0).otherwise(-1.0)
    return lines.withColumn("position", F.explode(places)).withColumn("x", F.col("start") + sign * F.least(F.col("position") * F.col("step"), length))


def serpentine(spark: SparkSession, scene: Scene, height: float, along: float, cross: float, prefix: str = "P") -> DataFrame:
    """idx, name, row, position, x, y, z, yaw: rows at cross distance, flown in turn in both directions.

    There is room for ceil(dz / cross) + 1 rows; the first stands half of what all but two of
    their distances leave of dz behind zmin, at zmin itself if they leave nothing, and no row
    lies behind zmax. The heading is that to the next sample, for the last that of the one before.
    """
    along, cross = scalar.positive(float(along), "along"), scalar.positive(float(cross), "cross")
    dz = scene.zmax - scene.zmin
    room = max(1, math.ceil(dz / cross) + 1)
    start = scene.zmin + max(0.0, (dz - (room - 2) * cross) / 2)
    rows = spark.range(room).select(F.col("id").cast("int").alias("row"), (F.lit(start) + F.col("id") * F.lit(cross)).alias("z")).where((F.col("row") == 0) | (F.col("z") <= scene.zmax))
    forth = F.col("row") % 2 == 0
    ends = rows.select("row", scalar.clamp(F.col("z"), scene.zmin, scene.zmax).alias("z"), F.when(forth, scene.xmin).otherwise(scene.xmax).alias("start"), F.when(forth, scene.xmax).otherwise(scene.xmin).alias("stop"), F.lit(along).alias("step"))
    in_row = max(1, math.ceil((scene.xmax - scene.xmin) / along)) + 1  # samples, the same in every row
    poses = line_samples(ends).withColumn("idx", F.col("row").cast("long") * in_row + F.col("position"))
    return headings(poses.select("idx", scalar.numbered(F.lit(prefix), F.col("idx")).alias("name"), "row", "position", "x", F.lit(float(height)).alias("y"), "z"))


def headings(poses: DataFrame, order: str = "idx") -> DataFrame:
    """poses with yaw in degrees towards the next pose; the last keeps the heading it came with; one alone has 0."""
    w = Window.orderBy(order)
    ahead = (F.lead("x").over(w) - F.col("x"), F.lead("z").over(w) - F.col("z"))
    behind = (F.col("x") - F.lag("x").over(w), F.col("z") - F.lag("z").over(w))
    angle = lambda d: F.degrees(F.atan2(d[1], d[0]))
    return poses.withColumn("yaw", scalar.wrap_degrees(F.coalesce(angle(ahead), angle(behind), F.lit(0.0))))


def rig(poses: DataFrame, cameras: tuple[tuple[str, float, float], ...] = NADIR, with_heading: bool = False) -> DataFrame:
    """name, x, y, z, yaw, pitch, roll of each picture of each pose; cameras keep a fixed yaw in the world, or turn with the heading."""
    heading = F.col("yaw") if with_heading else F.lit(0.0)
    camera = F.explode(F.array(*[F.struct(F.lit(s).alias("suffix"), F.lit(y).alias("turn"), F.lit(p).alias("pitch")) for s, y, p in cameras]))
    shots = poses.withColumn("camera", camera)
    return shots.select(F.format_string("%s_%s.png", "name", "camera.suffix").alias("name"), "x", "y", "z", scalar.wrap_degrees(heading + F.col("camera.turn")).alias("yaw"), F.col("camera.pitch").alias("pitch"), F.lit(0.0).alias("roll"))


def manifest(shots: DataFrame) -> DataFrame:
    """A text line for each picture: name x y z yaw pitch roll with three digits."""
    return shots.select(F.concat_ws(" ", "name", *[scalar.fixed(F.col(c), 3) for c in ("x", "y", "z", "yaw", "pitch", "roll")]).alias("value"))
