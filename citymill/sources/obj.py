"""Mesh text as tables: vertices, faces, and the rules by which lines are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import metrics

AXES = ("x", "y", "z")


def read_lines(spark: SparkSession, path: str, glob: str = "*.[oO][bB][jJ]") -> DataFrame:
    """path, line_no, value of every mesh file below a folder; whole files are read, so lines have numbers."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True)
    lines = F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value")
    return files.select(F.col("_metadata.file_path").alias("path"), "value").select("path", lines)


def strict_vertices(lines: DataFrame) -> DataFrame:
    """path, line_no, x, y, z of lines that begin with 'v ' and have three readable numbers; others are skipped.

    The numbers are one array, so the filter, which is pushed below the projection, splits a line
    once and not once for each number.
    """
    numbers = F.filter(F.transform(F.slice(F.split(F.trim("value"), r"\s+"), 2, 3), scalar.number), lambda n: n.isNotNull())
    rows = lines.where(F.col("value").startswith("v ")).select("path", "line_no", numbers.alias("_n")).where(F.size("_n") == 3)
    return rows.select("path", "line_no", *[F.col("_n")[k].alias(a) for k, a in enumerate(AXES)])


def vertex_heights(lines: DataFrame) -> DataFrame:
    """path, y of lines that begin with 'v ' and whose second number is readable."""
    rows = lines.where(F.col("value").startswith("v ")).withColumn("_p", F.split(F.trim("value"), r"\s+")).where(F.size("_p") >= 4)
    return rows.select("path", scalar.number(F.col("_p")[2]).alias("y")).where("y IS NOT NULL")


def lenient_numbers(lines: DataFrame) -> DataFrame:
    """path, line_no, x, y, z of lines that begin with 'v ' after any indent; null where a number is unreadable."""
    rows = lines.where(F.ltrim("value").startswith("v ")).withColumn("_p", F.split(F.trim("value"), r"\s+")).where(F.size("_p") >= 4)
    return rows.select("path", "line_no", *[scalar.number(F.col("_p")[k + 1]).alias(a) for k, a in enumerate(AXES)])


UNREADABLE = "x IS NULL OR y IS NULL OR z IS NULL"


def lenient_vertices(lines: DataFrame) -> DataFrame:
    """lenient_numbers without the files that have an unreadable number."""
    numbers = lenient_numbers(lines)
    return numbers.join(numbers.where(UNREADABLE).select("path").distinct(), "path", "left_anti")


def lenient_bounds(lines: DataFrame) -> DataFrame:
    """path, n and bounds of the files of lenient_vertices, in one pass."""
    found = metrics.bounds(lenient_numbers(lines), "path", (F.count("*").alias("n"), F.bool_or(F.expr(UNREADABLE)).alias("_bad")))
    return found.where("NOT _bad").drop("_bad")


def has_vertices(lines: DataFrame) -> DataFrame:
    """path, has_vertices."""
    return lines.groupBy("path").agg(F.bool_or(F.col("value").startswith("v ")).alias("has_vertices"))


def vertices(lines: DataFrame) -> DataFrame:
    """mesh, vid, x, y, z: vertices numbered from 0 in the order of the lines of their file; mesh is the file's path."""
    rows = strict_vertices(lines).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("line_no", *AXES))).alias("v"))
    return rows.select(F.col("path").alias("mesh"), F.posexplode("v").alias("vid", "v")).select("mesh", F.col("vid").cast("long").alias("vid"), *[F.col(f"v.{a}").alias(a) for a in AXES])


def faces(lines: DataFrame) -> DataFrame:
    """mesh, fid, idx: faces as vertex numbers from 0; negative numbers count from the last vertex before the line."""
    rows = lines.where(F.col("value").rlike(r"^\s*(v|f) "))
    kind = F.col("value").rlike(r"^\s*v ").cast("int")
    numbers = F.transform(F.filter(F.split(F.trim("value"), r"\s+"), lambda p, i: i > 0), lambda p: F.split(p, "/")[0].try_cast("int"))
    seen = F.sum(kind).over(Window.partitionBy("path").orderBy("line_no"))  # one file; files are of bounded size
    counted = rows.withColumn("_seen", seen).where(F.col("value").rlike(r"^\s*f ")).withColumn("_n", numbers)
    placed = counted.where(F.size("_n") >= 3).where(F.forall("_n", lambda n: n.isNotNull() & (n != 0)))
    order = Window.partitionBy("path").orderBy("line_no")
    return placed.select(F.col("path").alias("mesh"), (F.row_number().over(order) - 1).cast("long").alias("fid"), F.transform("_n", lambda n: F.when(n > 0, n - 1).otherwise(F.col("_seen").cast("int") + n)).alias("idx"))


def object_names(lines: DataFrame) -> DataFrame:
    """path, name: the file's name up to its first dot."""
    return lines.select("path").distinct().select("path", scalar.object_name(F.col("path")).alias("name"))


def mesh_outcomes(lines: DataFrame, threshold: float) -> DataFrame:
    """path, extents, fits, status, error of each file; a file without vertices fails as a row, not as a job."""
    sized = metrics.extents(strict_vertices(lines).withColumnRenamed("path", "mesh")).withColumnRenamed("mesh", "path")
    all_ = lines.select("path").distinct().join(sized, "path", "left")
    fits = (F.col("extent_x") > threshold) & (F.col("extent_y") > threshold) & (F.col("extent_z") > threshold)
    failed = F.col("extent_y").isNull()
    return all_.select("path", "extent_x", "extent_y", "extent_z", F.coalesce(fits, F.lit(False)).alias("fits"), F.when(failed, "failed").when(fits, "qualified").otherwise("below").alias("status"), F.when(failed, "no vertices").alias("error"))
