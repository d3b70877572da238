"""Reports and files out of tables: text reports, mesh text, clouds, documents.

Spark writes the data; one driver-side step adds what a format wants around it. Mesh, cloud and
document files are written by the tasks that hold their rows, one group for each file.
"""

from __future__ import annotations

import io
import os
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from . import tensors


def threshold_report(outcomes: DataFrame, threshold: float) -> DataFrame:
    """value: three header lines, then path and extents of each qualifying file, parted by tabs, in order."""
    totals = outcomes.agg(F.count("*").alias("total"), F.count_if("fits").alias("qualified"))
    head = totals.select(F.posexplode(F.array(F.lit(f"# threshold\t{threshold:.6f}"), F.concat(F.lit("# total_files\t"), "total", F.lit("\tqualified\t"), "qualified"), F.lit("path\textent_x\textent_y\textent_z"))).alias("at", "value"))
    rows = outcomes.where("fits").select(F.lit(3).alias("at"), F.concat_ws("\t", "path", *[scalar.fixed(F.col(f"extent_{a}")) for a in "xyz"]).alias("value"))
    return head.unionByName(rows).orderBy("at", "value").select("value")


def loose_report(found: DataFrame, errors: DataFrame) -> DataFrame:
    """value: a section of meshes with loose parts, then one of files that failed (path, error)."""
    hits = found.where("has_loose").select(F.lit(1).alias("part"), F.format_string("%s\tpoints=%d\tlines=%d", F.col("mesh").cast("string"), "loose_points", "loose_lines").alias("value"))
    failed = errors.select(F.lit(3).alias("part"), F.concat_ws("\t", "path", "error").alias("value"))
    head = found.sparkSession.createDataFrame([(0, "loose parts"), (2, "failures")], "part int, value string")
    return head.unionByName(hits).unionByName(failed).orderBy("part", "value").select("value")


def write_lines(lines: DataFrame, path: str) -> None:
    """A text file's lines; the order of the rows is kept over the parts."""
    lines.write.mode("overwrite").text(path)


def json_paths(paths: DataFrame) -> DataFrame:
    """value: a JSON array of the paths in order; one row, for lists that fit one file."""
    return paths.agg(F.to_json(F.sort_array(F.collect_list("path"))).alias("value"))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunk metadata as one table, partitioned by tile so that readers of a tile read its files only."""
    chunks.write.mode("overwrite").partitionBy("i", "j").parquet(path)


def obj_text(vertices: DataFrame, faces: DataFrame, file: str = "file", mesh: str = "mesh") -> DataFrame:
    """file, at, value: mesh text of each file: o, v and f lines, face numbers running on over its meshes.

    vertices: file, mesh, vid, x, y, z; faces: file, mesh, fid, idx.
    """
    counts = vertices.groupBy(file, mesh).agg(F.count("*").alias("n"))
    before = Window.partitionBy(file).orderBy(mesh).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select(file, mesh, "first")
    heads = counts.select(file, mesh, F.lit(0).alias("part"), F.lit(0).cast("long").alias("at"), F.concat(F.lit("o "), F.col(mesh).cast("string")).alias("value"))
    points = vertices.select(file, mesh, F.lit(1).alias("part"), F.col("vid").cast("long").alias("at"), F.concat_ws(" ", F.lit("v"), *[scalar.fixed(F.col(a)) for a in "xyz"]).alias("value"))
    rings = faces.join(offsets, [file, mesh]).select(file, mesh, F.lit(2).alias("part"), F.col("fid").cast("long").alias("at"), F.concat(F.lit("f "), F.array_join(F.transform("idx", lambda i: (i + F.col("first") + 1).cast("string")), " ")).alias("value"))
    return heads.unionByName(points).unionByName(rings)


def write_obj(lines: DataFrame, folder: str, file: str = "file", mesh: str = "mesh") -> DataFrame:
    """Writes obj_text to {folder}/{file}.obj, a folder that driver and executors share; file, bytes, status of each."""

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by([(mesh, "ascending"), ("part", "ascending"), ("at", "ascending")])
        name = str(table.column(file)[0].as_py())
        return _written(name, os.path.join(folder, f"{name}.obj"), ["\n".join(table.column("value").to_pylist()).encode() + b"\n"])

    return lines.groupBy(file).applyInArrow(write, "file string, bytes long, status string")


def _written(name: str, path: str, parts: Iterable[bytes]) -> pa.Table:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = b"".join(parts)
    with open(f"{path}.part", "wb") as out:  # a lost executor leaves no half file under the name
        out.write(data)
    os.replace(f"{path}.part", path)
    return pa.table({"file": [name], "bytes": pa.array([len(data)], pa.int64()), "status": ["written"]})


def ply_bytes(points: list[tuple[float, float, float]], binary: bool = True, coloured: bool = False) -> bytes:
    """A PLY cloud; coloured: red, green and blue are (v + 1) / 2 of each coordinate."""
    kinds = ["float x", "float y", "float z", *(["uchar red", "uchar green", "uchar blue"] if coloured else [])]
    head = "\n".join(["ply", f"format {'binary_little_endian' if binary else 'ascii'} 1.0", f"element vertex {len(points)}", *(f"property {k}" for k in kinds), "end_header"]) + "\n"
    shade = lambda v: max(0, min(255, round((v + 1) / 2 * 255)))
    rows = [(*p, *map(shade, p)) if coloured else tuple(p) for p in points]
    if binary:
        return head.encode() + b"".join(struct.pack("<fff" + "BBB" * coloured, *r) for r in rows)
    return (head + "".join(" ".join(f"{v:.6f}" if k < 3 else str(v) for k, v in enumerate(r)) + "\n" for r in rows)).encode()


def write_ply(points: DataFrame, folder: str, binary: bool = True, coloured: bool = False) -> DataFrame:
    """Writes each cloud (cloud, pid, x, y, z) to {folder}/{cloud}.ply; file, bytes, status of each."""

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        name = str(table.column("cloud")[0].as_py())
        rows = list(zip(*(table.column(a).to_pylist() for a in "xyz"), strict=True))
        return _written(name, os.path.join(folder, f"{name}.ply"), [ply_bytes(rows, binary, coloured)])

    return points.select("cloud", "pid", "x", "y", "z").groupBy("cloud").applyInArrow(write, "file string, bytes long, status string")


def write_arrays(points: DataFrame, folder: str, kind: str = "npz", key: str = "fps_points") -> DataFrame:
    """Writes each cloud (cloud, pid, x, y, z and any further number columns) as single-precision rows; file, bytes, status of each.

    kind npz: an array under `key` in a compressed NPZ file; kind pt: a tensor file.
    """
    if kind not in ("npz", "pt"):
        raise ValueError(f"npz or pt, not {kind!r}")
    columns = ["x", "y", "z", *(c for c in points.columns if c not in ("cloud", "pid", "x", "y", "z"))]

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        name = str(table.column("cloud")[0].as_py())
        rows = np.column_stack([table.column(c).to_numpy().astype(np.float32) for c in columns])
        return _written(name, os.path.join(folder, f"{name}.{kind}"), [tensors.dump(rows) if kind == "pt" else npz_bytes({key: rows})])

    return points.select("cloud", "pid", *columns).groupBy("cloud").applyInArrow(write, "file string, bytes long, status string")


def npz_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A compressed NPZ file of named arrays."""
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def write_documents(rows: DataFrame, folder: str, name: str = "name") -> DataFrame:
    """Writes each row as YAML to {folder}/{name}.yaml; file, bytes, status of each. Arrays and structs become lists and mappings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = str(row.pop(name))
                text = yaml.safe_dump({k: v for k, v in row.items() if v is not None}, sort_keys=False, allow_unicode=True)
                yield from _written(own, os.path.join(folder, f"{own}.yaml"), [text.encode()]).to_batches()

    return rows.mapInArrow(run, "file string, bytes long, status string")


def footprint_lists(folders: DataFrame, entries: DataFrame, key: str = "path") -> DataFrame:
    """key, entries: the footprints of each folder; an empty list where it has none."""
    point = lambda p: F.array(p["x"], p["y"], p["z"])
    rows = entries.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", "name", F.transform("contour", point).alias("bottom_contour"), "height"))).alias("entries"))
    kind = rows.schema["entries"].dataType.simpleString()
    return folders.select(key).distinct().join(rows, key, "left").select(key, F.coalesce("entries", F.array().cast(kind)).alias("entries"))
