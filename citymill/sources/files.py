"""Files and names: listings, copy plans, lists, document and cloud formats."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from . import tensors


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, modified, length of every file below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), "length").orderBy("path")


def wanted(files: DataFrame, extensions: list[str], hidden: bool = False) -> DataFrame:
    """Files of the given extensions, hidden ones only if asked for."""
    normal = [scalar.normal_extension(F.lit(e)) for e in extensions]
    found = files.where(scalar.extension(F.col("path")).isin(*normal) if normal else F.lit(True))
    return found if hidden else found.where(~scalar.is_hidden(F.col("path")))


def copy_plan(source: DataFrame, target: DataFrame, extensions: list[str], overwrite: bool = False, hidden: bool = False) -> DataFrame:
    """path, action of each source file: copy, overwrite, exists, other_type or hidden. Nothing is copied here."""
    normal = [scalar.normal_extension(F.lit(e)) for e in extensions]
    there = target.select("path").distinct().withColumn("there", F.lit(True))
    rows = source.select("path").distinct().join(there, "path", "left")
    right = scalar.extension(F.col("path")).isin(*normal) if normal else F.lit(True)
    action = F.when(~right, "other_type").when(scalar.is_hidden(F.col("path")) & F.lit(not hidden), "hidden").when(F.col("there") & F.lit(not overwrite), "exists").when(F.col("there"), "overwrite").otherwise("copy")
    return rows.select("path", action.alias("action"))


def todo(inputs: DataFrame, outputs: DataFrame, key: str = "path", least_bytes: int = 0) -> DataFrame:
    """Inputs whose output is not there yet, or has fewer bytes than asked for."""
    done = outputs.where(F.col("length") >= least_bytes) if least_bytes else outputs
    return inputs.join(done.select(key), key, "left_anti")


def output_paths(paths: DataFrame, folder: str) -> DataFrame:
    """path with the places of its three outputs: sharp points, sampled points, normalised mesh."""
    stem, own = scalar.stem(F.col("path")), scalar.parent(F.col("path"))
    at = lambda kind, ending: F.concat_ws("/", F.lit(folder), F.lit(kind), scalar.base_name(own), F.concat(stem, F.lit(ending)))
    return paths.select("path", at("sharp", ".ply").alias("sharp"), at("points", ".npz").alias("points"), at("normal", ".obj").alias("normal"))


def lines_list(spark: SparkSession, path: str) -> DataFrame:
    """name of each line that is not blank."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def comma_list(text: str) -> list[str]:
    return [t.strip() for t in text.split(",") if t.strip()]


def json_list(spark: SparkSession, path: str) -> DataFrame:
    """path of each entry of a JSON array of strings."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>")).alias("path"))


def _documents(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


CHUNK = "position array<double>, size double, building_indices array<int>, building_names array<string>, ground_indices array<int>, ground_names array<string>, index array<int>, z_offset double"


def chunk_documents(spark: SparkSession, path: str, glob: str = "data.yaml", size: float = 100.0) -> DataFrame:
    """path, chunk_id, raw, error and the typed fields of each chunk's metadata; defaults where keys are missing.

    raw keeps the whole mapping as JSON, so keys that are not typed pass through.
    """
    names = [f.split()[0] for f in CHUNK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("raw", pa.string()), ("error", pa.string()), ("position", pa.list_(pa.float64())), ("size", pa.float64()), *((n, pa.list_(pa.int32() if n.endswith("indices") else pa.string())) for n in names[2:6]), ("index", pa.list_(pa.int32())), ("z_offset", pa.float64())])
        for batch in batches:
            out = []
            for p, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                row = dict.fromkeys([*names, "error"]) | {"path": p, "raw": None}
                try:
                    d = yaml.safe_load(text) or {}
                    position = [float(v) for v in d.get("position", [])]
                    if len(position) != 3:
                        raise ValueError("position needs three numbers")
                    row |= {"raw": json.dumps(d), "position": position, "size": float(d.get("size", size)), "z_offset": float(d.get("z_offset", 0.0))}
                    row |= {n: [int(v) for v in d.get(n) or []] for n in ("building_indices", "ground_indices", "index")}
                    row |= {n: [str(v) for v in d.get(n) or []] for n in ("building_names", "ground_names")}
                except (ValueError, TypeError, AttributeError, yaml.YAMLError) as e:
                    row["error"] = str(e)
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    rows = _documents(spark, path, glob).mapInArrow(run, f"path string, raw string, error string, {CHUNK}")
    return rows.withColumn("chunk_id", scalar.base_name(scalar.parent(F.col("path")))).orderBy("index", "path")


def pair_documents(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """path, t1, t2, condition, position of each pair of each list."""
    schema = pa.schema([(n, pa.string()) for n in ("path", "t1", "t2", "condition", "position")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist([{"path": p} | {n: e.get(n) for n in schema.names[1:]} for e in yaml.safe_load(text) or []], schema=schema)

    return _documents(spark, path, glob).mapInArrow(run, "path string, t1 string, t2 string, condition string, position string")


def footprint_documents(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """path, idx, name, height, contour, error of each entry; both forms (bottom_contour, footprint) and a single mapping are read.

    A file without entries gives no row; an entry without a contour has an empty one and an error.
    """
    point = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])
    schema = pa.schema([("path", pa.string()), ("idx", pa.int64()), ("name", pa.string()), ("height", pa.float64()), ("contour", pa.list_(point)), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                try:
                    loaded = yaml.safe_load(text) or []
                except yaml.YAMLError as e:
                    out.append({"path": p, "idx": -1, "contour": [], "error": str(e)})
                    continue
                for at, e in enumerate([loaded] if isinstance(loaded, dict) else loaded):
                    ring = e.get("bottom_contour", e.get("footprint")) or []
                    error = None if ring else "there is no contour"
                    try:
                        contour = [dict(zip("xyz", map(float, q), strict=True)) for q in ring]
                        height = float(e.get("height", 0.0))
                    except (TypeError, ValueError) as x:
                        contour, height, error = [], 0.0, str(x)
                    out.append({"path": p, "idx": at, "name": str(e.get("name", e.get("mesh_id", at))), "height": height, "contour": contour, "error": error})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _documents(spark, path, glob).mapInArrow(run, "path string, idx long, name string, height double, contour array<struct<x:double,y:double,z:double>>, error string")


def cloud_files(spark: SparkSession, path: str, glob: str = "*.{ply,npz,pt}", key: str = "fps_points") -> DataFrame:
    """cloud, pid, x, y, z of PLY files (ASCII or little-endian binary), NPZ files (array `key`, else points, xyz or pos) and tensor files.

    A file that cannot be read fails with its name; clouds in Parquet need no reader of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                xyz = ply_points(content) if content[:3] == b"ply" else tensors.points(content) if p.endswith(".pt") else npz_points(content, key)
                if xyz.ndim != 2 or xyz.shape[1] < 3:
                    raise ValueError(f"{p}: points need three coordinates")
                name = p.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(xyz)), pa.array(range(len(xyz)), pa.int64()), *(pa.array(xyz[:, k].astype(np.float32)) for k in range(3))], ["cloud", "pid", "x", "y", "z"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInArrow(run, "cloud string, pid long, x float, y float, z float")


def npz_points(content: bytes, key: str) -> np.ndarray:
    with np.load(io.BytesIO(content)) as data:
        return data[next(k for k in (key, "points", "xyz", "pos") if k in data)]


def ply_points(content: bytes) -> np.ndarray:
    head, _, body = content.partition(b"end_header\n")
    lines = head.decode("ascii").split("\n")
    n = next(int(t.split()[2]) for t in lines if t.startswith("element vertex"))
    kinds = {"float": "<f4", "double": "<f8", "uchar": "u1", "int": "<i4", "float32": "<f4", "float64": "<f8", "uint8": "u1"}
    start = next(k for k, t in enumerate(lines) if t.startswith("element vertex"))
    fields = []
    for t in lines[start + 1 :]:
        if t.startswith("element"):
            break
        if t.startswith("property"):
            fields.append((t.split()[2], kinds[t.split()[1]]))
    if "format ascii" in head.decode("ascii"):
        rows = np.array([r.split() for r in body.decode("ascii").split("\n")[:n]], float).reshape(n, -1)
        return rows[:, [[f for f, _ in fields].index(a) for a in "xyz"]]
    rows = np.frombuffer(body, np.dtype(fields), n)
    return np.column_stack([rows[a] for a in "xyz"])
