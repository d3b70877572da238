"""The provided tables seen as meshes, clouds, listings and footprints; the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

VERTICES_SQL = """vertices AS (
  SELECT l_suppkey AS mesh, (l_suppkey % 10) * 50 + l_quantity AS x, l_discount * 100 * (1 + l_suppkey % 12) AS y,
         (l_suppkey // 10) * 100 + l_extendedprice / 1000 AS z FROM lineitem)"""
POINTS_SQL = """points AS (
  SELECT label AS cloud, vec_id AS pid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z
  FROM embeddings)"""
OBJ_LINES_SQL = """obj_lines AS (
  SELECT 'city/mesh_' || l_suppkey || '.obj' AS path, l_orderkey * 10 + l_linenumber AS line_no, CASE
    WHEN l_orderkey % 23 = 0 THEN 'vn ' || q || ' ' || d || ' ' || p WHEN l_orderkey % 23 = 1 THEN '  v ' || q || ' ' || d || ' ' || p
    WHEN l_orderkey % 23 = 2 THEN 'v ' || q || ' ' || d WHEN l_orderkey % 23 = 3 AND l_suppkey % 5 = 0 THEN 'v 1.0f ' || d || ' ' || p
    WHEN l_orderkey % 23 = 4 THEN 'v nan ' || d || ' ' || p ELSE 'v ' || q || ' ' || d || ' ' || p END AS value
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q, CAST(round(l_discount * 100) AS INTEGER) AS d, CAST(floor(l_extendedprice) AS BIGINT) AS p FROM lineitem))"""
FOOTPRINTS_SQL = """footprints AS (
  SELECT 'f_' || o_custkey AS path, o_orderkey AS idx, (o_orderkey % 97) - 48.5e0 AS x1, o_totalprice / 1000 AS z1, (o_custkey % 31) * 1.5e0 AS x2, -(o_orderkey % 13) * 2e0 AS z2
  FROM orders)"""
LISTING_SQL = """listing AS (SELECT page_id AS id, regexp_replace(url, '^[a-z]+://[^/]+/', '') AS path FROM pages)"""


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mesh, x, y, z (y is up): each line item is a vertex of its supplier's mesh."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("mesh"),
        ((F.col("l_suppkey") % 10) * 50 + F.col("l_quantity")).alias("x"),
        (F.col("l_discount") * 100 * (1 + F.col("l_suppkey") % 12)).alias("y"),
        (F.expr("l_suppkey div 10") * 100 + F.col("l_extendedprice") / 1000).alias("z"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cloud, pid, x, y, z: the first three components of each vector."""
    axis = lambda k: F.get("embedding", F.lit(k)).cast("double")
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("cloud"), F.col("vec_id").alias("pid"), axis(0).alias("x"), axis(1).alias("y"), axis(2).alias("z"))


def obj_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, line_no, value: mesh text with normals, indented, short, unreadable and nan lines among its vertices."""
    q, d, p = F.col("l_quantity").cast("int").cast("string"), F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.floor("l_extendedprice").cast("long").cast("string")
    kind, line = F.col("l_orderkey") % 23, lambda lead, *parts: F.concat_ws(" ", F.lit(lead), *parts)
    value = (
        F.when(kind == 0, line("vn", q, d, p))
        .when(kind == 1, line("  v", q, d, p))
        .when(kind == 2, line("v", q, d))
        .when((kind == 3) & (F.col("l_suppkey") % 5 == 0), line("v 1.0f", d, p))
        .when(kind == 4, line("v nan", d, p))
        .otherwise(line("v", q, d, p))
    )
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("city/mesh_"), "l_suppkey", F.lit(".obj")).alias("path"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"), value.alias("value"))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, idx, contour (two points): each order is a footprint in its customer's file."""
    point = lambda x, z: F.struct(x.cast("double").alias("x"), F.lit(0.0).alias("y"), z.cast("double").alias("z"))
    first = point((F.col("o_orderkey") % 97) - 48.5, F.col("o_totalprice") / 1000)
    second = point((F.col("o_custkey") % 31) * 1.5, -(F.col("o_orderkey") % 13) * 2.0)
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("f_"), "o_custkey").alias("path"), F.col("o_orderkey").alias("idx"), F.array(first, second).alias("contour"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, path: pages as files."""
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.regexp_replace("url", "^[a-z]+://[^/]+/", "").alias("path"))
