"""Spark-first analytics over 3-D city meshes, tiles, point clouds and flight paths."""
