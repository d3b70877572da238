"""Every plan against its SQL twin; plans without one must give rows of a stable schema."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import __spark_entry__
from citymill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_plan_equals_sql(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    result = duck.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_kernel_gives_rows(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_range_join_has_no_nested_loop_over_tiles(spark, sf_dir):
    plan = catalog.QUERIES["tile_mesh_stats"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Exchange hashpartitioning") <= 2


def test_entry_imports_and_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("gone", [("citymill/llm", "tests/llm", "corpus_pipeline.py"), ("citymill/llm", "tests/llm")])
def test_entry_works_without_the_removable_part(tmp_path, gone):
    root, copy = Path(__spark_entry__.__file__).parent, tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for name in gone:
        if (copy / name).exists():
            (shutil.rmtree if (copy / name).is_dir() else Path.unlink)(copy / name)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 60 and set(e.oracle_sql()) <= set(e.queries()); assert not any(n.startswith('op1') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})


@pytest.mark.parametrize("name", ["bottom_contour", "clipped_triangles", "faces_in_cube_any", "sharp_sample", "surface_sample", "faces_in_cube_all", "jittered_sample", "loose_geometry", "sdf_probe", "sharp_edge_counts", "voxel_surface"])
def test_made_rows_are_not_broadcast(spark, sf_dir, name):
    """The estimated size of exploded rows says nothing about their real size."""
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_camera_rig_equals_sql_above_four_digits(spark, tmp_path):
    import duckdb

    spark.range(9_998, 10_012).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    df = catalog.QUERIES["camera_rig"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM read_parquet('{tmp_path}/supplier.parquet/*.parquet')")
    result = con.execute(catalog.ORACLE_SQL["camera_rig"])
    columns = [d[0] for d in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
