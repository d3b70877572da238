"""Session settings and table readers shared by every plan."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("citymill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided Parquet tables; any store that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
