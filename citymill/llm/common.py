"""What the operators of this subpackage share: tokens, hashes, Arrow maps, checkpoints."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent.parent.parent)

#: Words of the contracts: runs of anything but space and the five ASCII controls 9 to 13.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_az(text: str) -> str:
    """Lower-cases A to Z only, so that every engine agrees on the result."""
    return text.translate(_AZ) if not text.isascii() else text.lower()


def words(text: str) -> list[str]:
    return WORD.findall(text)


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package, and gives checkpoints a folder.

    The folder is the one that the cluster names in spark.checkpoint.dir; only where that is
    unset, as in a local test, one is made here.
    """
    sc = spark.sparkContext
    known = sc.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, known]).strip(os.pathsep)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints, which driver and executors share."""
    return prepare(spark).sparkContext._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends, and so do the size estimates of its joins."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def release() -> None:
    """Gives freed memory back to the system: Python workers stay for later stages, their heaps should not."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and then its memory is released, at the end of each task."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return own


def forget(shared: Broadcast) -> None:
    """Drops what a worker made of a broadcast; a later task reads it again.

    Workers are taken in turn and there are more of them than cores, so those that wait would
    hold a large value each.
    """
    if getattr(shared, "_path", None):  # a file to read again
        shared.__dict__.pop("_value", None)


def slices(batches: Iterator[pa.RecordBatch], chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their text or html has about so many bytes; a longer text is a batch of its own."""
    for batch in batches:
        name = next((n for n in ("text", "html") if n in batch.schema.names), None)
        if name is None:
            yield batch
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + chars, "right")))
            yield batch.slice(at, to - at)
            at = to


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, large: Broadcast | None = None) -> DataFrame:
    """Applies work to each Arrow batch, cut by the length of its texts; one is held at a time.

    large: a broadcast that work reads and that is too large to stay in the worker after the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches):
                if batch.num_rows and (out := work(batch)) is not None:
                    yield out
        finally:
            if large is not None:
                forget(large)

    return df.mapInArrow(lean(run), schema)


def by_groups(df: DataFrame, keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Applies work to the rows of each group of whole-number keys; a task holds one group, and what of the next came along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not held or any(held[-1].column(k)[-1] != batch.column(k)[-1] for k in keys):
                table = pa.Table.from_batches([*held, batch])
                cuts = group_starts(table, keys)
                for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
                    yield from work(table.slice(a, b - a))
                held = table.slice(cuts[-2]).to_batches()
            else:
                held.append(batch)
        if held:
            table = pa.Table.from_batches(held)
            cuts = group_starts(table, keys)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield from work(table.slice(a, b - a))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run), schema)


def group_starts(table: pa.Table, keys: list[str]) -> list[int]:
    """Where the groups of a sorted table start, and its end."""
    columns = [table.column(k).to_numpy() for k in keys]
    new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    return [0, *new.tolist(), table.num_rows]


FEW = 300_000  # rows of a few numbers that may be broadcast
HOT = 1_000  # a key is hot where it holds more than one of so many rows


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined with a table of one narrow row for each key, whatever share of rows a key holds.

    A table of at most FEW rows, by a count, is broadcast. Of a larger one only the rows of hot
    keys are, of which there cannot be more than HOT; the other rows meet by a shuffle.
    """
    table = saved(table)
    if table.count() <= FEW:
        return rows.join(F.broadcast(table), keys, how)
    most = rows.count() / HOT
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys)
    hot = saved(hot)
    apart = [rows.join(F.broadcast(hot), keys, kind) for kind in ("left_semi", "left_anti")]
    return apart[0].join(F.broadcast(table.join(F.broadcast(hot), keys, "left_semi")), keys, how).unionByName(apart[1].join(table, keys, how))


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo folds; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")
