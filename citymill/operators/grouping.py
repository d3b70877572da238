"""Rows brought together: joins of made rows by shuffle, and whole groups in large Arrow tables for kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def join_made(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """An equi-join by shuffle and merge, never by broadcast.

    The size of rows made by explode is estimated by that of the rows they come from, so a side
    far too large to broadcast can look small; nothing here counts on that estimate.
    """
    return left.join(right.hint("merge"), on, how)


def map_groups(rows: DataFrame, key: str, work: Callable[[pa.Table], pa.Table], schema: str, rows_at_once: int = 200_000, most: int = 5_000_000) -> DataFrame:
    """work over tables that hold whole groups of key, each table of about rows_at_once rows.

    Rows are dealt by key and sorted by it, so a task reads its groups one after the other and
    holds one table; a group of more than `most` rows raises an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, key, rows_at_once, most):
            yield from work(table).to_batches()

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows_at_once: int, most: int) -> Iterator[pa.Table]:
    """Batches sorted by key as tables of about rows_at_once rows that hold whole groups; more than `most` rows held for one group raise an error."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows_at_once:
            continue
        table = pa.Table.from_batches(held)
        cut = _last_start(table.column(key))
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        elif table.num_rows > most:
            raise ValueError(f"{key} {table.column(key)[0]} has more than {most} rows")
        held, size = table.to_batches(), table.num_rows
    if size:
        yield pa.Table.from_batches(held)


def codes_of(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each row, equal for equal values; structs are told apart by all their fields."""
    column = column.combine_chunks()
    if pa.types.is_struct(column.type):
        parts = [codes_of(pa.chunked_array([f])) for f in column.flatten()]
        return np.unique(np.column_stack(parts), axis=0, return_inverse=True)[1].ravel()
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy()


def _last_start(column: pa.ChunkedArray) -> int:
    """Where the last group of a sorted column starts."""
    codes = codes_of(column)
    changes = np.flatnonzero(codes[1:] != codes[:-1])
    return int(changes[-1]) + 1 if len(changes) else 0


def starts_of(column: pa.ChunkedArray) -> np.ndarray:
    """Where the groups of a sorted column start, and its length."""
    codes = codes_of(column)
    return np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]])


def groups_of(table: pa.Table, key: str) -> Iterator[pa.Table]:
    """The groups of a sorted table, one by one."""
    starts = starts_of(table.column(key))
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        yield table.slice(a, b - a)
