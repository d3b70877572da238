"""Filters as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-5


def boxes_overlap(a: dict[str, tuple[Column, Column]], b: dict[str, tuple[Column, Column]], eps: float = EPS) -> Column:
    """Whether closed boxes, given as axis: (low, high), meet within eps on every axis."""
    found = F.lit(True)
    for axis in a:
        (a_low, a_high), (b_low, b_high) = a[axis], b[axis]
        found = found & (a_low <= b_high + eps) & (a_high >= b_low - eps)
    return found


def in_box(point: dict[str, Column], low: dict[str, Column], high: dict[str, Column]) -> Column:
    """Whether a point is in a closed box."""
    found = F.lit(True)
    for axis, value in point.items():
        found = found & (value >= low[axis]) & (value <= high[axis])
    return found


def any_target(items: Column, targets: Column) -> Column:
    """Some target is among the items."""
    return F.arrays_overlap(items, targets)


def all_targets(items: Column, targets: Column) -> Column:
    """Every target is among the items."""
    return F.forall(targets, lambda t: F.array_contains(items, t))


def other_than_targets(items: Column, targets: Column) -> Column:
    """Some item is not a target."""
    return F.exists(items, lambda i: ~F.array_contains(targets, i))


def valid_indices(indices: Column, size: Column) -> Column:
    """The indices from 0 up to size, others dropped."""
    return F.filter(indices, lambda i: (i >= 0) & (i < size))


def strict_superset(larger: Column, smaller: Column) -> Column:
    """larger has something that smaller lacks, and lacks nothing of it."""
    return (F.size(F.array_except(larger, smaller)) > 0) & (F.size(F.array_except(smaller, larger)) == 0)


def forward_hit(normal: tuple[Column, Column, Column], direction: tuple[float, float, float]) -> Column:
    """The surface faces away from where the ray comes from."""
    return sum((n * d for n, d in zip(normal, direction, strict=True)), F.lit(0.0)) > 0


def near_bottom(y: Column, lowest: Column, eps: float = EPS) -> Column:
    """Within eps of the lowest level; eps is at least 1e-6."""
    return F.abs(y - lowest) <= max(eps, 1e-6)
