"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / source size. The
whole part is given at once; the fractions are settled in pairs. A pair moves mass, counted in
words, from one document to the other at random until one of the two fractions becomes 0 or 1,
and the other goes on to meet the next document. Each step keeps the pair's words and every
document's expectation, so a source misses its target by less than one document.

Documents are dealt into buckets by a hash of their id; a bucket leaves one unsettled document
for each source. Those residuals meet in parent buckets, FAN buckets to a parent, until one is
left, which is settled alone. Large documents meet first, so what is left is small. A task holds one document at a time, so a hot source is no
hotter than its buckets. Randomness is a hash of (seed, level, document), so reruns agree.

Null text has size 0 and takes nothing; a null source is a source of its own, last in order.
Repeated rows and null ids are settled like others; extra columns are ignored; an empty table
gives an empty result. Very long texts only make sizes large.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

ROWS = 20_000  # documents in a bucket, about
FAN = 256  # buckets to a parent
WEIGHTS = (3, 1, 2)

_STATE = "doc_id long, source string, size long, source_size long, target double, copies int, p double, bucket long"


def sizes_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words of the text."""
    inner = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    size = F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+")))
    return docs.select("doc_id", "source", size.cast("long").alias("size"))


def targets_of(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target: share of all words by weight, at most cap times a source's own.

    Filling by weight under caps has one level: target = least(cap * size, level * weight). With
    sources in the order of cap * size / weight, the level is the largest of
    (total - caps before) / (weights from here on). This table has one row for each source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights)) + 1).cast("double")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    totals = totals.withColumn("limit", F.lit(cap) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    return totals.withColumn("level", left / rest).select("source", "source_size", F.least("limit", F.max("level").over(everything) * F.col("weight")).alias("target"))


def meet(s1: float, p1: float, s2: float, p2: float, u: float) -> tuple[float, float]:
    """The fractions of two documents of s1 and s2 words after they met; at least one is 0 or 1."""
    to_first, to_second = min(s1 * (1 - p1), s2 * p2), min(s1 * p1, s2 * (1 - p2))
    if u * (to_first + to_second) < to_second:
        return (1.0, 0.0 if s2 * p2 == to_first else p2 - to_first / s2) if s1 * (1 - p1) == to_first else (p1 + to_first / s1, 0.0)
    return (0.0, 1.0 if s2 * (1 - p2) == to_second else p2 + to_second / s2) if s1 * p1 == to_second else (p1 - to_second / s1, 1.0)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in the order of (bucket, source, size): all rows again, one at most of each pair unsettled."""
    held, schema = None, None
    for batch in batches:
        schema = batch.schema
        rows, out = batch.to_pylist(), []
        for row in rows:
            if not 0 < row["p"] < 1:
                out.append(row)
                continue
            if held is not None and (held["bucket"], held["source"]) == (row["bucket"], row["source"]):
                held["p"], row["p"] = meet(held["size"], held["p"], row["size"], row["p"], row["u"])
                if 0 < row["p"] < 1:
                    out.append(held)
                    held = row
                elif 0 < held["p"] < 1:
                    out.append(row)
                else:
                    out += [held, row]
                    held = None
            else:
                if held is not None:
                    out.append(held)
                held = row
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([held], schema=schema)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 8, rows_in_bucket: int = ROWS, fan: int = FAN) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: how often the mix takes each document."""
    sizes = sizes_of(docs).checkpoint()
    buckets = max(1, -(-sizes.count() // rows_in_bucket))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.when(F.col("size") > 0, F.floor("expected")).otherwise(0).cast("int")
    state = (
        sizes.join(targets_of(sizes, weights, share, cap).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("expected", expected)
        .withColumn("copies", whole)
        .withColumn("p", F.when(F.col("size") > 0, F.col("expected") - whole).otherwise(0.0))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(buckets)))
        .drop("of", "expected")
    )
    settled, level = [], 0
    while True:
        chance = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "source", "size"), F.lit(1 << 40)) / float(1 << 40)
        dealt = state.withColumn("u", chance).repartition("bucket").sortWithinPartitions("bucket", "source", F.desc("size"), "doc_id")
        state = dealt.mapInArrow(common.lean(_settle), f"{_STATE}, u double").drop("u").checkpoint()
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(state.where(~open_))
        state = state.where(open_)
        if buckets == 1:
            break
        buckets, level = -(-buckets // fan), level + 1
        state = state.withColumn("bucket", F.floor(F.col("bucket") / fan).cast("long"))
    last = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "doc_id", "source", "size"), F.lit(1 << 40)) / float(1 << 40) < F.col("p")
    settled.append(state.withColumn("p", F.when(last, 1.0).otherwise(0.0)))
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") + F.col("p").cast("int")).alias("copies"))


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
