"""A corpus from documents to token ids: reject toxic texts, keep one of each group of near
copies, replace personal data, mix sources to their targets, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. `run` writes each stage as Parquet to the shared folder of
spark.checkpoint.dir and reads it again for the next one. Null texts and ids, repeated rows,
very long texts, extra columns and empty tables are dealt with as the operators' modules say;
rows with a null id are never merged with others and stay in the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citymill.llm import bpe, common, mixing, near, private, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours score below 0.5."""
    docs = docs.select(*COLUMNS)
    index = toxicity.pack(docs, common.read(spark, sf_dir, "labels"))
    return toxicity.judge(docs, index, evidence=False).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word shingles of five and a similarity of 0.8."""
    docs = common.prepare(spark) and docs.select(*COLUMNS)
    return near.one_of_each(docs, size=5, percent=80).select(*COLUMNS)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars is that of the new text."""
    docs = common.prepare(spark) and docs.select(*COLUMNS)
    done = private.pseudonymise(docs).drop("entities")
    return done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; none at all where it takes none."""
    docs = common.prepare(spark) and docs.select(*COLUMNS)
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.xxhash64("text", "source")))
    mixed = mixing.mix(keyed.select(F.col("_key").alias("doc_id"), "text", "source"))
    given = mixed.groupBy(F.col("doc_id").alias("_key"), F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_null")).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0").checkpoint()
    taken = keyed.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn("_null", F.col("source").isNull()).join(given, ["_key", "_source", "_null"])
    repeated = given.where("_rows > 1")
    if not repeated.limit(1).count():
        return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*COLUMNS)
    one = taken.where("_rows = 1")
    order = Window.partitionBy("_key", "_source", "_null").orderBy("text", "lang", "n_chars")  # rows of one id and source only
    several = taken.where("_rows > 1").withColumn("_at", F.row_number().over(order)).withColumn("_copies", F.floor((F.col("_copies") + F.col("_rows") - F.col("_at")) / F.col("_rows")).cast("long")).drop("_at").where("_copies > 0")
    return one.unionByName(several).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip: ids of every text, and whether they decode to its bytes."""
    docs = common.prepare(spark) and docs.select(*COLUMNS)
    done = bpe.encode(docs.withColumn("text", F.coalesce("text", F.lit(""))), *bpe.vocabulary(), checked=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_copies),
    ("private_data", replace_private),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: Neighbour votes, keyed surrogates and sequential rounding are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = common.read(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for at, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    return docs
