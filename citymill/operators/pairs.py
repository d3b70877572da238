"""Before and after states of a tile: chunk tables, pairs by containment, splits, selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates, scalar


def parsed(names: DataFrame, column: str = "name") -> DataFrame:
    """names with a, b, c of names of the form a_b_c; other names are left out."""
    triple = scalar.index_triple(F.col(column))
    return names.withColumn("_t", triple).where("_t IS NOT NULL").select(*names.columns, F.col("_t")[0].alias("a"), F.col("_t")[1].alias("b"), F.col("_t")[2].alias("c"))


def prefix_counts(names: DataFrame, column: str = "name") -> DataFrame:
    """One row: how many prefixes a_b there are, and which."""
    prefixes = names.select(scalar.name_prefix(F.col(column)).alias("prefix")).where("prefix IS NOT NULL").distinct()
    return prefixes.agg(F.count("*").alias("n"), F.sort_array(F.collect_list("prefix")).alias("prefixes"))


def highest_third(names: DataFrame, column: str = "name") -> DataFrame:
    """a, b, max_c."""
    return parsed(names, column).groupBy("a", "b").agg(F.max("c").alias("max_c"))


def gaps(names: DataFrame, column: str = "name") -> DataFrame:
    """a, b, c of the missing names between 0 and the highest third part."""
    known = parsed(names, column).select("a", "b", "c")
    full = highest_third(names, column).select("a", "b", F.explode(F.sequence(F.lit(0), "max_c")).alias("c"))
    return full.join(known, ["a", "b", "c"], "left_anti")


def state_pairs(chunks: DataFrame, with_grounds: bool = False) -> DataFrame:
    """i, j, t1, t2, new_buildings: t2 holds all buildings of t1 and more; with_grounds: or so of grounds.

    States of one tile meet by an equi-join on (i, j); containment is tested on the arrays.
    """
    one = chunks.select("i", "j", F.col("k").alias("k1"), F.col("building_indices").alias("b1"), F.col("ground_indices").alias("g1"))
    two = chunks.select("i", "j", F.col("k").alias("k2"), F.col("building_indices").alias("b2"), F.col("ground_indices").alias("g2"))
    more = predicates.strict_superset(F.col("b2"), F.col("b1"))
    if with_grounds:
        more = more | predicates.strict_superset(F.col("g2"), F.col("g1"))
    pairs = one.join(two, ["i", "j"]).where("k1 <> k2").where(more)
    name = lambda k: F.concat_ws("_", "i", "j", k)
    return pairs.select("i", "j", name("k1").alias("t1"), name("k2").alias("t2"), F.sort_array(F.array_except("b2", "b1")).alias("new_buildings"))


def split_groups(keys: DataFrame, ratio: float, seed: str, columns: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """keys with split 'val' for floor(n * ratio) groups (at least one if ratio > 0), 'train' for the others.

    Groups are ranked by a hash of the seed and their key, so the split is the same everywhere.
    """
    draw = F.md5(F.concat_ws("_", F.lit(seed), *columns).cast("binary"))
    ranked = keys.select(*columns).distinct().withColumn("_draw", draw)
    place = F.row_number().over(Window.orderBy("_draw", *columns))
    total = ranked.agg(F.count("*").alias("_n"))
    wanted = F.floor(F.col("_n") * ratio)
    wanted = F.greatest(wanted, F.lit(1)) if ratio > 0 else F.lit(0)
    return ranked.withColumn("_place", place).crossJoin(F.broadcast(total)).select(*columns, F.when(F.col("_place") <= wanted, "val").otherwise("train").alias("split"))


def new_names(states: DataFrame, pairs: DataFrame, kind: str = "building_indices") -> DataFrame:
    """t1, t2, item: what t2 has and t1 has not."""
    own = states.select("name", F.col(kind).alias("items"))
    both = pairs.select("t1", "t2").join(own.withColumnsRenamed({"name": "t1", "items": "old"}), "t1").join(own.withColumnsRenamed({"name": "t2", "items": "new"}), "t2")
    return both.select("t1", "t2", F.explode(F.array_except(F.coalesce("new", F.array().cast("array<bigint>")), F.coalesce("old", F.array().cast("array<bigint>")))).alias("item"))


def change_clouds(states: DataFrame, pairs: DataFrame, clouds: DataFrame) -> DataFrame:
    """t1, t2 and the points of what is new in t2; names without a cloud add nothing."""
    return new_names(states, pairs).join(clouds.withColumnRenamed("cloud", "item"), "item").select("t1", "t2", *[c for c in clouds.columns if c != "cloud"])


def first_states(chunks: DataFrame, targets: list[int]) -> DataFrame:
    """i, j, t1, t2: for each final state the state before the targets were there.

    The final state of a tile is its last. Without a target among its buildings it stands for
    itself; else t1 is the first state whose grounds hold a target and nothing else. Tiles
    without such a state have t1 null.
    """
    wanted = F.array(*[F.lit(t).cast("long") for t in targets])
    final = chunks.groupBy("i", "j").agg(F.max_by(F.struct("name", "building_indices"), "k").alias("f"), F.max("k").alias("last"))
    fits = predicates.any_target(F.col("ground_indices"), wanted) & ~predicates.other_than_targets(F.col("ground_indices"), wanted)
    first = chunks.where(fits).groupBy("i", "j").agg(F.min_by("name", "k").alias("first"), F.min("k").alias("first_k"))
    found = final.join(first, ["i", "j"], "left")
    own = predicates.any_target(F.col("f.building_indices"), wanted)
    return found.select("i", "j", F.when(~own, F.col("f.name")).when(F.col("first_k") < F.col("last"), F.col("first")).alias("t1"), F.col("f.name").alias("t2"))


def ground_names(chunks: DataFrame, models: DataFrame) -> DataFrame:
    """name, models: the ground models of each chunk by their position in the natural order."""
    from .tiling import models_by_position

    return models_by_position(chunks, models, "ground_indices")


def with_condition(pairs: DataFrame, folder: str, ending: str = ".pt") -> DataFrame:
    """pairs with condition, the path of the cloud of their change, in place of any there was."""
    return pairs.withColumn("condition", F.concat(F.lit(folder.rstrip("/") + "/"), "t1", F.lit("_"), "t2", F.lit(ending)))


def zipped(first: DataFrame, second: DataFrame) -> DataFrame:
    """t1, t2, position of states of the same tile: first (i, j, t1) with second (i, j, t2)."""
    return first.join(second, ["i", "j"]).select("t1", "t2", F.concat_ws("_", "i", "j").alias("position"))


def in_input_order(rows: DataFrame) -> DataFrame:
    """Rows in the order of their idx column, however they were computed."""
    return rows.orderBy("idx")
