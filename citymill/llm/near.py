"""Near-duplicate documents by an inverted join of MinHash coordinates.

1. Each text's set of word shingles gives a signature of `COORDINATES` minima. Texts with equal
   sets are one from here on, told apart by the set and not by doc_id, so copies are never paired.
2. Signatures are posted under each (coordinate, value). A link of the wanted similarity agrees
   in at least T coordinates, but for a chance of `MISS`; so two such texts share one of their
   (COORDINATES - T + 1) rarest postings. Only those prefixes are posted: postings that a single
   text has fill most prefixes up, and texts that only share a common passage drop out.
3. Clusters: in a hub round one text of each list is the hub, and each text is held against the
   hub that it meets most often: at most one link a text. Lists that then still span several
   clusters are merged in full: in the order of set size, skipping partners whose size rules a
   link out, pairs of different clusters count their equal coordinates. A list gives at most
   one link less than it spans clusters. Two linked texts are in one cluster.
4. Confirmation: each cluster's full sets (64-bit hashes of all shingles) and `WIDE` further
   coordinates, read once, are compared until every pair is linked, ruled out by a wide
   signature (chance `MISS`) or by its full sets, or in one component already. Clusters above
   `ROWS` texts are first dealt at random `DEALS` times, which joins most of a large group, and
   then completed by pairs of blocks, of which two of one component never meet.

Null and empty texts have no shingle: n_shingles 0, a component of their own. A null doc_id
takes no part: its component is null and it is kept. Very long texts are used whole. Rows that
repeat a doc_id share a component only through their sets, and each is kept if its id is the
component's. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import smallest_labels
from .markov import _chunks, hashes_of, tokens_of

COORDINATES = 64
WIDE = 256
MISS = 1e-7
HUB_ROUNDS = 2
DEALS = 2  # random deals of a cluster above ROWS, before its blocks meet
ROWS = 2_048  # of a block
SHINGLES = 4_000_000  # of a block, 32 MB; a longer text is a block of its own
HOT_CELL = 200
CHARS = 3_000_000  # of texts in work at once

_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def multipliers(count: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(count)
    return rng.integers(1, 1 << 63, count, np.uint64) | np.uint64(1), rng.integers(1, 1 << 63, count, np.uint64)


def least_matches(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most coordinates T for which a pair of this similarity has fewer than T equal ones with chance at most miss."""
    p, below, t = percent / 100, 0.0, 0
    while t < coordinates:
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many of each text): distinct shingles of each text, sorted, text after text."""
    codes, words, lengths = tokens_of(texts)
    token = hashes_of(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(token)) - starts[owner]
    span = np.minimum(lengths, size)[owner]  # a shorter text is one shingle
    first = place + span <= lengths[owner]
    hashes = np.zeros(len(token), np.uint64)
    for k in range(size):
        more = (k < span) & (np.arange(len(token)) + k < len(token))
        moved = np.zeros(len(token), np.uint64)
        moved[more] = token[np.flatnonzero(more) + k]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX + moved
    hashes = (hashes + span.astype(np.uint64)) * _MIX
    hashes, owner = (hashes ^ (hashes >> np.uint64(32)))[first], owner[first]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
    return hashes[new], np.bincount(owner[new], minlength=len(lengths))


def signatures(hashes: np.ndarray, sizes: np.ndarray, count: int = COORDINATES) -> np.ndarray:
    """(texts with a shingle, count): smallest value under each multiplier, 32 bits."""
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    factors, terms = multipliers(count)
    out = np.zeros((len(begins), count), np.uint32)
    if len(begins):
        for k in range(count):
            out[:, k] = np.minimum.reduceat((hashes * factors[k] + terms[k]) >> np.uint64(32), begins)
    return out


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, key (of the whole set; null if empty), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, CHARS):
            hashes, sizes = shingle_sets(batch.column("text"), size)
            signs, keys = signatures(hashes, sizes), _keys(hashes, sizes)
            row = np.cumsum(sizes > 0) - 1
            signed = [signs[r].tobytes() if n else None for r, n in zip(row.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())], ["doc_id", "text_hash", "n_shingles", "key", "signature"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(common.lean(run), "doc_id long, text_hash long, n_shingles long, key binary, signature binary")


def _keys(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """128 bits that tell sets apart; None for an empty set."""
    ends = np.cumsum(sizes)
    return [xxhash.xxh3_128_digest(hashes[end - n : end].tobytes()) if n else None for end, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _postings(reps: DataFrame, least: int) -> DataFrame:
    """cell, rep: the rarest postings of each text that can have a partner.

    Cells that hold over one in HOT_CELL texts, at most COORDINATES * HOT_CELL of them, are
    known to every task; the other postings meet their cell's count by a shuffle.
    """

    def cells_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        return ((np.arange(COORDINATES, dtype=np.int64) << 32) | signs).ravel(), np.repeat(batch.column("rep").to_numpy(), COORDINATES)

    counted = common.saved(common.map_batches(reps.select("rep", "signature"), lambda b: pa.RecordBatch.from_arrays([pa.array(cells_of(b)[0])], ["cell"]), "cell long").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    most = reps.count() / HOT_CELL
    hot = sorted((r.cell, r.n) for r in counted.where(F.col("n") > most).collect())  # bounded, see above
    shared = reps.sparkSession.sparkContext.broadcast(np.array(hot, np.int64).reshape(-1, 2))

    def post(batch: pa.RecordBatch) -> pa.RecordBatch:
        cell, rep = cells_of(batch)
        known = np.zeros(len(cell), np.int64)
        if len(shared.value):
            at = np.minimum(np.searchsorted(shared.value[:, 0], cell), len(shared.value) - 1)
            known = np.where(shared.value[at, 0] == cell, shared.value[at, 1], 0)
        spread = np.where(known > 0, -1 - rep, cell)  # what is known meets nothing
        return pa.RecordBatch.from_arrays([pa.array(spread), pa.array(cell), pa.array(rep), pa.array(known)], ["meet", "cell", "rep", "known"])

    posted = common.map_batches(reps.select("rep", "signature"), post, "meet long, cell long, rep long, known long")
    sized = posted.join(counted.where(F.col("n") <= most).withColumnRenamed("cell", "meet"), "meet", "left").select("cell", "rep", F.when(F.col("known") > 0, F.col("known")).otherwise(F.col("n")).alias("n")).where(F.col("n").isNotNull())
    own = sized.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "cell"))).alias("cells"))  # at most COORDINATES each
    prefix = COORDINATES - least + 1
    alone = F.lit(COORDINATES) - F.size("cells")  # postings of one text come first in its prefix
    return own.where(F.size("cells") >= least).select("rep", F.explode(F.slice("cells", F.lit(1), F.lit(prefix) - alone)).alias("c")).select(F.col("c.cell").alias("cell"), "rep")


def _agree(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures agree in at least `least` coordinates."""
    hubs = pairs.select(F.col("b").alias("rep")).distinct().join(reps.select("rep", "signature"), "rep")
    two = pairs.join(reps.select(F.col("rep").alias("a"), F.col("signature").alias("left")), "a")

    def sign(rows: DataFrame, names: list[str]) -> DataFrame:  # wide rows: the few hubs, or by shuffle
        return rows.join(hubs.select(F.col("rep").alias("b"), F.col("signature").alias("right")), "b").select(*names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint32).reshape(-1, COORDINATES) for n in ("left", "right"))
        return batch.select(["a", "b"]).filter(pa.array((left == right).sum(1) >= least))

    return common.map_batches(sign(two, ["a", "b", "left", "right"]), run, "a long, b long")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """rep, comp after the links (a, b) between reps merged their components."""
    ends = links.join(labels.select(F.col("rep").alias("a"), F.col("comp").alias("ca")), "a").join(labels.select(F.col("rep").alias("b"), F.col("comp").alias("cb")), "b")
    joined = smallest_labels(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    moved = joined.where("node <> label").select(F.col("node").alias("comp"), "label")
    return common.saved(common.look_up(labels, moved, ["comp"], "left").select("rep", F.coalesce("label", "comp").alias("comp")))


def _open_lists(postings: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Postings with their component, size n and hub of the list, of lists that span several components."""
    placed = common.saved(postings.join(labels, "rep"))
    order = F.struct(F.xxhash64(F.lit(turn), "rep").alias("h"), F.col("rep").alias("hub"), F.col("comp").alias("hub_comp"))
    lists = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(order).alias("o")).where("low < high").select("cell", "n", "o.hub", "o.hub_comp")
    return common.look_up(placed, lists, ["cell"])


def _hub_pairs(postings: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): each text with the hub that it meets in most lists."""
    met = _open_lists(postings, labels, turn).where("comp <> hub_comp").groupBy("rep", "hub").agg(F.count("*").alias("lists"))
    return met.groupBy(F.col("rep").alias("a")).agg(F.max(F.struct("lists", (-F.col("hub")).alias("o"), "hub")).alias("m")).select("a", F.col("m.hub").alias("b"))


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    """rows with low, high and own: one block for a group that fits a task, else pairs of blocks.

    In a larger group a component that fills blocks has them for itself, the other components
    share some. Two blocks of one component never meet, so a large component is sent as often as
    there are blocks of other components, and not as often as it has blocks itself.
    """
    weight = F.greatest(F.sum("n_shingles") / SHINGLES, F.count("*") / ROWS)
    large = common.saved(rows.groupBy(group).agg(weight.alias("w")).where("w > 1").select(group))
    whole = [F.lit(0).alias(n) for n in ("low", "high", "own")]
    if not large.limit(1).count():
        return rows.select("*", *whole)
    columns = rows.columns
    rows = common.saved(common.look_up(rows, large.withColumn("large", F.lit(True)), [group], "left"))
    small, rest = rows.where("large IS NULL").select(*columns, *whole), rows.where("large").drop("large")
    parts = rest.groupBy(group, "comp").agg(weight.alias("w"))
    pure = parts.where("w >= 1").select(group, "comp", F.ceil("w").cast("int").alias("parts"))
    shared = parts.where("w < 1").groupBy(group).agg(F.ceil(F.sum("w")).cast("int").alias("shared"))
    named = common.look_up(common.look_up(rest, pure, [group, "comp"], "left"), shared, [group], "left")
    alone = F.col("parts").isNotNull()
    owner = F.when(alone, F.col("comp")).otherwise(F.lit(-1)).alias("owner")
    part = F.when(alone, F.pmod(F.xxhash64("rep"), "parts")).otherwise(F.pmod(F.xxhash64("comp"), F.coalesce("shared", F.lit(1)))).cast("int").alias("part")
    named = common.saved(named.select(*columns, owner, part))
    blocks = common.saved(named.groupBy(group, "owner", "part").agg(F.count("*").alias("n")).select(group, "owner", "part", F.struct("owner", "part").alias("block")))
    other = blocks.select(group, F.col("block").alias("other"), F.col("owner").alias("other_owner"))
    pairs = blocks.join(other, group).where("owner <> other_owner OR owner = -1 AND block = other OR owner = -1 AND other_owner = -1")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    number = lambda block: F.xxhash64(block).alias
    pairs = pairs.select(group, "owner", "part", number(low)("low"), number(high)("high"), number(F.col("block"))("own"))
    return small.unionByName(named.join(pairs, [group, "owner", "part"]).select(*columns, "low", "high", "own"))


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _spanning(table: pa.Table, signs: np.ndarray, percent: int, linked: Callable[[int, int], bool] | None) -> Iterator[pa.RecordBatch]:
    """Links that span what agrees in the table, component by component; with `linked`, only links that it confirms.

    Rows go by set size, so partners whose size rules a link out are skipped, as are those that
    are in one component already, before or by the links found so far.
    """
    if table.num_rows < 2:
        return
    rep, comp, n, own = (table.column(c).to_numpy() for c in ("rep", "comp", "n_shingles", "own"))
    apart = table.column("low")[0].as_py() != table.column("high")[0].as_py()
    order = np.lexsort((rep, n))
    rep, n, own, signs = rep[order], n[order], own[order], signs[order]
    label = np.unique(comp[order], return_inverse=True)[1]
    last = np.searchsorted(n, n * 100 // percent, "right")  # larger sets cannot have the similarity
    least = least_matches(percent, signs.shape[1])
    found: list[tuple[int, int]] = []
    for i in range(len(rep)):
        fits = label[i + 1 : last[i]] != label[i]
        if apart:
            fits &= own[i + 1 : last[i]] != own[i]
        j = i + 1 + np.flatnonzero(fits)
        if not len(j):
            continue
        agree = (signs[j] == signs[i]).sum(1)
        j, agree = j[agree >= least], agree[agree >= least]
        j = j[np.argsort(-agree, kind="stable")]
        while len(j):
            k = int(j[0])
            if linked is None or linked(int(order[i]), int(order[k])):
                found.append((i, k))
                label[label == label[k]] = label[i]
                j = j[label[j] != label[i]]
            else:
                j = j[1:]
    if found:
        a, b = np.array(found).T
        yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], schema=_LINK)


def _matrix(table: pa.Table, column: str, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind).reshape(-1, width)


def _clusters(postings: DataFrame, reps: DataFrame, percent: int, hub_rounds: int) -> DataFrame:
    """rep, cluster of texts that have a likely link; two texts with a link are in one cluster."""
    least = least_matches(percent)
    labels = common.saved(postings.select("rep").distinct().select("rep", F.col("rep").alias("comp")))
    for turn in range(hub_rounds):
        labels = _merged(labels, _agree(_hub_pairs(postings, labels, turn), reps, least))
    lists = _open_lists(postings, labels, hub_rounds).select("cell", "rep", "comp").join(reps.select("rep", "n_shingles", "signature"), "rep")
    meet = lambda table: _spanning(table, _matrix(table, "signature", np.uint32, COORDINATES), percent, None)
    labels = _merged(labels, common.by_groups(_dealt(lists, "cell"), ["cell", "low", "high"], meet, "a long, b long"))
    others = labels.where("rep <> comp")
    heads = common.look_up(labels.where("rep = comp"), others.select("comp").distinct(), ["comp"], "left_semi")
    return common.saved(others.unionByName(heads.select("rep", "comp")).withColumnRenamed("comp", "cluster"))


def _with_sets(clusters: DataFrame, reps: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """rep, cluster, n_shingles, wide, members: a wide signature and the full set of each clustered text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, CHARS):
            hashes, sizes = shingle_sets(batch.column("text"), size)
            ends, some = np.cumsum(sizes), sizes > 0
            wide = signatures(hashes, sizes, WIDE).astype(np.uint16)
            members = [hashes[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True) if n]
            keys = [k for k in _keys(hashes, sizes) if k is not None]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(some)), pa.array(keys, pa.binary()), pa.array([x.tobytes() for x in wide], pa.binary()), pa.array(members, pa.binary())], ["doc_id", "key", "wide", "members"])

    wanted = common.saved(clusters.join(reps.select("rep", "key", "first", "n_shingles"), "rep"))
    texts = common.look_up(docs.select("doc_id", "text"), wanted.select(F.col("first").alias("doc_id")).distinct(), ["doc_id"], "left_semi")
    sets = texts.mapInArrow(common.lean(run), "doc_id long, key binary, wide binary, members binary").withColumnRenamed("doc_id", "first")
    return common.saved(wanted.join(sets, ["first", "key"]).dropDuplicates(["rep"]).select("rep", "cluster", "n_shingles", "wide", "members"))


def _confirm(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links of the table that its full sets confirm."""
    sets = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]

    def linked(i: int, k: int) -> bool:
        one, two = sets[i], sets[k]
        both = int((one[np.minimum(np.searchsorted(one, two), len(one) - 1)] == two).sum())
        return 100 * both >= percent * (len(one) + len(two) - both)

    yield from _spanning(table, _matrix(table, "wide", np.uint16, WIDE), percent, linked)


def _components(sets: DataFrame, percent: int, deals: int) -> DataFrame:
    """rep, comp: components of the confirmed links within clusters."""
    confirm = functools.partial(_confirm, percent=percent)
    labels = common.saved(sets.select("rep", F.col("rep").alias("comp")))
    weight = F.greatest(F.sum("n_shingles") / SHINGLES, F.count("*") / ROWS)
    sizes = common.saved(sets.groupBy("cluster").agg(F.ceil(weight).cast("int").alias("deals")).where("deals > 1"))
    large = sizes.limit(1).count() > 0
    for turn in range(deals if large else 1):  # at random; a cluster that fits one block is done after the first
        rows = common.look_up(sets, sizes, ["cluster"], "left" if turn == 0 else "inner") if large else sets.withColumn("deals", F.lit(1))
        rows = rows.withColumn("low", F.pmod(F.xxhash64(F.lit(turn), "rep"), F.coalesce("deals", F.lit(1))).cast("int")).join(labels, "rep")
        rows = rows.select("cluster", "low", F.col("low").alias("high"), F.col("low").alias("own"), "rep", "comp", "n_shingles", "wide", "members")
        labels = _merged(labels, common.by_groups(rows, ["cluster", "low"], confirm, "a long, b long"))
    if large:
        rows = common.look_up(sets, sizes, ["cluster"]).drop("deals").join(labels, "rep")
        labels = _merged(labels, common.by_groups(_dealt(rows, "cluster"), ["cluster", "low", "high"], confirm, "a long, b long"))
    return labels


def groups(docs: DataFrame, size: int = 5, percent: int = 80, hub_rounds: int = HUB_ROUNDS, deals: int = DEALS) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), group_id, n_shingles, component_id, kept for every row.

    group_id numbers the texts that are linked, whatever their ids; it is null where nothing can be linked.
    """
    sketch = common.saved(_sketch(docs, size))
    known = sketch.where("key IS NOT NULL AND doc_id IS NOT NULL")
    reps = known.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("rows"))
    reps = common.saved(reps.withColumn("rep", F.monotonically_increasing_id()))
    postings = common.saved(_postings(reps, least_matches(percent)))
    clusters = _clusters(postings, reps, percent, hub_rounds)
    labels = _components(_with_sets(clusters, reps, docs, size), percent, deals)
    placed = common.saved(reps.select("rep", "key", "first", "rows").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")))
    smallest = placed.groupBy("comp").agg(F.min("first").alias("component_id"), F.count("*").alias("n")).where("n > 1").select("comp", "component_id")
    named = common.look_up(placed, smallest, ["comp"], "left").withColumn("grouped", F.col("component_id").isNotNull()).select("key", F.coalesce("component_id", "first").alias("component_id"), F.col("comp").alias("group_id"), "grouped", "rows")
    named = named.where("rows > 1 OR grouped").select("key", "component_id", "group_id")  # any other row stands for itself
    out = ["doc_id", "text_hash", "group_id", "n_shingles", "component_id"]
    done = common.look_up(known.select("doc_id", "text_hash", "n_shingles", "key"), named, ["key"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id")).select(*out)
    rest = sketch.where("key IS NULL OR doc_id IS NULL").select("doc_id", "text_hash", F.lit(None).cast("long").alias("group_id"), "n_shingles", F.col("doc_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs without near copies: of each group of linked texts one row of the smallest doc_id stays, of its texts the one with the smallest hash."""
    found = common.saved(groups(docs, size, percent).where("group_id IS NOT NULL"))
    own = F.struct("doc_id", "text_hash")
    chosen = found.groupBy("group_id").agg(F.min(own).alias("one"), F.count("*").alias("n")).where("n > 1").drop("n")
    keys = ["doc_id", "text_hash"]
    members = common.saved(common.look_up(found.select("group_id", *keys), chosen, ["group_id"]).select(*keys, (own == F.col("one")).alias("stays")))
    rest = common.look_up(docs.withColumn("text_hash", F.xxhash64("text")), members.where("NOT stays").select(*keys).distinct(), keys, "left_anti")
    repeated = common.saved(members.where("stays").groupBy(*keys).count().where("count > 1").select(*keys))
    if not repeated.limit(1).count():
        return rest.select(*docs.columns)
    once = common.look_up(rest, repeated, keys, "left_semi").dropDuplicates(keys)
    return common.look_up(rest, repeated, keys, "left_anti").unionByName(once).select(*docs.columns)


def op7_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(common.read(spark, sf_dir, "documents"), size=3, percent=85).drop("text_hash", "group_id")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM met JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(id, label) AS (SELECT doc_id, doc_id FROM d UNION SELECT b.y, r.label FROM r JOIN both_ways b ON b.x = r.id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(label) AS component_id FROM r GROUP BY id) l ON l.id = d.doc_id
"""
