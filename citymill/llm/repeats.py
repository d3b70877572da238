"""Exact repeated passages by suffix arrays: a difference-cover sort, dealt out by content.

A window is `LENGTH` bytes of a text. Every byte of a window that also starts anywhere else is
removed.

1. Dealing. The smallest hash among a window's k-grams is its anchor, so equal windows have
   equal anchors. Runs of windows with one anchor form a context (at most `RUN` windows).
   Contexts are counted by (anchor, content): an anchor that occurs once has no repeat; where
   all contexts of an anchor are alike, all their windows repeat. Only anchors with different
   contexts, or twice in one, go on, with one copy of each context.
2. Sorting. A task holds the contexts of whole anchors, joined to one string, and sorts their
   suffixes by the difference cover modulo 3: triples at the sampled places are sorted and
   named, names are sorted by recursion until they cover a window, the remaining suffixes are
   sorted by their first symbol and the rank behind it, and both are merged.
3. Windows that are neighbours in that order and equal repeat. An anchor with more than `HOT`
   contexts, such as a passage that very many texts embed, is not held by one task: its windows
   are counted one by one under a 128-bit hash.
4. The repeated windows of each text come back as spans; texts without any are not shuffled.

Null and empty texts have no bytes and an empty remainder. Very long texts are read whole, in
contexts. Repeated rows are repeats of each other and all go, if long enough; null ids stay;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LENGTH = 200
GRAM = 24
RUN = LENGTH - GRAM + 1
SORTED_AT_ONCE = 200_000  # bytes; small strings sort faster as they stay in the processor's cache
HOT = 5_000  # contexts of one anchor that join such a string: below 2 ** 21 bytes in all, so that three names fit 63 bits
FILTER_WORDS = 1 << 21  # of 64 bits: 16 MB, whatever the input

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Start places of all suffixes, in an order that agrees with their first `depth` symbols.

    symbols: numbers from 0, fewer than 2 ** 21 of them and below 2 ** 21 - 1.
    """
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    s = np.zeros(n + 4, np.int64)
    s[:n] = symbols + 1  # 0 stands behind the end
    ones, twos, zeros = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = s[sample] << 42 | s[sample + 1] << 21 | s[sample + 2]
    by_triple = np.argsort(triples)
    new = np.diff(triples[by_triple], prepend=-1) != 0
    if new.all() or depth <= 3:
        ranked = by_triple
    else:
        names = np.empty(len(sample), np.int64)
        names[by_triple] = np.cumsum(new) - 1
        ranked = suffix_order(names, -(-depth // 3))
    rank = np.zeros(n + 4, np.int64)
    rank[sample[ranked]] = np.arange(1, len(sample) + 1)
    near = lambda at: s[at] << 21 | rank[at + 1]  # noqa: E731  against suffixes at 1 modulo 3
    far = lambda at: s[at] << 42 | s[at + 1] << 21 | rank[at + 2]  # noqa: E731  against those at 2 modulo 3
    keys = near(zeros)
    own = np.argsort(keys)
    zeros, keys = zeros[own], keys[own]
    ordered = sample[ranked]
    ordered = ordered[ordered < n]
    first, second = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    place = np.empty(n, np.int64)
    place[zeros] = np.arange(len(zeros)) + np.searchsorted(near(first), keys) + np.searchsorted(far(second), far(zeros))
    place[ordered] = np.arange(len(ordered))
    place[first] += np.searchsorted(keys, near(first))
    place[second] += np.searchsorted(far(zeros), far(second))
    return np.argsort(place)


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start in data (bytes), whether its `length` bytes also begin at another of the starts."""
    flags = np.zeros(len(data), bool)
    wanted = np.zeros(len(data), bool)
    wanted[starts] = True
    order = suffix_order(data, length)
    order = order[wanted[order]]
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | padded[k : k + len(data)]
    left, right = order[:-1], order[1:]
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = words[left + k] == words[right + k]
        left, right = left[same], right[same]
    flags[left] = flags[right] = True
    return flags[starts]


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows, again) of each context of a text's bytes; again: its anchor stands in it twice or more."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = x * _A + (y ^ (y >> np.uint64(31))) * _B
        return z ^ (z >> np.uint64(29))

    one = _BYTES[data]
    two = both(one[:-1], one[1:])
    four = both(two[:-2], two[2:])
    eight = both(four[:-4], four[4:])
    sixteen = both(eight[:-8], eight[8:])
    n = len(data) - GRAM + 1
    grams = least = both(sixteen[:n], eight[16 : 16 + n])
    span = 1
    while 2 * span <= RUN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if RUN > span:
        least = np.minimum(least[: len(least) - (RUN - span)], least[RUN - span :])
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    size = np.diff(np.append(begin, len(least)))
    if (size > RUN).any():  # a text that repeats itself closely
        parts = -(-size // RUN)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, size = np.repeat(begin, parts) + part * RUN, np.minimum(RUN, np.repeat(size, parts) - part * RUN)
    found = least[begin]
    low = np.flatnonzero(grams <= found.max())  # all places of anchors are among these few
    values, rank = np.unique(grams[low], return_inverse=True)
    places = np.sort(rank * len(data) + low)
    own = np.searchsorted(values, found) * len(data) + begin
    return found, begin, size, np.searchsorted(places, own + size + RUN - 1) - np.searchsorted(places, own) > 1


def _contexts(text: bytes) -> Iterator[tuple[int, int, int, int, bool]]:
    """(anchor, content hash, first window, windows, again) of each context of a text; hashes as signed numbers."""
    found, begin, size, again = anchors(np.frombuffer(text, np.uint8))
    view, digest, half = memoryview(text), xxhash.xxh3_64_intdigest, 1 << 63
    for a, b, n, x in zip(found.view(np.int64).tolist(), begin.tolist(), size.tolist(), again.tolist(), strict=True):
        yield a, digest(view[b : b + n + LENGTH - 1]) - half, b, n, x


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _text_key(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def _counted(docs: DataFrame) -> DataFrame:
    """anchor, content, n, again: how often each context occurs; combined within batches."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        anchor, content, again = [], [], []
        for text in _encoded(batch):
            for a, c, _, _, x in _contexts(text):
                anchor.append(a)
                content.append(c)
                again.append(x)
        if not anchor:
            return None
        keys = np.empty(len(anchor), [("anchor", np.int64), ("content", np.int64)])
        keys["anchor"], keys["content"] = anchor, content
        order = np.lexsort((keys["content"], keys["anchor"]))
        keys, again = keys[order], np.array(again)[order]
        first = np.flatnonzero(np.concatenate([[True], (keys["anchor"][1:] != keys["anchor"][:-1]) | (keys["content"][1:] != keys["content"][:-1])]))
        times = np.diff(np.append(first, len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys["anchor"][first])), pa.array(np.ascontiguousarray(keys["content"][first])), pa.array(times, pa.int64()), pa.array(again[first])], ["anchor", "content", "n", "again"])

    return common.map_batches(docs.select("text"), work, "anchor long, content long, n long, again boolean").groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.bool_or("again").alias("again"))


def _anchor_filter(rows: DataFrame) -> Broadcast:
    """A one-hash Bloom filter of a column of hashes: at most FILTER_WORDS words come to the driver, whatever the input."""
    place = F.col("anchor").bitwiseAND(F.lit(FILTER_WORDS * 64 - 1))
    words = rows.select(F.shiftright(place, 6).cast("long").alias("word"), F.expr("shiftleft(1L, cast(anchor & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(FILTER_WORDS, np.int64)
    found = words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return rows.sparkSession.sparkContext.broadcast(table)


def _holds(table: np.ndarray, anchor: int) -> bool:
    place = anchor & (FILTER_WORDS * 64 - 1)
    return bool(int(table[place >> 6]) >> (place & 63) & 1)


def _occurrences(docs: DataFrame, some: Broadcast, mixed: Broadcast) -> DataFrame:
    """text_key, anchor, content, begin, n, bytes of contexts whose anchor may recur; bytes where its contexts may differ."""
    schema = pa.schema([("text_key", pa.binary()), ("anchor", pa.int64()), ("content", pa.int64()), ("begin", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recurring, differing = some.value, mixed.value
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [], [])
            sent: set[tuple[int, int]] = set()
            known: set[bytes] = set()
            for text in _encoded(batch):
                key = _text_key(text)
                if key in known:
                    continue
                known.add(key)
                for a, c, b, n, _ in _contexts(text):
                    if _holds(recurring, a):
                        data = None
                        if _holds(differing, a) and (a, c) not in sent:
                            sent.add((a, c))
                            data = text[b : b + n + LENGTH - 1]
                        for column, value in zip(columns, (key, a, c, b, n, data), strict=True):
                            column.append(value)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select("text").mapInArrow(common.lean(run), "text_key binary, anchor long, content long, begin int, n int, bytes binary")


def _sorted_flags(contexts: DataFrame) -> DataFrame:
    """anchor, content, flags of contexts (anchor, content, bytes): which of their windows repeat within the anchor."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("flags", pa.binary())])

    def settle(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
        sizes = np.array([len(data) for _, _, data in rows])
        begin = np.cumsum(sizes) - sizes
        windows = sizes - LENGTH + 1
        firsts = np.cumsum(windows) - windows
        starts = np.repeat(begin - firsts, windows) + np.arange(windows.sum())
        flags = repeated_windows(np.frombuffer(b"".join(data for _, _, data in rows), np.uint8), starts, LENGTH)
        out = [(a, c, np.packbits(flags[f : f + w]).tobytes()) for (a, c, _), f, w in zip(rows, firsts.tolist(), windows.tolist(), strict=True) if flags[f : f + w].any()]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for a, c, data in zip(*(batch.column(n).to_pylist() for n in ("anchor", "content", "bytes")), strict=True):
                if a != last and size >= SORTED_AT_ONCE:
                    if (done := settle(held)) is not None:
                        yield done
                    held, size = [], 0
                held.append((a, c, data))
                size += len(data)
                last = a
        if held and (done := settle(held)) is not None:
            yield done

    return contexts.select("anchor", "content", "bytes").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(common.lean(run), "anchor long, content long, flags binary")


def _counted_flags(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts, window by window."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: tuple[list, ...] = ([], [], [], [])
        for a, c, data in zip(*(batch.column(n).to_pylist() for n in ("anchor", "content", "bytes")), strict=True):
            for i in range(len(data) - LENGTH + 1):
                for column, value in zip(columns, (a, c, i, xxhash.xxh3_128_digest(data[i : i + LENGTH])), strict=True):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary())], ["anchor", "content", "i", "window"])

    windows = common.map_batches(contexts.select("anchor", "content", "bytes"), work, "anchor long, content long, i int, window binary")
    often = windows.groupBy("window").agg(F.count("*").alias("times")).where("times > 1").select("window")
    hits = windows.join(often, "window").groupBy("anchor", "content").agg(F.collect_list("i").alias("places"))  # at most RUN of a context

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for places in batch.column("places").to_pylist():
            flags = np.zeros(RUN, bool)
            flags[places] = True
            out.append(np.packbits(flags).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("content"), pa.array(out, pa.binary())], ["anchor", "content", "flags"])

    return common.map_batches(hits, pack, "anchor long, content long, flags binary")


def _spans(rows: DataFrame) -> DataFrame:
    """text_key, spans: begins and ends of the bytes to remove, from the repeated contexts of each text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for found in batch.column("found").to_pylist():
            covered = np.zeros(max(f["begin"] + f["n"] for f in found) + LENGTH, np.int32)
            for f in found:
                own = np.ones(f["n"], bool) if f["flags"] is None else np.unpackbits(np.frombuffer(f["flags"], np.uint8))[: f["n"]].astype(bool)
                places = f["begin"] + np.flatnonzero(own)
                np.add.at(covered, places, 1)
                np.add.at(covered, places + LENGTH, -1)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(covered) > 0).view(np.int8)])))
            out.append(edges.astype(np.int32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(out, pa.binary())], ["text_key", "spans"])

    gathered = rows.groupBy("text_key").agg(F.collect_set(F.struct("begin", "n", "flags")).alias("found"))  # bounded by the text
    return common.map_batches(gathered, work, "text_key binary, spans binary")


def spans_of(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """text_key, spans for each distinct text that holds repeats."""
    counted = _counted(docs).checkpoint()
    per_anchor = counted.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.bool_or("again").alias("within")).where("total > 1 OR within")
    recurring = counted.join(per_anchor, "anchor").select("anchor", "content", "n", "kinds", "within").checkpoint()
    mixed = recurring.where("kinds > 1 OR within")
    found = _occurrences(docs, _anchor_filter(recurring), _anchor_filter(mixed)).checkpoint()
    bytes_of = found.where("bytes IS NOT NULL").groupBy("anchor", "content").agg(F.first("bytes").alias("bytes"))
    contexts = bytes_of.join(mixed, ["anchor", "content"]).select("anchor", "content", "bytes", "n", "kinds")
    sorted_ = _sorted_flags(contexts.where(F.col("kinds") <= hot))
    flagged = sorted_.unionByName(_counted_flags(contexts.where(F.col("kinds") > hot)))
    partly = flagged.join(recurring.where("n = 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    repeated = recurring.where("n > 1").select("anchor", "content", F.lit(None).cast("binary").alias("flags")).unionByName(partly)
    return _spans(found.select("text_key", "anchor", "content", "begin", "n").join(repeated, ["anchor", "content"])).checkpoint()


def remove(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every row."""
    spans = spans_of(docs.select("doc_id", "text"), hot)
    places = spans.select(F.expr("cast(conv(substr(hex(text_key), 1, 15), 16, 10) as bigint)").alias("anchor"))
    some = _anchor_filter(places)

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [_text_key(t) for t in _encoded(batch)]
        hit = [_holds(some.value, int(k.hex()[:15], 16)) for k in keys]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(keys, pa.binary()), pa.array(hit, pa.bool_())], ["doc_id", "text", "text_key", "hit"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    keyed = common.map_batches(docs.select("doc_id", "text"), split, "doc_id long, text string, text_key binary, hit boolean")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: tuple[list, ...] = ([], [], [], [])
        for text, spans in zip(_encoded(batch), batch.column("spans").to_pylist(), strict=True):
            edges = np.frombuffer(spans or b"", np.int32)
            edges = edges if len(edges) % 2 == 0 else np.append(edges, len(text))
            begin, end = np.minimum(edges[::2], len(text)), np.minimum(edges[1::2], len(text))
            kept, at = [], 0
            for b, e in zip(begin.tolist(), end.tolist(), strict=True):
                kept.append(text[at:b])
                at = e
            kept.append(text[at:])
            for column, value in zip(columns, (len(text), int((end - begin).sum()), len(begin), b"".join(kept)), strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    with_spans = keyed.where("hit").join(spans, "text_key", "left").select("doc_id", "text", "spans")
    without = keyed.where("NOT hit").select("doc_id", "text", F.lit(None).cast("binary").alias("spans"))
    return common.map_batches(with_spans, cut, schema).unionByName(common.map_batches(without, cut, schema))


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
