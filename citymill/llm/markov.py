"""Hidden Markov language model: exact log-likelihood of every text under latent states.

Model. A token is a word (A to Z lower-cased) or the end of the text. Words with at least
`FREQUENT` of all training tokens are emitted by themselves; every other word is emitted as its
shape class and then drawn within the class by its smoothed training count:
    P(word) = P(class | state) * (c + 1) / (N_class + V_class + 1).
So the emission table is bounded (at most 1 / FREQUENT + SHAPES + 1 columns) while the counts of
all words, of all training texts, are used.

Steps. (1) Word counts, packed by hash bucket, from all training texts. (2) Token classes of
every text, packed by chunk of texts, in a checkpoint. (3) Start: all training texts are dealt to
`GROUPS` groups by the class that stands out most in them, a mixture is fitted to the groups' class
counts, then `FITS` rounds of EM for that mixture go over all training texts, each text on its own.
Nothing is sampled. (4) `ROUNDS` Baum-Welch rounds over all training texts:
exact expected counts of whole texts, summed across partitions in a tree. What enters each
segment of `SEGMENT` tokens is kept on the way forward, and the way back goes segment by
segment, so memory is bounded and no message between segments is lost.
(5) The scaled forward recursion over each whole text, in step for the texts of a chunk.
(6) Rare words meet their counts bucket by bucket; only sums for each text come back. Frequent
words never take part there, so no word is hot.

Words are told apart by a 64-bit hash. Null and empty texts have one token, the end. Very long
texts are scored whole. Repeated rows count and score each on their own; null ids count as the
empty text for the fold and stay null; extra columns are ignored; without training texts every
word is unknown and N is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FREQUENT = 2e-5
SHAPES = 1024
STATES = 8
GROUPS = 64
FITS = 3
ROUNDS = 2
TOKENS_AT_ONCE = 1 << 18
SEGMENT = 128  # tokens whose messages are held at once
STEPPED = 1_024  # texts in step
CHUNK_DOCS = 4_096
CHUNK_CHARS = 12_000_000
DOCS_IN_BUCKET = 4_000
END_HASH = np.uint64(0)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word code of each token, words by code, tokens of each text), without the ends."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(lowered, r"[\x20\x09-\x0D]+")
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    coded = flat.dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        owner, codes = owner[codes != empty], codes[codes != empty]
    return codes, words, np.bincount(owner, minlength=len(texts))


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit hashes; 0 is kept for the end."""
    found = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64) if len(words) else np.zeros(0, np.uint64)
    return np.where(found == END_HASH, np.uint64(1), found)


def shapes_of(words: pa.Array) -> np.ndarray:
    """The shape class of each word: its last two characters and how long it is."""
    tails = pc.utf8_slice_codeunits(words, -2).to_numpy(zero_copy_only=False) if len(words) else np.array([], object)
    lengths = np.minimum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) // 3, 4) if len(words) else np.zeros(0, np.int64)
    tail = pd.util.hash_array(tails, categorize=True).astype(np.uint64) if len(words) else np.zeros(0, np.uint64)
    return ((tail * np.uint64(5) + lengths.astype(np.uint64)) % np.uint64(SHAPES)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each has a bounded number of texts and of characters."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            limit = (sizes[at - 1] if at else 0) + chars
            to = min(at + CHUNK_DOCS, max(at + 1, int(np.searchsorted(sizes, limit, "right"))))
            yield batch.slice(at, to - at)
            at = to


def _packed(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_COUNTS = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("shapes", pa.binary()), ("counts", pa.binary())])


def _sum_by_hash(hashes: np.ndarray, shapes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, shapes, counts = hashes[order], shapes[order], counts[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], shapes[first], np.add.reduceat(counts, first) if len(first) else counts


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, hashes, shapes, counts: training counts of all words, packed by bucket of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            trained = batch.filter(pc.invert(batch.column("held_out")))
            codes, words, _ = tokens_of(trained.column("text"))
            counts = np.bincount(codes, minlength=len(words))
            hashes, shapes, counts = _sum_by_hash(np.r_[hashes_of(words), END_HASH], np.r_[shapes_of(words), -1], np.r_[counts, trained.num_rows])
            keep = counts > 0
            hashes, shapes, counts = hashes[keep], shapes[keep], counts[keep]
            own = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            cuts = np.searchsorted(own[order], np.arange(buckets + 1))
            yield _packed([{"bucket": b, "hashes": hashes[x].tobytes(), "shapes": shapes[x].astype(np.int16).tobytes(), "counts": counts[x].astype(np.int64).tobytes()} for b in np.unique(own).tolist() if len(x := order[cuts[b] : cuts[b + 1]])], _COUNTS)

    def merge(table: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        hashes, shapes, counts = _sum_by_hash(join("hashes", np.uint64), join("shapes", np.int16), join("counts", np.int64))
        return pa.Table.from_pylist([{"bucket": table.column("bucket")[0].as_py(), "hashes": hashes.tobytes(), "shapes": shapes.tobytes(), "counts": counts.tobytes()}], schema=_COUNTS)

    schema = "bucket int, hashes binary, shapes binary, counts binary"
    return docs.select("text", "held_out").mapInArrow(common.lean(run), schema).groupBy("bucket").applyInArrow(merge, schema)


class Vocabulary:
    """Training totals, the classes of frequent words and the smoothing of the shape classes; bounded by FREQUENT and SHAPES."""

    def __init__(self, counts: DataFrame):
        totals_schema = pa.schema([("n", pa.int64()), ("v", pa.int64())])

        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for c in batch.column("counts").to_pylist():
                    own = np.frombuffer(c, np.int64)
                    yield _packed([{"n": int(own.sum()), "v": len(own)}], totals_schema)

        row = counts.mapInArrow(common.lean(totals), "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
        self.n, self.v = int(row.n or 0), int(row.v or 0)
        least = max(2.0, FREQUENT * self.n)
        schema = pa.schema([("hash", pa.int64()), ("n", pa.int64()), ("v", pa.int64()), ("shape", pa.int32())])

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for h, s, c in zip(*(batch.column(x).to_pylist() for x in ("hashes", "shapes", "counts")), strict=True):
                    h, s, c = np.frombuffer(h, np.uint64), np.frombuffer(s, np.int16), np.frombuffer(c, np.int64)
                    top = (c >= least) | (h == END_HASH)
                    rest_n, rest_v = np.bincount(s[~top], c[~top], SHAPES), np.bincount(s[~top], minlength=SHAPES)
                    found = np.flatnonzero(rest_v)
                    yield pa.RecordBatch.from_arrays([pa.array(np.r_[h[top].view(np.int64), np.zeros(len(found), np.int64)]), pa.array(np.r_[c[top], rest_n[found].astype(np.int64)]), pa.array(np.r_[np.zeros(top.sum(), np.int64), rest_v[found]]), pa.array(np.r_[np.full(top.sum(), -1), found].astype(np.int32))], schema=schema)

        rows = counts.mapInArrow(common.lean(split), "hash long, n long, v long, shape int").groupBy("hash", "shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()  # at most 1 / FREQUENT + SHAPES rows
        top = sorted((np.uint64(r.hash & (1 << 64) - 1), r.n) for r in rows if r.shape < 0 and r.hash != 0)
        self.hashes, self.counts = np.array([h for h, _ in top], np.uint64), np.array([n for _, n in top], np.int64)
        self.end_count = sum(r.n for r in rows if r.shape < 0 and r.hash == 0)
        self.shape_n, self.shape_v = np.zeros(SHAPES), np.zeros(SHAPES)
        for r in rows:
            if r.shape >= 0:
                self.shape_n[r.shape], self.shape_v[r.shape] = r.n, r.v
        self.classes = 1 + SHAPES + len(top)  # end, shapes, frequent words

    def classes_of(self, hashes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, and its count where it is frequent (else -1)."""
        if not len(self.hashes):
            return 1 + shapes, np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        return np.where(known, 1 + SHAPES + at, 1 + shapes), np.where(known, self.counts[at], -1)


def _sequences(codes: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Classes of all tokens, each text followed by its end (class 0)."""
    out = np.zeros(len(codes) + len(lengths), np.uint16)
    ends = np.cumsum(lengths + 1) - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = classes[codes]
    return out


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K), (K, K), (K, classes)
        self.by_class = np.ascontiguousarray(emit.T)

    def likelihoods(self, sequence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each text's classes: scaled forward recursion, all texts in step."""
        order = np.argsort(-lengths, kind="stable")
        sizes, begins = lengths[order], (np.cumsum(lengths) - lengths)[order]
        total = np.zeros(len(lengths))
        alpha = np.tile(self.start, (len(lengths), 1))
        active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
        for t, n in enumerate(active):
            if t:
                alpha = alpha[:n] @ self.move
            alpha *= self.by_class[sequence[begins[:n] + t]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:n] += np.log10(scale)
        out = np.empty(len(lengths))
        out[order] = total
        return out

    def expected(self, sequence: np.ndarray, lengths: np.ndarray, into: list[np.ndarray]) -> None:
        """Adds the expected starts, moves and emissions of whole texts to into."""
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
        for at in range(0, len(lengths), STEPPED):
            self._expected(sequence, begins[at : at + STEPPED], lengths[at : at + STEPPED], into)

    def _expected(self, sequence: np.ndarray, begins: np.ndarray, lengths: np.ndarray, into: list[np.ndarray]) -> None:
        """The same for a few texts, longest first: forward once, keeping what enters each segment, then segment by segment backward."""
        steps, k = int(lengths[0]), len(self.start)
        active = np.append(np.searchsorted(-lengths, -np.arange(1, steps + 1), "right"), 0)  # texts that have a token t
        entering, ahead = [], np.tile(self.start, (len(lengths), 1))
        for t in range(steps):
            n = active[t]
            if t % SEGMENT == 0:
                entering.append(ahead[:n].copy())
            a = ahead[:n] * self.by_class[sequence[begins[:n] + t]]
            ahead = (a / a.sum(1, keepdims=True)) @ self.move
        behind = np.zeros((0, k))  # the message from the segment behind
        for segment in range(len(entering) - 1, -1, -1):
            first, last = segment * SEGMENT, min(steps, (segment + 1) * SEGMENT)
            alphas, emitted, scales, ahead = [], [], [], entering[segment]
            for t in range(first, last):
                n = active[t]
                e = self.by_class[sequence[begins[:n] + t]]
                a = ahead[:n] * e
                c = a.sum(1, keepdims=True)
                alphas.append(a / c)
                emitted.append(e)
                scales.append(c)
                ahead = alphas[-1] @ self.move
            gammas = []
            for t in range(last - 1, first - 1, -1):
                beta = np.ones((active[t], k))
                if m := active[t + 1]:
                    into[1] += alphas[t - first][:m].T @ behind
                    beta[:m] = behind @ self.move.T
                gammas.append(alphas[t - first] * beta)
                behind = emitted[t - first] * beta / scales[t - first]
            gammas.reverse()
            if not segment:
                into[0] += gammas[0].sum(0)
            seen = np.concatenate([sequence[begins[: active[t]] + t] for t in range(first, last)])
            gamma = np.concatenate(gammas)
            for j in range(k):
                into[2][j] += np.bincount(seen, gamma[:, j], into[2].shape[1])

    def shared_out(self, sequence: np.ndarray, lengths: np.ndarray, into: np.ndarray) -> None:
        """Adds the classes of each text to into (K, classes) by the shares of the states in it, one state for a whole text."""
        logs, ends = np.log(self.by_class), np.cumsum(lengths)
        at = 0
        while at < len(lengths):  # texts of about TOKENS_AT_ONCE tokens; a longer one alone in pieces
            first = ends[at] - lengths[at]
            to = max(at + 1, int(np.searchsorted(ends, first + TOKENS_AT_ONCE, "right")))
            fit = np.zeros((to - at, len(self.start)))
            begins = (ends - lengths)[at:to]
            for a in range(first, ends[to - 1], TOKENS_AT_ONCE):
                b = min(ends[to - 1], a + TOKENS_AT_ONCE)
                own = np.searchsorted(begins, np.arange(a, b), "right") - 1
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                fit[own[starts]] += np.add.reduceat(logs[sequence[a:b]], starts, axis=0)
            share = np.exp(fit - fit.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            for a in range(first, ends[to - 1], TOKENS_AT_ONCE):
                b = min(ends[to - 1], a + TOKENS_AT_ONCE)
                own = np.searchsorted(begins, np.arange(a, b), "right") - 1
                for k in range(len(self.start)):
                    into[k] += np.bincount(sequence[a:b], share[own, k], into.shape[1])
            at = to

    @staticmethod
    def zeros(states: int, classes: int) -> list[np.ndarray]:
        return [np.zeros(states), np.zeros((states, states)), np.zeros((states, classes))]

    def updated(self, counts: list[np.ndarray], background: np.ndarray) -> Model:
        """The next model from expected counts; background: share of each class, for smoothing."""
        start = counts[0] + 1e-3
        move = counts[1] * self.move + 1e-2
        emit = counts[2] + 5.0 * background + 1e-9
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def first_model(pairs: list[tuple[np.ndarray, np.ndarray]], background: np.ndarray, states: int) -> Model:
    """A mixture of class distributions over groups of texts (classes, times), by EM from groups far apart; each becomes a state."""
    classes = len(background)
    rng = np.random.default_rng(2)
    emit = np.tile(background, (states, 1))
    if pairs:
        sizes = np.array([n.sum() for _, n in pairs])
        chosen = [int(np.argmax(sizes))]
        far = np.full(len(pairs), np.inf)
        for _ in range(min(states, len(pairs)) - 1):  # next: the group that the chosen ones explain worst
            own = background.copy() * 50
            own[pairs[chosen[-1]][0]] += pairs[chosen[-1]][1]
            own /= own.sum()
            fit = np.array([(n @ np.log(background[c] / own[c])) / n.sum() for c, n in pairs])
            far = np.minimum(far, fit)
            far[sizes < 50] = -np.inf
            chosen.append(int(np.argmax(far)))
        for k, i in enumerate(chosen):
            own = background.copy() * 50
            own[pairs[i][0]] += pairs[i][1]
            emit[k] = own / own.sum()
        emit[len(chosen) :] *= rng.uniform(0.5, 1.5, (states - len(chosen), classes))
        emit /= emit.sum(1, keepdims=True)
        for _ in range(12):
            logs, grown = np.log(emit), np.tile(5.0 * background, (states, 1))
            for c, n in pairs:
                fit = logs[:, c] @ n
                share = np.exp(fit - fit.max())
                grown[:, c] += np.outer(share / share.sum(), n)
            emit = grown / grown.sum(1, keepdims=True)
    move = np.full((states, states), 0.02 / max(1, states - 1))
    np.fill_diagonal(move, 0.98)
    return Model(np.full(states, 1 / states), move, emit)


_REQUEST = pa.schema([("bucket", pa.int32()), ("chunk", pa.string()), ("n_docs", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("times", pa.binary())])


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, fits: int = FITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    spark = docs.sparkSession
    context = spark.sparkContext
    docs = docs.select("doc_id", "text", (common.fold_of(F.col("doc_id"), 7) == 2).alias("held_out"))
    n_docs = docs.count()
    buckets = max(16, -(-n_docs // DOCS_IN_BUCKET))
    counts = word_counts(docs, buckets).checkpoint()
    vocabulary = Vocabulary(counts)
    shared = context.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        own: Vocabulary = shared.value
        for number, batch in enumerate(_chunks(batches)):
            codes, words, lengths = tokens_of(batch.column("text"))
            hashes, shapes = hashes_of(words), shapes_of(words)
            classes, known = own.classes_of(hashes, shapes)
            count = np.full(len(codes), 0) if not len(codes) else known[codes]
            owner = np.repeat(np.arange(len(lengths)), lengths)
            base = np.bincount(owner, np.where(count >= 0, np.log10(np.maximum(count, 0) + 1.0), 0.0), len(lengths))
            tail = np.bincount(owner, np.where(count >= 0, 0.0, -np.log10(own.shape_n[shapes[codes]] + own.shape_v[shapes[codes]] + 1.0)) if len(codes) else None, len(lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{partition}/{number}"]),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool).tobytes()], pa.binary()),
                    pa.array([lengths.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([np.bincount(owner, count >= 0, len(lengths)).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([base.tobytes()], pa.binary()),
                    pa.array([tail.tobytes()], pa.binary()),
                    pa.array([_sequences(codes, lengths, classes).tobytes()], pa.binary()),
                    *(pa.array([x], pa.binary()) for x in _rare(hashes, codes, owner, count)),
                ],
                ["chunk", "doc_ids", "held_out", "lengths", "known", "base", "tail", "sequence", "rare_hashes", "rare_docs", "rare_times"],
            )

    chunks = docs.mapInArrow(common.lean(encode), "chunk string, doc_ids array<long>, held_out binary, lengths binary, known binary, base binary, tail binary, sequence binary, rare_hashes binary, rare_docs binary, rare_times binary").checkpoint()

    background = np.r_[vocabulary.end_count, vocabulary.shape_n, vocabulary.counts].astype(float) + 0.5
    background /= background.sum()
    model = first_model(_grouped(chunks, context.broadcast(background), vocabulary.classes), background, states)
    for _ in range(fits):
        model = refitted(model, _shared_out(chunks, context.broadcast(model), states, vocabulary.classes), background)
    for _ in range(rounds):
        model = model.updated(_expected(chunks, context.broadcast(model), states, vocabulary.classes), background)
    final = context.broadcast(model)

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, owner, times = np.frombuffer(row["rare_hashes"], np.uint64), np.frombuffer(row["rare_docs"], np.uint16), np.frombuffer(row["rare_times"], np.int32)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = [{"bucket": int(b), "chunk": row["chunk"], "n_docs": len(row["lengths"]) // 8, "hashes": hashes[x].tobytes(), "docs": owner[x].tobytes(), "times": times[x].tobytes()} for b in np.unique(bucket) if len(x := order[cuts[b] : cuts[b + 1]])]
                if out:
                    yield _packed(out, _REQUEST)

    answer_schema = pa.schema([("chunk", pa.string()), ("docs", pa.binary()), ("base", pa.binary()), ("known", pa.binary())])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(right.column("hashes").to_pylist()), np.uint64)
        found = np.frombuffer(b"".join(right.column("counts").to_pylist()), np.int64)
        out = []
        for row in left.to_pylist():
            asked, owner, times = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["times"], np.int32)
            at = np.minimum(np.searchsorted(hashes, asked), max(len(hashes) - 1, 0))
            count = np.where(hashes[at] == asked, found[at], 0) if len(hashes) else np.zeros(len(asked), np.int64)
            ids, where = np.unique(owner, return_inverse=True)
            out.append({"chunk": row["chunk"], "docs": ids.tobytes(), "base": np.bincount(where, times * np.log10(count + 1.0)).tobytes(), "known": np.bincount(where, times * (count > 0)).astype(np.int64).tobytes()})
        return pa.Table.from_pylist(out, schema=answer_schema)

    answers = chunks.select("chunk", "lengths", "rare_hashes", "rare_docs", "rare_times").mapInArrow(common.lean(request), "bucket int, chunk string, n_docs int, hashes binary, docs binary, times binary").groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(answer, "chunk string, docs binary, base binary, known binary")

    part_schema = "chunk string, doc_ids array<long>, held_out binary, lengths binary, docs binary, base binary, known binary, score binary"

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int64)
                score_ = final.value.likelihoods(np.frombuffer(row["sequence"], np.uint16), lengths + 1) + np.frombuffer(row["tail"])
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), pa.array([row["doc_ids"]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in (row["held_out"], row["lengths"], None, row["base"], row["known"], score_.tobytes()))], ["chunk", "doc_ids", "held_out", "lengths", "docs", "base", "known", "score"])

    own = chunks.select("chunk", "doc_ids", "held_out", "lengths", "known", "base", "tail", "sequence").mapInArrow(common.lean(forward), part_schema)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("doc_ids", "array<long>"), ("held_out", "binary"), ("lengths", "binary"))]
    parts = own.unionByName(answers.select("chunk", *empty, "docs", "base", "known", F.lit(None).cast("binary").alias("score")))
    n, v = vocabulary.n, vocabulary.v
    floor, end = math.log10(n + v + 1), math.log10(vocabulary.end_count + 1)
    result_schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def finish(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lead = next(r for r in rows if r["score"] is not None)
        lengths = np.frombuffer(lead["lengths"], np.int64)
        base, known, score_ = np.frombuffer(lead["base"]).copy(), np.frombuffer(lead["known"], np.int64).copy(), np.frombuffer(lead["score"]).copy()
        for r in sorted((r for r in rows if r["score"] is None), key=lambda r: (r["docs"], r["base"])):  # one order, so reruns agree
            ids, more = np.frombuffer(r["docs"], np.uint16), np.frombuffer(r["base"])
            base[ids] += more
            score_[ids] += more
            known[ids] += np.frombuffer(r["known"], np.int64)
        base += end - (lengths + 1) * floor
        known += int(vocabulary.end_count > 0)
        return pa.Table.from_arrays([pa.array(lead["doc_ids"], pa.int64()), pa.array(np.frombuffer(lead["held_out"], bool)), pa.array(lengths + 1), pa.array(known), pa.array(np.full(len(lengths), n)), pa.array(base), pa.array(score_)], schema=result_schema)

    return parts.groupBy("chunk").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _rare(hashes: np.ndarray, codes: np.ndarray, owner: np.ndarray, count: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Hash, text and times of each rare word of each text of a chunk, once."""
    rare = count < 0 if len(codes) else np.zeros(0, bool)
    pairs, times = np.unique(codes[rare].astype(np.int64) * CHUNK_DOCS + owner[rare], return_counts=True)
    return hashes[pairs // CHUNK_DOCS].tobytes(), (pairs % CHUNK_DOCS).astype(np.uint16).tobytes(), times.astype(np.int32).tobytes()


def _training(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequence and lengths of a chunk's training texts."""
    lengths, held = np.frombuffer(row["lengths"], np.int64) + 1, np.frombuffer(row["held_out"], bool)
    if not held.all():
        yield np.frombuffer(row["sequence"], np.uint16)[np.repeat(~held, lengths)], lengths[~held]


def _outstanding(sequence: np.ndarray, lengths: np.ndarray, background: np.ndarray) -> np.ndarray:
    """For each text the class with the largest times * log(times / expected times); ties to the smaller class."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    pairs, times = np.unique(owner * len(background) + sequence, return_counts=True)
    text, own = pairs // len(background), pairs % len(background)
    weight = times * np.log(times / (lengths[text] * background[own]))
    best = np.lexsort((own, -weight, text))
    return own[best[np.searchsorted(text, np.arange(len(lengths)))]]  # text is sorted, and so is text[best]


def _grouped(chunks: DataFrame, background, classes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Classes and their times in all training texts, by group; a text's group is its outstanding class modulo GROUPS."""

    def count(row: dict, into: np.ndarray) -> None:
        for sequence, lengths in _training(row):
            group = np.repeat(_outstanding(sequence, lengths, background.value) % GROUPS, lengths)
            found, times = np.unique(group * classes + sequence, return_counts=True)
            into[found // classes, found % classes] += times

    table = _summed(chunks, count, GROUPS, classes)
    return [(own, row[own]) for row in table if len(own := np.flatnonzero(row))]


def _shared_out(chunks: DataFrame, model, states: int, classes: int) -> np.ndarray:
    """Model.shared_out of all training texts."""

    def count(row: dict, into: np.ndarray) -> None:
        for sequence, lengths in _training(row):
            model.value.shared_out(sequence, lengths, into)

    return _summed(chunks, count, states, classes)


def refitted(model: Model, counts: np.ndarray, background: np.ndarray) -> Model:
    """The model with emissions from the counts of a mixture; background as in updated."""
    emit = counts + 5.0 * background + 1e-9
    return Model(model.start, model.move, emit / emit.sum(1, keepdims=True))


def _expected(chunks: DataFrame, model, states: int, classes: int) -> list[np.ndarray]:
    """Expected counts over all training texts."""

    def count(row: dict, into: np.ndarray) -> None:
        flat = into[0]
        parts = [flat[:states], flat[states : states + states**2].reshape(states, states), flat[states + states**2 :].reshape(states, classes)]
        for sequence, lengths in _training(row):
            model.value.expected(sequence, lengths, parts)

    flat = _summed(chunks, count, 1, states + states**2 + states * classes)[0]
    return [flat[:states], flat[states : states + states**2].reshape(states, states), flat[states + states**2 :].reshape(states, classes)]


def _summed(chunks: DataFrame, count, height: int, breadth: int) -> np.ndarray:
    """A table (height, breadth) to which count adds each chunk: summed in each task, then in a tree of its blocks."""
    width = 4096
    schema = pa.schema([("salt", pa.int32()), ("block", pa.int32()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        into = np.zeros((height, breadth))
        for batch in batches:
            for row in batch.to_pylist():
                count(row, into)
        flat = into.ravel()
        blocks = [(b, flat[b * width : (b + 1) * width]) for b in range(-(-len(flat) // width))]
        yield _packed([{"salt": TaskContext.get().partitionId() // 16, "block": b, "values": x.tobytes()} for b, x in blocks if x.any()], schema)

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["values"])  # one order, so reruns agree
        total = np.sum([np.frombuffer(r["values"]) for r in rows], axis=0)
        return pa.Table.from_pylist([{"salt": rows[0]["salt"] // 16, "block": rows[0]["block"], "values": total.tobytes()}], schema=schema)

    kind = "salt int, block int, values binary"
    summed = chunks.select("lengths", "held_out", "sequence").mapInArrow(common.lean(run), kind)
    parts = chunks.rdd.getNumPartitions()
    while True:
        summed = summed.groupBy("salt", "block").applyInArrow(add, kind)
        parts = -(-parts // 16)
        if parts <= 1:
            break
    flat = np.zeros(height * breadth)
    for r in summed.collect():  # one table of bounded size
        flat[r.block * width : (r.block + 1) * width] = np.frombuffer(r["values"])
    return flat.reshape(height, breadth)


def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
