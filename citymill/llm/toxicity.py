"""Toxicity from the nearest labelled examples by exact weighted TF-IDF cosine in a block-max index.

1. Examples: at most `SAMPLE` labelled training rows, by a hash of their id; exact copies of a
   text among them count once, with the label of the smallest id.
2. Terms: all words of the examples, clean and toxic; none is left out. A word weighs its
   inverse document frequency times one plus the log-likelihood ratio by which it leans to
   toxic examples (plus nothing where it does not).
3. Document frequencies come from all documents, not from the sample.
4. The examples' unit vectors are posted by term, in blocks of `BLOCK` examples that lie close
   together. Postings of rare terms are added up at once; for the `DENSE` most common terms,
   found in most texts, each block holds every term's largest weight. What these allow a block
   at most, with its best sum of rare terms, is its bound. The `FIRST` blocks of the highest
   bounds give a text its k-th best similarity so far, and only blocks whose bound reaches that
   are opened. Sums run in single precision, and all examples that can be among the k best are
   compared again in double, in one order of terms, so neighbours are those of a full scan.
5. The score is the similarity-weighted vote of the neighbours, smoothed towards the share of
   label 1 among the examples. Neighbours are returned as evidence.

Null or empty text, and text without a word of any example, has no neighbour and takes the share
of label 1 among examples without a word that leans to toxic by `LIFT` and `GAIN`. Without any
labelled row the share is 0. Very long texts are read whole. Repeated rows score alike; ties in
similarity go to the smaller doc_id; a doc_id that has several labels counts as toxic if
any is; null labels and null ids take no part in training. Extra columns are ignored, or kept by
`judge`. Memory grows with the words of the sample (12 bytes a word and example, and 8 more for rare
words). The index is made by a task and goes through the driver as bytes, once; a worker holds it no
longer than a task lasts.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 6_000
GAIN = 18.0
LIFT = 5.0  # times as common among toxic examples as among others, at least
BLOCK = 64  # examples
FIRST = 3  # blocks that give the first neighbours
DENSE = 1_024  # terms kept as a matrix
ROWS = 256  # texts compared at once
MARGIN = 1e-4  # more than single precision loses in a product of unit vectors
NEIGHBOURS = 15
LETTERS = re.compile(r"[^\W\d_]+")
PIECE = 4_000_000  # bytes of a row of the packed index
EXAMPLES = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("copy", pa.int64()), ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int32()))])


class Index:
    """Inverted index over the examples' unit vectors.

    examples: doc_id, label, and the counts of each as arrays (starts, terms, counts) in one piece.
    Terms are numbered by falling number of examples, so the first `DENSE` are the most common.
    """

    def __init__(self, words: list[str], idf: np.ndarray, ids: list[int], labels: list[int], starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, bare: float, overall: float, neighbours: int = NEIGHBOURS):
        self.words, self.idf, self.ids, self.labels = words, idf, ids, np.array(labels, float)
        self.bare, self.overall, self.k, self.starts, self.of = bare, overall, neighbours, starts, terms
        weights = (1 + np.log(counts)) * idf[terms]
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        norm = np.sqrt(np.bincount(row, weights * weights, len(ids)))
        self.weights = weights / norm[row]
        self._place(_close_together(self._matrix()))
        self._build()

    def _matrix(self) -> np.ndarray:
        """(terms, examples): weights of the most common terms."""
        out = np.zeros((min(DENSE, len(self.words)), len(self.ids)), np.float32)
        row, often = np.repeat(np.arange(len(self.ids)), np.diff(self.starts)), self.of < len(out)
        out[self.of[often], row[often]] = self.weights[often]
        return out

    def _place(self, order: np.ndarray) -> None:
        """Puts the examples into this order."""
        sizes = np.diff(self.starts)[order]
        taken = np.arange(sizes.sum()) + np.repeat(self.starts[:-1][order] - (np.cumsum(sizes) - sizes), sizes)
        self.ids, self.labels = [self.ids[k] for k in order.tolist()], self.labels[order]
        self.of, self.weights = self.of[taken], self.weights[taken]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("terms", "dense", "most", "begins", "at", "rows", "values")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._build()
        common.release()

    def _build(self) -> None:
        """What follows from the vectors: terms' numbers, the matrix of common terms, and postings (at, rows, values) of rare ones."""
        self.terms = {w: k for k, w in enumerate(self.words)}
        self.dense = self._matrix()
        row = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.starts))
        rare = np.flatnonzero(self.of >= len(self.dense))
        order = rare[np.argsort(self.of[rare], kind="stable")]
        self.rows, self.values = row[order], self.weights[order].astype(np.float32)
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.of[rare], minlength=len(self.words)))]).astype(np.int64)
        self.begins = np.arange(0, len(self.ids), BLOCK)
        self.most = np.maximum.reduceat(self.dense, self.begins, axis=1) if len(self.ids) else self.dense

    @property
    def postings(self) -> dict[int, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Rows and weights by term and block of `BLOCK` examples; to look into the index, not to search."""
        out: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
        row, order = np.repeat(np.arange(len(self.ids)), np.diff(self.starts)), np.argsort(self.of, kind="stable")
        ends = np.cumsum(np.bincount(self.of, minlength=len(self.words)))
        for t, own in enumerate(np.split(order, ends[:-1]) if len(ends) else []):
            rows, values = row[own], self.weights[own]
            out[t] = {int(b): (rows[rows // BLOCK == b] % BLOCK, values[rows // BLOCK == b]) for b in np.unique(rows // BLOCK)}
        return out

    def unit(self, counts: dict[int, float]) -> dict[int, float]:
        if not counts:
            return {}
        terms = np.array(sorted(counts))
        weights = (1 + np.log([counts[t] for t in terms.tolist()])) * self.idf[terms]
        return dict(zip(terms.tolist(), (weights / math.sqrt((weights * weights).sum())).tolist(), strict=True))

    def counts(self, text: str) -> dict[int, float]:
        known = self.terms
        return {known[w]: n for w, n in Counter(LETTERS.findall(text.lower())).items() if w in known}

    def nearest(self, text: str) -> list[tuple[float, int]]:
        """(similarity, row) of the k nearest examples that share a term, nearest first."""
        return self.nearest_of([text])[0]

    def nearest_of(self, texts: list[str]) -> list[list[tuple[float, int]]]:
        return [found for at in range(0, len(texts), ROWS) for found in self._nearest_of(texts[at : at + ROWS])]

    def _nearest_of(self, texts: list[str]) -> list[list[tuple[float, int]]]:
        n, m = len(self.ids), len(self.dense)
        if not n:
            return [[] for _ in texts]
        own = [(np.fromiter(v, np.int64, len(v)), np.fromiter(v.values(), float, len(v))) for v in (self.unit(self.counts(t)) for t in texts)]
        matrix = np.zeros((len(texts), m), np.float32)
        for k, (terms, weights) in enumerate(own):
            few = int(np.searchsorted(terms, m))
            matrix[k, terms[:few]] = weights[:few]
        scores = np.zeros((len(texts), n), np.float32)  # of rare terms
        for k, (terms, weights) in enumerate(own):
            few = int(np.searchsorted(terms, m))
            start = self.at[terms[few:]]
            size = self.at[terms[few:] + 1] - start
            total = int(size.sum())
            if total:
                entries = np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)
                scores[k] = np.bincount(self.rows[entries], self.values[entries] * np.repeat(weights[few:], size), n)
        self.open(matrix, scores)
        whole, out = np.zeros(len(self.words)), []
        for k, (terms, weights) in enumerate(own):
            least = max(0.0, float(np.partition(scores[k], n - self.k)[n - self.k]) - MARGIN) if n > self.k else 0.0
            whole[terms] = weights
            found = []
            for r in np.flatnonzero(scores[k] >= least if least else scores[k] > 0).tolist():
                a, b = self.starts[r], self.starts[r + 1]
                found.append((-float((whole[self.of[a:b]] * self.weights[a:b]).sum()), self.ids[r], r))
            whole[terms] = 0
            out.append([(-s, r) for s, _, r in sorted(found)[: self.k]])
        return out

    def open(self, matrix: np.ndarray, scores: np.ndarray) -> float:
        """Completes scores by the common terms in the blocks that can hold a neighbour, and lowers them to -1 elsewhere; the share of blocks opened."""
        n, blocks = scores.shape[1], len(self.begins)
        bounds = np.maximum.reduceat(scores, self.begins, axis=1) + matrix @ self.most + np.float32(MARGIN)
        opened = np.zeros((len(matrix), blocks), bool)

        def add(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)).tolist():
                at, rows = slice(b * BLOCK, min(n, (b + 1) * BLOCK)), np.flatnonzero(wanted[:, b])
                scores[rows, at] += matrix[rows] @ self.dense[:, at]
            opened[wanted] = True

        first = min(blocks, max(FIRST, -(-2 * self.k // BLOCK)))
        best = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        wanted = np.zeros_like(opened)
        np.put_along_axis(wanted, best, True, 1)
        add(wanted)
        places = (best[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(len(matrix), -1)
        known = np.where(places < n, np.take_along_axis(scores, np.minimum(places, n - 1), 1), np.float32(-1))
        least = np.partition(known, known.shape[1] - self.k, axis=1)[:, known.shape[1] - self.k]
        add((bounds >= least[:, None] - np.float32(MARGIN)) & ~opened & (bounds > 2 * MARGIN))
        scores[~np.repeat(opened, np.diff(np.append(self.begins, n)), axis=1)] = -1
        return float(opened.mean())

    def score(self, found: list[tuple[float, int]], smooth: float = 0.25) -> float:
        if not found:
            return self.bare
        total = sum(s for s, _ in found)
        return float((sum(s * self.labels[r] for s, r in found) + smooth * self.overall) / (total + smooth))


def _close_together(dense: np.ndarray) -> np.ndarray:
    """An order of the examples in which those of a block are alike: halves between two far apart, again and again."""
    left, out = [np.arange(dense.shape[1])], [np.zeros(0, np.int64)]
    while left:
        own = left.pop()
        if len(own) <= BLOCK:
            out.append(own)
            continue
        x = dense[:, own]
        one = x[:, np.argmin(x.mean(1) @ x)]
        two = x[:, np.argmin(one @ x)]
        order = own[np.argsort((two - one) @ x, kind="stable")]
        half = max(BLOCK, len(own) // 2 // BLOCK * BLOCK)
        left += [order[half:], order[:half]]
    return np.concatenate(out)


def _examples(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, toxic, copy (a hash of the text), words and their times of at most `sample` training rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (common.fold_of(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, text, label in zip(batch.column("doc_id").to_pylist(), common.texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
            found = LETTERS.findall(text.lower())
            counts = Counter(found)
            out.append({"doc_id": doc_id, "toxic": int(label), "copy": xxhash.xxh64_intdigest(text) - (1 << 63), "words": list(counts), "times": list(counts.values())})
        return pa.RecordBatch.from_pylist(out, EXAMPLES)

    return common.map_batches(rows, work, "doc_id long, toxic int, copy long, words array<string>, times array<int>").checkpoint()


def _gains(n1: np.ndarray, n0: np.ndarray, all1: int, all0: int) -> np.ndarray:
    """Log-likelihood ratios of words found in n1 of all1 toxic and n0 of all0 other examples; 0 where they do not lean to toxic."""
    share, total = (n1 + n0) / max(1, all1 + all0), np.zeros(len(n1))
    with np.errstate(divide="ignore", invalid="ignore"):
        for n, size in ((n1, all1), (n0, all0)):
            for k, p in ((n, share), (size - n, 1 - share)):
                total += np.where(k > 0, k * np.log(k / (size * p)), 0.0)
    return np.where(n1 * all0 > n0 * all1, 2 * np.maximum(total, 0.0), 0.0)


class Packed:
    """An index as bytes; what a worker reads from its broadcast is the index."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self) -> tuple:
        return pickle.loads, (self.data,)


def _in_one_task(rows: DataFrame, work: Callable[[pa.Table], bytes]) -> bytes:
    """What work makes of all examples, of which there are at most the sample; the driver only holds the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = work(pa.Table.from_batches(list(batches), EXAMPLES))
        for at in range(0, len(data), PIECE):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([data[at : at + PIECE]], pa.binary())], ["at", "data"])

    found = rows.repartition(1).mapInArrow(common.lean(run), "at long, data binary").toArrow()
    pieces = [found["data"][k].as_buffer() for k in np.argsort(found["at"].to_numpy()).tolist()]
    data = b"".join(pieces) if pieces else work(EXAMPLES.empty_table())  # no rows, no task
    del found, pieces
    common.release()
    return data


def _distinct(rows: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """ids, labels, and the vectors (starts, terms, counts) and words of the examples that count."""
    seen: set[int] = set()
    kept: dict[int, tuple[int, int]] = {}  # label and place
    for doc_id, copy, label, place in sorted(zip(rows["doc_id"].to_pylist(), rows["copy"].to_pylist(), rows["toxic"].to_pylist(), range(len(rows)), strict=True)):
        if copy not in seen and doc_id not in kept:
            kept[doc_id] = (label, place)
        seen.add(copy)
    ids, label = sorted(kept), np.array([kept[i][0] for i in sorted(kept)], np.int64)
    taken = rows.select(["words", "times"]).take(pa.array([kept[i][1] for i in ids], pa.int64())).combine_chunks()
    lists = pa.concat_arrays(taken["words"].chunks) if taken["words"].num_chunks else pa.array([], pa.list_(pa.string()))
    times = pa.concat_arrays(taken["times"].chunks) if taken["times"].num_chunks else pa.array([], pa.list_(pa.int32()))
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    number, counts = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), times.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = len(coded.dictionary)
    order = np.argsort(-np.bincount(number, minlength=size), kind="stable")
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    return ids, label, starts, rank[number].astype(np.int32), counts, coded.dictionary.take(pa.array(order)).to_pylist()


def _index(rows: pa.Table, frequency: np.ndarray, n_docs: int) -> Index:
    ids, label, starts, terms, counts, words = _distinct(rows)
    all1, all0, size = int(label.sum()), int(len(label) - label.sum()), len(words)
    row = np.repeat(np.arange(len(ids)), np.diff(starts))
    n1 = np.bincount(terms, label[row], size)
    n0 = np.bincount(terms, 1 - label[row], size)
    gains = _gains(n1, n0, all1, all0)
    idf = (np.log((1 + n_docs) / (1 + frequency)) + 1) * (1 + gains)
    leans = (gains >= GAIN) & (n1 * max(all0, 1) >= LIFT * n0 * max(all1, 1))
    overall = all1 / len(ids) if ids else 0.0
    without = label[np.bincount(row, leans[terms], len(ids)) == 0] if ids else label
    return Index(words, idf, ids, label.tolist(), starts, terms, counts, float(without.sum() + overall) / (len(without) + 1), overall)


def pack(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Packed:
    """The index over the training examples of docs and labels, made by tasks; the driver never holds it but as bytes."""
    rows = _examples(docs, labels, sample).dropDuplicates(["doc_id", "copy"])
    words = _in_one_task(rows, lambda table: "\n".join(_distinct(table)[-1]).encode())  # a word has letters only
    frequency, n_docs = document_frequency(docs, words)
    return Packed(_in_one_task(rows, lambda table: pickle.dumps(_index(table, frequency, n_docs), pickle.HIGHEST_PROTOCOL)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Index:
    """The index of `pack`, to look into here."""
    return pickle.loads(pack(docs, labels, sample).data)


def document_frequency(docs: DataFrame, words: bytes) -> tuple[np.ndarray, int]:
    """In how many of all documents each word (in UTF-8, one a line) occurs, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(words)  # bounded by the sample's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: k for k, w in enumerate(shared.value.decode().split("\n"))} if shared.value else {}
        total, n = np.zeros(len(known) + 1, np.int64), 0
        for batch in batches:
            for text in common.texts_of(batch, "text"):
                n += 1
                total[[known[w] for w in set(LETTERS.findall(text.lower())) if w in known]] += 1
        total[-1] = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["term", "n"])

    frequency = np.zeros((words.count(b"\n") + 1 if words else 0) + 1, np.int64)
    found = docs.select("text").mapInArrow(common.lean(run), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row for each word
    frequency[found["term"].to_numpy()] = found["n"].to_numpy()
    return frequency[:-1], int(frequency[-1])


def judge(docs: DataFrame, index: Index | Packed, evidence: bool = True) -> DataFrame:
    """docs with score, predicted and, if asked for, neighbours (doc_id, similarity, label)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample
    clash = {"score", "predicted", "neighbours"}
    columns = [c for c in docs.columns if c not in clash]
    docs = docs.select(*columns)
    extra = [("score", pa.float64()), ("predicted", pa.int32())] + [("neighbours", pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())])))] * evidence

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        found = own.nearest_of(common.texts_of(batch, "text"))
        scores = [own.score(x) for x in found]
        values = [scores, [int(s >= 0.5) for s in scores]] + [[[{"doc_id": own.ids[r], "similarity": s, "label": int(own.labels[r])} for s, r in x] for x in found]] * evidence
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, kind) for v, (_, kind) in zip(values, extra, strict=True))], [*columns, *(n for n, _ in extra)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return common.map_batches(docs, work, f"{schema}, score double, predicted int" + (", neighbours array<struct<doc_id:bigint,similarity:double,label:int>>" if evidence else ""), large=shared)


def op5_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents").select("doc_id", "text"), common.read(spark, sf_dir, "labels")
    judged = judge(docs, pack(docs, labels))
    return judged.select("doc_id", (common.fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "neighbours")
