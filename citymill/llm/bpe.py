"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 token, rank) becomes a tokenizers BPE model. The model works on
characters, so every byte is written as one printable character (the byte table); decoding
reverses that table and joins bytes before any UTF-8 decoding, so a character that is split
over several tokens comes back whole.

Null or empty text gives no ids and empty bytes. Very long texts are encoded whole. Repeated
rows, rows with null ids and extra columns are simply carried along or ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common


@functools.cache
def byte_table() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else 256 and up."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PieceEncoder:
    """Encodes texts piece by piece; a piece is one match of the pattern and is merged on its own.

    Pieces repeat often, so each new one goes through the tokenizers library once, in batches,
    and its ids and offsets are kept. The memo is emptied when it holds `most` pieces.

    A rank file allows every pair whose concatenation is a token, in the order of that token's
    rank, so all splits of a token into two tokens are listed as merges, in rank order.
    """

    def __init__(self, path: str, pattern: str, most: int = 60_000, step_chars: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, table = load_ranks(path), byte_table()
        written = {token: "".join(table[b] for b in token) for token in ranks}
        merges = [(written[t[:i]], written[t[i:]]) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.tokenizer = Tokenizer(models.BPE({written[t]: r for t, r in ranks.items()}, merges, ignore_merges=True, cache_capacity=0))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces_of = regex.compile(pattern, flags=regex.V0).findall
        self.most, self.step_chars = most, step_chars
        self.memo: dict[str, object] = {}
        back = {c: b for b, c in enumerate(table)}
        self.bytes_of = {rank: bytes(back[c] for c in written[token]) for token, rank in ranks.items()}

    def kept(self, encoding) -> object:
        """What the memo keeps of a piece's encoding: its ids and character offsets."""
        return encoding.ids, encoding.offsets

    def known(self, texts: Iterable[str]) -> Iterator[list]:
        """For each text, what the memo keeps of its pieces, in order."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.pieces_of(text))
            size += len(text)
            if size >= self.step_chars:
                yield from self._of(held)
                held, size = [], 0
        yield from self._of(held)

    def _of(self, held: list[list[str]]) -> Iterator[list]:
        if len(self.memo) > self.most:
            self.memo.clear()
        memo = self.memo
        if new := list(set().union(*held).difference(memo)):
            for at in range(0, len(new), 10_000):
                part = new[at : at + 10_000]
                memo.update(zip(part, map(self.kept, self.tokenizer.encode_batch(part, add_special_tokens=False)), strict=True))
        for pieces in held:
            yield [memo[p] for p in pieces]

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[list[int], list[tuple[int, int]]]]:
        """Ids and character offsets of each text; tokens that share a split character share its span."""
        for parts in self.known(texts):
            ids, offsets, at = [], [], 0
            for i, spans in parts:
                ids += i
                offsets += [(at + a, at + b) for a, b in spans]
                at = offsets[-1][1] if offsets else at
            yield ids, offsets

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes through the reversed byte table, joined before any UTF-8 decoding."""
        return b"".join([self.bytes_of[i] for i in ids])


class IdEncoder(PieceEncoder):
    """Keeps the ids of each piece only."""

    def kept(self, encoding) -> object:
        return encoding.ids

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[list[int], list[tuple[int, int]]]]:
        for parts in self.known(texts):
            yield [i for ids in parts for i in ids], []


class DigestEncoder(PieceEncoder):
    """Keeps, for each piece, the number of ids, their decimal text and the bytes they decode to."""

    def kept(self, encoding) -> object:
        return len(encoding.ids), ",".join(map(str, encoding.ids)), self.decode(encoding.ids)


def encoder(path: str, pattern: str, kind: type[PieceEncoder] = PieceEncoder) -> PieceEncoder:
    """A new encoder, for one task: it takes a third of a second to build, and goes with its task."""
    return kind(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", offsets: bool = False, checked: bool = False) -> DataFrame:
    """(id, ids, decoded[, starts, ends]): token ids, the bytes they decode to, character offsets.

    checked: instead of decoded, round_trip says whether the ids decode to the text's bytes.

    Offsets are in characters of the text; tokens that share a split character share its span.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    second = ("round_trip", "boolean", pa.bool_()) if checked else ("decoded", "binary", pa.binary())
    schema = f"`{id_column}` {kind}, ids array<int>, {second[0]} {second[1]}" + (", starts array<int>, ends array<int>" if offsets else "")

    def work(batch: pa.RecordBatch, own: PieceEncoder) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        texts = common.texts_of(batch, text_column)
        for text, (ids, spans) in zip(texts, own.encode(texts), strict=True):
            decoded = own.decode(ids)
            columns[0].append(ids)
            columns[1].append(decoded == text.encode() if checked else decoded)
            if offsets:
                columns[2].append([a for a, _ in spans])
                columns[3].append([b for _, b in spans])
        kinds = (pa.list_(pa.int32()), second[2], pa.list_(pa.int32()), pa.list_(pa.int32()))[: 4 if offsets else 2]
        return pa.RecordBatch.from_arrays([batch.column(id_column), *map(pa.array, columns, kinds)], [id_column, "ids", second[0], "starts", "ends"][: 5 if offsets else 3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern, PieceEncoder if offsets else IdEncoder)
        for batch in common.slices(batches):
            yield work(batch, own)

    return docs.select(id_column, text_column).mapInArrow(common.lean(run), schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 by the same encoder, without carrying ids through Spark."""

    def work(batch: pa.RecordBatch, own: DigestEncoder) -> pa.RecordBatch:
        counts, ids_sha, decoded_sha = [], [], []
        for parts in own.known(common.texts_of(batch, "text")):
            counts.append(sum([n for n, _, _ in parts]))
            ids_sha.append(common.sha256_hex(",".join([t for _, t, _ in parts]).encode()))
            decoded_sha.append(common.sha256_hex(b"".join([b for _, _, b in parts])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern, DigestEncoder)
        for batch in common.slices(batches):
            yield work(batch, own)

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> tuple[str, str]:
    """The rank file and pattern of the registered query; both are parameters of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.read(spark, sf_dir, "documents"), *vocabulary())
