"""Packing in space-filling-curve order.

A document's tokens are hashed into a count vector, scaled to length one and projected to
few dimensions; the cell of its projection has a Hilbert key. Documents are range-sorted by
key, so alike documents lie near each other, and each partition's stretch of the curve is
cut into full sequences. What is left at a stretch's end is cut into power-of-two sequences,
so nothing is padded there either.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.llm.bpe import byte_letters
from meshtally.llm.common import read_bytes, slices, stored

HASHED = 4096  # width of the hashed document vector
DIMENSIONS, BITS = 3, 16
SEED = 20


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of whole numbers below 2**bits) along the Hilbert curve.

    Per bit, from the highest: the octant reflects and swaps the axes of what lies below it;
    the Gray code of the turned coordinates, read across the axes, is the key.
    """
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(axes):
            upper = (x[:, i] >> b) & 1 == 1
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, i] ^= swap
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[:, i] >> b) & 1
    return key


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as id arrays."""
    axes = np.random.default_rng(SEED).standard_normal((HASHED, DIMENSIONS))
    places = np.zeros((len(documents), DIMENSIONS))
    for k, ids in enumerate(documents):
        # Knuth's multiplicative hash spreads neighbouring ids over the vector.
        count = np.bincount((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20), minlength=HASHED)
        places[k] = count @ axes / np.sqrt(max(1, (count * count).sum()))
    share = 1 / (1 + np.exp(-1.702 * places))  # about the normal distribution function
    return hilbert_key(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def byte_level(content: bytes):
    """The vocabulary file's byte-level encoding; special strings in a text become their ids."""
    import tiktoken
    model = json.loads(content)
    byte = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    # Fixed value: the word pattern of byte-level vocabularies of this kind.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    coding = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return coding.encode(text, allowed_special="all", disallowed_special=())
        return coding.encode_ordinary(text)

    return encode


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, text: str, doc_id: str) -> DataFrame:
    """doc_id, key and ids (little-endian unsigned 32-bit) of each document."""
    content = read_bytes(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(content)
        for batch in batches:
            names, at = batch.column(0), 0
            for part in slices(batch.column(1).to_pylist()):
                ids = [np.array([*encode(t), end_id], "<u4") for t in part]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(at, len(part)), pa.array(curve_keys(ids), pa.int64()),
                     pa.array([i.tobytes() for i in ids], pa.binary())], ["doc_id", "key", "ids"])
                at += len(part)

    return (docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, "doc_id bigint, key bigint, ids binary"))


class Cutter:
    """Cuts a stream of documents into sequences of `most` ids, a power of two."""

    def __init__(self, most: int, first: int):
        self.most, self.sequence = most, first
        self.open: list[tuple] = []  # pieces of the sequence being filled
        self.filled = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            part = ids[start:start + self.most - self.filled]
            self.open.append((doc_id, start, part, len(ids)))
            self.filled += len(part)
            start += len(part)
            if self.filled == self.most:
                yield from self.close()

    def close(self) -> Iterator[tuple]:
        """The open sequence; one that isn't full becomes several of a power of two each."""
        room = 0
        for doc_id, start, part, total in self.open:
            at = 0
            while at < len(part):
                if not room:
                    room = size = 1 << (self.filled.bit_length() - 1)
                    self.filled -= size
                    sequence, self.sequence = self.sequence, self.sequence + 1
                piece = part[at:at + room]
                yield doc_id, start + at, piece, total, sequence, size - room
                room -= len(piece)
                at += len(piece)
        self.open, self.filled = [], 0


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, most: int = 2048, text: str = "text",
         doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Pieces of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    most: sequence length, a power of two. A null or empty text is its end id alone. Each
    row is one document: repeated rows and equal ids are packed once each, alike documents
    in the order of doc_id, then content; null doc_ids come first. Other columns are not
    read. An empty table gives no piece. with_ids=False leaves out the ids.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    tokens = stored(tokenised(docs, vocabulary, end_id, text, doc_id))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(most, TaskContext.get().partitionId() << 40)

        def made(pieces: list[tuple]) -> pa.RecordBatch:
            raw = [p[2].astype("<u4").tobytes() for p in pieces]
            rows = [(d, s, len(p), zlib.crc32(r), n, q, o) for (d, s, p, n, q, o), r in zip(pieces, raw)]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(names)
            if with_ids:
                cols.append(pa.array(raw, pa.binary()))
            return pa.RecordBatch.from_arrays(cols, [*names, *["ids"] * with_ids])

        for batch in batches:
            pieces = []
            for d, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                pieces += cut.add(d, np.frombuffer(raw, "<u4"))
                if len(pieces) >= 4096:
                    yield made(pieces)
                    pieces = []
            yield made(pieces)
        yield made(list(cut.close()))

    schema = ", ".join(f"{n} bigint" for n in names) + (", ids binary" if with_ids else "")
    return (tokens.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
            .mapInArrow(run, schema))
