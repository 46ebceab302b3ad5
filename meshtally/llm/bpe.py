"""Byte-pair encoding and decoding with a pair occurrence index.

All distinct words of a slice of a partition are laid out in one symbol sequence. An index
maps each mergeable pair to all its positions in that sequence. Ranks that have positions
are applied in ascending order, every occurrence at once, and only the lists of the pairs
beside a merge are updated. So a word costs its merges once for the whole slice, however
often it occurs.

The vocabulary lower-cases, drops white space and marks word ends. White space therefore
separates independent chunks, and chunks met before are looked up.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import read_bytes, slices

# Fixed values of the vocabulary's word pattern; white space as its regular expressions see it.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"
CACHE = 3_000_000  # characters of chunks remembered by a task


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


def ordered(a: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order."""
    a = np.sort(a)
    return a[np.diff(a, prepend=-1) > 0]


class WordBpe:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: bytes):
        model = json.loads(content)
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.final = np.array([vocab[c + WORD_END] for c in letters])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges])
        self.right = np.array([vocab[b] for _, b in merges])
        self.made = np.array([vocab[a + b] for a, b in merges])
        self.size = max(self.token) + 1
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.words = regex.compile(WORD, regex.V1)
        self.chunk = regex.compile(rf"[^{SPACE}]+")
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[bytes, str]] = {}
        self.held = 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where the vocabulary doesn't merge it."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct, normalised words, and where each word's begin."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(w) for w in raw])
        ends = np.cumsum(lengths)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        sym[ends - 1] = self.final[flat[ends - 1]]
        nxt = np.arange(1, len(flat) + 1)
        nxt[ends - 1] = -1
        prv = np.arange(-1, len(flat) - 1)
        prv[ends - lengths] = -1
        alive = np.ones(len(flat), bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Add the pairs that begin at these positions to the index."""
            rank = self.ranks(sym[at], sym[nxt[at]])
            known = rank >= 0
            rank, at = rank[known], at[known]
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            starts = np.flatnonzero(np.diff(rank, prepend=-1))
            for r, places in zip(rank[starts].tolist(), np.split(at, starts[1:])):
                if r in index:
                    index[r].append(places)
                else:
                    index[r] = [places]
                    heapq.heappush(active, r)

        note(np.flatnonzero(nxt >= 0))
        while active:
            rank = heapq.heappop(active)
            at = ordered(np.concatenate(index.pop(rank)))
            at = at[alive[at] & (nxt[at] >= 0) & (sym[at] == self.left[rank])]
            at = at[sym[nxt[at]] == self.right[rank]]
            if self.left[rank] == self.right[rank] and len(at) > 1:
                keep, taken = [], -1
                for p, q in zip(at.tolist(), nxt[at].tolist()):  # of overlapping pairs the left one merges
                    if p != taken:
                        keep.append(p)
                        taken = q
                at = np.array(keep)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.made[rank]
            alive[gone] = False
            nxt[at] = after
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            note(ordered(np.concatenate([before[before >= 0], at[after >= 0]])))
        count = np.add.reduceat(alive, ends - lengths, dtype=np.int64)
        return sym[alive].astype("<u4"), np.concatenate([[0], np.cumsum(count)])

    def normal(self, chunk: str) -> str:
        if chunk.isascii():
            return chunk.lower()
        return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()

    def learn(self, chunks: set[str]) -> None:
        """Put new chunks into the caches."""
        size = sum(map(len, chunks))
        if self.held + size > CACHE:
            self.known.clear()
            self.held = 0
        self.held += size
        split = {c: self.words.findall(self.normal(c)) for c in chunks}
        words = list(set(chain.from_iterable(split.values())))
        if not words:
            return
        ids, at = self.encode_words(words)
        raw, shown, at = ids.tobytes(), list(map(self.token.__getitem__, ids.tolist())), at.tolist()
        of = {w: (raw[4 * i:4 * j], " ".join(shown[i:j])) for w, i, j in zip(words, at, at[1:])}
        for c, ws in split.items():
            self.known[c] = of[ws[0]] if len(ws) == 1 else (
                b"".join([of[w][0] for w in ws]), " ".join([of[w][1] for w in ws]))

    def chunks(self, text: str) -> list[str]:
        """White-space separated chunks; the strings of special tokens stand alone."""
        out = []
        for k, part in enumerate(self.parts.split(text) if self.parts and "<|" in text else [text]):
            if k % 2:
                out.append(part)
            elif any(c in part for c in "\x1c\x1d\x1e\x1f"):  # str.split takes these for white space
                out += self.chunk.findall(part)
            else:
                out += part.split()
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit words, and the decoded text, of each text."""
        split = [self.chunks(t) for t in texts]
        every = set().union(*split) - self.special.keys()
        if new := every - self.known.keys():
            self.learn(new)
        if missing := every - self.known.keys():  # the cache was emptied
            self.learn(missing)
        for s, i in self.special.items():
            self.known[s] = np.array([i], "<u4").tobytes(), s
        known = self.known
        for part in split:
            if part:
                ids, shown = zip(*[known[c] for c in part])
                yield b"".join(ids), " ".join(shown)
            else:
                yield b"", ""


ENCODED = "struct<ids:binary,decoded:string>"
DIGEST = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def encode(text: Column, vocabulary: str, digest: bool = False) -> Column:
    """Ids (little-endian unsigned 32-bit) and decoded text of a text column.

    vocabulary: path of a word-end BPE file. digest: the count and SHA-256 of both instead,
    so that neither leaves the task. Null and empty texts have no ids and decode to the
    empty text. The strings of special tokens become those tokens. Rows are independent of
    each other, so repeated rows, ties and other columns change nothing.
    """
    content = read_bytes(vocabulary)

    @F.arrow_udf(DIGEST if digest else ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = WordBpe(content)
        for batch in batches:
            rows = []
            for part in slices(batch.to_pylist()):
                for ids, decoded in model.encode(part):
                    if digest:
                        rows.append({"n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                                     "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()})
                    else:
                        rows.append({"ids": ids, "decoded": decoded})
            kind = ([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                    if digest else [("ids", pa.binary()), ("decoded", pa.string())])
            yield pa.array(rows, pa.struct(kind))

    return run(text)


def decode(ids: Column, vocabulary: str) -> Column:
    """Text of an ids column as `encode` makes it; a null decodes to the empty text."""
    content = read_bytes(vocabulary)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = WordBpe(content).token
        for batch in batches:
            yield pa.array([" ".join([token[i] for i in np.frombuffer(b or b"", "<u4").tolist()])
                            for b in batch.to_pylist()], pa.string())

    return run(ids)


def digests(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of docs; an empty table gives none."""
    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                        encode(F.col(f"`{text}`"), vocabulary, digest=True).alias("_e"))
    return found.select("doc_id", "_e.*")
