"""Near-duplicate detection by one-permutation hashing.

The distinct shingle hashes of a document fall into bins of one hash range; a bin's value is
its least hash. An empty bin takes the value of the first occupied bin in an order of its
own, the same for all documents (optimal densification). Bins make bands, and equal bands
make buckets. A bucket gives star-shaped candidate edges, from one centre to its members;
buckets that the stars leave in several components are compared block against block. All
is confirmed on full shingle sets. Documents with equal sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import slices, stored
from meshtally.llm.components import components

# 72 bands of 8 bins: a pair of likeness 0.8 shares no band with probability 2e-6.
BANDS, ROWS = 72, 8
BINS = BANDS * ROWS
TRIES = 16
BLOCK = 1024  # members of a bucket that are compared with as many others at a time
BLOCK_SHINGLES = 1 << 20  # shingles of those members together
WIDTH = 4096  # shingles summed at a time
WORDS_KEPT = 300_000  # word hashes remembered by a task


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct hashes of the shingles of a text."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        tokens = text.encode().lower().split()  # bytes: ASCII letters and white space only
        if not tokens:
            return np.zeros(0, np.uint64)
        if len(tokens) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = xxhash.xxh3_64_intdigest(t)
        h = np.array([known[t] for t in tokens], np.uint64)
        last = len(h) - self.words + 1
        s = h[:last].copy()
        for k in range(1, self.words):
            s = mixed(s) + h[k:last + k]
        s = np.sort(mixed(s))
        return s[np.concatenate([[True], s[1:] != s[:-1]])]


class Signer:
    """Band hashes of a sorted set."""

    def __init__(self) -> None:
        rng = np.random.default_rng(8)
        self.order = rng.permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)
        self.factor = rng.integers(1, 1 << 63, BINS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        value = np.zeros(BINS, np.uint64)
        full = np.zeros(BINS, bool)
        value[bins[first]], full[bins[first]] = hashes[first], True
        empty = np.flatnonzero(~full)
        for k in range(TRIES):
            source = self.order[empty, k]
            found = full[source]
            value[empty[found]] = value[source[found]]
            empty = empty[~found]
            if not len(empty):
                break
        else:
            order = self.order[empty]
            value[empty] = value[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
        rows = mixed(value) * self.factor
        return mixed(rows.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64) ^ self.band)


def signed(docs: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """doc_id, set_hash, n_shingles and bands of each row; without shingles set_hash and bands are null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sign = Shingler(words), Signer()
        for batch in batches:
            at = 0
            for part in slices(batch.column(1).to_pylist()):
                sets = [shingles(t) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)),
                     pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([sign(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "set_hash", "n_shingles", "bands"])
                at += len(part)

    return (docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, "doc_id bigint, set_hash string, n_shingles bigint, bands array<bigint>"))


def sets_of(docs: DataFrame, nodes: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """(node, n, shingles) of the documents whose ids are in nodes; hashes as little-endian 64-bit words."""
    @F.arrow_udf("binary")
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = Shingler(words)
        for batch in batches:
            yield pa.array([make(t or "").tobytes() for t in batch.to_pylist()], pa.binary())

    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("node"), F.col(f"`{text}`").alias("_t"))
    return (texts.join(nodes, "node", "left_semi").dropDuplicates(["node"])
            .select("node", shingles("_t").alias("shingles")))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                out.append(False)
                continue
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            out.append(100 * common >= percent * (len(both) - common))
        return pa.array(out)

    return (pairs.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b")
            .where(alike("_sa", "_sb")).select("a", "b"))


def undecided(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (band, node, comp) of the buckets that links leave in more than one component.

    members: (band, node, n). A bucket gets as many blocks as its members or their n shingles need.
    """
    comps = components(links)
    at = members.join(comps, "node", "left").select("band", "node", "n", F.coalesce("label", "node").alias("comp"))
    split = stored(at.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.sum("n").alias("n"))
                   .where("lo < hi").select("band", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("n") / BLOCK_SHINGLES)).alias("blocks")))
    return stored(at.drop("n").join(split, "band"))


def across(nodes: list[int], comps: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Alike pairs of different components, one for each node and other component, within one comparison."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    renumbered = np.cumsum(count > 1) - 1
    owner, column = owner[shared], renumbered[column[shared]]
    common = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers, exact below 2 ** 24
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int((count > 1).sum()), WIDTH):
        lo, hi = np.searchsorted(column, [start, start + WIDTH])
        has = np.zeros((len(sets), WIDTH), np.float32)
        has[owner[lo:hi], column[lo:hi] - start] = 1
        common += has @ has.T
    whole = size[:, None] + size - common
    alike = (100 * common.astype(float) >= percent * whole) & (comps[:, None] < comps)
    if blocks[0] != blocks[-1]:  # pairs within a block have a comparison of their own
        alike &= blocks[:, None] != blocks
    a, b = np.nonzero(alike)
    _, first = np.unique(np.stack([a, comps[b]]), axis=1, return_index=True)
    return [(nodes[i], nodes[j]) for i, j in zip(a[first].tolist(), b[first].tolist())]


def compared(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components within buckets, block against block.

    A bucket of any size is split into blocks by its members' count and shingles, and each
    pair of blocks is one comparison of bounded size. Pairs are formed inside it as sums over shingles, never as rows.
    """
    own = F.pmod(F.xxhash64("node", F.lit(8)), "blocks")
    rows = (rest.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "comp", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def links() -> list[tuple[int, int]]:
            if len({h[1] for h in held}) < 2:
                return []
            return across([h[2] for h in held], np.array([h[1] for h in held]), np.array([h[0] for h in held]),
                          [np.frombuffer(h[3], "<u8") for h in held], percent)

        def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            out = []
            for band, i, j, *row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if key != (band, i, j):
                    out += links()
                    key, held = (band, i, j), []
                held.append(row)
            yield batch_of(out)
        yield batch_of(links())

    placed = rows.join(sets, "node").select("band", "i", "j", "own", "comp", "node", "shingles")
    return (placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "own")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def links_between(docs: DataFrame, nodes: DataFrame, words: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """Confirmed links (a, b) between classes that connect all that any link connects.

    nodes: (node, n, bands) of one document of each class. After the stars from each
    bucket's smallest node, the members of a bucket that are still in different components
    are compared with each other, so that no link is lost.
    """
    # Two different sets this much alike have 100 / (100 - percent) shingles together at least.
    least = -(-100 // max(1, 100 - percent)) - 1
    banded = nodes.where(F.col("n") >= least).select(F.explode("bands").alias("band"), "node", "n")
    shared = stored(banded.groupBy("band").agg(F.count("*").alias("size"), F.min("node").alias("centre"))
                    .where("size > 1").drop("size"))
    members = stored(banded.join(shared, "band"))
    sets = stored(sets_of(docs, members.select("node").distinct(), words, text, doc_id))
    stars = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(confirmed(stars, sets, percent))
    rest = undecided(members, links)
    return links if rest.isEmpty() else stored(links.unionByName(compared(rest, sets, percent)))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs.

    A document's set holds its distinct shingles of `words` words (ASCII letters lowered,
    split at ASCII white space); fewer words are one shingle. Documents are linked if
    their sets' common shingles are `percent` of all or more. component_id is the smallest
    doc_id that links reach. A null or empty text has no set and no link; a null doc_id
    is neither linked nor kept. A doc_id names one document: rows that repeat it repeat its
    text, and each gets the same result. Other columns are not read; an empty table gives none.
    """
    sig = stored(signed(docs, words, text, doc_id))
    named = sig.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(named.groupBy("set_hash").agg(F.min("doc_id").alias("node")))
    nodes = (named.select("set_hash", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands")
             .join(classes, ["set_hash", "node"]).dropDuplicates(["node"]))
    comps = components(links_between(docs, nodes, words, percent, text, doc_id))
    labels = stored(classes.join(comps, "node", "left")
                    .select("set_hash", F.coalesce("label", "node").alias("label")))
    out = sig.select("doc_id", "n_shingles", "set_hash").join(labels, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
