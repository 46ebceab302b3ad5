"""Line deduplication with two Bloom filters.

Only hashes of lines meet first. Each shard of the hash space passes its hashes through a
once-seen filter; those that it may have held before go into a twice-seen filter. The
twice-seen filters, which hold repeats alone and are folded to a bounded size, are
broadcast. Lines that they don't know are unique and never shuffled; the suspected repeats
shuffle as text, are counted exactly, and the document that keeps the line is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import ascii_lower, stored

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}
BITS_PER_LINE, HASHES = 16, 4
LARGEST_SHARD = 1 << 28  # bits of a shard's filter
TWICE_BITS = 1 << 27  # bits of all twice-seen filters together: 16 MB, whatever the input


def line_key(line: str) -> str:
    line = line.strip(SPACE)
    return line.lower() if line.isascii() else line.translate(LOWER)


def keys_of(text: Column, least: int) -> Column:
    """Distinct keys of the lines of a text that are long enough to count."""
    keys = F.transform(F.split(text, "\n", -1), lambda l: ascii_lower(F.btrim(l, F.lit(SPACE))))
    return F.array_distinct(F.filter(keys, lambda k: F.length(k) >= least))


def shard_and_bits(hashes: np.ndarray, shards: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each hash, and its bit places (a row of HASHES) in a filter of `bits`, a power of two.

    The places in a filter half as long are these modulo its length, so a filter is folded
    by uniting its halves.
    """
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)  # the golden ratio's multiplier
    places = (mixed >> np.uint64(20))[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (h % np.uint64(shards)).astype(np.int64), (places & np.uint64(bits - 1)).astype(np.int64)


def holds(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filter_[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)


def put(filter_: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(filter_, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def twice_seen(hashes: DataFrame, n_lines: int) -> tuple[int, int, dict[int, bytes]]:
    """Shards, bits a shard, and the folded twice-seen filter of each shard that has repeats.

    hashes: one bigint column, a row for each line key of each document.
    """
    spark = hashes.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_lines * BITS_PER_LINE // LARGEST_SHARD))
    once_bits = 1 << max(10, (n_lines * BITS_PER_LINE // shards).bit_length())
    twice_bits = max(8, min(once_bits, 1 << (max(1, TWICE_BITS // shards).bit_length() - 1)))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two copies of a hash tell as much as many."""
        for batch in batches:
            h, n = np.unique(batch.column(0).to_numpy(), return_counts=True)
            h = np.concatenate([h, h[n > 1]])
            yield pa.RecordBatch.from_arrays([pa.array((h.view(np.uint64) % np.uint64(shards)).astype(np.int64)),
                                              pa.array(h)], ["shard", "hash"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            h, n = np.unique(batch.column(1).to_numpy(), return_counts=True)
            shard, places = shard_and_bits(h, shards, once_bits)
            for s in np.unique(shard).tolist():
                mine = shard == s
                if s not in once:
                    once[s] = np.zeros(once_bits // 8, np.uint8)
                    twice[s] = np.zeros(twice_bits // 8, np.uint8)
                again = holds(once[s], places[mine]) | (n[mine] > 1)
                put(twice[s], places[mine][again] & (twice_bits - 1))
                put(once[s], places[mine])
        rows = [(s, f.tobytes()) for s, f in twice.items() if f.any()]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int64()),
                                          pa.array([f for _, f in rows], pa.binary())], ["shard", "seen"])

    filters = (hashes.mapInArrow(thin, "shard bigint, hash bigint").repartition(shards, "shard")
               .mapInArrow(own, "shard bigint, seen binary"))
    return shards, twice_bits, {r.shard: bytes(r.seen) for r in filters.collect()}  # TWICE_BITS at most


def repeated(docs: DataFrame, text: str, doc_id: str, least: int) -> DataFrame:
    """(doc_id, key) of the keys that more than one document may hold: all that do, and few others."""
    spark = docs.sparkSession
    keyed = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.explode(keys_of(F.col(f"`{text}`"), least)).alias("key"))
    lines = F.length(F.col(f"`{text}`")) - F.length(F.replace(F.col(f"`{text}`"), F.lit("\n"), F.lit(""))) + 1
    n_lines = docs.agg(F.sum(lines)).first()[0] or 0
    shards, bits, filters = twice_seen(keyed.select(F.xxhash64("key").alias("hash")), n_lines)
    shared = spark.sparkContext.broadcast(filters)

    @F.arrow_udf("boolean")
    def suspected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen = {s: np.frombuffer(f, np.uint8) for s, f in shared.value.items()}
        for batch in batches:
            shard, places = shard_and_bits(batch.to_numpy(), shards, bits)
            out = np.zeros(len(shard), bool)
            for s in np.unique(shard).tolist():
                if s in seen:
                    out[shard == s] = holds(seen[s], places[shard == s])
            yield pa.array(out)

    return keyed.where(suspected(F.xxhash64("key"))).select("doc_id", "key")


def drops(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 20, documents: int = 3) -> DataFrame:
    """doc_id and `keys`, the line keys that it loses: all but the largest doc_id that holds them do."""
    suspects = stored(repeated(docs, text, doc_id, least))
    # Stored, so that Spark sees its size and can split a join on a very common line.
    common = stored(suspects.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
                    .where(F.col("n") >= documents).select("key", "last"))
    return (suspects.join(common, "key").where("doc_id < last")
            .groupBy("doc_id").agg(F.collect_set("key").alias("keys")))  # bounded by the document's own lines


KEPT = "struct<n_lines:bigint,n_dropped:bigint,text:string>"


def kept(text: Column, keys: Column) -> Column:
    """Line count, dropped lines and the remaining text."""
    @F.arrow_udf(KEPT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])
        for texts, lost in batches:
            rows = []
            for t, gone in zip(texts.to_pylist(), lost.to_pylist()):
                lines = (t or "").split("\n")
                gone = set(gone or ())
                stay = [l for l in lines if line_key(l) not in gone] if gone else lines
                rows.append({"n_lines": len(lines), "n_dropped": len(lines) - len(stay), "text": "\n".join(stay)})
            yield pa.array(rows, kind)

    return run(text, keys)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 20,
                documents: int = 3, into: str = "_kept_lines") -> DataFrame:
    """docs with a struct column `into`: n_lines, n_dropped and the text without repeated lines.

    A line's key is the line without white space at its ends, ASCII letters lowered. Keys of
    `least` code points or more that are in `documents` or more documents lose all their
    lines but those of the largest doc_id. A null or empty text is one empty line. A row
    without doc_id counts for no document and keeps its lines; rows that share a doc_id are
    one document. All other columns stay as they are, but for one named like `into`.
    """
    lost = drops(docs, text, doc_id, least, documents).toDF("lost_by", "keys")
    names = [F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()]
    # The caller's columns in one, so that none can be taken for a column of this step.
    rows = docs.select(F.struct(*names).alias("doc"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("bigint").alias("id"))
    return rows.join(lost, F.expr("id = lost_by"), "left").select("doc.*", kept(F.col("text"), F.col("keys")).alias(into))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "_kept_lines.n_lines", "_kept_lines.n_dropped",
        F.sha2(F.col("_kept_lines.text").cast("binary"), 256).alias("kept_sha256"))
