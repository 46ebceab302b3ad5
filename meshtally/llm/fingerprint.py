"""Document fingerprints: quartile bucket digests.

The overlapping byte triplets of a text are hashed into buckets and counted. Each bucket is
coded by the quartile of all buckets that its count lies in, two bits a bucket, after one
byte for the text's length on a logarithmic scale. Digests are compared bucket by bucket
and by length; the difference is bounded, so likeness runs from 0 to 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
GROWTH = 1.25  # a length code more for each so many times the length
MOST = 400  # difference from which digests have no likeness
LENGTH_STEP, MOST_LENGTH = 4, 100
LOWEST = -(1 << 63)
TASK_BYTES = 32 << 20  # text that a task takes
MOST_BLOCKS = 1 << 16  # each has a row on the driver; beyond it blocks grow, and their sort spills


def digest(text: str) -> str:
    """Hex digest: length code, then the buckets' quartiles."""
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    count = np.zeros(BUCKETS, np.int64)
    if len(raw) >= 3:
        mixed = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)  # Knuth's multiplier
        count = np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    ranked = np.sort(count)
    code = sum((count > ranked[k * BUCKETS // 4 - 1]).astype(np.uint8) for k in (1, 2, 3))
    packed = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    length = min(255, round(math.log(1 + len(raw), GROWTH)))
    return bytes([length]).hex() + packed.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling to 0 at the bound; opposite quartiles count double."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    apart = min(MOST_LENGTH, LENGTH_STEP * abs(int(x[0]) - int(y[0])))
    for shift in (0, 2, 4, 6):
        steps = np.abs((x[1:] >> shift & 3).astype(int) - (y[1:] >> shift & 3))
        apart += int(steps.sum()) + 3 * int((steps == 3).sum())
    return 1 - min(MOST, apart) / MOST


def with_next(docs: DataFrame, text: str, doc_id: str, blocks: int, tasks: int) -> DataFrame:
    """Rows of blocks of consecutive ids, each block ended by the row that follows it.

    Blocks come from approximate quantiles of the ids; the text is shuffled once. The
    largest row of each block, which follows the block above, is sent to both.
    """
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(LOWEST)).alias("place"),
                       F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    cuts = np.unique(rows.approxQuantile("place", [k / blocks for k in range(1, blocks)], 0.2 / blocks) or [0.0])

    @F.arrow_udf("bigint")
    def block(place: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, place.to_numpy(zero_copy_only=False).astype(float)), pa.int64())

    largest = sorted((r.block, r.place) for r in
                     rows.groupBy(block("place").alias("block")).agg(F.max("place").alias("place")).collect())
    rows = rows.withColumn("block", block("place"))
    if not largest:
        return rows.withColumn("carried", F.lit(0))
    above = [b for b, _ in largest[1:]] + [largest[0][0]]
    ends = docs.sparkSession.createDataFrame([(p, b) for (_, p), b in zip(largest, above)], "place bigint, block bigint")
    carried = rows.drop("block").join(F.broadcast(ends), "place")  # one row per block
    return (rows.withColumn("carried", F.lit(0))
            .unionByName(carried.withColumn("carried", F.lit(1)))
            .repartition(tasks, "block")
            .sortWithinPartitions("block", "carried", F.desc("place"), F.desc("text")))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprint of each text, of its edited text, and its likeness to that and to the next document.

    The edited text has its second half replaced from the next document in descending
    doc_id; after the last comes the first, and a lone row follows itself. Null texts are
    empty; null doc_ids count as the smallest; rows of equal doc_id are ordered by text.
    Texts under three bytes have no triplet and differ by length alone. An empty table
    gives none. Other columns are not read.
    """
    length = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_BLOCKS, 1 + length // TASK_BYTES))
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row, whose next document hasn't come: block, doc_id, text, digest
        for batch in batches:
            rows = []
            cols = [batch.column(batch.schema.get_field_index(n)).to_pylist()
                    for n in ("block", "carried", "doc_id", "text")]
            for block, carried, doc, text in zip(*cols):
                text = text or ""
                mark = digest(text) if waiting and waiting[0] == block or not carried else None
                if waiting and waiting[0] == block:
                    _, own_doc, own, own_mark = waiting
                    half = len(own) // 2
                    edited = own[:len(own) - half] + text[:half]
                    edited_mark = digest(edited)
                    rows.append((own_doc, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_mark, edited_mark,
                                 likeness(own_mark, edited_mark), likeness(own_mark, mark)))
                waiting = None if carried else (block, doc, text, mark)
            cols = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    # Several blocks to a task, so that no task has twice its share of them.
    return with_next(docs, text, doc_id, min(MOST_BLOCKS, 8 * tasks), tasks).mapInArrow(run, schema)
