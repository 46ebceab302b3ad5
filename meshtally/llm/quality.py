"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text come from its bytes and words. Trees are grown on a bounded
sample of labelled rows, on statistics cut into histogram bins, and flattened into arrays:
a batch of documents walks all nodes of a level at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import held_out, slices

SAMPLE = 20_000  # most labelled rows that the trees are grown on
BINS, TREES, DEPTH, RATE, RIDGE, LEAST_ROWS = 64, 80, 4, 0.15, 1.0, 20
MARKS = b"|!#$%&*"
CLASSES = {"upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)),
           "space": b" \t\r\x0b\x0c", "line": b"\n", "end": b".?", "comma": b",;:",
           "other": bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,;:?" + MARKS),
           "high": bytes(range(128, 256))} | {f"mark_{m}": bytes([m]) for m in MARKS}
STATISTICS = (*CLASSES, "log_bytes", "log_words", "word_length", "distinct_words", "repeated_next", "commonest_word",
              "upper_words", "one_letter_words", "marked_words", "distinct_lines", "line_words")


def statistics(text: str) -> list[float]:
    """The statistics of a text, in the order of STATISTICS; all 0 for an empty one."""
    raw = text.encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = [float(count[list(c)].sum()) / len(raw) for c in CLASSES.values()]
    words = raw.split()
    n = max(1, len(words))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = raw.split(b"\n")
    return [*shares, float(np.log1p(len(raw))), float(np.log1p(len(words))), len(raw) / n, len(seen) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n, max(seen.values(), default=0) / n,
            sum(map(bytes.isupper, words)) / n, sum(len(w) == 1 for w in words) / n,
            sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:?" for w in words) / n,
            len(set(lines)) / len(lines), n / len(lines)]


@dataclass
class Trees:
    """Flattened trees: node k of a tree has children 2k+1 and 2k+2; leaves are at the last level."""

    feature: np.ndarray  # (trees, inner nodes)
    limit: np.ndarray  # a value goes right if it's larger
    value: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += value[at - inner]
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels y (0 or 1) of rows x; logistic loss, second-order gains."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    positive = (y.sum() + 1) / (n + 2)
    base = float(np.log(positive / (1 - positive)))
    inner = (1 << DEPTH) - 1
    features = np.zeros((TREES, inner), np.int64)
    limits = np.full((TREES, inner), np.inf)
    values = np.zeros((TREES, inner + 1))
    margin = np.full(n, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            first, nodes = (1 << depth) - 1, 1 << depth
            best = np.full(nodes, 1e-6)
            local = at - first
            for j in range(width):
                cell = local * BINS + binned[:, j]
                gs, hs, ns = (np.bincount(cell, w, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1) for w in (g, h, None))
                gl, hl = gs[:, :-1], hs[:, :-1]
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga ** 2 / (ha + RIDGE)
                gain[(ns[:, :-1] < LEAST_ROWS) | (ns[:, -1:] - ns[:, :-1] < LEAST_ROWS)] = 0
                cut = gain[:, :len(edges[j])].argmax(axis=1) if len(edges[j]) else np.zeros(nodes, int)
                top = gain[np.arange(nodes), cut] if len(edges[j]) else np.zeros(nodes)
                better = top > best
                best[better] = top[better]
                features[t, first:first + nodes][better] = j
                limits[t, first:first + nodes][better] = edges[j][cut[better]] if better.any() else 0
            at = 2 * at + 1 + (x[np.arange(n), features[t, at]] > limits[t, at])
        leaf = at - inner
        values[t] = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        margin += values[t, leaf]
    return Trees(features, limits, values, base)


def table_of(texts: list[str | None]) -> np.ndarray:
    rows = [statistics(t) for part in slices(texts) for t in part]
    return np.array(rows, float).reshape(-1, len(STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, text: str = "text",
        doc_id: str = "doc_id") -> Trees:
    """Trees grown on at most `sample` labelled rows (those of the least hashed ids), none of them held out.

    Rows with a null id, label or text teach nothing. Without labelled rows every score is 0.5.
    """
    known = (labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y"))
             .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id", 4)))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array(list(table_of(texts.to_pylist())), pa.list_(pa.float64()))

    rows = (docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_t")).where("_t IS NOT NULL")
            .join(F.broadcast(chosen), "_id")  # `sample` rows at most
            .orderBy(F.xxhash64("_id"), "_id").limit(sample)
            .select("_y", measured("_t").alias("_x")).collect())
    x = np.array([r._x for r in rows], float).reshape(-1, len(STATISTICS))
    return grow(x, np.array([r._y for r in rows], float))


def score(text: Column, trees: Trees) -> Column:
    """Score of a text column, 0 to 1; null and empty texts are scored alike."""
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(trees.score(table_of(batch.to_pylist())), pa.float64())

    return run(text)


def scores(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs.

    Each row is scored from its text alone; repeated rows score alike, an empty table gives
    none, and columns other than doc_id and text are not read.
    """
    trees = fit(docs, labels)
    out = docs.select("doc_id", held_out("doc_id", 4).alias("held_out"), score(F.col("text"), trees).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))
